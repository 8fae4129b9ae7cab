"""Strict aggregates, statistics and row functions."""

import pytest
from pyspark.sql import functions as F

from frostline.functions import nulls, scalars
from frostline.functions.stats import bundle_aggregates, bundle_columns


def agg(spark, values, *columns):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    return tuple(df.agg(*columns).first())


X = None


@pytest.fixture(autouse=True)
def _column(spark):
    global X
    X = F.col("x")


def test_strict_aggregates_see_one_null(spark):
    out = agg(spark, [1, None, 3], nulls.strict_mean(X), nulls.strict_sum(X), nulls.strict_min(X), nulls.strict_max(X))
    assert out == (None,) * 4
    assert agg(spark, [None, None], nulls.strict_mean(X)) == (None,)
    assert agg(spark, [1, 2, 6], nulls.strict_mean(X), nulls.strict_range(X)) == (3.0, 5.0)


def test_thermal_sum_adds_values_not_excess(spark):
    out = agg(spark, [5, 3, 2.9, -1], nulls.thermal_sum(X, 3.0), nulls.thermal_sum(X, 0.0, above=False))
    assert out == (8.0, -1.0)


def test_strict_count_and_quantile(spark):
    assert agg(spark, [1, 2, 3, 4], nulls.strict_count_if(X > 2), nulls.strict_quantile(X, 0.5)) == (2, 2.5)
    assert agg(spark, [1, None], nulls.strict_count_if(X > 2), nulls.strict_quantile(X, 0.5)) == (None, None)


def test_nan_and_infinity_become_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,)], "x double")
    assert [r[0] for r in df.select(nulls.no_nan(X)).collect()] == [None, None, 1.0]


def test_bundle_by_hand(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 10)], "x double")
    got = df.agg(*bundle_aggregates("x")).select(*[c.alias(n) for n, c in bundle_columns("x").items()]).first().asDict()
    assert got["mean"] == 4 and got["median"] == 3 and got["max"] == 10 and got["min"] == 1
    assert abs(got["mad"] - 1.4826) < 1e-12  # |x - 3| = 2 1 0 1 7, median 1
    assert got["iqr50"] == 2 and abs(got["iqr90"] - (8.8 - 1.2)) < 1e-12
    assert abs(got["qcd"] - 2 / 6) < 1e-12 and abs(got["var"] - 12.5) < 1e-12


def test_bundle_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(-1.0,), (1.0,)], "x double")
    got = df.agg(*bundle_aggregates("x")).select(*[c.alias(n) for n, c in bundle_columns("x").items()]).first()
    assert got["cvsd"] is None and got["qcd"] is None


def test_pad_site_code(spark):
    df = spark.createDataFrame([("7",), ("42",), ("123",), ("1234",)], "s string")
    got = [r[0] for r in df.select(scalars.pad_site_code(F.col("s"), "RAS")).collect()]
    assert got == ["RAS007", "RAS042", "RAS123", "RAS1234"]


def test_time_layouts(spark):
    texts = ["2024.01.15 10:30", "15.01.2024 10:30", "2024/01/15 10:30:00", "15.01.2024 10:30:00", "2024.01.15", "15/01/2024", "rubbish"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [str(r[0]) for r in df.select(scalars.parse_logger_time(F.col("t"), ntz=True)).collect()]
    assert got == ["2024-01-15 10:30:00"] * 4 + ["2024-01-15 00:00:00"] * 2 + ["None"]


def test_decimal_comma_and_id(spark):
    df = spark.createDataFrame([("3,25", "/a/data_94212204_0.csv"), ("x", "/a/binary_1_0.csv")], "v string, p string")
    got = df.select(scalars.parse_decimal_comma(F.col("v")), scalars.logger_id_from_path(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(3.25, 94212204), (None, None)]


def test_hydro_year_turns_on_first_of_september(spark):
    df = spark.sql("SELECT date'2020-08-31' AS d UNION ALL SELECT date'2020-09-01' UNION ALL SELECT date'2019-09-01'")
    got = df.select(F.year(scalars.hydro_date(F.col("d"))), F.dayofyear(scalars.hydro_date(F.col("d")))).collect()
    assert [tuple(r) for r in got] == [(2020, 366), (2021, 1), (2020, 1)]


def test_round2_of_halves(spark):
    df = spark.createDataFrame([(14.355,), (14.354999999999999,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(scalars.round2(X)).collect()] == [14.36, 14.36, -0.5]


def test_month_sequence(spark):
    df = spark.sql("SELECT date'2024-01-15' AS a, date'2024-03-02' AS b UNION ALL SELECT date'2024-01-01', date'2024-02-01'")
    got = [[str(x) for x in r[0]] for r in df.select(scalars.month_sequence(F.col("a"), F.col("b"))).collect()]
    assert got == [["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"], ["2024-01-01", "2024-02-01"]]
