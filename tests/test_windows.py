"""Chunked windows, rolling frames, runs and fills."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from frostline.operators import chunks, rolling
from frostline.operators.resample import interpolate_short_gaps
from frostline.operators.runs import with_runs
from tests.conftest import column


@pytest.fixture(scope="module")
def ragged(spark):
    """Two series with gaps of minutes to weeks, so some chunks hold a single row."""
    rng = random.Random(3)
    rows = []
    for key in ("a", "b"):
        t = 0
        for _ in range(300):
            t += rng.choice([15, 15, 15, 15, 60, 1440, 9000])
            rows.append((key, t, rng.choice([None, float(rng.randint(0, 50))])))
    df = spark.createDataFrame(rows, "k string, m int, x double")
    return df.select("k", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, m, 0)").alias("t"), "x")


@pytest.mark.parametrize("days", [1, 3, 30])
@pytest.mark.parametrize("back,ahead", [(1, 0), (0, 2), (4, 4), (9, 3)])
def test_halo_windows_equal_plain_windows(ragged, days, back, ahead):
    plain = Window.partitionBy("k").orderBy("t")

    def features(w):
        frame = w.rowsBetween(-back, ahead)
        return {
            "s": F.sum("x").over(frame),
            "n": F.count(F.lit(1)).over(frame),
            **({"lag": F.lag("x", back).over(w)} if back else {}),
            **({"lead": F.lead("x", ahead).over(w)} if ahead else {}),
        }

    ragged = ragged.withColumn("k2", F.lit(1)).select("k", "k2", "t", "x")
    halo = chunks.row_halo(ragged, ["k", "k2"], "t", back, ahead, chunks.time_chunk("t", days))
    got = halo.own(halo.df.withColumns(features(halo.window)))
    want = ragged.withColumns(features(plain))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("forward", [True, False])
def test_carry_equals_plain_fill(ragged, forward):
    w = Window.partitionBy("k").orderBy("t")
    if forward:
        want = F.last("x", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    else:
        want = F.first("x", True).over(w.rowsBetween(0, Window.unboundedFollowing))
    side = {"forward" if forward else "backward": {"y": F.col("x")}}
    got = chunks.carry(ragged, ["k"], "t", chunk=chunks.time_chunk("t", 2), **side)
    expected = ragged.withColumn("y", want)
    assert sorted(map(str, got.select("k", "t", "x", "y").collect())) == sorted(map(str, expected.collect()))


def test_halo_spreads_one_hot_series(spark):
    hot = spark.range(5000).select(
        F.lit("hot").alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, int(id) * 15, 0)").alias("t"), F.col("id").alias("x")
    )
    halo = chunks.row_halo(hot, ["k"], "t", 4, 4, chunks.time_chunk("t", 2))
    sizes = [r["count"] for r in halo.df.groupBy(chunks.PART).count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 2 * 96 + 8
    assert halo.own(halo.df).count() == 5000


def test_mask_hit_edges_and_nulls(series):
    df = series([9, 0, 0, None, 0, 0, 0, 9])
    halo = chunks.row_halo(df, ["site"], "datetime", 1, 1)
    hot = F.col("T1") > 5
    out = halo.own(
        halo.df.withColumns(
            {"m": rolling.mask_hit(hot, halo.frame(1, 1), 3), "lenient": rolling.mask_hit(hot, halo.frame(1, 1), 3, True)}
        )
    )
    # The ends are never masked; their outlier still masks the neighbour; a null makes its surroundings unknown.
    assert column(out, "m") == [0, 1, None, None, None, 0, 1, 0]
    assert column(out, "lenient") == [0, 1, 0, 0, 0, 0, 1, 0]


def test_mean_excluding_middle(series):
    df = series([1, 1, 1, 1, 100, 3, 3, None, 3])
    halo = chunks.row_halo(df, ["site"], "datetime", 4, 4)
    out = halo.own(halo.df.withColumn("r", rolling.mean_excluding_middle(F.col("T1"), halo.frame(4, 4), 9)))
    got = column(out, "r")
    assert got[:4] == [None] * 4 and got[5:] == [None] * 4
    assert abs(got[4] - 13 / 7) < 1e-12


def test_runs_null_inside_and_across_years(spark):
    rows = [("s", 2020, 1, True), ("s", 2020, 2, True), ("s", 2020, 3, None), ("s", 2020, 4, None), ("s", 2020, 5, True), ("s", 2021, 6, True)]
    df = spark.createDataFrame(rows, "site string, year int, d int, v boolean")
    out = with_runs(df, ["site", "year"], "d", F.col("v"))
    assert [(r["run"], r["run_length"]) for r in out.orderBy("d").collect()] == [(1, 2), (1, 2), (2, 2), (2, 2), (3, 1), (1, 1)]


def test_interpolation_single_double_and_ends(series):
    out = interpolate_short_gaps(series([None, 1, None, 3, None, None, 6, None]), ["site"], "datetime", ["T1"])
    assert column(out, "T1") == [None, 1.0, 2.0, 3.0, None, None, 6.0, None]


def test_interpolation_is_time_weighted(series):
    df = series([0, None, 3], stamps=["2024-01-01 00:00", "2024-01-01 00:10", "2024-01-01 00:30"])
    assert column(interpolate_short_gaps(df, ["site"], "datetime", ["T1"]), "T1") == [0.0, 1.0, 3.0]


def test_null_keys_form_their_own_series(spark):
    rows = [(k, d, float(i)) for k in (None, "a") for i, d in enumerate((1, 2, 40, 41))]
    df = spark.createDataFrame(rows, "k string, d int, x double").select(
        "k", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(d)").alias("t"), "x"
    )
    halo = chunks.row_halo(df, ["k"], "t", 1, 0, chunks.time_chunk("t", 3))
    out = halo.own(halo.df.withColumn("l", F.lag("x").over(halo.window)))
    assert sorted(str(r["l"]) for r in out.collect()) == sorted(["None", "0.0", "1.0", "2.0"] * 2)
