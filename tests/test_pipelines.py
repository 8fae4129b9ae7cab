"""The stages chained on small tables."""

from datetime import date, datetime, timedelta

from frostline.config import EXPORT_COLUMNS
from frostline.operators import dedup
from frostline.operators.export import check_columns, export_clean, export_metadata
from frostline.plans import pipelines

T0 = datetime(2022, 6, 1)


def readings(spark):
    """Two loggers over four days; one misses three hours, one has a stray minute and a spike."""
    rows = []
    for logger in (1, 2):
        for i in range(4 * 96):
            if logger == 1 and 100 <= i < 112:
                continue
            t = 8.0 + (i % 96) / 32 + logger / 4
            rows.append((logger, T0 + timedelta(minutes=15 * i), 4, t, t + 1, 60.0 if (logger, i) == (2, 200) else t + 2, 900.0))
    rows.append((1, T0, 4, 99.0, 99.0, 99.0, 99.0))  # repeated stamp: the smaller reading stays
    return spark.createDataFrame(
        rows, "tomst_id long, datetime timestamp_ntz, zone int, T1 double, T2 double, T3 double, moist double"
    )


def registry(spark):
    rows = [("A001", 1, datetime(2022, 6, 2)), ("A002", 2, datetime(2022, 6, 2, 12))]
    return spark.createDataFrame(rows, "site string, tomst_id long, maxdt timestamp_ntz")


def test_raw_to_cleaned_to_export(spark):
    log = spark.createDataFrame(
        [("A001", 1, date(2022, 6, 4), date(2022, 6, 4), 6), ("A002", 2, date(2022, 6, 1), date(2022, 6, 1), 2)],
        "site string, tomst_id long, start_date date, end_date date, probl int",
    )
    raw = pipelines.raw_table(readings(spark), registry(spark), log, "MAT").cache()
    n = {r["site"]: r["count"] for r in raw.groupBy("site").count().collect()}
    assert n == {"A001": 4 * 96, "A002": 3 * 96}  # gap filled; the day on the shelf is gone
    assert raw.filter("T1 is null").count() == 12 and raw.filter("T1 > 50").count() == 0
    assert raw.filter("error_tomst = 6").count() == 96

    no_bias = spark.createDataFrame([], "tomst_id long, T1 double, T2 double, T3 double")
    clean = pipelines.clean_series(raw, no_bias, registry(spark)).cache()
    assert clean.count() == raw.count()
    assert clean.filter("T3 > 50").count() == 0
    assert clean.filter("error_tomst = 6 AND moist IS NOT NULL").count() == 0
    both = raw.alias("a").join(clean.alias("b"), ["site", "datetime"])
    assert both.filter("b.T1 IS NOT NULL AND a.T1 IS NOT NULL AND abs(a.T1 - b.T1) > 1e-9").count() == 0

    series = export_clean(raw, registry(spark), "MAT")
    places = spark.createDataFrame([("A001", "A", 60.0, 20.0)], "site string, area string, Lat double, Lon double")
    meta = export_metadata(series, places, Country_code="NO")
    assert check_columns(meta, EXPORT_COLUMNS) == ([], []) and meta.columns == list(EXPORT_COLUMNS)
    assert meta.count() == 8 and meta.filter("Latitude IS NULL").count() == 4


def test_imputed_table_is_dense(spark):
    rows = []
    for i in range(96 * 3):
        for s, off in (("A", 0.0), ("B", 1.0), ("C", 2.0)):
            t = None if (s == "C" and 50 <= i < 60) else 9.0 + (i % 96) / 16 + off
            rows.append((s, T0 + timedelta(minutes=15 * i), t, t, t, None if t is None else 800.0 + t))
    df = spark.createDataFrame(rows, "site string, datetime timestamp_ntz, T1 double, T2 double, T3 double, moist double")
    out = pipelines.imputed_table(df, "MAT", max_iter=1, max_depth=4).cache()
    assert out.count() == 3 * 96 * 3
    assert out.columns == ["site", "datetime", "T1", "T2", "T3", "moist", "T1_imp", "T2_imp", "T3_imp", "moist_imp"]
    assert out.filter("T1 IS NULL OR T2 IS NULL OR T3 IS NULL OR moist IS NULL").count() == 0
    assert out.filter("T1_imp").count() == 10 and out.filter("moist_imp").count() == 10


def test_first_file_wins_unless_it_measured_nothing(spark):
    t = [datetime(2024, 1, 1, h) for h in range(3)]
    rows = [
        (1, t[0], "b.csv", 1, 4.0, 1.0),
        (1, t[0], "a.csv", 9, 5.0, 2.0),  # the first file, whatever the value
        (1, t[1], "a.csv", 2, None, None),  # measured nothing
        (1, t[1], "b.csv", 3, 6.0, None),
        (1, t[2], "a.csv", 10, 7.0, 1.0),
        (1, t[2], "a.csv", 9, 8.0, 1.0),  # the first row, by number
    ]
    df = spark.createDataFrame(rows, "tomst_id long, datetime timestamp_ntz, path string, row long, T1 double, moist double")
    got = dedup.first_reading(df, sensors=("T1", "moist")).orderBy("datetime").collect()
    assert [(r["T1"], r["moist"]) for r in got] == [(5.0, 2.0), (6.0, None), (8.0, 1.0)]
