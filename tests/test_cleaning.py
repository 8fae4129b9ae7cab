"""Gaps, masks, peaks, grids, bias, ledger and merges on hand-made series."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from frostline.config import PEAK_RULES, PEAK_RULES_2023
from frostline.operators import bias, chunks, dedup, gaps, ledger, masks, peaks, registry, resample
from tests.conftest import column


def stamps(df):
    return [t.strftime("%d %H:%M") for t in column(df, "datetime")]


def ts(*minutes):
    return [datetime(2024, 1, 1, m // 60, m % 60) for m in minutes]


@pytest.mark.parametrize(
    "minutes,expected",
    [
        ([0, 15, 35], ["00:00", "00:15", "00:30", "00:35"]),  # 20-minute gap
        ([0, 30], ["00:00", "00:15", "00:30"]),  # first step counts as 15
        ([0, 15, 60], ["00:00", "00:15", "00:30", "00:45", "01:00"]),
        ([0, 10, 40], ["00:00", "00:10", "00:20", "00:30", "00:40"]),  # 10-minute logger
        ([0], ["00:00"]),
    ],
)
def test_gap_fill_steps(series, minutes, expected):
    df = series([1.0] * len(minutes), stamps=ts(*minutes), error_tomst=[3] * len(minutes))
    out = gaps.fill_gaps_site(df)
    assert [s[3:] for s in stamps(out)] == expected
    assert set(column(out, "error_tomst")) == {3} and set(column(out, "tomst_id")) == {1}
    assert sum(v is not None for v in column(out, "T1")) == len(minutes)


def test_gap_fill_with_seconds(series):
    stamps = [f"2024-01-01 {t}" for t in ("00:00:00", "00:15:00", "00:45:30", "01:01:15")]
    out = gaps.fill_gaps_site(series([1, 2, 3, 4], stamps=stamps))
    got = [t.strftime("%H:%M:%S") for t in column(out, "datetime")]
    assert got == ["00:00:00", "00:15:00", "00:30:00", "00:45:00", "00:45:30", "00:55:30", "01:01:15"]


def test_gap_fill_across_chunks_leaves_no_gap(series):
    df = series([1, 2, 3], stamps=["2024-01-01 23:45", "2024-01-05 00:00", "2024-01-05 00:15"], error_tomst=[1, None, 2])
    out = gaps.fill_gaps_site(df, chunk=chunks.time_chunk("datetime", 1))
    assert out.count() == 3 + 3 * 96
    assert [c for c in column(out, "error_tomst")][-2:] == [1, 2]


def test_visit_mask(series, spark):
    df = series([1, 2, 3, 4, 5])
    visits = spark.createDataFrame([("S1", 1, datetime(2024, 1, 1, 0, 30)), ("S1", 2, datetime(2024, 1, 1))], "site string, tomst_id long, maxdt timestamp_ntz")
    assert column(masks.mask_visits(df, visits, ["T1"]), "T1") == [1.0, None, None, None, 5.0]


def test_range_mask_at_the_ends(series):
    df = series([99, 1, 1, 1, -99])
    got = column(masks.mask_range(df, {"T1": (-40.0, 30.0)}), "T1")
    assert got == [99.0, None, 1.0, None, -99.0]
    got = column(masks.mask_range(series([1, None, 1, 1]), {"T1": (-40.0, 30.0)}), "T1")
    assert got == [1.0, None, None, 1.0]
    got = column(masks.mask_range(series([1, None, 1, 1]), {"T1": (-40.0, 30.0)}, skip_null=True), "T1")
    assert got == [1.0, None, 1.0, 1.0]


def test_combined_masks_equal_the_two_steps(series, spark):
    df = series([1, 50, 3, 4, 5, 6, 99, 8, 9, 9, 9], T2=[0.0] * 11, T3=[0.0] * 11, moist=[300.0] * 11)
    visits = spark.createDataFrame([("S1", 1, datetime(2024, 1, 1, 1, 0))], "site string, tomst_id long, maxdt timestamp_ntz")
    one = masks.mask_visits_and_range(df, visits)
    two = masks.mask_range(masks.mask_visits(df, visits))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_code_table(series):
    codes = list(range(11))
    df = series([1] * 11, T2=[1.0] * 11, T3=[1.0] * 11, moist=[1.0] * 11, error_tomst=codes)
    out = masks.mask_codes(df)
    nulled = {s: {c for c, v in zip(codes, column(out, s)) if v is None} for s in ("T1", "T2", "T3", "moist")}
    assert nulled == {"T1": {1, 2, 4, 9}, "T2": {1, 2, 7, 8}, "T3": {1, 2, 4, 5, 7, 8, 10}, "moist": {1, 2, 6, 8, 9, 10}}


def test_chain_unknown_overwrites_and_any_rule_does_not(spark):
    df = spark.range(1)
    null = F.lit(None).cast("boolean")
    rules = [(F.lit(True), F.lit(True)), (null, F.lit(True))]
    assert df.select(peaks.chain(rules)).first()[0] is False
    assert df.select(peaks.chain(rules, any_rule=True)).first()[0] is True


def test_t2_rise_rule_clears_an_earlier_flag(spark):
    one = spark.range(1)
    d, sd, roll, h, l = F.lit(12.0), F.lit(100.0), F.lit(8.0), F.lit(12.0), F.lit(12.0)
    assert one.select(peaks.chain(peaks.rule_conditions(PEAK_RULES["T2"], d, sd, roll, h, l))).first()[0] is False
    assert one.select(peaks.chain(peaks.rule_conditions(PEAK_RULES_2023["T2"], d, sd, roll, h, l))).first()[0] is True


def test_spike_is_found_and_spread(series):
    flat = series([10.0] * 21)
    spike = series([10.0] * 10 + [30.0] + [10.0] * 10, site="S2")
    out = peaks.remove_peaks(flat.unionByName(spike), sensors=["T1"])
    got = column(out.filter("site = 'S2'"), "T1")
    # Rules see the row before and after a jump too, so three flags spread by two rows.
    assert [i for i, v in enumerate(got) if v is None] == list(range(7, 14))
    assert None not in column(out.filter("site = 'S1'"), "T1")[:5]


def test_regularise_ten_minute_logger(series):
    df = series([0, 10, 20, 30, 40, 50, 60], step=10, error_tomst=[0, 0, 5, 0, 0, 0, 0])
    out = resample.regularise(df, sensors=["T1"])
    assert [s[3:] for s in stamps(out)] == ["00:00", "00:15", "00:30", "00:45", "01:00"]
    assert column(out, "T1") == [0.0, 15.0, 30.0, 45.0, 60.0]
    # The inserted stamp takes the code of the last stamp on the grid, not of the reading between.
    assert column(out, "error_tomst") == [0, 0, 0, 0, 0]


def test_regularise_leaves_regular_sites_alone(series):
    df = series([1, None, 3], error_tomst=[0, None, 1])
    assert sorted(map(str, resample.regularise(df, sensors=["T1"]).collect())) == sorted(map(str, df.collect()))


def test_regularise_long_gap_stays_null(series):
    df = series([0, 15, 90], stamps=ts(0, 15, 90), error_tomst=[1, 2, 3])
    out = resample.regularise(df, sensors=["T1"])
    assert column(out, "T1") == [0.0, 15.0, None, None, None, None, 90.0]
    assert column(out, "error_tomst") == [1, 2, 2, 2, 2, 2, 3]


def test_dense_grid_size_and_flag(series):
    df = series([1, 2, 3]).unionByName(series([5], start="2024-01-01 00:30:00", site="S2"))
    out = resample.dense_grid(df, ["T1"])
    assert out.count() == 2 * 3
    assert out.filter("T1_imp").count() == 2


def test_ledger_inclusive_days_and_smallest_code(spark, series):
    log = spark.createDataFrame(
        [("S1", 1, date(2024, 1, 2), date(2024, 1, 3), 6), ("S1", 1, date(2024, 1, 3), date(2024, 1, 3), 1), ("S1", 1, date(2024, 1, 3), date(2024, 1, 3), 0)],
        "site string, tomst_id long, start_date date, end_date date, probl int",
    )
    out = ledger.label_errors(series([0] * 4, step=1440), log)
    assert column(out, "probl") == [0, 6, 1, 0]


def test_archive_wins(spark):
    schema = "site string, datetime timestamp_ntz, T1 double, T2 double, T3 double, moist double"
    t = datetime(2024, 1, 1)
    old = spark.createDataFrame([("A", t, 1.0, 1.0, 1.0, 1.0), ("B", t, 1.0, None, 1.0, 1.0)], schema)
    new = spark.createDataFrame([("A", t, 2.0, 2.0, 2.0, 2.0), ("B", t, 2.0, 2.0, 2.0, 2.0)], schema)
    got = {r["site"]: r["T1"] for r in dedup.merge_archive(old, new).collect()}
    assert got == {"A": 1.0, "B": 2.0}


def test_bias_uses_stable_shelf_days_but_the_last(series):
    n = 40
    df = series([5.5] * n, step=180, T2=[5.0] * n, T3=[4.75] * n, moist=[500.0] * n, probl=[2] * n)
    got = bias.estimate_bias(df).first().asDict()
    assert got == {"tomst_id": 1, "T1": 0.5, "T2": 0.0, "T3": -0.25}
    jumpy = series([5.5] * n, step=180, T2=[5.0] * n, T3=[i % 2 * 1.0 for i in range(n)], moist=[500.0] * n, probl=[2] * n)
    assert bias.estimate_bias(jumpy).count() == 0


def test_missing_offset_counts_as_zero(series, spark):
    df = series([5.0], T2=[5.0], T3=[5.0])
    offsets = spark.createDataFrame([(1, 0.5, None, -0.5)], "tomst_id long, T1 double, T2 double, T3 double")
    row = bias.apply_bias(df, offsets).first()
    assert (row["T1"], row["T2"], row["T3"]) == (4.5, 5.0, 5.5)


def test_overrides(series, spark):
    df = series([1, 2, 3, 4], step=1440)
    rules = spark.createDataFrame(
        [("S1", None, date(2024, 1, 2), "T1", "null", None), ("S1", date(2024, 1, 3), None, None, "delete", None), ("S1", date(2024, 1, 2), date(2024, 1, 4), None, "rename", "S9")],
        "site string, after date, before date, column string, action string, target string",
    )
    got = [(r["site"], r["T1"]) for r in registry.apply_overrides(df, rules).orderBy("datetime").collect()]
    assert got == [("S1", None), ("S1", 2.0), ("S9", 3.0)]
