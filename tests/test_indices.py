"""Index rules on hand-made years."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frostline.operators import export, impute, moisture, snow, thermal
from frostline.sources import logger_files


def daily_readings(spark, t1, t2=None, t3=None, start=date(2021, 1, 1), per_day=1, imp=False, moist=None):
    rows = []
    for i, v in enumerate(t1):
        for k in range(per_day):
            t = datetime.combine(start + timedelta(days=i), datetime.min.time()) + timedelta(hours=12 * k)
            a, b, c = v, (t2 or t1)[i], (t3 or t1)[i]
            m = moist[i] if moist else 20.0
            rows.append(("S1", t, a, b, c, m, imp, imp, imp, None if m is None else imp))
    schema = (
        "site string, datetime timestamp_ntz, T1 double, T2 double, T3 double, moist double, "
        "T1_imp boolean, T2_imp boolean, T3_imp boolean, moist_imp boolean"
    )
    return spark.createDataFrame(rows, schema)


def values(df):
    return {(r["var"], r["sensor"]): r["value"] for r in df.collect()}


@pytest.fixture(scope="module")
def year(spark):
    """365 days: -5 in winter, 10 from day 121 to day 240, with a cold spell of five days."""
    t = [10.0 if 121 <= d <= 240 else -5.0 for d in range(1, 366)]
    for d in range(150, 155):
        t[d - 1] = -1.0
    return daily_readings(spark, t)


def test_degree_indices(year):
    daily = thermal.daily_table(year)
    got = {r["var"]: r["T1"] for r in thermal.degree_indices(daily, thermal.DAY_INDICES).filter("year = 2021").collect()}
    assert got["TDD"] == 115 * 10 and got["TDD_days"] == 115
    assert got["GDD3"] == 1150 and got["GDD5_days"] == 115
    assert got["FDD_days"] == 250
    # January to August belong to hydrological year 2021.
    assert got["FDD"] == -5.0 * (120 + 3) - 5


def test_incomplete_year_has_no_indices(spark):
    daily = thermal.daily_table(daily_readings(spark, [1.0] * 300))
    assert thermal.annual_mean(daily).count() == 0
    assert thermal.degree_indices(daily, thermal.DAY_INDICES).filter("period = 'annual' AND year = 2021 AND var = 'TDD'").count() == 0


def test_warm_year_drops_sums_without_days_but_rescues_frost(spark):
    daily = thermal.daily_table(daily_readings(spark, [2.0] * 365))
    got = {r["var"]: (r["T1"], r["T1_imp"]) for r in thermal.degree_indices(daily, thermal.DAY_INDICES).filter("year = 2021").collect()}
    assert "GDD3" not in got and got["FDD_days"] == (0.0, 0.0) and got["TDD"] == (730.0, 0.0)


def test_season_bounds_skip_short_runs(spark):
    t = [-5.0] * 365
    for d in range(100, 105):  # five warm days: enough for T1, not for T3
        t[d - 1] = 10.0
    for d in range(150, 200):
        t[d - 1] = 10.0
    daily = thermal.daily_table(daily_readings(spark, t))
    years = thermal.complete_years(daily)
    t1, t3 = values(thermal.season_index(daily, years, "T1")), values(thermal.season_index(daily, years, "T3"))
    assert t1[("start_of_season", "T1")] == 100 and t3[("start_of_season", "T3")] == 150
    assert t1[("season_length", "T1")] == 99 and t3[("end_of_season", "T3")] == 199


def test_freeze_thaw_amplitude_and_zero(spark):
    rows = []
    # One reading pair per day: (low, high).
    for i, (low, high) in enumerate([(-1.0, 1.0), (-0.2, 0.3), (0.0, 2.0)]):
        for k, v in enumerate((low, high)):
            rows.append(("S1", datetime(2021, 1, 1 + i, 12 * k), v, v, v, False, False, False))
    df = spark.createDataFrame(rows, "site string, datetime timestamp_ntz, T1 double, T2 double, T3 double, T1_imp boolean, T2_imp boolean, T3_imp boolean")
    from frostline.operators import periods

    part = periods.daily_partials(df, ("T1", "T2", "T3"), ("T1", "T2", "T3"))
    daily = periods.with_calendar(periods.with_means(part, ("T1", "T2", "T3"), ("T1", "T2", "T3")))
    # 1>-1 counts, -1>0.3 counts, 0.3>-0.2 is exactly 0.5 and does not, -0.2>2 counts, 2>0 keeps its sign.
    assert values(thermal.freeze_thaw(daily, "T1")) == {("freeze_thaw_freq", "T1"): 3.0}


def test_nearest_rank_extremes(spark):
    df = daily_readings(spark, [float(d) for d in range(1, 32)])
    got = {(r["sensor"], r["var"]): r["value"] for r in thermal.month_ranks(df).collect()}
    assert got[("T1", "min")] == 1.0 and got[("T1", "max")] == 31.0
    got = {(r["sensor"], r["var"]): r["value"] for r in thermal.month_ranks(df, 0.1, 0.9).collect()}
    assert got[("T1", "min")] == 3.0 and got[("T1", "max")] == 29.0


def test_frost_of_season(spark):
    t3 = [-5.0] * 365
    for d in range(150, 200):
        t3[d - 1] = 10.0
    df = daily_readings(spark, t3).unionByName(
        daily_readings(spark, t3).filter("datetime = timestamp_ntz'2021-06-10 00:00:00'").withColumn("T3", F.lit(-2.0)).withColumn("datetime", F.expr("timestamp_ntz'2021-06-10 06:00:00'"))
    )
    daily = thermal.daily_table(df)
    years = thermal.complete_years(daily)
    assert values(thermal.season_frost(daily, years, "T3")) == {("GST3_frost", "T3"): -2.0}
    assert values(thermal.summer_frost(daily, years)) == {("summer_frost_freq", "T3"): 1.0}


def test_quarters_and_short_series(spark):
    days = spark.createDataFrame([("S1", 2021, d, float(d), float(d), 0.0) for d in range(1, 8)], "site string, year int, doy int, moist double, moistsat double, moist_imp double")
    sizes = {r["quarter"]: r["count"] for r in moisture.with_quarters(days).groupBy("quarter").count().collect()}
    assert sizes == {1: 2, 2: 2, 3: 2, 4: 1}
    assert moisture.rolled(days).count() == 0  # fewer than 13 days
    one = days.filter("doy = 1")
    assert moisture.trend(one, "moist").count() == 0
    slope = {r["var"]: r["value"] for r in moisture.trend(days, "moist").collect()}
    assert abs(slope["trend_slope"] - 1) < 1e-12 and abs(slope["trend_r2"] - 1) < 1e-12


def snow_input(spark, cold_from, cold_to, days=730):
    rows = [("S1", datetime(2020, 1, 1) + timedelta(days=i), -1.0 if cold_from <= i < cold_to else 12.0, False) for i in range(days)]
    return spark.createDataFrame(rows, "site string, datetime timestamp_ntz, T2 double, T2_imp boolean")


def test_snow_period(spark):
    got = {r["var"]: r["value"] for r in snow.snow_indices(snow_input(spark, 320, 440, 731)).collect()}
    # Day 320 is 16 November 2020 (doy 321); cores start four days in and spread back over them.
    assert got["newsnow_doy"] == 321 and got["n_snow_days"] == 120 and got["n_snow_period"] == 1
    assert got["snowmelt_doy"] == 440 - 366 and got["max_snow_period_length"] == 120


def test_no_snow_and_always_snow(spark):
    assert snow.snow_indices(snow_input(spark, 0, 0)).count() == 0
    assert snow.snow_indices(snow_input(spark, 0, 9999)).count() == 0  # no snow-free day, no midsummer


def test_pmm_takes_nearest_then_earliest(spark):
    rows = [
        (datetime(2024, 1, 1), 1.0, 10.0),
        (datetime(2024, 1, 2), 1.0, 11.0),
        (datetime(2024, 1, 3), 3.0, 30.0),
        (datetime(2024, 1, 4), 1.4, None),
        (datetime(2024, 1, 5), 2.0, None),
        (datetime(2024, 1, 6), 9.0, None),
        (datetime(2024, 1, 7), -9.0, None),
    ]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, prediction double, observed double")
    got = [r["matched"] for r in impute.pmm_match(df).orderBy("datetime").collect()]
    assert got == [10.0, 11.0, 30.0, 10.0, 10.0, 30.0, 10.0]


def test_match_draws_among_the_nearest(spark):
    rows = [(datetime(2024, 1, 1) + timedelta(hours=i), float(i // 2), 10.0 * i if i < 40 else None) for i in range(40)]
    asks = [(datetime(2024, 2, 1) + timedelta(hours=i), 7.2, None) for i in range(60)] + [(datetime(2024, 3, 1), None, None)]
    df = spark.createDataFrame(rows + asks, "datetime timestamp_ntz, prediction double, observed double")
    out = impute.pmm_match(df, k=3, width=1.0).filter("observed IS NULL")
    got = {r["matched"] for r in out.filter("prediction IS NOT NULL").collect()}
    assert got == {140.0, 150.0, 160.0}  # both of prediction 7, then the earlier one of 8
    again = impute.pmm_match(df.repartition(3), k=3, width=4.0).filter("observed IS NULL")
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    none = df.filter("observed IS NULL")
    assert {r["matched"] for r in impute.pmm_match(none, k=3).collect()} == {None}


def test_forest_uses_many_sites(spark):
    t0 = datetime(2024, 1, 1)
    rows = [
        (f"S{s:02d}", t0 + timedelta(hours=i), None if (i * 7 + s) % 23 == 0 else float((i % 24) + s))
        for s in range(25)
        for i in range(96)
    ]
    rows += [("S99", t0, None)]
    df = spark.createDataFrame(rows, "site string, datetime timestamp_ntz, T1 double")
    sites = sorted({r[0] for r in rows})
    out = impute.impute_forest(df, "T1", sites, num_trees=3, max_iter=1, max_depth=5).cache()
    assert out.count() == 26 * 96
    assert out.filter("T1 IS NULL AND site <> 'S99'").count() == 0
    assert out.filter("site = 'S99' AND T1 IS NULL").count() == 96
    seen = {(r[0], r[2]) for r in rows}
    assert {(r["site"], r["T1"]) for r in out.filter("site <> 'S99'").collect()} <= seen


def test_forest_keeps_observed_and_emits_observed_values(spark):
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        base = 10 + 5 * ((i % 96) / 96)
        for s, off in (("A", 0.0), ("B", 2.0), ("C", -1.0)):
            rows.append((s, t0 + timedelta(minutes=15 * i), None if (s == "B" and 100 <= i < 140) else round(base + off, 3)))
    df = spark.createDataFrame(rows, "site string, datetime timestamp_ntz, T1 double")
    out = impute.impute_forest(df, "T1", ["A", "B", "C"], num_trees=5, max_iter=1, max_depth=6).cache()
    assert out.count() == 1200 and out.filter("T1 IS NULL").count() == 0
    assert out.filter("T1_imp").count() == 40
    both = df.withColumnRenamed("T1", "before").join(out, ["site", "datetime"])
    assert both.filter("before IS NOT NULL AND before <> T1").count() == 0
    seen = {r[0] for r in df.filter("site = 'B' AND T1 IS NOT NULL").select("T1").collect()}
    assert {r[0] for r in out.filter("T1_imp").select("T1").collect()} <= seen


def test_frozen_rule(spark):
    t = datetime(2024, 1, 1)
    k = "site string, datetime timestamp_ntz"
    t1 = spark.createDataFrame([(s, t, v) for s, v in zip("abcd", (5.0, 0.5, 5.0, 5.0))], k + ", T1 double")
    orig = spark.createDataFrame([(s, t, v) for s, v in zip("abcd", (100.0, 100.0, None, None))], k + ", moist double")
    imp = spark.createDataFrame([("a", t, None, None), ("b", t, 90.0, True), ("c", t, 70.0, True)], k + ", moist double, moist_imp boolean")
    got = {r["site"]: (r["moist"], r["moist_imp"]) for r in impute.frozen_moisture(orig, imp, t1).collect()}
    assert got == {"a": (100.0, False), "b": (None, None), "c": (70.0, True), "d": (None, None)}


def test_number_rows(spark):
    df = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("k")).repartition(7)
    got = export.number_rows(df, ["k"]).orderBy("k").collect()
    assert [r["meta_id"] for r in got] == list(range(1, 1001))


def test_scan_of_files(spark, tmp_path):
    def write(name, lines):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("\n".join(lines) + "\n")

    def line(i, when, v="1,5"):
        return f"{i};{when};4;{v};2.5;3;{i % 7};"

    times = [(datetime(2024, 1, 1) + timedelta(minutes=15 * i)) for i in range(101)]
    write("a/data_111_0.csv", [line(i, t.strftime("%Y.%m.%d %H:%M")) for i, t in enumerate(times)])
    write("b/data_222_0.csv", [line(i, t.strftime("%d/%m/%Y %H:%M")) for i, t in enumerate(times[:100])])  # rejected
    again = [line(i, t.strftime("%d.%m.%Y %H:%M:%S")) for i, t in enumerate(times)] + [line(101, times[5].strftime("%d.%m.%Y %H:%M:%S"), "9,25")]
    write("c/data_333_0.csv", again)
    write("c/binary_333_0.csv", ["junk"])
    spark.conf.set("spark.sql.session.timeZone", "Etc/GMT-2")
    try:
        rows = logger_files.scan_logger_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r["tomst_id"] for r in rows} == {111, 333} and len(rows) == 202
    fifth = [r for r in rows if r["tomst_id"] == 333 and r["T1"] == 9.25]
    assert len(fifth) == 1 and fifth[0]["datetime"].timestamp() == datetime.fromisoformat("2024-01-01 01:15:00+00:00").timestamp()


def test_month_ranks_by_selection(spark):
    """Ties, nulls, NaN and repeated times against a sort by hand; no reading is exchanged before it is counted."""
    import random

    rng = random.Random(4)
    rows = []
    for site in ("A", "B"):
        for k in range(900):
            v = rng.choice([-0.0, 0.0, 0.5, 1.0, 1.0625, -3.2, 1e7, 2e7, float("nan")]) if site == "A" else 5.0
            v = None if k % 11 == 0 else v
            rows.append((site, datetime(2024, 1 + k % 2, 1 + k % 28, k % 24, 15 * (k % 3)), v, v, None, bool(k % 2), None, False))
    df = spark.createDataFrame(rows, "site string, datetime timestamp_ntz, T1 double, T2 double, T3 double, T1_imp boolean, T2_imp boolean, T3_imp boolean")
    for q in (0.001, 0.1, 0.7):
        out = thermal.month_ranks(df, q, 1 - q)
        got = {(r["site"], r["month"], r["sensor"], r["var"]): (r["value"], r["pct"]) for r in out.collect()}
        want = {}
        for site in ("A", "B"):
            for month in (1, 2):
                mine = [r for r in rows if r[0] == site and r[1].month == month]
                k = max(1, round(len(mine) * q))
                for sensor, at in (("T1", 2), ("T2", 3)):
                    full = [r for r in mine if r[at] is not None]
                    up = lambda x: (x != x, 0.0 if x != x else x)
                    order = {"min": sorted(full, key=lambda r: (up(r[at]), r[1], r[at + 3] or False))}
                    order["max"] = sorted(full, key=lambda r: ((0, 0.0) if r[at] != r[at] else (1, -r[at]), r[1], r[at + 3] or False))
                    for var in ("min", "max"):
                        if k <= len(full):
                            r = order[var][k - 1]
                            want[site, month, sensor, var] = (str(r[at] + 0.0), None if r[at + 3] is None else 100.0 * r[at + 3])
        assert {k: (str(v + 0.0), p) for k, (v, p) in got.items()} == want
    plan = [line for line in out._jdf.queryExecution().executedPlan().toString().split("\n") if "Initial Plan" not in line]
    depth = [len(line) - len(line.lstrip(" :+-*(0123456789)")) for line in plan]
    for at, line in enumerate(plan):
        if "Scan" in line:
            above, level = [], depth[at]
            for back in range(at - 1, -1, -1):
                if depth[back] < level:
                    level = depth[back]
                    above.append(plan[back])
            first = next(x for x in above if "HashAggregate" in x or (" Exchange " in x and "Broadcast" not in x))
            assert "HashAggregate" in first
