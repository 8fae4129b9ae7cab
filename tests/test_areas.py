"""All areas in one job: the same rows as one run per area."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frostline.config import SENSORS
from frostline.operators import peaks
from frostline.plans import areas, pipelines

T0 = datetime(2024, 1, 1)
POLICIES = {"MAT": areas.CURRENT, "VIN": areas.OF_2023_VIN, "RAS": areas.OF_2023}


@pytest.fixture(scope="module")
def tables(spark):
    """Sites of the same numbers in three areas, with peaks between the thresholds of the rule sets."""
    rows = []
    for a, area in enumerate(POLICIES):
        for site in ("1", "2", "3", None):
            for k in range(150):
                v = 5 * math.sin(k / 15) + a
                jump = {40: 3.0, 60: 6.0, 80: 11.0, 100: -7.0}.get(k, 0.0) if site == "2" else 0.0
                wet = 1000.0 + {40: 250.0, 60: 600.0, 80: 3085.0}.get(k, 0.0) * (site == "2")
                code = {20: 2, 21: 4, 22: 8}.get(k, 0)
                if k not in (7, 8, 9):
                    rows.append((area, site, 10 * a + 1, T0 + timedelta(minutes=15 * k), v + jump, v + jump, v + jump, wet, code))
    schema = "area string, site string, tomst_id long, datetime timestamp_ntz, T1 double, T2 double, T3 double, moist double, error_tomst int"
    raw = spark.createDataFrame(rows, schema)
    bias = spark.createDataFrame([(1, 0.5, None, 0.0), (11, -0.25, 0.0, 1.0)], "tomst_id long, T1 double, T2 double, T3 double")
    visits = spark.createDataFrame([("MAT", "1", 1, T0), ("VIN", "2", 11, T0 + timedelta(minutes=1500)), ("VIN", None, 11, T0), (None, "1", 1, T0)], "area string, site string, tomst_id long, maxdt timestamp_ntz")
    return raw, bias, visits


def as_rows(df):
    return sorted(map(str, df.collect()))


def test_areas_together_equal_areas_alone(tables):
    raw, bias, visits = tables
    together, seen = areas.clean_areas(raw, bias, visits, POLICIES)
    assert together.columns == raw.columns
    got = {}
    for area, policy in POLICIES.items():
        alone = pipelines.clean_series(
            raw.filter(F.col("area") == area).drop("area"), bias, visits.filter(F.col("area") == area).drop("area"), limits=policy.limits, codes=policy.codes, rules=policy.rules
        )
        got[area] = as_rows(together.filter(F.col("area") == area).drop("area"))
        assert got[area] == as_rows(alone.select(*[c for c in raw.columns if c != "area"]))
    assert len({len(r) for r in got.values()}) == 1 and len(set(map(tuple, got.values()))) == 3
    assert set(seen.get) == {f"{s}_{a}" for s in SENSORS for a in POLICIES}
    assert seen.get["T3_MAT"] != seen.get["T3_RAS"] or seen.get["moist_VIN"] != seen.get["moist_RAS"]


def test_an_area_without_a_policy_is_an_error(tables):
    raw, bias, visits = tables
    with pytest.raises(Exception, match="no policy for area"):
        areas.clean_areas(raw, bias, visits, {"MAT": areas.CURRENT})


def test_counts_come_with_the_masking_job(tables):
    raw = tables[0].filter("area = 'MAT'").drop("area")
    flagged, seen = peaks.observe_peaks(peaks.flag_peaks(raw))
    rows = peaks.mask_peaks(flagged).collect()
    want = {r["sensor"]: r["n_peaks"] for r in peaks.peak_counts(peaks.flag_peaks(raw)).collect()}
    assert len(rows) == raw.count() and seen.get == want and sum(want.values()) > 0
