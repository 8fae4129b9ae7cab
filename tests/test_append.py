"""Appending readings gives the rows of a whole run, from the chunks they can change."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frostline.plans import append, pipelines

T0 = datetime(2024, 1, 1)
DAYS = 12


@pytest.fixture(scope="module")
def tables(spark):
    """Nine sites: steady, with 10-minute steps, with a gap, off the grid, with two loggers, sparse."""
    rows = []
    for site in range(9):
        k, step = 0, 10 if site == 1 else 15
        while (at := timedelta(minutes=step * k + (4 if site == 3 and k > 200 else 0))) < timedelta(days=DAYS):
            day = at.days
            k += 1
            if (site == 2 and 3 <= day < 6) or (site == 8 and k % 150 > 3):
                continue
            v = 5 * math.sin(k / 20) + site / 10 + (9.0 if k % 331 == 0 else 0.0)
            value = None if k % 97 == 0 else v
            logger = 40 + day // 4 % 2 if site == 4 else site
            code = None if k % 5 or day > 7 else site % 4
            rows.append((f"S{site}", logger, T0 + at, value, v, v - 1, 1000.0 + 10 * v, code))
    schema = "site string, tomst_id long, datetime timestamp_ntz, T1 double, T2 double, T3 double, moist double, error_tomst int"
    raw = spark.createDataFrame(rows, schema).repartition(4).cache()
    bias = spark.createDataFrame([(1, 0.5, None, 0.0), (41, -0.25, 0.0, 1.0)], "tomst_id long, T1 double, T2 double, T3 double")
    visits = spark.createDataFrame([("S0", 0, T0 + timedelta(days=2)), ("S4", 41, T0 + timedelta(days=11))], "site string, tomst_id long, maxdt timestamp_ntz")
    return raw, bias, visits, rounded(pipelines.clean_series(raw, bias, visits))


def rounded(df):
    cells = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(map(str, df.select(*cells).collect()))


CASES = {
    "the last days": "datetime >= '2024-01-11 13:00'",
    "between, and a logger that returns": "site in ('S0', 'S3') and date(datetime) = '2024-01-05' or site = 'S4' and datetime >= '2024-01-09'",
    "a new site and a sparse one": "site = 'S6' or site = 'S8' and datetime >= '2024-01-08'",
    "nothing": "false",
}


@pytest.mark.parametrize("case", CASES)
def test_append_equals_the_whole_run(spark, tables, case):
    raw, bias, visits, want = tables
    new, old = raw.where(CASES[case]), raw.where(f"not ({CASES[case]})")
    cleaned = pipelines.clean_series(old, bias, visits)
    got, summary = append.append_cleaned(old, new, cleaned, append.summary_of(old, 1), bias, visits, days=1)
    assert rounded(got) == want
    assert rounded(summary.select(sorted(summary.columns))) == rounded((s := append.summary_of(raw, 1)).select(sorted(s.columns)))


def test_only_chunks_in_reach_are_read(spark, tables):
    raw = tables[0].where("site <> 'S8'")  # sparse rows reach over many chunks
    last = "datetime >= '2024-01-11 13:00'"
    found = append.closure(raw.where(f"not ({last})"), raw.where(last), append.summary_of(raw.where(f"not ({last})"), 1), 1)
    first = found.summary.agg(F.min("chunk")).first()[0]
    assert min(r.chunk for r in found.replaced.collect()) >= first + 8
    assert min(r.chunk for r in found.read.collect()) >= first + 6


def test_the_grid_from_the_summary(spark, tables):
    raw = tables[0]
    steps = {r.site: r for r in append.plan_of(append.summary_of(raw, 1)).collect()}
    assert {s for s, r in steps.items() if r._mixed} == {"S1", "S2", "S3", "S8"}
    assert all(r._t0 == T0 for r in steps.values())
