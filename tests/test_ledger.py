"""Both forms of the ledger join, and the sweep that settles overlaps."""

import random
from datetime import date, datetime, timedelta

import pytest

from frostline.operators import ledger

SCHEMA = "site string, tomst_id long, start_date date, end_date date, probl int"
DAY = date(2024, 1, 1)


def interval(site, logger, first, last, code):
    return (site, logger, DAY + timedelta(days=first), DAY + timedelta(days=last), code)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    rows = [interval("A", 1, 0, 9, 0), interval("A", 1, 3, 5, 7), interval("A", 1, 4, 6, 2), interval("A", 1, 8, 4, 3), interval("A", 1, 0, 9, 0)]
    rows += [interval(rng.choice("AB"), rng.randint(1, 3), s := rng.randint(0, 800), s + rng.choice((0, 1, 30, 200)), rng.randint(0, 10)) for _ in range(60)]
    rows += [("A", 1, None, DAY, 2), ("A", 1, DAY, None, 2), (None, 1, DAY, DAY, 2), ("A", None, DAY, DAY, 2)]
    readings = [(s, i, datetime(2024, 1, 1) + timedelta(hours=19 * k), "x", k) for s in ("A", "B", None) for i in (1, 2, 3, None) for k in range(1100)]
    readings += [("A", 1, None, "x", -1)]
    return spark.createDataFrame(readings, "site string, tomst_id long, datetime timestamp_ntz, start_date string, row int"), spark.createDataFrame(rows, SCHEMA)


def as_rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("bin_days", [1, 32, 5000])
def test_both_forms_are_equal(tables, bin_days):
    readings, book = tables
    assert as_rows(ledger.label_errors_bins(readings, book, bin_days=bin_days)) == as_rows(ledger.label_errors(readings, book))


def test_segments_are_disjoint_and_joined(spark):
    rows = [interval("A", 1, 0, 9, 0), interval("A", 1, 3, 5, 7), interval("A", 1, 4, 6, 2), interval("A", 1, 7, 7, 2), interval("A", 1, 20, 25, 7), interval("A", 1, 22, 23, 9)]
    got = sorted(((r.start_date - DAY).days, (r.end_date - DAY).days, r.probl) for r in ledger.ledger_segments(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 2, 0), (3, 3, 7), (4, 7, 2), (8, 9, 0), (20, 25, 7)]


def test_long_intervals_have_few_rows(spark):
    """Ten years are one row a bin, not one a day."""
    book = spark.createDataFrame([interval("A", 1, 0, 3650, 2)], SCHEMA)
    assert ledger.ledger_days(book).count() == 3651 and ledger.ledger_segments(book).count() == 1
    readings = spark.createDataFrame([("A", 1, datetime(2026, 5, 5))], "site string, tomst_id long, datetime timestamp_ntz")
    labelled = ledger.label_errors_bins(readings, book)
    assert labelled.first()["probl"] == 2
    text = labelled._jdf.queryExecution().executedPlan().toString()
    assert "_bin" in text and "BroadcastNestedLoop" not in text and "Cartesian" not in text


def test_unknown_codes_are_an_error_and_nothing_is_nothing(spark):
    with pytest.raises(Exception, match="unknown ledger code 77"):
        ledger.ledger_segments(spark.createDataFrame([interval("A", 1, 0, 1, 77)], SCHEMA)).collect()
    assert ledger.ledger_segments(spark.createDataFrame([], SCHEMA)).count() == 0
