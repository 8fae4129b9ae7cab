"""Error ledger: day intervals with a code per (site, logger)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostline.config import NOT_IN_FIELD

KEYS = ("site", "tomst_id")
LEDGER_COLUMNS = (*KEYS, "start_date", "end_date", "probl")


def ledger_days(ledger: DataFrame) -> DataFrame:
    """One row per (site, logger, day). Where intervals overlap the smallest non-zero code wins."""
    days = ledger.filter("end_date >= start_date").select(
        *KEYS, F.explode(F.sequence("start_date", "end_date")).alias("_day"), "probl"
    )
    smallest = F.min(F.when(F.col("probl") != 0, F.col("probl")))
    return days.groupBy(*KEYS, "_day").agg(F.coalesce(smallest, F.lit(0)).alias("probl"))


def label_errors(df: DataFrame, ledger: DataFrame, time: str = "datetime") -> DataFrame:
    """Add ``probl``: the code valid on the day of the row, 0 without one."""
    labelled = df.withColumn("_day", F.to_date(time)).join(ledger_days(ledger), [*KEYS, "_day"], "left")
    return labelled.select(*df.columns, F.coalesce("probl", F.lit(0)).alias("probl"))


BIN_DAYS = 32
LEDGER_CODES = tuple(range(11))


def ledger_segments(ledger: DataFrame, codes: Sequence[int] = LEDGER_CODES) -> DataFrame:
    """Disjoint intervals per (site, logger) with the smallest non-zero code valid in them, 0 where only zeros are.

    A sweep over starts and ends: a running count per code tells which codes are open from one boundary to the next, so
    overlaps cost no row per day. Neighbours of one code are joined. A code that is not among ``codes`` is an error, since
    the sweep would not see it; a null code counts as no interval.
    """
    known = ledger.filter("end_date >= start_date AND probl IS NOT NULL").withColumn(
        "probl",
        F.when(F.col("probl").isin(*codes), F.col("probl")).otherwise(
            F.raise_error(F.concat(F.lit("unknown ledger code "), F.col("probl").cast("string"))).cast("int")
        ),
    )
    edges = F.array(
        F.struct(F.col("start_date").alias("_day"), F.lit(1).alias("_n")),
        F.struct(F.date_add("end_date", 1).alias("_day"), F.lit(-1).alias("_n")),
    )
    steps = (
        known.select(*KEYS, "probl", F.inline(edges))
        .groupBy(*KEYS, "_day")
        .agg(*[F.sum(F.when(F.col("probl") == c, F.col("_n")).otherwise(0)).alias(f"_c{c}") for c in codes])
    )
    line = Window.partitionBy(*KEYS).orderBy("_day")
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    open_ = {c: F.sum(f"_c{c}").over(so_far) for c in codes}
    last = F.lit(None).cast("int")
    code = F.coalesce(*[F.when(open_[c] > 0, F.lit(c)) for c in sorted(codes, key=lambda c: (c == 0, c))], last)
    pieces = steps.select(*KEYS, "_day", code.alias("probl"), F.date_sub(F.lead("_day").over(line), 1).alias("_end"))
    changed = ~F.col("probl").eqNullSafe(F.lag("probl").over(line))
    runs = pieces.withColumn("_run", F.sum(changed.cast("int")).over(so_far))
    return (
        runs.filter("probl IS NOT NULL")
        .groupBy(*KEYS, "_run", "probl")
        .agg(F.min("_day").alias("start_date"), F.max("_end").alias("end_date"))
        .select(*LEDGER_COLUMNS)
    )


def label_errors_bins(df: DataFrame, ledger: DataFrame, time: str = "datetime", bin_days: int = BIN_DAYS) -> DataFrame:
    """``label_errors`` as an interval join: equal on (site, logger, bin of days), between start and end inside it.

    Each disjoint interval has a row per bin it touches, so a ledger of long intervals stays small, and a reading meets the
    few intervals of its bin, of which at most one holds it.
    """
    number = lambda day: F.floor(F.unix_date(day) / bin_days)
    segments = ledger_segments(ledger).withColumn("_bin", F.explode(F.sequence(number(F.col("start_date")), number(F.col("end_date")))))
    rows = df.withColumn("_day", F.to_date(time)).withColumn("_bin", number(F.col("_day")))
    left, right = rows.alias("r"), segments.alias("s")
    same = [F.col(f"r.{c}") == F.col(f"s.{c}") for c in (*KEYS, "_bin")]
    inside = F.col("r._day").between(F.col("s.start_date"), F.col("s.end_date"))
    return left.join(right, [*same, inside], "left").select(*[F.col(f"r.{c}") for c in df.columns], F.coalesce("s.probl", F.lit(0)).alias("probl"))


def drop_not_in_field(df: DataFrame, error: str = "probl") -> DataFrame:
    return df.filter(F.col(error) != NOT_IN_FIELD)


def ledger_update(old: DataFrame, new: DataFrame, replace: bool = False) -> DataFrame:
    """Old and new intervals, each once; or only the new ones."""
    if replace:
        return new.select(*LEDGER_COLUMNS).distinct()
    return old.select(*LEDGER_COLUMNS).unionByName(new.select(*LEDGER_COLUMNS)).distinct()


def normalise_legacy_ledger(ledger: DataFrame, area: str) -> DataFrame:
    """Bare site numbers become padded codes."""
    from frostline.functions.scalars import pad_site_code

    return ledger.withColumn("site", pad_site_code(F.col("site"), area))


def inverted_intervals(ledger: DataFrame) -> DataFrame:
    """Intervals that end before they start; there should be none."""
    return ledger.filter("end_date < start_date")


def sites_without_log(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sites the ledger never mentions."""
    return df.select("site").distinct().join(ledger.select("site"), "site", "left_anti")
