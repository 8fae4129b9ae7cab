"""Clean a table again after new readings, only where they can change it.

A new reading changes rows near it in its own series, and through the reference series rows of all sites near those times. The
closure is taken in chunks of days from a summary with one row per site, logger and chunk, so finding it reads no readings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.config import ERROR_CODES, PEAK_RULES, PLAUSIBLE, SENSORS
from frostline.functions.scalars import minutes_between
from frostline.operators.chunks import CHUNK_DAYS, time_chunk
from frostline.plans.pipelines import clean_series
from frostline.session import stage

#: Rows that a row can be changed from: masks and grid look 3 rows far, peaks and gap fill 8 more.
NEAR, FAR = 3, 8
MARK = "\u0001"


def summary_of(raw: DataFrame, days: int = CHUNK_DAYS) -> DataFrame:
    """One row per site, logger and chunk: rows, first and last time, and the steps within the site that end at them."""
    df = raw.withColumn("chunk", time_chunk("datetime", days))
    before = F.lag("datetime").over(Window.partitionBy("site", "chunk").orderBy("datetime"))
    df = df.withColumn("step", minutes_between(F.col("datetime"), before))
    return df.groupBy("site", "tomst_id", "chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("datetime").alias("first"),
        F.max("datetime").alias("last"),
        F.min("step").alias("low"),
        F.max("step").alias("high"),
        F.max((F.col("step") == 10).cast("int")).alias("ten"),
    )


def _site_chunks(summary: DataFrame) -> DataFrame:
    return summary.groupBy("site", "chunk").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("ten").alias("ten")
    )


def plan_of(summary: DataFrame) -> DataFrame:
    """First reading of each site, and whether its steps are mixed: what the 15-minute grid needs of a whole series."""
    along = Window.partitionBy("site").orderBy("chunk")
    df = _site_chunks(summary).withColumn("over", minutes_between(F.col("first"), F.lag("last").over(along)))
    ten = F.greatest(F.max("ten"), F.max((F.col("over") == 10).cast("int"))) == 1
    low, high = F.least(F.min("low"), F.min("over")), F.greatest(F.max("high"), F.max("over"))
    return df.groupBy("site").agg(F.min("first").alias("_t0"), ((low != high) | ten).alias("_mixed"))


def _near(chunks: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The chunks of each series that are ``hit``, next to such a chunk, or fewer than ``rows`` rows from one."""
    along = Window.partitionBy(*keys).orderBy("chunk")
    df = chunks.withColumn("end", F.sum("n").over(along)).withColumn("start", F.col("end") - F.col("n"))
    later, earlier = along.rowsBetween(1, Window.unboundedFollowing), along.rowsBetween(Window.unboundedPreceding, -1)

    def following(c: str) -> Column:
        return F.min(F.when(F.col("hit"), F.col(c))).over(later)

    def preceding(c: str) -> Column:
        return F.max(F.when(F.col("hit"), F.col(c))).over(earlier)

    tests = [
        F.col("hit"),
        following("start") - F.col("end") < rows,
        F.col("start") - preceding("end") < rows,
        following("chunk") == F.col("chunk") + 1,
        preceding("chunk") == F.col("chunk") - 1,
    ]
    found = F.lit(False)
    for test in tests:
        found = found | F.coalesce(test, F.lit(False))
    return df.withColumn("found", found).filter("found").select(*keys, "chunk")


def _spread(chunks: DataFrame, among: DataFrame, rows: int) -> DataFrame:
    """The chunks in which some site has rows that near to one of the chunks ``among``, themselves included."""
    marked = chunks.join(among.withColumn("hit", F.lit(True)), "chunk", "left").withColumn("hit", F.col("hit").isNotNull())
    return _near(marked, ["site"], rows).select("chunk").distinct()


@dataclass(frozen=True)
class Closure:
    """Chunks whose result is ``replaced``, chunks whose readings are ``read`` for it, summary and grid of all readings."""

    replaced: DataFrame
    read: DataFrame
    summary: DataFrame
    plan: DataFrame


def closure(old: DataFrame, new: DataFrame, summary: DataFrame, days: int = CHUNK_DAYS) -> Closure:
    """What ``new`` readings can change in the cleaned form of ``old``, whose ``summary`` is kept from run to run."""
    touched = stage(new.select("site", "tomst_id", time_chunk("datetime", days).alias("chunk")).distinct())
    places = touched.select("site", "chunk").distinct()
    again = old.withColumn("chunk", time_chunk("datetime", days)).join(places, ["site", "chunk"], "left_semi").drop("chunk")
    both = stage(summary.join(places, ["site", "chunk"], "left_anti").unionByName(summary_of(again.unionByName(new), days)))
    plan = plan_of(both)
    before = plan_of(summary).select("site", F.col("_t0").alias("t"), F.col("_mixed").alias("m"))
    same = F.col("t").eqNullSafe(F.col("_t0")) & F.col("m").eqNullSafe(F.col("_mixed"))
    regridded = plan.join(before, "site", "left").filter(~same).select("site")
    chunks = stage(_site_chunks(both))
    hit = F.coalesce(F.col("hit"), F.lit(False))
    by_site = _near(chunks.join(places.withColumn("hit", F.lit(True)), ["site", "chunk"], "left").withColumn("hit", hit), ["site"], NEAR)
    loggers = both.join(touched.withColumn("hit", F.lit(True)), ["site", "tomst_id", "chunk"], "left").withColumn("hit", hit)
    by_logger = _near(loggers, ["site", "tomst_id"], NEAR)
    whole = chunks.join(regridded, "site", "left_semi")
    changed = by_site.select("chunk").union(by_logger.select("chunk")).union(whole.select("chunk")).distinct()
    replaced = stage(_spread(chunks, changed, FAR))
    return Closure(replaced, stage(_spread(chunks, _spread(chunks, replaced, FAR + 2), NEAR + 1)), both, stage(plan))


def _origin(summary: DataFrame, replaced: DataFrame) -> DataFrame:
    """``site, chunk, origin, again`` for all chunks of a site: the last one with readings up to it, and if it is replaced."""
    chunks = summary.select("site", "chunk").distinct()
    end = summary.agg(F.max("chunk")).scalar()
    following = F.coalesce(F.lead("chunk").over(Window.partitionBy("site").orderBy("chunk")) - 1, end)
    marked = chunks.withColumn("to", following).join(replaced.withColumn("again", F.lit(True)), "chunk", "left")
    return marked.select(
        "site", F.explode(F.sequence("chunk", "to")).alias("at"), F.col("chunk").alias("origin"), F.col("again").isNotNull().alias("again")
    ).withColumnRenamed("at", "chunk")


def cleaned_again(
    old: DataFrame,
    new: DataFrame,
    cleaned: DataFrame,
    bias: DataFrame,
    visits: DataFrame,
    found: Closure,
    days: int = CHUNK_DAYS,
    sensors: Sequence[str] = SENSORS,
    limits: Mapping[str, tuple[float, float]] = PLAUSIBLE,
    codes: Mapping[str, Sequence[int]] = ERROR_CODES,
    rules=PEAK_RULES,
) -> DataFrame:
    """The rows of the replaced chunks, cleaned from the readings of the chunks in reach alone.

    A stretch of chunks in reach is cleaned as a series of its own, on the grid of its whole series. Logger and error code that
    are carried into it come from the last row of ``cleaned`` before it.
    """
    chunk = time_chunk("datetime", days)
    rows = old.unionByName(new).withColumn("chunk", chunk).join(found.read, "chunk", "left_semi")
    skipped = F.col("hit").isNull().cast("int")
    stretches = (
        found.summary.select("site", "chunk").distinct().join(found.read.withColumn("hit", F.lit(True)), "chunk", "left")
        .withColumn("run", F.sum(skipped).over(Window.partitionBy("site").orderBy("chunk")))
        .withColumn("ahead", F.lag("chunk").over(Window.partitionBy("site").orderBy("chunk")))
    )
    runs = stage(stretches.filter("hit").groupBy("site", "run").agg(F.collect_list("chunk").alias("chunks"), F.min_by("ahead", "chunk").alias("ahead")))
    name = F.concat("site", F.lit(MARK), F.col("run").cast("string"))
    named = rows.join(runs.select("site", "run", F.explode("chunks").alias("chunk")), ["site", "chunk"]).withColumn("site", name)
    marks = visits.join(runs.select("site", "run"), "site").withColumn("site", name)
    grid = found.plan.join(runs.select("site", "run"), "site").select(name.alias("site"), "_t0", "_mixed")
    out = clean_series(named.select(*old.columns), bias, marks.select(*visits.columns), sensors, limits, codes, rules, chunk=chunk, grid=grid)
    parts = F.split("site", MARK)
    out = out.withColumns({"run": parts[1].cast("long"), "site": parts[0]}).withColumn("chunk", chunk)
    origin = _origin(found.summary, found.replaced)
    out = out.join(origin.filter("again").select("site", "chunk"), ["site", "chunk"], "left_semi")
    carried = [c for c in ("tomst_id", "error_tomst") if c in cleaned.columns]
    last = origin.join(runs.select("site", "run", F.col("ahead").alias("origin")), ["site", "origin"]).select("site", "run", "chunk")
    seeds = (
        cleaned.withColumn("chunk", chunk).join(last, ["site", "chunk"]).groupBy("site", "run")
        .agg(*[F.max_by(c, "datetime").alias(f"_s_{c}") for c in carried])
    )
    out = out.join(seeds, ["site", "run"], "left")
    return out.select(*[F.coalesce(c, f"_s_{c}").alias(c) if c in carried else F.col(c) for c in cleaned.columns])


def append_cleaned(
    old: DataFrame, new: DataFrame, cleaned: DataFrame, summary: DataFrame, bias: DataFrame, visits: DataFrame, days: int = CHUNK_DAYS, **options
) -> tuple[DataFrame, DataFrame]:
    """``cleaned`` of ``old`` and ``new`` readings together, from ``cleaned`` of the ``old`` ones; and the new summary.

    The rows are those of :func:`frostline.plans.pipelines.clean_series` over all readings. Site and time are no nulls and
    unique over both tables, as in the raw table; ``bias`` and the visits among ``old`` readings are those of the old run. A site
    whose steps become mixed, or that gains an earlier first reading, is cleaned anew as a whole, with all sites in its chunks.
    Without new readings the old table comes back.
    """
    found = closure(old, new, summary, days)
    again = cleaned_again(old, new, cleaned, bias, visits, found, days, **options)
    origin = _origin(found.summary, found.replaced).filter("again").select("site", "chunk")
    kept = cleaned.withColumn("chunk", time_chunk("datetime", days)).join(origin, ["site", "chunk"], "left_anti").drop("chunk")
    return kept.unionByName(again), found.summary
