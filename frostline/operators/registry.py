"""Which logger sits at which site, and when it was last read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.operators.dedup import keep_last

COLUMNS = ("site", "tomst_id", "maxdt")


def latest_logger_per_site(registry: DataFrame) -> DataFrame:
    """Newest registry row of each site; the larger logger id on a tie."""
    return keep_last(registry.select(*COLUMNS), ["site"], [F.col("maxdt"), F.col("tomst_id")])


def latest_site_per_logger(registry: DataFrame) -> DataFrame:
    """Newest site of each logger; the larger site code on a tie."""
    newest = keep_last(registry.select(*COLUMNS), ["tomst_id"], [F.col("maxdt"), F.col("site")])
    return newest.select("tomst_id", "site")


def assign_site(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Add the site of each logger from its newest registry row."""
    return df.join(latest_site_per_logger(registry), "tomst_id", "left").select("site", *df.columns)


def assign_site_from_map(df: DataFrame, site_map: DataFrame) -> DataFrame:
    """Add the site from a fixed (site, logger) map."""
    return df.join(site_map.select("tomst_id", "site").distinct(), "tomst_id", "left").select("site", *df.columns)


def unassigned_loggers(df: DataFrame) -> DataFrame:
    """Loggers without a site; there should be none."""
    return df.filter("site is null").select("tomst_id").distinct()


def latest_reading(df: DataFrame, time: str = "datetime") -> DataFrame:
    """Newest reading per (site, logger)."""
    return df.groupBy("site", "tomst_id").agg(F.max(time).alias("maxdt"))


def registry_update(registry: DataFrame, df: DataFrame, drop_null: bool = False) -> DataFrame:
    """Registry plus the newest reading per (site, logger), each row once."""
    out = registry.select(*COLUMNS).unionByName(latest_reading(df)).distinct()
    return out.dropna() if drop_null else out


def multi_logger_sites(registry: DataFrame) -> DataFrame:
    """Distinct (site, logger) pairs of sites that have several loggers."""
    pairs = registry.select("site", "tomst_id").distinct()
    several = pairs.groupBy("site").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return pairs.join(several.select("site"), "site", "left_semi")


def apply_overrides(df: DataFrame, rules: DataFrame, time: str = "datetime") -> DataFrame:
    """Apply a rule table (site, after, before, column, action, target).

    ``action`` is ``null`` (blank ``column``), ``delete`` or ``rename`` (site becomes ``target``, the
    smallest one if several apply); a rule covers days strictly after ``after`` and strictly before
    ``before``, null leaving a side open. Rules are expanded to days and folded to one row per site
    and day, so this is an equi-join that never multiplies rows.
    """
    day = F.to_date(time)
    span = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    first = F.greatest(F.date_add("after", 1), span.select("a").scalar())
    last = F.least(F.date_sub("before", 1), span.select("b").scalar())
    action = F.col("action")
    folded = (
        rules.withColumns({"_a": first, "_b": last})
        .filter("_a <= _b")
        .select("site", F.explode(F.sequence("_a", "_b")).alias("_day"), "column", "action", "target")
        .groupBy("site", "_day")
        .agg(
            F.max((action == "delete").cast("int")).alias("_delete"),
            F.min(F.when(action == "rename", F.col("target"))).alias("_target"),
            F.collect_set(F.when(action == "null", F.col("column"))).alias("_blank"),
        )
    )
    rows = df.withColumn("_day", day).join(folded, ["site", "_day"], "left")
    rows = rows.filter(F.coalesce("_delete", F.lit(0)) == 0)
    fixed = ("site", "tomst_id", time)

    def value(c: str) -> Column:
        if c == "site":
            return F.coalesce("_target", "site").alias("site")
        if c in fixed:
            return F.col(c)
        blank = F.coalesce(F.array_contains("_blank", F.lit(c)), F.lit(False))
        return F.when(~blank, F.col(c)).alias(c)

    return rows.select(*[value(c) for c in df.columns])


def apply_site_renames(registry: DataFrame, renames: DataFrame) -> DataFrame:
    """Give single (site, logger) pairs a new site code: renames(site, tomst_id, new_site)."""
    joined = registry.join(renames.select("site", "tomst_id", "new_site"), ["site", "tomst_id"], "left")
    return joined.select(
        *[F.coalesce("new_site", "site").alias("site") if c == "site" else F.col(c) for c in registry.columns]
    )


def site_overrides(registry: DataFrame, manual: DataFrame, renames: DataFrame) -> DataFrame:
    """Append manual registry rows, then rename (site, logger) pairs; each row once."""
    rows = registry.select(*COLUMNS).unionByName(manual.select(*COLUMNS)).distinct()
    return apply_site_renames(rows, renames).distinct()
