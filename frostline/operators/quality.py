"""Shares, steps and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.operators.resample import step_sizes

RARE_SHARE = 0.0001


def plausible_dates(df: DataFrame, first: str, last: str, time: str = "datetime") -> DataFrame:
    """Rows strictly between two days."""
    return df.filter((F.col(time) > F.lit(first).cast("date")) & (F.col(time) < F.lit(last).cast("date")))


def exclude_prefix(df: DataFrame, prefixes: Sequence[str], site: str = "site") -> DataFrame:
    for prefix in prefixes:
        df = df.filter(~F.col(site).startswith(prefix))
    return df


def minute_shares(df: DataFrame, logger: str = "tomst_id", time: str = "datetime") -> DataFrame:
    """Share of each minute of the hour in a logger's rows (60 rows per logger at most)."""
    counts = df.groupBy(logger, F.minute(time).alias("mins")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(logger)))


def drop_stray_minutes(
    df: DataFrame, logger: str = "tomst_id", time: str = "datetime", share: float = RARE_SHARE
) -> DataFrame:
    """Drop rows at minutes that make up less than ``share`` of the logger's rows."""
    stray = minute_shares(df, logger, time).filter(F.col("share") < share).select(logger, "mins")
    return df.withColumn("mins", F.minute(time)).join(stray, [logger, "mins"], "left_anti").select(*df.columns)


def timestamp_coverage(
    df: DataFrame,
    value: str = "moist",
    time: str = "datetime",
    site: str = "site",
    max_null_share: float | None = 0.8,
    min_observed: int | None = None,
) -> DataFrame:
    """Times with enough observed sites, counted against all sites of the table."""
    n_sites = df.select(site).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    seen = df.groupBy(time).agg(F.count(value).alias("n_observed")).withColumn("n_sites", n_sites)
    if min_observed is not None:
        return seen.filter(F.col("n_observed") > min_observed)
    return seen.filter(1 - F.col("n_observed") / F.col("n_sites") < max_null_share)


def month_completeness(
    df: DataFrame, value: str, keys: Sequence[str] = ("site", "year", "month"), max_null_share: float = 0.5
) -> DataFrame:
    """Groups of daily rows in which less than ``max_null_share`` is null."""
    share = F.avg(F.col(value).isNull().cast("double"))
    return df.groupBy(*keys).agg(share.alias("na_prop")).filter(F.col("na_prop") < max_null_share)


def temporal_resolution(
    df: DataFrame, logger: str = "tomst_id", time: str = "datetime", modal: bool = False, chunk: Column | None = None
) -> DataFrame:
    """The rarest step per logger, or the most frequent one with ``modal``; shorter steps win ties."""
    steps = step_sizes(df, logger, time, chunk)
    order = F.struct(-F.col("n") if modal else F.col("n"), F.col("step"))
    return steps.groupBy(logger).agg(F.min_by("step", order).alias("Temporal_resolution"))
