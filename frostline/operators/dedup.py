"""Keep one row per key with a stated precedence.

All of these are aggregates, so duplicates collapse before the shuffle and a hot key costs one
row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that is smallest by ``order``; null order values count as smallest."""
    return _pick(df, keys, order, F.min_by)


def measured_first(*columns: str) -> list[Column]:
    """Order by the columns' values, where a null never comes before a value."""
    return [o for c in columns for o in (F.col(c).isNull(), F.col(c))]


def first_reading(
    readings: DataFrame, keys: Sequence[str] = ("tomst_id", "datetime"), sensors: Sequence[str] = ("T1", "T2", "T3", "moist")
) -> DataFrame:
    """One reading per logger and time: of those that measured anything the first by file and row.

    Without the columns ``path`` and ``row`` the smallest reading counts, and a null never comes before a value.
    """
    if {"path", "row"} <= set(readings.columns):
        return keep_first(readings, keys, [F.coalesce(*sensors).isNull(), F.col("path"), F.col("row")]).drop("path", "row")
    return keep_first(readings, keys, measured_first(*sensors, *[c for c in ("zone",) if c in readings.columns]))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that is largest by ``order``."""
    return _pick(df, keys, order, F.max_by)


def merge_archive(
    archive: DataFrame,
    new: DataFrame,
    keys: Sequence[str] = ("site", "datetime"),
    required: Sequence[str] = ("T1", "T2", "T3", "moist"),
) -> DataFrame:
    """Archive rows without a null sensor, then new rows; the archive wins on equal keys."""
    old = archive.dropna(how="any", subset=list(required)).withColumn("datanew", F.lit(False))
    both = old.unionByName(new.withColumn("datanew", F.lit(True)), allowMissingColumns=True)
    order = [F.col("datanew"), *[F.col(c) for c in both.columns if c not in (*keys, "datanew")]]
    return keep_first(both, keys, order)
