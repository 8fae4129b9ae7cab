"""Run ids and run lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_runs(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, run: str = "run", length: str = "run_length"
) -> DataFrame:
    """Number the runs of equal ``value`` per group and add their lengths.

    Null is a value of its own. Groups are daily rows of one year, so 366 rows at most.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    change = F.coalesce((~F.col("_value").eqNullSafe(F.lag("_value").over(w))).cast("int"), F.lit(1))
    first = F.row_number().over(w) == 1
    return (
        df.withColumn("_value", value)
        .withColumn("_change", F.when(first, F.lit(1)).otherwise(change))
        .withColumn(run, F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
        .withColumn(length, F.count(F.lit(1)).over(Window.partitionBy(*keys, run)).cast("int"))
        .drop("_value", "_change")
    )
