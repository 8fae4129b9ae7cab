"""Insert empty rows where a series skips time stamps (K1, K2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions.scalars import add_minutes, minutes_between
from frostline.operators import chunks


def fill_gaps(
    df: DataFrame,
    keys: Sequence[str],
    time: str = "datetime",
    carry: Sequence[str] = (),
    chunk: Column | None = None,
) -> DataFrame:
    """Fill every gap longer than 15 minutes with rows strictly inside it.

    The step is 15 minutes when the step before the gap is a multiple of 15 (or the gap is the
    first step), else 10. Steps are taken to the second. ``carry`` columns are down-filled; the others are null on new rows.
    """
    columns = df.columns
    near = chunks.carry(df, keys, time, {f"_f_{c}": F.col(c) for c in carry}, chunk=chunk, beside=[time])
    before = minutes_between(F.col(time), F.col(f"_before.{time}"))
    step = F.when(F.coalesce(before, F.lit(15.0)) % 15 == 0, F.lit(15)).otherwise(F.lit(10))
    steps = near.withColumn("_following", F.col(f"_after.{time}")).withColumn("_step", step)
    gap = minutes_between(F.col("_following"), F.col(time))
    # Last whole step that stays strictly before the next row.
    last = (F.ceil(gap / F.col("_step")) - 1).cast("int")
    offsets = F.when((gap > 15) & (last >= 1), F.sequence(F.lit(0), last)).otherwise(F.array(F.lit(0)))
    filled = steps.select(
        *[F.col(f"_f_{c}").alias(c) if c in carry else F.col(c) for c in columns], "_step", F.explode(offsets).alias("_k")
    )
    new = F.col("_k") > 0
    kept = {*keys, *carry}

    def value(c: str) -> Column:
        if c == time:
            return F.when(new, add_minutes(F.col(time), F.col("_k") * F.col("_step"))).otherwise(F.col(time)).alias(c)
        if c in kept:
            return F.col(c)
        return F.when(~new, F.col(c)).alias(c)

    return filled.select(*[value(c) for c in columns])


def fill_gaps_logger(
    df: DataFrame, logger: str = "tomst_id", time: str = "datetime", chunk: Column | None = None
) -> DataFrame:
    """Gap fill per logger; site and error code are down-filled."""
    carry = [c for c in ("site", "probl") if c in df.columns]
    return fill_gaps(df, [logger], time, carry, chunk)


def fill_gaps_site(
    df: DataFrame, site: str = "site", time: str = "datetime", chunk: Column | None = None
) -> DataFrame:
    """Gap fill per site; logger and error code are down-filled."""
    carry = [c for c in ("tomst_id", "error_tomst") if c in df.columns]
    return fill_gaps(df, [site], time, carry, chunk)
