"""Hourly and daily tables the indices are built from.

Both keep counts and sums next to the strict means, so months and years are derived from them
without another pass over the readings. Aggregation combines before the shuffle, and every later
group is bounded by the calendar: 24 hours a day, 366 days a year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions.scalars import hydro_date
from frostline.operators.resample import calendar_pad


def _partials(df: DataFrame, keys: Sequence[str], values: Sequence[str], flags: Sequence[str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n")]
    for v in values:
        aggs += [
            F.count(v).alias(f"c_{v}"),
            F.sum(v).alias(f"s_{v}"),
            F.min(v).alias(f"lo_{v}"),
            F.max(v).alias(f"hi_{v}"),
        ]
    for v in flags:
        x = F.col(f"{v}_imp").cast("double")
        aggs += [F.count(x).alias(f"ci_{v}"), F.sum(x).alias(f"si_{v}")]
    return df.groupBy(*keys).agg(*aggs)


def _merge(df: DataFrame, keys: Sequence[str], values: Sequence[str], flags: Sequence[str]) -> DataFrame:
    aggs = [F.sum("n").alias("n")]
    for v in values:
        aggs += [
            F.sum(f"c_{v}").alias(f"c_{v}"),
            F.sum(f"s_{v}").alias(f"s_{v}"),
            F.min(f"lo_{v}").alias(f"lo_{v}"),
            F.max(f"hi_{v}").alias(f"hi_{v}"),
        ]
    for v in flags:
        aggs += [F.sum(f"ci_{v}").alias(f"ci_{v}"), F.sum(f"si_{v}").alias(f"si_{v}")]
    return df.groupBy(*keys).agg(*aggs)


def hourly_partials(
    df: DataFrame, values: Sequence[str], flags: Sequence[str], site: str = "site", time: str = "datetime"
) -> DataFrame:
    rows = df.select(
        F.col(site).alias("site"),
        F.to_date(time).alias("date"),
        F.hour(time).alias("hour"),
        *values,
        *[f"{v}_imp" for v in flags],
    )
    return _partials(rows, ["site", "date", "hour"], values, flags)


def daily_partials(
    df: DataFrame, values: Sequence[str], flags: Sequence[str], site: str = "site", time: str = "datetime"
) -> DataFrame:
    rows = df.select(
        F.col(site).alias("site"), F.to_date(time).alias("date"), *values, *[f"{v}_imp" for v in flags]
    )
    return _partials(rows, ["site", "date"], values, flags)


def daily_from_hourly(hourly: DataFrame, values: Sequence[str], flags: Sequence[str]) -> DataFrame:
    return _merge(hourly, ["site", "date"], values, flags)


def strict_of(v: str, stat: str = "s", count: str = "c") -> Column:
    """``stat`` of ``v`` where every reading of the row's period is present."""
    return F.when(F.col(f"{count}_{v}") == F.col("n"), F.col(f"{stat}_{v}"))


def with_means(partials: DataFrame, values: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Add the strict mean of each value as ``<v>``, and of each flag as ``<v>_imp``."""
    return partials.withColumns(
        {
            **{v: strict_of(v) / F.col("n") for v in values},
            **{f"{v}_imp": strict_of(v, "si", "ci") / F.col("n") for v in flags},
        }
    )


def with_calendar(df: DataFrame) -> DataFrame:
    """Add year, month, doy and the hydrological year of ``date``."""
    return df.withColumns(
        {
            "year": F.year("date"),
            "month": F.month("date"),
            "doy": F.dayofyear("date"),
            "hydyear": F.year(hydro_date(F.col("date"))),
        }
    )


def padded_daily(partials: DataFrame, values: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Daily means over whole calendar years; a missing day is one row without readings."""
    padded = calendar_pad(partials, "site", "date")
    counts = [f"c_{v}" for v in values] + [f"ci_{v}" for v in flags]
    padded = padded.withColumn("missing", F.col("n").isNull())
    padded = padded.fillna(1, ["n"]).fillna(0, counts)
    return with_calendar(with_means(padded, values, flags))


def padded_hourly(hourly: DataFrame, daily: DataFrame, values: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Hourly means plus one empty row for each day without readings."""
    means = with_means(hourly, values, flags).select(
        "site", "date", "hour", *values, *[f"{v}_imp" for v in flags]
    )
    holes = daily.filter("missing").select("site", "date")
    return with_calendar(means.unionByName(holes, allowMissingColumns=True))
