"""Long and wide layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INDEX_COLUMNS = ("site", "var", "period", "year")


def pivot_sites(
    df: DataFrame, value: str, sites: Sequence[str] | None = None, site: str = "site", time: str = "datetime"
) -> DataFrame:
    """One column per site. Without ``sites`` Spark looks them up, up to its pivot limit."""
    pivot = df.groupBy(time).pivot(site, list(sites)) if sites else df.groupBy(time).pivot(site)
    return pivot.agg(F.first(value, ignorenulls=True))


def unpivot_sites(
    wide: DataFrame, sites: Sequence[str], value: str, site: str = "site", time: str = "datetime"
) -> DataFrame:
    """One row per time and site; nulls are kept."""
    return wide.unpivot([time], list(sites), site, value)


def unpivot_sensors(wide: DataFrame, sensors: Sequence[str], keys: Sequence[str] = INDEX_COLUMNS) -> DataFrame:
    """Columns ``<sensor>`` and ``<sensor>_imp`` become rows (sensor, value, imputed_percentage).

    Rows with any null are dropped.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(s).alias("sensor"),
                F.col(s).cast("double").alias("value"),
                F.col(f"{s}_imp").cast("double").alias("imputed_percentage"),
            )
            for s in sensors
        ]
    )
    return wide.select(*keys, F.inline(cells)).dropna(how="any")
