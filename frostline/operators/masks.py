"""Turn readings to null: visits, implausible values, error codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.config import ERROR_CODES, PLAUSIBLE, SENSORS
from frostline.operators.chunks import Halo, row_halo
from frostline.operators.rolling import mask_hit, partial_sum

SERIES = ("site", "tomst_id")


def out_of_range(sensor: str, limits: tuple[float, float]) -> Column:
    low, high = limits
    x = F.col(sensor)
    return (x < low) | ((x >= high) if sensor == "moist" else (x > high))


def mark_visits(df: DataFrame, visits: DataFrame, time: str = "datetime") -> DataFrame:
    """Add ``visit``: how many reading times of (site, logger) fall on the row."""
    marks = (
        visits.select(*SERIES, F.col("maxdt").alias(time))
        .dropna()
        .groupBy(*SERIES, time)
        .agg(F.count(F.lit(1)).cast("int").alias("visit"))
    )
    return df.join(marks, [*SERIES, time], "left")


def _mask_visits(halo: Halo, df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    near = partial_sum(F.col("visit"), halo.frame(1, 1))
    df = df.withColumn("_near", near)
    return df.select(
        *[F.when(F.col("_near") == 0, F.col(c)).alias(c) if c in sensors else F.col(c) for c in df.columns if c != "_near"]
    )


def _mask_range(
    halo: Halo, df: DataFrame, limits: Mapping[str, tuple[float, float]], skip_null: bool
) -> DataFrame:
    hits = {
        f"_hit_{s}": mask_hit(out_of_range(s, lim), halo.frame(1, 1), 3, skip_null) for s, lim in limits.items()
    }
    df = df.withColumns(hits)
    return df.select(
        *[
            F.when(F.col(f"_hit_{c}") == 0, F.col(c)).alias(c) if c in limits else F.col(c)
            for c in df.columns
            if not c.startswith("_hit_")
        ]
    )


def mask_visits(
    df: DataFrame, visits: DataFrame, sensors: Sequence[str] = SENSORS, chunk: Column | None = None
) -> DataFrame:
    """Null the sensors at a reading time and one row to each side."""
    halo = row_halo(mark_visits(df, visits), SERIES, "datetime", 1, 1, chunk)
    return halo.own(_mask_visits(halo, halo.df, sensors)).select(*df.columns)


def mask_range(
    df: DataFrame,
    limits: Mapping[str, tuple[float, float]] = PLAUSIBLE,
    keys: Sequence[str] = SERIES,
    skip_null: bool = False,
    chunk: Column | None = None,
) -> DataFrame:
    """Null implausible values and their neighbours.

    A null neighbour makes the test unknown and nulls the value too, unless ``skip_null``; the
    first and last row of a series are always kept.
    """
    limits = {s: lim for s, lim in limits.items() if s in df.columns}
    halo = row_halo(df, keys, "datetime", 1, 1, chunk)
    return halo.own(_mask_range(halo, halo.df, limits, skip_null)).select(*df.columns)


def mask_visits_and_range(
    df: DataFrame,
    visits: DataFrame,
    limits: Mapping[str, tuple[float, float]] = PLAUSIBLE,
    sensors: Sequence[str] = SENSORS,
    skip_null: bool = False,
    chunk: Column | None = None,
) -> DataFrame:
    """Both masks in one pass: the second looks one row further, so the halo is two rows."""
    sensors = [s for s in sensors if s in df.columns]
    limits = {s: limits[s] for s in sensors}
    halo = row_halo(mark_visits(df, visits), SERIES, "datetime", 2, 2, chunk)
    masked = _mask_range(halo, _mask_visits(halo, halo.df, sensors), limits, skip_null)
    return halo.own(masked).select(*df.columns)


def mask_codes(
    df: DataFrame, codes: Mapping[str, Sequence[int]] = ERROR_CODES, error: str = "error_tomst"
) -> DataFrame:
    """Null the sensors an error code invalidates."""
    return df.select(
        *[
            F.when(~F.coalesce(F.col(error).isin(*codes[c]), F.lit(False)), F.col(c)).alias(c)
            if c in codes
            else F.col(c)
            for c in df.columns
        ]
    )


def any_measured(df: DataFrame, sensors: Sequence[str] = SENSORS) -> DataFrame:
    """Rows with at least one reading."""
    return df.filter(F.coalesce(*sensors).isNotNull())
