"""Cross-sensor bias from the days a logger was not in the field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.config import NOT_IN_FIELD, TEMPERATURES
from frostline.functions.scalars import middle_of_three
from frostline.operators.chunks import row_halo

STABLE = 0.125


def loggers_to_calibrate(df: DataFrame, bias: DataFrame) -> DataFrame:
    """Loggers that have no offsets yet."""
    return df.select("tomst_id").distinct().join(bias.select("tomst_id"), "tomst_id", "left_anti")


def estimate_bias(df: DataFrame, error: str = "probl", time: str = "datetime", chunk: Column | None = None) -> DataFrame:
    """Offset of each temperature sensor from the middle one, per logger.

    Uses complete rows of the not-in-field days but the last, with plausible values and a T3 that
    stays within 0.125 degrees of its six predecessors and of the first and third successor.
    """
    idle = (
        df.filter(F.col(error) == NOT_IN_FIELD).select("tomst_id", F.to_date(time).alias("_day")).distinct()
    )
    last = idle.groupBy("tomst_id").agg(F.max("_day").alias("_last"))
    idle = idle.join(last, "tomst_id").filter("_day < _last").select("tomst_id", "_day")
    inside = [(F.col(t) > -30) & (F.col(t) < 30) for t in TEMPERATURES]
    rows = (
        df.filter(inside[0] & inside[1] & inside[2] & (F.col("moist") > 0))
        .select("tomst_id", time, *TEMPERATURES, F.to_date(time).alias("_day"))
        .join(idle, ["tomst_id", "_day"], "left_semi")
        .drop("_day")
    )
    halo = row_halo(rows, ["tomst_id"], time, 6, 3, chunk)
    w = halo.window
    t3 = F.col("T3")
    near = [F.abs(t3 - F.lag("T3", k).over(w)) for k in range(1, 7)] + [
        F.abs(t3 - F.lead("T3", k).over(w)) for k in (1, 3)
    ]
    stable = halo.df.withColumn("_near", F.array(*near))
    stable = halo.own(stable).filter(F.forall("_near", lambda x: x.isNotNull() & (x <= STABLE)))
    means = stable.groupBy("tomst_id").agg(*[F.avg(t).alias(t) for t in TEMPERATURES])
    middle = middle_of_three(*[F.col(t) for t in TEMPERATURES])
    return means.select("tomst_id", *[F.round(F.col(t) - middle, 4).alias(t) for t in TEMPERATURES])


def extend_bias(bias: DataFrame, df: DataFrame, error: str = "probl", drop_null: bool = False) -> DataFrame:
    """Known offsets plus estimates for the loggers that have none."""
    new = estimate_bias(df.join(bias.select("tomst_id"), "tomst_id", "left_anti"), error)
    out = bias.select("tomst_id", *TEMPERATURES).unionByName(new)
    return out.dropna() if drop_null else out


def apply_bias(df: DataFrame, bias: DataFrame) -> DataFrame:
    """Subtract the offsets of the row's logger; a missing offset counts as 0."""
    sensors = [t for t in TEMPERATURES if t in df.columns]
    offsets = bias.groupBy("tomst_id").agg(*[F.max(t).alias(f"_o_{t}") for t in sensors])
    joined = df.join(offsets, "tomst_id", "left")
    return joined.select(
        *[
            (F.col(c) - F.coalesce(f"_o_{c}", F.lit(0.0))).alias(c) if c in sensors else F.col(c)
            for c in df.columns
        ]
    )
