"""The 13 dispersion and position statistics of a daily series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from frostline.functions.nulls import ratio

# Names of the statistics, in output order.
STAT_NAMES = (
    "mean", "median", "max", "min", "sd", "var", "mad", "cvsd", "cvvar", "cvmad", "qcd", "iqr50", "iqr90",
)

MAD_SCALE = 1.4826


def array_median(values: Column) -> Column:
    """Median of a small array without nulls."""
    ordered = F.sort_array(values)
    n = F.size(ordered)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2.0)


def bundle_aggregates(x: str) -> list[Column]:
    """Aggregates that :func:`bundle_struct` needs for column ``x``.

    ``collect_list`` holds the days of one site and period, 366 values at most.
    """
    c = F.col(x)
    return [
        F.avg(c).alias(f"{x}__mean"),
        F.max(c).alias(f"{x}__max"),
        F.min(c).alias(f"{x}__min"),
        F.stddev_samp(c).alias(f"{x}__sd"),
        F.var_samp(c).alias(f"{x}__var"),
        F.percentile(c, F.array(*[F.lit(p) for p in (0.05, 0.25, 0.5, 0.75, 0.95)])).alias(f"{x}__q"),
        F.collect_list(c).alias(f"{x}__all"),
    ]


def bundle_columns(x: str) -> dict[str, Column]:
    """The statistics by name, computed from the aggregates above."""
    mean, sd, var = F.col(f"{x}__mean"), F.col(f"{x}__sd"), F.col(f"{x}__var")
    q05, q25, q50, q75, q95 = (F.get(F.col(f"{x}__q"), F.lit(i)) for i in range(5))
    mad = MAD_SCALE * array_median(F.transform(F.col(f"{x}__all"), lambda v: F.abs(v - q50)))
    return {
        "mean": mean,
        "median": q50,
        "max": F.col(f"{x}__max"),
        "min": F.col(f"{x}__min"),
        "sd": sd,
        "var": var,
        "mad": mad,
        "cvsd": ratio(sd, mean),
        "cvvar": ratio(var, mean),
        "cvmad": ratio(mad, mean),
        "qcd": ratio(q75 - q25, q75 + q25),
        "iqr50": q75 - q25,
        "iqr90": q95 - q05,
    }
