"""Rolling expressions over a row frame (F2-F8). Edge behaviour is spelled out per function."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def rows_in(frame: WindowSpec) -> Column:
    return F.count(F.lit(1)).over(frame)


def partial_sum(x: Column, frame: WindowSpec) -> Column:
    """Sum of the non-null values in reach, 0 when there are none."""
    return F.coalesce(F.sum(x).over(frame), F.lit(0))


def strict_over(agg: Column, x: Column, frame: WindowSpec, rows: Column | None = None) -> Column:
    """``agg`` over the frame, null when one of its values is null. ``rows``: the frame's rows, if a column has them."""
    return F.when(F.count(x).over(frame) == (rows_in(frame) if rows is None else rows), agg.over(frame))


def strict_max(x: Column, frame: WindowSpec, rows: Column | None = None) -> Column:
    return strict_over(F.max(x), x, frame, rows)


def strict_min(x: Column, frame: WindowSpec) -> Column:
    return strict_over(F.min(x), x, frame)


def mask_hit(flag: Column, frame: WindowSpec, width: int, skip_null: bool = False, rows: Column | None = None) -> Column:
    """1 when a flag is up in the frame, 0 when none is or the frame is cut by the series end.

    A null flag in a whole frame gives null, unless ``skip_null``.
    """
    x = flag.cast("int")
    rows = rows_in(frame) if rows is None else rows
    worst = F.coalesce(F.max(x).over(frame), F.lit(0)) if skip_null else strict_max(x, frame, rows)
    return F.when(rows < width, F.lit(0)).otherwise(worst)


def mean_of_others(x: Column, count: Column, total: Column, rows: Column, width: int) -> Column:
    """Mean of the neighbours in a whole frame from its count and sum, without the row itself; nulls are skipped."""
    others = count - x.isNotNull().cast("int")
    return F.when((rows >= width) & (others > 0), (total - F.coalesce(x, F.lit(0.0))) / others)


def mean_excluding_middle(x: Column, frame: WindowSpec, width: int) -> Column:
    """:func:`mean_of_others` over a frame."""
    return mean_of_others(x, F.count(x).over(frame), F.sum(x).over(frame), rows_in(frame), width)


def full_mean(x: Column, frame: WindowSpec, width: int, strict: bool = True) -> Column:
    """Mean over whole frames only."""
    mean = strict_over(F.avg(x), x, frame) if strict else F.avg(x).over(frame)
    return F.when(rows_in(frame) == width, mean)
