"""Regular time grids: 15-minute series, calendars, dense site-time grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.config import SENSORS
from frostline.functions.scalars import add_minutes, minutes_between
from frostline.operators.chunks import carry, row_halo
from frostline.session import stage

STEP = 15


def _seconds(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later).cast("double")


def _between(value: Column, a: Column, b: Column, share: Column) -> Column:
    return a + (b - a) * share


def interpolate_short_gaps(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    columns: Sequence[str],
    chunk: Column | None = None,
) -> DataFrame:
    """Linear in time over single nulls; longer runs and the ends stay null."""
    halo = row_halo(df, keys, time, 1, 1, chunk)
    w = halo.window
    share = _seconds(F.col(time), F.lag(time).over(w)) / _seconds(F.lead(time).over(w), F.lag(time).over(w))
    out = halo.df.withColumns(
        {
            f"_i_{c}": F.coalesce(F.col(c), _between(F.col(c), F.lag(c).over(w), F.lead(c).over(w), share))
            for c in columns
        }
    )
    return halo.own(out).select(
        *[F.col(f"_i_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def step_sizes(df: DataFrame, site: str = "site", time: str = "datetime", chunk: Column | None = None) -> DataFrame:
    """Distinct steps (minutes, fractions for seconds) per site, with how often each occurs."""
    halo = row_halo(df.select(site, time), [site], time, 1, 0, chunk)
    steps = halo.own(halo.df.withColumn("step", minutes_between(F.col(time), F.lag(time).over(halo.window))))
    return steps.filter("step is not null").groupBy(site, "step").agg(F.count(F.lit(1)).alias("n"))


def regularise(
    df: DataFrame,
    site: str = "site",
    time: str = "datetime",
    sensors: Sequence[str] = SENSORS,
    fill: Sequence[str] = ("tomst_id", "error_tomst"),
    chunk: Column | None = None,
    grid: DataFrame | None = None,
) -> DataFrame:
    """Put sites with mixed or 10-minute steps on a 15-minute grid from their first reading.

    A grid stamp between two readings is interpolated when it is the only one there and both
    readings are present; a null reading likewise when no grid stamp separates it from its
    neighbours. Off-grid readings are dropped afterwards and ``fill`` is taken from the last row
    on the grid. Other sites pass through unchanged. ``grid`` (site, ``_t0``, ``_mixed``) states first reading and mixed steps
    where ``df`` holds parts of series. Readings with their neighbours are staged once,
    as three branches need them.
    """
    columns = df.columns
    sensors = [s for s in sensors if s in columns]
    fill = [c for c in fill if c in columns]
    df = df.filter(F.col(time).isNotNull())
    near = carry(df, [site], time, chunk=chunk, beside=[time, *sensors])
    near = stage(
        near.select(
            *columns,
            F.col(f"_before.{time}").alias("_prev"),
            F.col(f"_after.{time}").alias("_foll"),
            *[F.col(f"_before.{s}").alias(f"_p_{s}") for s in sensors],
            *[F.col(f"_after.{s}").alias(f"_n_{s}") for s in sensors],
        )
    )
    step = minutes_between(F.col(time), F.col("_prev"))
    plan = grid if grid is not None else near.groupBy(site).agg(
        F.min(time).alias("_t0"),
        ((F.min(step) != F.max(step)) | (F.max((step == 10).cast("int")) == 1)).alias("_mixed"),
    )
    rows = near.join(plan, site)
    mixed = F.coalesce(F.col("_mixed"), F.lit(False))

    def slot(t: Column) -> Column:  # whole grid steps from the origin up to t
        return F.floor(_seconds(t, F.col("_t0")) / (60 * STEP)).cast("long")

    on_grid = _seconds(F.col(time), F.col("_t0")) % (60 * STEP) == 0
    # Grid stamps strictly between this row and the next one.
    ahead = F.ceil(_seconds(F.col("_foll"), F.col("_t0")) / (60 * STEP)).cast("long") - 1 - slot(F.col(time))
    behind = (
        F.ceil(_seconds(F.col(time), F.col("_t0")) / (60 * STEP)).cast("long") - 1 - slot(F.col("_prev"))
    )
    rows = rows.withColumns({"_on": on_grid, "_ahead": F.coalesce(ahead, F.lit(0)), "_behind": F.coalesce(behind, F.lit(0))})
    if fill:
        rows = carry(
            rows, [site], time, {f"_f_{c}": F.when(~mixed | F.col("_on"), F.col(c)) for c in fill}, chunk=chunk
        )
    extra = F.when(mixed & (F.col("_ahead") > 0), F.sequence(F.lit(0).cast("long"), F.col("_ahead"))).otherwise(
        F.array(F.lit(0).cast("long"))
    )
    rows = rows.withColumn("_k", F.explode(extra)).filter(~mixed | F.col("_on") | (F.col("_k") > 0))
    new = F.col("_k") > 0
    stamp = add_minutes(F.col("_t0"), (slot(F.col(time)) + F.col("_k")) * STEP)

    def sensor(s: str) -> Column:
        inserted = _between(
            F.col(s), F.col(s), F.col(f"_n_{s}"), _seconds(stamp, F.col(time)) / _seconds(F.col("_foll"), F.col(time))
        )
        own = _between(
            F.col(s),
            F.col(f"_p_{s}"),
            F.col(f"_n_{s}"),
            _seconds(F.col(time), F.col("_prev")) / _seconds(F.col("_foll"), F.col("_prev")),
        )
        lone = (F.col("_ahead") == 0) & (F.col("_behind") == 0)
        return (
            F.when(new, F.when(F.col("_ahead") == 1, inserted))
            .when(F.col(s).isNull() & mixed & lone, own)
            .otherwise(F.col(s))
            .alias(s)
        )

    def value(c: str) -> Column:
        if c == time:
            return F.when(new, stamp).otherwise(F.col(time)).alias(time)
        if c == site:
            return F.col(site)
        if c in sensors:
            return sensor(c)
        if c in fill:
            return F.when(mixed, F.col(f"_f_{c}")).otherwise(F.col(c)).alias(c)
        return F.when(~new, F.col(c)).alias(c)

    return rows.select(*[value(c) for c in columns])


def year_bounds(df: DataFrame, date: str) -> tuple[Column, Column]:
    """First and last calendar day over all series, as scalar subqueries."""
    bounds = df.agg(
        F.make_date(F.year(F.min(date)), F.lit(1), F.lit(1)).alias("a"),
        F.make_date(F.year(F.max(date)), F.lit(12), F.lit(31)).alias("b"),
    )
    return bounds.select("a").scalar(), bounds.select("b").scalar()


def calendar_pad(daily: DataFrame, site: str = "site", date: str = "date") -> DataFrame:
    """Every site gets every day from 1 January of the first to 31 December of the last year.

    Runs on daily rows: one row per site and day.
    """
    first, last = year_bounds(daily, date)
    days = daily.select(site).distinct().select(site, F.explode(F.sequence(first, last)).alias(date))
    return days.join(daily, [site, date], "left").select(*daily.columns)


def dense_grid(
    df: DataFrame,
    values: Sequence[str],
    site: str = "site",
    time: str = "datetime",
    drop_null: bool = False,
) -> DataFrame:
    """Every site at every time stamp any site has, with a ``<value>_imp`` flag where it was null.

    Sites are expanded to days and matched with the stamps of that day, so the grid is built by an
    equi-join on the day. ``drop_null`` first removes rows without any of ``values``.
    """
    rows = df.select(site, time, *values)
    if drop_null:
        rows = rows.filter(F.coalesce(*values).isNotNull())
    stamps = rows.select(F.to_date(time).alias("_day"), F.col(time)).distinct()
    days = stamps.agg(F.min("_day").alias("a"), F.max("_day").alias("b"))
    sites = rows.select(site).distinct()
    grid = (
        sites.select(
            site, F.explode(F.sequence(days.select("a").scalar(), days.select("b").scalar())).alias("_day")
        )
        .join(stamps, "_day")
        .select(site, time)
    )
    dense = grid.join(rows, [site, time], "left")
    return dense.select(site, time, *values, *[F.col(v).isNull().alias(f"{v}_imp") for v in values])
