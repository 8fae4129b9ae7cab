"""Windows over long series without one task per series.

A series is cut into time chunks. Rolling frames see the rows across a chunk border through a
*halo*: copies of the few nearest rows of the neighbouring chunks. Fills see them through one
carried value per chunk. A series with a third of all rows is thus spread over as many tasks as
it has chunks, and the data are shuffled once, by (series, chunk).

The key of a part is one struct of series and chunk. A struct is never null itself, so null keys
form a series of their own, and no null filter is inferred on one side of the joins below: both
sides read the same exchange. The order columns must be unique within a series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

PART = "_part"
CHUNK = "_c"
OWN = "_own"
CHUNK_DAYS = 30


def time_chunk(time: str, days: int = CHUNK_DAYS) -> Column:
    """Ordinal of the ``days``-long calendar block of ``time``."""
    return F.floor(F.datediff(F.col(time), F.lit("1970-01-01")) / F.lit(days)).cast("int")


@dataclass(frozen=True)
class Halo:
    """Rows with their halo copies; windows of bounded reach are exact on the own rows."""

    df: DataFrame
    order: tuple[str, ...]

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(PART).orderBy(*self.order)

    def frame(self, back: int, ahead: int) -> WindowSpec:
        return self.window.rowsBetween(-back, ahead)

    def own(self, df: DataFrame) -> DataFrame:
        """Drop the halo copies and the helper columns."""
        return df.filter(OWN).drop(PART, OWN)


def _part(keys: Sequence[str], chunk: Column, source: str = "") -> Column:
    """Key of a part: the series keys (taken from the struct ``source`` if given) and the chunk."""
    at = f"{source}." if source else ""
    return F.struct(*[F.col(f"{at}{k}").alias(k) for k in keys], chunk.alias(CHUNK))


def _series(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"{PART}.{k}").alias(k) for k in keys]) if keys else F.lit(0)


def row_halo(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | str,
    back: int,
    ahead: int,
    chunk: Column | None = None,
) -> Halo:
    """Add to each chunk the ``back`` rows before it and the ``ahead`` rows after it.

    ``chunk`` must be an integer that never falls along ``order``; 30-day blocks of the first order
    column by default.
    """
    order = (order,) if isinstance(order, str) else tuple(order)
    keys = tuple(keys)
    columns = df.columns
    chunk = time_chunk(order[0]) if chunk is None else chunk
    part = Window.partitionBy(PART)
    ranked = (
        df.withColumn(PART, _part(keys, chunk))
        .withColumn("_rn", F.row_number().over(part.orderBy(*order)))
        .withColumn("_n", F.count(F.lit(1)).over(part))
    )
    # The few first and last rows of each chunk, as one row per chunk.
    row = F.struct(*[F.col(c) for c in columns], F.lit(False).alias(OWN))
    edges = (
        ranked.filter((F.col("_rn") <= max(ahead, 1)) | (F.col("_rn") > F.col("_n") - back))
        .groupBy(PART)
        .agg(F.first("_n").alias("_n"), F.collect_list(F.struct("_rn", row.alias("row"))).alias("_edge"))
    )
    # Rows of the series before the start and before the end of a chunk, and the chunks in reach.
    along = Window.partitionBy("_series").orderBy(f"{PART}.{CHUNK}")
    this = F.col(f"{PART}.{CHUNK}")
    chunks = (
        edges.withColumn("_series", _series(keys))
        .withColumn("_end", F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumns(
            {
                "_next": F.collect_list(F.struct(this.alias("c"), F.col("_start").alias("at"))).over(
                    along.rowsBetween(1, max(back, 1))
                ),
                "_prev": F.collect_list(F.struct(this.alias("c"), F.col("_end").alias("at"))).over(
                    along.rowsBetween(-max(ahead, 1), -1)
                ),
            }
        )
        .select("_start", "_next", "_prev", F.inline("_edge"))
    )
    after = F.filter("_next", lambda t: (t["at"] - F.col("_start") - F.col("_rn")) < F.lit(back))
    before = F.filter("_prev", lambda t: (F.col("_start") + F.col("_rn") - 1 - t["at"]) < F.lit(ahead))
    copies = (
        chunks.select(
            F.explode(F.transform(F.concat(after, before), lambda t: t["c"])).alias("_to"), F.col("row").alias("_row")
        )
        .select(_part(keys, F.col("_to"), "_row").alias(PART), "_row")
        .groupBy(PART)
        .agg(F.collect_list("_row").alias("_copies"))  # back + ahead rows at most
    )
    self_row = F.array(F.struct(*[F.col(c) for c in columns], F.lit(True).alias(OWN)))
    with_copies = F.when(
        (F.col("_rn") == 1) & F.col("_copies").isNotNull(), F.concat(self_row, F.col("_copies"))
    ).otherwise(self_row)
    out = (
        ranked.join(copies, PART, "left")
        .select(PART, F.explode(with_copies).alias("_row"))
        .select(*[F.col(f"_row.{c}").alias(c) for c in columns], PART, F.col(f"_row.{OWN}").alias(OWN))
    )
    return Halo(out, order)


def carry(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    forward: dict[str, Column] | None = None,
    backward: dict[str, Column] | None = None,
    chunk: Column | None = None,
    beside: Sequence[str] = (),
) -> DataFrame:
    """Nearest non-null values along ``order``, as new columns.

    ``forward`` takes the last one up to and including each row, ``backward`` the next one from it
    on. Each chunk passes one value per column to its neighbours. ``beside`` are columns of the rows just before and after,
    null or not, added as the structs ``_before`` and ``_after``; they pass a border the same way, so one row to each side
    needs no copies of rows.
    """
    keys = list(keys)
    forward, backward = forward or {}, backward or {}
    values = {**forward, **backward}
    base = df.withColumn(PART, _part(keys, time_chunk(order) if chunk is None else chunk))
    base = base.withColumns({f"_v_{name}": value for name, value in values.items()})

    def edge(name: str) -> Column:
        pick = F.max_by if name in forward else F.min_by
        return pick(F.col(f"_v_{name}"), F.when(F.col(f"_v_{name}").isNotNull(), F.col(order)))

    sums = base.groupBy(PART).agg(
        *[edge(name).alias(f"_c_{name}") for name in values],
        *[F.max_by(c, order).alias(f"_l_{c}") for c in beside],
        *[F.min_by(c, order).alias(f"_f_{c}") for c in beside],
    )
    sums = sums.withColumn("_series", _series(keys))
    along = Window.partitionBy("_series").orderBy(f"{PART}.{CHUNK}")
    inside = Window.partitionBy(PART).orderBy(order)

    def outer(name: str) -> Column:
        if name in forward:
            return F.last(f"_c_{name}", True).over(along.rowsBetween(Window.unboundedPreceding, -1))
        return F.first(f"_c_{name}", True).over(along.rowsBetween(1, Window.unboundedFollowing))

    def inner(name: str) -> Column:
        if name in forward:
            return F.last(f"_v_{name}", True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        return F.first(f"_v_{name}", True).over(inside.rowsBetween(0, Window.unboundedFollowing))

    sides = {"_before": (F.lag, "l"), "_after": (F.lead, "f")} if beside else {}
    carried = sums.select(
        PART,
        *[outer(name).alias(f"_i_{name}") for name in values],
        *[
            F.struct(*[step(f"_{edge}_{c}").over(along).alias(c) for c in beside]).alias(f"_i{side}")
            for side, (step, edge) in sides.items()
        ],
    )
    row = F.struct(*[F.col(c) for c in beside])
    # Windows before the join: it keeps their order, so the rows are sorted once.
    base = base.withColumns(
        {f"_w_{name}": inner(name) for name in values} | {side: step(row).over(inside) for side, (step, _) in sides.items()}
    )
    joined = base.join(carried, PART, "left")
    joined = joined.withColumns(
        {name: F.coalesce(f"_w_{name}", f"_i_{name}") for name in values} | {side: F.coalesce(side, f"_i{side}") for side in sides}
    )
    return joined.drop(PART, *[f"{p}{n}" for n in values for p in ("_v_", "_w_", "_i_")], *[f"_i{side}" for side in sides])


def locf(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], chunk: Column | None = None
) -> DataFrame:
    """Down-fill ``columns`` along ``order`` within each series."""
    names = df.columns
    filled = carry(df, keys, order, {f"_f_{c}": F.col(c) for c in columns}, chunk=chunk)
    return filled.select(*[F.col(f"_f_{c}").alias(c) if c in columns else F.col(c) for c in names])
