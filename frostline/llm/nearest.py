"""Nearest neighbours by low-dimensional stable projections in a kd-tree.

Vectors are projected on a few Gaussian directions. A squared projected distance is the true one times a chi-square
variable, so a search that takes projected neighbours in order may stop once the next lies beyond ``d_k^2 * quantile``,
``d_k`` being the k-th best true distance so far: a closer vector is then missed with the quantile's error only.

The upper kd-tree cuts the projected space into cells, one task each. A query is searched in its own cell first, which
bounds ``d_k``, then in the cells whose boxes pass the same test.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.session import stage

AXES = 8
CHANCE = 0.99
CELL = 4096  # vectors of a cell that is aimed at
MOST_CELLS = 4096  # bounds what is sent to every task
SAMPLE = 20_000  # vectors that the cells' cuts are fitted on; every vector is indexed
BUCKET = 64


def chi_square_quantile(chance: float, axes: int) -> float:
    """The quantile for an even number of degrees of freedom."""

    def beyond(x: float) -> float:
        return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(axes // 2))

    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if beyond(middle) > 1 - chance else (low, middle)
    return high


def _usable(rows: DataFrame, axes: int, seed: int) -> DataFrame:
    """``vec_id, vec, dim, proj`` of the vectors that take part; ``vec`` holds doubles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned: dict[int, np.ndarray] = {}
        for b in batches:
            ids, vecs, dims, projs = [], [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) if v.is_valid else np.zeros(0)
                if not len(x) or not np.isfinite(x).all() or not x.any():
                    continue
                if len(x) not in turned:
                    turned[len(x)] = np.random.default_rng([seed, len(x)]).normal(size=(len(x), axes))
                ids.append(i)
                vecs.append((x + 0.0).tobytes())  # no negative zero, so equal vectors have equal bytes
                dims.append(len(x))
                projs.append((x @ turned[len(x)]).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary()), pa.array(dims, pa.int32()), pa.array(projs, pa.list_(pa.float64()))], ["vec_id", "vec", "dim", "proj"])

    plain = rows.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return plain.mapInArrow(run, "vec_id long, vec binary, dim int, proj array<double>")


class Cuts:
    """Upper kd-tree: cell of projected points, by median cuts along the widest axis."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.nodes: list[tuple[int, float, int, int]] = []  # axis, cut, lower and upper child; a cell has axis -1 and its number
        self.cells = 0
        self._grow(sample, cells)

    def _grow(self, points: np.ndarray, cells: int) -> int:
        me = len(self.nodes)
        self.nodes.append((-1, 0.0, self.cells, 0))
        spread = np.ptp(points, axis=0) if len(points) > 1 else np.zeros(1)
        if cells <= 1 or spread.max() == 0:
            self.cells += 1
            return me
        axis = int(spread.argmax())
        lower = cells // 2
        cut = float(np.quantile(points[:, axis], lower / cells))
        below = points[:, axis] <= cut
        if below.all():
            below = points[:, axis] < cut
            cut = float(np.nextafter(cut, -np.inf))
        a = self._grow(points[below], lower)
        self.nodes[me] = (axis, cut, a, self._grow(points[~below], cells - lower))
        return me

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            axis, cut, a, b = self.nodes[node]
            if axis < 0:
                out[rows] = a
            elif len(rows):
                below = points[rows, axis] <= cut
                todo += [(a, rows[below]), (b, rows[~below])]
        return out


class CellTree:
    """kd-tree over the projected vectors of one cell."""

    def __init__(self, ids: list[list[int]], vectors: np.ndarray, points: np.ndarray):
        self.ids, self.vectors, self.points = ids, vectors, points
        self.buckets: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            p = points[rows]
            spread = np.ptp(p, axis=0)
            if len(rows) <= BUCKET or spread.max() == 0:
                self.buckets.append(rows)
                continue
            order = rows[np.argsort(p[:, int(spread.argmax())], kind="stable")]
            todo += [order[: len(order) // 2], order[len(order) // 2 :]]
        self.low = np.array([points[r].min(axis=0) for r in self.buckets])
        self.high = np.array([points[r].max(axis=0) for r in self.buckets])

    def search(self, own: int, vector: np.ndarray, point: np.ndarray, k: int, bound: float, quantile: float) -> list[tuple[float, int]]:
        """The k best ``(distance, vec_id)`` not beyond ``bound``, by incremental projected neighbours."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        box = (gap * gap).sum(axis=1)
        best: list[tuple[float, int]] = []
        limit = bound
        for bucket in np.argsort(box, kind="stable"):
            if box[bucket] > limit * limit * quantile:
                break
            rows = self.buckets[bucket]
            away = self.points[rows] - point
            near = rows[(away * away).sum(axis=1) <= limit * limit * quantile]
            if not len(near):
                continue
            off = self.vectors[near] - vector
            true = np.sqrt((off * off).sum(axis=1))
            for row, d in zip(near[true <= limit].tolist(), true[true <= limit].tolist(), strict=True):
                best += [(d, i) for i in self.ids[row] if i != own]
            if len(best) >= k:
                best = sorted(best)[:k]
                limit = min(limit, best[-1][0])
        return sorted(best)[:k]


def search(rows: DataFrame, asks: Column, k: int = 10, axes: int = AXES, chance: float = CHANCE, cell: int = CELL, seed: int = 11) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row of ``rows(vec_id, embedding)`` where ``asks``.

    ``score`` is the Euclidean distance in double precision; ties go to the smaller ``vec_id``; all other ids are candidates,
    and fewer than ``k`` are all returned. Vectors that are null, empty, zero, or hold null or non-finite values take no
    part, nor do rows without an id, nor vectors of another length than the most frequent (the longer on ties). Of
    several vectors of one id the bytewise smallest counts. Empty in, empty out.
    """
    spark = rows.sparkSession
    quantile = chi_square_quantile(chance, axes)
    one = _usable(rows, axes, seed).groupBy("vec_id").agg(F.min(F.struct("vec", "dim", "proj")).alias("v")).select("vec_id", "v.*")
    usable = stage(one)
    schema = "query_id long, rank int, vec_id long, score double"
    sizes = usable.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if not sizes:
        return spark.createDataFrame([], schema)
    usable = usable.where(F.col("dim") == sizes["dim"]).drop("dim")
    # Of equal vectors only the k + 1 smallest ids can be among anyone's k nearest.
    alike = usable.withColumn("place", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    index = stage(alike.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("proj").alias("proj")))
    total = index.count()
    sample = index.select("proj", F.xxhash64("vec").alias("h")).orderBy("h").limit(SAMPLE).select("proj").toPandas()
    cuts = spark.sparkContext.broadcast(Cuts(np.array(sample["proj"].tolist()), min(MOST_CELLS, -(-total // cell))))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                points = b.column("proj").flatten().to_numpy().reshape(-1, axes)
                yield pa.RecordBatch.from_arrays([pa.array(cuts.value.of(points)), *b.columns], ["cell", *b.schema.names])

    def dealt(df: DataFrame, fields: str) -> DataFrame:
        return df.mapInArrow(placed, f"cell int, {fields}")

    held = stage(dealt(index.select("vec", "ids", "proj"), "vec binary, ids array<long>, proj array<double>"))
    bounds = held.groupBy("cell").agg(*[F.min(F.col("proj")[i]) for i in range(axes)], *[F.max(F.col("proj")[i]) for i in range(axes)]).orderBy("cell").collect()
    numbers = np.array([r[0] for r in bounds], dtype=np.int32)
    low, high = np.array([r[1 : axes + 1] for r in bounds]), np.array([r[axes + 1 :] for r in bounds])
    queries = stage(dealt(usable.where(asks).select("vec_id", "vec", "proj"), "vec_id long, vec binary, proj array<double>"))

    def found(asked: DataFrame) -> DataFrame:
        """Search each query in its ``cell``: ``query_id, vec_id, score`` of up to k candidates not beyond ``bound``."""
        stored = held.select("cell", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("vec_id"), "vec", "proj", "ids", F.lit(None).cast("double").alias("bound"))
        other = asked.select("cell", F.lit(1).alias("kind"), "vec_id", "vec", "proj", F.lit(None).cast("array<long>").alias("ids"), "bound")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, parts, tree = -1, [], None
            for b in batches:
                cells, kinds = b.column("cell").to_numpy(), b.column("kind").to_numpy()
                ends = np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1
                for lo, hi in zip([0, *ends], [*ends, b.num_rows], strict=True):
                    part = b.slice(lo, hi - lo)
                    vectors = np.frombuffer(b"".join(part.column("vec").to_pylist())).reshape(hi - lo, -1)
                    points = part.column("proj").flatten().to_numpy().reshape(hi - lo, axes)
                    if cells[lo] != now:
                        now, parts, tree = cells[lo], [], None
                    if not kinds[lo]:
                        parts.append((part.column("ids").to_pylist(), vectors, points))
                        continue
                    if not parts:
                        continue
                    tree = tree or CellTree([i for p in parts for i in p[0]], np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]))
                    out = []
                    for q, v, p, limit in zip(part.column("vec_id").to_pylist(), vectors, points, part.column("bound").to_pylist(), strict=True):
                        out += [(q, i, d) for d, i in tree.search(q, v, p, k, math.inf if limit is None else limit, quantile)]
                    cols = list(zip(*out, strict=True)) or [[], [], []]
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], ["query_id", "vec_id", "score"])

        together = stored.unionByName(other).repartition("cell").sortWithinPartitions("cell", "kind")
        return together.mapInArrow(run, "query_id long, vec_id long, score double")

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cells but the first whose boxes pass the stopping test at a query's bound."""
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                points = part.column("proj").flatten().to_numpy().reshape(-1, axes)
                bound = part.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
                far = np.zeros((len(points), len(numbers)))
                for i in range(axes):
                    gap = np.maximum(np.maximum(low[None, :, i] - points[:, None, i], points[:, None, i] - high[None, :, i]), 0)
                    far += gap * gap
                ok = np.isnan(bound)[:, None] | (far <= np.nan_to_num(bound * bound * quantile)[:, None])
                ok &= numbers[None, :] != part.column("cell").to_numpy()[:, None]
                who, where = np.nonzero(ok)
                chosen = part.select(["vec_id", "vec", "proj", "bound"]).take(pa.array(who))
                yield pa.RecordBatch.from_arrays([pa.array(numbers[where]), *chosen.columns], ["cell", *chosen.schema.names])

    home = stage(found(queries.withColumn("bound", F.lit(None).cast("double"))))
    reach = home.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("score")).alias("bound"))
    bounded = queries.join(reach, queries["vec_id"] == reach["query_id"], "left").select("cell", "vec_id", "vec", "proj", "bound")
    away = found(bounded.mapInArrow(others, "cell int, vec_id long, vec binary, proj array<double>, bound double"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = home.unionByName(away).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
