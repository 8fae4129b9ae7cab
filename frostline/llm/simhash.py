"""SimHash near-duplicates through a hierarchical index over Gray-ordered fingerprints.

Fingerprints are sorted by Gray rank and cut into ranges, so a range shares most of its leading bits. Each range is one
tree: a node stores the bits on which all its fingerprints agree, a child only those that its parent does not fix yet.
A search adds up the differing bits on its way down and leaves a whole group as soon as they exceed the limit.
As fingerprints that differ in a leading bit are far apart in the order, there is one order for each block of bits that
near fingerprints may agree in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.components import components, spanning_edges
from frostline.llm.text import pieces, small_batches, split_words
from frostline.session import stage

SEED = 42
DISTANCE = 2
GROUP = 8192  # fingerprints of a range that is aimed at
MOST_RANGES = 4096  # ranges of an order at most; bounds what is sent to every task
FANOUT = 8


def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's word shingles in order, and their number; a text of fewer words is one shingle."""
    rows, words = split_words(texts)
    if not len(rows):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    counts = np.bincount(rows, minlength=len(texts))
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = b" ".join(words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    first = np.cumsum(counts) - counts
    shingles = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    owner = np.repeat(np.arange(len(texts)), shingles)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = at + np.minimum(size, counts[owner]) - 1
    h64 = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (h64(joined[a:b], SEED) for a, b in zip(starts[at].tolist(), ends[last].tolist(), strict=True)), np.uint64, len(at)
    )
    return hashes, shingles


def fingerprints_of(texts: pa.Array, size: int = 3) -> np.ndarray:
    """64-bit SimHash of each text's word shingles; 0 for texts without words."""
    hashes, shingles = shingle_hashes(texts, size)
    out = np.zeros(len(texts), dtype=np.uint64)
    begin = np.cumsum(shingles) - shingles
    full = np.flatnonzero(shingles)
    for a in range(0, len(full), 256):
        part = full[a : a + 256]
        lo, hi = begin[part[0]], begin[part[-1]] + shingles[part[-1]]
        bits = np.unpackbits(hashes[lo:hi].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, begin[part] - lo, axis=0, dtype=np.int64)
        majority = 2 * ones > shingles[part][:, None]
        out[part] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` is the unsigned fingerprint's bits as a long."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            fp = pa.array(fingerprints_of(b.column("text"), size).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), fp], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in the reflected Gray sequence."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayTree:
    """The hierarchical index of one Gray range."""

    def __init__(self, fingerprints: np.ndarray):
        order = np.argsort(gray_rank(fingerprints), kind="stable")
        self.leaves = fingerprints[order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # first child, pattern, agreed bits
        ones = zeros = self.leaves
        while len(ones) > 1 or not self.levels:
            first = np.arange(0, len(ones), FANOUT)
            ones, zeros = np.bitwise_and.reduceat(ones, first), np.bitwise_or.reduceat(zeros, first)
            self.levels.append((first, ones, ~(ones ^ zeros)))

    def search(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of a query and the fingerprint, of every pair at ``limit`` or fewer bits."""
        _, pattern, agreed = self.levels[-1]
        query = np.repeat(np.arange(len(queries)), len(pattern))
        node = np.tile(np.arange(len(pattern)), len(queries))
        mask = agreed[node]
        apart = np.bitwise_count((queries[query] ^ pattern[node]) & mask).astype(np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            near = apart <= limit
            query, node, apart, mask = query[near], node[near], apart[near], mask[near]
            first = self.levels[level][0]
            below = self.leaves if not level else self.levels[level - 1][1]
            size = np.minimum(first[node] + FANOUT, len(below)) - first[node]
            child = np.repeat(first[node], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            query, apart, fixed = np.repeat(query, size), np.repeat(apart, size), np.repeat(mask, size)
            mask = self.levels[level - 1][2][child] if level else np.full(len(child), ~np.uint64(0))
            apart = apart + np.bitwise_count((queries[query] ^ below[child]) & mask & ~fixed)
            node = child
        near = apart <= limit
        return query[near], self.leaves[node[near]]


def _ordered(fp: np.ndarray) -> np.ndarray:
    """Gray rank as a signed long of the same order."""
    return (gray_rank(fp) ^ np.uint64(1 << 63)).view(np.int64)


def _turned(fp: np.ndarray, by: int) -> np.ndarray:
    """Bits rotated to the left."""
    return (fp << np.uint64(by) | fp >> np.uint64(64 - by)) if by % 64 else fp


def links(distinct: DataFrame, limit: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """``a, b``: edges that connect exactly what fingerprints at ``limit`` or fewer bits connect.

    ``distinct`` has one row per fingerprint ``fp``. Two such fingerprints agree in one of ``limit + 1`` blocks of bits, so
    there is an order for each block, in which it leads. Each order is cut into ranges of about ``group`` fingerprints; only
    their bounds and agreed bits, ``MOST_RANGES`` at most, pass the driver. A task holds one range and searches it for its
    own fingerprints, and for those sent to it: of lower rank, with the same leading block, and near its agreed bits.
    Most leading blocks lie within one range, so each fingerprint is sent about once for each order.
    """
    starts = [64 * k // (limit + 1) for k in range(limit + 2)]

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for k, by in enumerate(starts[:-1]):
                own = _turned(fp, by)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array(own.view(np.int64)), pa.array(_ordered(own))], ["turn", "fp", "place"])

    placed = stage(distinct.select("fp").mapInArrow(ranked, "turn int, fp long, place long"))
    ranges = min(MOST_RANGES, max(1, -(-placed.count() // (group * (limit + 1)))))
    found = placed.groupBy("turn").agg(F.percentile_approx("place", [(i + 1) / ranges for i in range(ranges)], 10 * MOST_RANGES)).collect()
    bounds = {r[0]: np.unique(np.array(r[1][:-1], dtype=np.int64)) for r in found}  # a range ends with its bound

    def own_parts(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per order in the batch: its number, fingerprints, places, and their ranges in it."""
        turns = b.column("turn").to_numpy()
        for k in np.unique(turns):
            rows = np.flatnonzero(turns == k)
            place = b.column("place").to_numpy()[rows]
            yield int(k), b.column("fp").to_numpy()[rows], place, np.searchsorted(bounds[int(k)], place, side="left")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, fp, _, own in own_parts(b):
                yield pa.RecordBatch.from_arrays([pa.array((own + k * MOST_RANGES).astype(np.int32)), pa.array(fp)], ["part", "fp"])

    roots = placed.mapInArrow(dealt, "part int, fp long").groupBy("part").agg(F.bit_and("fp"), F.bit_or("fp")).collect()
    pattern, loose = np.zeros(MOST_RANGES * (limit + 1), np.uint64), np.zeros(MOST_RANGES * (limit + 1), np.uint64)
    filled = np.array([r[0] for r in roots], dtype=np.int64)
    pattern[filled] = np.array([r[1] for r in roots], dtype=np.int64).view(np.uint64)
    loose[filled] = pattern[filled] ^ np.array([r[2] for r in roots], dtype=np.int64).view(np.uint64)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(part: np.ndarray, asks: int, fp: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(np.full(len(fp), asks, np.int32)), pa.array(fp)], ["part", "asks", "fp"])

        for b in batches:
            for k, fp, place, own in own_parts(b):
                yield rows(own + k * MOST_RANGES, 0, fp)
                rest = np.uint64(64 - (starts[k + 1] - starts[k]))  # bits after the leading block
                rank = place.view(np.uint64) ^ np.uint64(1 << 63)
                block_ends = (rank | ((np.uint64(1) << rest) - np.uint64(1))) ^ np.uint64(1 << 63)
                last = np.searchsorted(bounds[k], block_ends.view(np.int64), side="left")
                for at in range(0, len(fp), 4096):
                    more = (last - own)[at : at + 4096]
                    who = np.repeat(np.arange(at, at + len(more)), more)
                    where = own[who] + 1 + np.arange(len(who)) - np.repeat(np.cumsum(more) - more, more) + k * MOST_RANGES
                    near = np.bitwise_count((fp[who].view(np.uint64) ^ pattern[where]) & ~loose[where]) <= limit
                    if near.any():
                        yield rows(where[near], 1, fp[who[near]])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tree = -1, [], None
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            x, y = spanning_edges(np.concatenate(a), np.concatenate(b))
            a.clear()
            b.clear()
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

        def look(values: np.ndarray) -> Iterator[pa.RecordBatch]:
            back = 64 - starts[now // MOST_RANGES]
            for at in range(0, len(values), 512):
                q, match = tree.search(block := values[at : at + 512], limit)
                other = block[q] != match
                a.append(_turned(block[q][other], back))
                b.append(_turned(match[other], back))
                if sum(map(len, a)) > 200_000:
                    yield flush()

        def grown() -> Iterator[pa.RecordBatch]:
            nonlocal tree
            if held and tree is None:
                tree = GrayTree(np.concatenate(held))
                yield from look(tree.leaves)

        for batch in batches:
            part, asks, fp = (batch.column(i).to_numpy() for i in range(3))
            edges = np.flatnonzero((np.diff(part) != 0) | (np.diff(asks) != 0)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(part)], strict=True):
                if lo == hi:
                    continue
                if part[lo] != now:
                    yield from grown()
                    now, held, tree = int(part[lo]), [], None
                values = fp[lo:hi].view(np.uint64)
                if asks[lo]:
                    yield from grown()
                    yield from look(values)
                else:
                    held.append(values)
        yield from grown()
        if a:
            yield flush()

    return (
        placed.mapInArrow(sent, "part int, asks int, fp long")
        .repartition("part")
        .sortWithinPartitions("part", "asks")
        .mapInArrow(searched, "a long, b long")
    )


def near_duplicates(docs: DataFrame, limit: int = DISTANCE, size: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs(doc_id, text)``; other columns don't matter.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the lower-cased (A-Z) text, null like empty; texts without words have fingerprint
    zero and are linked like any other. Repeated rows each get a row. ``component_id`` is the smallest ``doc_id`` that
    links reach; null ids count for nothing, so it is null only if all ids of a component are. Empty in, empty out.
    """
    marked = stage(with_fingerprints(docs, size))
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct, limit))
    classes = stage(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(classes.join(least, "root").select("fp", "component_id"))
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def smallest_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is its ``component_id`` in ``found``, one row of each; rows without an id stay."""
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    columns = docs.columns
    alike = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*[c for c in columns if c != "doc_id"])).alias("row"))
    return alike.select(*[F.col(c) if c == "doc_id" else F.col("row")[c].alias(c) for c in columns]).unionByName(docs.where("doc_id is null"))


def one_of_each(docs: DataFrame, limit: int = DISTANCE, size: int = 3) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of its component, one row of each; rows without an id stay."""
    return smallest_of_each(docs, near_duplicates(docs, limit, size))
