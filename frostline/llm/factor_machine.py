"""Factorisation machines over hashed words, for quality and toxicity.

A text is a sparse vector of all hashed words that occur and, for quality, of bins of structure statistics and of metadata. The
score is ``w0 + sum(w x) + 1/2 sum over factors of ((sum(v x))^2 - sum(v^2 x^2))``, linear in the number of words (sum of squares).
No term is chosen beforehand: every bucket that occurs has a weight and factors, and penalties take the useless ones to zero.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from frostline.llm.text import coded_words, distinct, pieces, small_batches, sums, utf8
from frostline.session import stage, unstage

BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
MAX_ROWS = 16_384  # labelled rows that are learned from, the first by a hash of their id
EDGE_MARKS = b".,;:!?\"'()[]{}*#$%&|<>-_"
BINS = 10
STRUCTURE = ("words", "word_length", "variety", "longest_run", "upper", "digits", "marks", "symbols", "lines", "beyond_ascii", "white")


@dataclass
class Model:
    """``terms``: buckets with a weight that is not zero, ascending; ``edges``: bin borders of each statistic and metadata column.

    ``linear`` and ``factors`` hold the terms first, then ``BINS + 1`` bins for each row of ``edges``, the last one for nulls.
    """

    terms: np.ndarray
    edges: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    metadata: tuple[str, ...] = ()


def term_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash bucket of the terms of each text: its words without marks around them, and their first 3 to 8 bytes.

    A row has a bucket once for each distinct word that gives it. Beginnings of words carry what inflected and compound
    forms share.
    """
    rows, codes, words = coded_words(pc.utf8_lower(texts.cast(pa.string())), lower=False)
    n = max(1, len(words))
    pairs = distinct(rows * n + codes)
    rows, codes = pairs // n, pairs % n
    plain = [w.encode().strip(EDGE_MARKS) for w in words.to_numpy(zero_copy_only=False).tolist()]
    whole = np.array([zlib.crc32(w) for w in plain], dtype=np.uint64)
    head = np.frombuffer(b"".join(w[:8].ljust(8, b"\0") for w in plain), dtype="<u8")
    size = np.array([len(w) for w in plain], dtype=np.int64)
    out_rows, out = [rows], [(whole % BUCKETS).astype(np.int64)[codes] if len(codes) else codes]
    for k in range(3, 9):
        mixed = (head & np.uint64((1 << 8 * k) - 1)) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(k)
        bucket = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        long = size[codes] >= k if len(codes) else np.zeros(0, bool)
        out_rows.append(rows[long])
        out.append(bucket[codes[long]])
    order = np.argsort(rows := np.concatenate(out_rows), kind="stable")
    return rows[order], np.concatenate(out)[order]


def structure_of(texts: pa.Array) -> np.ndarray:
    """Statistics of each text's form, a row of ``STRUCTURE`` each."""
    n = len(texts)
    rows, codes, words = coded_words(texts)
    data, offsets = utf8(texts)
    size = np.diff(offsets)

    def share(values) -> np.ndarray:
        table = np.zeros(256, dtype=np.int64)
        table[list(values)] = 1
        return sums(table[data], offsets) / np.maximum(size, 1)

    count = np.bincount(rows, minlength=n)
    w = np.maximum(count, 1)
    different = np.bincount(distinct(rows * max(1, len(words)) + codes) // max(1, len(words)), minlength=n)
    longest = np.zeros(n, dtype=np.int64)
    if len(rows):
        start = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1])]))
        np.maximum.at(longest, rows[start], np.diff(np.concatenate([start, [len(rows)]])))
    white = share([0x20, *range(9, 14)])
    return np.column_stack(
        [
            np.log1p(count),
            size * (1 - white) / w,
            np.log1p(different) / np.log1p(w),
            longest / np.sqrt(w),
            share(range(65, 91)),
            share(range(48, 58)),
            share(b"!?.,;:-_=+~^/\\@'\"()[]{}"),
            share(b"#*$%&|<>"),
            share(b"\n") * size / w,
            share(range(128, 256)),
            white,
        ]
    )


def _with_metadata(docs: DataFrame, metadata: tuple[str, ...]) -> DataFrame:
    """``doc_id, text, meta``: the metadata as doubles, null where a column is missing or no number."""
    numbers = {f.name for f in docs.schema.fields if isinstance(f.dataType, NumericType)}
    values = [F.col(f"`{c}`").cast("double") if c in numbers else F.lit(None).cast("double") for c in metadata]
    meta = F.array(*values) if values else F.array().cast("array<double>")
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), meta.alias("meta"))


def _values(batch: pa.RecordBatch, statistics: bool, metadata: int) -> np.ndarray:
    """Statistics, then metadata, of each text of a batch; NaN for null."""
    n = batch.num_rows
    stats = structure_of(batch.column("text")) if statistics else np.zeros((n, 0))
    meta = batch.column("meta").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, metadata)
    return np.column_stack([stats, meta])


def _sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, statistics: bool, metadata: tuple[str, ...]) -> DataFrame:
    """``y, terms, stats`` of the labelled rows to learn from."""
    y = F.col(label).cast("int")
    known = labels.where(y.isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.round(F.avg(y)).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = _with_metadata(docs, metadata).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min(F.struct("text", "meta")).alias("one"), F.first("y").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            rows, buckets = term_buckets(b.column("text"))
            pairs = distinct(rows * BUCKETS + buckets)
            cuts = np.searchsorted(pairs, np.arange(b.num_rows + 1) * BUCKETS).astype(np.int32)
            terms = pa.ListArray.from_arrays(pa.array(cuts), pa.array((pairs % BUCKETS).astype(np.int32)))
            stats = _values(b, statistics, len(metadata)).tolist()
            out = [b.column("doc_id"), b.column("y"), terms, pa.array(stats, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "y", "terms", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return one.select("doc_id", "y", "one.text", "one.meta").mapInArrow(run, f"doc_id {kind}, y int, terms array<int>, stats array<double>")


def binned(stats: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Input, counted from 0, of each row and statistic: the bin its value falls in, or the bin of nulls."""
    bins = np.empty(stats.shape, dtype=np.int64)
    for k, cut in enumerate(edges):
        bin_of = np.searchsorted(cut, stats[:, k], side="right")
        bins[:, k] = k * (BINS + 1) + np.where(np.isnan(stats[:, k]), BINS, bin_of)
    return bins


def _sparse(rows: np.ndarray, inputs: np.ndarray, bins: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and input of every entry that is 1, ordered by row, then input."""
    n, width = bins.shape
    rows = np.concatenate([rows, np.repeat(np.arange(n), width)])
    inputs = np.concatenate([inputs, terms + bins.ravel()])
    order = np.lexsort((inputs, rows))
    return rows[order], inputs[order]


def _training(lengths: np.ndarray, terms: np.ndarray, bins: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the rows and their inputs in ascending order, from each row's terms in that order; its bins follow them.

    The entries are put in their places as 32-bit numbers, without sorting all of them at once.
    """
    width = bins.shape[1]
    starts = np.concatenate([[0], np.cumsum(lengths + width)])
    inputs, is_term = np.empty(starts[-1], dtype=np.int32), np.ones(starts[-1], bool)
    last = (starts[1:, None] - width + np.arange(width)).ravel()
    is_term[last] = False
    inputs[last], inputs[is_term] = (base + bins).ravel(), terms
    return starts, inputs


def _margins(rows: np.ndarray, inputs: np.ndarray, n: int, bias: float, linear: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of each row and its sums of factors; a row's sums are taken in the order of its own entries alone."""
    sums_of = np.stack([np.bincount(rows, column[inputs], n) for column in factors.T], axis=1) if len(inputs) else np.zeros((n, factors.shape[1]))
    squares = np.bincount(rows, (factors * factors).sum(axis=1)[inputs], n)  # inputs are 0 or 1, so x^2 = x
    return bias + np.bincount(rows, linear[inputs], n) + ((sums_of**2).sum(axis=1) - squares) / 2, sums_of


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def predict(model: Model, rows: np.ndarray, inputs: np.ndarray, n: int) -> np.ndarray:
    """Probability of label 1 of ``n`` rows, whose entries are given by row and input in ascending order."""
    return _chance(_margins(rows, inputs, n, model.bias, model.linear, model.factors)[0])


def _fit(
    starts: np.ndarray, inputs: np.ndarray, y: np.ndarray, width: int, free: int, factors: int, warm: int, epochs: int, settle: int, rate: float, l1: float, group: float, seed: int
) -> tuple[float, np.ndarray, np.ndarray]:
    """Minimise log loss over small batches of rows; row ``i`` has the ``inputs`` from ``starts[i]`` to ``starts[i + 1]``.

    Weights follow the regularised leader (penalty ``l1`` an epoch times the root of the number of rows, as noise grows with
    it; none for the last ``free`` inputs), so those of useless inputs are exactly zero. After ``warm`` of the ``epochs``
    factors join by Adagrad with a penalty ``group`` on their length, none for an input that has a weight; an input whose factors
    reach zero has no pairs from then on. For all inputs the penalty would end the factors of long texts, which begin short,
    at their first step, whatever they tell. Inputs that are left go on for ``settle`` epochs without a penalty on weights, which would hold their scores near the mean.
    """
    rng = np.random.default_rng(seed)
    n, sizes = len(y), np.diff(starts)
    p = np.clip(y.mean() if n else 0.5, 0.01, 0.99)
    bias, seen = float(np.log(p / (1 - p))), 1.0
    z, squared, w = np.zeros(width), np.zeros(width), np.zeros(width)
    penalty = np.full(width, l1 * n**0.5)
    penalty[width - free :] = 0
    v = rng.normal(0, 0.3 / max(1.0, sizes.mean() if n else 1.0) ** 0.5, (width, factors))
    alive, spread = np.ones(width, bool), np.ones(width)
    for epoch in range(epochs + settle):
        if epoch == epochs:  # the inputs that are left go on without a penalty on weights
            kept = (w != 0) | (alive & (epochs > warm))
            alive &= kept
            stays = kept[inputs]
            starts, inputs = np.concatenate([[0], np.cumsum(stays)])[starts], inputs[stays]
            sizes = np.diff(starts)
            z, penalty = -w * (1 + np.sqrt(squared)) / rate, np.zeros(width)
        for block in np.array_split(rng.permutation(n), max(1, n // 128)):
            size = sizes[block]
            ends = np.cumsum(size)
            used, at = np.unique(inputs[np.repeat(starts[block] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)], return_inverse=True)
            row = np.repeat(np.arange(len(block)), size)
            margin = bias + np.bincount(row, w[used][at], len(block))
            paired = warm <= epoch and epochs > warm
            if paired:
                place = np.cumsum(alive[used]) - 1
                held = alive[used][at]
                prow, pat, pused = row[held], place[at[held]], used[alive[used]]
                vu = v[pused]
                pairs, sums_of = _margins(prow, pat, len(block), 0.0, np.zeros(len(pused)), vu)
                margin += pairs
            err = _chance(margin) - y[block]
            slope = np.bincount(at, err[row], len(used))
            old, squared[used] = squared[used], squared[used] + slope**2
            root = np.sqrt(squared[used])
            z[used] += slope - (root - np.sqrt(old)) / rate * w[used]
            over = np.maximum(np.abs(z[used]) - penalty[used] * (epoch + 1), 0) * np.sign(z[used])
            w[used] = -over * rate / (1 + root)
            if paired and len(pused):
                pull = err[:, None] * sums_of
                steep = np.stack([np.bincount(pat, column[prow], len(pused)) for column in pull.T], axis=1)
                steep -= np.bincount(pat, err[prow], len(pused))[:, None] * vu
                spread[pused] += (steep**2).mean(axis=1)
                step = 0.1 / np.sqrt(spread[pused])[:, None]
                vu = vu - step * steep
                length = np.sqrt((vu**2).sum(axis=1, keepdims=True))
                held_by = np.where(w[pused] != 0, 0.0, group)[:, None]
                vu *= np.maximum(0, 1 - step * held_by / np.maximum(length, 1e-12))
                v[pused], alive[pused] = vu, vu.any(axis=1)
            total = float(err.sum())
            seen += total * total
            bias -= 0.1 * total / seen**0.5
    return bias, w, v * (epochs > warm)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    statistics: bool,
    metadata: tuple[str, ...] = (),
    max_rows: int = MAX_ROWS,
    factors: int = 8,
    warm: int = 5,
    epochs: int = 12,
    settle: int = 15,
    rate: float = 1.0,
    l1: float = 0.1,
    group: float = 1.3,
    seed: int = 7,
) -> Model:
    """Learn ``labels.label`` (0 or 1) from the texts of ``docs``, and from its numeric columns ``metadata``.

    At most ``max_rows`` labelled documents are learned from, the first by a hash of ``doc_id``; all their hashed terms are
    inputs (``BUCKETS`` at most), and one task descends on them, so its memory is bounded too. A document with several labels
    takes their rounded mean, one with several texts the smallest text. Null labels and ids teach nothing, a null text counts
    as empty, null metadata has a bin of its own. Without both labels the score is the share of label 1, held within 0.01 and
    0.99 (one half without any label).
    """
    small_batches(docs.sparkSession)
    sample = stage(_sample(docs, labels, label, max_rows, statistics, metadata))
    width = (len(STRUCTURE) if statistics else 0) + len(metadata)

    def fit(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("doc_id").combine_chunks()
        n = table.num_rows
        lists = table.column("terms").chunk(0)
        buckets = lists.flatten().to_numpy(zero_copy_only=False)
        stats = np.array(table.column("stats").to_pylist(), dtype=np.float64).reshape(n, width)
        terms = np.flatnonzero(np.bincount(buckets, minlength=BUCKETS))
        known = [column[~np.isnan(column)] for column in stats.T]
        edges = np.array([np.quantile(c if len(c) else [0.0], np.arange(1, BINS) / BINS) for c in known]).reshape(width, BINS - 1)
        place = np.zeros(BUCKETS, dtype=np.int32)
        place[terms] = np.arange(len(terms))
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        free = width * (BINS + 1)
        starts, inputs = _training(lengths, place[buckets], binned(stats, edges), len(terms))
        bias, w, v = _fit(starts, inputs, table.column("y").to_numpy().astype(np.float64), len(terms) + free, free, factors, warm, epochs, settle, rate, l1, group, seed)
        keep = (w != 0) | v.any(axis=1)
        keep[len(terms) :] = True
        flat = [terms[keep[: len(terms)]].astype(np.int64), edges.astype(np.float64), np.float64(bias), w[keep], v[keep]]
        return pa.table({"part": pa.array([x.tobytes() for x in flat], pa.binary()), "k": pa.array(range(5), pa.int32())})

    # The kept weights: at most BUCKETS + bins rows of factors + 1 doubles, whatever the data.
    found = sample.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(lambda t: fit(t.drop_columns(["one"])), "part binary, k int").collect()
    found.sort(key=lambda r: r[1])  # five rows; sorting them in Spark would sample them first, and so fit twice
    unstage(sample)
    if not found:
        return Model(np.zeros(0, np.int64), np.zeros((width, BINS - 1)), 0.0, np.zeros(width * (BINS + 1)), np.zeros((width * (BINS + 1), factors)), metadata)
    parts = [np.frombuffer(bytes(r[0]), np.int64 if r[1] == 0 else np.float64) for r in found]
    return Model(parts[0], parts[1].reshape(width, BINS - 1), float(parts[2][0]), parts[3], parts[4].reshape(-1, factors), metadata)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without other columns than ``doc_id``, with ``score``: the probability of label 1 of every whole text.

    A null text counts as empty, metadata that ``docs`` lacks as null; every row gets a score, and equal texts with equal
    metadata get the same one, whatever rows come with them. Empty tables give no rows.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most BUCKETS + bins inputs, whatever the data
    statistics = len(model.edges) > len(model.metadata)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        place = np.full(BUCKETS, -1, dtype=np.int32)
        place[m.terms] = np.arange(len(m.terms))
        for b in pieces(batches, limit=2 << 20):
            rows, buckets = term_buckets(b.column("text"))
            at = place[buckets].astype(np.int64)
            span = max(1, len(m.terms))
            entries = distinct((rows * span + at)[at >= 0])
            bins = binned(_values(b, statistics, len(m.metadata)), m.edges)
            found = predict(m, *_sparse(entries // span, entries % span, bins, len(m.terms)), b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _with_metadata(docs, model.metadata).mapInArrow(run, f"doc_id {kind}, score double")
