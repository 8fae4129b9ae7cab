"""Quality rules: robust multivariate outliers per language and source by minimum covariance determinant.

Every text gives a vector of transformed statistics. For each (language, source) the half of the rows with the smallest
Mahalanobis distance is sought by concentration steps over all rows: a step is one aggregate of counts, sums and
products per group, and the distance that holds half of the rows is read off a histogram of fixed bins. Only numbers
per group move, so a group with a third of all rows is summed like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.llm.text import coded_words, distinct, pieces, small_batches, sums, utf8
from frostline.session import stage

SYMBOLS = b"#*$%&|<>"
#: Statistics that are judged, and the standard deviation below which a group's spread is not taken.
FLOORS = {"word_length": 0.06, "symbols": 0.05, "dup_lines": 0.08, "repeats": 0.15, "variety": 0.03, "upper": 0.06, "marks": 0.06}
STEPS = 4
CUTOFF = 60.0  # squared distance; far beyond the chi-square quantile 0.9999 of 7 (29.9), as clean statistics have long tails
LEAST_ROWS = 50  # smaller groups of a language are judged together
CHI2_MEDIAN = 6.3458  # of 7 degrees of freedom
BINS_PER_OCTAVE = 16


def _repeat_words(rows: np.ndarray, codes: np.ndarray, vocabulary: int, texts: int) -> np.ndarray:
    """Per text: words that lie in a 3-word window found twice or more in it."""
    out = np.zeros(texts, dtype=np.int64)
    if len(rows) < 3:
        return out
    inside = rows[2:] == rows[:-2]
    at, (a, b, c) = np.flatnonzero(inside), (codes[:-2][inside], codes[1:-1][inside], codes[2:][inside])
    if not len(at):
        return out
    bits = max(1, int(vocabulary - 1).bit_length())
    if 3 * bits + int(texts).bit_length() <= 62:
        key = (((rows[at] << bits | a) << bits) | b) << bits | c
    else:  # number the pairs first
        pair = np.unique(a << bits | b, return_inverse=True)[1]
        key = np.unique(pair.astype(np.int64) << bits | c, return_inverse=True)[1].astype(np.int64) * texts + rows[at]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marked = np.zeros(len(rows) + 2, dtype=bool)
    first = at[twice]
    marked[first] = marked[first + 1] = marked[first + 2] = True
    return np.bincount(rows[marked[: len(rows)]], minlength=texts)


def _lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    if not text:
        return 0, 0
    lines = [x for x in text.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    return len(lines), len(lines) - len(set(lines))


def statistics_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts and transformed statistics of each text; null counts as empty."""
    n = len(texts)
    rows, codes, words = coded_words(texts, lower=False)
    data, offsets = utf8(texts)
    count = lambda table: sums(table[data].astype(np.int64), offsets)
    table = np.zeros(256, dtype=bool)

    def among(values: bytes) -> np.ndarray:
        t = table.copy()
        t[list(values)] = True
        return count(t)

    n_words = np.bincount(rows, minlength=n)
    points = count(np.arange(256) & 0xC0 != 0x80)
    white = among(bytes([0x20, *range(9, 14)]))
    symbols = among(SYMBOLS)
    upper, lower = among(bytes(range(65, 91))), among(bytes(range(97, 123)))
    marks = among(b"!?.,;:-_=+~^/\\@'\"()[]{}")
    lines = np.array([_lines(t) for t in texts.to_pylist()], dtype=np.int64).reshape(-1, 2)
    repeats = _repeat_words(rows, codes, len(words), n)
    pairs = distinct(rows * max(1, len(words)) + codes) // max(1, len(words))
    different = np.bincount(pairs, minlength=n)
    w = np.maximum(n_words, 1)
    out = {"n_words": n_words, "word_chars": points - white, "n_symbols": symbols, "n_dup_lines": lines[:, 1], "n_repeat_words": repeats}
    out |= {
        "word_length": np.log1p((points - white) / w),
        "symbols": np.log1p(4 * symbols / w),
        "dup_lines": lines[:, 1] / np.maximum(lines[:, 0], 1),
        "repeats": np.sqrt(repeats / w),
        "variety": np.log1p(different) / np.log1p(w),
        "upper": np.sqrt(upper / np.maximum(upper + lower, 1)),
        "marks": np.log1p(marks / w),
    }
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
NAMES = list(FLOORS)
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the group ``grp`` (language and source), the counts (long) and the statistics (double) of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            found = statistics_of(b.column("text"))
            values = [pa.array(found[k].astype(np.int64)) for k in COUNTS] + [pa.array(found[k].astype(np.float64)) for k in FLOORS]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *values], ["doc_id", "grp", *COUNTS, *FLOORS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, grp string, " + ", ".join([f"{k} long" for k in COUNTS] + [f"{k} double" for k in FLOORS])
    grp = F.to_json(F.struct(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")))
    return docs.select("doc_id", grp.alias("grp"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _cells(rows: DataFrame, least: int) -> DataFrame:
    """``grp, cell``: the group itself, or the pool of its language's small groups, or the pool of all small pools."""
    sizes = stage(rows.groupBy("grp").agg(F.count("*").alias("n")))
    lang = F.coalesce(F.get_json_object("grp", "$.lang"), F.lit(""))
    small = sizes.where(F.col("n") < least).select("grp", "n", F.concat(F.lit("small groups of "), lang).alias("pool"))
    pools = small.groupBy("pool").agg(F.sum("n").alias("total"))
    pooled = small.join(pools, "pool").select("grp", F.when(F.col("total") >= least, F.col("pool")).otherwise("small pools").alias("cell"))
    return sizes.where(F.col("n") >= least).select("grp", F.col("grp").alias("cell")).unionByName(pooled)


def _distance(scale: bool = False) -> Column:
    """Squared distance of a row to its cell's ``mu`` under the factor ``w`` of the inverse covariance."""
    p = len(NAMES)
    gap = [F.col(x) - F.col("mu")[i] for i, x in enumerate(NAMES)]
    total = F.lit(0.0)
    for i in range(p):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col("w")[i * p + j] * gap[j]
        total = total + part * part
    return total * F.col("scale") if scale else total


def _halves(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Of every cell: ``edge``, the bin up to which half of its rows lie, and the sums of those rows.

    Sums are taken per cell and bin of distance, so a step passes over the rows once.
    """
    placed = rows.join(model, "grp").withColumn("bin", F.ceil(F.log2(_distance() + F.lit(1e-6)) * BINS_PER_OCTAVE))
    values = [F.count("*").alias("n"), *[F.sum(x).alias(f"m{i}") for i, x in enumerate(NAMES)]]
    values += [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"p{i}_{j}") for i, j in PAIRS]
    bins = placed.groupBy("cell", "bin").agg(*values)
    cell = Window.partitionBy("cell")  # a cell has some hundred bins
    bins = bins.withColumn("upto", F.sum("n").over(cell.orderBy("bin"))).withColumn("all", F.sum("n").over(cell))
    kept = bins.where((F.col("upto") - F.col("n")) * 2 < F.col("all"))
    names = ["n", *[f"m{i}" for i in range(len(NAMES))], *[f"p{i}_{j}" for i, j in PAIRS]]
    return kept.groupBy("cell").agg(F.max("bin").alias("edge"), *[F.sum(x).alias(x) for x in names])


def _shape(halves: DataFrame) -> DataFrame:
    """``cell, mu, w`` from sums; the spread of every statistic gets its floor."""
    p, floor = len(NAMES), np.square(list(FLOORS.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mus, ws = [], []
            for r in b.to_pylist():
                mu = np.array([r[f"m{i}"] for i in range(p)]) / r["n"]
                s = np.zeros((p, p))
                for i, j in PAIRS:
                    s[i, j] = s[j, i] = r[f"p{i}_{j}"] / r["n"] - mu[i] * mu[j]
                s[np.diag_indices(p)] = np.maximum(np.diag(s), 0) + floor
                mus.append(mu.tolist())
                ws.append(np.linalg.inv(np.linalg.cholesky(s)).ravel().tolist())
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("cell"), pa.array(mus, kind), pa.array(ws, kind)], ["cell", "mu", "w"])

    return halves.mapInArrow(run, "cell string, mu array<double>, w array<double>")


def estimates(rows: DataFrame, steps: int = STEPS, least: int = LEAST_ROWS) -> DataFrame:
    """``grp, cell, mu, w, scale`` of every group: the minimum-covariance-determinant estimate of its cell.

    It starts at the medians with the floors as spread; ``steps`` concentration steps follow. ``scale`` makes half of
    the squared distances lie below the chi-square median, but never stretches a spread that stands at its floor.
    """
    cells = stage(_cells(rows, least))
    medians = [F.percentile_approx(x, 0.5, 1000).alias(f"c{i}") for i, x in enumerate(NAMES)]
    unit = F.array(*[F.lit(1.0 / v if i == j else 0.0) for i, v in enumerate(FLOORS.values()) for j in range(len(NAMES))])
    start = rows.join(cells, "grp").groupBy("cell").agg(*medians)
    model = stage(cells.join(start.select("cell", F.array(*[f"c{i}" for i in range(len(NAMES))]).alias("mu"), unit.alias("w")), "cell"))
    for _ in range(steps):
        model = stage(cells.join(_shape(_halves(rows, model)), "cell"))
    edge = F.pow(F.lit(2.0), F.col("edge") / BINS_PER_OCTAVE)
    scale = _halves(rows, model).select("cell", F.least(F.lit(1.0), F.lit(CHI2_MEDIAN) / edge).alias("scale"))
    return stage(model.join(scale, "cell"))


def judge(docs: DataFrame, steps: int = STEPS, cutoff: float = CUTOFF, least: int = LEAST_ROWS) -> DataFrame:
    """``doc_id``, counts, ``base_failed``, ``distance`` and ``kept`` of every row of ``docs(doc_id, text, lang, source)``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; a null text has none. A row fails the base rule with under 50
    words, or if over half of its words lie in repeated 3-word windows. Estimates are made from the rows that pass it;
    such a row is kept if its squared Mahalanobis distance is ``cutoff`` at most. Null languages and sources are groups
    of their own; repeated rows each count and each get a row; equal vectors all fit. Empty in, empty out.
    """
    rows = stage(with_statistics(docs))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    model = estimates(rows.where("not base_failed").select("grp", *NAMES), steps, least)
    judged = rows.join(model, "grp", "left").withColumn("distance", _distance(scale=True))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select("doc_id", *COUNTS, "base_failed", "distance", kept.alias("kept"))
