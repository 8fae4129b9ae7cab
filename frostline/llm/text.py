"""Arrow and numpy helpers for batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Spark send Python few rows at a time: texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def fold(key: Column | str, folds: int) -> Column:
    """Remainder of the CRC-32 of a key's text; a null key has fold 0."""
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that their texts hold about ``limit`` bytes; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = (np.cumsum(size) - size) // limit
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def split_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array]:
    """Row and word of every word ``[^\\x20\\x09-\\x0D]+``, in order; null texts have none."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    words, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)  # texts that begin or end with white space give empty ones
    return pc.filter(rows, full).to_numpy(zero_copy_only=False).astype(np.int64), pc.filter(words, full)


def coded_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of every word in order, and the distinct words by code."""
    rows, words = split_words(texts, lower)
    coded = words.dictionary_encode()
    return rows, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of the texts in one array, and the offsets of the texts in it (one more than texts)."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    data = texts.buffers()[2]
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each stretch ``offsets[i]:offsets[i + 1]``; empty stretches sum to 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; by sorting, which is faster here than hashing."""
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered
