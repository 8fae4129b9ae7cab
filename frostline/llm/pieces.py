"""Sampled segmentations over a SentencePiece vocabulary by forward filtering and backward sampling.

All ways to cut a text into pieces form a lattice. Forward sums give each place the weight of everything before it; a
segmentation is then drawn from the end, a piece at a time, in proportion to its share. Draws come from a hash of the
row's key and the place, so a row always gets the same segmentation. Characters without a piece are spelt in byte pieces,
so decoding gives the text back.

No piece spans the start of a word, so the lattice is built once for each distinct word of a batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.text import pieces as cut_batches
from frostline.llm.text import small_batches, utf8

SPACE = 0x2581  # the sign that stands for a space in the vocabulary
NO_CHARACTER = 0x1FFFFF


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of each number."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``begin[i] .. begin[i] + size[i] - 1`` of all i, one after the other."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


class Lattice:
    """Segmenter of a SentencePiece model. The weight of a piece is ``(2 + rank) ** -power`` by its rank in the model."""

    def __init__(self, model_path: str, power: float = 1.0):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        n = model.vocab_size()
        self.byte_ids = np.full(256, -1, dtype=np.int64)
        texts: list[bytes] = []
        trie: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                texts.append(bytes([int(piece[3:5], 16)]))
                continue
            texts.append(piece.replace(chr(SPACE), " ").encode())
            inner = piece.lstrip(chr(SPACE))
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or chr(SPACE) in inner:
                continue
            node = 0
            for c in piece:
                node = trie.setdefault((node, ord(c)), len(trie) + 1)
                if node == len(ends):
                    ends.append(-1)
            ends[node] = i
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary lacks byte pieces")
        keys = np.array([(a << 21) | c for a, c in trie], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], np.array(list(trie.values()), dtype=np.int64)[order]
        self.ends = np.array(ends, dtype=np.int64)
        self.root = np.zeros(NO_CHARACTER + 1, dtype=np.int32)  # child of the root by character, 0 for none
        of_root = self.keys < 1 << 21
        self.root[self.keys[of_root]] = self.child[of_root]
        rank = np.array([max(0.0, -model.get_score(i)) for i in range(n)])
        rank[self.byte_ids] = n
        self.weight = -power * np.log(2.0 + rank)
        self.bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.bytes_size = np.array([len(t) for t in texts], dtype=np.int64)
        self.bytes_begin = np.cumsum(self.bytes_size) - self.bytes_size

    def _edges(self, chars: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces that fit: first character, length, id (-1: byte pieces of one character). ``last`` ends each one's word."""
        starts, sizes, ids = [], [], []
        at, node, size = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        single = np.zeros(len(chars), dtype=bool)
        while len(at):
            if size:
                key = node << 21 | chars[at + size]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                ok = self.keys[place] == key
                at, node = at[ok], self.child[place[ok]]
            else:
                node = self.root[chars].astype(np.int64)
                at, node = np.flatnonzero(node), node[node > 0]
            size += 1
            piece = self.ends[node]
            full = piece >= 0
            starts.append(at[full])
            sizes.append(np.full(full.sum(), size))
            ids.append(piece[full])
            if size == 1:
                single[at[full]] = True
            more = at + size < last[at]
            at, node = at[more], node[more]
        spelt = np.flatnonzero(~single)
        return np.concatenate([*starts, spelt]), np.concatenate([*sizes, np.ones(len(spelt), np.int64)]), np.concatenate([*ids, np.full(len(spelt), -1)])

    def __call__(self, texts: pa.Array, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sampled segmentation of all texts, and how many each has; ``keys`` seed the draws of each row."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        led = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(" "), texts, ""))
        data, offsets = utf8(led)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        first = data == 0x20
        first[1:] &= data[:-1] != 0x20
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        begin = np.flatnonzero(first)
        bounds = np.append(begin, len(data)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(begin), pa.py_buffer(bounds.tobytes()), pa.py_buffer(data.tobytes())).dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary
        row = np.searchsorted(offsets, begin, side="right") - 1
        length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        whole = "".join(words.to_numpy(zero_copy_only=False).tolist())
        original = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        chars = np.where(original == SPACE, NO_CHARACTER, np.where(original == 0x20, SPACE, original))
        word_end = np.cumsum(length)
        word_of = np.repeat(np.arange(len(words)), length)
        start, size, piece = self._edges(chars, word_end[word_of])
        # The places between characters: word w has length[w] + 1 of them, from base[w].
        base = word_end - length + np.arange(len(words))
        source = start + word_of[start]
        target = source + size
        spelt = piece < 0
        width = 1 + (original >= 0x80) + (original >= 0x800) + (original >= 0x10000)
        weight = np.where(spelt, width[start] * self.weight[self.byte_ids[0]], self.weight[piece])
        offset = target - base[word_of[start]]
        by = np.argsort(target * 64 + 63 - np.minimum(size, 63))  # the longest piece to a place first
        source, target, weight, offset, start, piece = (x[by] for x in (source, target, weight, offset, start, piece))
        alpha = np.full(len(chars) + len(words), -np.inf)
        alpha[base] = 0.0
        small = offset.astype(np.uint16) if offset.max() < 1 << 16 else offset
        by_level = np.argsort(small, kind="stable")
        levels = np.searchsorted(offset[by_level], np.arange(1, offset.max() + 2))
        for a, b in zip(levels[:-1], levels[1:], strict=True):
            level = by_level[a:b]
            value, to = alpha[source[level]] + weight[level], target[level]
            groups = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            top = np.maximum.reduceat(value, groups)
            counts = np.diff(np.append(groups, b - a))
            alpha[to[groups]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, counts)), groups))
        share = np.exp(alpha[source] + weight - alpha[target])
        groups = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        run = np.cumsum(share)
        run -= np.repeat(run[groups] - share[groups], np.diff(np.append(groups, len(target))))
        run[np.append(groups[1:], len(target)) - 1] = 2.0  # whatever is drawn, the last piece to a place ends the search
        first_edge = np.zeros(len(alpha), dtype=np.int64)
        first_edge[target[groups]] = groups
        # Backward sampling of all words of the batch at once.
        index = np.arange(len(which)) - np.searchsorted(row, row)
        seeds = _mixed(keys[row].view(np.uint64) ^ _mixed(index.astype(np.uint64)))
        live, place, floor = np.arange(len(which)), (base + length)[which], base[which]
        picked, owner, step = [], [], 0
        while len(live):
            draw = (_mixed(seeds[live] + np.uint64(step)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = first_edge[place]
            on = np.flatnonzero(run[edge] < draw)
            while len(on):
                edge[on] += 1
                on = on[run[edge[on]] < draw[on]]
            picked.append(edge)
            owner.append(live)
            place = source[edge]
            on = place > floor
            live, place, floor, step = live[on], place[on], floor[on], step + 1
        counts = np.zeros(len(which), dtype=np.int64)
        for o in owner:
            counts[o] += 1
        stop = np.cumsum(counts)
        edges = np.empty(stop[-1], dtype=np.int64)
        for k, (o, e) in enumerate(zip(owner, picked, strict=True)):
            edges[stop[o] - 1 - k] = e
        ids, spelling = piece[edges], np.flatnonzero(piece[edges] < 0)
        each = np.ones(len(ids), dtype=np.int64)
        each[spelling] = width[start[edges[spelling]]]
        out = np.repeat(ids, each)
        if len(spelling):
            letters = "".join(map(chr, original[start[edges[spelling]]])).encode()
            out[_spread((np.cumsum(each) - each)[spelling], each[spelling])] = self.byte_ids[np.frombuffer(letters, np.uint8)]
        total = np.concatenate([[0], np.cumsum(each)])
        per_word = total[stop] - total[stop - counts]
        return out, np.bincount(row, weights=per_word, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts, and how many each has; the space that leads a text is taken off again."""
        size = self.bytes_size[ids]
        data = self.bytes[_spread(self.bytes_begin[ids], size)]
        total = np.concatenate([[0], np.cumsum(size)])
        stop = np.cumsum(counts)
        length = total[stop] - total[stop - counts]
        keep = np.ones(len(data), dtype=bool)
        keep[(np.cumsum(length) - length)[length > 0]] = False
        return data[keep], length - (length > 0)


@lru_cache(maxsize=2)
def lattice(model_path: str, power: float) -> Lattice:
    """The segmenter of a model, kept in the worker."""
    return Lattice(model_path, power)


def sample(docs: DataFrame, model_path: str, power: float = 1.0, seed: int = 0, batch_bytes: int = 4 << 20) -> DataFrame:
    """``doc_id, ids``: a sampled segmentation of every text, the same in every run.

    Draws are seeded by ``doc_id`` (as text; null is a key like another) and ``seed``, so repeated rows get equal ids. A null
    or empty text has none. The model file must be readable on every executor.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cut_batches(batches, limit=batch_bytes):
            ids, counts = lattice(model_path, power)(b.column("text"), b.column("key").to_numpy())
            cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _keyed(docs, seed).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(rows: DataFrame, model_path: str, power: float = 1.0) -> DataFrame:
    """``doc_id, text`` of ``rows(doc_id, ids)``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = pc.fill_null(b.column("ids"), pa.scalar([], b.column("ids").type))
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            data, size = lattice(model_path, power).decode(pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64), counts)
            cuts = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            text = pa.StringArray.from_buffers(b.num_rows, pa.py_buffer(cuts.tobytes()), pa.py_buffer(data.tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), text], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, f"doc_id {kind}, text string")


def digest(docs: DataFrame, model_path: str, power: float = 1.0, seed: int = 0, batch_bytes: int = 4 << 20) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32`` (of unsigned little-endian 32-bit ids) and ``lossless``: decoding gives the text back."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cut_batches(batches, limit=batch_bytes):
            model = lattice(model_path, power)
            ids, counts = model(b.column("text"), b.column("key").to_numpy())
            stop = np.cumsum(counts)
            packed = ids.astype("<u4")
            crc = [zlib.crc32(packed[e - n : e]) for e, n in zip(stop.tolist(), counts.tolist(), strict=True)]
            data, size = model.decode(ids, counts)
            given, offsets = utf8(b.column("text"))
            back = data.tobytes()
            wanted = given.tobytes()
            at = np.concatenate([[0], np.cumsum(size)])
            same = [back[p:q] == wanted[x:y] for p, q, x, y in zip(at[:-1], at[1:], offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts), pa.array(crc, pa.int64()), pa.array(same)], ["doc_id", "n_pieces", "ids_crc32", "lossless"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _keyed(docs, seed).mapInArrow(run, f"doc_id {kind}, n_pieces long, ids_crc32 long, lossless boolean")


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("\0null"))).alias("key")
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), key)
