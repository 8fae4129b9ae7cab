"""Best-fit packing of tokenised documents, improved by swap-based local search.

Texts are encoded once and cut into pieces of a sequence at most; only lengths and checksums go on. Pieces are dealt by
a hash into groups of a set number of tokens, so the quality doesn't depend on how the input is split, and each group is
packed by itself: best fit from the longest piece on, then exchanges between sequences with room left. An exchange moves
a piece, swaps one for one or two for one, always so that the fuller sequence gets fuller: the sum of squared fills
grows until sequences empty. The search ends when no fewer sequences can hold the tokens.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.text import pieces, small_batches, utf8
from frostline.session import stage

GROUP_TOKENS = 1 << 24  # that are packed together


def _kinds() -> np.ndarray:
    """Kind of each byte: white space, letter, digit or other; lead and second bytes of the letters À to ÿ are letters."""
    kind = np.full(256, OTHER, dtype=np.uint8)
    kind[[0x20, *range(9, 14)]] = SPACE
    kind[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = LETTER
    kind[48:58] = DIGIT
    return kind


SPACE, LETTER, DIGIT, OTHER, WHOLE = range(5)
KINDS = _kinds()


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it is printable, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space and lowers case: each distinct part is encoded once.

    Chunks between white space of printable ASCII and the letters À to ÿ are split here into words, digits and the rest,
    as the tokenizer does. Chunks with an apostrophe, with what could be a special token or with other letters are left
    whole to the tokenizer. ``known`` parts are remembered, and forgotten when they get too many.
    """

    def __init__(self, path: str, known: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), known
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.begin, self.size = (np.zeros(0, t) for t in (np.uint32, np.int64, np.int64))

    def _encoded(self, part: str) -> list[int]:
        if not part.strip(" \t\n\v\f\r"):
            return []
        if part.isascii():
            if part.isprintable() and "'" not in part and "<|" not in part:
                return [t.id for t in self.model.tokenize(part)]
        elif part.isalpha() and part.islower() and all(c.isascii() or "ß" <= c <= "ÿ" for c in part):
            return [t.id for t in self.model.tokenize("".join([self.letters[x] for x in part.encode()]))]
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def _learn(self, parts: list[str]) -> None:
        own = [self._encoded(x) for x in parts]
        n = np.array([len(x) for x in own], dtype=np.int64)
        self.place.update(zip(parts, range(len(self.place), len(self.place) + len(parts)), strict=True))
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(n) - n])
        self.size = np.concatenate([self.size, n])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(own), np.uint32, int(n.sum()))])

    @staticmethod
    def _parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts with plain chunks in lower case, and where their parts begin; runs of white space are parts too."""
        kind = KINDS[data]
        before, after = np.concatenate([[0], data[:-1]]), np.concatenate([data[1:], [0]])
        second = (before == 0xC3) & (data >= 0x80) & (data <= 0xBF)
        lead = (data == 0xC3) & (after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)
        letter = second & (data != 0x97) & (data != 0xB7)
        strange = (data >= 0x80) & ~lead & ~letter | (data < 0x20) & (kind != SPACE) | (data == 0x7F) | (data == 0x27) | (data == 0x3C) & (after == 0x7C)
        inside = kind != SPACE
        text = np.zeros(len(data), dtype=bool)
        text[offsets[:-1][np.diff(offsets) > 0]] = True
        chunk = np.cumsum(inside & (np.concatenate([[True], ~inside[:-1]]) | text))
        whole = np.zeros(int(chunk[-1]) + 1, dtype=bool)
        whole[chunk[strange]] = True
        whole = whole[chunk] & inside
        upper = ((data >= 65) & (data <= 90) | letter & (data <= 0x9E)) & ~whole
        kind[whole] = WHOLE
        first = text | (kind == DIGIT)
        first[1:] |= kind[1:] != kind[:-1]
        return data + upper.astype(np.uint8) * np.uint8(32), np.flatnonzero(first)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the number of each text's; null texts have none."""
        data, offsets = utf8(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        low, starts = self._parts(data, offsets)
        bounds = np.append(starts, len(data)).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds.tobytes()), pa.py_buffer(low.tobytes()))
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.place) + len(distinct) > self.most:
            self._forget()
        if new := [c for c in distinct if c not in self.place]:
            self._learn(new)
        known = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))
        which = known[coded.indices.to_numpy(zero_copy_only=False)]
        size = self.size[which]
        flat = self.ids[np.repeat(self.begin[which] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        total = np.concatenate([[0], np.cumsum(size)])
        return flat, np.diff(total[np.searchsorted(starts, offsets)])


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary, kept in the worker."""
    return WordEncoder(path)


class Bin:
    """A sequence: its pieces by their size, and how many tokens it holds."""

    def __init__(self) -> None:
        self.items: dict[int, list[int]] = {}
        self.fill = 0

    def add(self, size: int, item: int) -> None:
        self.items.setdefault(size, []).append(item)
        self.fill += size

    def take(self, size: int) -> int:
        held = self.items[size]
        item = held.pop()
        if not held:
            del self.items[size]
        self.fill -= size
        return item

    def pairs(self) -> list[tuple[int, int]]:
        """Sizes of any two pieces; a sequence has few distinct sizes, as they add up to its fill."""
        sizes = sorted(self.items)
        return [(x, y) for k, x in enumerate(sizes) for y in sizes[k:] if x != y or len(self.items[x]) > 1]


def best_fit(sizes: np.ndarray, limit: int) -> list[Bin]:
    """Longest piece first, each into the fullest sequence that has room for it."""
    bins: list[Bin] = []
    by_room: list[list[Bin]] = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r: some sequence has room r
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            chosen = Bin()
            bins.append(chosen)
        chosen.add(size, item)
        if room := limit - chosen.fill:
            by_room[room].append(chosen)
            rooms |= 1 << room
    return bins


def exchange(full: Bin, poor: Bin, room: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
    """The sizes to give from ``full`` and from ``poor`` so that ``full`` gains most, ``room`` at most; None if nothing does.

    Ties go to the plainer exchange: a move, one for one, two for one.
    """
    best, found = 0, None
    b = np.array(sorted(poor.items))
    if (k := int(np.searchsorted(b, room, side="right"))) and b[k - 1] > best:
        best, found = int(b[k - 1]), ((), (int(b[k - 1]),))
    a = np.array(sorted(full.items))

    def better(gives: np.ndarray, gets: np.ndarray, name) -> None:
        nonlocal best, found
        if best == room or not len(gives) or not len(gets):
            return
        at = np.searchsorted(gets, gives + room, side="right") - 1  # the most that may come for each
        gain = np.where(at >= 0, gets[at] - gives, 0)
        k = int(gain.argmax())
        if gain[k] > best:
            best, found = int(gain[k]), name(k, int(at[k]))

    better(a, b, lambda i, j: ((int(a[i]),), (int(b[j]),)))
    if best < room:
        two = sorted(poor.pairs(), key=sum)
        better(a, np.array([x + y for x, y in two]), lambda i, j: ((int(a[i]),), two[j]))
    if best < room:
        pair = sorted(full.pairs(), key=sum)
        better(np.array([x + y for x, y in pair]), b, lambda i, j: (pair[i], (int(b[j]),)))
    return found


def local_search(bins: list[Bin], limit: int, partners: int = 64, rounds: int = 256) -> list[Bin]:
    """Exchange pieces between sequences with room until none can be emptied.

    The emptiest sequence gives, the fullest with room take; one that can give nothing waits until others have changed.
    ``partners`` and ``rounds`` bound the effort: how many sequences one that gives is tried with, and how often one gives.
    """
    least = -(-sum(b.fill for b in bins) // limit)
    open_, done = [b for b in bins if b.fill < limit], [b for b in bins if b.fill == limit]
    failed: set[int] = set()
    for _ in range(rounds):
        if len(open_) + len(done) <= least:
            break
        open_.sort(key=lambda b: b.fill)
        poor = next((b for b in open_ if id(b) not in failed), None)
        if poor is None:
            break
        changed = False
        for full in reversed(open_[-partners:]):
            while full is not poor and poor.fill and full.fill >= poor.fill and full.fill < limit:
                found = exchange(full, poor, limit - full.fill)
                if not found:
                    break
                out, into = [(s, full.take(s)) for s in found[0]], [(s, poor.take(s)) for s in found[1]]
                for s, item in out:
                    poor.add(s, item)
                for s, item in into:
                    full.add(s, item)
                changed = True
        if changed:
            failed.clear()
        failed.add(id(poor))
        done += [b for b in open_ if b.fill == limit]
        open_ = [b for b in open_ if 0 < b.fill < limit]
    return done + open_


def place(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece."""
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for k, b in enumerate(local_search(best_fit(sizes, limit), limit)):
        at = 0
        for size, items in b.items.items():
            for item in items:
                sequence[item], offset[item] = k, at
                at += size
    return sequence, offset


def cut(docs: DataFrame, encode: Callable, end_id: int, limit: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, row``: the pieces of all documents, ``row`` being unique to each."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.shiftleft(F.spark_partition_id().cast("long"), 36).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for b in pieces(batches):
            ids, counts = encode(b.column("text"))
            ids = np.insert(ids.astype("<u4"), np.cumsum(counts), end_id)
            counts = counts + 1
            parts = -(-counts // limit)
            doc = np.repeat(np.arange(len(counts)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * limit
            length = np.minimum(limit, counts[doc] - start)
            at = (np.cumsum(counts) - counts)[doc] + start
            crc = np.array([zlib.crc32(ids[x : x + n]) for x, n in zip(at.tolist(), length.tolist(), strict=True)], np.int64)
            row = b.column("base")[0].as_py() + made + np.arange(len(doc))
            made += len(doc)
            columns = [b.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), *map(pa.array, (start, length, crc, row))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "row"])

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, row long")


def pack(docs: DataFrame, encode: Callable, end_id: int, limit: int = 4096, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """A row per piece of every document: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``encode`` gives the ids of an array of texts, ``end_id`` follows each document, and documents longer than ``limit`` are
    cut into pieces of ``limit``, the last of which may be shorter. A null text is empty and has the end id alone; a null id
    is kept; repeated rows are packed each; other columns are ignored. Equal pieces keep the order of their hash. Groups of
    about ``group_tokens`` tokens are packed apart, so their number grows with the corpus and a task's work doesn't; each
    may end with one sequence that is not full. Sequence ids are unique, not dense. Empty in, empty out.
    """
    cuts = stage(cut(docs, encode, end_id, limit))
    total = cuts.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / group_tokens))
    dealt = cuts.repartition(groups, F.xxhash64("row")).withColumn("base", F.shiftleft(F.spark_partition_id().cast("long"), 33))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by("row").combine_chunks()
        sequence, offset = place(table.column("length").to_numpy(), limit)
        base = table.column("base")[0].as_py()
        out = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        out = out.append_column("sequence_id", pa.array(base + sequence)).append_column("offset", pa.array(offset))
        yield from out.to_batches()

    return dealt.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
