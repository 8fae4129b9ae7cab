"""Vector bin packing of tokenised examples into training sequences.

An example takes tokens, one segment and loss-bearing tokens. The open sequence takes the example whose demand has the
largest dot product with what is left in it, until none fits; what room is left then takes cut-off ends. Each task
packs its own rows, a bounded number of tokens at a time, so nothing is shuffled and a lost executor costs its tasks.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.text import pieces, small_batches, utf8

WINDOW = 1 << 20  # tokens that are packed together


def _bytes(values) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table


WHITE = _bytes([0x20, *range(9, 14)])
WIDE = _bytes([0xE1, 0xE2, 0xE3])  # first bytes of three-byte characters some of which are white space
LEADS = WHITE | WIDE | _bytes([0xC2])


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold."""

    tokens: int = 2048
    segments: int = 512
    loss: int = 2048


class Encoder:
    """Byte-level BPE of whole texts by a vocabulary of ranks.

    A space between two characters that are no white space always begins a new pre-token, so a text can be cut there and
    each distinct chunk encoded once. ``known`` chunks are remembered, and forgotten when they get too many. ``special``
    strings in a text are their ids, as the tokenizer of the vocabulary has them.
    """

    def __init__(self, ranks_path: str, pattern: str, known: int = 400_000, special: dict[str, int] | None = None):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.special = dict(special or {})
        self.space_first = np.zeros(max([*ranks.values(), *self.special.values()]) + 1, dtype=bool)
        self.space_first[[i for t, i in ranks.items() if t[:1] == b" "]] = True
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)
        self.most = known
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.begin, self.size = (np.zeros(0, t) for t in (np.uint32, np.int64, np.int64))

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks that are new. Those that are a space and a word are encoded in one go and told apart by the space."""
        plain = [c for c in chunks if c[0] == " " and c.count(" ") == 1 and not c[-1].isspace() and not any(x in c for x in self.special)]
        rest = list(set(chunks).difference(plain))
        ids = self.bpe.encode_to_numpy("".join(plain), disallowed_special=()) if plain else np.zeros(0, np.uint32)
        begin = np.flatnonzero(self.space_first[ids])
        size = np.diff(np.concatenate([begin, [len(ids)]]))
        own = [self.bpe.encode(c, allowed_special="all") for c in rest]
        n = np.array([len(x) for x in own], dtype=np.int64)
        start = len(self.place)
        self.place.update(zip(plain + rest, range(start, start + len(chunks)), strict=True))
        self.begin = np.concatenate([self.begin, len(self.ids) + begin, len(self.ids) + len(ids) + np.cumsum(n) - n])
        self.size = np.concatenate([self.size, size, n])
        self.ids = np.concatenate([self.ids, ids, np.fromiter((i for x in own for i in x), np.uint32, int(n.sum()))])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the number of each text's; null texts have none."""
        data, offsets = utf8(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        safe = np.concatenate([np.full(3, 0x20, np.uint8), data, np.full(1, 0x20, np.uint8)])
        at = np.flatnonzero(data == 0x20)
        last, next_ = safe[at + 2], safe[at + 4]
        cut = ~WHITE[last] & ~LEADS[next_] & ~((safe[at + 1] == 0xC2) & ((last == 0x85) | (last == 0xA0))) & ~WIDE[safe[at]]
        first = np.zeros(len(data), dtype=bool)
        first[at[cut]] = first[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data)).astype(np.int32)
        bounds = np.concatenate([starts[:1].astype(np.int32), ends])
        chunks = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds.tobytes()), pa.py_buffer(data.tobytes()))
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
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


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()) -> Encoder:
    """The encoder of a vocabulary, kept in the worker."""
    return Encoder(ranks_path, pattern, special=dict(special))


def pick(size: np.ndarray, heavy: np.ndarray, limits: Limits) -> list[tuple[list[int], np.ndarray]]:
    """Sequences filled one after the other by the dot-product rule: the examples in each, and the room left in it.

    ``size`` and ``heavy`` are the examples' tokens and loss-bearing tokens. Examples of one demand are a class: a pick looks at
    classes, of which there are few, not at examples.
    """
    if not len(size):
        return []
    room_all = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
    weight = np.array([size.mean(), 1.0, heavy.mean()]) / room_all / room_all
    open_bins: list[tuple[list[int], np.ndarray]] = []
    kinds, which, many = np.unique(np.column_stack([-size, heavy]), axis=0, return_inverse=True, return_counts=True)
    items = np.argsort(which.ravel(), kind="stable")
    at, end = np.cumsum(many) - many, np.cumsum(many)
    each, load = -kinds[:, 0], kinds[:, 1]
    live = np.arange(len(many))
    while len(live):
        room, held = room_all.copy(), []
        while room[1] >= 1:
            fits = (at[live] < end[live]) & (each[live] <= room[0]) & (load[live] <= room[2] + 1e-9)
            can = live[fits]
            if not len(can):
                break
            pull = weight * room
            best = can[int((each[can] * pull[0] + load[can] * pull[2]).argmax())]
            take = 1
            if len(can) == 1:  # nothing else fits, now or later
                take = int(min(end[best] - at[best], room[0] // each[best], room[1]))
                if load[best] > 0:
                    take = max(1, min(take, int((room[2] + 1e-9) // load[best])))
            held += items[at[best] : at[best] + take].tolist()
            at[best] += take
            room = room - take * np.array([each[best], 1.0, load[best]])
        open_bins.append((held, room))
        live = live[at[live] < end[live]]
    return open_bins


def place(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of ``(example, start, length)``; each token of each example lies in exactly one.

    Full sequences are cut off first. Of the rest, the dot-product rule fills one sequence after the other; then the
    emptiest are taken apart to fill the room that is left in the others. ``loss`` is the share of an example's tokens
    that bear loss.
    """
    whole = [min(limits.tokens, int(limits.loss / s) if s > 0 else limits.tokens) for s in loss]
    whole = np.maximum(1, np.array(whole, dtype=np.int64))
    out: list[list[tuple[int, int, int]]] = []
    for i in np.flatnonzero(tokens >= whole):
        out += [[(int(i), int(k * whole[i]), int(whole[i]))] for k in range(tokens[i] // whole[i])]
    start = tokens // whole * whole
    left = np.flatnonzero(tokens > start)
    order = np.argsort(start[left] - tokens[left], kind="stable")
    left = left[order]
    size = (tokens[left] - start[left]).astype(np.float64)
    heavy = size * loss[left]
    need = np.column_stack([size, np.ones(len(left)), heavy])
    open_bins = pick(size, heavy, limits)
    rooms = [r for _, r in open_bins]
    filled = [[(int(left[j]), int(start[left[j]]), int(need[j][0])) for j in held] for held, _ in open_bins]
    giver = sorted(range(len(filled)), key=lambda b: -rooms[b][0])
    taker = sorted(range(len(filled)), key=lambda b: rooms[b][0])
    closed = set()
    for g in giver:
        closed.add(g)
        parts = filled[g]
        while parts:
            item, at, n = parts[-1]
            share = float(loss[item])
            while taker and (taker[0] in closed or rooms[taker[0]][0] < 1 or rooms[taker[0]][1] < 1 or rooms[taker[0]][2] < share):
                taker.pop(0)
            if not taker:
                break
            room = rooms[taker[0]]
            take = int(min(n, room[0], room[2] / share if share > 0 else n))
            filled[taker[0]].append((item, at + n - take, take))
            rooms[taker[0]] = room - np.array([take, 1, take * share])
            parts[-1] = (item, at, n - take)
            if take == n:
                parts.pop()
        if not taker:
            break
    return out + [f for f in filled if f]


SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, segment int"


def pack(docs: DataFrame, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], end_id: int, limits: Limits = Limits(), window: int = WINDOW, keep_ids: bool = False, loss_share: str | None = None) -> DataFrame:
    """A row per piece of every document: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, segment``.

    ``encode`` gives the ids of an array of texts; ``end_id`` follows each document. ``loss_share`` names a column with
    the share of a document's tokens that bear loss (null: all); all do if it is not given. A null text is empty and has
    the end id alone; repeated rows are packed each. With ``keep_ids`` the piece's ids come along as an array. Sequence ids are
    unique, not dense. One sequence in each ``window`` of tokens may stay partly empty. Empty in, empty out.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    share = F.coalesce(F.col(loss_share).cast("double"), F.lit(1.0)) if loss_share else F.lit(1.0)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)).alias("share"), F.shiftleft(F.spark_partition_id().cast("long"), 33).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
        count, made = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal made
            keys = pa.concat_arrays([b.column("doc_id") for b, _, _ in held])
            share = np.concatenate([b.column("share").to_numpy() for b, _, _ in held])
            base = held[0][0].column("base")[0].as_py()
            tokens = np.concatenate([n for _, _, n in held])
            ids = np.concatenate([x for _, x, _ in held])
            at = np.cumsum(tokens) - tokens
            sequences = place(tokens, share, limits)
            flat = [(i, s, n, base + made + q, k) for q, parts in enumerate(sequences) for k, (i, s, n) in enumerate(parts)]
            made += len(sequences)
            item, start, length, sequence, segment = np.array(flat, dtype=np.int64).T
            new = np.concatenate([[True], sequence[1:] != sequence[:-1]])
            before = np.cumsum(length) - length
            offset = before - np.maximum.accumulate(np.where(new, before, 0))
            lo = at[item] + start
            crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(lo.tolist(), length.tolist(), strict=True)]
            columns = [keys.take(pa.array(item)), *map(pa.array, (start, length, np.array(crc, np.int64), tokens[item], sequence, offset, segment.astype(np.int32)))]
            if keep_ids:
                columns.append(pa.array([ids[a : a + n].astype(np.int32) for a, n in zip(lo, length, strict=True)], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names)

        for b in pieces(batches):
            ids, counts = encode(b.column("text"))
            stops = np.cumsum(counts)
            ids = np.insert(ids.astype("<u4"), stops, end_id)
            held.append((b, ids, counts + 1))
            count += len(ids)
            if count >= window:
                yield flush()
                held.clear()
                count = 0
        if held:
            yield flush()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "segment"] + ["ids"] * keep_ids
    return rows.mapInArrow(run, f"doc_id {kind}, {SCHEMA}" + ", ids array<int>" * keep_ids)
