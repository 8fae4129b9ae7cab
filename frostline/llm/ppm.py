"""Language-model scoring by prediction by partial matching.

The model is a trie of byte contexts, pretrained on the corpus and then fixed. A byte is coded in the longest context the
trie knows; a byte that was not seen there costs an escape (method C: as likely as the number of distinct bytes seen) and
is looked for in the next shorter context, where bytes of the longer one are excluded. Below the empty context all bytes
left are equally likely.

Counts are taken over all training texts and none is left out, so the model grows with the corpus and lies in tables.
What a byte costs depends on nothing but itself and its ``order`` bytes of context, its gram. Grams whose nearest
``NEAR`` bytes of context are equal have all contexts of that length and more in common: they come together in a task,
which builds that part of the trie, with the shorter contexts from a broadcast, and prices them. Texts look the prices of
frequent grams up in the task and get those of all others by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.text import coded_words, fold, pieces, small_batches
from frostline.session import stage

ORDER = 5
NEAR = 3  # depths below it are shared: 2^24 cells at most; a part of the trie has 256^(order + 1 - NEAR), 2^24 at order 5
BLOCK = 1 << 18  # parts are priced together up to so many grams
HOT_GRAMS = 1 << 21  # grams that hold at least so small a share of all coded bytes are looked up in the task: that many at most
HOT = 1 << 18  # words that hold at least so small a share of all tokens are looked up in the task: HOT of them at most
TEXT_BYTES = 2 << 20  # of texts looked at together
ROWS_OUT = 1 << 16  # of a batch handed to Spark
KEY_BYTES = 32  # longer words are known by a digest
EDGE = 0xFF  # never occurs in UTF-8: stands before a text, as often as contexts are long, and once after it


def _grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Per coded byte its context and itself as one number, and where each text's begin (one more than texts).

    The lowest byte is the coded one, the bytes above it are its context, nearest first.
    """
    import pyarrow.compute as pc

    low = pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")).cast(pa.binary()).to_numpy(zero_copy_only=False)
    pad = bytes([EDGE]) * order
    whole = np.frombuffer(pad + (bytes([EDGE]) + pad).join(low) + bytes([EDGE]), dtype=np.uint8)
    size = np.array([len(x) for x in low], dtype=np.int64) + 1
    gram = np.zeros(len(whole) - order, dtype=np.uint64)
    for k in range(order + 1):
        gram |= whole[order - k : len(whole) - k].astype(np.uint64) << np.uint64(8 * k)
    begin = np.cumsum(size + order) - size - order
    keep = np.ones(len(gram), dtype=bool)
    for k in range(order):
        between = begin[1:] - 1 - k
        keep[between] = False
    return gram[keep], np.concatenate([[0], np.cumsum(size)])


def _word_keys(words: pa.Array) -> list[bytes]:
    """Each word's bytes, or of long ones a digest one byte longer than any word kept."""
    import hashlib

    raw = words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    return [w if len(w) <= KEY_BYTES else b"\0" + hashlib.sha256(w).digest() for w in raw]


def corpus_counts(docs: DataFrame, order: int, folds: int) -> DataFrame:
    """``kind, word, gram, train, total``: counts of tokens (kind 0) and of coded bytes with their context (kind 1).

    ``train`` counts in training rows, ``total`` in all, for tokens and bytes alike. The end token is the empty word.
    """
    small_batches(docs.sparkSession)
    names = ["kind", "word", "gram", "train", "total"]

    def rows_of(kind: int, words, grams, train, total) -> pa.RecordBatch:
        n = len(total)
        columns = [pa.array(np.full(n, kind, np.int32)), words if kind == 0 else pa.nulls(n, pa.binary()), pa.array(grams.view(np.int64)) if kind else pa.nulls(n, pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(train), pa.array(total)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        pending, size = {}, 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            g, c = np.concatenate(kept), np.concatenate(counts)
            by = np.argsort(g, kind="stable")
            g, c = g[by], c[by]
            first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            return g[first], np.add.reduceat(c, first)

        def words_out() -> pa.RecordBatch:
            train = np.array([v[0] for v in pending.values()], dtype=np.int64)
            total = np.array([v[1] for v in pending.values()], dtype=np.int64)
            return rows_of(0, pa.array(list(pending), pa.binary()), None, train, total)

        def grams_out(marked: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(marked), ROWS_OUT):
                g, n = marked[at : at + ROWS_OUT], c[at : at + ROWS_OUT]
                yield rows_of(1, None, g >> np.uint64(1), np.where(g & np.uint64(1), 0, n), n)

        for b in pieces(batches, limit=TEXT_BYTES):
            held = b.column("held").to_numpy(zero_copy_only=False)
            text = b.column("text")
            rows, codes, words = coded_words(text)
            total = np.bincount(codes, minlength=len(words))
            train = np.bincount(codes[~held[rows]], minlength=len(words)) if len(rows) else total
            for key, a, c in zip(_word_keys(words), train.tolist(), total.tolist(), strict=True):
                old = pending.get(key)
                if old:
                    old[0] += a
                    old[1] += c
                else:
                    pending[key] = [a, c]
            end = pending.setdefault(b"", [0, 0])
            end[0] += int((~held).sum())
            end[1] += len(held)
            if len(pending) > 300_000:
                yield words_out()
                pending.clear()
            gram, begin = _grams(text, order)
            marked = np.sort(gram << np.uint64(1) | np.repeat(held, np.diff(begin)).astype(np.uint64))
            first = np.flatnonzero(np.concatenate([[True], marked[1:] != marked[:-1]]))
            kept.append(marked[first])
            counts.append(np.diff(np.append(first, len(marked))))
            size += len(first)
            if size > 2_000_000:
                g, c = merged()
                kept[:], counts[:], size = [g], [c], 0
                if len(g) > 1_000_000:
                    yield from grams_out(g, c)
                    kept.clear()
                    counts.clear()
        if pending:
            yield words_out()
        if kept:
            yield from grams_out(*merged())

    inputs = docs.select(F.col("text").cast("string").alias("text"), (fold("doc_id", folds) == 1).alias("held"))
    partial = inputs.mapInArrow(run, "kind int, word binary, gram long, train long, total long")
    return partial.groupBy("kind", "word", "gram").agg(F.sum("train").alias("train"), F.sum("total").alias("total"))


@dataclass
class Depth:
    """Cells of one depth, by ascending gram, and the contexts they belong to."""

    cells: np.ndarray
    logs: np.ndarray  # log10 of a cell's count
    contexts: np.ndarray
    hit: np.ndarray  # log10 of count plus distinct bytes: what a cell's count is divided by
    escape: np.ndarray  # log10 probability of an escape
    hit_less: np.ndarray  # the same two when the bytes of a context one longer are excluded; by that longer context
    escape_less: np.ndarray


class Trie:
    """The fixed model, or the part of it that some grams need. ``bytes_logs`` gives log10 probabilities of coded bytes."""

    def __init__(self, cells: list[tuple[np.ndarray, np.ndarray]]):
        self.order = len(cells) - 1
        self.depths: list[Depth] = []
        sums_below = None
        for k, (gram, count) in enumerate(cells):
            by = np.argsort(gram)
            gram, count = gram[by], count[by].astype(np.float64)
            context = gram >> np.uint64(8)
            first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(gram) else np.zeros(0, np.int64)
            total = np.add.reduceat(count, first) if len(first) else np.zeros(0)
            kinds = np.diff(np.append(first, len(gram))).astype(np.float64)
            names = context[first]
            hit, escape = np.log10(total + kinds), np.log10(kinds / (total + kinds))
            less, less_escape = np.zeros(len(names)), np.zeros(len(names))
            if k and len(names):
                up_gram, up_count, up_names, up_total, up_kinds = sums_below
                parent = np.searchsorted(up_names, names & np.uint64((1 << 8 * (k - 1)) - 1))
                shorter = gram & np.uint64((1 << 8 * k) - 1)
                taken = np.add.reduceat(up_count[np.searchsorted(up_gram, shorter)], first)
                rest, left = up_total[parent] - taken, up_kinds[parent] - kinds
                some = left > 0
                less[some] = np.log10(rest[some] + left[some])
                less_escape[some] = np.log10(left[some] / (rest[some] + left[some]))
            self.depths.append(Depth(gram, np.log10(count), names, hit, escape, less, less_escape))
            sums_below = gram, count, names, total, kinds
        self.floor = -np.log10(max(1, 256 - len(cells[0][0])))

    def bytes_logs(self, gram: np.ndarray) -> np.ndarray:
        """log10 probability of each coded byte."""
        out = np.zeros(len(gram))
        todo = np.arange(len(gram))
        excluded = np.full(len(todo), -1)  # the longer context just escaped from
        for k in range(self.order, -1, -1):
            depth = self.depths[k]
            if not len(todo) or not len(depth.cells):
                continue
            g = gram[todo] & np.uint64((1 << 8 * (k + 1)) - 1)
            ctx = np.minimum(np.searchsorted(depth.contexts, g >> np.uint64(8)), len(depth.contexts) - 1)
            known = depth.contexts[ctx] == g >> np.uint64(8)
            cell = np.minimum(np.searchsorted(depth.cells, g), len(depth.cells) - 1)
            found = depth.cells[cell] == g
            after = excluded >= 0
            above = self.depths[k + 1] if k < self.order else None
            hit, escape = depth.hit[ctx], depth.escape[ctx]
            if above is not None and after.any():
                hit = np.where(after, above.hit_less[excluded], hit)
                escape = np.where(after, above.escape_less[excluded], escape)
            out[todo] += np.where(found, depth.logs[cell] - hit, np.where(known, escape, 0.0))
            excluded = np.where(known, ctx, -1)[~found]
            todo = todo[~found]
        out[todo] += self.floor
        return out


class Prices:
    """A hash table from gram to log10 probability."""

    def __init__(self, gram: np.ndarray, value: np.ndarray):
        self.gram, self.value = gram, value
        self.bits = max(4, int(4 * max(1, len(gram))).bit_length())
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self.probes = 0
        todo, at = np.arange(len(gram)), self._slot(gram)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            miss = self.slots[at] != todo
            todo, at = todo[miss], (at[miss] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, gram: np.ndarray) -> np.ndarray:
        return (gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each gram, 0 where it is not in the table, and whether it is."""
        out, found = np.zeros(len(gram)), np.zeros(len(gram), dtype=bool)
        todo, at = np.arange(len(gram)), self._slot(gram)
        for _ in range(self.probes):
            cell = self.slots[at]
            full = cell >= 0
            same = full & (self.gram[cell] == gram[todo])
            out[todo[same]] = self.value[cell[same]]
            found[todo[same]] = True
            on = full & ~same
            todo, at = todo[on], (at[on] + 1) & ((1 << self.bits) - 1)
            if not len(todo):
                break
        return out, found


def _low(gram: np.ndarray, depth: int) -> np.ndarray:
    """Coded byte and ``depth`` bytes of context."""
    return gram & np.uint64((1 << 8 * (depth + 1)) - 1)


def priced(counts: DataFrame, order: int, block: int = BLOCK) -> DataFrame:
    """``gram, total, price`` of every gram of ``corpus_counts``: the log10 probability of its coded byte."""
    grams = counts.where("kind = 1").select("gram", "train", "total")
    shared = min(NEAR, order + 1)
    depth = F.explode(F.sequence(F.lit(0), F.lit(shared - 1))).alias("depth")
    short = grams.where("train > 0").select("gram", "train", depth).select("depth", F.expr("gram & shiftright(-1L >>> 8, 8 * (6 - depth))").alias("gram"), "train")
    few = short.groupBy("depth", "gram").agg(F.sum("train").alias("n")).toPandas()
    levels = [few[few["depth"] == k] for k in range(shared)]
    common = counts.sparkSession.sparkContext.broadcast([(v["gram"].to_numpy(np.int64).view(np.uint64), v["n"].to_numpy(np.int64)) for v in levels])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def price() -> pa.RecordBatch:
            gram, train, total = (np.concatenate(x) for x in zip(*parts, strict=True))
            cells = list(common.value)
            seen, times = gram[train > 0], train[train > 0]
            for k in range(shared, order + 1):
                g, at = np.unique(_low(seen, k), return_inverse=True)
                cells.append((g, np.bincount(at, weights=times, minlength=len(g)).astype(np.int64)))
            logs = Trie(cells).bytes_logs(gram)
            return pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(total), pa.array(logs)], ["gram", "total", "price"])

        held = 0
        for b in batches:
            gram, train, total = (b.column(x).to_numpy(zero_copy_only=False) for x in ("gram", "train", "total"))
            gram = gram.view(np.uint64)
            if held + len(gram) > block and len(gram):  # cut where the last part of this batch begins, as it may go on
                near = _low(gram >> np.uint64(8), NEAR - 1)
                old = len(parts) and _low(parts[-1][0][-1:] >> np.uint64(8), NEAR - 1)[0] != near[0]
                cut = int(np.flatnonzero(near == near[-1])[0])
                if cut or old:
                    parts.append((gram[:cut], train[:cut], total[:cut]))
                    yield price()
                    parts.clear()
                    held, gram, train, total = 0, gram[cut:], train[cut:], total[cut:]
            parts.append((gram, train, total))
            held += len(gram)
        if held:
            yield price()

    near = F.expr(f"shiftrightunsigned(gram, 8) & {(1 << 8 * NEAR) - 1}L")
    parted = grams.withColumn("near", near).repartition("near").sortWithinPartitions("near")
    return parted.select("gram", "train", "total").mapInArrow(run, "gram long, total long, price double")


def score(docs: DataFrame, order: int = ORDER, folds: int = 5, hot: int = HOT, hot_grams: int = HOT_GRAMS, block: int = BLOCK) -> DataFrame:
    """Train on the rows of ``docs(doc_id, text)`` outside fold 1 and score every row.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: ``score`` is the trie's log10
    probability of the lower-cased (A-Z) text and its end, ``base_score`` that of a smoothed unigram model of its words
    and end token. Null texts are empty: one end token. A null ``doc_id`` is not held out; repeated rows count and are
    scored each. ``hot``, ``hot_grams`` and ``block`` bound memory and change no result. Empty in, empty out.
    """
    if not 0 <= order <= 6:
        raise ValueError("contexts hold 0 to 6 bytes")
    spark = docs.sparkSession
    small_batches(spark)
    counts = stage(corpus_counts(docs, order, folds))
    prices = stage(priced(counts, order, block))
    coded = prices.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    top = prices.where(F.col("total") * hot_grams >= coded).select("gram", "price").toPandas()
    model = spark.sparkContext.broadcast(Prices(top["gram"].to_numpy(np.int64).view(np.uint64), top["price"].to_numpy(np.float64)))
    words = counts.where("kind = 0")
    n, every, v = words.agg(F.coalesce(F.sum("train"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0)), F.count(F.when(F.col("train") > 0, 1))).first()
    often = words.where((F.col("total") * hot >= every) | (F.octet_length("word") == 0)).select("word", "train").toPandas()
    table = spark.sparkContext.broadcast({bytes(w): int(c) for w, c in zip(often["word"], often["train"], strict=True)})
    names = ["row", "key", "gram", "n", "doc_id", "held_out", "n_tokens", "n_known", "counted", "score"]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        for b in pieces(batches, limit=TEXT_BYTES):
            text, m = b.column("text"), b.num_rows
            rows, codes, vocabulary = coded_words(text)
            keys = _word_keys(vocabulary)
            count = np.fromiter((known.get(k, -1) for k in keys), np.int64, len(keys))
            c = count[codes] if len(codes) else codes
            near = c >= 0
            base = np.bincount(rows[near], weights=np.log10(c[near] + 0.5), minlength=m)
            seen = np.bincount(rows[near & (c > 0)], minlength=m)
            size = len(keys) or 1
            pair = np.sort(rows[~near] * size + codes[~near])
            one = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else pair
            times = np.diff(np.append(one, len(pair)))
            row, code = pair[one] // size, pair[one] % size
            far = pa.array(keys, pa.binary()).take(pa.array(code))
            ids = b.column("row")
            end = known.get(b"", 0)
            gram, begin = _grams(text, order)
            logs, priced_here = model.value.find(gram)
            own = [
                ids, pa.array([b"\0row" + int(i).to_bytes(40, "big") for i in ids.to_pylist()], pa.binary()), pa.array(np.zeros(m, np.int64)), pa.array(np.zeros(m, np.int64)),
                b.column("doc_id"), b.column("held"), pa.array(np.bincount(rows, minlength=m) + 1), pa.array(seen + (end > 0)), pa.array(base + np.log10(end + 0.5)),
                pa.array(np.add.reduceat(logs, begin[:-1])),
            ]
            yield pa.RecordBatch.from_arrays(own, names)

            def sent(row: np.ndarray, key: pa.Array, gram: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
                k = len(row)
                rest = [pa.nulls(k, b.column("doc_id").type), pa.nulls(k, pa.bool_()), *[pa.nulls(k, pa.int64())] * 2, *[pa.nulls(k, pa.float64())] * 2]
                return pa.RecordBatch.from_arrays([ids.take(pa.array(row)), key, pa.array(gram), pa.array(times), *rest], names)

            for at in range(0, len(row), ROWS_OUT):
                cut = slice(at, at + ROWS_OUT)
                yield sent(row[cut], far[cut], np.zeros(len(row[cut]), np.int64), times[cut])
            row, gram = np.repeat(np.arange(m), np.diff(begin))[~priced_here], gram[~priced_here]
            by = np.lexsort((gram, row))
            row, gram = row[by], gram[by]
            one = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])])) if len(row) else by
            times = np.diff(np.append(one, len(row)))
            for at in range(0, len(one), ROWS_OUT):
                cut = one[at : at + ROWS_OUT]
                yield sent(row[cut], pa.array([b""] * len(cut), pa.binary()), gram[cut].view(np.int64), times[at : at + ROWS_OUT])

    inputs = docs.select("doc_id", F.col("text").cast("string").alias("text"), (fold("doc_id", folds) == 1).alias("held"), F.monotonically_increasing_id().alias("row"))
    found = inputs.mapInArrow(run, f"row long, key binary, gram long, n long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, counted double, score double")
    # A rare word has gram 0, a rare gram the empty word; that word itself, the end token, is never rare.
    rare = words.where((F.col("total") * hot < every) & (F.octet_length("word") > 0)).select(F.col("word").alias("key"), F.lit(0).cast("long").alias("gram"), "train", F.lit(0.0).alias("price"))
    few = prices.where(F.col("total") * hot_grams < coded).select(F.lit(b"").alias("key"), "gram", F.lit(0).cast("long").alias("train"), "price")
    joined = found.join(rare.unionByName(few), ["key", "gram"], "left")
    c = F.coalesce(F.col("train"), F.lit(0))
    is_word = F.octet_length("key") > 0
    total = joined.groupBy("row").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum(F.when(c > 0, F.col("n")).otherwise(0))).alias("n_known"),
        (F.max("counted") + F.sum(F.when(is_word, F.col("n") * F.log10(c + 0.5)).otherwise(0.0))).alias("counted"),
        (F.max("score") + F.sum(F.col("n") * F.coalesce(F.col("price"), F.lit(0.0)))).alias("score"),
    )
    per = F.log10(F.lit(float(n) + 0.5 * (v + 1)))
    return total.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), (F.col("counted") - F.col("n_tokens") * per).alias("base_score"), "score")
