"""Each operator against brute force, and on rows that are easy to get wrong."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from frostline.llm import chat, components, factor_machine, nearest, outliers, packing, pieces, ppm, quality, simhash, toxicity, warc
from frostline.llm.queries import QUERIES, byte_bpe
from frostline.session import new_stage_path
from tests.compare import ROOT, compare, connect

SF = f"{ROOT}/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = ", key string, row long, fp long, y int, n int, kept boolean, held boolean, cell string, grp string"
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Same text here again"), (6, "Same text here again"), (6, "Same text here again"),
    (None, "no id at all"), (8, "ü ß 中文 \U0001f642 <|endoftext|> \x00 a  b"), (9, "long " * 30000), (10, "x" * 70000), (11, "    's it's"),
]


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if (i or 0) % 2 else None, None, len(t or ""), *["e", 1, 1, 1, 1, True, True, "c", "g"]) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + EXTRA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_every_operator_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())


# language model -----------------------------------------------------------------------------------------------------


def base_scores(rows):
    tokens = [(i, WORDS.findall(lowered(t)) + [""]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted((i or 0, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws in tokens)


@pytest.mark.parametrize("hot", [4, 1 << 18])
def test_base_score(spark, odd, docs, hot):
    for df in (odd, docs):
        got = ppm.score(df, hot=hot).collect()
        assert sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == base_scores(texts_of(df))
        assert all(r.score < 0 for r in got)
    assert ppm.score(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("order", "hot", "block"), [(0, 1 << 21, 1 << 20), (2, 1 << 21, 1 << 20), (3, 500, 2000), (5, 1000, 3000), (6, 1 << 21, 1 << 20)])
def test_ppm_against_a_plain_coder(spark, docs, order, hot, block):
    few = docs.orderBy("doc_id").limit(25)
    got = {r.doc_id: r.score for r in ppm.score(few, order=order, hot_grams=hot, block=block).collect()}
    coded = {i: b"\xff" * order + lowered(t).encode() + b"\xff" for i, t in texts_of(few)}
    counts = [Counter() for _ in range(order + 1)]
    for i, b in coded.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            for at in range(order, len(b)):
                for k in range(order + 1):
                    counts[k][b[at - k : at + 1]] += 1
    tree = [{} for _ in counts]
    for k, c in enumerate(counts):
        for gram, n in c.items():
            tree[k].setdefault(gram[:-1], {})[gram[-1]] = n
    for i in [j for j in coded if j % 3 == 0 or zlib.crc32(str(j).encode()) % 5 == 1][:12]:
        b, log = coded[i], 0.0
        for at in range(order, len(b)):
            out = set()
            for k in range(order, -1, -1):
                seen = tree[k].get(b[at - k : at])
                left = {s: n for s, n in (seen or {}).items() if s not in out}
                if not left:
                    continue
                whole = sum(left.values()) + len(left)
                if b[at] in left:
                    log += math.log10(left[b[at]] / whole)
                    break
                log += math.log10(len(left) / whole)
                out |= set(left)
            else:
                log -= math.log10(256 - len(tree[0][b""]))
        assert got[i] == pytest.approx(log, abs=1e-6)


def test_held_out_texts_are_likelier_than_under_the_base_model(spark):
    got = ppm.score(spark.read.parquet(f"{ROOT}/sf0.1/documents.parquet"), hot_grams=1 << 17).where("held_out")
    score, base = got.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


# classifiers --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("name", "operator", "threshold", "label"), [("op2_quality_fm", quality, 0.5, "quality"), ("op6_toxicity_fm", toxicity, 0.7, "toxic")])
def test_held_out_accuracy(spark, name, operator, threshold, label):
    folder = f"{ROOT}/sf0.01"
    rows = queries()[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    right = [r.predicted == r[label] for r in rows]
    assert np.mean(right) > 0.93
    assert np.mean([r.predicted for r in rows if r[label] == 0 or label == "quality"]) < (0.05 if label == "toxic" else 1)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in rows)


def test_sum_of_squares_is_the_pairwise_sum():
    rng = np.random.default_rng(0)
    x = rng.random((5, 12)) < 0.5
    m = factor_machine.Model(np.arange(12), np.zeros((0, 9)), 0.1, rng.normal(size=12), rng.normal(size=(12, 3)))
    pairs = [sum(row[a] * row[b] * float(m.factors[a] @ m.factors[b]) for a in range(12) for b in range(a)) for row in x]
    assert np.allclose(factor_machine.predict(m, *np.nonzero(x), 5), 1 / (1 + np.exp(-(m.bias + x @ m.linear + pairs))), atol=1e-12)


@pytest.mark.parametrize("others", [0, 40])
def test_an_insult_is_only_toxic_with_a_group(spark, others):
    """Only the pair tells the label, so a sum of single weights can't; rows of the second half are not learned from."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(4000):
        a, b = rng.random(2) < 0.5
        words = ["filler", "pests" if a else "birds", "neighbours" if b else "gardens", *[f"{k:04d}w" for k in rng.choice(2000, others, replace=False)]]
        rows.append((i, " ".join(words), int(a == b)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")

    def right(**settings):
        model = toxicity.train(df, df.where("doc_id < 2000"), **settings)
        got = toxicity.score(df, model).join(df, "doc_id").where("doc_id >= 2000").collect()
        return np.mean([(r.score > 0.5) == r.toxic for r in got])

    assert right() > 0.95
    assert right(epochs=5) < 0.6  # weights alone


def test_training_entries_are_those_sorted():
    rng = np.random.default_rng(6)
    lists = [np.sort(rng.choice(50, k, replace=False)) for k in (3, 0, 7, 1)]
    lengths, bins = np.array([len(x) for x in lists]), rng.integers(0, 22, (4, 2))
    bins.sort(axis=1)
    rows, inputs = factor_machine._sparse(np.repeat(np.arange(4), lengths), np.concatenate(lists), bins, 50)
    starts, got = factor_machine._training(lengths, np.concatenate(lists), bins, 50)
    assert (got == inputs).all() and (starts == np.searchsorted(rows, np.arange(5))).all()


def test_words_that_tell_alone_keep_their_factors(spark):
    """In long texts factors begin short; the penalty of useless inputs would end those of telling words at their first step."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1500):
        bad = rng.random() < 0.3
        rows.append((i, " ".join(["pests" if bad else "birds", *[f"{k:04d}w" for k in rng.choice(2000, 150, replace=False)]]), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df, df.where("doc_id < 1000"))
    assert model.factors.any()
    got = toxicity.score(df, model).join(df, "doc_id").where("doc_id >= 1000").collect()
    assert all((r.score > 0.5) == r.toxic for r in got)


def _plain_score(model, text, n_chars):
    """Score of one text, pair by pair, from the words as Python splits them."""
    inputs = set()
    place = {int(t): k for k, t in enumerate(model.terms)}
    for word in set(WORDS.findall((text or "").lower())):
        word = word.encode().strip(factor_machine.EDGE_MARKS)
        buckets = [zlib.crc32(word) % factor_machine.BUCKETS]
        for k in range(3, min(8, len(word)) + 1):
            mixed = (int.from_bytes(word[:k], "little") * 0x9E3779B97F4A7C15 % 2**64) ^ k
            buckets.append(mixed >> (64 - factor_machine.BUCKET_BITS))
        inputs |= {place[x] for x in buckets if x in place}
    values = factor_machine.structure_of(pa.array([text], pa.string()))[0].tolist() if len(model.edges) else []
    values += [n_chars] * len(model.metadata)
    for k, (value, cuts) in enumerate(zip(values, model.edges, strict=True)):
        at = factor_machine.BINS if value is None else sum(value >= c for c in cuts)
        inputs.add(len(model.terms) + k * (factor_machine.BINS + 1) + at)
    chosen = sorted(inputs)
    margin = model.bias + sum(model.linear[a] for a in chosen)
    margin += sum(float(model.factors[a] @ model.factors[b]) for a in chosen for b in chosen if b < a)
    return 1 / (1 + np.exp(-margin))


def test_scores_are_those_of_a_plain_machine(spark, docs):
    texts = [(r.doc_id, r.text, r.n_chars) for r in docs.select("doc_id", "text", F.col("n_chars").cast("long")).limit(60).collect()]
    texts += [(-1, None, None), (-2, "", 0), (-3, "idiot " * 3000, 18000)]
    df = spark.createDataFrame(texts, "doc_id long, text string, n_chars long")
    rng = np.random.default_rng(5)
    labels = docs.sparkSession.read.parquet(f"{ROOT}/sf0.01/labels.parquet")
    whole = docs.sparkSession.read.parquet(f"{ROOT}/sf0.01/documents.parquet")
    for operator in (quality, toxicity):
        model = operator.train(whole, labels)
        model.factors = model.factors + rng.normal(0, 0.05, model.factors.shape)  # so that pairs count in any case
        got = {r.doc_id: r.score for r in operator.score(df.repartition(3), model).collect()}
        assert got == {r.doc_id: r.score for r in operator.score(df.coalesce(1), model).collect()}  # a row's score is its own
        for i, text, n_chars in texts:
            assert got[i] == pytest.approx(_plain_score(model, text, n_chars), abs=1e-9)


def test_metadata_may_lack_or_be_no_number(spark, docs):
    labels = spark.read.parquet(f"{ROOT}/sf0.001/labels.parquet")
    model = quality.train(docs, labels)
    for other in (docs.drop("n_chars"), docs.withColumn("n_chars", F.lit("many")), docs.withColumn("n_chars", F.lit(None).cast("long"))):
        assert quality.score(other, model).count() == docs.count()
        assert quality.score(other, quality.train(other, labels)).count() == docs.count()


def test_classifiers_take_odd_rows(spark, odd):
    for operator, label in ((quality, "quality"), (toxicity, "toxic")):
        for rows in ([], [(1, None)], [(1, 1), (2, 1)], [(1, 0), (1, 1), (4, 0), (5, 1), (None, 1)]):
            labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
            got = operator.score(odd, operator.train(odd, labels)).collect()
            assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert operator.score(odd.limit(0), operator.train(odd.limit(0), labels)).count() == 0


# quality rules ------------------------------------------------------------------------------------------------------


def test_statistics_and_base_rule(spark, odd, docs):
    for df in (odd, docs):
        want = []
        for i, t in texts_of(df):
            t = t or ""
            w = WORDS.findall(t)
            c, marked = Counter(zip(w, w[1:], w[2:], strict=False)), set()
            for k in range(len(w) - 2):
                if c[tuple(w[k : k + 3])] > 1:
                    marked |= {k, k + 1, k + 2}
            lines = [x for x in t.split("\n") if WORDS.search(x)]
            counts = (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(marked))
            want.append((i or 0, *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]))
        got = outliers.judge(df).collect()
        assert sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted(want)
        assert not any(r.kept and r.base_failed for r in got)
    assert outliers.judge(docs.limit(0)).count() == 0


def test_outliers_are_the_bad_documents(spark):
    folder = f"{ROOT}/sf0.01"
    rows = queries()["op5_mcd_outliers"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.98
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.05


def test_estimate_resists_a_third_of_outliers(spark):
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0.0, 0.1, (400, 7)), rng.normal(3.0, 0.1, (200, 7))
    rows = spark.createDataFrame([("g", *map(float, v)) for v in np.vstack([good, bad])], "grp string, " + ", ".join(f"{k} double" for k in outliers.NAMES))
    mu = outliers.estimates(rows).first()["mu"]
    assert np.abs(np.array(mu)).max() < 0.1


# near-duplicates ----------------------------------------------------------------------------------------------------


def fingerprint(text):
    w = WORDS.findall(lowered(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark, odd, docs):
    for df in (odd.where("length(text) < 1000 or text is null"), docs.limit(60)):
        got = sorted((r.doc_id or 0, r.fp & (2**64 - 1)) for r in simhash.with_fingerprints(df).collect())
        assert got == sorted((i or 0, fingerprint(t)) for i, t in texts_of(df))


def test_gray_tree_finds_every_pair():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)), base[:1] ^ np.uint64(3)]))
    q, found = simhash.GrayTree(fps).search(fps, 2)
    want = {(int(a), int(b)) for a in fps for b in fps if int(a ^ b).bit_count() <= 2}
    assert {(int(fps[i]), int(f)) for i, f in zip(q, found, strict=True)} == want


@pytest.mark.parametrize("group", [8, 8192])
def test_links_connect_what_brute_force_connects(spark, group):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    chain = np.cumsum(np.full(30, 1, np.uint64)) ^ base[0]
    fps = np.unique(np.concatenate([base, chain, base ^ np.uint64(1 << 40 | 1)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r.node: r.root for r in components.components(simhash.links(df, 2, group)).collect()}
    root = list(range(len(fps)))
    find = lambda x: x if root[x] == x else find(root[x])
    for i in range(len(fps)):
        for j in range(i):
            if int(fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    keys = [int(x) for x in fps.view(np.int64)]
    classes = {}
    for i, k in enumerate(keys):
        classes.setdefault(find(i), set()).add(got.get(k, k))
    assert all(len(c) == 1 for c in classes.values()) and len({c.pop() for c in classes.values()}) == len({find(i) for i in range(len(fps))})


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}
    assert components.components(edges.limit(0)).count() == 0


def test_near_duplicates_of_odd_rows(spark, odd):
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert got[1] == got[2] == got[3] == 1 and got[5] == got[6] == 5 and got[None] is None
    assert simhash.near_duplicates(odd).count() == len(ODD)
    one = simhash.one_of_each(odd)
    assert one.columns == odd.columns and sorted(r.doc_id or 0 for r in one.collect()) == [0, 1, 4, 5, 8, 9, 10, 11]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


# packing ------------------------------------------------------------------------------------------------------------


def ids_of(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids + [1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 40)])
def test_pieces_hold_each_id_once(spark, odd, docs, limits):
    for df in (odd.where("doc_id is not null and doc_id <> 6"), docs):
        rows = packing.pack(df, byte_bpe(), 1, limits, keep_ids=True).collect()
        given = texts_of(df)
        parts = {}
        for r in rows:
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
            parts.setdefault(r.doc_id, []).append(r)
        for (i, _), ids in zip(given, ids_of([t for _, t in given]), strict=True):
            own = sorted(parts[i], key=lambda r: r.start)
            assert [x for r in own for x in r.ids] == ids and all(r.doc_tokens == len(ids) for r in own)
        sequences = {}
        for r in rows:
            sequences.setdefault(r.sequence_id, []).append(r)
        for own in sequences.values():
            own.sort(key=lambda r: r.offset)
            assert [r.offset for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1])
            assert len(own) <= limits.segments and sum(r.length for r in own) <= min(limits.tokens, limits.loss)
    assert packing.pack(docs.limit(0), byte_bpe(), 1).count() == 0
    assert packing.pack(odd, byte_bpe(), 1).select("doc_id").distinct().count() == len({i for i, _ in ODD})


def test_little_padding(spark):
    rows = packing.pack(spark.read.parquet(f"{ROOT}/sf0.01/documents.parquet").coalesce(1), byte_bpe(), 1).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(2048 - r.n for r in rows) < 0.01 * 2048 * len(rows)


@pytest.mark.parametrize("share", [0.0, 0.3, 1.0])
def test_placement_keeps_all_three_limits(share):
    rng = np.random.default_rng(2)
    tokens, loss = rng.integers(1, 300, 500), np.full(500, share)
    limits = packing.Limits(128, 4, 50)
    seen = np.zeros(500, dtype=int)
    for parts in packing.place(tokens, loss, limits):
        assert len(parts) <= 4 and sum(n for _, _, n in parts) <= 128 and sum(n * share for _, _, n in parts) <= 50 + 1e-9
        for i, _, n in parts:
            seen[i] += n
    assert (seen == tokens).all()


def plain_picks(size, heavy, limits):
    """The demands in each sequence by the dot-product rule, one example at a time."""
    left = [(x, 1, y) for x, y in zip(size, heavy, strict=True)]
    most = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
    weight, bins = np.mean(left, axis=0) / most / most, []
    while left:
        room, held = most.copy(), []
        while fit := [d for d in left if d[0] <= room[0] and d[1] <= room[1] and d[2] <= room[2] + 1e-9]:
            best = max(fit, key=lambda d: (round(float(np.dot(d, weight * room)), 12), d[0], -d[2]))
            left.remove(best)
            held.append((best[0], best[2]))
            room = room - np.array(best)
        bins.append(sorted(held))
    return bins


def test_picks_follow_the_dot_product_rule():
    rng = np.random.default_rng(12)
    for k in range(80):
        size = rng.integers(1, 60, 40).astype(float)
        heavy = size * (1.0 if k % 2 else rng.choice([0.0, 0.25, 0.5, 1.0], 40))
        limits = packing.Limits(64, int(rng.integers(2, 9)), int(rng.integers(60, 65)))
        got = [sorted((size[i], heavy[i]) for i in held) for held, _ in packing.pick(size, heavy, limits)]
        assert got == plain_picks(size.tolist(), heavy.tolist(), limits)


def test_a_window_of_one_token_texts_takes_seconds():
    import time

    began = time.perf_counter()
    assert len(packing.place(np.ones(1 << 20, dtype=np.int64), np.ones(1 << 20), packing.Limits())) == 2048
    assert time.perf_counter() - began < 20


def test_chunked_encoding_equals_whole_encoding():
    rng = np.random.default_rng(4)
    alphabet = ["<|endoftext|>", "<|", "endoftext|>", " ", " ", "\n", "\t", " ", " ", "\x85", "a", "é", "1", ".", "'s", "'", "中", "　", " the", "\x00"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 20))) for _ in range(3000)]
    ids, counts = byte_bpe()(pa.array(texts))
    cuts = np.concatenate([[0], np.cumsum(counts)])
    assert [ids[a:b].tolist() + [1] for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == ids_of(texts)


# sampled pieces -----------------------------------------------------------------------------------------------------


def test_sampling_is_lossless_and_repeatable(spark, odd):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    df = odd.unionByName(odd.selectExpr("100 as doc_id", "'▁ a▁b  ' as text", *[c for c in odd.columns if c not in ("doc_id", "text")]).limit(1))
    ids = pieces.sample(df, path)
    back = sorted((r.doc_id or 0, r.text) for r in pieces.decode(ids, path).collect())
    assert back == sorted((i or 0, t or "") for i, t in texts_of(df))
    first, again = (sorted(map(tuple, pieces.digest(df.repartition(n), path).na.fill({"doc_id": 0}).collect())) for n in (1, 5))
    assert first == again and all(r[3] for r in first)
    assert pieces.sample(df.limit(0), path).count() == 0


def test_sampling_follows_the_lattice():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, lattice = SentencePieceProcessor(model_file=path), pieces.lattice(path, 1.0)
    vocabulary = {model.id_to_piece(i): i for i in range(model.vocab_size()) if not model.is_byte(i)}

    def ways(text):
        if not text:
            yield (), 0.0
        for n in range(1, len(text) + 1):
            if text[:n] in vocabulary:
                for rest, w in ways(text[n:]):
                    yield (vocabulary[text[:n]], *rest), w + lattice.weight[vocabulary[text[:n]]]

    every = dict(ways("▁theing"))
    ids, counts = lattice(pa.array(["theing"] * 20000), np.arange(20000))
    stop = np.cumsum(counts)
    found = Counter(tuple(ids[e - n : e].tolist()) for e, n in zip(stop, counts, strict=True))
    total = sum(map(math.exp, every.values()))
    assert set(found) <= set(every) and max(abs(found[k] / 20000 - math.exp(w) / total) for k, w in every.items()) < 0.015


# archives -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("parts", "split"), [(1, "128m"), (3, "2k")])
def test_archives_come_back(spark, parts, split):
    fake = warc.MAGIC + "WARC-Type: response\r\nX-Page-ID: 999\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "u", "x" * 120), (2, "u", "x" * 120), (3, None, None), (4, "u\n4", fake * 3 + "é" * 60), (5, "u", fake * 3 + "é" * 60), (6, "u", "a\r\n\r\nb" + warc.MAGIC + "z" + warc.MAGIC)]
    rows += [(7, "u", "tiny"), (8, "u", "tiny"), (None, "n", "x" * 120), (10, "w", warc.MAGIC), *[(100 + i, "z", f"page {i} " * 40 + (fake if i % 7 == 0 else "")) for i in range(60)]]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")
    path = new_stage_path(spark)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    warc.write(pages.repartition(parts), path)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = warc.read(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    first, want = {}, {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    for i, _, h in rows:
        b = (h or "").encode()
        again = b in first and (i is None or i > first[b])
        want[i] = (len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None)
    assert len(got) == len(rows) and {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want
    assert all(r.payload == (dict((i, h) for i, _, h in rows)[r.page_id] or "") for r in got if r.record_type == "response")


@pytest.mark.parametrize("size", [65_000, 100_000, 1_000_000])
def test_a_long_url_hides_no_record(spark, size):
    rows = [(1, "u", "first"), (2, "u" * size, "second"), (3, "ü" * size, "third"), (4, "u", "last"), (5, "u", "é" * size + warc.MAGIC + "x" * size)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = new_stage_path(spark)
    warc.write(pages.orderBy("page_id").coalesce(1), path)
    assert sorted((r.page_id, r.url, r.payload) for r in warc.read(spark, path).collect()) == rows


def test_archive_of_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# conversations ------------------------------------------------------------------------------------------------------


def test_prefixes_collapse(spark):
    rows = []
    for conv, turns in {1: "ab", 2: "abc", 3: "abc", 4: "abd", 5: "b", 6: "a", 7: "bz"}.items():
        rows += [(conv, k * 300, "user" if k % 2 == 0 else "assistant", t, 1) for k, t in enumerate(turns)]
    rows += [(8, None, None, None, 1), (9, None, None, None, 1), (9, 0, None, None, 1), (9, 0, None, None, 2), (None, 0, "user", "a", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int")
    got = chat.maximal(df)
    assert sorted({r.conv_id for r in got.collect()}) == [2, 4, 7, 9]
    one = [r.segment for r in chat.render(got).where("conv_id = 2").orderBy("pos").collect()]
    assert one == ["<|start|>user\na<|end|>\n", "<|start|>assistant\nb<|end|>\n", "<|start|>user\nc<|end|>\n"]
    assert chat.render(chat.maximal(df.limit(0))).count() == 0


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_conversations_against_sql(spark, folder):
    diff, n = compare(queries()["op3_chat_collapse"](spark, f"{ROOT}/{folder}"), connect(f"{ROOT}/{folder}"), chat.ORACLE)
    assert not diff and n


# nearest neighbours -------------------------------------------------------------------------------------------------


def test_recall_and_exact_scores(spark):
    df = spark.read.parquet(f"{ROOT}/sf0.1/embeddings.parquet")
    rows = nearest.search(df, F.col("vec_id") % 100 == 0, cell=256).collect()
    plain = df.toPandas()
    x, ids = np.array(plain["embedding"].tolist(), dtype=np.float64), plain["vec_id"].to_numpy()
    hits = total = 0
    for j in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[j]) ** 2).sum(axis=1))
        d[j] = np.inf
        mine = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == ids[j])
        assert [m[0] for m in mine] == list(range(1, 11)) and all(abs(d[np.flatnonzero(ids == m[1])[0]] - m[2]) < 1e-9 for m in mine)
        hits, total = hits + len({m[1] for m in mine} & set(ids[np.lexsort((ids, d))[:10]])), total + 10
    assert hits / total >= 0.9


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, []), (None, [1.0, 0.0]), (7, [1.0, 2.0, 3.0])]
    rows += [(10 + i, [2.0, 2.0]) for i in range(30)] + [(11, [2.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cell string, rank int")
    got = nearest.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    want = [(q, k + 1, v) for q, o in ((0, 100), (100, 0)) for k, v in enumerate([o, 1, *range(10, 18)])]
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == want
    assert nearest.search(df.limit(0), F.lit(True)).count() == 0
    few = nearest.search(df.where("vec_id in (0, 1, 100)"), F.col("vec_id") == 0).collect()
    assert len(few) == 2


# pipeline -----------------------------------------------------------------------------------------------------------


def brute_kept(rows):
    """Ids that stay: the smallest of each component of fingerprints within 2 bits, by comparing every pair."""
    prints = [(i, fingerprint(t)) for i, t in rows]
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, x) in enumerate(prints):
        for j, y in prints[:k]:
            if (x ^ y).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i, _ in prints if find(i) == i}


def test_the_near_duplicate_stage_against_every_pair(spark):
    docs = spark.read.parquet(f"{ROOT}/sf0.01/documents.parquet")
    kept = corpus_pipeline.one_per_group(spark, docs, f"{ROOT}/sf0.01").collect()
    assert len(kept) == len({r.doc_id for r in kept}) and {r.doc_id for r in kept} == brute_kept(texts_of(docs))


def test_the_pipeline_takes_odd_rows(spark, odd):
    """Every filtering stage on rows with nulls, repeats, clashing columns and long texts, and on none."""
    folder = f"{ROOT}/sf0.001"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, folder).columns == odd.columns
        assert stage(spark, odd, folder).exceptAll(odd).count() == 0
        assert stage(spark, odd.limit(0), folder).count() == 0
    assert corpus_pipeline.packed(spark, odd.limit(0), folder).count() == 0


def test_pipeline_stages(spark):
    folder = f"{ROOT}/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "SimHash near-dedup", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = new_stage_path(spark)
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns and after.exceptAll(docs).count() == 0 and 0 < after.count() < docs.count()
        docs = after
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).select("doc_id").distinct().collect()} == left
    assert not [r for r in simhash.near_duplicates(docs).collect() if r.doc_id != r.component_id]
