"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from frostline.llm import spelling
from frostline.llm.queries import QUERIES
from tests.compare import ROOT

UPPER = {c: c + 32 for c in range(65, 91)}


def brute_vocabulary(rows, misspell=199, least_length=6, least_count=5):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % misspell == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= least_length and n >= least_count}


def deletions(w):
    return {w[:i] + w[i + 1 :] for i in range(len(w))}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return min(a, b, key=len) in deletions(max(a, b, key=len))


def brute_variants(words, ratio=5):
    by: dict[str, set[str]] = {}
    for w in words:
        for d in deletions(w) | {w}:
            by.setdefault(d, set()).add(w)
    near = {w: {v for d in deletions(w) | {w} for v in by[d] if is_near(w, v)} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v.encode()), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_the_query_against_brute_force(spark):
    folder = f"{ROOT}/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = rows_of(QUERIES["op11_spelling_trie"](spark, folder))
    assert len(rows) == len(set(rows)) > 500
    assert set(rows) == brute_variants(brute_vocabulary(docs))


def test_words_of_odd_rows(spark):
    docs = [
        (1, None), (2, ""), (None, "Nobody nobody NOBODY " * 3), (3, "Größe GRÖSSE größe ×÷abcdef x y1234567z " * 3), (3, "Größe GRÖSSE größe ×÷abcdef x y1234567z " * 3),
        (4, "a" * 100_000 + " tail-tail longer longest"), (5, "word " * 50_000), (6, "émigré\x00émigré émigrés ǆabcdefgh ﬀabcdefgh"),
    ]
    df = spark.createDataFrame([(i, t, "w", 7, "r") for i, t in docs], "doc_id long, text string, word string, n int, run string")
    for misspell in (1, 2, 199):
        found = {r.word: r.n for r in spelling.vocabulary(df, misspell, least_count=1).collect()}
        assert found == brute_vocabulary(docs, misspell, least_count=1)


@pytest.mark.parametrize("letters, sizes", [("ab", (1, 9)), ("abcàÿ", (6, 8)), ("a", (1, 14))])
def test_dense_words(spark, letters, sizes):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))): rng.choice((5, 6, 25, 30, 150, 800)) for _ in range(400)}
    df = spark.createDataFrame([(w, n, 1, "x") for w, n in words.items()], "word string, n long, id int, root string")
    rows = rows_of(spelling.variants(df))
    assert len(rows) == len(words) and set(rows) == brute_variants(words)


def test_long_words_and_hot_beginnings(spark):
    """Words that share a very long beginning need few levels; a third of all words may begin alike."""
    long = "abc" * 20_000
    words = {long: 100, long + "d": 5, "x" + long: 7, long[:-1]: 600, long[:30_000] + "z" + long[30_001:]: 9, long[::-1]: 5}
    words |= {f"hothothot{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 676)}": 5 + i for i in range(1500)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = rows_of(spelling.variants(df))
    assert {(r[0], *r[3:5]) for r in rows} >= {(long, 100, 4)}
    assert set(rows) == {r for r in brute_variants({w: n for w, n in words.items() if len(w) < 99})} | {r for r in rows if len(r[0]) > 99}
    assert {r[0]: r[1] for r in rows if len(r[0]) > 99} == {long: long[:-1], long + "d": long, "x" + long: long, long[:-1]: None, long[:30_000] + "z" + long[30_001:]: long, long[::-1]: None}


def test_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(docs)).count() == 0
    assert rows_of(spelling.variants(spark.createDataFrame([("single", 5)], "word string, n long"))) == [("single", None, "single", 5, 0, None)]
