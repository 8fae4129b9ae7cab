"""Spelling variants: words one edit apart, found by walking a trie that is kept as tables.

The trie has compressed edges: an edge is named by its first letter and holds all letters up to the next fork, which
are the common beginning of the least and the greatest word below it, so each level is one aggregate. Its nodes are
known by the smallest word id below them.

The frontier holds states (word, what is left of it, node, edits). States without an edit walk along the word's own
path; two words one edit apart part at a fork, so an edit is only tried there: a letter of the word is dropped, or
replaced by a greater one (the other direction is the same pair seen from the other word). A state with an edit then
has to match edge after edge, by an equi-join with the edge table of its level, until it ends in a leaf.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.session import stage, unstage

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "\x00"  # no letter, and smaller than every letter


def vocabulary(docs: DataFrame, misspell: int = 199, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """``word, n``: runs of letters of all texts with A-Z in lower case, at least so long and so frequent.

    Of a run whose CRC-32 of ``<doc_id>:<run>`` is divisible by ``misspell`` one letter is left out. Null texts have no
    runs, a null id is an empty text, and repeated rows count each.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"),
    )
    lower = F.when(F.col("run") == F.lower("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER))
    hashed = runs.select("doc", lower.alias("run")).select("run", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    dropped = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    words = hashed.withColumn("at", at).select(F.when(F.col("h") % misspell == 0, dropped).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _first(c: str, at: int = 1):
    return F.substring(c, at, 1)


def _edges(walkers: DataFrame) -> DataFrame:
    """Edges of a level from the words that walk there: ``node, c, label, child, leaf``. A leaf's child is its word's id."""
    letters = "zip_with(split(lo, ''), split(hi, ''), (a, b) -> a <=> b)"
    shared = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.expr(f"substring(lo, 1, cast(array_position({letters}, false) as int) - 1)"))
    return (
        walkers.groupBy("node", _first("rest").alias("c"))
        .agg(F.min("rest").alias("lo"), F.max("rest").alias("hi"), F.min("id").alias("child"), F.count("*").alias("words"))
        .select("node", "c", shared.alias("label"), "child", (F.col("words") == 1).alias("leaf"))
    )


def _skips(edges: DataFrame, below: DataFrame) -> DataFrame:
    """Edges with the letter that follows their first one; of an edge of one letter, with each edge below it."""
    long = edges.where(F.length("label") > 1).select("node", "c", F.col("label").alias("path"), F.col("child").alias("to"), "leaf", F.lit(1).alias("step"))
    b = below.select(F.col("node").alias("child"), F.col("label").alias("more"), F.col("child").alias("to"), F.col("leaf").alias("end"))
    short = (
        edges.where((F.length("label") == 1) & ~F.col("leaf"))
        .join(b, "child")
        .select("node", "c", F.concat("label", "more").alias("path"), "to", F.col("end").alias("leaf"), F.lit(2).alias("step"))
    )
    return long.unionByName(short).withColumn("next", _first("path", 2))


def _edited(walkers: DataFrame, edges: DataFrame, skips: DataFrame) -> DataFrame:
    """States after an edit at a fork: ``id, rest, to, leaf, step``."""
    own = walkers.select("id", "rest", "node", _first("rest").alias("c0"), _first("rest", 2).alias("c1")).where(F.col("c0") != END)
    e = edges.select("node", F.col("c").alias("c1"), "label", F.col("child").alias("to"), "leaf")
    dropped = (
        own.where("c0 <> c1")
        .join(e, ["node", "c1"])
        .where("startswith(substring(rest, 2), label)")
        .select("id", F.expr("substring(rest, 2 + length(label))").alias("rest"), "to", "leaf", F.lit(1).alias("step"))
    )
    s = skips.select("node", F.col("next").alias("c1"), "c", "path", "to", "leaf", "step")
    replaced = (
        own.join(s, ["node", "c1"])
        .where("c > c0 and startswith(substring(rest, 2), substring(path, 2))")
        .select("id", F.expr("substring(rest, 1 + length(path))").alias("rest"), "to", "leaf", "step")
    )
    return dropped.unionByName(replaced)


def _followed(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one edge further, of those whose letters match."""
    s = states.select("id", "rest", "node", _first("rest").alias("c"))
    return (
        s.join(edges, ["node", "c"])
        .where("startswith(rest, label)")
        .select("id", F.expr("substring(rest, 1 + length(label))").alias("rest"), F.col("child").alias("to"), "leaf", F.lit(1).alias("step"))
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b``: ids of all pairs of words that differ by exactly one inserted, deleted or replaced letter, each once.

    ``words`` has ``id, word`` with distinct non-null words and ids. There are as many levels as a word has forks on its
    path; each is staged, so a lost executor costs the tasks of one level.
    """
    walkers = stage(words.select("id", F.concat("word", F.lit(END)).alias("rest"), F.lit(-1).cast("long").alias("node")))
    edges = stage(_edges(walkers))
    made: list[DataFrame] = []
    states: dict[int, list[DataFrame]] = {}
    level = 0
    while not edges.isEmpty():
        inner = edges.where("not leaf").select("node", "c", "label", "child")
        walking = (
            walkers.withColumn("c", _first("rest"))
            .join(inner, ["node", "c"])
            .select("id", F.expr("substring(rest, 1 + length(label))").alias("rest"), F.col("child").alias("node"))
        )
        walking = stage(walking)
        below = stage(_edges(walking))
        out = _edited(walkers, edges, _skips(edges, below))
        for s in states.pop(level, []):
            out = out.unionByName(_followed(s, edges))
        out = stage(out)
        unstage(walkers)
        unstage(edges)
        made.append(out.where("leaf").select(F.col("id").alias("a"), F.col("to").alias("b")))
        for step in (1, 2):
            states.setdefault(level + step, []).append(out.where(f"not leaf and step = {step}").select("id", "rest", F.col("to").alias("node")))
        walkers, edges, level = walking, below, level + 1
    pairs = words.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    for found in made:
        pairs = pairs.unionByName(found)
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """``id, root``: the last word reached from each word that has a form, by doubling the steps."""
    now = stage(forms.select("id", F.col("form_id").alias("root")))
    while True:
        hop = now.select(F.col("id").alias("root"), F.col("root").alias("far"))
        after = stage(now.join(hop, "root", "left").select("id", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        unstage(now)
        now = after.select("id", "root")
        if after.where("moved").isEmpty():
            return now


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``word, n``.

    The form is the most frequent word one edit away (ties: the smallest in code-point order), if it is ``ratio`` times
    as frequent; the root is the last one when forms are followed, the word itself if it has none. A word has at most as
    many neighbours as it has edits, so their group is bounded. Other columns are ignored; empty in, empty out. Words are
    taken as distinct and not null.
    """
    words = stage(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()))
    pairs = near_pairs(words.select("id", "word"))
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("near")))
    named = both.join(words.select(F.col("id").alias("near"), "word", "n"), "near")
    best = named.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "word", "near")).alias("best"))
    known = stage(
        words.join(best, "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best")
        )
    )
    roots = _roots(known.where("best is not null").select("id", F.col("best.near").alias("form_id")))
    last = roots.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return known.join(last, "id", "left").select(
        "word", F.col("best.word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", (-F.col("best.less")).alias("form_n")
    )
