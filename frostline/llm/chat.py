"""Chat formatting: logged snapshots of a growing conversation collapse to the longest one, which is rendered.

A conversation's prefix of k turns has a rolling hash: the sum of hashes of its first k (position, role, text). A conversation
that equals a prefix of a longer one is dropped by an anti-join on (k, hash); of equal ones the smallest id stays.
Positions and sums run over blocks of turns and then over block totals, so a long conversation isn't one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.session import stage

BLOCK = 256  # turn numbers of a block


def _part(seed: int) -> Column:
    """Hash of a turn at its place; the sum over turns depends on all of them and on their order."""
    return F.xxhash64(F.lit(seed), "pos", F.col("role").isNull(), "role", F.col("text").isNull(), "text").cast("decimal(20,0)")


def positions(turns: DataFrame, values: list[str], block: int = BLOCK) -> DataFrame:
    """``turns`` with the running sum of each of ``values`` (decimal) per ``conv_id`` in the order of ``turn, role, text``."""
    t = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / block), F.lit(-(1 << 62))))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = t.groupBy("conv_id", "block").agg(*[F.sum(v).alias(f"{v}_all") for v in values])
    carried = totals.select("conv_id", "block", *[F.coalesce(F.sum(f"{v}_all").over(before), F.lit(0)).alias(f"{v}_before") for v in values])
    run = t.select("*", *[F.sum(v).over(inside).alias(f"{v}_run") for v in values])
    joined = run.join(carried, [run["conv_id"].eqNullSafe(carried["conv_id"]), run["block"] == carried["block"]]).drop(carried["conv_id"], carried["block"])
    sums = {f"{v}_run": (F.col(f"{v}_run") + F.col(f"{v}_before")) for v in values}
    return joined.withColumns(sums).drop("block", *[f"{v}_before" for v in values])


def maximal(conversations: DataFrame) -> DataFrame:
    """The turns of conversations that are no prefix of another: ``conv_id, pos, turns, role, text``.

    Turns are ordered by ``turn``, then role and text; repeated rows of a conversation count once. ``pos`` counts from 1,
    ``turns`` is the conversation's length. Null role, text or turn are values like others (null turns come first); rows
    without ``conv_id`` belong to no conversation and go. Of equal conversations the smallest ``conv_id`` stays.
    """
    plain = conversations.where("conv_id is not null").select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    turns = plain.distinct().withColumn("one", F.lit(1).cast("decimal(20,0)"))
    placed = positions(turns, ["one"]).withColumn("pos", F.col("one_run").cast("long")).drop("one", "one_run")
    hashed = stage(placed.withColumn("h1", _part(1)).withColumn("h2", _part(2)))
    modulus = F.lit("18446744073709551616").cast("decimal(20,0)")
    rolling = positions(hashed.select("conv_id", "turn", "role", "text", "pos", "h1", "h2"), ["h1", "h2"])
    rolled = stage(rolling.select("conv_id", "pos", (F.col("h1_run") % modulus).cast("decimal(20,0)").alias("a"), (F.col("h2_run") % modulus).cast("decimal(20,0)").alias("b")))
    length = rolled.groupBy("conv_id").agg(F.max("pos").alias("turns"))
    ends = stage(rolled.join(length, "conv_id").where("pos = turns").select("conv_id", "turns", "a", "b"))
    inner = rolled.join(ends.select("conv_id", F.col("turns").alias("n")), "conv_id").where("pos < n").select(F.col("pos").alias("turns"), "a", "b").distinct()
    one = ends.groupBy("turns", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    kept = one.join(inner, ["turns", "a", "b"], "left_anti").select("conv_id", "turns")
    return hashed.join(kept, "conv_id").select("conv_id", "pos", "turns", "role", "text")


def render(turns: DataFrame, start: str = "<|start|>", middle: str = "\n", end: str = "<|end|>\n") -> DataFrame:
    """Each turn as a segment of the training text: ``conv_id, pos, turns, role, segment, bears_loss``.

    A conversation's text is its segments by ``pos``. Assistant turns bear loss; null role and text are empty.
    """
    role = F.coalesce("role", F.lit(""))
    segment = F.concat(F.lit(start), role, F.lit(middle), F.coalesce("text", F.lit("")), F.lit(end))
    return turns.select("conv_id", "pos", "turns", role.alias("role"), segment.alias("segment"), (role == "assistant").alias("bears_loss"))


ORACLE = """
WITH plain AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS turns,
    md5(string_agg(concat(coalesce('+' || role, '-'), chr(30), coalesce('+' || text, '-'), chr(31)), '') OVER w) AS prefix
  FROM plain WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ends AS (SELECT turns, prefix, min(conv_id) AS conv_id FROM placed WHERE pos = turns GROUP BY turns, prefix),
kept AS (SELECT conv_id FROM ends e WHERE NOT EXISTS (SELECT 1 FROM placed p WHERE p.pos = e.turns AND p.prefix = e.prefix AND p.pos < p.turns))
SELECT conv_id, pos, turns, coalesce(role, '') AS role,
  concat('<|start|>', coalesce(role, ''), chr(10), coalesce(text, ''), '<|end|>', chr(10)) AS segment,
  coalesce(role, '') = 'assistant' AS bears_loss
FROM placed JOIN kept USING (conv_id)
"""
