"""The corpus pipeline: quality classifier, quality rules, near-duplicates, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.llm import outliers, packing, quality, simhash
from frostline.llm.queries import byte_bpe
from frostline.llm.text import fold
from frostline.session import new_stage_path


def _kept(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` with a ``doc_id`` among ``ids``; a null id is an id like others."""
    chosen = ids.select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good; labels of the corpus that are not held out teach it."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels.where(fold("doc_id", 3) != 1))
    return _kept(docs, quality.score(docs, model).where("score >= 0.5"))


def regular_form(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are no outliers of their language and source."""
    return _kept(docs, outliers.judge(docs).where("kept"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (three-word shingles) link at 2 bits, that with the smallest id."""
    return simhash.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs, byte_bpe(), end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("quality rules", regular_form),
    ("SimHash near-dedup", one_per_group),
    ("packing", packed),
]

ORACLE_SQL = None  # a learned classifier, a tokenizer and a placement heuristic have no SQL; tests/llm compares the stages with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's rows are written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = new_stage_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
