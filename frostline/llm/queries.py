"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.llm import bestfit, chat, nearest, outliers, packing, pieces, ppm, quality, simhash, spelling, toxicity, warc, whitening
from frostline.llm.text import fold


#: Fixed value: the special token of the byte-level vocabulary.
END_OF_TEXT = (("<|endoftext|>", 50256),)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_bpe() -> Callable:
    """Ids of the public byte-level BPE vocabulary; the encoder is made in the worker."""
    import public_tokenizers

    path, pattern = _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return lambda texts: packing.encoder(path, pattern, END_OF_TEXT)(texts)


def word_bpe() -> Callable:
    """Ids of the public word BPE vocabulary; the encoder is made in the worker."""
    path = _tokenizer("word_bpe_49k.json")
    return lambda texts: bestfit.encoder(path)(texts)


def op1_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(_table(spark, sf_dir, "documents"))


def _classified(spark: SparkSession, sf_dir: str, operator, threshold: float) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = operator.train(docs, labels.where(fold("doc_id", 3) != 1))
    return operator.score(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, quality, 0.5)


def op3_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(chat.maximal(_table(spark, sf_dir, "conversations")))


def op4_projected_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = outliers.judge(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op6_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, toxicity, 0.7)


def op7_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), byte_bpe(), end_id=1)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op9_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(_table(spark, sf_dir, "documents")))


def op12_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(_table(spark, sf_dir, "documents"), word_bpe(), end_id=1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ppm_score,
        op2_quality_fm,
        op3_chat_collapse,
        op4_projected_kdtree,
        op5_mcd_outliers,
        op6_toxicity_fm,
        op7_vector_packing,
        op8_sampled_pieces,
        op9_simhash_gray,
        op10_warc_chain,
        op11_spelling_trie,
        op12_cholesky_whitening,
        op13_swap_packing,
    )
}

ORACLE: dict[str, str] = {"op3_chat_collapse": chat.ORACLE}
