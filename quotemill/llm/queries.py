"""Registered queries of the operators in this subpackage, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import (attention_lm, bpe, chat_format, collocations, imatch, importance, knn_tree, lang_id, minhash_join,
                           mixing, suffix_dedup, url_filter, weak_quality)
from quotemill.llm.common import in_partitions, table


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return imatch.fingerprint_edits(in_partitions(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of every conversation paired with its answer-swapped twin."""
    chosen, rejected = chat_format.swapped_answers(table(spark, sf_dir, "conversations"))
    return chat_format.preference_segments(chosen, rejected)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    import public_tokenizers

    docs = in_partitions(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"))


def op6_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under the unigram and the attention model."""
    return attention_lm.score(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = in_partitions(docs).withColumn("held_out", lang_id.remainder(F.col("doc_id"), 4) == 2)
    model = lang_id.train(docs.where("not held_out"))
    out = lang_id.predict(docs, model, ("doc_id", "held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 400 bytes."""
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
                      F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))


def op9_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page."""
    out = url_filter.judge(table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return knn_tree.search(rows, rows.where("vec_id % 20 = 0"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark texts."""
    docs = in_partitions(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return importance.resample(docs, table(spark, sf_dir, "benchmark"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of every document."""
    out = weak_quality.judge(in_partitions(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return collocations.mine(in_partitions(table(spark, sf_dir, "documents").select("lang", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_imatch, op2_preference_format, op3_source_mix, op4_bpe, op5_near_duplicates,
        op6_attention, op7_language, op8_repeats, op9_url_verdicts, op10_nearest, op11_importance,
        op12_quality, op13_collocations)}
