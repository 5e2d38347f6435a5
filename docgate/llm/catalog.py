"""The queries of this folder: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.llm import bpe, chat, embedding_dedup, hard_negatives, line_quality, mixing, page_diff
from docgate.llm import subword_classifier, suffix_dedup, superminhash, token_count, warc, whitening
from docgate.llm.common import scratch, table, written

MAX_TOKENS = 2048
QUALITY = 0.7


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "ids",
    )
    return bpe.decode(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_quality.clean_lines(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.round("_probability", 6).alias("probability"),
        F.col("_sampled").alias("sampled"),
    )


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lengths = F.transform("removed", lambda s: s["end"] - s["start"])
    return suffix_dedup.cut(docs).select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_windows(turns.unionByName(added)))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    manifest = warc.write(table(spark, sf_dir, "pages"), folder)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return warc.read(manifest, folder, columns)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = subword_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return subword_classifier.score(docs, model).select(
        "doc_id",
        subword_classifier.held_out().alias("held_out"),
        "score",
        (F.col("score") >= QUALITY).cast("int").alias("predicted"),
    )


def op10_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.main_text(table(spark, sf_dir, "pages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_bpe, op2_token_counts, op3_line_quality, op4_embeddings, op5_mixing, op6_suffix,
        op7_chat, op8_warc, op9_quality, op10_superminhash, op11_page_diff, op12_hard_negatives,
        op13_whitening,
    )
}
ORACLE: dict[str, str] = {
    "op5_mixing": f"WITH {mixing.sql()}\n"
    "SELECT doc_id, _topic AS topic, _tokens AS n_tokens, round(_probability, 6) AS probability, "
    "_sampled AS sampled FROM sampled",
    "op12_hard_negatives": hard_negatives.sql(),
}
