"""A training-data pipeline over ``documents``, in stages of the operators in ``docgate.llm``.

Every stage takes all that the stage before kept, written as Parquet and read again. All but the
last return the columns of ``documents``; the last adds the token ids of the text and their count.
Null texts are empty documents for all stages. Rows are kept or dropped as wholes, except for the
third stage, which cuts repeated passages out of texts, and the fourth, which may repeat rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.llm import bpe, mixing, subword_classifier, suffix_dedup, superminhash
from docgate.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
QUALITY = 0.7
SHINGLES = superminhash.Settings(words=5, percent=80, bands=40, rows=5)
MIX = mixing.Settings(keep=0.95)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = subword_classifier.fit(docs, table(spark, sf_dir, "labels"))
    scored = subword_classifier.score(docs.select(*COLUMNS), model, name="_score")
    return scored.where(F.col("_score") >= QUALITY).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    found = superminhash.near_duplicates(docs, SHINGLES)
    dropped = found.where("NOT kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that stand in an earlier place are cut. A character that a cut goes
    through goes as a whole; a document of which nothing is left goes too."""
    keep = ("doc_id", "lang", "source", "n_chars")
    cut = suffix_dedup.cut(docs, keep=keep)
    touched = F.size("removed") > 0
    return (
        cut.where(~touched | (F.length(F.trim("text")) > 0))
        .withColumn("n_chars", F.when(touched, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
        .select(*COLUMNS)
    )


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source, language and form get the tempered shares: documents of what there is too little of
    come several times, with the same id."""
    return mixing.repeated(docs.select(*COLUMNS), MIX).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode(docs.select(*COLUMNS), path).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing", mixed),
    ("BPE encoding", encoded),
]

# The first three stages have no SQL; tests compare the run with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
