"""Scoring answers, and what follows from the scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: scores below this one call for action.
THRESHOLD = 0.8
LOW_SCORE = "score below threshold"
NEW_DOCUMENTS = "new documents"


def evaluate_answers(answers: DataFrame) -> DataFrame:
    """Add ``matched_terms`` (expected terms found in the answer, any case) and ``score``.

    Order and repeats of the expected terms are kept. Without expected terms the score is 1.
    """
    lowered = answers.withColumn("_answer", F.lower("answer"))
    matched = lowered.withColumn(
        "matched_terms",
        F.filter("expected_terms", lambda t: F.contains(F.col("_answer"), F.lower(t))),
    ).drop("_answer")
    return matched.withColumn(
        "score",
        F.when(F.size("expected_terms") == 0, F.lit(1.0)).otherwise(
            F.size("matched_terms") / F.size("expected_terms")
        ),
    )


def suggest_improvements(evaluated: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``title, detail`` for every answer scored below the threshold.

    A term is missing if the answer does not contain it. That is tested term by term on the answer:
    a look into ``matched_terms`` would match all terms anew for each term, as the optimizer puts the
    whole match into the condition.
    """
    lowered = evaluated.where(F.col("score") < threshold).withColumn("_answer", F.lower("answer"))
    holds = lambda t: F.coalesce(F.contains(F.col("_answer"), F.lower(t)), F.lit(False))
    missing = F.filter("expected_terms", lambda t: t.isNotNull() & ~holds(t))
    return lowered.select(
        F.concat(F.lit("Improve answer coverage for: "), "question").alias("title"),  # fixed text
        F.concat(F.lit("Missing terms: "), F.array_join(missing, ", ")).alias("detail"),  # fixed text
    )


def metric_records(evaluated: DataFrame, run_id: str) -> DataFrame:
    """Rows of the metrics table."""
    return evaluated.select(
        F.lit(run_id).alias("run_id"),
        "question",
        "score",
        F.current_timestamp().alias("created_at"),
    )


def retraining_signals(
    evaluated: DataFrame, new_sources: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """One signal per low score, and one (without score) per distinct ``source`` of new documents."""
    low = evaluated.where(F.col("score") < threshold).select(
        F.lit(LOW_SCORE).alias("reason"), F.col("question").alias("source"), "score"
    )
    fresh = new_sources.select("source").distinct().select(
        F.lit(NEW_DOCUMENTS).alias("reason"), "source", F.lit(None).cast("double").alias("score")
    )
    return low.unionByName(fresh).withColumn("created_at", F.current_timestamp())


def content_snapshot(docs: DataFrame) -> DataFrame:
    """What to remember of a state of the documents: ``doc_id, source, content`` (a hash). One row
    for each distinct content of an id; a null text is a content of its own."""
    return docs.select("doc_id", "source", F.coalesce(F.md5("text"), F.lit("null")).alias("content")).distinct()


def fresh_documents(previous: DataFrame, current: DataFrame) -> DataFrame:
    """``doc_id, source, change`` of the documents that are ``new`` or ``changed`` since an earlier
    snapshot. Both are ``content_snapshot`` tables, so ids and hashes are exchanged and no texts. An
    id with several contents is changed as soon as one of them is not known; ids may be null.
    """
    known = previous.groupBy("doc_id").agg(F.collect_set("content").alias("_known"))
    now = current.alias("c").join(known.alias("p"), F.expr("c.doc_id <=> p.doc_id"), "left")
    change = F.when(F.col("_known").isNull(), F.lit("new")).when(
        ~F.array_contains("_known", F.col("content")), F.lit("changed")
    )
    return now.select("c.doc_id", "source", change.alias("change")).where("change IS NOT NULL").distinct()


def fresh_sources(fresh: DataFrame) -> DataFrame:
    """``source, n_new, n_changed`` for the sources of fresh documents; each is a reason to retrain."""
    count = lambda kind: F.count_if(F.col("change") == kind)
    return fresh.groupBy("source").agg(count("new").alias("n_new"), count("changed").alias("n_changed"))


def signal_json(signals: DataFrame) -> DataFrame:
    """Add ``body``: the signal as JSON with a null score written out."""
    columns = [c for c in ("reason", "source", "score", "created_at") if c in signals.columns]
    return signals.withColumn(
        "body", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    )
