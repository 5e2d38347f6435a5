"""Grounded prompts: the retrieved chunks and the question as one text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the answer given when nothing was retrieved.
NO_CONTEXT_ANSWER = "I don't have enough information — no relevant chunks found."


def rag_prompts(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per question: ``question_id, question, prompt, prompt_len, fixed_answer``.

    ``hits`` is a search result with ``question_id, rank, source_url, chunk_text``. A question has
    at most top-k hits, so its context is small whatever the corpus. Without hits the prompt is
    NULL and the fixed answer is set.
    """
    block = F.concat(F.lit("["), "source_url", F.lit("]\n"), "chunk_text")
    ordered = F.array_sort(F.collect_list(F.struct("rank", block.alias("block"))))
    contexts = hits.groupBy("question_id").agg(
        F.array_join(ordered["block"], "\n\n").alias("context")
    )
    prompt = F.concat(F.lit("Context:\n"), "context", F.lit("\n\nQuestion: "), "question")
    return (
        questions.join(contexts, "question_id", "left")
        .withColumn("prompt", prompt)
        .select(
            "question_id",
            "question",
            "prompt",
            F.length("prompt").alias("prompt_len"),
            F.when(F.col("prompt").isNull(), F.lit(NO_CONTEXT_ANSWER)).alias("fixed_answer"),
        )
    )
