"""Connected components of a table of links, without bringing links or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgate.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """From rows (a, b) to rows (node, component), the smallest node that can be reached.

    In each round every node hooks onto its smallest neighbour, hooks are followed twice, and the
    links between the hooked ends that are left go to the next round. A node that is larger than
    one of its neighbours disappears, so the links shrink quickly. Minima are combined before the
    shuffle, so a node with very many links is no hot spot; each round is a table in the shared
    folder. Links with a null end are ignored.
    """
    smaller, larger = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    pairs = written(links.where("a <> b").select(smaller, larger).distinct(), "links")
    labels = None
    while not pairs.isEmpty():
        ends = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("hook"))
        hooks = written(hooks.withColumn("hook", F.least("node", "hook")), "hooks")
        hooks = written(_followed(_followed(hooks)), "hooks")
        labels = hooks.toDF("node", "component") if labels is None else written(
            _relabelled(labels, "component", hooks), "labels"
        )
        moved = _relabelled(_relabelled(pairs, "a", hooks), "b", hooks).where("a <> b")
        pairs = written(moved.select(smaller, larger).distinct(), "links")
    return pairs.toDF("node", "component") if labels is None else labels


def _relabelled(rows: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """Replace a column's nodes by what they hook onto; others stay."""
    by = hooks.select(F.col("node").alias(column), F.col("hook").alias("_hook"))
    new = F.coalesce("_hook", column).alias(column)
    names = [new if c == column else F.col(c) for c in rows.columns]
    return rows.join(by, column, "left").select(*names)


def _followed(hooks: DataFrame) -> DataFrame:
    onward = hooks.toDF("hook", "_next")
    return hooks.join(onward, "hook", "left").select("node", F.coalesce("_next", "hook").alias("hook"))
