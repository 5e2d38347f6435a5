"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The token shares of the cells are raked:
scaled to the targets of the sources, then of the languages, then of the topics, again and again.
A target is the margin's own share to the power ``temper``, normed, so large margins give way to
small ones. The quotient of fitted and present share is a cell's weight; a document is sampled with
the weight times a factor, at most one, and the factor is calibrated so that the expected tokens
are ``keep`` of all. The draw is a hash of the id, so it is the same in every run.

Where a chance is cut at one, ``sample`` stays short of the targets. ``repeated`` reaches them at any
``keep``: a document comes ``weight * keep`` times, as whole copies and one draw for the rest.

Only DataFrame operations are used. Work on documents is one aggregation and one join with the
cells; raking works on the table of cells, whose rows are spread by margin. Spark broadcasts that
table only where it is small.

Null text has no tokens, null source or language is the empty one. Cells without tokens cost
nothing and are kept whole. Repeated rows share their draw; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgate.llm.common import WORD, free, written

MARGINS = ("source", "lang", "topic")
SPACE = 2.0**32


@dataclass(frozen=True)
class Settings:
    keep: float = 0.8
    temper: float = 0.7
    sweeps: int = 6
    calibrations: int = 6
    seed: int = 5


def tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic(text: str = "text", n_tokens: Column | None = None) -> Column:
    """Documents carry no topic; their form stands in for it: notes of under 60 words, lists with
    a line for every 25 words or fewer, and prose."""
    n = tokens(text) if n_tokens is None else n_tokens
    lines = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1
    return F.when(n < 60, "note").when(lines * 25 >= n, "list").otherwise("prose")


def placed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the cell they are in and their tokens, in columns of their own; columns
    of these names are an error, also those that ``sample`` and ``repeated`` append."""
    free(docs, "_tokens", *(f"_{m}" for m in MARGINS), "_weight", "_probability", "_sampled", "_expected", "_copy")
    n = tokens(text)
    return docs.withColumn("_tokens", n).withColumns(
        {
            "_source": F.coalesce("source", F.lit("")),
            "_lang": F.coalesce("lang", F.lit("")),
            "_topic": topic(text, F.col("_tokens")),
        }
    )


def raked(cells: DataFrame, s: Settings) -> DataFrame:
    """Cells (source, lang, topic, tokens) with their present and their fitted share."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    rows = cells.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    for margin in MARGINS:
        sums = rows.groupBy(margin).agg(F.pow(F.sum("share"), F.lit(s.temper)).alias("goal"))
        norm = sums.agg(F.sum("goal")).first()[0] or 1.0
        rows = rows.join(sums.withColumn("goal", F.col("goal") / norm), margin)
        rows = rows.withColumnRenamed("goal", f"goal_{margin}")
    rows = written(rows.withColumn("fitted", F.col("share")), "cells")
    for _ in range(s.sweeps):
        for margin in MARGINS:
            reached = F.sum("fitted").over(Window.partitionBy(margin))
            rows = rows.withColumn("fitted", F.col("fitted") * F.col(f"goal_{margin}") / reached)
        rows = written(rows, "cells")
    return rows.select(*MARGINS, "tokens", "share", "fitted")


def probabilities(cells: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Cells (source, lang, topic, tokens) with the probability of their documents."""
    rows = raked(cells, s).withColumn("weight", F.col("fitted") / F.col("share"))
    rows = written(rows, "weights")
    wanted = s.keep * (rows.agg(F.sum("tokens")).first()[0] or 0)
    factor = s.keep
    for _ in range(s.calibrations):
        full = F.col("weight") * F.lit(factor) >= 1
        sure, open_ = rows.agg(
            F.sum(F.when(full, F.col("tokens"))),
            F.sum(F.when(~full, F.col("weight") * F.col("tokens"))),
        ).first()
        if not open_:
            break
        factor = (wanted - (sure or 0)) / open_
    chance = F.least(F.lit(1.0), F.col("weight") * F.lit(float(factor)))
    return rows.select(*MARGINS, "weight", chance.alias("probability"))


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), doc_id.cast("string"))), 1, 8)
    return F.coalesce(F.conv(digits, 16, 10).cast("double") / SPACE, F.lit(0.0))


def sample(docs: DataFrame, s: Settings = Settings(), text: str = "text") -> DataFrame:
    """All documents with _source, _lang, _topic, _tokens, _weight, _probability, and _sampled."""
    rows = placed(docs, text)
    names = [f"_{m}" for m in MARGINS]
    cells = written(rows.groupBy(*names).agg(F.sum("_tokens").alias("tokens")), "cells")
    chances = written(probabilities(cells.toDF(*MARGINS, "tokens"), s), "chances").toDF(
        *names, "_weight", "_probability"
    )
    chance = F.coalesce("_probability", F.lit(1.0))
    return rows.join(chances, names, "left").withColumns(
        {"_probability": chance, "_sampled": draw(F.col("doc_id"), s.seed) < chance}
    )


def repeated(docs: DataFrame, s: Settings = Settings(), text: str = "text") -> DataFrame:
    """Documents as often as drawn, with _source, _lang, _topic, _tokens, _weight and _expected, the
    expected number of copies: the expected tokens are ``keep`` of all, in the fitted shares."""
    rows = placed(docs, text)
    names = [f"_{m}" for m in MARGINS]
    cells = written(rows.groupBy(*names).agg(F.sum("_tokens").alias("tokens")), "cells")
    fitted = raked(cells.toDF(*MARGINS, "tokens"), s)
    weights = written(fitted.select(*MARGINS, F.col("fitted") / F.col("share")), "weights")
    expected = F.coalesce(F.col("_weight") * F.lit(s.keep), F.lit(1.0))
    rows = rows.join(weights.toDF(*names, "_weight"), names, "left").withColumn("_expected", expected)
    whole = F.floor("_expected")
    more = draw(F.col("doc_id"), s.seed) < F.col("_expected") - whole
    copies = (whole + more.cast("int")).cast("int")
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy")


def sql(docs: str = "documents", s: Settings = Settings()) -> str:
    """CTEs in DuckDB's SQL whose last one, ``sampled``, is the result of ``sample``."""
    words = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
    lines = r"(length(text) - length(replace(text, chr(10), '')) + 1)"
    ctes = [
        f"counted AS (SELECT *, coalesce({words}, 0) AS _tokens FROM {docs})",
        "placed AS (SELECT *, coalesce(source, '') AS _source, coalesce(lang, '') AS _lang, "
        "CASE WHEN _tokens < 60 THEN 'note' "
        f"WHEN {lines} * 25 >= _tokens THEN 'list' ELSE 'prose' END AS _topic FROM counted)",
        "cells AS (SELECT _source AS source, _lang AS lang, _topic AS topic, "
        "sum(_tokens)::DOUBLE AS tokens FROM placed GROUP BY ALL HAVING sum(_tokens) > 0)",
        "shares AS (SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS share FROM cells)",
    ]
    for m in MARGINS:
        ctes += [
            f"t_{m} AS (SELECT {m}, pow(sum(share), {s.temper}) AS goal FROM shares GROUP BY {m})",
            f"g_{m} AS (SELECT {m}, goal / (SELECT sum(goal) FROM t_{m}) AS goal_{m} FROM t_{m})",
        ]
    joins = " ".join(f"JOIN g_{m} USING ({m})" for m in MARGINS)
    ctes.append(f"fit0 AS MATERIALIZED (SELECT *, share AS fitted FROM shares {joins})")
    n = 0
    for _ in range(s.sweeps):
        for m in MARGINS:
            ctes.append(
                f"fit{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (fitted), "
                f"fitted * goal_{m} / sum(fitted) OVER (PARTITION BY {m}) AS fitted FROM fit{n})"
            )
            n += 1
    ctes += [
        f"weights AS MATERIALIZED (SELECT source, lang, topic, tokens, fitted / share AS weight FROM fit{n})",
        f"factor0 AS (SELECT {s.keep}::DOUBLE AS f)",
    ]
    for k in range(s.calibrations):
        f = f"(SELECT f FROM factor{k})"
        ctes.append(
            f"factor{k + 1} AS MATERIALIZED (SELECT coalesce(({s.keep} * sum(tokens) - coalesce(sum(tokens) "
            f"FILTER (WHERE weight * {f} >= 1), 0)) / sum(weight * tokens) "
            f"FILTER (WHERE weight * {f} < 1), {f}) AS f FROM weights)"
        )
    ctes += [
        "chances AS (SELECT source AS _source, lang AS _lang, topic AS _topic, weight AS _weight, "
        f"least(1.0, weight * (SELECT f FROM factor{s.calibrations})) AS p FROM weights)",
        "joined AS (SELECT *, coalesce(p, 1.0) AS _probability "
        "FROM placed LEFT JOIN chances USING (_source, _lang, _topic))",
        "sampled AS (SELECT *, "
        f"coalesce(('0x' || substr(md5('{s.seed}:' || doc_id::VARCHAR), 1, 8))::BIGINT / {SPACE}, 0) "
        "< _probability AS _sampled FROM joined)",
    ]
    return ",\n".join(ctes)
