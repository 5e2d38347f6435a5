"""Keyword search over the chunk table, for one query or a table of questions.

A chunk table has ``doc_id, chunk_no, chunk_text, source_url``. Several chunks may share
``doc_id, chunk_no`` (messages without a trace id do); they are different chunks, and ties between
them are ordered by a hash of their text. Question tables have ``question_id, question``.

Scale notes. The single-query forms are one scan with a bounded top-k. In the batch forms what is
broadcast is a table of question words, after it has been measured; above the limit the same
expressions run on a shuffled join, so the rows are the same. Every top-k is cut to k rows per
question inside each map task before the rows are exchanged, so a question matching a third of
the corpus still sends k rows per task, and these meet in lanes, not all in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgate.functions.strict_json import ROOT
from docgate.functions.terms import terms, tokens
from docgate.operators.gate import keep, with_syntax
from docgate.operators.scoring import BM25_B, BM25_K1, UNIT, best
from docgate.operators.sizing import BROADCAST_LIMIT, fits_broadcast, row_bytes
from docgate.session import reliable, scratch, stored

DEFAULT_TOP_K = 5

_KEY = ("doc_id", "chunk_no")
_LANES = 64
# Parts of a table of questions that one task lays out.
_LANE_PARTS = 256


def _check_top_k(top_k: int) -> None:
    if top_k < 1:
        raise ValueError(f"top_k must be at least 1, got {top_k}")


def _first(found: DataFrame, top_k: int) -> DataFrame:
    """The first ``top_k`` hits in key order; a top-k operator, not a sort of all hits."""
    ordered = found.orderBy(*_KEY, F.xxhash64("chunk_text")).limit(top_k)
    return ordered.select(*_KEY, "chunk_text", "source_url")


def search_all_terms(chunks: DataFrame, query: str, top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """Chunks that contain every word of the query."""
    _check_top_k(top_k)
    spark = chunks.sparkSession
    wanted = spark.range(1).select(terms(F.lit(query)).alias("t")).first()["t"]
    if not wanted:
        return _first(chunks.where(F.lit(False)), top_k)
    lowered = F.lower("chunk_text")
    # The substring test is implied by the word test and far cheaper, so it goes first.
    likely = reduce(and_, [F.contains(lowered, F.lit(w)) for w in wanted])
    missing = F.array_except(F.array(*[F.lit(w) for w in wanted]), tokens(F.col("chunk_text")))
    return _first(chunks.where(likely & (F.size(missing) == 0)), top_k)


def search_any_word(
    chunks: DataFrame, query: str, top_k: int = DEFAULT_TOP_K, max_words: int | None = None
) -> DataFrame:
    """Chunks that contain one of the query's words (of the first ``max_words``, if given)
    anywhere, also inside a word."""
    _check_top_k(top_k)
    lowered = F.lower("chunk_text")
    hits = [F.contains(lowered, F.lower(F.lit(w))) for w in query.split()[:max_words]]
    return _first(chunks.where(reduce(or_, hits) if hits else F.lit(False)), top_k)


def search_chunks(
    chunks: DataFrame, query: str, top_k: int = DEFAULT_TOP_K, mode: str = "all_terms"
) -> DataFrame:
    """Search result as returned to a caller: ``doc_id, chunk_text, source_url``."""
    if mode not in ("all_terms", "any_word"):
        raise ValueError(f"mode must be 'all_terms' or 'any_word', got {mode!r}")
    search = search_all_terms if mode == "all_terms" else search_any_word
    return search(chunks, query, top_k).select("doc_id", "chunk_text", "source_url")


def _top(hits: DataFrame, keys: list[str], order: Sequence[Column | str], top_k: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return hits.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top_k)


def _ranked(hits: DataFrame, order: Sequence[Column | str], top_k: int) -> DataFrame:
    """Number the hits of each question from 1 and keep the first ``top_k``.

    Spark cuts each map task's rows to ``top_k`` per question before it exchanges them. With very
    many map tasks that is still a lot for one question, so the tasks are merged in lanes first,
    and the lanes' winners after that.
    """
    lanes = hits.withColumn("lane", F.spark_partition_id() % _LANES)
    winners = _top(lanes, ["question_id", "lane"], order, top_k).drop("lane", "rank")
    return _top(winners, ["question_id"], order, top_k)


def _question_terms(questions: DataFrame) -> DataFrame:
    """``question_id, wanted`` for questions with at least one word."""
    words = questions.select("question_id", terms(F.col("question")).alias("wanted"))
    return words.where(F.size("wanted") > 0)


def corpus_stats(chunks: DataFrame) -> DataFrame:
    """Word statistics of the whole corpus: ``term, n_chunks, n_words``.

    ``n_chunks`` is the number of chunks with the word and ``n_words`` their total length. The row
    with the empty term describes the corpus itself: every chunk is counted under it. Summed up
    inside the map tasks, so a word found everywhere is one row of each. May be stored and passed
    to the searches below, for any questions.
    """
    worded = chunks.select(tokens(F.col("chunk_text")).alias("words"))
    each = worded.select(
        F.size("words").alias("length"),
        F.explode(F.array_append(F.array_distinct("words"), "")).alias("term"),
    )
    return each.groupBy("term").agg(
        F.count("*").alias("n_chunks"), F.sum("length").alias("n_words")
    )


def _anchored(questions: DataFrame, stats: DataFrame) -> DataFrame:
    """``question_id, wanted, term``: a question with its words and the rarest of them."""
    each = _question_terms(questions).select("question_id", F.explode("wanted").alias("term"))
    rarity = F.struct(F.coalesce("n_chunks", F.lit(0)), "term")
    return (
        each.join(stats, "term", "left")
        .groupBy("question_id")
        .agg(F.collect_list("term").alias("wanted"), F.min(rarity).alias("rarest"))
        .select("question_id", "wanted", F.col("rarest.term").alias("term"))
    )


def search_batch(
    chunks: DataFrame,
    questions: DataFrame,
    top_k: int = DEFAULT_TOP_K,
    carry: tuple[str, ...] = (),
    broadcast_limit: int = BROADCAST_LIMIT,
    stats: DataFrame | None = None,
) -> DataFrame:
    """For every question the first ``top_k`` chunks that contain all its words.

    Returns ``question_id, rank, doc_id, chunk_no`` and the chunk columns named in ``carry``.
    A question meets a chunk through its rarest word only, and the other words are tested on the
    spot. With too many questions to broadcast, the chunk's rows under such words are exchanged.
    """
    _check_top_k(top_k)
    anchored = reliable(_anchored(questions, corpus_stats(chunks) if stats is None else stats))
    # Conditions on ``all_words`` accept NULL: else Spark infers that it is not NULL and checks
    # that by splitting every chunk into words once more, further down.
    each = chunks.select(
        *_KEY, *carry, F.xxhash64("chunk_text").alias("_id"), tokens(F.col("chunk_text")).alias("all_words")
    ).withColumn("term", F.explode(F.array_distinct("all_words")))
    if fits_broadcast(anchored, broadcast_limit, F.octet_length(F.array_join("wanted", " "))):
        met = each.join(F.broadcast(anchored), "term")
    else:
        words = anchored.select("term").distinct()
        if fits_broadcast(words, broadcast_limit, F.octet_length("term")):
            each = each.join(F.broadcast(words), "term", "left_semi")
        met = each.join(anchored.hint("merge"), "term")
    hits = met.where(
        F.coalesce(F.size(F.array_except("wanted", "all_words")) == 0, F.lit(False))
    ).select("question_id", *_KEY, "_id", *carry)
    return _ranked(hits, [*_KEY, "_id"], top_k).select("question_id", "rank", *_KEY, *carry)


# Any white space as a question is split at it, beyond what the pattern language takes for it.
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"
_GRAM = 3
# Chunks, the first in key order, that are searched before the whole corpus is.
_HEAD = 2048


def _grams(text: Column, length: int) -> Column:
    """Distinct substrings of a length; a look-ahead at every character takes linear time."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{length}}}))"), F.lit(1)))


def _parts(text: Column, lengths: Sequence[int]) -> Column:
    return reduce(F.concat, [_grams(text, n) for n in lengths])


def _word_grams(words: DataFrame) -> DataFrame:
    """``word, gram``: the grams of a word; one shorter than a gram is its own."""
    whole = F.length("word") <= _GRAM
    grams = F.when(whole, F.array("word")).otherwise(_grams(F.col("word"), _GRAM))
    return words.select("word", F.explode(grams).alias("gram"))


def _rarest_gram(chunks: DataFrame, grams: DataFrame, lengths: Sequence[int], limit: int) -> DataFrame:
    """``word, gram``: each word with that of its grams that the fewest chunks hold."""
    asked = grams.select("gram").distinct()
    asked = F.broadcast(asked) if fits_broadcast(asked, limit, F.octet_length("gram")) else asked
    held = chunks.select(F.explode(_parts(F.lower("chunk_text"), lengths)).alias("gram"))
    counts = held.join(asked, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)), "gram")
    rarest = grams.join(counts, "gram", "left").groupBy("word").agg(F.min(rarity).alias("rarest"))
    return rarest.select("word", F.col("rarest.gram").alias("gram"))


def search_any_word_batch(
    chunks: DataFrame,
    questions: DataFrame,
    top_k: int = DEFAULT_TOP_K,
    carry: tuple[str, ...] = (),
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """For every question the first ``top_k`` chunks with one of its words anywhere, also inside a
    word. Returns ``question_id, rank, doc_id, chunk_no`` and the chunk columns named in ``carry``.

    Chunks are searched for the distinct words of all questions. A word meets a chunk through one
    gram, the rarest of its grams of three characters in the corpus, and is verified on the spot;
    words of one or two characters are grams themselves. The first k chunks of a question are among
    the first k of its words, so only these are brought to the questions: a word that is in every
    chunk and every question costs k rows for each. Grams are exchanged only where the words are too
    many to broadcast.

    Frequent words are settled early: one with k hits among the first chunks in key order has its
    first k there. The whole corpus is searched for the others, so that the hits to be ordered are
    those of words which are rare among the first chunks.
    """
    _check_top_k(top_k)
    split = F.array_distinct(F.transform(F.split("question", _SPACE), F.lower))
    asked = questions.select("question_id", F.explode(split).alias("word")).where("word <> ''")
    words = reliable(asked.select("word").distinct())
    order = [*_KEY, "_id"]
    needed = list(dict.fromkeys([*_KEY, *carry, "chunk_text"]))
    chunks = chunks.select(*needed, F.xxhash64("chunk_text").alias("_id"))
    head = reliable(chunks.orderBy(*order).limit(_HEAD))
    head = head.repartition(chunks.sparkSession.sparkContext.defaultParallelism)
    early = reliable(_first_of_words(head, words, top_k, carry, broadcast_limit))
    settled = early.where(F.col("rank") == top_k).select("word")
    late = _first_of_words(chunks, words.join(settled, "word", "left_anti"), top_k, carry, broadcast_limit)
    first = early.join(settled, "word", "left_semi").unionByName(late)
    # Chunks equal in key and text are hits of their own; two words may find the same ones.
    copies = first.groupBy("word", *order, *carry).agg(F.count("*").alias("n"))
    found = asked.join(copies, "word").groupBy("question_id", *order, *carry).agg(F.max("n").alias("n"))
    each_copy = found.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return _ranked(each_copy, order, top_k).select("question_id", "rank", *_KEY, *carry)


def _first_of_words(
    chunks: DataFrame, words: DataFrame, top_k: int, carry: tuple[str, ...], limit: int
) -> DataFrame:
    """``word, rank``, the chunk's key, ``_id`` and the carried columns of the first ``top_k`` chunks
    that hold a word."""
    grams = reliable(_word_grams(words))
    lengths = sorted(r[0] for r in grams.select(F.length("gram")).distinct().collect())  # at most three
    anchored = reliable(_rarest_gram(chunks, grams, lengths or [_GRAM], limit))
    each = chunks.select(*_KEY, *carry, "_id", F.lower("chunk_text").alias("_lowered")).withColumn(
        "gram", F.explode(_parts(F.col("_lowered"), lengths or [_GRAM]))
    )
    if fits_broadcast(anchored, limit, F.octet_length("word") + F.octet_length("gram")):
        met = each.join(F.broadcast(anchored), "gram")
    else:
        met = each.join(anchored.hint("merge"), "gram")
    order = [*_KEY, "_id"]
    hits = met.where(F.contains("_lowered", F.col("word"))).select(
        F.col("word").alias("question_id"), *order, *carry
    )
    return _ranked(hits, order, top_k).withColumnRenamed("question_id", "word")


def search_ranked(
    chunks: DataFrame | None,
    questions: DataFrame,
    top_k: int = DEFAULT_TOP_K,
    stats: DataFrame | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    counted: DataFrame | None = None,
) -> DataFrame:
    """For every question its ``top_k`` best chunks by BM25; one common word is enough to count.

    ``stats``, if given, is ``corpus_stats`` of the same chunks. The chunks are exchanged once, by
    their identity. Each is scored whole, against all question words, and a task keeps the first k of
    every question: pairs of chunk and question are neither exchanged nor kept. With too many
    questions to broadcast at once, the counted words are stored and scored once for each part of the
    questions that can be. Only a question that takes more than half the limit by itself has its
    counted words and shares exchanged.

    ``counted``, if given with ``stats``, is ``counted_words`` of the same chunks, which are not read
    then (``sources.tables.save_postings``, ``read_postings``). It is not exchanged either.
    """
    _check_top_k(top_k)
    if chunks is None and (counted is None or stats is None):
        raise ValueError("without chunks, both counted words and statistics are needed")
    if stats is None:
        stats = reliable(corpus_stats(chunks))
    corpus = stats.where(F.col("term") == "").first()
    n_chunks, n_words = (corpus["n_chunks"], corpus["n_words"]) if corpus else (0, 0)
    idf = F.expr(f"ln(1D + ({float(n_chunks)!r}D - n_chunks + 0.5D) / (n_chunks + 0.5D))")
    weighted = reliable(
        _question_terms(questions)
        .select("question_id", F.explode("wanted").alias("term"))
        .join(stats, "term")
        .select("question_id", "term", idf.alias("idf"))
    )
    given, counted = counted, counted_words(chunks) if counted is None else counted
    mean_length = max(n_words, 1) / max(n_chunks, 1)
    if fits_broadcast(weighted, broadcast_limit, F.octet_length("term")):
        return _best_ranked(best(counted, weighted, mean_length, top_k), top_k)
    if given is None:
        counted = stored(counted)
    parts, long = _parted(weighted, broadcast_limit)
    found = _best_ranked(_all_totals(counted, weighted if long is None else long, mean_length), top_k)
    if not parts:
        return found
    # One part after the other, so that the words of only one are held at a time.
    spark, answered = weighted.sparkSession, scratch(weighted.sparkSession)
    for part in parts:
        asked = spark.read.schema(weighted.schema).parquet(part)
        _best_ranked(best(counted, asked, mean_length, top_k), top_k).write.mode("append").parquet(answered)
    short = spark.read.schema(found.schema).parquet(answered)
    return short if long is None else short.unionByName(found)


def _best_ranked(totals: DataFrame, top_k: int) -> DataFrame:
    """The ``top_k`` best of every question, from what ``scoring.best`` returns."""
    scored = totals.withColumn("score", F.round(F.col("total") * UNIT, 6))
    # Chunks equal in key and text were scored once and are hits of their own.
    hits = scored.withColumn("_", F.explode(F.array_repeat(F.lit(0), F.least("copies", F.lit(top_k)).cast("int"))))
    ranked = _ranked(hits, [F.col("score").desc(), *_KEY, "_id"], top_k)
    return ranked.select("question_id", "rank", *_KEY, "score")


def _parted(weighted: DataFrame, limit: int) -> tuple[list[str], DataFrame | None]:
    """Whole questions in parts that can be broadcast, each stored in a folder, and what there is of
    questions that take more than half the limit by themselves.

    Questions are laid end to end, and one belongs to the part in which it starts; a part is shorter
    than the limit by the longest of them. What is laid out by one task are sizes of questions.
    """
    size = F.sum(row_bytes(F.octet_length("term")))
    sizes = reliable(weighted.groupBy(F.col("question_id").alias("_of")).agg(size.alias("bytes")))
    fits = F.col("bytes") <= limit // 2
    longest, total, more = sizes.agg(
        F.max(F.when(fits, F.col("bytes"))), F.sum(F.when(fits, F.col("bytes"))), F.count_if(~fits)
    ).first()
    same = F.col("question_id").eqNullSafe(F.col("_of"))
    long = weighted.join(sizes.where(~fits), same, "left_semi") if more else None
    if not total:
        return [], long
    lane = F.expr(f"pmod(xxhash64(_of), {total // (_LANE_PARTS * limit) + 1})")
    before = Window.partitionBy("lane").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    part = F.concat_ws("-", "lane", F.floor(start / F.lit(limit - longest)))
    laid = reliable(sizes.where(fits).withColumn("lane", lane).select("_of", part.alias("part")))
    folder = scratch(weighted.sparkSession)
    each = weighted.join(laid, same).drop("_of").repartition("part")
    each.write.partitionBy("part").parquet(folder)
    names = sorted(r["part"] for r in laid.select("part").distinct().collect())
    return [f"{folder}/part={name}" for name in names], long


def _all_totals(counted: DataFrame, weighted: DataFrame, mean_length: float) -> DataFrame:
    """What ``scoring.best`` returns, for every pair that shares a word, by a merge join."""
    each = counted.select(
        *_KEY, "_id", "copies", "length", F.explode(F.arrays_zip("terms", "tfs")).alias("word")
    ).select("*", F.col("word.terms").alias("term"), F.col("word.tfs").alias("tf"))
    met = each.join(weighted.hint("merge"), "term")
    damping = f"{BM25_K1}D * ({1 - BM25_B}D + {BM25_B}D * length / {mean_length!r}D)"
    share = F.expr(f"CAST(round(idf * tf * {BM25_K1 + 1}D / (tf + {damping}) / {UNIT!r}D) AS BIGINT)")
    return met.groupBy("question_id", *_KEY, "_id", "copies").agg(F.sum(share).alias("total"))


def counted_words(chunks: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per chunk: its distinct words ``terms``, their counts ``tfs``, its ``length`` in words
    and ``copies``, the number of chunks equal in key and text. One exchange, of whole chunks, to as
    many partitions as are asked for."""
    identity = (*_KEY, "_id")
    texts = chunks.where(F.col("chunk_text").isNotNull()).select(
        *_KEY, F.xxhash64("chunk_text").alias("_id"), "chunk_text"
    )
    if partitions is not None:
        texts = texts.repartition(partitions, *identity)
    unique = texts.groupBy(*identity).agg(F.first("chunk_text").alias("text"), F.count("*").alias("copies"))
    worded = unique.select(*identity, "copies", F.array_sort(tokens(F.col("text"))).alias("words"))
    # Equal words stand side by side: a word is counted by where the next one starts.
    starts = F.filter(
        F.transform("words", lambda w, n: F.when((n == 0) | (w != F.get("words", n - 1)), n)),
        lambda n: n.isNotNull(),
    )
    started = worded.select(*identity, "copies", "words", F.size("words").alias("length"), starts.alias("starts"))
    return started.select(
        *identity,
        "copies",
        "length",
        F.transform("starts", lambda n: F.get("words", n)).alias("terms"),
        F.transform(
            "starts", lambda n, at: F.coalesce(F.get("starts", at + 1), F.col("length")) - n
        ).alias("tfs"),
    )


def find_by_trace(messages: DataFrame, trace_id: str) -> DataFrame:
    """``message_id, trace_id`` of all messages that parse as JSON and have the given trace id,
    whether or not they keep to the contract."""
    member = F.expr(f"try_variant_get(_wrapped, '{ROOT}.trace_id', 'string')")
    parsed = with_syntax(messages)
    hit = F.col("_code").isNull() & (member == trace_id)
    return keep(parsed, hit, "message_id", member.alias("trace_id"))
