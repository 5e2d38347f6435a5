"""Chat formatting in budgeted windows.

The turns of a conversation are put in order by ``turn`` (then role and text, for repeated rows),
and prefix sums of their tokens choose the windows. Room is the budget less the tokens of the system
turn (the first turn, if its role is system). Turns that lie between two multiples of three quarters
of the room form a window, a turn across a multiple is one by itself, and goes into the window after
it if both fit into the room. Every window after the first starts with the system turn and with up
to ``history`` turns before it, as many as still fit. So no window passes the budget, unless one turn
with the system turn does; that turn then stands alone with the system turn. Repeated turns are
outside the loss mask; every assistant turn is inside it exactly once, in the window it belongs to.

Prefix sums are taken over ranges of the sorted rows with a carry from range to range, so a
conversation of any length is spread over tasks; its system turn is looked up under several salts. A
window is put together in one task; its size is bounded by the budget and the longest turn.

Template: ``<s>[INST]role[/INST]text</s>`` for each turn. A control string inside a role or text
gets one more backslash after its first character, which is taken away again on reading.

Null texts and roles are empty, a null turn comes first, and rows without ``conv_id`` form one
conversation without id. Other columns are not used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgate.llm.common import WORD, written

BUDGET = 1024
SALTS = 16
HISTORY = 2
NO_ID = -(2**63)

# The template's control strings, and what is put between them.
OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
_CONTROL = r"(?=/?(?:s>|INST\]))"
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _CONTROL)


def escape(text: Column) -> Column:
    """One more backslash inside everything that reads like a control string, escaped or not."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def ordered(turns: DataFrame, tokens: Column) -> DataFrame:
    """Turns with their position in the conversation, their tokens, those before them, and those of
    the conversation's system turn (0 if it has none)."""
    key = F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv_id")
    rows = turns.select(
        key, F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ranges = rows.withColumn("tokens", tokens.cast("long")).repartitionByRange(
        "conv_id", "turn", F.xxhash64("role", "text")
    )
    ranges = written(ranges.withColumn("range", F.spark_partition_id()), "turns")
    rank = F.struct("turn", F.xxhash64("role", "text"), "role", "text")
    sums = ranges.groupBy("conv_id", "range").agg(
        F.count("*").alias("n"), F.sum("tokens").alias("sum"),
        F.min_by(F.struct("role", "tokens"), rank).alias("first"),
    )
    head = F.first("first").over(
        Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    )
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = sums.select(
        "conv_id", "range",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("sum_before"),
        F.when(head["role"] == "system", head["tokens"]).otherwise(0).alias("system_tokens"),
    )
    inside = Window.partitionBy("conv_id", "range").orderBy(
        F.col("turn").asc_nulls_first(), F.xxhash64("role", "text"), "role", "text"
    )
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.select(
        "*",
        (F.row_number().over(inside) - 1).alias("own_n"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("own_sum"),
    )
    return placed.join(carried, ["conv_id", "range"]).select(
        "conv_id", "role", "text", "tokens", "system_tokens",
        (F.col("own_n") + F.col("n_before")).alias("place"),
        (F.col("own_sum") + F.col("sum_before")).alias("tokens_before"),
    )


def in_windows(placed: DataFrame, budget: int) -> DataFrame:
    """Turns with the window they belong to: twice the number of a cell of three quarters of the room,
    and one more for a turn that reaches across the cell's end."""
    room = F.greatest(F.lit(1).cast("long"), F.lit(budget) - F.col("system_tokens"))
    cell = F.greatest(F.lit(1).cast("long"), F.floor(room * 3 / 4))
    is_system = (F.col("place") == 0) & (F.col("role") == "system")
    tokens = F.when(is_system, 0).otherwise(F.col("tokens"))
    start = F.when(is_system, 0).otherwise(F.col("tokens_before") - F.col("system_tokens"))
    last = F.greatest(start, start + tokens - 1)
    crosses = (F.floor(start / cell) != F.floor(last / cell)).cast("long")
    dealt = written(
        placed.withColumns({"room": room, "own": tokens, "window": 2 * F.floor(start / cell) + crosses}),
        "dealt",
    )
    sums = dealt.groupBy("conv_id", "window").agg(
        F.sum("own").alias("sum"), F.first("room").alias("room")
    )
    crossing = sums.where("window % 2 = 1").withColumn("next", F.col("window") + 1)
    after = sums.select("conv_id", F.col("window").alias("next"), F.col("sum").alias("more"))
    moved = crossing.join(after, ["conv_id", "next"]).where("sum + more <= room")
    return dealt.join(moved.select("conv_id", "window", "next"), ["conv_id", "window"], "left").withColumn(
        "window", F.coalesce("next", "window")
    ).drop("next")


def format_windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None
) -> DataFrame:
    """One row per window: conv_id, window (rising, with gaps), formatted, n_tokens (as counted by
    ``tokens``, words and one more for each turn by default; repeated turns included), n_turns,
    n_repeated (turns at its start that stand in earlier windows), loss (spans of code points whose
    tokens are learned)."""
    if tokens is None:
        tokens = F.regexp_count("text", F.lit(WORD)) + 1
    placed = written(in_windows(ordered(turns, tokens), budget), "placed")
    columns = ["conv_id", "window", "place", "role", "text", "tokens"]
    later = (
        placed.groupBy("conv_id", "window")
        .agg(
            F.min("place").alias("first"), F.min("tokens_before").alias("before"),
            F.sum("own").alias("sum"), F.first("room").alias("room"),
        )
        .where("first > 0")
        .withColumnRenamed("window", "into")
    )
    # The system turn stands first, so it is no part of the history.
    is_system = (F.col("place") == 0) & (F.col("role") == "system")
    systems = placed.where(is_system).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    )
    salted = later.withColumn("salt", F.pmod(F.xxhash64("into"), F.lit(SALTS).cast("long")))
    repeated = [systems.join(salted.select("conv_id", "salt", "into"), ["conv_id", "salt"])]
    if history:
        nearest = later.withColumn(
            "place", F.explode(F.sequence(F.greatest(F.lit(0), F.col("first") - history), F.col("first") - 1))
        ).select("conv_id", "place", "into", "before", "sum", F.col("room").alias("into_room"))
        fits = F.col("before") - F.col("tokens_before") + F.col("sum") <= F.col("into_room")
        repeated.append(placed.where(~is_system).join(nearest, ["conv_id", "place"]).where(fits))
    every = placed.select(*columns, F.lit(True).alias("own"))
    for rows in repeated:
        rows = rows.drop("window").withColumnRenamed("into", "window")
        every = every.unionByName(rows.select(*columns, F.lit(False).alias("own")))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))
    parts = every.select(
        "conv_id", "window", "place", "own", "tokens", head.alias("head"), escape(F.col("text")).alias("body"),
        (F.col("own") & (F.col("role") == "assistant")).alias("learned"),
    )
    grouped = parts.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("place", "own", "head", "body", "learned"))).alias("p"),
        F.sum("tokens").alias("n_tokens"),
    )
    piece = lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))
    # Start of every turn: the code points of those before it.
    walked = F.aggregate(
        "p",
        F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
        ),
        lambda s, p: F.struct(
            (s["at"] + F.length(piece(p))).cast("long").alias("at"),
            F.when(
                p["learned"],
                F.concat(
                    s["spans"],
                    F.array(
                        F.struct(
                            (s["at"] + F.length(p["head"])).cast("long").alias("start"),
                            (s["at"] + F.length(p["head"]) + F.length(p["body"]))
                            .cast("long")
                            .alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
    )
    return grouped.select(
        F.nullif("conv_id", F.lit(NO_ID)).alias("conv_id"),
        "window",
        F.array_join(F.transform("p", piece), "").alias("formatted"),
        "n_tokens",
        F.size("p").alias("n_turns"),
        F.size(F.filter("p", lambda p: ~p["own"])).alias("n_repeated"),
        walked["spans"].alias("loss"),
    )


READ_BACK = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def read_back(windows: DataFrame) -> DataFrame:
    """Parse formatted windows again, conversation by conversation: turns without the repeated
    ones, and the text under the loss mask. A digest over a conversation has to run through it in
    order; it is fed window by window, so memory stays with one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        current, state = none, None
        for batch in batches:
            rows = []
            for w in batch.to_pylist():
                if w["conv_id"] != current or state is None:
                    if state is not None:
                        rows.append(finished(current, state))
                    current = w["conv_id"]
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in _TURN.findall(w["formatted"])[w["n_repeated"] :]:
                    state[0] += 1
                    state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                for span in w["loss"]:
                    learned = unescape(w["formatted"][span["start"] : span["end"]])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(w["formatted"])
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_READ)
        if state is not None:
            yield pa.RecordBatch.from_pylist([finished(current, state)], schema=_READ)

    def finished(conv_id, state) -> dict:
        turns, digest, chars, loss, formatted = state
        values = (conv_id, turns, digest.hexdigest(), chars, loss.hexdigest(), formatted)
        return dict(zip(_READ.names, values))

    return windows.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(
        run, READ_BACK
    )


_READ = pa.schema(
    [
        (name, pa.string() if kind == "string" else pa.int64())
        for name, kind in (part.split() for part in READ_BACK.split(", "))
    ]
)
