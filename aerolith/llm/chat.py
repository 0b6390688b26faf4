"""Chat formatting: snapshots of a conversation collapse to the longest one, which is rendered.

Loggers write a conversation again after each turn. A conversation whose messages are the beginning
of a longer one's is such a snapshot. A rolling hash of each turn's prefix gives its key: the number
of messages so far and two 64-bit hashes, each the exclusive or of the messages' own hashes. A whole
conversation that occurs more often as a prefix than as a whole is somebody's snapshot, and an anti
join takes it out.

A message's hash covers its turn number, role and text, so turns are compared at the same numbers.
Rows that repeat in all four columns count once. Messages that share a turn number are one turn,
rendered in order of role and text. Null turns come first; rows without conv_id form one
conversation. All of it is DataFrame functions; only the messages that are rendered are shuffled
with their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aerolith.llm.common import running, running_total
from aerolith.session import stored

TURNS_PER_ROW = 1024
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _segment(turn: Column, turns_per_row: int) -> Column:
    return F.coalesce(F.floor(turn / turns_per_row), F.lit(-(2**62))).cast("long")


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def turn_digests(messages: DataFrame, turns_per_row: int = TURNS_PER_ROW) -> DataFrame:
    """conv_id, turn, segment, the messages of that turn and the exclusive or of their hashes."""
    parts = [
        F.col("turn").isNull(), F.coalesce("turn", F.lit(0).cast("long")),
        F.col("role").isNull(), F.coalesce("role", F.lit("")),
        F.col("text").isNull(), F.coalesce("text", F.lit("")),
    ]
    hashed = messages.select(
        "conv_id", "turn", F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2")
    )
    return (
        hashed.distinct()
        .groupBy("conv_id", "turn", _segment(F.col("turn"), turns_per_row).alias("segment"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor("h1").alias("x1"),
            F.bit_xor("h2").alias("x2"),
        )
    )


def maximal_conversations(messages: DataFrame, turns_per_row: int = TURNS_PER_ROW) -> DataFrame:
    """conv_id, n_messages and n_copies of the conversations that are no prefix of a longer one.

    Of conversations that are equal throughout, the smallest conv_id stands for all `n_copies`.
    """
    turns = stored(turn_digests(messages, turns_per_row), "chat-turns")
    total = lambda a, b: a + b
    rolling = running(
        turns, "conv_id", "segment", ["turn"],
        {
            "before": (F.sum, total, F.col("n")),
            "before1": (F.bit_xor, _xor, F.col("x1")),
            "before2": (F.bit_xor, _xor, F.col("x2")),
        },
    )
    prefixes = (
        rolling.select(
            (F.col("before") + F.col("n")).alias("n"),
            _xor(F.col("before1"), F.col("x1")).alias("x1"),
            _xor(F.col("before2"), F.col("x2")).alias("x2"),
        )
        .groupBy("n", "x1", "x2")
        .agg(F.count(F.lit(1)).alias("seen"))
    )
    wholes = (
        turns.groupBy("conv_id")
        .agg(F.sum("n").alias("n"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
        .groupBy("n", "x1", "x2")
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    )
    longer = (
        (wholes["n"] == prefixes["n"])
        & (wholes["x1"] == prefixes["x1"])
        & (wholes["x2"] == prefixes["x2"])
        & (prefixes["seen"] > wholes["n_copies"])
    )
    return wholes.join(prefixes, longer, "left_anti").select(
        "conv_id", F.col("n").alias("n_messages"), "n_copies"
    )


def render(messages: DataFrame, chosen: DataFrame, turns_per_row: int = TURNS_PER_ROW) -> DataFrame:
    """The chosen conversations as text, in rows of up to `turns_per_row` messages: conv_id, segment,
    n_messages, n_copies and text. Null roles and texts are empty.

    Segments go by the running count of a conversation's messages, in order of turn, role and text:
    most conversations are one row, segment 0, and no row holds more than `turns_per_row` messages,
    however many share a turn.
    """
    spoken = messages.select(
        F.col("conv_id").alias("_conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    same = F.col("_conv").eqNullSafe(F.col("conv_id"))
    short = chosen.filter(F.col("n_messages") <= turns_per_row)
    long = chosen.filter(F.col("n_messages") > turns_per_row)
    # Messages of long conversations, all of them different, are range-sorted; the ranges are the
    # buckets of the running count.
    order = ["turn", "role", "text"]
    sorted_ = stored(
        spoken.join(long, same, "left_semi").distinct().repartitionByRange("_conv", *order)
        .withColumn("_bucket", F.spark_partition_id()),
        "chat-long",
    )
    numbered = running_total(sorted_, "_conv", "_bucket", order, F.lit(1), "_before")
    message = F.struct(*order).alias("_m")
    kept = spoken.join(short, same, "left_semi").select(
        "_conv", message, F.lit(0).cast("long").alias("segment")
    ).unionByName(
        numbered.select("_conv", message, F.floor(F.col("_before") / turns_per_row).cast("long").alias("segment"))
    )
    line = lambda m: F.concat(F.lit(OPEN), m["role"], F.lit(MIDDLE), m["text"], F.lit(CLOSE))
    texts = kept.groupBy("_conv", "segment").agg(
        F.array_join(F.transform(F.sort_array(F.collect_set("_m")), line), "").alias("text")
    )
    return texts.join(chosen, same).select(
        "conv_id", "segment", "n_messages", "n_copies", "text"
    )


def collapse_snapshots(messages: DataFrame, turns_per_row: int = TURNS_PER_ROW) -> DataFrame:
    """Maximal conversations, rendered. An empty table gives an empty result; columns other than
    conv_id, turn, role and text are not read."""
    chosen = stored(maximal_conversations(messages, turns_per_row), "chat-chosen")
    return render(messages, chosen, turns_per_row)
