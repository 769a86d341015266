"""Chat formatting with rotated perspectives.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as users with their names.  The mask says
which characters are learned: what the speaker says, and the end mark after it.

Everything here is made of Spark's own functions.  A conversation is rendered in
parts of ``MESSAGES`` messages that follow each other, each a row with the place of
its first message.  All conversations are laid end to end in one order and cut into
ranges; a range knows how many messages of its first conversation lie before it, so a
conversation of any length, also of one repeated message, is numbered by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.ranks import PLACE, RANGE, in_ranges, known_rows

MESSAGES = 64
NOBODY = "unknown"

BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def _head(role: Column, speaker: Column) -> Column:
    name = F.when(role == speaker, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), role))
    return F.concat(F.lit(BEGIN), name, F.lit("\n"))


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with ``ordinal``, their place from 0 in their conversation by turn, role and text."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = in_ranges(rows, [F.col(c) for c in ("conv_id", "turn", "role", "text")], ranges)
    ends = (
        placed.groupBy(RANGE)
        .agg(F.max_by(F.struct("conv_id"), PLACE).alias("last"), F.min_by(F.struct("conv_id"), PLACE).alias("first"))
        .withColumnRenamed(RANGE, "of")
    )
    last = (
        placed.join(F.broadcast(ends), (F.col(RANGE) == F.col("of")) & (F.struct("conv_id") == F.col("last")))
        .groupBy(RANGE, "first", "last")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # one row a range
    )
    carried, held, before = [], None, 0
    for r in sorted(last, key=lambda r: r[RANGE]):
        first, end = r["first"]["conv_id"], r["last"]["conv_id"]
        goes_on = held is not None and held[0] == first
        carried.append((r[RANGE], goes_on, first, before if goes_on else 0))
        # A range of one conversation adds to what was carried, another begins anew.
        before = r["n"] + (before if goes_on and first == end else 0)
        held = (end,)
    sent = known_rows(rows.sparkSession, carried, f"{RANGE} int, goes_on boolean, of bigint, earlier bigint")
    own = F.row_number().over(Window.partitionBy(RANGE, "conv_id").orderBy(PLACE)) - 1
    earlier = F.when(F.col("goes_on") & F.col("of").eqNullSafe(F.col("conv_id")), F.col("earlier")).otherwise(0)
    numbered = placed.withColumn("own", own).join(F.broadcast(sent), RANGE)
    return numbered.withColumn("ordinal", F.col("own") + earlier).select(*rows.columns, "ordinal")


def perspectives(conversations: DataFrame, messages: int = MESSAGES) -> DataFrame:
    """``conv_id, speaker, first_message, n_messages, n_learned, text, mask`` for every speaker and part.

    ``first_message`` is the place, from 0, of the part's first message in its conversation; parts begin at
    every ``messages``-th.  ``mask`` has the lengths, in characters, of what is not learned and learned by
    turns, beginning with what is not.  Messages are ordered by turn, then role
    and text; a null turn comes first, a null role is ``unknown``, a null text
    empty, null ``conv_id`` are one conversation.  Repeated rows are
    rendered each.  An empty table gives no rows; other columns are not read.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(NOBODY)).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    speakers = rows.select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    first = F.col("ordinal") - F.col("ordinal") % messages
    parts = (
        _numbered(rows)
        .groupBy("conv_id", first.cast("bigint").alias("first_message"))
        .agg(F.sort_array(F.collect_list(F.struct("ordinal", "role", "text"))).alias("said"))
    )

    def shown(m: Column) -> Column:
        head = _head(m["role"], F.col("speaker"))
        body = F.concat(m["text"], F.lit(END))
        own = m["role"] == F.col("speaker")
        return F.struct(
            F.concat(head, body).alias("shown"),
            F.char_length(F.when(own, head).otherwise(F.concat(head, body))).alias("skipped"),
            F.char_length(F.when(own, body).otherwise(F.lit(""))).alias("learned"),
        )

    return (
        parts.join(speakers, F.expr("conv_id <=> c"))
        .withColumn("said", F.transform("said", shown))
        .select(
            "conv_id",
            "speaker",
            "first_message",
            F.size("said").cast("bigint").alias("n_messages"),
            F.aggregate("said.learned", F.lit(0).cast("bigint"), lambda n, x: n + x).alias("n_learned"),
            F.array_join("said.shown", "").alias("text"),
            F.flatten(F.transform("said", lambda m: F.array(m["skipped"], m["learned"]))).alias("mask"),
        )
    )
