"""Multi-party perspective rotation of dialogues (operator 1).

For every participant of a conversation the dialogue is written once more: that
participant's turns are the assistant's, the others' are users' by name, and a system turn
stays one. Spans mark the assistant's text, the only part to learn from.

A conversation is written in parts of ``PART_TURNS`` turns by their place in it, so no row grows
with it; nearly all have one part. Places come from counts: equal turns are counted, dealt out by
ranges of conversation and turn, and numbered behind the sums of the ranges before, so a
conversation of any size, or many copies of one turn, are numbered by many tasks. Participants
are distinct pairs found by partial aggregation, and the join that gives every turn its
perspectives may be split where a conversation is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslayers.storage import materialize

PART_TURNS = 256
# Copies of a turn that one task writes out at a time.
COPIES = 4096
SYSTEM, NAMELESS = "system", "unknown"
BEGIN, END = "<|begin|>", "<|end|>\n"


def _header(role: Column, perspective: Column) -> Column:
    return (
        F.when(role == SYSTEM, F.lit(f"{BEGIN}system\n"))
        .when(role == perspective, F.lit(f"{BEGIN}assistant\n"))
        .otherwise(F.concat(F.lit(f"{BEGIN}user name="), role, F.lit("\n")))
    )


def _placed(given: DataFrame) -> DataFrame:
    """Every turn (id, turn, role, text) with its ``place`` in the conversation, from 0."""
    order = ["turn", "role", "text"]
    distinct = given.groupBy("id", *order).agg(F.count(F.lit(1)).alias("n"))
    partitions = int(given.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = distinct.repartitionByRange(partitions, "id", *order).withColumn("range", F.spark_partition_id())
    ranged = materialize(ranged, "turns")
    # Sums of a conversation in the ranges before; only those that go on over a range have any.
    sums = ranged.groupBy("id", "range").agg(F.sum("n").alias("sum"))
    ranges = Window.partitionBy("id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("id").alias("of"), F.col("range").alias("of_range"), F.sum("sum").over(ranges).alias("begin"))
    within = Window.partitionBy("range", "id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = ranged.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0)))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("range") == F.col("of_range"))
    numbered = numbered.join(sums.where("begin > 0"), same, "left")
    first = (F.coalesce("begin", F.lit(0)) + F.col("within")).alias("first")
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / COPIES))
    dealt = numbered.select("id", *order, first, "n", F.explode(pieces).alias("piece"))
    if not ranged.where(F.col("n") > COPIES).isEmpty():
        dealt = dealt.repartition(partitions, "first", "piece")
    copies = F.sequence(F.col("piece") * COPIES, F.least(F.col("n"), (F.col("piece") + 1) * COPIES) - 1)
    dealt = dealt.select("id", *order, "first", F.explode(copies).alias("copy"))
    return dealt.select("id", *order, (F.col("first") + F.col("copy")).alias("place"))


def rotate(
    conversations: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """One row per conversation, participant and part of ``part_turns`` turns: ``rendered``, ``spans`` and counts.

    ``spans`` are begin and end (code points, end excluded) of the assistant's texts with
    their end marks in ``rendered``. Turns stand in the order of ``turn``; equal or null
    turn numbers in that of role and text, a null one first. A null role is a participant
    called ``unknown``, a null text is empty, rows with a null conversation are one
    conversation, repeated rows are turns of their own. A conversation of system turns
    alone has no participant and no row. A part is a rendering of its own: its spans begin at 0, and
    a part without a turn of the participant has none.
    """
    given = conversations.select(
        F.col(conversation).alias("id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(NAMELESS)).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    participants = given.where(F.col("role") != SYSTEM).groupBy("id", "role").agg(F.count(F.lit(1)).alias("n"))
    participants = participants.select(F.col("id").alias("of"), F.col("role").alias("perspective"))
    turns = _placed(given).join(participants, F.col("id").eqNullSafe(F.col("of")))
    message = F.struct(
        F.col("place"),
        F.col("role"),
        F.col("text"),
        F.concat(_header(F.col("role"), F.col("perspective"))).alias("header"),
    )
    part = F.floor(F.col("place") / part_turns).cast("int")
    grouped = turns.groupBy("id", "perspective", part.alias("part")).agg(F.sort_array(F.collect_list(message)).alias("messages"))
    pieces = F.transform("messages", lambda m: F.concat(m["header"], m["text"], F.lit(END)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def add(acc: Column, m: Column) -> Column:
        begin = acc["at"] + F.length(m["header"])
        end = begin + F.length(m["text"]) + len(END)
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        spans = F.when(m["role"] == F.col("perspective"), F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return grouped.select(
        F.col("id").alias(conversation),
        "perspective",
        "part",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.array_join(pieces, "").alias("rendered"),
        F.aggregate("messages", start, add, lambda acc: acc["spans"]).alias("spans"),
    )


ORACLE_SQL = f"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '{NAMELESS}') AS role, coalesce(text, '') AS text FROM conversations
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM given
), turns AS (
    SELECT m.conv_id, p.role AS perspective, CAST(m.place // {PART_TURNS} AS INTEGER) AS part,
        m.place, m.role, m.text,
        CASE WHEN m.role = 'system' THEN '{BEGIN}system' WHEN m.role = p.role THEN '{BEGIN}assistant'
            ELSE '{BEGIN}user name=' || m.role END || chr(10) AS header
    FROM numbered AS m
    JOIN (SELECT DISTINCT conv_id, role FROM given WHERE role <> 'system') AS p ON m.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
    SELECT *, sum(length(header) + length(text) + {len(END)}) OVER (
            PARTITION BY conv_id, perspective, part ORDER BY place ROWS UNBOUNDED PRECEDING) AS stop
    FROM turns
)
SELECT conv_id, perspective, part, count(*) AS n_messages,
    string_agg(header || text || '{END.strip()}' || chr(10), '' ORDER BY place) AS rendered,
    coalesce(string_agg(CAST(CAST(stop AS BIGINT) - length(text) - {len(END)} AS VARCHAR) || '-' || CAST(CAST(stop AS BIGINT) AS VARCHAR), ' '
        ORDER BY place) FILTER (role = perspective), '') AS spans
FROM placed GROUP BY conv_id, perspective, part"""
