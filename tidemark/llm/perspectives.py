"""Chat formatting by perspective rotation.

Every participant of a conversation is in turn the assistant: the dialogue is rendered with that
speaker's turns as the assistant's, all others as turns of named users, and the character spans of
the assistant's turns (text and end marker) as the training mask. System turns are nobody's.

A conversation of any length is rendered in parts of ``part_turns`` turn numbers, so that none has
to fit a task; every part has all perspectives of the whole conversation. A part of more rows than that (turns
repeated or without a number, rows without a conv_id), or of more than ``PART_CHARS`` characters, is cut
into slices by the position of its rows; ``slice`` is 0 for all others and grows along the part. Positions come
from a sort of all rows into ranges (copies are told apart by their place in the input) and the sizes of what a
part has in earlier ranges, so no group of rows has to fit a task.

Defined results: a null role speaks under the name ``unknown``; a null text is an empty turn; turns
without a number come last, in a part of their own; turns with the same number follow by role and text,
repeated rows are repeated turns; rows with a null conv_id are one conversation; a conversation of
system turns only has no perspective. Markers inside texts and names are broken up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import read_table, saved

SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>"
PART_TURNS = 256
PART_CHARS = 1 << 24


def unmarked(text: Column) -> Column:
    """Text in which nothing reads as a marker."""
    return F.replace(F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))


def sliced(turns: DataFrame, part_turns: int) -> DataFrame:
    """Adds ``slice``: at most ``part_turns`` rows of a part and about PART_CHARS characters."""
    order = [F.col("turn").isNull(), "turn", "role", "said"]
    ranges = saved(
        turns.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange("conv_id", "part", *order, "tie")
        .withColumn("range", F.spark_partition_id()).withColumn("chars", F.char_length("said").cast("long")),
        "turns")
    part = ["conv_id", "part"]
    sizes = ranges.groupBy(*part, "range").agg(F.count(F.lit(1)).alias("rows"), F.sum("chars").alias("chars"))
    before = Window.partitionBy(*part).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (  # of a range only its first part can have rows in an earlier one
        sizes.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("range").alias("r"),
                     F.sum("rows").over(before).alias("rows_before"),
                     F.sum("chars").over(before).alias("chars_before"))
        .where("rows_before > 0")
    )
    here = Window.partitionBy(*part, "range").orderBy(*order, "tie")
    done = here.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0)
    placed = (
        ranges.withColumn("n", F.row_number().over(here) - 1)
        .withColumn("m", F.coalesce(F.sum("chars").over(done), none))
        .join(F.broadcast(earlier), (F.col("range") == F.col("r")) & F.col("conv_id").eqNullSafe(F.col("c"))
              & F.col("part").eqNullSafe(F.col("p")), "left")
    )
    at = F.floor((F.col("n") + F.coalesce("rows_before", none)) / part_turns)
    chars = F.floor((F.col("m") + F.coalesce("chars_before", none)) / PART_CHARS)
    return placed.select(*turns.columns, (at + chars).alias("slice"))  # neither falls along the part


def rotate(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """(conv_id, part, speaker, n_turns, n_trained, text, spans, slice); ``spans`` are [start, stop)."""
    turns = df.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.floor(F.col(f"`{turn_col}`") / part_turns).alias("part"),
        F.col(f"`{turn_col}`").alias("turn"),
        unmarked(F.coalesce(F.col(f"`{role_col}`"), F.lit(UNKNOWN))).alias("role"),
        unmarked(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("said"),
    )
    speakers = turns.where(F.col("role") != SYSTEM).select(
        F.col("conv_id").alias("of"), F.col("role").alias("speaker")).distinct()
    ordered = F.sort_array(F.collect_list(F.struct(F.col("turn").isNull(), "turn", "role", "said")))
    parts = sliced(turns, part_turns).groupBy("conv_id", "part", "slice").agg(ordered.alias("turns"))
    met = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))

    def head(t: Column) -> Column:
        return (
            F.when(t["role"] == SYSTEM, f"<|{SYSTEM}|>\n")
            .when(t["role"] == F.col("speaker"), "<|assistant|>\n")
            .otherwise(F.concat(F.lit("<|user name="), t["role"], F.lit("|>\n")))
        )

    pieces = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), F.concat(t["said"], F.lit(END)).alias("body"),
        (t["role"] == F.col("speaker")).alias("own")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        body = state["at"] + F.char_length(p["head"])
        stop = body + F.char_length(p["body"])
        span = F.array(F.struct(body.alias("start"), stop.alias("stop")))
        return F.struct((stop + 1).alias("at"), F.when(p["own"], F.concat(state["spans"], span))
                        .otherwise(state["spans"]).alias("spans"))

    return met.withColumn("pieces", pieces).select(
        "conv_id", "part", "speaker",
        F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_trained"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        F.aggregate("pieces", start, step, lambda state: state["spans"]).alias("spans"),
        "slice",
    )


def op7_perspectives(spark, sf_dir: str) -> DataFrame:
    """All perspectives of all conversations; spans as text."""
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["stop"])), ",")
    return rotate(read_table(spark, sf_dir, "conversations")).withColumn("spans", spans)


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, CAST(floor(turn / 256) AS BIGINT) AS part, turn,
         replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '|>', '| >') AS role,
         replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS said
  FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> 'system'
), counted AS (
  SELECT *, row_number() OVER w AS place, (sum(length(said)) OVER w) - length(said) AS before FROM turns
  WINDOW w AS (PARTITION BY conv_id, part ORDER BY turn NULLS LAST, role, said
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), cut AS (
  SELECT *, CAST((place - 1) // 256 + before // 16777216 AS BIGINT) AS slice FROM counted
), piece AS (
  SELECT t.conv_id, part, slice, speaker, role = speaker AS own, said || '<|end|>' AS body, place AS n,
         CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>'
              ELSE '<|user name=' || role || '|>' END || chr(10) AS head
  FROM cut t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, part, slice, speaker ORDER BY n)
            - length(body) - 1 AS start
  FROM piece
)
SELECT conv_id, part, slice, speaker, count(*) AS n_turns, count(*) FILTER (own) AS n_trained,
       string_agg(head || body || chr(10), '' ORDER BY n) AS text,
       coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + length(body) AS BIGINT), ',' ORDER BY n)
                FILTER (own), '') AS spans
FROM placed GROUP BY conv_id, part, slice, speaker
"""
