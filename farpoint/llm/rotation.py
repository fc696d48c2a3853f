"""Chat formatting: multi-party perspective rotation (DataFrame functions only).

For every participant (speaker) of a conversation the dialogue is rendered
once with that speaker as the assistant and everyone else as a named user.
The loss mask covers the assistant's own content and end mark, nothing else.
A rendered turn is::

    <|im_start|>assistant\\n{text}<|im_end|>\\n
    <|im_start|>user name={speaker}\\n{text}<|im_end|>\\n

``system`` turns are instructions, not a participant; they are rendered as
``<|im_start|>system`` in every perspective.

A dialogue is cut into parts of PART_TURNS consecutive turns (one part for
nearly all), so no conversation, however long, is gathered as a whole; the
parts of a perspective joined in order are its dialogue.  Turns are ranked in
two steps (inside buckets of turn numbers, then over the buckets' totals).

Defined cases: null text is rendered as empty; a null speaker speaks as
``unknown``; turns with equal numbers are ordered by speaker, then text, then
repeated; a null turn comes first; a null conv_id is a conversation of its own;
a conversation without participants (only system turns) has no perspective;
an empty table gives an empty result; only the four columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from farpoint.llm.scratch import Scratch

PART_TURNS = 64
BUCKET_TURNS = 64         # turn numbers ranked together
# The template's marks.
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, UNKNOWN = "system", "unknown"


def ranked_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, speaker, text, turn, rank): rank counts a conversation's turns from 0."""
    t = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit(UNKNOWN)).alias("speaker"),
                     F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("bucket", F.coalesce(F.floor(F.col("turn") / BUCKET_TURNS), F.lit(-1 << 60)))
    per = t.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Win.partitionBy("conv_id").orderBy("bucket").rowsBetween(Win.unboundedPreceding, -1)
    first = per.select(F.col("conv_id").alias("c"), F.col("bucket").alias("b"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Win.partitionBy("conv_id", "bucket").orderBy(
        F.col("turn").asc_nulls_first(), "speaker", "text")
    return (t.withColumn("i", F.row_number().over(inside) - 1)
            .join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("bucket") == F.col("b")))
            .select("conv_id", "speaker", "text", "turn", (F.col("first") + F.col("i")).alias("rank")))


def rotate_perspectives(turns: DataFrame) -> DataFrame:
    """(conv_id, perspective, part, n_turns, n_assistant, text, mask) of every participant.

    ``mask``: the spans [{start, end}] of ``text`` (code points, end exclusive)
    that the loss covers.
    """
    scratch = Scratch(turns.sparkSession, "rotation")
    t = scratch.save(ranked_turns(turns)).withColumn("part", F.floor(F.col("rank") / PART_TURNS))
    # parts are short lists; a part is built once and then rendered per participant
    parts = scratch.save(t.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(
        F.struct("rank", "speaker", "text"))).alias("turns")))
    who = t.filter(F.col("speaker") != SYSTEM).select(
        F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    each = parts.join(scratch.save(who), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")

    def head(x, me):
        return (F.when(x["speaker"] == me, F.lit("assistant"))
                .when(x["speaker"] == SYSTEM, F.lit(SYSTEM))
                .otherwise(F.concat(F.lit("user name="), x["speaker"])))

    def render(x, me):
        h = F.concat(F.lit(START), head(x, me), F.lit("\n"))
        return F.struct((x["speaker"] == me).alias("mine"), h.alias("head"),
                        F.concat(x["text"], F.lit(END)).alias("body"))

    msgs = each.withColumn("msgs", F.transform(
        "turns", lambda x: render(x, F.col("perspective"))))
    # running offset of each message: (end of the text so far, spans so far)
    zero = F.struct(F.lit(0).cast("bigint").alias("at"),
                    F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def add(acc, m):
        body = acc["at"] + F.length(m["head"])
        end = body + F.length(m["body"])
        span = F.array(F.struct(body.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
        return F.struct((end + 1).cast("bigint").alias("at"),
                        F.when(m["mine"], F.concat(acc["spans"], span)).otherwise(
                            acc["spans"]).alias("spans"))

    text = F.concat(F.array_join(F.transform("msgs", lambda m: F.concat(m["head"], m["body"])),
                                 "\n"), F.lit("\n"))
    return msgs.select(
        "conv_id", "perspective", F.col("part").cast("bigint").alias("part"),
        F.size("msgs").cast("bigint").alias("n_turns"),
        F.size(F.filter("msgs", lambda m: m["mine"])).cast("bigint").alias("n_assistant"),
        text.alias("text"), F.aggregate("msgs", zero, add)["spans"].alias("mask"))
