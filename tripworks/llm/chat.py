"""Dialogues seen from each participant: that speaker as assistant, the others as named users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tripworks.llm.frames import ranked
from tripworks.sources.scratch import materialise

# Roles that set the scene: shown as they are, never a participant.
CONTEXT_ROLES = ("system",)
UNNAMED = "unknown"
# Turns of one rendered part. A longer dialogue is several parts, numbered from 0.
PART_TURNS = 256
END = "<|end|>"


def _safe(text: Column) -> Column:
    """No text can look like a marker."""
    return F.replace(F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))


def _head(role: Column, speaker: Column, context: Sequence[str]) -> Column:
    other = F.when(role.isin(*context), F.concat(F.lit("<|"), _safe(role), F.lit("|>"))).otherwise(F.concat(F.lit("<|user:"), _safe(role), F.lit("|>")))
    return F.concat(F.when(role == speaker, F.lit("<|assistant|>")).otherwise(other), F.lit("\n"))


def rotate(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    context: Sequence[str] = CONTEXT_ROLES,
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """One row per dialogue, part and participant: (conv_id, part, speaker, text, offset, mask, n_turns, n_chars, n_trained).

    Every turn is a head line, the text, an end marker and a line break. The speaker's own turns have
    the head ``<|assistant|>``, others ``<|user:NAME|>``, context roles their own name; markers inside
    texts and names are broken up by a blank. ``mask`` lists what to train on, start:end in code points
    of the rendered dialogue, end exclusive: the speaker's own texts with their end markers.

    Turns come in order of turn (null first), role and text, repeated rows one after the other. Turns
    are numbered across tasks, and a part holds at most ``part_turns``, so a dialogue of any length is
    never in one task: the parts of a speaker, one after the other, are the whole dialogue, which begins
    with its context roles once, ``offset`` is where a part begins in it, and ``mask`` counts from the
    beginning of the dialogue. Markers are broken up for good: what looked like one is not restored. Null role is a participant ``unknown``, null text empty, null conv_id a dialogue
    like any other; one without participants gives no rows. Other columns are not looked at.
    """
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(UNNAMED)).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    placed = ranked(turns, ["conv_id"], ["turn", "role", "text"], "place")
    part = F.floor((F.col("place") - 1) / part_turns).alias("part")
    parts = placed.groupBy("conv_id", part).agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    speakers = materialise(turns.where(~F.col("role").isin(*context)).select(F.col("conv_id").alias("of"), F.col("role").alias("speaker")).distinct(), "speakers")
    met = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))
    speaker = F.col("speaker")
    said = F.transform(
        "turns",
        lambda t: F.struct(
            _head(t["role"], speaker, context).alias("head"),
            F.concat(_safe(t["text"]), F.lit(END)).alias("body"),
            (t["role"] == speaker).alias("own"),
        ),
    )
    met = met.select("conv_id", "part", "speaker", said.alias("said"))

    def step(done: Column, t: Column) -> Column:
        start = done["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(
            (end + 1).alias("at"),
            F.when(t["own"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"),
            F.when(t["own"], done["own"] + F.length(t["body"])).otherwise(done["own"]).alias("own"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.lit(0).alias("own"))
    met = met.withColumn("marked", F.aggregate("said", zero, step))
    whole = F.array_join(F.transform("said", lambda t: F.concat(t["head"], t["body"], F.lit("\n"))), "")
    # dialogues of several parts, one row per part and speaker
    several = materialise(placed.where(F.col("place") > part_turns).select(F.col("conv_id").alias("long")).distinct(), "long-dialogues")
    cut = met.join(several, F.col("conv_id").eqNullSafe(F.col("long")), "left_semi")
    before = W.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = materialise(cut.select("conv_id", "speaker", "part", F.col("marked.at").cast("bigint").alias("size")), "part-sizes")
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0).cast("bigint"))).drop("size").toDF("c", "s", "p", "offset")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("speaker") == F.col("s")) & (F.col("part") == F.col("p"))
    met = met.join(offsets.where("p > 0"), same, "left").withColumn("offset", F.coalesce("offset", F.lit(0).cast("bigint")))
    spans = F.transform("marked.spans", lambda x: F.concat_ws(":", *((x[n] + F.col("offset")).cast("string") for n in ("start", "end"))))
    return met.select(
        "conv_id",
        "part",
        "speaker",
        whole.alias("text"),
        "offset",
        F.array_join(spans, ",").alias("mask"),
        F.size("said").cast("bigint").alias("n_turns"),
        F.col("marked.at").cast("bigint").alias("n_chars"),
        F.col("marked.own").cast("bigint").alias("n_trained"),
    )
