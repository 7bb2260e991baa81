"""Chat formatting: every dialogue rendered once per participant, native columns only.

Multi-party perspective rotation: for each participant of a conversation the turns
are rendered with that speaker as the assistant and everyone else as a user who
carries their name; system turns stay system turns. The mask marks what the model
learns from in that perspective: the assistant's words and the end mark after them.

Long dialogues are rendered in consecutive parts of ``part_turns`` turn numbers (a
row per conversation, speaker and part). A part of more than ``piece_turns`` turns, as
repeated turn numbers or a null conv_id make it, is cut by the turns' order into
consecutive pieces of that many at most, so no task gathers a conversation of any
length; the parts and pieces of a speaker, put after each other, are the whole dialogue.

Defined results: turns go by turn number, then role, then text (between the pieces of a
part by the text's first 256 characters, then its hash); a null turn number comes after
all others (part -1);
a turn that repeats with the same conversation, number, role and text is one
utterance; a null role is the participant ``unknown``; a null text is an empty turn;
a null conv_id is a conversation of its own. A conversation of system turns only has
no participant and so no row. Control marks inside a text are broken up by a
zero-width space, so that a text can't open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
UNKNOWN = "unknown"
#: A speaker's name in a header line: what isn't a letter, digit, _ or - becomes _.
NAME = r"[^\p{L}\p{N}_-]"


def _plain(text: Column) -> Column:
    """The text without anything that reads as a control mark."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(?=im_(?:start|end)\|>)", "<​|")


def _header(role: Column, speaker: Column) -> Column:
    named = F.concat(F.lit("user name="), F.regexp_replace(role, NAME, "_"))
    who = F.when(role == SYSTEM, F.lit(SYSTEM)).when(role == speaker, F.lit("assistant")).otherwise(named)
    return F.concat(F.lit(OPEN), who, F.lit("\n"))


def _same_part(a: str, b: str) -> Column:
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.part") == F.col(f"{b}.part"))


def _pieces(turns: DataFrame, piece_turns: int) -> DataFrame:
    """The distinct turns with their ``piece``: 0, or in a part of more than ``piece_turns``
    of them the number of its run of so many turns at most, in the turns' order."""
    full = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n")).where(F.col("n") > piece_turns)
    full = stored(full.select("conv_id", "part"), "full_parts")
    once = ["conv_id", "turn", "role", "text"]
    if not full.limit(1).count():
        return turns.dropDuplicates(once).withColumn("piece", F.lit(0))
    rest = turns.alias("t").join(full.alias("f"), _same_part("t", "f"), "left_anti").dropDuplicates(once)
    many = turns.alias("t").join(full.alias("f"), _same_part("t", "f"), "left_semi").dropDuplicates(once)
    order = ["conv_id", "part", "turn", "role", F.substring(_plain(F.col("text")), 1, 256), F.xxhash64("text")]
    # numbered in order within a range of the turns: a run is so many rows of a range
    many = many.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("nth", F.monotonically_increasing_id())
    many = stored(many.withColumn("run", F.floor(F.col("nth") / piece_turns)).drop("nth"), "full_turns")
    part = W.partitionBy("conv_id", "part")
    runs = many.groupBy("conv_id", "part", "run").agg(F.count("*").alias("n"))
    runs = runs.select("conv_id", "part", "run", F.when(F.sum("n").over(part) > piece_turns,
                                                        F.row_number().over(part.orderBy("run")) - 1)
                       .otherwise(0).alias("piece"))
    many = many.alias("t").join(runs.alias("r"), _same_part("t", "r") & (F.col("t.run") == F.col("r.run")))
    return rest.withColumn("piece", F.lit(0)).unionByName(many.select(*[f"t.{c}" for c in turns.columns], "r.piece"))


def rotate(turns: DataFrame, part_turns: int = 64, piece_turns: int = 256) -> DataFrame:
    """One row per conversation, participant, part and piece.

    ``rendered``: the text; ``spans``: array of (start, end) code point offsets in it
    that are trained on; ``mask``: a 0/1 string with a digit per segment (header, body
    and end mark of each turn), and ``segments`` their lengths; ``n_turns``,
    ``n_trained`` (turns spoken by the participant), ``trained_chars``.
    """
    t = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(UNKNOWN)).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    t = t.withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long"))
    t = _pieces(t, piece_turns)
    speakers = (turns.select(F.col("conv_id").cast("long").alias("conv_id"),
                             F.coalesce(F.col("role"), F.lit(UNKNOWN)).alias("speaker"))
                .where(F.col("speaker") != SYSTEM).distinct())
    turn = F.struct(F.col("turn"), F.col("role"), _plain(F.col("text")).alias("text"))
    parts = t.groupBy("conv_id", "part", "piece").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rows = parts.alias("p").join(speakers.alias("s"), F.col("p.conv_id").eqNullSafe(F.col("s.conv_id"))).select(
        "p.conv_id", "p.part", "p.piece", "p.turns", "s.speaker")

    speaker = F.col("speaker")
    segments = F.flatten(F.transform("turns", lambda x: F.array(
        F.struct(_header(x.role, speaker).alias("s"), F.lit(0).alias("m")),
        F.struct(F.concat(x.text, F.lit(CLOSE)).alias("s"), (x.role == speaker).cast("int").alias("m")),
        F.struct(F.lit("\n").alias("s"), F.lit(0).alias("m")))))
    rows = rows.withColumn("pieces", segments)
    rows = rows.withColumn("segments", F.transform("pieces", lambda x: F.length(x.s)))
    start = F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.length(x.s)
        spans = F.when(x.m == 1, F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), end.alias("end")))))
        return F.struct(end.alias("at"), spans.otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("pieces", start, step, lambda acc: acc["spans"])
    return rows.select(
        "conv_id", "speaker", "part", "piece",
        F.array_join(F.transform("pieces", lambda x: x.s), "").alias("rendered"),
        spans.alias("spans"),
        F.array_join(F.transform("pieces", lambda x: x.m.cast("string")), "").alias("mask"),
        "segments", F.size("turns").alias("n_turns"),
        F.size(F.filter("turns", lambda x: x.role == speaker)).alias("n_trained"),
    ).withColumn("trained_chars", F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]))
