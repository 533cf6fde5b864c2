"""Chat formatting by perspective rotation: each participant in turn is the assistant.

Method: for every participant of a conversation the dialogue is rendered with that speaker as assistant,
all others as users named by their role, and a mask that is on for the assistant's words only. The
result is one row per conversation, perspective and chunk of ``CHUNK`` turns: the text, and the spans of
the text that count for training. Turns are dealt to chunks by their rank in the conversation, so a row
is bounded however long a dialogue is; ``start_char`` says where the chunk begins in the whole rendering.

The rank needs no sort of a conversation in one task: turns are counted by (conversation, slice of turn
numbers), a running sum over these counts tells where a slice starts, and only a slice is ordered.
Each turn is rendered once for every participant, as the method asks, in the task that holds it.

Defined results: a null text is empty; a null role speaks as "unknown"; equal turn numbers are ordered
by role and text; repeated rows are turns of their own; rows without conversation or turn number form a
conversation "null", respectively come first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 256
SLICE = 256
NAMELESS = "unknown"


def header(role: Column, perspective: Column) -> Column:
    """Opening of a turn: the perspective's own turns are the assistant's, others are named users."""
    return F.when(role == perspective, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n")))


CLOSING = "<|end|>\n"


def ranked(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rank): rank from 0 in the order of the dialogue."""
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(NAMELESS)).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("slice", F.floor(F.coalesce("turn", F.lit(-SLICE)) / SLICE))
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("conv_id", "slice").agg(F.count("*").alias("n"))
    starts = starts.select(F.col("conv_id").alias("of"), F.col("slice").alias("at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv_id", "slice").orderBy("turn", "role", "text")
    own = rows.withColumn("place", F.row_number().over(inside) - 1)
    joined = own.join(starts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at")))
    return joined.select("conv_id", "turn", "role", "text", (F.col("start") + F.col("place")).alias("rank"))


def rendered(turns: DataFrame) -> DataFrame:
    """(conv_id, perspective, chunk, n_turns, start_char, text, spans, n_masked).

    spans are the (start, end) code points of ``text`` whose mask is on.
    """
    rows = ranked(turns).withColumn("chunk", F.floor(F.col("rank") / CHUNK))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(F.struct("rank", "role", "text"))).alias("turns"))
    speakers = rows.select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct()
    views = chunks.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    perspective = F.col("perspective")
    pieces = F.transform(
        "turns",
        lambda t: F.struct(header(t["role"], perspective).alias("head"), t["text"].alias("body"), (t["role"] == perspective).alias("own")),
    )
    views = views.withColumn("pieces", pieces)

    def step(done: Column, piece: Column) -> Column:
        start = done["at"] + F.length(piece["head"])
        end = start + F.length(piece["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        spans = F.when(piece["own"] & (end > start), F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct((end + len(CLOSING)).alias("at"), spans.alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))
    views = views.withColumn("run", F.aggregate("pieces", empty, step))
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSING))), "")
    before = Window.partitionBy("conv_id", "perspective").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    masked = F.aggregate("run.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    views = views.select(
        "conv_id", "perspective", F.col("chunk").cast("long").alias("chunk"), F.size("turns").alias("n_turns"),
        F.col("run.at").cast("long").alias("n_chars"), text.alias("text"), F.col("run.spans").alias("spans"), masked.alias("n_masked"),
    )
    lengths = views.select("conv_id", "perspective", "chunk", F.coalesce(F.sum("n_chars").over(before), F.lit(0)).cast("long").alias("start_char"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("conv_id", "perspective", "chunk")]
    joined = views.alias("l").join(lengths.alias("r"), same[0] & same[1] & same[2])
    return joined.select(*[F.col(f"l.{c}") for c in ("conv_id", "perspective", "chunk", "n_turns")], F.col("r.start_char"), *[F.col(f"l.{c}") for c in ("text", "spans", "n_masked")])
