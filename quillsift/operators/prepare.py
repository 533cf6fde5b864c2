"""Cleaning, union and duplicate removal of message tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.functions import text as T
from quillsift.session import written

KEY = ["Source", "row_id"]


def subject_of(body: Column) -> Column:
    """First line after a leading ``Subject:``, stripped; empty without that prefix."""
    line = F.substring_index(body, "\n", 1)
    return F.when(body.rlike(T.SUBJECT_PATTERN), T.strip(line.substr(F.lit(9), F.length(line)))).otherwise("")


def body_of(body: Column) -> Column:
    """All after the first line where that line is a subject, else the whole body."""
    first_break = F.instr(body, "\n")
    rest = F.when(first_break == 0, "").otherwise(body.substr(first_break + 1, F.length(body)))
    return F.when(body.rlike(T.SUBJECT_PATTERN), rest).otherwise(body)


def prepare(raw: DataFrame) -> DataFrame:
    """Raw (Source, row_id, Body, Label) to messages with a subject of their own."""
    body = F.col("Body")
    return raw.where(body.isNotNull()).select(
        "Source",
        "row_id",
        T.plain_separators(subject_of(body)).alias("Subject"),
        T.plain_separators(body_of(body)).alias("Body"),
        "Label",
    )


def union_sources(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def with_text(messages: DataFrame) -> DataFrame:
    return messages.withColumn("text", T.joined_text())


def first_of_each(messages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Keep the first message, in (Source, row_id) order, of each distinct text.

    Digests and row keys are written once; the digests that occur more than once
    are grouped with partial aggregation, so a text that fills a third of the
    table costs one small row per task. Only the keys that are not the first of
    their text are taken out again: few rows, which AQE broadcasts if their
    bytes are small, and then no text moves.
    """
    by = by or []
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    keyed = written(messages.select(*KEY, *[c for c in by if c not in KEY], digest), "digests")
    firsts = keyed.groupBy("digest", *by).agg(F.min(F.struct(*KEY)).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = keyed.join(firsts, ["digest", *by])
    losers = repeated.where(F.struct(*KEY) != F.col("first")).select(*KEY)
    return messages.join(losers, KEY, "left_anti")


def drop_low_quality(messages: DataFrame, column: str = "text", max_tokens: int = 100_000) -> DataFrame:
    text = F.col(column)
    return messages.where(~T.is_blank(text) & (T.word_count(text) <= max_tokens))
