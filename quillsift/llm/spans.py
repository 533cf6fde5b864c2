"""Cutting spans out of texts in one pass over the text, however many spans it has."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def named_span(start: Column, end: Column, name: Column) -> Column:
    """Code points, end exclusive, and what stands in their place."""
    return F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), name.alias("name"))


def cut(text: str | None, spans: list[dict] | None) -> str | None:
    """The text with each span replaced by its name; overlapping spans become one, named by the first."""
    if text is None or not spans:
        return text
    parts, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], s["end"], s["name"])):
        if parts and span["start"] < at:
            at = max(at, span["end"])
            continue
        parts += [text[at : span["start"]], span["name"]]
        at = span["end"]
    return "".join(parts) + text[at:]


def replaced(text: Column, spans: Column) -> Column:
    """``cut`` for columns, one row at a time."""

    @F.arrow_udf("string")
    def each(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([cut(texts[i].as_py(), found[i].as_py()) for i in range(len(texts))], type=pa.string())

    return each(text, spans)
