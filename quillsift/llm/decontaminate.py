"""Benchmark decontamination: texts against the word windows of a benchmark.

Method: the benchmark's windows of ten consecutive words (an item of fewer words, but not none, is one
window) form a hash set that is broadcast; every token window of every text is looked up in it, each hit
is verified word for word, and the hit spans or whole documents are removed.

The set is built in blocks of a measured size: windows are dealt to blocks by their hash so that no
block exceeds ``block_bytes``, one block is broadcast at a time, and the texts are scanned once per
block, each scan adding to what the earlier ones found. No row is joined, so no key can be hot.

Defined results: a null or empty text has no words and no hit; a null or empty item has no window; an
item without id is named "null"; repeated rows are judged each by itself; an empty benchmark hits
nothing; columns of ``docs`` other than the text pass through untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.llm.spans import named_span, replaced
from quillsift.llm.words import Words, chunks, windows
from quillsift.session import written

WIDTH = 10
SEED = 11
BLOCK_BYTES = 64 << 20
ROW_OVERHEAD = 64
SIEVE_BITS = 20
HITS = "n_words long, spans array<struct<first:int,last:int,start:int,end:int>>, items array<string>"
SPANS = "array<struct<first:int,last:int,start:int,end:int>>"
ARROW_SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])


def _window_text(found: Words, at: int, width: int) -> bytes:
    return b" ".join(found.data[found.starts[k] : found.ends[k]] for k in range(at, at + width))


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(code, n, phrase, item): one row per window of each item of (item_id, text)."""

    def cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            code, size, phrase, item = [], [], [], []
            for begin, found in chunks(texts, cache):
                by_width = {}
                for i in range(len(found.first) - 1):
                    lo, hi = int(found.first[i]), int(found.first[i + 1])
                    n = min(width, hi - lo)
                    if not n:
                        continue
                    if n not in by_width:
                        by_width[n] = windows(found, n, SEED).view(np.int64)
                    for at in range(lo, hi - n + 1):
                        code.append(int(by_width[n][at]))
                        size.append(n)
                        phrase.append(_window_text(found, at, n))
                        item.append(ids[begin + i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(code, pa.int64()), pa.array(size, pa.int32()), pa.array(phrase, pa.binary()), pa.array(item, pa.string())],
                ["code", "n", "phrase", "item"],
            )

    source = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(cut_items, "code long, n int, phrase binary, item string").distinct()


class _Scanner:
    """Looks up all windows of a batch of texts in one block of the benchmark."""

    def __init__(self, rows: list):
        grouped: dict = {}
        for row in rows:
            grouped.setdefault((row["n"], row["code"]), {}).setdefault(bytes(row["phrase"]), []).append(row["item"])
        self.index = {}
        for width in sorted({n for n, _ in grouped}):
            codes = np.array(sorted(c for n, c in grouped if n == width), dtype=np.int64)
            sieve = np.zeros(1 << SIEVE_BITS, dtype=bool)
            sieve[codes.view(np.uint64) >> np.uint64(64 - SIEVE_BITS)] = True
            self.index[width] = (sieve, {int(c): grouped[width, int(c)] for c in codes})

    def scan(self, texts: list, cache: dict) -> list[dict]:
        out = []
        for begin, found in chunks(texts, cache):
            total = len(found.hashes)
            change = np.zeros(total + 1, dtype=np.int64)
            owner = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
            items: dict[int, set] = {}
            for width, (sieve, phrases) in self.index.items():
                codes = windows(found, width, SEED)
                maybe = np.flatnonzero(sieve[codes >> np.uint64(64 - SIEVE_BITS)])
                maybe = maybe[owner[maybe] == owner[maybe + width - 1]] if len(maybe) else maybe
                for at, code in zip(maybe.tolist(), codes[maybe].view(np.int64).tolist()):
                    names = phrases.get(code, {}).get(_window_text(found, at, width)) if code in phrases else None
                    if names:
                        change[at] += 1
                        change[at + width] -= 1
                        items.setdefault(int(owner[at]), set()).update(names)
            hit = np.cumsum(change)[:-1] > 0
            counts = np.diff(found.first).tolist()
            for i, n in enumerate(counts):
                row = {"n_words": n, "spans": [], "items": []}
                if i in items:
                    lo, hi = int(found.first[i]), int(found.first[i + 1])
                    edge = np.flatnonzero(np.diff(hit[lo:hi].view(np.int8), prepend=0, append=0)).tolist()
                    row["items"] = sorted(items[i])
                    row["spans"] = _spans(found, lo, int(found.offsets[i]), edge, texts[begin + i])
                out.append(row)
        return out


def _spans(found: Words, lo: int, offset: int, edges: list[int], text: str) -> list[dict]:
    """Word numbers and code points of each hit run."""
    raw = text.encode("utf-8", "surrogatepass")
    spans, byte, point = [], 0, 0

    def points(to: int) -> int:
        nonlocal byte, point
        point += len(raw[byte:to].decode("utf-8", "surrogatepass"))
        byte = to
        return point

    for first, last in zip(edges[0::2], edges[1::2]):
        start = points(int(found.starts[lo + first]) - offset)
        spans.append({"first": first, "last": last, "start": start, "end": points(int(found.ends[lo + last - 1]) - offset)})
    return spans


def _scan(text: Column, rows_of) -> Column:
    """``rows_of`` gives the rows of a block; the index over them is built once per worker."""

    @F.arrow_udf(HITS)
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner, cache = _Scanner(rows_of.value), {}
        kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(ARROW_SPAN)), ("items", pa.list_(pa.string()))])
        for texts in batches:
            yield pa.array(scanner.scan(texts.to_pylist(), cache), type=kind)

    return hits(text)


def joined_spans(old: Column, new: Column) -> Column:
    """Union of two lists of spans: sorted, and overlapping or touching ones become one, in one pass over both."""

    @F.arrow_udf(SPANS)
    def joined(olds: pa.Array, news: pa.Array) -> pa.Array:
        out = []
        for old, new in zip(olds.to_pylist(), news.to_pylist()):
            done: list[dict] = []
            for span in sorted([*(old or []), *(new or [])], key=lambda s: (s["first"], s["last"])):
                if done and done[-1]["last"] >= span["first"]:
                    done[-1]["last"] = max(done[-1]["last"], span["last"])
                    done[-1]["end"] = max(done[-1]["end"], span["end"])
                else:
                    done.append(span)
            out.append(done)
        return pa.array(out, type=pa.list_(ARROW_SPAN))

    return joined(old, new)


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES, into: str = "hits"
) -> DataFrame:
    """``docs`` with a struct column ``into`` (n_words, spans of words and code points, items)."""
    spark = docs.sparkSession
    index = written(item_windows(benchmark, width), "windows")
    size = index.agg(F.sum(F.length("phrase") + F.length("item") + ROW_OVERHEAD)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    out = docs
    for block in range(blocks):
        rows = index.where(F.pmod("code", F.lit(blocks)) == block).collect()
        found = _scan(F.col(text).cast("string"), spark.sparkContext.broadcast([r.asDict() for r in rows]))
        if block:
            old, more = F.col(into), F.col(f"{into}_more")
            out = out.withColumn(f"{into}_more", found).withColumn(
                into,
                F.struct(
                    old["n_words"].alias("n_words"),
                    joined_spans(old["spans"], more["spans"]).alias("spans"),
                    F.array_sort(F.array_union(old["items"], more["items"])).alias("items"),
                ),
            ).drop(f"{into}_more")
        else:
            out = out.withColumn(into, found)
        if block < blocks - 1:
            out = written(out, "scanned")
    return out


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def digest(scanned: DataFrame) -> DataFrame:
    """Per document: words, hit words, number and digest of the items that occur, and the verdict."""
    n_hit = hit_words(F.col("hits.spans"))
    return scanned.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hits.items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the hit spans of their texts."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    scanned = scan(rows, benchmark, f"row.`{text}`", width)
    if remove == "documents":
        return scanned.where(F.size("hits.spans") == 0).select("row.*")
    own = F.col(f"row.`{text}`")
    spans = F.transform("hits.spans", lambda s: named_span(s["start"], s["end"], F.lit("")))
    left = F.when(F.size(spans) > 0, replaced(own.cast("string"), spans)).otherwise(own)
    return scanned.withColumn("left", left).select(*[F.col("left").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
