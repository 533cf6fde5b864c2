"""Resampling a corpus towards a target: importance weights, Gumbel noise, the highest scores win.

Method: features are runs of words, hashed to ``buckets``. The counts of all documents and of the target
give every bucket a gain; the gains travel as one array literal, from which a document's weight is summed.
The cutoff of the draw is found by a weighted median of medians: each partition tells the median key of its
remaining rows and their number, the driver takes the weighted median of these, and the next job counts the
rows on both sides of it, so at least a quarter of the rows goes in each round, until the cutoff is exact.
Only the winners are sorted.

How it scales: texts are read twice and never moved; counting shuffles at most ``buckets`` rows a task. The
rounds read one narrow table of keys, written anew when an eighth of it is left; the driver gets two
rows a partition, and at most ``LAST_ROWS`` keys at the end. Winners are dealt by key ranges and numbered
inside a range. Every step reads a written table, so lost executors only repeat tasks.

Defined results: a null or empty text has no features and weight 0; a null id counts as empty text in the
noise and comes after all others; rows equal in score and id are ordered by a hash of their text, then as
stored, so repeated rows are drawn one by one; an empty target or table works; the columns of the documents come back
in a struct ``doc``, so no name can clash. Ids must be integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsift.llm.bytepairs import let
from quillsift.session import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
LAST_ROWS = 4_096
REWRITE = 8
#: The total order of the draw, smallest first.
PLACE = ["minus_score", "no_id", "id", "tie", "row"]


def words_of(text: Column) -> Column:
    folded = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


def runs_of(words: Column, longest: int) -> Column:
    """All runs of 1 to ``longest`` words, joined by a space."""
    return words if longest == 1 else let(words, lambda words: _runs(words, longest))


def _runs(words: Column, longest: int) -> Column:
    def of_length(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(n)]))

    return F.concat(*[of_length(n) for n in range(1, longest + 1)])


def hashed(words: Column, longest: int, buckets: int) -> Column:
    """array<int>: the bucket of every feature, repeats included."""
    return F.transform(runs_of(words, longest), lambda run: (F.crc32(F.encode(run, "UTF-8")) % buckets).cast("int"))


def bucket_counts(texts: DataFrame, text: str, longest: int, buckets: int) -> dict[int, int]:
    rows = texts.select(F.explode(hashed(words_of(F.col(text)), longest, buckets)).alias("bucket")).groupBy("bucket").count()
    return {row["bucket"]: row["count"] for row in rows.collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> list[int]:
    """Thousandths of the log ratio of the smoothed shares of each bucket, rounded down."""
    s_all, t_all = sum(source.values()), sum(target.values())

    def gain(b: int) -> int:
        above = (target.get(b, 0) + 1.0) * (s_all + float(buckets))
        return math.floor(1000 * math.log(above / ((source.get(b, 0) + 1.0) * (t_all + float(buckets)))))

    return [gain(b) for b in range(buckets)]


def noise(key: Column, seed: str) -> Column:
    """Thousandths of a Gumbel variable from the hash of seed and id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((number + 0.5) / 4294967296.0))).cast("long")


def scored(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None,
    longest: int = 1, buckets: int = BUCKETS, seed: str = SEED,
) -> DataFrame:
    """(doc, n_words, n_features, weight, score) and the order of the draw; ``carry`` names the columns of ``doc``."""
    by_bucket = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets), buckets)
    literal = F.split(F.lit(",".join(map(str, by_bucket))), ",").cast("array<bigint>")
    rows = docs.select(
        F.struct(*(carry or docs.columns)).alias("doc"), F.col(key).cast("long").alias("id"),
        F.xxhash64(F.col(text)).alias("tie"), words_of(F.col(text)).alias("words"),
    )
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("sum"))

    def add(done: Column, gain: Column) -> Column:
        return F.struct((done["n"] + 1).alias("n"), (done["sum"] + gain).alias("sum"))

    found = let(literal, lambda g: F.aggregate(hashed(F.col("words"), longest, buckets), none, lambda done, b: add(done, F.element_at(g, b + 1))))
    rows = rows.select("doc", "id", "tie", F.size("words").cast("long").alias("n_words"), found.alias("f"))
    mean = F.when(F.col("f.n") > 0, F.expr("(f.sum - pmod(f.sum, f.n)) div f.n")).otherwise(F.lit(0).cast("long"))
    rows = rows.select("doc", "id", "tie", "n_words", F.col("f.n").alias("n_features"), mean.alias("weight"))
    rows = rows.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    return rows.select(
        "doc", "n_words", "n_features", "weight", "score", (-F.col("score")).alias("minus_score"), F.col("id").isNull().cast("long").alias("no_id"),
        F.coalesce("id", F.lit(0)).alias("id"), "tie", F.monotonically_increasing_id().alias("row"),
    )


def _upto(keys: list[np.ndarray], pivot: tuple[int, ...]) -> np.ndarray:
    """Which keys are the pivot or come before it."""
    less, same = np.zeros(len(keys[0]), bool), np.ones(len(keys[0]), bool)
    for column, value in zip(keys, pivot):
        less |= same & (column < value)
        same &= column == value
    return less | same


def _sides(table: DataFrame, after: tuple | None, upto: tuple | None, pivot: tuple | None) -> list:
    """Per partition the number and median key of the rows in (after, upto], on both sides of the pivot."""

    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[batch.column(c).to_numpy(zero_copy_only=False) for c in PLACE] for batch in batches]
        if not parts:
            return
        keys = [np.concatenate([part[c] for part in parts]) for c in range(len(PLACE))]
        inside = np.ones(len(keys[0]), bool)
        if after is not None:
            inside &= ~_upto(keys, after)
        if upto is not None:
            inside &= _upto(keys, upto)
        left = _upto(keys, pivot) if pivot is not None else inside
        for side, chosen in (("left", inside & left), ("right", inside & ~left)):
            n = int(chosen.sum())
            if n:
                rest = [column[chosen] for column in keys]
                middle = np.lexsort(rest[::-1])[(n - 1) // 2]
                yield pa.RecordBatch.from_pylist([{"side": side, "n": n} | {c: int(column[middle]) for c, column in zip(PLACE, rest)}])

    schema = "side string, n long, " + ", ".join(f"{c} long" for c in PLACE)
    return table.select(*PLACE).mapInArrow(medians, schema).collect()


def _weighted_median(rows: list) -> tuple[int, ...]:
    half, seen = sum(row["n"] for row in rows) / 2, 0
    for row in sorted(rows, key=lambda row: tuple(row[c] for c in PLACE)):
        seen += row["n"]
        if seen >= half:
            return tuple(row[c] for c in PLACE)
    raise ValueError("no rows")


def _between(after: tuple | None, upto: tuple | None) -> Column:
    def key(values: tuple) -> Column:
        return F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(PLACE, values)])

    inside = F.lit(True)
    if after is not None:
        inside = inside & (F.struct(*PLACE) > key(after))
    return inside if upto is None else inside & (F.struct(*PLACE) <= key(upto))


def cutoff(table: DataFrame, wanted: int) -> tuple[int, ...] | None:
    """The ``wanted``-th smallest key (PLACE) of a written table; None if nothing is wanted."""
    if wanted <= 0:
        return None
    after = upto = None
    rows = _sides(table, after, upto, None)
    size = left = sum(row["n"] for row in rows)
    while left > LAST_ROWS:
        pivot = _weighted_median(rows)
        sides = _sides(table, after, upto, pivot)
        below = sum(row["n"] for row in sides if row["side"] == "left")
        if below == wanted:
            return pivot
        if below > wanted:
            upto, rows = pivot, [row for row in sides if row["side"] == "left"]
        else:
            after, wanted, rows = pivot, wanted - below, [row for row in sides if row["side"] == "right"]
        left = sum(row["n"] for row in rows)
        if left * REWRITE < size:
            table, size = written(table.where(_between(after, upto)).select(*PLACE), "remaining"), left
    last = sorted(tuple(row) for row in table.where(_between(after, upto)).select(*PLACE).collect())
    return last[wanted - 1]


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with rank from 1: dealt by key ranges, which are counted, then numbered each on its own."""
    dealt = winners.repartitionByRange(*PLACE).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "winners")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy(*PLACE)
    return dealt.withColumn("place", F.row_number().over(inside)).join(starts, "part").withColumn("rank", F.col("start") + F.col("place"))


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None, longest: int = 1,
    buckets: int = BUCKETS, seed: str = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """(doc, n_features, weight, score, rank) of every document; rank is null where it isn't drawn."""
    table = written(scored(docs, target, key, text, carry, longest, buckets, seed), "scored")
    fit = table.where(F.col("n_words") >= least_words)
    border = cutoff(fit, fit.count() * percent // 100)
    drawn = (F.col("n_words") >= least_words) & _between(None, border) if border else F.lit(False)
    columns = ["doc", "n_features", "weight", "score"]
    winners = ranked(table.where(drawn)).select(*columns, F.col("rank").cast("long").alias("rank"))
    return winners.union(table.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))
