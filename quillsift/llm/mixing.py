"""Mixing sources to target weights, with DataFrame functions only.

Method (Efraimidis-Spirakis): each document has the exponential key -ln(u) / w, with u a hash of seed
and id in (0, 1) and w its quality; within a source documents are taken in the order of their keys until
their sizes reach the source's budget. A source whose target exceeds its size gives complete epochs
first; only the rest of the target is selected, and the document at the border gives the words that are
still missing, so a source's total is its target rounded down.

Nothing sorts a source. A histogram of the keys (source, bucket), summed before the shuffle, finds the
bucket that holds the border; while it has more than ``ROWS_PER_BUCKET`` rows of different keys, a further histogram of
its key range does so again. The rows of the last bucket alone are ordered, and every document is then judged by comparing
it with its source's border row. The number of buckets follows the number of rows. The list of distinct
sources, one row each, is ranked in one task; it is the only thing that is.

Targets: weights are shares of the sum of all sizes; a target stops at ``most`` times its source's size,
and the excess is reshared by weight among the others until none is above.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own, the
last; rows without id have equal keys; rows equal in key, id and size at the border share its words evenly, rounded
down; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsift.session import written

WORD = r"[^\x20\x09-\x0D]+"
PLAIN = r"[\p{L}\p{N}\x20\x09-\x0D.,;:!?'-]+"
LEAST_QUALITY = 0.1
SEED = "mix-1"
ROWS_PER_BUCKET = 20_000
LEAST_BUCKETS = 256
MOST = 3
DIGITS = 12


def size_of(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """Share of letters, digits, blanks and plain punctuation, 0.1 at least."""
    odd = F.length(F.regexp_replace(text, PLAIN, ""))
    share = F.when(F.length(text) > 0, 1 - odd / F.length(text)).otherwise(F.lit(0.0))
    return F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(LEAST_QUALITY))


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the first hex digits of the MD5 of seed and key."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))))
    number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return (number + 0.5) / float(16**DIGITS)


def cycle_weight() -> Column:
    """Weights 1, 2, 3, repeating, by code point of the source, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return ((place - 1) % 3 + 1).cast("double")


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, weight) with ``target``; each round needs two sums of the sources."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    limit = F.col("source_size") * most
    while True:
        row = sources.agg(
            F.count(F.when(limit < F.lit(level) * F.col("weight"), 1)).alias("capped"),
            F.coalesce(F.sum(F.when(limit < F.lit(level) * F.col("weight"), limit)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(limit >= F.lit(level) * F.col("weight"), F.col("weight"))), F.lit(0.0)).alias("weights"),
        ).first()
        if row["capped"] == capped or not row["weights"]:
            break
        capped, level = row["capped"], (total - row["given"]) / row["weights"]
    return sources.withColumn("target", F.least(limit.cast("double"), F.lit(level) * F.col("weight")))


def _buckets(rows: int) -> int:
    return max(LEAST_BUCKETS, rows // ROWS_PER_BUCKET)


def _holding(binned: DataFrame, plan: DataFrame) -> DataFrame:
    """(of, low, high, rows, start, budget): of each source the bucket that holds the border, with the words before it."""
    same = F.col("source").eqNullSafe(F.col("of"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    histogram = binned.groupBy("source", "bucket").agg(
        F.sum("size").alias("words"), F.count("*").alias("rows"), F.min("order_key").alias("low"), F.max("order_key").alias("high")
    )
    histogram = histogram.withColumn("ahead", F.coalesce(F.sum("words").over(before), F.lit(0)))
    found = histogram.join(plan, same).withColumn("start", F.col("start") + F.col("ahead"))
    found = found.where((F.col("start") <= F.col("budget")) & (F.col("budget") < F.col("start") + F.col("words")))
    return written(found.select("of", "low", "high", "rows", "start", "budget"), "holding")


def holding(marked: DataFrame, plan: DataFrame, buckets: int) -> DataFrame:
    """The key range of each source's border, with at most ROWS_PER_BUCKET rows unless these have one key.

    Keys are cut at even steps of 1 - exp(-key), then larger ranges at even steps of the key, again and again.
    """
    n = F.lit(buckets)
    first = plan.select(F.col("source").alias("of"), F.lit(0).cast("long").alias("start"), "budget")
    out = _holding(marked.withColumn("bucket", F.floor((1 - F.exp(-F.col("order_key"))) * n)), first)
    large = (F.col("rows") > ROWS_PER_BUCKET) & (F.col("low") < F.col("high"))
    while not out.where(large).isEmpty():
        ranges = out.where(large).select("of", "low", "high")
        inside = F.col("source").eqNullSafe(F.col("of")) & F.col("order_key").between(F.col("low"), F.col("high"))
        place = (F.col("order_key") - F.col("low")) / (F.col("high") - F.col("low"))
        binned = marked.join(ranges, inside).withColumn("bucket", F.least(F.floor(place * n), n - 1)).drop("of", "low", "high")
        out = out.where(~large).unionByName(_holding(binned, out.where(large).select("of", "start", "budget")))
    return out


def borders(sized: DataFrame, planned: DataFrame) -> DataFrame:
    """``planned`` with epochs, budget and the border row of each source (null if the budget is 0)."""
    marked = sized.select("source", "order_key", "doc_key", "size").where("size > 0")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = planned.withColumn("epochs", epochs).withColumn(
        "budget", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    )
    same = F.col("source").eqNullSafe(F.col("of"))
    found = holding(marked, plan, _buckets(sized.count())).drop("rows")
    inside = marked.join(found, same & F.col("order_key").between(F.col("low"), F.col("high")))
    order = ["order_key", "doc_key", "size"]
    inside = inside.groupBy("source", "start", "budget", *order).agg(F.count("*").alias("ties"))
    ahead = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("size") * F.col("ties")
    inside = inside.withColumn("start", F.col("start") + F.coalesce(F.sum(words).over(ahead), F.lit(0)))
    cut = inside.where((F.col("start") <= F.col("budget")) & (F.col("budget") < F.col("start") + words)).select(
        F.col("source").alias("of"),
        F.struct(*order).alias("border"),
        F.floor((F.col("budget") - F.col("start")) / F.col("ties")).cast("long").alias("border_words"),
    )
    return plan.join(cut, same, "left").drop("of")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with size, order_key and doc_key."""
    return docs.withColumn("size", size_of(F.col(text))).withColumn(
        "order_key", -F.log(uniform(F.col(key))) / quality(F.col(text))
    ).withColumn("doc_key", F.coalesce(F.col(key).cast("string"), F.lit("")))


def plan(rows: DataFrame, weight: Column | None = None, most: int = MOST) -> DataFrame:
    """Per source: size, weight, target, epochs, budget and border, from the rows of ``sized``."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = written(sources.withColumn("weight", cycle_weight() if weight is None else weight), "sources")
    return written(borders(rows, targets(sources, most)), "plan")


def take(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``rows`` of ``sized`` with source_size, target, epochs and taken; per row, no shuffle but the small join."""
    side = planned.select(F.col("source").alias("__of"), "source_size", "target", "epochs", "border", "border_words")
    joined = rows.join(side, F.col("source").eqNullSafe(F.col("__of")))
    place = F.struct("order_key", "doc_key", "size")
    part = F.when(F.col("border").isNull(), F.lit(0)).when(place < F.col("border"), F.col("size"))
    part = part.when(place == F.col("border"), F.col("border_words")).otherwise(F.lit(0))
    taken = (F.col("epochs") * F.col("size") + part).cast("long")
    return joined.withColumn("taken", taken).drop("__of", "border", "border_words", "order_key", "doc_key")


def shares(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    narrow = docs.select(F.col(key).alias("doc_id"), "source", F.col(text).cast("string").alias("text"))
    rows = written(sized(narrow).drop("text"), "sized")
    return take(rows, plan(rows)).select("doc_id", "size", "source_size", "target", "taken")


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents the mix takes, with epochs (complete copies), size and taken (words, repeats counted).

    The words beyond ``epochs * size`` are the first of the text. Texts are read twice and never moved.
    """
    keep = docs.columns
    narrow = docs.select(F.col(key).alias("doc_id"), "source", F.col(text).cast("string").alias("text"))
    planned = plan(written(sized(narrow).drop("text"), "sized"))
    row = docs.select(F.struct(*keep).alias("__row"), F.col("source"), F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    taken = take(sized(row), planned).where("taken > 0")
    return taken.select(*[F.col(f"__row.{c}").alias(c) for c in keep], F.struct("epochs", "size", "taken").alias("__mix")).select(
        *keep, *[F.col(f"__mix.{c}").alias(c if c not in keep else f"mix_{c}") for c in ("epochs", "size", "taken")]
    )
