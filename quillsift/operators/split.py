"""Exact, repeatable splits and samples decided by a hash of the row key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsift.functions.text import row_hash
from quillsift.operators.order_stats import SMALL_ROWS, hash_cutoffs
from quillsift.operators.prepare import KEY
from quillsift.session import cut, small_side


def source_and_label() -> Column:
    return F.concat_ws("_", F.col("Label").cast("string"), F.col("Source"))


def quotas(sizes: DataFrame, test_size: float) -> DataFrame:
    """(stratum, n, quota) from (stratum, n): proportional shares, largest remainders first."""
    whole = Window.partitionBy()
    share = F.col("n") * F.col("wanted") / F.col("total")
    by_remainder = Window.orderBy(F.desc("remainder"), "stratum")
    return (
        sizes.withColumn("total", F.sum("n").over(whole))
        .withColumn("wanted", F.ceil(F.lit(float(test_size)) * F.col("total")))
        .withColumn("floor", F.floor(share))
        .withColumn("remainder", (F.col("n") * F.col("wanted")) % F.col("total"))
        .withColumn("left_over", F.col("wanted") - F.sum("floor").over(whole))
        .withColumn("turn", F.row_number().over(by_remainder))
        .withColumn("quota", F.col("floor") + (F.col("turn") <= F.col("left_over")).cast("bigint"))
        .select("stratum", "n", "quota")
    )


def _check_strata(sizes: DataFrame, least: int) -> None:
    poor = [r["stratum"] for r in sizes.where(F.col("n") < least).limit(5).collect()]
    if poor:
        raise ValueError(f"strata with fewer than {least} rows: {poor}")


def _keyed(rows: DataFrame, stratum: Column, seed: int) -> DataFrame:
    return rows.withColumn("stratum", stratum.cast("string")).withColumn("hash", row_hash(seed, *KEY))


def stratified(rows: DataFrame, stratum: Column, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` = train / test with exact quotas per stratum.

    The rows are scanned three times (sizes, histogram, split) and never
    shuffled: write them out first if they are costly to compute.
    """
    keyed = _keyed(rows, stratum, seed)
    sizes = cut(keyed.groupBy("stratum").agg(F.count("*").alias("n")))
    _check_strata(sizes, 2)
    wanted = quotas(sizes, test_size).select("stratum", F.lit(0).alias("cut_no"), F.col("quota").alias("rank"))
    cutoffs = hash_cutoffs(keyed, "stratum", "hash", wanted).drop("cut_no")
    in_test = F.coalesce(F.col("hash") <= F.col("cutoff"), F.lit(False))
    return (
        keyed.join(small_side(cutoffs, SMALL_ROWS), "stratum", "left")
        .withColumn("split", F.when(in_test, "test").otherwise("train"))
        .drop("stratum", "hash", "cutoff")
    )


def folds(rows: DataFrame, label: str = "Label", k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1: within each label the sizes differ by at most one row."""
    keyed = _keyed(rows, F.col(label), seed)
    sizes = cut(keyed.groupBy("stratum").agg(F.count("*").alias("n")))
    _check_strata(sizes, k)
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(k - 1)),
        lambda i: F.struct(
            i.alias("cut_no"),
            (i * F.floor(F.col("n") / k) + F.least(i.cast("bigint"), F.col("n") % k)).alias("rank"),
        ),
    )
    wanted = sizes.select("stratum", F.inline(ends))
    cutoffs = (
        hash_cutoffs(keyed, "stratum", "hash", wanted)
        .groupBy("stratum")
        .agg(F.array_sort(F.collect_list("cutoff")).alias("cutoffs"))
    )
    passed = F.size(F.filter("cutoffs", lambda c: c < F.col("hash")))
    return (
        keyed.join(small_side(cutoffs, SMALL_ROWS), "stratum")
        .withColumn("fold", passed)
        .drop("stratum", "hash", "cutoffs")
    )


def sample(rows: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """At most n rows, the same ones on every run: the n smallest hashes."""
    return rows.withColumn("hash", row_hash(seed, *KEY)).orderBy("hash").limit(n).drop("hash")


def hold_out(rows: DataFrame, share: float = 0.1, seed: int = 42) -> DataFrame:
    """Add ``split`` = train / validation: an exact share of all rows, for early stopping."""
    marked = stratified(rows, F.lit("all"), share, seed)
    return marked.withColumn("split", F.when(F.col("split") == "test", "validation").otherwise("train"))


def with_class_weights(rows: DataFrame, label: str = "Label") -> DataFrame:
    """Add ``weight`` = rows / (classes * rows of the class): both classes weigh the same."""
    sizes = rows.groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy()
    weights = sizes.select(
        label,
        (F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n"))).alias("weight"),
    )
    return rows.join(small_side(weights, SMALL_ROWS), label)
