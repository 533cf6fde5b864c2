"""Profiles of message tables, outliers, label separation and length reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsift.functions import text as T
from quillsift.operators.features import FLAGS, feature_kind, long_form
from quillsift.operators.order_stats import SMALL_ROWS, quantiles, running_totals
from quillsift.operators.prepare import subject_of
from quillsift.session import cut, small_side


def _digest(columns: list[str]) -> Column:
    """Digest of whole rows; lengths keep neighbouring values apart, nulls differ from ''."""
    parts = [
        F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
        for c in map(F.col, columns)
    ]
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256))


def source_summary(raw: DataFrame, columns: list[str]) -> DataFrame:
    """Per source: rows, columns of ``raw``, ham, spam, spam rate, missing bodies, rows that repeat in ``columns``."""
    per_row = raw.groupBy("Source", _digest(columns).alias("digest")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("Label") == 0).alias("ham"),
        F.count_if(F.col("Label") == 1).alias("spam"),
        F.count_if(F.col("Body").isNull()).alias("no_body"),
        F.sum("Label").alias("label_sum"),
        F.count("Label").alias("labels"),
    )
    return per_row.groupBy("Source").agg(
        F.sum("n").alias("rows"),
        F.lit(len(raw.columns)).cast("bigint").alias("cols"),
        F.sum("ham").alias("ham"),
        F.sum("spam").alias("spam"),
        F.try_divide(F.sum("label_sum").cast("double"), F.sum("labels")).alias("spam_rate"),
        F.sum("no_body").alias("missing_body"),
        (F.sum("n") - F.count("*")).alias("duplicate_rows"),
    )


def cleaning_summary(raw: DataFrame) -> DataFrame:
    """Per source: rows in, out and dropped, and the share of empty subjects, in one scan."""
    kept = F.col("Body").isNotNull()
    subject = T.plain_separators(subject_of(F.col("Body")))
    return raw.groupBy("Source").agg(
        F.count("*").alias("rows_in"),
        F.count_if(kept).alias("rows_out"),
        F.count_if(~kept).alias("rows_dropped"),
        F.avg(F.when(kept, (subject == "").cast("double"))).alias("empty_subject_rate"),
    )


def column_profile(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Per column (and group): type, rows, nulls and duplicate values, a null counting as one value.

    Cells are counted by digest first, so a value that fills a third of a column
    is one row per task in the shuffle.
    """
    by = by or []
    types = dict(df.dtypes)
    cells = df.select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.lit(types[c]).alias("dtype"),
                        F.col(c).isNull().alias("missing"),
                        F.unhex(F.sha2(F.col(c).cast("string"), 256)).alias("digest"),
                    )
                    for c in columns
                ]
            )
        )
    )
    values = cells.groupBy(*by, "column", "dtype", "missing", "digest").agg(F.count("*").alias("n"))
    return values.groupBy(*by, "column", "dtype").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("missing"), F.col("n")).otherwise(0)).alias("missing_values"),
        (F.sum("n") - F.count("*")).alias("duplicate_values"),
    )


def label_mix(df: DataFrame, by: list[str]) -> DataFrame:
    """(by, Label, count, share): label counts and their share within each group."""
    counts = df.groupBy(*by, "Label").agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(*by))
    return counts.select(*by, "Label", "count", (F.col("count") / total).alias("share"))


def label_mix_pivot(df: DataFrame, labels: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Comparison table: one row per source, counts and shares of each label as columns."""
    table = df.groupBy("Source").agg(
        F.count("*").alias("rows"), *[F.count_if(F.col("Label") == v).alias(f"count_{v}") for v in labels]
    )
    return table.select(
        "*", *[(F.col(f"count_{v}") / F.col("rows")).alias(f"share_{v}") for v in labels]
    )


def subject_prefix_rate(raw: DataFrame) -> DataFrame:
    """Per source: share of bodies that start with ``Subject:``, in any case and exactly."""
    def rate(hit: Column) -> Column:
        return F.avg(hit.cast("int"))

    return raw.groupBy("Source").agg(
        rate(F.col("Body").rlike(T.SUBJECT_PATTERN)).alias("any_case"),
        rate(F.col("Body").startswith("Subject:")).alias("exact_case"),
    )


def _value_counts(featured: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, value, pos, neg, n): all later passes read this instead of the messages."""
    return cut(
        long_form(featured, [label], features)
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) == 0).alias("neg"),
            F.count("*").alias("n"),
        )
    )


def outlier_report(featured: DataFrame, features: list[str], label: str = "Label") -> DataFrame:
    """Per numeric feature: quartile fences, outlier count, rate and label mix.

    Flags are left out. The fences come from exact quartiles of the counted
    values, and the outliers are summed from the same counts.
    """
    numeric = [c for c in features if c not in FLAGS]
    counts = _value_counts(featured, numeric, label)
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    fences = quantiles(counts, ["feature"], "value", "n", [0.25, 0.75]).select(
        "feature",
        "rows",
        (q1 - 1.5 * (q3 - q1)).alias("lower_bound"),
        (q3 + 1.5 * (q3 - q1)).alias("upper_bound"),
    )
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))

    def beyond(count: str) -> Column:
        return F.sum(F.when(outside, F.col(count)).otherwise(0))

    report = (
        counts.join(small_side(fences, SMALL_ROWS), "feature")
        .groupBy("feature", "lower_bound", "upper_bound", "rows")
        .agg(beyond("n").alias("outlier_count"), beyond("neg").alias("ham_count"), beyond("pos").alias("spam_count"))
    )

    def part(value: int, count: str) -> Column:
        mix = F.struct(F.lit(value), F.try_divide(F.col(count).cast("double"), F.col("outlier_count")))
        return F.when(F.col(count) > 0, mix)

    parts = F.array_compact(F.array(part(0, "ham_count"), part(1, "spam_count")))
    return report.select(
        "feature",
        "lower_bound",
        "upper_bound",
        "outlier_count",
        (F.col("outlier_count") / F.col("rows")).alias("outlier_rate"),
        F.map_from_entries(parts).alias("label_mix"),
        "ham_count",
        "spam_count",
    )


def outlier_label_counts(report: DataFrame) -> DataFrame:
    """Outliers per feature and label, fewest first."""
    return report.select("feature", "outlier_count", "ham_count", "spam_count").orderBy(
        "outlier_count", "feature"
    )


def label_separation(featured: DataFrame, features: list[str], label: str = "Label") -> DataFrame:
    """(feature, separation): distance of the feature's ROC area from one half."""
    counts = _value_counts(featured, features, label)
    ranked = running_totals(counts, ["feature"], "value", ["neg"], carry=["pos"])
    pairs = F.sum(F.col("pos").cast("double") * (F.col("before_neg") + F.col("neg") / 2))
    area = F.try_divide(pairs, F.sum("pos").cast("double") * F.sum("neg"))
    return ranked.groupBy("feature").agg(F.abs(area - 0.5).alias("separation"))


def top_features(separation: DataFrame, n: int = 12) -> DataFrame:
    return separation.orderBy(F.desc("separation"), "feature").limit(n)


def flag_rate_by_label(featured: DataFrame, flags: list[str], label: str = "Label") -> DataFrame:
    """(feature, Label, rate): share of messages that carry a flag."""
    rates = featured.groupBy(label).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in flags])
    return rates.unpivot([label], flags, "feature", "rate")


def feature_box_stats(featured: DataFrame, features: list[str], label: str = "Label") -> DataFrame:
    """Box-plot numbers per feature and label; counts on the log(1 + x) scale."""
    shown = F.when(feature_kind(F.col("feature")) == "count", F.log1p("value")).otherwise(F.col("value"))
    counts = cut(
        long_form(featured, [label], features)
        .groupBy("feature", label, "value")
        .agg(F.count("*").alias("n"))
        .withColumn("value", shown)
    )
    boxes = quantiles(counts, ["feature", label], "value", "n", [0.25, 0.5, 0.75]).select(
        "feature",
        label,
        "rows",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    box = ["feature", label, "rows", "q1", "median", "q3"]
    return (
        counts.join(small_side(boxes, SMALL_ROWS), ["feature", label])
        .groupBy(*box)
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
    )


def length_percentiles(
    lengths: DataFrame, units: list[str], percents: tuple[int, ...] = (50, 90, 95, 99, 100)
) -> DataFrame:
    """(percentile, one column per length column) over all messages."""
    counts = cut(
        lengths.select(*[F.col(u).cast("double").alias(u) for u in units])
        .unpivot([], units, "unit", "length")
        .groupBy("unit", "length")
        .agg(F.count("*").alias("n"))
    )
    points = quantiles(counts, ["unit"], "length", "n", [p / 100 for p in percents])
    rows = points.select(
        "unit", F.posexplode("quantiles").alias("at", "length"), F.array(*map(F.lit, percents)).alias("percents")
    )
    return (
        rows.withColumn("percentile", F.element_at("percents", F.col("at") + 1))
        .groupBy("percentile")
        .agg(*[F.max(F.when(F.col("unit") == u, F.col("length"))).alias(u) for u in units])
    )


def length_coverage(lengths: DataFrame, unit: str, candidates: list[int]) -> DataFrame:
    """Per candidate length: percentage of messages covered and truncated, in one scan."""
    shares = lengths.agg(
        *[F.avg((F.col(unit) <= c).cast("double")).alias(str(c)) for c in candidates]
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("candidate"), (F.col(f"`{c}`") * 100).alias("covered")) for c in candidates]
    )
    return shares.select(F.inline(rows)).withColumn("truncated", 100 - F.col("covered"))
