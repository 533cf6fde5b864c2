"""The 77 structural features of a message, and how they are named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.functions import text as T
from quillsift.functions.charsets import PUNCTUATION
from quillsift.operators.prepare import prepare

RATIO_ENDS = ("_upper_ratio", "_digit_ratio")
FLAG_ENDS = ("_has_http_url", "_has_web_url")
SHAPE_ENDS = ("_length", "_word_count", *RATIO_ENDS)
PUNCTUATION_ENDS = tuple(f"_{name}_count" for name in PUNCTUATION.values())


# Work columns: the text without a-z, and of that the punctuation alone.
REST, MARKS = "_rest", "_marks"


def part_features(text: Column, prefix: str) -> list[Column]:
    """Features of one text, given its work columns under the same prefix.

    Most characters are lower-case letters, so counting on what is left after
    they are removed is several times cheaper than one pass per character.
    """
    rest, marks = F.col(f"{prefix}{REST}"), F.col(f"{prefix}{MARKS}")
    upper = T.ascii_count(rest, "A-Z")
    letters = upper + F.octet_length(text) - F.octet_length(rest)
    values = {
        "length": F.char_length(text).cast("bigint"),
        "word_count": T.word_count(text),
        "upper_ratio": T.share(upper, letters),
        "digit_ratio": T.share(T.digit_count(rest), F.char_length(text)),
        "has_http_url": F.coalesce(marks.contains("://") & text.rlike(T.HTTP_PATTERN), F.lit(False)),
        "has_web_url": F.coalesce(text.rlike(T.WEB_PATTERN), F.lit(False)),
    }
    values.update({f"{name}_count": T.char_count(marks, char) for char, name in PUNCTUATION.items()})
    return [value.alias(f"{prefix}_{name}") for name, value in values.items()]


def with_features(messages: DataFrame, subject: str = "Subject", body: str = "Body") -> DataFrame:
    """All features next to the columns already there, computed in one pass over each row."""
    parts = {"subject": F.col(subject), "body": F.col(body)}
    kept = messages.columns
    work = messages.withColumns({f"{p}{REST}": T.without_lower(text) for p, text in parts.items()})
    work = work.withColumns({f"{p}{MARKS}": T.punctuation(F.col(f"{p}{REST}")) for p in parts})
    features = [column for p, text in parts.items() for column in part_features(text, p)]
    return work.select(*kept, *features, (F.char_length(F.col(subject)) > 0).alias("has_subject"))


def part_names(prefix: str) -> list[str]:
    return [
        f"{prefix}{end}" for end in (*SHAPE_ENDS, *FLAG_ENDS, *PUNCTUATION_ENDS)
    ]


FEATURES = [*part_names("subject"), *part_names("body"), "has_subject"]
FLAGS = [c for c in FEATURES if c.endswith(FLAG_ENDS) or c == "has_subject"]
NUMERIC = [c for c in FEATURES if c not in FLAGS]


def build_dataset(raw: DataFrame) -> DataFrame:
    """Prepared and featured messages of all sources, in one plan."""
    return with_features(prepare(raw))


def feature_kind(feature: Column) -> Column:
    def ends(suffixes: tuple[str, ...]) -> Column:
        return feature.rlike("(" + "|".join(suffixes) + ")$")

    return F.when(ends(FLAG_ENDS), "flag").when(ends(RATIO_ENDS), "ratio").otherwise("count")


def long_form(featured: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """(keys, feature, value): one row per message and feature, values as double."""
    wide = featured.select(*keys, *[F.col(c).cast("double").alias(c) for c in features])
    return wide.unpivot(keys, features, "feature", "value")


def spread(featured: DataFrame, features: list[str]) -> DataFrame:
    """(feature, varies, one_value): does a column hold several values, or exactly one?

    Two values differ exactly when the smallest is below the largest, so one
    aggregate without any distinct set answers for every column. Its single row
    is turned into one row per feature on the driver.
    """
    ends = featured.agg(
        *[F.min(c).alias(f"low_{c}") for c in features], *[F.max(c).alias(f"high_{c}") for c in features]
    ).first()
    rows = []
    for c in features:
        low, high = ends[f"low_{c}"], ends[f"high_{c}"]
        rows.append((c, low is not None and low < high, low is not None and low == high))
    return featured.sparkSession.createDataFrame(rows, "feature string, varies boolean, one_value boolean")


def varying_features(featured: DataFrame, features: list[str]) -> list[str]:
    """Names of the columns with more than one distinct value, in their given order."""
    varying = {r["feature"] for r in spread(featured, features).where("varies").collect()}
    return [c for c in features if c in varying]


def constant_features(featured: DataFrame, features: list[str]) -> list[str]:
    """Names of the columns with exactly one distinct value; all-null ones are not among them."""
    constant = {r["feature"] for r in spread(featured, features).where("one_value").collect()}
    return [c for c in features if c in constant]


# The categories of the report.
CATEGORIES = ["shape/ratio features", "embedded/link flags", "punctuation counts", "other"]


def feature_summary(names: DataFrame) -> DataFrame:
    """Count and list of the features of each category, 0 and empty where none, from a table of feature names."""
    def ends(suffixes: tuple[str, ...]) -> Column:
        return F.col("feature").rlike("(" + "|".join(suffixes) + ")$")

    category = (
        F.when(ends(SHAPE_ENDS), "shape/ratio features")
        .when(ends(FLAG_ENDS), "embedded/link flags")
        .when(ends(PUNCTUATION_ENDS), "punctuation counts")
        .otherwise("other")
    )
    categories = names.sparkSession.createDataFrame([(c,) for c in CATEGORIES], "category string")
    return categories.join(names.withColumn("category", category), "category", "left").groupBy("category").agg(
        F.count("feature").alias("count"), F.array_sort(F.collect_list("feature")).alias("list")
    )
