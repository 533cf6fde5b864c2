"""Result files of a load test."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column of a statistics file, our name, type.
STATS = [
    ("Request Count", "requests", "int"),
    ("Failure Count", "failures", "int"),
    ("Requests/s", "rps", "double"),
    ("Median Response Time", "median_ms", "double"),
    ("95%", "p95_ms", "double"),
    ("99%", "p99_ms", "double"),
]
SUMMARY_SCHEMA = (
    "users int, batch_size int, requests int, failures int, rps double, median_ms double, p95_ms double, p99_ms double"
)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """Totals of one statistics file: its row named 'Aggregated'."""
    rows = spark.read.option("header", True).csv(path).where(F.col("Name") == "Aggregated")
    if rows.isEmpty():
        raise ValueError(f"no 'Aggregated' row in {path}")
    return rows.select(*[F.col(f"`{c}`").cast(t).alias(name) for c, name, t in STATS])


def write_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").option("header", True).csv(path)


def latest_summary(spark: SparkSession, folder: str, tag: str) -> DataFrame:
    """Summary of the newest run whose folder is ``<tag>-<stamp>``: one file, or all part files of a folder."""
    pattern = f"{folder}/{tag}-[0-9]*/summary.csv"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    summary = F.regexp_extract("path", r"^(.*?/summary\.csv)(?:/|$)", 1)
    newest = files.agg(F.max(summary).alias("path")).first()["path"]
    if newest is None:
        raise LookupError(f"no run of {tag} in {folder}")
    return spark.read.schema(SUMMARY_SCHEMA).option("header", True).csv(newest)
