"""CSV sources: one file per source, or one folder per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.operators.prepare import union_sources
from quillsift.sources import csv_ranges

SCHEMA = "Body string, Label int"
# Texts that also count as missing on request.
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


FORMAT = {"quote": '"', "escape": '"', "mode": "FAILFAST"}


def _reader(spark: SparkSession):
    return spark.read.options(header=True, multiLine=True, **FORMAT)


def _body(pandas_nulls: bool) -> Column:
    body = F.col("Body")
    return F.when(~body.isin(NULL_WORDS), body) if pandas_nulls else body


def read_file(spark: SparkSession, path: str, source: str | None = None, pandas_nulls: bool = False) -> DataFrame:
    """One CSV as raw messages; columns are taken by name, others are ignored.

    A file is read by many tasks, quoted line breaks or not; ``row_id`` is the number of the record. In a folder
    all files have the columns of one.
    """
    name = source if source is not None else path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".csv")
    rows = csv_ranges.read(spark, path, _reader(spark).csv(path).columns, FORMAT)
    return rows.select(
        F.lit(name).alias("Source"),
        "row_id",
        _body(pandas_nulls).alias("Body"),
        F.col("Label").cast("int").alias("Label"),
    )


def read_named(spark: SparkSession, paths: dict[str, str], pandas_nulls: bool = False) -> DataFrame:
    """Named files as one table."""
    return union_sources([read_file(spark, p, name, pandas_nulls) for name, p in paths.items()])


def read_sources(
    spark: SparkSession, file: str | None = None, folder: str | None = None, pandas_nulls: bool = False
) -> DataFrame:
    """One file, or every ``*.csv`` of a folder; the file stem names the source."""
    if (file is None) == (folder is None):
        raise ValueError("give either a file or a folder")
    if file is not None:
        return read_file(spark, file, pandas_nulls=pandas_nulls)
    # Only paths are selected, so the listing reads no file content.
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path")
    paths = sorted(r["path"] for r in listing.collect())
    if not paths:
        raise ValueError(f"no CSV file in {folder}")
    return union_sources([read_file(spark, p, pandas_nulls=pandas_nulls) for p in paths])


def write_by_source(raw: DataFrame, path: str) -> None:
    """One folder per source, many files each."""
    raw.select("Source", "Body", "Label").write.partitionBy("Source").options(
        header=True, quote='"', escape='"', emptyValue='""'
    ).csv(path)


def read_by_source(spark: SparkSession, path: str) -> DataFrame:
    """Folders written by ``write_by_source``, read in one parallel scan."""
    return _reader(spark).schema(f"{SCHEMA}, Source string").csv(path).select("Source", "Body", "Label")
