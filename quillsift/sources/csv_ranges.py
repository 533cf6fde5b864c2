"""CSV files with quoted line breaks, one file read by many tasks.

The text source cuts a file into byte ranges and gives each range the lines that start in it. Whether a line
starts inside quotes depends on the number of quotes before it. So every line gets the parity of the quotes
before it within its range and two running numbers: how many records have begun so far if the range itself begins
outside quotes, and if inside. One row per range then tells by sums over the earlier ranges which of both holds,
and how many records came before: a line knows its record without any order among the tasks. Records of one
line stay where they are; lines of longer records are brought together by record number.

Doubled quotes inside quotes keep the parity. Blank lines between records are no records. A file that ends
inside quotes ends its last record there. An empty file has no records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsift.session import small_side

RANGE = ["file", "begin"]
#: Ranges whose rows are broadcast; more are joined by a shuffle.
SMALL_RANGES = 1_000_000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, begin, number, odd, odd_after, outside, inside, line) of every line, by its byte range.

    ``outside`` and ``inside`` count the records begun up to this line, itself included, in a range that begins
    outside or inside quotes.
    """
    found = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"),
        F.col("value").alias("line"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, n, odd, begun = None, 0, 0, [0, 0]
        for batch in batches:
            out = []
            for file, begin, line in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if (file, begin) != here:
                    here, n, odd, begun = (file, begin), 0, 0, [0, 0]
                before, odd = odd, (odd + line.count('"')) & 1
                # Begun outside quotes, a range is outside them again wherever the parity is even.
                begun[before] += line not in ("", "\r")
                out.append((n, before, odd, *begun))
                n += 1
            counts = [pa.array(column, pa.int64()) for column in zip(*out)] or [pa.array([], pa.int64())] * 5
            names = ["number", "odd", "odd_after", "outside", "inside"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *counts, batch.column(2)], [*RANGE, *names, "line"])

    schema = "file string, begin long, number long, odd long, odd_after long, outside long, inside long, line string"
    return found.mapInArrow(number, schema)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, row_id, first, record): every record as written, numbered over all files by path.

    ``first`` marks the first record of a file.
    """
    lines = numbered_lines(spark, path)
    ranges = lines.groupBy(*RANGE).agg(
        F.sum(F.when(F.col("odd") != F.col("odd_after"), 1).otherwise(0)).alias("turns"),
        F.max("outside").alias("outside"), F.max("inside").alias("inside"),
    )
    # One row per range of the files, so these windows stay small however long the lines are.
    of_file = Window.partitionBy("file").orderBy("begin")
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    opened = ranges.withColumn("open", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2)
    opened = opened.withColumn("begun", F.when(F.col("open") == 0, F.col("outside")).otherwise(F.col("inside")))
    before = Window.orderBy(*RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = opened.withColumn("before", F.coalesce(F.sum("begun").over(before), F.lit(0)))
    starts = starts.withColumn("file_start", F.min("before").over(Window.partitionBy("file")))
    starts = small_side(starts.select(*RANGE, "open", "before", "file_start"), SMALL_RANGES)
    own = F.when(F.col("open") == 0, F.col("outside")).otherwise(F.col("inside"))
    begins, ends = F.col("odd") == F.col("open"), F.col("odd_after") == F.col("open")
    placed = lines.join(starts, RANGE).select(
        *RANGE, "number", "line", (F.col("before") + own - 1).alias("row_id"), "file_start",
        (begins & ends).alias("whole"), (begins & F.col("line").isin("", "\r")).alias("blank"),
    ).where("not blank")
    # Null where a line is no record by itself: a filter on its parsed columns may move before this one.
    alone = F.when(F.col("whole"), F.col("line")).alias("record")
    single = placed.where("whole").select("file", "row_id", "file_start", alone)
    parts = F.array_sort(F.collect_list(F.struct("begin", "number", "line")))
    longer = placed.where("not whole").groupBy("file", "row_id", "file_start").agg(parts.alias("parts"))
    longer = longer.select("file", "row_id", "file_start", F.array_join(F.col("parts")["line"], "\n").alias("record"))
    return single.unionByName(longer).select(
        "file", "row_id", (F.col("row_id") == F.col("file_start")).alias("first"),
        F.regexp_replace("record", r"\r\z", "").alias("record"),
    )


def read(spark: SparkSession, path: str, columns: list[str], options: dict[str, str]) -> DataFrame:
    """(row_id, columns) of all records but each file's first; columns by position, as text."""
    schema = ", ".join("`" + c.replace("`", "``") + "` STRING" for c in columns)
    rows = records(spark, path).where("not first")
    # Line breaks inside quotes are read as \n, as the file reader does.
    text = F.when(~F.col("first"), F.regexp_replace("record", "\r\n", "\n"))
    return rows.select("row_id", F.from_csv(text, schema, options).alias("row")).select("row_id", "row.*")
