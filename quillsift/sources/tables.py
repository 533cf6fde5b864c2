"""Message, score and request views over the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Tables whose texts are costly to process, with the key that spreads them.
TEXT_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}
SPREAD = "spark.quillsift.spread"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table, read as it is.

    One-file tables of a single machine have one split. There, and only if the session asks for it by
    ``spark.quillsift.spread``, text tables are dealt to that many partitions.
    """
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    parts = spark.conf.get(SPREAD, None)
    return rows.repartition(int(parts), TEXT_KEYS[name]) if parts and name in TEXT_KEYS else rows


def raw_messages(spark: SparkSession, folder: str, labelled: bool = True) -> DataFrame:
    """Documents as raw messages; a third each with 'Subject: ', 'SUBJECT:', no prefix.

    Without ``labelled`` all documents are there, their label null where there is none.
    """
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    turn = F.col("doc_id") % 3
    body = (
        F.when(turn == 0, F.concat(F.lit("Subject: "), F.col("text")))
        .when(turn == 1, F.concat(F.lit("SUBJECT:"), F.col("text")))
        .otherwise(F.col("text"))
    )
    return documents.join(labels, "doc_id", "inner" if labelled else "left").select(
        F.col("lang").alias("Source"),
        F.col("doc_id").alias("row_id"),
        body.alias("Body"),
        F.col("toxic").alias("Label"),
    )


def raw_messages_nulls(spark: SparkSession, folder: str, labelled: bool = True) -> DataFrame:
    """The same messages, some of them with a missing body."""
    missing = F.col("row_id") % 50 == 7
    return raw_messages(spark, folder, labelled).withColumn("Body", F.when(~missing, F.col("Body")))


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    return as_requests(table(spark, folder, "events"))


def as_requests(events: DataFrame) -> DataFrame:
    """Events as a log of scoring requests from a sweep over users and batch sizes."""
    user, event = F.col("user_id") % 5, F.col("event_id") % 5
    return events.select(
        "event_id",
        "ts",
        F.col("value").alias("response_ms"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("failed"),
        F.when(user == 0, 1).when(user == 1, 5).when(user == 2, 10).when(user == 3, 25).otherwise(50).alias("users"),
        F.when(event == 0, 1).when(event == 1, 2).when(event == 2, 5).when(event == 3, 10).otherwise(20).alias("batch_size"),
    )


def unlabelled_messages(spark: SparkSession, folder: str) -> DataFrame:
    return as_messages(table(spark, folder, "conversations"))


def as_messages(turns: DataFrame) -> DataFrame:
    """Conversation turns as messages to score: (msg_id, subject, body)."""
    return turns.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("msg_id"),
        F.col("role").alias("subject"),
        F.col("text").alias("body"),
    )
