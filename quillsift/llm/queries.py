"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm import bytepairs, chat, decontaminate, html_extract, importance, jaccard, language, mixing, nearest, pii, repair, toxicity, urlfilter

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _fold(parts: int):
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.scan(docs, _table(spark, folder, "benchmark")))


def op2_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    found = html_extract.extract(pages, html_extract.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pii.digest(pii.scan(docs, pii.train(docs)))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.join(docs).select("doc_id", "class_id", "n_links", "n_text_links")


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return chat.rendered(_table(spark, folder, "conversations")).select(
        "conv_id", "perspective", "chunk", "n_turns", "start_char", "n_masked",
        F.sha2("text", 256).alias("text_sha256"), F.array_join(spans, ",").alias("mask"),
    )


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.shares(_table(spark, folder, "documents").select("doc_id", "source", "text"))


def op7_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.search(_table(spark, folder, "embeddings"))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(_fold(3) == 1, F.lit(False))
    net = language.train(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), net)
    return found.select("doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    model = toxicity.train(docs, _table(spark, folder, "labels").where(~held_out))
    scored = toxicity.score(docs, model, into="score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return urlfilter.judged(pages).select("page.page_id", "host", "path", "rule", "verdict", "template")


def op11_importance(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = importance.resample(docs, _table(spark, folder, "benchmark"), carry=["doc_id"])
    return found.select("doc.doc_id", "n_features", "weight", "score", "rank")


def op12_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = bytepairs.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    ids = F.col("ids")
    # (?U) gives the pattern's classes their Unicode meaning, as the library has it.
    return bytepairs.encode(docs, ranks, "(?U)" + public_tokenizers.PATTERN).select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"), F.sha2(bytepairs.little_endian(ids, ranks), 256).alias("ids_sha256"),
        F.sha2(bytepairs.decode(ids, ranks), 256).alias("decoded_sha256"),
    )


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return repair.reports(rows, repair.damaged(rows), F.col("copies"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_html_extract, op3_pii, op4_jaccard_join, op5_chat_format, op6_mix_sources, op7_nearest, op8_language,
        op9_toxicity, op10_url_filter, op11_importance, op12_byte_pairs, op13_repair,
    )
}
