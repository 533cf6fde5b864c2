import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quillsift.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size string, target int, epochs int"


def sample(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a"] * 5 + ["b", "ü", None, "c"])
        text = rng.choice([None, "", " ".join("w" * rng.randint(1, 6) + rng.choice(["", "#", "\u00a0x"]) for _ in range(rng.randint(1, 90)))])
        rows.append((None if i % 50 == 9 else i, text, source, "s", 1, 2))
    rows.append((9999, "big " * 30_000, "b", "s", 1, 2))
    return rows + [rows[-1], rows[0], rows[0]]


def expected_targets(rows):
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(order)
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return sizes, target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = 3 * sizes[s]
            free.discard(s)


def test_targets_and_totals(spark):
    rows = sample()
    sizes, targets = expected_targets(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = M.shares(frame.withColumn("text", F.col("text")))
    assert got.count() == len(rows)
    by_source = M.take(M.sized(frame.drop("size", "target", "epochs")), M.plan(M.sized(frame.drop("size", "target", "epochs"))))
    for r in by_source.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.first("source_size").alias("s")).collect():
        assert r["s"] == sizes[r["source"]] and r["t"] == pytest.approx(targets[r["source"]])
        assert abs(r["n"] - r["t"]) <= 2
    assert by_source.where("taken > 3 * size").count() == 0


def test_reruns_agree_and_heavier_documents_come_first(spark):
    frame = spark.createDataFrame(sample(), SCHEMA)
    first, again = ({tuple(r) for r in M.shares(frame.repartition(n)).collect()} for n in (2, 5))
    assert first == again
    keys = M.sized(spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "good words here").otherwise("### @@@ bad").alias("text")))
    good, bad = (keys.where(f"doc_id % 2 = {k}").agg(F.avg("order_key")).first()[0] for k in (0, 1))
    assert good == pytest.approx(1, abs=0.1) and bad > 1.5


def test_mixture_keeps_columns_and_empty_table(spark):
    frame = spark.createDataFrame(sample(), SCHEMA)
    got = M.mixture(frame)
    assert got.columns[: len(frame.columns)] == frame.columns and got.columns[len(frame.columns) :] == ["mix_epochs", "mix_size", "taken"]
    assert got.where("taken <= 0").count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert M.shares(empty).count() == 0 and M.mixture(empty).count() == 0
    assert math.isfinite(M.sized(frame.drop("size")).agg(F.max("order_key")).first()[0])


def test_the_border_bucket_of_a_poor_source_is_refined(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_BUCKET", 50)
    rows = M.written(M.sized(spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("#### ####").alias("text"), F.lit("a").alias("source"))), "rows")
    planned = spark.createDataFrame([("a", 6000, 4000.0)], "source string, source_size long, target double")
    marked = rows.select("source", "order_key", "doc_key", "size")
    found = M.holding(marked, planned.selectExpr("source", "4000L AS budget"), M.LEAST_BUCKETS).collect()
    assert len(found) == 1 and found[0]["rows"] <= 50 and found[0]["low"] > 5
    border = M.borders(rows, planned).first()["border"]
    assert border["order_key"] == sorted(r["order_key"] for r in rows.collect())[2000]
