"""Registered queries run with the functions' own defaults."""

import inspect

import pytest
from pyspark.sql import functions as F

from quillsift.operators import subword as sw
from quillsift.plans import queries as Q

FULL = {
    "grid_search": ("ln.grid_search", {"grid": None, "k": 5}),
    "random_search": ("search", {"trials": 15}),
    "neural_scores": ("fit_neural", {"embedding_dim": 64, "dense_units": 32}),
    "train_report": ("classic_train", {"vocab_size": 20_000}),
    "bpe_train": ("sw.learn", {"vocab_size": 20_000}),
    "subword_tfidf": ("sw.learn", {"vocab_size": 20_000}),
}


class Called(Exception):
    pass


@pytest.mark.parametrize("name", FULL)
def test_queries_do_the_full_job(spark, monkeypatch, name):
    path, wanted = FULL[name]
    *owner, attribute = path.split(".")
    holder = getattr(Q, owner[0]) if owner else Q
    signature = inspect.signature(getattr(holder, attribute))

    def stand_in(*args, **kwargs):
        bound = signature.bind(*args, **kwargs)
        bound.apply_defaults()
        raise Called({k: bound.arguments[k] for k in wanted})

    monkeypatch.setattr(holder, attribute, stand_in)
    monkeypatch.setattr(Q, "documents", lambda spark, folder: None)
    monkeypatch.setattr(Q, "experiment", lambda spark, folder: (None, None, []))
    monkeypatch.setattr(Q.tables, "raw_messages", lambda spark, folder: None)
    if path != "sw.learn":
        monkeypatch.setattr(Q, "training", lambda spark, folder: (None, None, []))
    with pytest.raises(Called) as called:
        Q.QUERIES[name](spark, f"none-{name}")
    assert called.value.args[0] == wanted


def test_feature_summary_follows_the_rows(spark, folder, monkeypatch):
    full = Q.featured_messages(spark, folder)
    for rows, counts in ((full.limit(20), 77), (full.where("false"), 0), (full.withColumn("body_length", F.lit(None)), 76)):
        monkeypatch.setattr(Q, "featured_messages", lambda spark, folder, rows=rows: rows)
        assert Q.feature_summary(spark, folder).agg(F.sum("count")).first()[0] == counts


def test_encoded_ids_are_in_a_query(spark, folder, monkeypatch):
    texts = spark.createDataFrame([(1, "low lower lowest"), (2, "né 1"), (3, "")], "doc_id int, text string")
    model = sw.learn(texts, vocab_size=270)
    monkeypatch.setattr(Q, "documents", lambda spark, folder: texts)
    monkeypatch.setattr(Q, "document_subwords", lambda spark, folder: model)
    rows = Q.bpe_ids(spark, folder).collect()
    wanted = {r["doc_id"]: r["ids"] for r in texts.select("doc_id", sw.encode(F.col("text"), model).alias("ids")).collect()}
    assert {r["doc_id"]: r["ids"] for r in rows} == wanted and len(wanted[1]) < 17
    sizes = model.token_sizes()
    assert {r["doc_id"]: r["n_bytes"] for r in Q.bpe_encode(spark, folder).collect()} == {k: sum(sizes[i] for i in ids) for k, ids in wanted.items()}
