import time

from pyspark.sql import functions as F

from quillsift.llm import decontaminate, language, pii
from quillsift.llm.spans import cut, named_span, replaced


def test_overlapping_spans_become_one():
    def spans(*found):
        return [{"start": s, "end": e, "name": n} for s, e, n in found]

    assert cut("0123456789", spans((2, 4, "<b>"), (0, 1, "<a>"), (3, 6, "<c>"), (6, 7, "<d>"))) == "<a>1<b><d>789"
    assert cut("ab", spans()) == "ab" and cut(None, spans((0, 1, "x"))) is None and cut("", []) == ""
    assert cut("😀x😀", spans((1, 2, "_"))) == "😀_😀"


def test_a_text_of_very_many_spans(spark):
    start = time.perf_counter()
    text = "ab " * 200_000
    row = spark.createDataFrame([(text,)], "text string").withColumn("s", F.transform(F.sequence(F.lit(0), F.lit(199_999)), lambda i: named_span(3 * i, 3 * i + 1, F.lit("<x>"))))
    assert row.select(replaced(F.col("text"), F.col("s")).alias("t")).first()["t"] == "<x>b " * 200_000
    assert time.perf_counter() - start < 60


def test_columns_of_any_name_come_back(spark):
    rows = [(1, "Write to ann@example.com now", 7, 8, 9, 10, 11), (2, None, 1, 2, 3, 4, 5), (3, "one two three four five six seven eight nine ten eleven", 0, 0, 0, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, hits int, pii int, language int, left int")
    items = spark.createDataFrame([("i", "two three four five six seven eight nine ten eleven")], "item_id string, text string")
    clean = decontaminate.clean(docs, items)
    assert clean.columns == docs.columns and sorted(map(tuple, clean.collect())) == sorted(rows[:2])
    cleaned = {r["doc_id"]: tuple(r) for r in decontaminate.clean(docs, items, remove="spans").collect()}
    assert cleaned[3] == (3, "one ", 0, 0, 0, 0, 0) and cleaned[1] == rows[0] and cleaned[2] == rows[1]
    hidden = {r["doc_id"]: tuple(r) for r in pii.redact(docs, None).collect()}
    assert hidden[1] == (1, "Write to <email> now", 7, 8, 9, 10, 11) and hidden[2] == rows[1]
    texts = [(i, f"{word} " * 30, i, i, i, i, i, lang) for i, (word, lang) in enumerate([("hello the", "en"), ("über nicht", "de")] * 30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, row int, hits int, pii int, language int, left int, lang string")
    kept = language.keep_known(docs, language.train(docs), least=0.0)
    assert kept.columns == docs.columns and all(r["row"] == r["doc_id"] == r["language"] for r in kept.collect())


def test_lists_of_spans_join_in_one_pass(spark):
    old = [(i, i + 1, 2 * i, 2 * i + 1) for i in range(0, 60_000, 2)]
    new = [(i, i + 1, 2 * i, 2 * i + 1) for i in range(1, 60_000, 2)]
    kind = decontaminate.SPANS
    row = spark.createDataFrame([(old, new), ([], [(3, 5, 6, 9)])], f"a {kind}, b {kind}")
    got = row.select(decontaminate.joined_spans(F.col("a"), F.col("b")).alias("s")).collect()
    assert [tuple(s) for s in got[0]["s"]] == [(0, 60_000, 0, 119_999)] and [tuple(s) for s in got[1]["s"]] == [(3, 5, 6, 9)]
