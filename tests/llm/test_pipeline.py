import corpus_pipeline
import pytest
from test_decontaminate import brute as contaminated
from test_jaccard import shingle_set
from test_mixing import expected_targets
from test_pii import brute as personal

import __spark_entry__ as contract
from quillsift.llm import language


def test_stages_against_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    states = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / name)
        stage(spark, states[-1], folder).write.parquet(out)
        states.append(spark.read.parquet(out))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert states[-1].columns == docs.columns
    first, known, unique, clean, redacted, mixed = ([r.asDict() for r in s.collect()] for s in states)

    assert len(known) >= 0.99 * len([r for r in first if r["text"] and language.LETTER.search(r["text"])])

    left = {r["doc_id"] for r in unique}
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in known}
    by_gram = {}
    for doc, grams in sets.items():
        for gram in grams:
            by_gram.setdefault(gram, set()).add(doc)
    near = {d: {o for g in s for o in by_gram[g] if o != d and 10 * len(s & sets[o]) >= 8 * len(s | sets[o])} for d, s in sets.items()}
    for doc in sets:
        group, todo = {doc}, [doc]
        while todo:
            fresh = near[todo.pop()] - group
            group |= fresh
            todo += fresh
        assert (doc in left) == (doc == min(group))

    hit = {row[0] for row in contaminated([(r["doc_id"], r["text"]) for r in unique], items) if row[5]}
    assert {r["doc_id"] for r in clean} == left - hit and hit

    before = {r["doc_id"]: r["text"] for r in clean}
    assert {r["doc_id"] for r in redacted} == set(before)
    for r in redacted:
        assert (r["text"] == before[r["doc_id"]]) == (not personal(before[r["doc_id"]])) and not personal(r["text"])

    _, targets = expected_targets([(r["doc_id"], r["text"], r["source"]) for r in redacted])
    for source, target in targets.items():
        assert abs(sum(r["taken"] for r in mixed if r["source"] == source) - target) <= 1


def test_run_is_registered_and_handles_odd_tables(spark, folder, tmp_path):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    rows = [(1, "One small text, of some words in it.", "en", "a", 3)] * 2 + [(None, None, None, None, None), (None, "Another text with a few other words", None, None, 1), (2, "", "en", "a", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("some", rows), ("none", [])):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / name / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    assert [r["doc_id"] for r in got] == [1] or {r["doc_id"] for r in got} == {1, None}
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("name", [f"op{n}_" for n in range(1, 11)])
def test_one_query_per_operator(name):
    assert len([q for q in contract.queries() if q.startswith(name)]) == 1
