import numpy as np
import pytest

from quillsift.llm import queries as Q
from quillsift.llm import toxicity as T


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in Q.op9_toxicity(spark, folder).collect() if r["held_out"] and truth.get(r["doc_id"]) is not None]
    toxic = [r for r in rows if truth[r["doc_id"]] == 1]
    clean = [r for r in rows if truth[r["doc_id"]] == 0]
    assert np.mean([r["predicted"] for r in toxic]) >= 0.9 and np.mean([r["predicted"] for r in clean]) <= 0.01


@pytest.fixture(scope="module")
def lexicon():
    return T.Lexicon({"idiot": 2.0, "tras": 1.0})


def reading(lexicon, text):
    return dict(zip(T.READINGS, lexicon.clause(text.lower().split())))


def test_clauses_are_read_by_the_composed_grammar(lexicon):
    assert reading(lexicon, "an idiot here")["plain"] == 2
    assert reading(lexicon, "you idiot")["aimed"] == 2
    assert reading(lexicon, "idiot that you are") == dict.fromkeys(T.READINGS, 0) | {"aimed": 2}
    assert reading(lexicon, "not an idiot")["negated"] == 2
    assert reading(lexicon, "not once in years an idiot")["plain"] == 2
    assert reading(lexicon, "he wrote trashy things")["reported"] == 1
    assert reading(lexicon, "kill time")["threat"] == 1
    assert reading(lexicon, "kill you")["threat_aimed"] == 1
    assert reading(lexicon, "nothing at all") == dict.fromkeys(T.READINGS, 0)


def test_clauses_not_words_are_scored(lexicon):
    trie = lexicon.trie()
    assert lexicon.features("you. idiot", trie)[0] > 0 and lexicon.features("you idiot", trie)[1] > 0
    assert lexicon.features("antitras", trie) == lexicon.features("", trie) == lexicon.features(None, trie)


def test_defined_results(spark):
    docs = [(i, "you are an idiot, clearly" if i % 3 == 0 else "a calm text") for i in range(60)] + [(None, "idiot"), (70, None), (71, ""), (71, ""), (72, "word " * 200_000 + "idiot")]
    frame = spark.createDataFrame([(d, t, 1.0) for d, t in docs], "doc_id long, text string, toxicity double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(0, 0), (None, 1), (5, None), (500, 1)], "doc_id long, toxic int")
    model = T.train(frame, labels)
    got = {(r["doc_id"], r["text"]): r["s"] for r in T.score(frame, model, into="s").collect()}
    assert got[0, "you are an idiot, clearly"] > 0.5 > got[1, "a calm text"] == got[70, None] == got[71, ""]
    assert got[72, docs[-1][1]] > got[1, "a calm text"]
    assert T.train(frame, labels.where("false")) is None
    assert {r["s"] for r in T.score(frame, None, into="s").collect()} == {0.0}
    assert T.score(frame.where("false"), model).count() == 0


def test_short_words_are_learned_as_whole_words(spark):
    docs = [(i, "oh you zog, leave" if i % 3 == 0 else "a calm zogging text") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    mixed = frame.selectExpr("doc_id", "replace(text, ', leave', '') as text")
    model = T.train(mixed, labels)
    assert "zog" in model.lexicon.stems and "you" not in model.lexicon.stems
    trie = model.lexicon.trie()
    insult, clean = model.scores(["an old zog", "some zogging and 1zog"], trie)
    assert insult > 0.5 > clean == model.scores([""], trie)[0]


def test_a_target_moves_the_weight_of_the_match_that_waits():
    lexicon = T.Lexicon({"moron": 3.0, "idiot": 5.0})
    found = dict(zip(T.READINGS, lexicon.clause("moron not idiot you".split()).tolist()))
    assert sorted(found.values()) == [0, 0, 0, 0, 3, 5] and list(found.values())[:3] == [0, 3, 5]
