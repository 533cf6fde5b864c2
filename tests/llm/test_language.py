import numpy as np
import pytest

from quillsift.llm import language as L
from quillsift.llm import queries as Q


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = [r for r in Q.op8_language(spark, folder).collect() if r["held_out"]]
    assert len(rows) > 2000
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.fixture(scope="module")
def net():
    return L.fit([(f"the and of {i} with".encode(), "en") for i in range(60)] + [(f"el que los {i} ñ una".encode(), "es") for i in range(60)])


def test_whole_texts_count(net):
    text = "the and of with " * 40 + "el que los ñ una " * 4000
    assert L.predict([text], net)[0][0] == "es"
    assert L.predict(["the and of with " * 400 + "el que"], net)[0][0] == "en"


def test_gradients_match_differences(net):
    rng = np.random.default_rng(0)
    small = L.Network(["a", "b", "c"])
    for w in small.weights():
        w += rng.normal(0, 0.1, w.shape).astype(np.float32)
    small.vectors[0] = 0
    codes, truth = rng.integers(1, 200, (5, L.LENGTH)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss():
        return -np.log(small.probabilities(codes)[np.arange(5), truth]).mean()

    for weights, gradient in zip(small.weights(), small.gradients(codes, truth)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before = weights[at]
        weights[at] = before + 2e-3
        up = loss()
        weights[at] = before - 2e-3
        down = loss()
        weights[at] = before
        assert (up - down) / 4e-3 == pytest.approx(gradient[at], rel=0.1, abs=1e-3)


def test_defined_results(spark, net):
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 !!", "x"), (4, "漢字 かな", "x"), (4, "the and of", "x"), (None, "the and of", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, language string")
    got = [r["found"] for r in L.identify(frame, net, into="found").collect()]
    assert [g["lang"] for g in got[:3]] == ["und"] * 3 and [g["score"] for g in got[:3]] == [0.0] * 3
    assert got[4] == got[5] and got[4]["lang"] == "en"
    kept = L.keep_known(frame, net)
    assert kept.columns == frame.columns and kept.count() == 3
    nothing = frame.where("false").selectExpr("*", "'en' as lang")
    assert L.train(nothing) is None and L.identify(nothing, None).count() == 0
    assert L.predict(["abc"], None) == [("und", 0.0)]
