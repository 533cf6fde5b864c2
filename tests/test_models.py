import json
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quillsift.operators import bayes, linear as ln, search, subword as sw, vectors as vc
from quillsift.operators.neural import fit_neural
from quillsift.operators.score import score_inputs
from quillsift.plans.experiment import classic_train, classic_tune
from quillsift.sources import registry
from quillsift.streaming import streams as st

SPAM = ["win free money now!!!", "free prize click here", "cheap pills free offer", "money money win prize"]
HAM = ["meeting notes for monday", "lunch with the team today", "please review the report", "notes from the project call"]


@pytest.fixture(scope="module")
def raw(spark):
    rows = []
    for i in range(48):
        label = i % 2
        words = (SPAM if label else HAM)[(i // 2) % 4]
        rows.append(("one" if i % 3 else "two", i, f"Subject: {words}\n{words} number {i}", label))
    return spark.createDataFrame(rows, "Source string, row_id long, Body string, Label int")


@pytest.fixture(scope="module")
def trained(spark, raw, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("registry"))
    model, record = classic_train(raw, folder, "baseline", vocab_size=300, C=10.0, max_iter=50)
    return folder, model, record.first()


def test_report_of_a_separable_set(trained):
    _, _, record = trained
    assert record["metrics"]["f1"] == 1.0 and record["metrics"]["roc_auc"] == 1.0
    assert record["input_data"]["train_rows"] + record["input_data"]["test_rows"] == 48


def test_run_record_round_trip(spark, trained):
    folder, _, _ = trained
    run = registry.load_runs(spark, f"{folder}/runs").first()
    assert (run["run"], run["model"], run["f1"]) == ("baseline", "classic", 1.0)
    assert "C=10.0" in run["hyperparameters"]


def test_indented_run_files(spark, tmp_path):
    record = {"operation": "dnn train", "duration_seconds": 1.5, "hyperparameters": {}, "metrics": {"f1": 0.5}}
    (tmp_path / "some_run.metrics.json").write_text(json.dumps(record, indent=2))
    run = registry.load_runs(spark, str(tmp_path / "*.metrics.json"), one_per_file=True).first()
    assert (run["run"], run["model"], run["hyperparameters"], run["f1"]) == ("some_run", "dnn", "(defaults)", 0.5)


def test_registered_model_scores_the_same(spark, trained):
    folder, model, _ = trained
    rows = [("1", SPAM[0], f"{SPAM[0]} number 7"), ("2", HAM[0], f"{HAM[0]} number 8"), ("3", None, "no subject")]
    messages = spark.createDataFrame(rows, "msg_id string, subject string, body string")
    inputs = score_inputs(messages, model.features)
    again = registry.load_model(spark, folder, "baseline")
    left, right = (
        [r["spam_probability"] for r in m.score(inputs, ["msg_id"]).orderBy("msg_id").collect()] for m in (model, again)
    )
    assert left == pytest.approx(right) and left[0] > 0.5 > left[1]


def test_registry_checks_version_and_type(spark, trained, tmp_path):
    folder, _, _ = trained
    rows = registry.manifest(spark, folder)
    rows.withColumn("schema_version", F.lit(2)).write.parquet(str(tmp_path / "old" / "manifest"))
    with pytest.raises(ValueError):
        registry.load_model(spark, str(tmp_path / "old"), "baseline")
    rows.withColumn("model_type", F.lit("other")).write.parquet(str(tmp_path / "odd" / "manifest"))
    with pytest.raises(ValueError):
        registry.load_model(spark, str(tmp_path / "odd"), "baseline")
    with pytest.raises(LookupError):
        registry.load_model(spark, folder, "unknown")


def test_tuning_picks_from_the_grid(spark, raw, tmp_path):
    grid = {"C": [0.1, 1.0], "max_features": [50], "ngrams": [(1, 1)]}
    model, record = classic_tune(raw, str(tmp_path), "tuned", grid, k=2, vocab_size=270)
    assert model.params["C"] in grid["C"] and 0 <= record.first()["best_cv_f1"] <= 1


def test_steps_of_a_fit_carry_no_vocabulary(spark, monkeypatch):
    """Every step sends the plan of its vectors: neither stages nor a name per term belong there."""
    rows = [("one", i, i % 2, (SPAM if i % 2 else HAM)[i % 4].split(), float(i), 1.0) for i in range(40)]
    table = spark.createDataFrame(rows, "Source string, row_id long, Label int, tokens array<string>, f double, weight double")
    seen, plain = [], ln.regression

    class Watched:
        def __init__(self, *given):
            self.inner = plain(*given)

        def fit(self, vectors):
            seen.append(vectors)
            return self.inner.fit(vectors)

    monkeypatch.setattr(ln, "regression", lambda *given: Watched(*given))
    monkeypatch.setattr(search, "regression", lambda *given: Watched(*given))
    ln.fit_linear(table, sw.Subwords([], []), ["f"], max_iter=5)
    search.random_search(table, ["f"], {"C": {"type": "choice", "values": [1.0]}}, trials=1, max_iter=5)
    assert len(seen) == 2
    for vectors in seen:
        assert vectors.schema["features"].metadata == {} and vectors.inputFiles()
        assert sum(row["weight"] for row in vectors.collect()) == pytest.approx(vectors.count())


def tokenised(spark, lines):
    return spark.createDataFrame([(i, line.split()) for i, line in enumerate(lines)], "id long, tokens array<string>")


def test_tfidf_weights(spark):
    lines = ["a b b", "a c", "a"]
    df = tokenised(spark, lines)
    stages = vc.tfidf_stages(df, 3, (1, 1), None)
    rows = PipelineModel(stages).transform(df).select("id", vector_to_array("tfidf").alias("w")).orderBy("id").collect()
    idf = {t: math.log(4 / (1 + n)) + 1 for t, n in {"a": 3, "b": 1, "c": 1}.items()}
    norm = math.hypot(idf["a"], 2 * idf["b"])
    assert rows[0]["w"] == pytest.approx([idf["a"] / norm, 2 * idf["b"] / norm, 0.0])


def test_vocabulary_width_and_ngrams(spark):
    df = tokenised(spark, ["a b a b", "b c"])
    grams = PipelineModel(vc.term_stages((1, 2))).transform(df)
    kept = [(r["term"], r["tf"], r["df"]) for r in vc.vocabulary(grams, 3)]
    assert kept == [("b", 3, 2), ("a", 2, 1), ("a b", 2, 1)]
    assert len(vc.vocabulary(grams, None)) == 6


def test_too_many_terms_are_refused(spark, monkeypatch):
    monkeypatch.setattr(vc, "MAX_WIDTH", 5)
    grams = PipelineModel(vc.term_stages((1, 2))).transform(tokenised(spark, ["a b a b", "b c"]))
    with pytest.raises(ValueError):
        vc.vocabulary(grams, None)


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (4.0, 5)], "x double, c int")
    got = np.array([tuple(r) for r in vc.with_scaled(df, ["x", "c"]).collect()])
    x = np.array([1.0, 2.0, 4.0])
    assert np.allclose(got[:, 0], (x - x.mean()) / x.std()) and np.allclose(got[:, 1], 0)


def test_bayes_by_hand(spark):
    rows = [(1, "apple banana apple", 0), (2, "banana cherry", 1), (3, "cherry cherry date", 1)]
    train = spark.createDataFrame(rows, "id long, text string, Label int")
    model = bayes.fit(train, ["id"])
    terms = ["apple", "banana", "cherry", "date"]
    counts = np.array([[t.split().count(w) for w in terms] for _, t, _ in rows], float)
    idf = np.log(4 / (1 + (counts > 0).sum(0))) + 1
    weights = counts * idf
    weights /= np.linalg.norm(weights, axis=1, keepdims=True)
    labels = np.array([0, 1, 1])
    sums = np.array([weights[labels == c].sum(0) + 1 for c in (0, 1)])
    logs = np.log(sums / sums.sum(1, keepdims=True))
    query = np.array([0, 1.0, 1.0, 0]) * idf
    query /= np.linalg.norm(query)
    joint = np.log([1 / 3, 2 / 3]) + logs @ query
    expected = 1 / (1 + math.exp(joint[0] - joint[1]))
    new = spark.createDataFrame([(9, "Banana unknown cherry"), (10, "nothing known")], "id long, text string")
    got = {r["id"]: r["score"] for r in bayes.score(model, new, ["id"]).collect()}
    assert got[9] == pytest.approx(expected) and got[10] == pytest.approx(2 / 3)


def test_random_draws_stay_in_range():
    import random

    space = {
        "a": {"type": "int", "min_value": 10, "max_value": 70, "step": 20},
        "b": {"type": "float", "min_value": 0.25, "max_value": 1.0, "step": 0.25},
        "c": {"type": "float", "min_value": 2e-3, "max_value": 5.0, "sampling": "log"},
        "d": {"type": "choice", "values": ["x", "y"]},
    }
    draws = [search.draw(space, random.Random(i)) for i in range(200)]
    assert {d["a"] for d in draws} == {10, 30, 50, 70}
    assert {round(d["b"], 6) for d in draws} == {0.25, 0.5, 0.75, 1.0}
    assert all(2e-3 <= d["c"] <= 5.0 for d in draws) and {d["d"] for d in draws} == {"x", "y"}
    assert draws == [search.draw(space, random.Random(i)) for i in range(200)]


def test_neural_model_learns(spark, raw):
    from quillsift.plans.experiment import prepare_experiment

    train, test, features = prepare_experiment(raw)
    subwords = sw.learn(train, "text", 270)
    table = ln.training_table(train, subwords, features)
    scores = fit_neural(table, subwords, features, 8, 8, 30).score(test, ["Label"]).collect()
    assert all(0 <= r["spam_probability"] <= 1 for r in scores)
    assert sum((r["spam_probability"] > 0.5) == (r["Label"] == 1) for r in scores) >= 0.7 * len(scores)


def test_stream_scores_equal_batch_scores(spark, trained, tmp_path):
    _, model, _ = trained
    rows = [(str(i), "free" if i % 2 else None, f"money notes {i}") for i in range(20)]
    schema = "msg_id string, subject string, body string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streamed = st.drain(st.score_stream(arriving, model, ["msg_id"]), "scores")
    batch = model.score(score_inputs(spark.read.parquet(str(tmp_path / "in")), model.features), ["msg_id"])
    left, right = ({r["msg_id"]: r["spam_probability"] for r in df.collect()} for df in (streamed, batch))
    assert left.keys() == right.keys() and all(left[k] == pytest.approx(right[k]) for k in left)


def test_stream_keeps_first_arrivals(spark, tmp_path):
    rows = [(str(i), "same" if i % 3 == 0 else f"text {i}") for i in range(60)]
    spark.createDataFrame(rows, "msg_id string, text string").repartition(4).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema("msg_id string, text string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    firsts = st.drain(st.first_arrivals(arriving, "text", "msg_id"), "firsts")
    texts = [r["text"] for r in firsts.collect()]
    assert sorted(texts) == sorted({t for _, t in rows})


def test_regression_reaches_the_optimum(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) * [1.0, 0.05, 3.0, 0.4]
    y = (x @ [1.0, 8.0, -0.4, 0.0] + rng.normal(size=300) > 0.8).astype(float)
    w = np.where(y == 1, 2.0, 0.7)
    rows = [(float(a), float(b), Vectors.dense(c)) for a, b, c in zip(y, w, x)]
    model = ln.regression(3.0, len(rows)).fit(spark.createDataFrame(rows, ["Label", "weight", "features"]))
    beta = model.coefficients.toArray()
    error = w * (1 / (1 + np.exp(-(x @ beta + model.intercept))) - y) / w.sum()
    assert np.abs(x.T @ error + beta / (3.0 * len(rows))).max() < 1e-4 and abs(error.sum()) < 1e-4
