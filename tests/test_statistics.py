import numpy as np
import pytest
from pyspark.sql import functions as F

from quillsift.operators import evaluate as ev, order_stats as os_, profile as pf, split as sp
from quillsift.session import cut


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    data = {"even": rng.normal(size=501), "ties": rng.integers(0, 5, 400).astype(float), "one": np.array([3.0])}
    data["hot"] = np.concatenate([np.zeros(500), rng.random(1000)])
    rows = [(g, float(v)) for g, values in data.items() for v in values]
    counts = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count("*").alias("n"))
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    for slices in (1, 7, 64):
        got = {r["g"]: r["quantiles"] for r in os_.quantiles(counts, ["g"], "v", "n", probs, slices).collect()}
        for g, values in data.items():
            assert np.allclose(got[g], np.quantile(values, probs)), (g, slices)


def test_running_totals(spark):
    rows = [("a", float(v), v % 3) for v in range(1000)] + [("b", 1.0, 5)]
    counts = spark.createDataFrame(rows, "g string, v double, n long")
    got = {(r["g"], r["v"]): r["before_n"] for r in os_.running_totals(counts, ["g"], "v", ["n"], slices=16).collect()}
    total = 0
    for v in range(1000):
        assert got["a", float(v)] == total
        total += v % 3
    assert got["b", 1.0] == 0 and len(got) == 1001


def test_outliers_hand_made(spark):
    values = [1, 2, 2, 3, 2, 1, 100]
    df = spark.createDataFrame([(v, v > 50, int(v == 100)) for v in values], "normal_feature int, has_subject boolean, Label int")
    rows = pf.outlier_report(df, ["normal_feature", "has_subject"]).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["feature"], row["lower_bound"], row["upper_bound"], row["outlier_count"]) == ("normal_feature", 0.0, 4.0, 1)
    assert row["outlier_rate"] == pytest.approx(1 / 7) and row["label_mix"] == {1: 1.0}


def test_outliers_of_a_constant(spark):
    df = spark.createDataFrame([(8, 0)] * 5, "c int, Label int")
    row = pf.outlier_report(df, ["c"]).first()
    assert (row["lower_bound"], row["upper_bound"], row["outlier_count"], row["label_mix"]) == (8.0, 8.0, 0, {})


def test_column_profile_counts_a_null_once(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1), (None, 1)], "x string, y int")
    got = {r["column"]: (r["missing_values"], r["duplicate_values"]) for r in pf.column_profile(df, ["x", "y"]).collect()}
    assert got == {"x": (1, 1), "y": (2, 2)}


def test_duplicate_rows(spark):
    rows = [("s", "ab", 1), ("s", "ab", 1), ("s", None, 1), ("s", "", 1), ("t", "ab", 1)]
    df = spark.createDataFrame(rows, "Source string, Body string, Label int")
    got = {r["Source"]: r["duplicate_rows"] for r in pf.source_summary(df, df.columns).collect()}
    assert got == {"s": 1, "t": 0}


def scored(spark, pairs):
    rows = [("d", label, float(score)) for label, score in pairs]
    return spark.createDataFrame(rows, "dataset string, Label int, score double")


def test_metrics_hand_made(spark):
    row = ev.evaluate(scored(spark, [(0, 0.3), (1, 0.6)]), ["dataset"]).first()
    assert (row["precision"], row["recall"], row["f1"], row["roc_auc"]) == (1.0, 1.0, 1.0, 1.0)


def test_metrics_undefined_and_ties(spark):
    none = ev.evaluate(scored(spark, [(0, 0.1), (1, 0.2)]), ["dataset"]).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)
    assert ev.evaluate(scored(spark, [(1, 0.1), (1, 0.7)]), ["dataset"]).first()["roc_auc"] is None
    ties = ev.evaluate(scored(spark, [(0, 0.5), (1, 0.5), (0, 0.5), (1, 0.5)]), ["dataset"]).first()
    assert ties["roc_auc"] == 0.5 and (ties["tp"], ties["fp"]) == (2, 2)


def test_auc_matches_spark_ml(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(3)
    df = scored(spark, [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(500)])
    area = ev.roc_auc(ev.score_counts(df, ["dataset"], "Label", "score"), ["dataset"]).first()["roc_auc"]
    reference = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="Label", numBins=0).evaluate(df)
    assert area == pytest.approx(reference, abs=1e-9)


def strata(spark, sizes):
    rows = [(s, i, int(s == "x")) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "Source string, row_id long, Label int")


def test_split_quotas(spark):
    df = strata(spark, {"x": 10, "y": 7, "z": 3})
    marked = sp.stratified(df, F.col("Source")).collect()
    assert len(marked) == 20
    test = [r["Source"] for r in marked if r["split"] == "test"]
    assert {s: test.count(s) for s in "xyz"} == {"x": 2, "y": 1, "z": 1}
    again = sp.stratified(df.repartition(3), F.col("Source")).collect()
    assert sorted(map(tuple, marked)) == sorted(map(tuple, again))


def test_split_refuses_tiny_strata(spark):
    with pytest.raises(ValueError):
        sp.stratified(strata(spark, {"x": 10, "y": 1}), F.col("Source"))


def test_folds_are_balanced_and_complete(spark):
    marked = sp.folds(strata(spark, {"x": 23, "y": 52}), k=5).collect()
    assert len(marked) == 75
    for label, n in ((1, 23), (0, 52)):
        sizes = [sum(r["Label"] == label and r["fold"] == f for r in marked) for f in range(5)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_sample_is_repeatable(spark):
    df = strata(spark, {"x": 50})
    first = {r["row_id"] for r in sp.sample(df, 5).collect()}
    assert len(first) == 5 and first == {r["row_id"] for r in sp.sample(df.repartition(4), 5).collect()}
    assert sp.sample(df, 500).count() == 50


def test_class_weights(spark):
    got = {r["Label"]: r["weight"] for r in sp.with_class_weights(strata(spark, {"x": 1, "y": 3})).collect()}
    assert got == {1: 2.0, 0: pytest.approx(2 / 3)}


def test_coverage(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (10,)], "words int")
    got = {r["candidate"]: (r["covered"], r["truncated"]) for r in pf.length_coverage(df, "words", [0, 5, 10]).collect()}
    assert got == {0: (0.0, 100.0), 5: (50.0, 50.0), 10: (100.0, 0.0)}


def test_quantiles_of_a_million_distinct_values_in_one_group(spark):
    n = 2_000_001
    counts = cut(spark.range(n).select(F.lit("g").alias("g"), (F.col("id") * 0.5).alias("v"), F.lit(1).cast("long").alias("n")))
    assert os_.sliced(counts, ["g"], "v").agg(F.max("slice")).first()[0] + 1 == max(os_.LEAST_SLICES, n // os_.ROWS_PER_SLICE)
    row = os_.quantiles(counts, ["g"], "v", "n", [0.25, 0.5]).first()
    assert row["rows"] == n and row["quantiles"] == [250_000.0, 500_000.0]
