"""Registered queries: every operator over whole tables, by name."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.functions import text as T
from quillsift.operators import bayes, evaluate as ev, features as ft, linear as ln, prepare as pr, profile as pf
from quillsift.operators import request_log as rl, split as sp, subword as sw, vectors as vc
from quillsift.operators.network import fit_network
from quillsift.operators.neural import fit_neural
from quillsift.operators.prepare import KEY
from quillsift.operators.score import score_inputs, scored_by
from quillsift.operators.search import random_search as search
from quillsift.plans import settings as P
from quillsift.plans.experiment import classic_train, prepare_experiment
from quillsift.session import new_path, written
from quillsift.sources import csv_source, loadtest, registry, tables
from quillsift.streaming import streams as st

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def featured_messages(spark: SparkSession, folder: str, labelled: bool = True) -> DataFrame:
    return ft.build_dataset(tables.raw_messages(spark, folder, labelled))


# Sources and cleaning


@query
def raw_messages(spark, folder):
    return tables.raw_messages(spark, folder)


@query
def csv_roundtrip(spark, folder):
    path = new_path(spark, "csv")
    csv_source.write_by_source(tables.raw_messages(spark, folder), path)
    return csv_source.read_by_source(spark, path)


@query
def csv_named(spark, folder):
    """One folder of CSV files per source, read by name."""
    path = new_path(spark, "csv")
    raw = tables.raw_messages(spark, folder)
    csv_source.write_by_source(raw, path)
    names = [r["Source"] for r in raw.select("Source").distinct().collect()]
    return csv_source.read_named(spark, {n: f"{path}/Source={n}" for n in names}).drop("row_id")


@query
def prep_messages(spark, folder):
    return pr.prepare(tables.raw_messages_nulls(spark, folder, labelled=False))


@query
def normalise_separators(spark, folder):
    marks = [part for char in P.INJECTED for part in (F.lit(char), F.lit("x"))]
    text = F.concat(F.col("text"), *marks)
    return tables.table(spark, folder, "documents").select("doc_id", T.plain_separators(text).alias("text"))


@query
def build_dataset(spark, folder):
    return featured_messages(spark, folder, labelled=False)


@query
def dedup_first(spark, folder):
    texts = pr.with_text(pr.prepare(tables.raw_messages(spark, folder, labelled=False)))
    return pr.first_of_each(texts).select(*KEY, "Label", "text")


@query
def dedup_within_source(spark, folder):
    texts = pr.with_text(pr.prepare(tables.raw_messages(spark, folder, labelled=False)))
    return pr.first_of_each(texts, by=["Source"]).select(*KEY, "Label", "text")


@query
def low_quality_filter(spark, folder):
    documents = tables.table(spark, folder, "documents").select("doc_id", "text")
    return pr.drop_low_quality(documents, max_tokens=P.MAX_TOKENS)


@query
def varying_features(spark, folder):
    """The names found while the experiment is prepared; its training rows are not read for them again."""
    _, _, names = experiment(spark, folder)
    return spark.createDataFrame([(name,) for name in names], "feature string")


@query
def constant_features(spark, folder):
    return ft.spread(featured_messages(spark, folder, labelled=False), ft.FEATURES).where("one_value").select("feature")


@query
def prepare_experiment_rows(spark, folder):
    train, test, _ = experiment(spark, folder)
    columns = [*KEY, "Label", "text"]
    return train.select(*columns, F.lit("train").alias("split")).unionByName(
        test.select(*columns, F.lit("test").alias("split"))
    )


QUERIES["prepare_experiment"] = QUERIES.pop("prepare_experiment_rows")


@query
def score_projection(spark, folder):
    messages = tables.unlabelled_messages(spark, folder)
    return score_inputs(messages, P.SCORE_FEATURES).select("msg_id", "text", *P.SCORE_FEATURES)


# Features and profiles


@query
def message_features(spark, folder):
    return featured_messages(spark, folder, labelled=False).select(*KEY, *ft.FEATURES)


@query
def page_features(spark, folder):
    pages = tables.table(spark, folder, "pages")
    return ft.with_features(pages, "url", "html").drop("url", "html")


@query
def feature_summary(spark, folder):
    """Of the features that the featured rows hold: one wide aggregate, whose single row is then turned."""
    featured = featured_messages(spark, folder)
    names = [c for c in featured.columns if c not in (*KEY, "Subject", "Body", "Label")]
    held = featured.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "n").where("n > 0")
    return ft.feature_summary(held.select("feature")).withColumn("list", F.array_join("list", ","))


@query
def feature_kinds(spark, folder):
    """One wide aggregate with both means of each feature; its single row is then turned."""
    featured = featured_messages(spark, folder, labelled=False)
    plain = {c: F.col(c).cast("double") for c in ft.FEATURES}
    row = featured.agg(*[F.struct(F.avg(v).alias("plain"), F.avg(F.log1p(v)).alias("logged")).alias(c) for c, v in plain.items()])
    long = row.unpivot([], ft.FEATURES, "feature", "means")
    kind = ft.feature_kind(F.col("feature"))
    shown = F.when(kind == "count", F.col("means.logged")).otherwise(F.col("means.plain"))
    return long.select("feature", kind.alias("kind"), F.round(shown, 6).alias("mean_shown"))


@query
def source_summary(spark, folder):
    raw = tables.raw_messages_nulls(spark, folder)
    return rounded(pf.source_summary(raw, ["Source", "Body", "Label"]), "spam_rate")


@query
def cleaning_summary(spark, folder):
    return rounded(pf.cleaning_summary(tables.raw_messages_nulls(spark, folder)), "empty_subject_rate")


@query
def column_profile(spark, folder):
    raw = tables.raw_messages_nulls(spark, folder)
    return pf.column_profile(raw, raw.columns)


@query
def source_columns(spark, folder):
    raw = tables.raw_messages_nulls(spark, folder)
    return pf.column_profile(raw, ["row_id", "Body", "Label"], by=["Source"])


@query
def label_mix(spark, folder):
    return rounded(pf.label_mix(tables.raw_messages(spark, folder), ["Source"]), "share")


@query
def label_mix_pivot(spark, folder):
    return rounded(pf.label_mix_pivot(tables.raw_messages(spark, folder)), "share_0", "share_1")


@query
def subject_prefix_rate(spark, folder):
    return rounded(pf.subject_prefix_rate(tables.raw_messages_nulls(spark, folder, labelled=False)), "any_case", "exact_case")


@query
def outlier_report(spark, folder):
    report = pf.outlier_report(featured_messages(spark, folder), ft.FEATURES)
    mixed = report.select(
        "feature", "lower_bound", "upper_bound", "outlier_count", "outlier_rate",
        F.col("label_mix")[0].alias("ham_share"), F.col("label_mix")[1].alias("spam_share"),
    )
    return rounded(mixed, "lower_bound", "upper_bound", "outlier_rate", "ham_share", "spam_share")


@query
def outlier_label_counts(spark, folder):
    return pf.outlier_label_counts(pf.outlier_report(featured_messages(spark, folder), ft.FEATURES))


@query
def label_separation(spark, folder):
    return rounded(pf.label_separation(featured_messages(spark, folder), ft.FEATURES), "separation")


@query
def top_features(spark, folder):
    separation = pf.label_separation(featured_messages(spark, folder), ft.FEATURES)
    exact = separation.withColumn("separation", F.round("separation", 9))
    return rounded(pf.top_features(exact), "separation")


@query
def flag_rate_by_label(spark, folder):
    return rounded(pf.flag_rate_by_label(featured_messages(spark, folder), ft.FLAGS), "rate")


@query
def feature_box_stats(spark, folder):
    boxes = pf.feature_box_stats(featured_messages(spark, folder), ft.FEATURES)
    return rounded(boxes, "q1", "median", "q3", "whisker_low", "whisker_high")


def document_lengths(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return tables.table(spark, folder, "documents").select(
        T.word_count(text).alias("words"), F.char_length(text).alias("chars")
    )


@query
def length_percentiles(spark, folder):
    points = pf.length_percentiles(document_lengths(spark, folder), ["words", "chars"])
    return rounded(points.withColumn("ratio", F.try_divide("chars", "words")), "words", "chars", "ratio")


@query
def length_coverage(spark, folder):
    lengths = document_lengths(spark, folder)
    return rounded(pf.length_coverage(lengths, "words", P.CANDIDATES), "covered", "truncated")


# Splits and weights


def split_keys(spark: SparkSession, folder: str) -> DataFrame:
    return tables.raw_messages(spark, folder).select(*KEY, "Label")


@query
def stratified_split(spark, folder):
    return sp.stratified(split_keys(spark, folder), sp.source_and_label())


@query
def label_split(spark, folder):
    return sp.stratified(split_keys(spark, folder), F.col("Label"))


@query
def validation_split(spark, folder):
    outer = sp.stratified(split_keys(spark, folder), sp.source_and_label())
    return sp.hold_out(outer.where("split = 'train'").drop("split"), 0.1, seed=7)


@query
def cv_folds(spark, folder):
    return sp.folds(split_keys(spark, folder), k=P.FOLDS)


@query
def fixed_sample(spark, folder):
    return sp.sample(split_keys(spark, folder), P.SAMPLE)


@query
def class_weights(spark, folder):
    return rounded(sp.with_class_weights(split_keys(spark, folder)), "weight")


# Vectors


@query
def pad_truncate(spark, folder):
    words = F.split(T.strip(F.col("text")), f"[{T.BLANK_CLASS}]+")
    lengths = F.transform(F.filter(words, lambda w: w != ""), F.char_length)
    return tables.table(spark, folder, "documents").select(
        "doc_id", F.array_join(sw.pad_truncate(lengths, P.PAD).cast("array<string>"), " ").alias("ids")
    )


@query
def word_tfidf(spark, folder):
    texts = pr.with_text(pr.prepare(tables.raw_messages(spark, folder, labelled=False))).select(*KEY, "text")
    terms = written(vc.word_terms(texts, KEY), "terms")
    idf = vc.term_idf(terms, texts.count())
    return rounded(vc.tfidf(terms, idf, KEY), "idf", "weight")


@query
def scaled_features(spark, folder):
    featured = featured_messages(spark, folder, labelled=False).select(*KEY, *P.SCALED)
    return rounded(vc.with_scaled(featured, P.SCALED), *P.SCALED)


# Naive Bayes across sources


def bayes_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Model of one source's training rows; scores of its test rows and of all other sources."""
    texts = pr.with_text(pr.prepare(tables.raw_messages(spark, folder)))
    unique = written(pr.first_of_each(texts, by=["Source"]).select(*KEY, "Label", "text"), "unique")
    at_home = F.col("Source") == P.HOME
    home = sp.stratified(unique.where(at_home), F.col("Label"))
    model = bayes.fit(home.where("split = 'train'"), KEY)
    dataset = F.when(at_home, F.concat("Source", F.lit(" (test)"))).otherwise(F.col("Source"))
    others = unique.where(~at_home).unionByName(home.where("split = 'test'").drop("split"))
    return bayes.score(model, others, KEY).select(dataset.alias("dataset"), "row_id", "Label", "score")


def bayes_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return ev.evaluate(bayes_scores(spark, folder), ["dataset"], threshold=P.THRESHOLD)


@query
def naive_bayes_scores(spark, folder):
    return rounded(bayes_scores(spark, folder), "score")


@query
def cross_source_metrics(spark, folder):
    return rounded(ev.metrics_long(bayes_metrics(spark, folder), "dataset"), "value")


@query
def metrics_pivot(spark, folder):
    long = ev.metrics_long(bayes_metrics(spark, folder), "dataset")
    return rounded(ev.metrics_pivot(long), *ev.METRICS)


# Evaluation of a rule score


def rule_scores(spark: SparkSession, folder: str, feature: str = "body_upper_ratio") -> DataFrame:
    featured = featured_messages(spark, folder)
    return featured.select(*KEY, "Label", F.col(feature).alias("score"))


def rule_metrics(spark: SparkSession, folder: str, feature: str = "body_upper_ratio") -> DataFrame:
    return ev.evaluate(rule_scores(spark, folder, feature), ["Source"], threshold=P.THRESHOLD)


@query
def evaluate_scores(spark, folder):
    return rounded(rule_metrics(spark, folder), *ev.METRICS)


@query
def evaluate_overall(spark, folder):
    return rounded(ev.evaluate_overall(rule_scores(spark, folder), "Source", threshold=P.THRESHOLD), *ev.METRICS)


@query
def outside_scores(spark, folder):
    """A numpy function as the model, measured like any other."""
    weights, bias = P.OUTSIDE, P.OUTSIDE_BIAS

    def load():
        import numpy as np

        def model(upper, exclaims, digits):
            return 1 / (1 + np.exp(-bias - sum(w * c for w, c in zip(weights.values(), (upper, exclaims, digits)))))

        return model

    featured = featured_messages(spark, folder).select(*KEY, "Label", *[F.col(c).cast("double").alias(c) for c in weights])
    scored = scored_by(featured, load, list(weights), [*KEY, "Label"])
    return rounded(ev.evaluate(scored, ["Source"]), *ev.METRICS)


@query
def class_report(spark, folder):
    report = ev.class_report(rule_metrics(spark, folder), ["Source"])
    return rounded(report, "precision", "recall", "f1")


@query
def error_rates(spark, folder):
    rates = ev.error_rates(rule_metrics(spark, folder)).select(
        "Source", "tn", "fp", "fn", "tp", "false_positive_rate", "false_negative_rate"
    )
    return rounded(rates, "false_positive_rate", "false_negative_rate")


@query
def run_delta(spark, folder):
    old, new = (
        rule_metrics(spark, folder, feature).withColumnRenamed("Source", "run")
        for feature in ("body_digit_ratio", "body_upper_ratio")
    )
    return rounded(ev.run_delta(old, new), "f1_old", "f1_new", "delta_f1")


# Request log


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return rl.request_summary(tables.request_log(spark, folder))


@query
def request_summary(spark, folder):
    return rounded(requests(spark, folder), "rps", "median_ms", "p95_ms", "p99_ms")


@query
def loadtest_summary(spark, folder):
    """The newest summary file of a sweep, as written."""
    path = new_path(spark, "sweeps")
    summary = rounded(requests(spark, folder), "rps", "median_ms", "p95_ms", "p99_ms")
    for stamp, rows in (("1", summary.where("users = 1")), ("2", summary)):
        loadtest.write_summary(rows, f"{path}/sweep-{stamp}/summary.csv")
    return loadtest.latest_summary(spark, path, "sweep")


@query
def request_pivot(spark, folder):
    return rounded(rl.request_pivot(requests(spark, folder), P.USERS), *[f"u{u}" for u in P.USERS])


@query
def request_peak(spark, folder):
    return rounded(rl.request_peak(requests(spark, folder)), "rps")


@query
def sweep_grid(spark, folder):
    return rl.sweep_grid(requests(spark, folder), P.SWEEP_USERS, P.BATCHES)


@query
def request_windows(spark, folder):
    return rounded(rl.request_windows(tables.request_log(spark, folder)), "mean_ms")


@query
def stream_request_windows(spark, folder):
    events = st.table_stream(spark, folder, "events")
    log = st.with_event_time(tables.as_requests(events))
    table = st.drain_complete(rl.request_windows(log), "windows")
    return rounded(table.withColumn("start", F.col("start").cast("timestamp_ntz")), "mean_ms")


@query
def request_percentile_windows(spark, folder):
    windows = rl.request_percentile_windows(tables.request_log(spark, folder))
    return rounded(windows, "rps", "failures_per_s", *rl.POINTS)


@query
def stream_percentile_windows(spark, folder):
    """Windows of the stream; a flag per percentile says whether its rank is within the sketch's error of the exact one."""
    log = st.with_event_time(tables.as_requests(st.table_stream(spark, folder, "events")))
    table = st.drain_complete(rl.sketched_percentile_windows(log), "percentiles")
    table = table.withColumn("start", F.col("start").cast("timestamp_ntz"))
    near = rl.percentiles_within(table, tables.request_log(spark, folder))
    return rounded(table.drop(*rl.POINTS).join(near, "start"), "rps", "failures_per_s")


# Sub-word vocabulary. What several queries need is made once per session and folder.


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return tables.table(spark, folder, "documents").select("doc_id", "text")


@lru_cache(maxsize=None)
def document_subwords(spark: SparkSession, folder: str) -> sw.Subwords:
    return sw.learn(documents(spark, folder))


@lru_cache(maxsize=None)
def experiment(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, list[str]]:
    return prepare_experiment(tables.raw_messages(spark, folder))


@lru_cache(maxsize=None)
def training(spark: SparkSession, folder: str) -> tuple[DataFrame, sw.Subwords, list[str]]:
    train, _, features = experiment(spark, folder)
    subwords = sw.learn(train, "text")
    return ln.training_table(train, subwords, features), subwords, features


@lru_cache(maxsize=None)
def classic(spark: SparkSession, folder: str) -> ln.TextModel:
    return ln.fit_linear(*training(spark, folder), max_iter=P.MAX_ITER)


@query
def pretoken_counts(spark, folder):
    return sw.pretoken_counts(documents(spark, folder))


@query
def bpe_train(spark, folder):
    model = document_subwords(spark, folder)
    tokens = model.vocab_table(spark).withColumnRenamed("id", "merged")
    return model.merge_table(spark).join(tokens, "merged")


@query
def bpe_ids(spark, folder):
    """Ids of each document, and the bytes of all its tokens: those of its text with a leading blank."""
    model = document_subwords(spark, folder)
    sizes = F.from_json(F.lit(json.dumps(model.token_sizes())), "array<int>")
    encoded = documents(spark, folder).select("doc_id", sw.encode(F.col("text"), model).alias("ids"))
    lengths = F.transform("ids", lambda i: F.element_at(sizes, i + 1))
    return encoded.withColumn("n_bytes", F.aggregate(lengths, F.lit(0).cast("long"), lambda n, x: n + x))


@query
def bpe_encode(spark, folder):
    """The column of ``bpe_ids`` that SQL can follow."""
    return bpe_ids(spark, folder).select("doc_id", "n_bytes")


@query
def bpe_decode(spark, folder):
    model = document_subwords(spark, folder)
    encoded = documents(spark, folder).select("doc_id", sw.encode(F.col("text"), model).alias("ids"))
    return encoded.select("doc_id", sw.decode(F.col("ids"), model).alias("text"))


@query
def bpe_roundtrip(spark, folder):
    path = new_path(spark, "subwords")
    document_subwords(spark, folder).save(spark, path)
    model = sw.Subwords.load(spark, path)
    encoded = documents(spark, folder).select("doc_id", sw.encode(F.col("text"), model).alias("ids"))
    return encoded.select("doc_id", sw.decode(F.col("ids"), model).alias("text"))


@query
def subword_lengths(spark, folder):
    ids = sw.encode(F.col("text"), document_subwords(spark, folder))
    lengths = documents(spark, folder).select(
        T.word_count(F.col("text")).alias("words"), F.size(ids).alias("subwords")
    )
    points = pf.length_percentiles(written(lengths, "lengths"), ["words", "subwords"], P.PERCENTS)
    return rounded(points.withColumn("ratio", F.try_divide("subwords", "words")), "ratio")


@query
def subword_tfidf(spark, folder):
    table, _, _ = training(spark, folder)
    stages = vc.tfidf_stages(table, table.count(), (1, 1), None)
    return PipelineModel(stages).transform(table).select(*KEY, vector_to_array("tfidf").alias("weights"))


# Trained models


def _same(scores: DataFrame, direct: DataFrame, keep: list[str], on: list[str]) -> DataFrame:
    """(keep, same): is the probability that of the directly scored row?"""
    known = direct.select(*on, F.col("spam_probability").alias("direct"))
    near = F.abs(F.col("spam_probability") - F.col("direct")) < 1e-9
    return scores.join(known, on, "left").select(*keep, F.coalesce(near, F.lit(False)).alias("same"))


@query
def logistic_scores(spark, folder):
    _, test, _ = experiment(spark, folder)
    return classic(spark, folder).score(test, [*KEY, "Label"])


@query
def grid_search(spark, folder):
    table, _, features = training(spark, folder)
    return ln.grid_search(table, features, max_iter=P.MAX_ITER)


@query
def random_search(spark, folder):
    table, _, features = training(spark, folder)
    return search(table, features, P.SPACE, max_iter=P.MAX_ITER)


@query
def neural_scores(spark, folder):
    table, subwords, features = training(spark, folder)
    _, test, _ = experiment(spark, folder)
    model = fit_neural(table, subwords, features)
    return model.score(test, [*KEY, "Label"])


@query
def network_scores(spark, folder):
    """The network with class weights, stopped by its hold-out."""
    table, subwords, features = training(spark, folder)
    _, test, _ = experiment(spark, folder)
    return fit_network(table, subwords, features).score(test, [*KEY, "Label"])


@query
def train_report(spark, folder):
    """Rows trained and judged; the record itself is in the run folder."""
    raw = tables.raw_messages(spark, folder)
    _, record = classic_train(raw, new_path(spark, "train"), "classic_baseline", max_iter=P.MAX_ITER)
    judged = F.aggregate(F.flatten("metrics.confusion_matrix"), F.lit(0).cast("long"), lambda n, x: n + x)
    return record.select("operation", "input_data.train_rows", "input_data.test_rows", judged.alias("judged"))


@query
def cached_train(spark, folder):
    """The second request for the same parameters finds the first one's model."""
    store = new_path(spark, "cache")
    table, subwords, features = training(spark, folder)
    key = {"C": 1.0, "vocab": len(subwords.tokens)}
    _, test, _ = experiment(spark, folder)

    def train() -> ln.TextModel:
        return ln.fit_linear(table, subwords, features, C=key["C"], max_iter=P.MAX_ITER)

    parts = []
    for attempt in (1, 2):
        model, reused = registry.cached_model(spark, store, "classic", "classic", key, train)
        scored = model.score(test, [*KEY])
        parts.append(scored.select(F.lit(attempt).alias("attempt"), F.lit(reused).alias("reused"), "*"))
    return _same(parts[0].unionByName(parts[1]), parts[0], ["attempt", "reused", *KEY], KEY)


@query
def registry_roundtrip(spark, folder):
    store = new_path(spark, "registry")
    registry.register(spark, store, "classic", "classic", classic(spark, folder))
    model = registry.load_model(spark, store, "classic")
    _, test, _ = experiment(spark, folder)
    return _same(model.score(test, [*KEY]), classic(spark, folder).score(test, [*KEY]), KEY, KEY)


# Runs


def rule_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One run record per source, from the rule score."""
    metrics = rule_metrics(spark, folder)
    settings = F.create_map(
        F.lit("feature"), F.lit("body_upper_ratio"), F.lit("threshold"), F.lit(str(P.THRESHOLD))
    )
    return metrics.select(
        F.col("Source").alias("run"),
        F.lit("classic rule").alias("operation"),
        settings.alias("hyperparameters"),
        ev.metrics_struct().alias("metrics"),
    )


@query
def run_records(spark, folder):
    path = new_path(spark, "runs")
    registry.save_runs(rule_runs(spark, folder), path)
    runs = spark.read.schema(registry.RUN_SCHEMA).json(path).select("run", "operation", "metrics.*")
    cells = F.array_join(F.flatten("confusion_matrix").cast("array<string>"), " ")
    spam = F.element_at("classification_report", 2)
    runs = runs.withColumns({"confusion": cells, "spam_f1": spam["f1"], "spam_support": spam["support"]})
    return rounded(runs.drop("confusion_matrix", "classification_report"), *ev.METRICS, "spam_f1")


@query
def run_ranking(spark, folder):
    path = new_path(spark, "runs")
    registry.save_runs(rule_runs(spark, folder), path)
    runs = registry.load_runs(spark, path).drop("duration_s")
    return rounded(ev.ranked_runs(runs), *ev.METRICS)


# Scoring


@query
def batch_score(spark, folder):
    model = classic(spark, folder)
    messages = tables.unlabelled_messages(spark, folder)
    return model.score(score_inputs(messages, model.features), ["msg_id"])


@query
def stream_score(spark, folder):
    messages = tables.as_messages(st.table_stream(spark, folder, "conversations"))
    streamed = st.drain(st.score_stream(messages, classic(spark, folder), ["msg_id"]), "scores")
    return _same(streamed, batch_score(spark, folder), ["msg_id"], ["msg_id"])


@query
def stream_dedup(spark, folder):
    messages = tables.as_messages(st.table_stream(spark, folder, "conversations"))
    texts = messages.withColumn("text", T.joined_text("subject", "body"))
    return st.drain(st.first_arrivals(texts, "text", "msg_id").select("digest"), "firsts")
