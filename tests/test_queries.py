"""Registered queries against their SQL, on whole tables at sf0.01; compare.py runs all of them."""

import pytest

import __spark_entry__ as contract
from compare import check, database

FAST = [
    "prep_messages", "normalise_separators", "dedup_first", "dedup_within_source", "low_quality_filter",
    "message_features", "page_features", "source_summary", "cleaning_summary", "column_profile", "label_mix",
    "label_mix_pivot", "subject_prefix_rate", "outlier_report", "label_separation", "feature_box_stats",
    "length_percentiles", "stratified_split", "validation_split", "cv_folds", "fixed_sample", "class_weights",
    "scaled_features", "word_tfidf", "naive_bayes_scores", "evaluate_scores", "class_report", "run_ranking",
    "request_summary", "request_pivot", "request_peak", "sweep_grid", "request_windows",
    "stream_request_windows", "stream_dedup", "csv_roundtrip", "evaluate_overall", "outside_scores",
    "request_percentile_windows", "stream_percentile_windows",
]


@pytest.fixture(scope="module")
def connection(folder):
    return database(folder)


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, connection, folder, name):
    assert check(spark, connection, folder, name, contract.queries()[name], contract.oracle_sql()[name]) is None


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
