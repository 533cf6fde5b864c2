import pytest
from pyspark.sql import functions as F

from quillsift.functions.charsets import PUNCTUATION, STOP_WORDS
from quillsift.operators import features as ft

SCHEMA = "Subject string, Body string"


def one(spark, subject, body=""):
    return ft.with_features(spark.createDataFrame([(subject, body)], SCHEMA)).first()


def test_names_are_complete(spark):
    assert len(ft.FEATURES) == 77
    assert set(one(spark, "a").asDict()) == {*ft.FEATURES, "Subject", "Body"}


def test_hand_made_message(spark):
    row = one(spark, "AB!!", "hi http://www.x.com www.x.com")
    assert (row["subject_length"], row["subject_word_count"]) == (4, 1)
    assert (row["subject_upper_ratio"], row["subject_digit_ratio"]) == (1.0, 0.0)
    assert (row["subject_exclaim_count"], row["subject_question_count"]) == (2, 0)
    assert row["has_subject"] and row["body_has_http_url"] and row["body_has_web_url"]


@pytest.mark.parametrize(
    "text, flag",
    [("éwww.x.com", False), ("WWW.X.COM", True), ("www.x.c", False), ("_www.ab.cd", False), ("x www.ab.cd", True)],
)
def test_web_url(spark, text, flag):
    assert one(spark, "", text)["body_has_web_url"] is flag


@pytest.mark.parametrize("text, flag", [("HTTPS://a", True), ("http:/a", False), ("http :// a", False), ("a://b", False)])
def test_http_url(spark, text, flag):
    assert one(spark, "", text)["body_has_http_url"] is flag


def test_edges(spark):
    empty = one(spark, "")
    assert all(not empty[c] for c in ft.FEATURES)
    digits = one(spark, "", "a٣b 1")
    assert digits["body_digit_ratio"] == 2 / 5
    assert one(spark, "", "123")["body_upper_ratio"] == 0.0
    assert one(spark, "", "😀é")["body_length"] == 2


def test_against_python(spark):
    text = "The QUICK (brown) fox -- jumped; over 13 l4zy d0gs! 😀 Ünïcode Å #1 \\ `x` {y} |z| ~ ^ [a] <b> $5 50% a_b @c"
    row = one(spark, "", text)
    for char, name in PUNCTUATION.items():
        assert row[f"body_{name}_count"] == text.count(char), char
    letters = [c for c in text if c.isascii() and c.isalpha()]
    assert row["body_upper_ratio"] == sum(c.isupper() for c in letters) / len(letters)
    assert row["body_digit_ratio"] == sum(c.isdecimal() for c in text) / len(text)
    assert row["body_word_count"] == len(text.split())


def test_varying_and_constant(spark):
    df = spark.createDataFrame([(1, 8, None, True), (2, 8, None, False), (3, 8, None, True)], "v int, c int, n int, b boolean")
    assert ft.varying_features(df, ["v", "c", "n", "b"]) == ["v", "b"]
    assert ft.constant_features(df, ["v", "c", "n", "b"]) == ["c"]


def test_summary_of_all_features(spark):
    names = spark.createDataFrame([(c,) for c in ft.FEATURES], "feature string")
    counts = {r["category"]: r["count"] for r in ft.feature_summary(names).collect()}
    assert counts == {"shape/ratio features": 8, "embedded/link flags": 4, "punctuation counts": 64, "other": 1}


def test_kind(spark):
    df = spark.createDataFrame([("body_has_web_url",), ("body_upper_ratio",), ("body_length",), ("has_subject",)], "f string")
    assert [r[0] for r in df.select(ft.feature_kind(F.col("f"))).collect()] == ["flag", "ratio", "count", "count"]


def test_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert set(STOP_WORDS) == set(StopWordsRemover.loadDefaultStopWords("english"))
