import pytest
from pyspark.sql import functions as F

from quillsift.functions import text as T
from quillsift.operators import features, prepare as pr
from quillsift.plans import queries

RAW = "Source string, row_id long, Body string, Label int"


def prepared(spark, bodies):
    rows = [("mail", i, body, 0) for i, body in enumerate(bodies)]
    return [(r["Subject"], r["Body"]) for r in pr.prepare(spark.createDataFrame(rows, RAW)).orderBy("row_id").collect()]


def test_null_dropped_and_subject_split(spark):
    got = prepared(
        spark,
        [
            "Subject: Your parcel is late!\nPay the fee today",
            "A plain note: the parcel came, thanks",
            None,
        ],
    )
    assert got == [
        ("Your parcel is late!", "Pay the fee today"),
        ("", "A plain note: the parcel came, thanks"),
    ]


@pytest.mark.parametrize(
    "body, expected",
    [
        ("SUBJECT:x", ("x", "")),
        ("subject:  a \r\nb\nc", ("a", "b\nc")),
        ("hello\nSubject: x", ("", "hello\nSubject: x")),
        ("Subject:\n", ("", "")),
        ("Subject:\u3000a\xa0\nb", ("a", "b")),
        ("", ("", "")),
    ],
)
def test_subject_cases(spark, body, expected):
    assert prepared(spark, [body]) == [expected]


def test_separators_become_one_space_each(spark):
    marks = "\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
    body = "Subject: a" + marks + "b\nc" + marks + "d\x1f\xa0e"
    assert prepared(spark, [body]) == [("a" + " " * 8 + "b", "c" + " " * 8 + "d\x1f\xa0e")]


def messages(spark, rows):
    schema = "Source string, row_id long, Subject string, Body string, Label int"
    return pr.with_text(spark.createDataFrame(rows, schema))


def test_first_of_each_text(spark):
    rows = [
        ("b", 1, "Hi", "there", 0),
        ("a", 9, "Hi", "there", 1),
        ("a", 10, "Heya", "not there", 0),
        ("a", 11, "Hi", "there", 0),
    ]
    kept = pr.first_of_each(messages(spark, rows))
    assert sorted((r["Source"], r["row_id"], r["Label"]) for r in kept.collect()) == [("a", 9, 1), ("a", 10, 0)]
    again = pr.first_of_each(kept)
    assert again.count() == 2
    within = pr.first_of_each(messages(spark, rows), by=["Source"])
    assert sorted((r["Source"], r["row_id"]) for r in within.collect()) == [("a", 9), ("a", 10), ("b", 1)]


def test_copies_of_one_text_fill_a_third(spark):
    rows = [("a", i, "s", "same" if i % 3 == 0 else f"text {i}", 0) for i in range(3000)]
    kept = pr.first_of_each(messages(spark, rows))
    assert kept.count() == 2001
    assert kept.where("Body = 'same'").select("row_id").collect()[0][0] == 0


def test_low_quality(spark):
    texts = ["", " \t\u3000\n", "a b c", "a b c d", "a\x85b\u3000c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in pr.drop_low_quality(df, max_tokens=3).collect()] == ["a b c", "a\x85b\u3000c"]


def test_blanks_match_python(spark):
    text = "".join(chr(c) + "x" for c in range(1, 0x3100) if chr(c).isspace() or c % 97 == 0)
    row = spark.createDataFrame([(text, " " + text + "\u2003")], "t string, u string").select(
        T.word_count(F.col("t")), T.strip(F.col("u"))
    ).first()
    assert row[0] == len(text.split())
    assert row[1] == text.strip()


def test_training_rows_are_searched_for_varying_features_once(spark, tmp_path, monkeypatch):
    texts = [(i, f"{'Win' * (i % 3)} text {i}{'!' * (i % 4)}", "en") for i in range(40)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    searched, plain = [], features.spread
    monkeypatch.setattr(features, "spread", lambda rows, names: searched.append(names) or plain(rows, names))
    found = [r["feature"] for r in queries.QUERIES["varying_features"](spark, str(tmp_path)).collect()]
    assert len(searched) == 1
    train, _, names = queries.experiment(spark, str(tmp_path))
    assert found == names == [c for c in features.FEATURES if train.select(c).distinct().count() > 1]
