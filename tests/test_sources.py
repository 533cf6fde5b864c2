import pytest

from quillsift.sources import csv_source, loadtest


def test_files_of_a_folder(spark, tmp_path):
    (tmp_path / "one.csv").write_text('n,Body,Label\n0,"Subject: a\nsaid ""x""",1\n1,,0\n2,NA,0\n')
    (tmp_path / "two.csv").write_text("Label,Body\n1,plain\n")
    rows = csv_source.read_sources(spark, folder=str(tmp_path)).orderBy("Source", "row_id").collect()
    assert [(r["Source"], r["Body"], r["Label"]) for r in rows] == [
        ("one", 'Subject: a\nsaid "x"', 1), ("one", None, 0), ("one", "NA", 0), ("two", "plain", 1),
    ]
    nulls = csv_source.read_sources(spark, file=str(tmp_path / "one.csv"), pandas_nulls=True)
    assert nulls.where("Body is null").count() == 2
    named = csv_source.read_named(spark, {"A": str(tmp_path / "one.csv"), "B": str(tmp_path / "two.csv")})
    assert {r["Source"] for r in named.collect()} == {"A", "B"}


def test_exactly_one_input(spark, tmp_path):
    for arguments in ({}, {"file": "x", "folder": "y"}):
        with pytest.raises(ValueError):
            csv_source.read_sources(spark, **arguments)
    with pytest.raises(ValueError):
        csv_source.read_sources(spark, folder=str(tmp_path))


def test_load_test_files(spark, tmp_path):
    head = "Type,Name,Request Count,Failure Count,Median Response Time,Requests/s,95%,99%\n"
    (tmp_path / "s.csv").write_text(head + "POST,/score,5,1,70,2.5,80,90\n,Aggregated,6,1,71,3.5,81,91\n")
    row = loadtest.read_stats(spark, str(tmp_path / "s.csv")).first()
    assert (row["requests"], row["failures"], row["rps"], row["p99_ms"]) == (6, 1, 3.5, 91.0)
    (tmp_path / "none.csv").write_text(head + "POST,/score,5,1,70,2.5,80,90\n")
    with pytest.raises(ValueError):
        loadtest.read_stats(spark, str(tmp_path / "none.csv"))


def test_latest_summary(spark, tmp_path):
    columns = "users int, batch_size int, requests int, failures int, rps double, median_ms double, p95_ms double, p99_ms double"
    for stamp, rps in (("20260101-000000", 1.0), ("20260202-000000", 2.0)):
        one = spark.createDataFrame([(1, 1, 1, 0, rps, 1.0, 1.0, 1.0)], columns)
        loadtest.write_summary(one, str(tmp_path / f"tag-{stamp}" / "summary.csv"))
    assert loadtest.latest_summary(spark, str(tmp_path), "tag").first()["rps"] == 2.0


def test_latest_summary_reads_all_part_files_of_the_newest_run(spark, tmp_path):
    columns = "cast(id as int) users, 1 batch_size, 2 requests, 0 failures, 1.5D rps, 3D median_ms, 4D p95_ms, 5D p99_ms"
    for stamp, rows in (("20260101-000000", 50), ("20260102-000000", 30)):
        summary = spark.range(rows).selectExpr(*columns.split(", ")).repartition(3)
        loadtest.write_summary(summary, str(tmp_path / f"sweep-{stamp}" / "summary.csv"))
    assert len(list((tmp_path / "sweep-20260102-000000" / "summary.csv").glob("part-*"))) == 3
    assert sorted(r["users"] for r in loadtest.latest_summary(spark, str(tmp_path), "sweep").collect()) == list(range(30))
