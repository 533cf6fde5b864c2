import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillsift.operators import evaluate as ev, request_log as rl
from quillsift.operators.score import scored_by


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(3)
    start = dt.datetime(2026, 1, 1)
    rows = [(start + dt.timedelta(seconds=rng.randrange(200_000)), float(rng.randrange(400)), int(rng.random() < 0.1)) for _ in range(3_000)]
    rows += [(None, 5.0, 1), (start + dt.timedelta(days=9), None, 1)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, response_ms double, failed int"), rows


def test_percentile_windows(log):
    table, rows = log
    got = {r["start"].date(): r for r in rl.request_percentile_windows(table).collect()}
    days = {}
    for ts, ms, failed in rows:
        if ts is not None:
            days.setdefault(ts.date(), []).append((ms, failed))
    assert set(got) == set(days)
    for day, own in days.items():
        row, times = got[day], [ms for ms, _ in own if ms is not None]
        assert (row["requests"], row["failures"]) == (len(own), sum(failed for _, failed in own))
        assert row["rps"] == pytest.approx(len(own) / 86_400)
        for name, share in rl.POINTS.items():
            assert row[name] == (pytest.approx(np.quantile(times, share)) if times else None)


def test_sketched_percentiles_stay_within_their_error(log):
    table, _ = log
    sketched = rl.sketched_percentile_windows(table)
    assert all(r[name] for r in rl.percentiles_within(sketched, table).collect() for name in rl.POINTS)
    wrong = sketched.withColumn("p95_ms", F.lit(10.0))
    assert not any(r["p95_ms"] for r in rl.percentiles_within(wrong, table).collect())


def scored(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", "all"]), rng.randrange(2), rng.randrange(20) / 20) for _ in range(400)] + [(None, 1, 0.9)]
    return spark.createDataFrame(rows, "Source string, Label int, score double")


def test_overall_equals_single_evaluations(spark):
    rows = scored(spark)
    got = {(r["Source"], r["overall"]): r for r in ev.evaluate_overall(rows, "Source").collect()}
    assert set(got) == {("a", False), ("b", False), ("all", False), ("all", True)}
    whole = ev.evaluate(rows.withColumn("one", F.lit(1)), ["one"]).first()
    for name in [*ev.METRICS, "tn", "fp", "fn", "tp"]:
        assert got["all", True][name] == pytest.approx(whole[name])
    for row in ev.evaluate(rows, ["Source"]).collect():
        assert [got[row["Source"], False][name] for name in ev.METRICS] == [pytest.approx(row[name]) for name in ev.METRICS]


def test_outside_model(spark):
    def load():
        return lambda x, y: np.nan_to_num(x) * 2 + y

    rows = spark.createDataFrame([(1, 0.5, 1.0), (2, None, 3.0), (3, 2.0, 0.0)], "id int, x double, y double")
    got = {r["id"]: r["score"] for r in scored_by(rows, load, ["x", "y"], ["id"], batch_size=2).collect()}
    assert got == {1: 2.0, 2: 3.0, 3: 4.0}
    assert scored_by(rows.limit(0), load, ["x", "y"], ["id"]).count() == 0
