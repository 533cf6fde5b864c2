import numpy as np
import pytest

from quillsift.llm import nearest as N


def brute(ids, vectors, every=20, k=20):
    out = {}
    for q in range(len(ids)):
        if ids[q] % every == 0:
            scores = (vectors * vectors[q]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[q]][:k]
            out[int(ids[q])] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def answers(frame, **options):
    out = {}
    for r in sorted(N.search(frame, **options).collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want])


def test_recall_on_the_given_vectors(spark, monkeypatch):
    monkeypatch.setattr(N, "CELL", 512)
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.collect()
    want = brute(np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float))
    got = answers(frame)
    assert set(got) == set(want) and recall(got, want) >= 0.95
    for q in want:
        exact = dict(want[q])
        assert all(s == pytest.approx(exact[i], abs=1e-12) for i, s in got[q] if i in exact)


def test_norms_differ_and_copies_tie(spark, monkeypatch):
    monkeypatch.setattr(N, "CELL", 100)
    monkeypatch.setattr(N, "BLOCK", 64)
    monkeypatch.setattr(N, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(900, 12)) * rng.uniform(0.2, 3, size=(900, 1))
    vectors[300:600] = vectors[7]
    frame = spark.createDataFrame([(i, v.tolist(), 1.0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, score double")
    want, got = brute(np.arange(900), vectors), answers(frame)
    assert recall(got, want) >= 0.95
    assert got[300] == want[300]


def test_unusable_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (20, [0.5, 2.0]), (20, [0.5, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(frame)
    assert got[0] == [(1, 0.5), (20, 0.5), (20, 0.5)] and {i for i, _ in got[20]} == {0, 1}
    assert N.search(frame.where("false")).count() == 0


def test_chi_square_quantiles():
    assert N.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert N.chi_square_quantile(0.5, 2) == pytest.approx(1.3863, abs=1e-3)
