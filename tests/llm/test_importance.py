import hashlib
import math
import random
import re
import zlib
from collections import Counter

from quillsift.llm import importance as I

SCHEMA = "doc_id long, text string, score string, weight int, row int"


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features(text, longest):
    found = words(text)
    return [" ".join(found[i : i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)]


def expected(rows, target, longest=1, buckets=50, least=3, percent=10):
    def h(feature):
        return zlib.crc32(feature.encode()) % buckets

    s = Counter(h(f) for row in rows for f in features(row[1], longest))
    t = Counter(h(f) for text in target for f in features(text, longest))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text, *_ in rows:
        found = features(text, longest)
        weight = sum(gain[h(f)] for f in found) // len(found) if found else 0
        u = (int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
        out.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log(u))), len(words(text))))
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = Counter(r[:4] for r in fit[: percent * len(fit) // 100])
    return Counter(r[:4] for r in out), drawn, [r[:4] for r in fit[: percent * len(fit) // 100]]


def sample(n=600, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "One", " ".join(rng.choice(["Ärger", "the", "x1", "Über-all", "日本", "end."]) for _ in range(rng.randint(1, 40)))])
        rows.append((None if i % 60 == 7 else i, text, "s", 1, 2))
    rows += [rows[5]] * 40 + [(10_000, "long " * 50_000, "s", 1, 2)]
    return rows


TARGET = ["the x1 the", "Über all", None, ""]


def check(spark, rows, **kwargs):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = I.resample(docs, target, buckets=50, least_words=3, **kwargs).collect()
    every, drawn, order = expected(rows, TARGET, longest=kwargs.get("longest", 1), percent=kwargs.get("percent", 10))

    def flat(r):
        return (r["doc"]["doc_id"], r["n_features"], r["weight"], r["score"])

    assert Counter(map(flat, got)) == every
    winners = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in winners] == list(range(1, len(order) + 1))
    assert [flat(r) for r in winners] == order and Counter(map(flat, winners)) == drawn
    assert got[0]["doc"].asDict().keys() == {"doc_id", "text", "score", "weight", "row"}


def test_scores_and_draw_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(I, "LAST_ROWS", 5)
    check(spark, sample())


def test_longer_runs_and_other_shares(spark):
    check(spark, sample(200, 6), longest=3, percent=37)


def test_every_cutoff_of_a_table_with_ties(spark, monkeypatch):
    monkeypatch.setattr(I, "LAST_ROWS", 3)
    rng = random.Random(2)
    rows = [(rng.randint(0, 3), rng.randint(0, 1), rng.randint(0, 2), 0, i) for i in range(90)]
    table = I.written(spark.createDataFrame(rows, ", ".join(f"{c} long" for c in I.PLACE)).repartition(5), "keys")
    for wanted in (1, 2, 44, 45, 89, 90):
        assert I.cutoff(table, wanted) == sorted(rows)[wanted - 1]
    assert I.cutoff(table, 0) is None


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    target = spark.createDataFrame([], "text string")
    assert I.resample(none, target).count() == 0
    some = I.resample(spark.createDataFrame(sample(20), SCHEMA), target, least_words=1_000_000).collect()
    assert len(some) == 61 and all(r["rank"] is None for r in some)
