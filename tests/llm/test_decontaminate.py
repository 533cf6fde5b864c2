import hashlib
import random

from pyspark.sql import functions as F
from test_words_and_groups import plain

from quillsift.llm import decontaminate as D

DOCS = "doc_id long, text string, hits string, phrase int"
ITEMS = "item_id long, text string, code int"


def brute(docs, items):
    grams = {}
    for item, text in items:
        words = plain(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            grams.setdefault(tuple(words[i : i + n]), set()).add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        words, hit, found = plain(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(words) - n + 1):
                names = grams.get(tuple(words[i : i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def sample():
    rng = random.Random(4)
    words = ["Ab", "cd", "éf", "g1", "hij", "k"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(8, 16)))) for i in range(12)]
    items += [(20, "Short One"), (21, "short, one"), (None, "nameless item"), (22, None), (23, ""), (24, "...")]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(60)]
    docs += [(100 + k, f"Xx yy. {text or ''}; zz {text or ''}!") for k, (_, text) in enumerate(items)]
    docs += [(None, None), (None, ""), (7, "a short ONE b"), (7, "a short ONE b"), (8, "w " * 200_000 + (items[0][1] or ""))]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS),
        spark.createDataFrame([(i, t, 2) for i, t in items], ITEMS),
    )


def test_digest_matches_brute_force_in_one_block_and_in_many(spark):
    docs, items = sample()
    left, right = frames(spark, docs, items)
    want = brute(docs, items)
    for block_bytes in (1 << 26, 2000):
        got = D.digest(D.scan(left, right, block_bytes=block_bytes)).collect()
        assert sorted((tuple(r) for r in got), key=str) == want


def test_documents_or_spans_are_removed_and_clean_rows_stay(spark):
    docs, items = sample()
    left, right = frames(spark, docs, items)
    flagged = [r[5] for r in brute(docs, items)]
    kept = D.clean(left, right)
    assert kept.columns == left.columns and kept.count() == flagged.count(False)
    cut = D.clean(left, right, remove="spans")
    assert cut.count() == len(docs) and cut.columns == left.columns
    assert D.scan(cut.where(F.length("text") < 30), right).where(F.size("hits.spans") > 0).count() <= flagged.count(True) // 2
    row = D.clean(*frames(spark, [(1, "Before: Short, ONE; after é")], items), remove="spans").first()
    assert row["text"] == "Before: ; after é" and row["hits"] == "x"


def test_empty_tables(spark):
    docs, items = sample()
    none = frames(spark, [], [])
    left, right = frames(spark, docs, items)
    assert D.clean(none[0], right).count() == 0
    assert D.clean(left, none[1]).count() == len(docs)
