import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quillsift.llm.grouped import components, roots, runs
from quillsift.llm.words import chunks, shingles

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    return WORD.findall((text or "").translate(UPPER))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é1.-\n漢", max_size=40)), max_size=8))
def test_words_match_the_pattern(texts):
    cache = {}
    hashes = {}
    for begin, found in chunks(texts, cache):
        for i in range(len(found.first) - 1):
            lo, hi = found.first[i], found.first[i + 1]
            own = [found.data[found.starts[k] : found.ends[k]].decode() for k in range(lo, hi)]
            assert own == plain(texts[begin + i])
            for word, code in zip(own, found.hashes[lo:hi].tolist()):
                assert hashes.setdefault(word, code) == code
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab c", max_size=30), max_size=6))
def test_shingles_are_equal_exactly_for_equal_words(texts):
    cache, seen = {}, {}
    for begin, found in chunks(texts, cache):
        codes, first = shingles(found, 5, 23)
        for i in range(len(first) - 1):
            words = plain(texts[begin + i])
            want = [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else []
            own = codes[first[i] : first[i + 1]].tolist()
            assert len(own) == len(want)
            for shingle, code in zip(want, own):
                assert seen.setdefault(shingle, code) == code
    assert len(set(seen.values())) == len(seen)


def test_a_very_long_text_and_a_very_long_word():
    found = next(chunks(["ab " * 700_000 + "x" * 3_000_000], {}))[1]
    assert len(found.hashes) == 700_001 and len(set(found.hashes.tolist())) == 2


def test_runs_cross_batches():
    batches = [pa.RecordBatch.from_pydict({"k": k, "v": v}) for k, v in (([1, 1], [1, 2]), ([1], [3]), ([], []), ([2, 3], [4, 5]))]
    batches = [b.cast(pa.schema([("k", pa.int64()), ("v", pa.int64())])) for b in batches]
    assert [t.column("v").to_pylist() for t in runs(iter(batches), ["k"])] == [[1, 2, 3], [4], [5]]


def test_components_match_a_search(spark):
    rng = np.random.default_rng(1)
    pairs = [(f"n{a:03d}", f"n{b:03d}") for a, b in rng.integers(0, 200, (140, 2))] + [(f"p{k:03d}", f"p{k + 1:03d}") for k in range(60)]
    names = sorted({n for p in pairs for n in p})
    number = {n: i for i, n in enumerate(names)}
    label = roots(len(names), np.array([number[a] for a, _ in pairs]), np.array([number[b] for _, b in pairs]))
    want = {(n, names[label[i]]) for n, i in number.items() if (label == label[i]).sum() > 1}
    got = components(spark.createDataFrame(pairs, "a string, b string")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0
