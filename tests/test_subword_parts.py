"""Merges learned on the parts of rare words, and words segmented side by side."""

import random

import pyarrow as pa
import pytest

from quillsift.operators import subword as sw
from quillsift.operators.pair_index import pair_key
from tests.test_subword import library


def made_up(alphabet, lines, seed, most=9):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, most))) for _ in range(30)) for _ in range(lines)]


@pytest.mark.parametrize("alphabet, bound, size", [("ab", 150, 420), ("abcd", 400, 600)])
def test_no_job_per_window_and_the_merges_of_the_library(spark, monkeypatch, alphabet, bound, size):
    lines = made_up(alphabet, 60, 3)
    df = spark.createDataFrame(list(enumerate(lines)), "id long, text string")
    monkeypatch.setattr(sw, "GUESSED_WORDS", bound)
    monkeypatch.setattr(sw, "FLOOR_PARTS", (16, 8, 4, 2, 1))
    jobs, collected = [], sw._collected
    monkeypatch.setattr(sw, "_collected", lambda rows: jobs.append(1) or collected(rows))
    model = sw.learn(df, vocab_size=size)
    assert library(lines, size).get_vocab() == {token: i for i, token in enumerate(model.tokens)}
    assert len(jobs) <= 4, len(jobs)


def test_a_text_made_in_two_ways_unites_cut_pairs(spark):
    known = 300
    a, b, c, bc, y, z = 10, 11, 12, 299, 20, 21
    merges = [(a, b, 300), (300, c, 301), (a, bc, 301)]
    counts = [(c, y, 6), (bc, y, 6), (c, z, 9), (b, y, 8), (a, b, 40)]
    rows = [(pair_key(ord(sw.symbol(left)), ord(sw.symbol(right))), n) for left, right, n in counts]
    pairs = spark.createDataFrame(rows, "pair long, n long")
    assert sorted(sw._risen(pairs, merges, known, 10)) == sorted(row[0] for row in rows[:2])
    assert sw._risen(pairs, merges, known, 13) == []
    # Two ways with the same ends unite nothing.
    assert sw._risen(pairs, [(a, b, 300), (300, c, 301), (b, c, 302), (a, 302, 301)], known, 10) == []


def test_words_side_by_side_as_one_by_one():
    rng = random.Random(4)
    words = ["", "a", "aaaaaaa", "aaaa", "é漢" * 9, "ab" * 200, *{"".join(rng.choice("abc") for _ in range(rng.randint(1, 70))) for _ in range(300)}]
    ids = {ch: sw.BYTE_ID[ord(ch)] for ch in "abc"}
    a, b, c = ids["a"], ids["b"], ids["c"]
    merges = [(a, a, 258), (258, 258, 259), (a, b, 260), (b, c, 261), (260, c, 262), (a, 261, 262), (258, b, 263), (262, 262, 264)]
    ranks = sw.merge_ranks(merges)
    one = sw.segmenter(ranks)
    found = sw.segmented(pa.array(words), sw.RankTable.of(ranks), one)
    assert found.to_pylist() == [list(one(word)) for word in words]
    assert sw.segmented(pa.array([], pa.string()), sw.RankTable.of(ranks), one).to_pylist() == []
    assert sw.segmented(pa.array(["abc"]), sw.RankTable.of({}), one).to_pylist() == [[a, b, c]]
