import base64
import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from quillsift.llm import bytepairs as B
from quillsift.llm import queries

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")

TEXTS = [
    None, "", " ", "  \n\n  x's don't ''ll \t", "a" * 1000, " " * 700 + "b", "日本語" * 300 + "𝔘𝔫𝔦 　 x ", "<|endoftext|>",
    "\x01a\x02b\x01\x01\x02\x03", "é" * 129 + "-" * 600, "½ⅷ²3４ \x85\x1c\x0b", "word " * 20_000, "again", "again",
]


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    lines = open(public.path("byte_bpe_multi_50k.tiktoken"), "rb")
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=table, special_tokens={})


def test_ids_and_bytes_equal_the_librarys(spark, ranks, library):
    rows = [(i, text, "other", i) for i, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, words int")
    got = B.encode(docs, ranks, "(?U)" + public.PATTERN, frequent=5)
    assert got.columns == [*docs.columns, "ids"]
    got = got.select("*", B.decode(F.col("ids"), ranks).alias("bytes"), B.little_endian(F.col("ids"), ranks).alias("le"))
    for row in got.collect():
        ids = library.encode_ordinary(row["text"] or "")
        assert row["ids"] == ids and row["row"] == "other" and row["words"] == row["doc_id"]
        assert bytes(row["bytes"]) == (row["text"] or "").encode() and bytes(row["le"]) == struct.pack(f"<{len(ids)}I", *ids)


def test_query_over_its_whole_table(spark, folder, library):
    got = queries.op12_byte_pairs(spark, folder).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(got) == len(docs)
    for row in got:
        ids = library.encode_ordinary(docs[row["doc_id"]])
        expected = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(docs[row["doc_id"]].encode()).hexdigest())
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == expected


def test_empty_table_unknown_ids_and_bad_files(spark, ranks, tmp_path):
    empty = spark.createDataFrame([], "text string, ids string")
    assert B.encode(empty, ranks, "(?U)" + public.PATTERN).collect() == []
    odd = spark.createDataFrame([([72, 60_000, -1],), (None,)], "ids array<int>").select(B.decode(F.col("ids"), ranks).alias("b")).collect()
    assert odd[0]["b"] == ranks.pieces[72] and odd[1]["b"] is None
    lines = [base64.b64encode(bytes([b])) + b" %d\n" % b for b in range(256)]
    (tmp_path / "few").write_bytes(b"".join(lines[:9]))
    (tmp_path / "jump").write_bytes(b"".join([*lines, base64.b64encode(b"abc") + b" 256\n"]))
    for name in ("few", "jump"):
        with pytest.raises(ValueError):
            B.read_ranks(str(tmp_path / name))


def test_the_heap_takes_the_leftmost_of_the_lowest_rank():
    merges = {(0, 0): 3, (3, 0): 4, (3, 3): 5}
    assert B.merge_all([0] * 5, merges) == [3, 4]
    assert B.merge_all([0] * 4, merges) == [5]
    assert B.merge_all([], merges) == [] and B.merge_all([1], merges) == [1]


def test_a_look_up_meets_the_commonest_word_of_a_bucket_first(spark, ranks, monkeypatch):
    monkeypatch.setattr(B, "WORD_BUCKETS", 1)
    docs = spark.createDataFrame([("a b b",), ("zz b a a a a",)], "text string")
    (bucket,) = B.frequent_words(docs, "text", ranks, r"\S+")
    words = [entry.split(B.CLOSE)[0] for entry in bucket.split(B.OPEN)[1:]]
    assert words == ["zz", "b", "a"]
    got = B.encode(docs, ranks, r"\S+").orderBy("text").collect()
    assert [row["ids"] for row in got] == [[i for c in text.split() for i in expected(ranks, c)] for text in ("a b b", "zz b a a a a")]


def expected(ranks, word):
    single = {piece[0]: i for i, piece in enumerate(ranks.pieces) if len(piece) == 1}
    return B.merge_all([single[b] for b in word.encode()], ranks.merges)


def test_the_fold_cuts_strings_not_arrays(spark, ranks):
    """An array cut or joined costs the interpreter many times a string's cut."""
    words = [" unwholesomeness", "aaaaa", "ÄÖÜß", "日本語日本", "𝔘𝔫𝔦", "\x01\x02\x03", "x", "-" * 99, " \u00a0\u3000"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    folded = table.select("word", B._folded(ranks, lambda ids_of: ids_of(F.col("word"))).alias("signs"))
    assert "slice(" not in folded._jdf.queryExecution().analyzed().toString()
    for row in folded.collect():
        assert row["signs"] == "".join(map(B.symbol, expected(ranks, row["word"])))


def test_the_fold_knows_ids_on_both_sides_of_the_surrogates(spark):
    far = B.SURROGATES - B.FIRST_SYMBOL
    pieces = [bytes([b]) for b in range(256)] + [b""] * far
    for rank, piece in ((far - 1, b"bc"), (far, b"ab"), (far + 1, b"aab")):
        pieces[rank] = piece
    ranks = B.Ranks(pieces, {(98, 99): far - 1, (97, 98): far, (97, far): far + 1})
    docs = spark.createDataFrame([("abc aab ab",), ("aabc",)], "text string")
    for frequent in (1, 9):
        got = B.encode(docs, ranks, r"\S+", frequent=frequent).orderBy("text").collect()
        assert [row["ids"] for row in got] == [[97, 97, far - 1], [97, far - 1, far + 1, far]]
