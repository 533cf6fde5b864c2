"""Byte-level BPE by ranked merges, in Spark's higher-order functions.

Method: a word is a string with one symbol per id, its bytes at first. A fold over the word's length replaces, in
each step, the leftmost neighbours of the lowest rank by their merge, as a rank file asks; ranks come from a literal
map from pairs to merges, cut into hash buckets so that a look-up reads a few entries. Symbols and ranks are strings
because Spark cuts and joins strings much faster than arrays. Texts are cut into words
by the JVM's regular expressions. The ``FREQUENT`` commonest distinct words of a bounded sample of the
texts are folded once and travel as a second literal; any other word is folded where it stands, so no token
is ever shuffled. Which words are folded ahead decides the time, never the ids. Words longer than
``LONGEST`` bytes, for which the fold's work would grow with the square, go to an Arrow function that does
the same merges from a heap. Decoding concatenates the binary pieces of the ids.

Bounds: the literals are bounded by the rank file and by ``FREQUENT``; the sample by ``SAMPLE`` rows. ``encode``
lowers spark.sql.maxPlanStringLength, as the driver would else keep the literals' text for every execution. A row
holds the ids of its own text. A lost executor costs its tasks, which depend on nothing but their rows.

Defined results: a null or empty text has no ids; a text is encoded whole, however long; repeated rows get
equal ids; an empty table gives an empty result; other columns pass through, and the result replaces a
column of its own name only. A rank file must give every byte and reach every token by its own merges,
else ``read_ranks`` raises ValueError. ``decode`` gives null for a null array and skips ids that are not
in the file.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quillsift.session import written

SAMPLE = 20_000
FREQUENT = 1 << 19
LONGEST = 256
#: Buckets of pairs and of words; that of words is a power of two.
PAIR_BUCKETS, WORD_BUCKETS = 1 << 15, 1 << 17
#: Ends of a word while it is folded, and the rank of neighbours that make no token, behind all symbols.
EDGE, NO_RANK = "\x01", "\U0010ffff"
#: In a bucket of words each is OPEN, word, CLOSE, ids as symbols.
OPEN, CLOSE, BORDER = "\x01", "\x02", "\x03"
#: Characters of a plan's text that the driver keeps; it would hold the literals of every execution.
PLAN_TEXT = 1 << 16
FIRST_SYMBOL, SURROGATES, SKIPPED = 0x100, 0xD800, 0x800
LATIN = "".join(map(chr, range(256)))


@dataclass(frozen=True)
class Ranks:
    """``pieces[id]`` are a token's bytes, ``merges`` the pairs of ids that make a token."""

    pieces: list[bytes]
    merges: dict[tuple[int, int], int]


def merge_all(ids: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """Merges from a heap of (rank, place): the leftmost pair of the lowest rank first; n log n in the length."""
    after = list(range(1, len(ids) + 1))
    before = list(range(-1, len(ids) - 1))
    alive = [True] * len(ids)
    heap = [(merges[pair], i, pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in merges]
    heapq.heapify(heap)
    while heap:
        merged, i, pair = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= len(ids) or (ids[i], ids[j]) != pair:
            continue
        ids[i], alive[j], after[i] = merged, False, after[j]
        if after[i] < len(ids):
            before[after[i]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] < len(ids):
                pair = (ids[left], ids[after[left]])
                if pair in merges:
                    heapq.heappush(heap, (merges[pair], left, pair))
    return [token for token, kept in zip(ids, alive) if kept]


def read_ranks(path: str) -> Ranks:
    """A rank file: a line has the base64 bytes of a token and its rank, which is its id.

    The file, of bounded size, is read on the driver. The pair that makes a token is the last one left when
    the token's bytes are merged by lower ranks.
    """
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the rank file lacks bytes")
    merges: dict[tuple[int, int], int] = {}
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        if len(token) > 1:
            left = merge_all([ranks[bytes([b])] for b in token], merges)
            if len(left) != 2:
                raise ValueError(f"token {rank} is not reached by the merges of lower rank")
            merges[left[0], left[1]] = rank
    return Ranks(pieces, merges)


def symbol(token: int) -> str:
    """One character per id, surrogates skipped."""
    code = FIRST_SYMBOL + token
    return chr(code if code < SURROGATES else code + SKIPPED)


def short_plans(spark: SparkSession) -> None:
    """Lowers the length of plan texts for the session, unless it has one of its own."""
    name, unset = "spark.sql.maxPlanStringLength", 2**31 - 16
    if spark.conf.get(name) in (str(unset), f"{unset}b"):
        spark.conf.set(name, PLAN_TEXT)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed, and written in the plan, once."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda known, _: known, body)


def _strings(values: list[str]) -> Column:
    """A constant array that the optimiser folds to one literal."""
    return F.split(F.lit(BORDER.join(values)), BORDER, -1)


def _rank_map(ranks: Ranks) -> Column:
    """array<map<string,string>>: pair of symbols to the symbol of its merge, in buckets by CRC-32."""
    buckets: list[dict[str, str]] = [{} for _ in range(PAIR_BUCKETS)]
    for (left, right), rank in ranks.merges.items():
        pair = symbol(left) + symbol(right)
        buckets[zlib.crc32(pair.encode()) % PAIR_BUCKETS][pair] = symbol(rank)
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")


def _byte_symbols(ranks: Ranks) -> str:
    place = {piece: i for i, piece in enumerate(ranks.pieces) if len(piece) == 1}
    return "".join(symbol(place[bytes([b])]) for b in range(256))


def words_of(text: Column, pattern: str) -> Column:
    """Every match of the pattern, in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(pattern), F.lit(0))


def fold(word: Column, of_bytes: str, rank_map: Column) -> Column:
    """Symbols of one word: as many steps as the word has bytes, each doing the best merge or none.

    ``ranks`` has one symbol per pair of neighbours: the merge's, or NO_RANK. Symbols sort as their ids, which are the
    ranks. A step looks up the two pairs that its merge makes; the others keep their ranks.
    """

    def rank(pair: Column) -> Column:
        bucket = F.get(rank_map, F.crc32(pair.cast("binary")) % PAIR_BUCKETS)
        return F.coalesce(F.try_element_at(bucket, pair), F.lit(NO_RANK))

    def state(signs: Column, ranks: Column, each: Column) -> Column:
        return F.struct(signs.alias("signs"), ranks.alias("ranks"), F.array_min(each).alias("best"))

    def begin(signs: Column) -> Column:
        pairs = F.sequence(F.lit(1), F.char_length(signs) - 1)
        each = F.transform(pairs, lambda i: rank(F.substring(signs, i, F.lit(2))))
        return let(each, lambda each: state(signs, F.array_join(each, ""), each))

    def merge(done: Column, p: Column) -> Column:
        def ranked(signs: Column) -> Column:
            before = F.overlay(done["ranks"], rank(F.substring(signs, p - 1, F.lit(2))), p - 1, F.lit(2))
            ranks = F.overlay(before, rank(F.substring(signs, p, F.lit(2))), p, F.lit(1))
            return let(ranks, lambda ranks: state(signs, ranks, F.split(ranks, "")))

        return let(F.overlay(done["signs"], done["best"], p, F.lit(2)), ranked)

    def step(done: Column, _: Column) -> Column:
        place = F.instr(done["ranks"], done["best"])
        return F.when(done["best"] == NO_RANK, done).otherwise(let(place, lambda p: merge(done, p)))

    signs = F.translate(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), LATIN, of_bytes)
    start = let(F.concat(F.lit(EDGE), signs, F.lit(EDGE)), begin)
    return F.aggregate(
        F.sequence(F.lit(1), F.octet_length(word)), start, step,
        lambda done: F.substring(done["signs"], F.lit(2), F.char_length(done["signs"]) - 2),
    )


def _folded(ranks: Ranks, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body`` with a function from a word to its ids as symbols; the literal is written once."""
    of_bytes = _byte_symbols(ranks)
    return let(_rank_map(ranks), lambda rank_map: body(lambda word: fold(word, of_bytes, rank_map)))


def _bucket(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(WORD_BUCKETS - 1)


def frequent_words(docs: DataFrame, text: str, ranks: Ranks, pattern: str, frequent: int = FREQUENT, sample: int = SAMPLE) -> list[str]:
    """The commonest words with their ids, in WORD_BUCKETS buckets; both bounds are parameters.

    A look-up reads its bucket from the end, so the commonest word stands last.
    """
    share = min(1.0, sample / max(1, docs.count()))
    chosen = docs.select(text).sample(share, seed=1) if share < 1 else docs.select(text)
    counted = chosen.select(F.explode(words_of(F.col(text), pattern)).alias("word")).groupBy("word").count()
    fit = (F.octet_length("word") <= LONGEST) & ~F.col("word").rlike(f"[{OPEN}{CLOSE}{BORDER}]")
    top = written(counted.where(fit).orderBy(F.desc("count"), "word").limit(frequent), "words")
    # A limit leaves one partition; the fold deserves all cores.
    parts = max(1, docs.sparkSession.sparkContext.defaultParallelism)
    done = top.repartition(parts, "word").select("word", "count", _folded(ranks, lambda ids_of: ids_of(F.col("word"))).alias("ids"))
    entry = F.concat(F.lit(OPEN), F.col("word"), F.lit(CLOSE), F.col("ids"))
    entries = F.sort_array(F.collect_list(F.struct("count", entry.alias("entry"))))["entry"]
    found = done.groupBy(_bucket(F.col("word")).alias("at")).agg(F.array_join(entries, "").alias("entries"))
    buckets = [""] * WORD_BUCKETS
    for row in found.toLocalIterator():
        buckets[row["at"]] = row["entries"]
    return buckets


def encode(docs: DataFrame, ranks: Ranks, pattern: str, text: str = "text", into: str = "ids", frequent: int = FREQUENT) -> DataFrame:
    """``docs`` with ``into``: the ids of the whole text as array<int>.

    Each match of the pattern is encoded on its own; special tokens are ordinary text.
    """
    short_plans(docs.sparkSession)
    merges = docs.sparkSession.sparkContext.broadcast(ranks.merges)
    singles = docs.sparkSession.sparkContext.broadcast({piece[0]: i for i, piece in enumerate(ranks.pieces) if len(piece) == 1})

    @pandas_udf("array<string>")
    def merged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda words: ["".join(map(symbol, merge_all([singles.value[b] for b in word.encode()], merges.value))) for word in words])

    others = [c for c in docs.columns if c != into]
    # Whether the text holds the sign that begins an entry.
    marked = F.contains(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(OPEN))
    row = docs.select(F.struct(*others).alias("row"), words_of(F.col(text), pattern).alias("words"), marked.alias("marked"))
    long = F.array_distinct(F.filter("words", lambda w: F.octet_length(w) > LONGEST))
    row = row.withColumn("long", long).withColumn("merged", merged("long"))
    row = row.withColumn("odd", F.col("marked") | (F.size("long") > 0))
    known = _strings(frequent_words(docs, text, ranks, pattern, frequent))

    def looked_up(word: Column, buckets: Column) -> Column:
        # The word put between the two signs, which costs less than a concatenation of three.
        entry = F.overlay(F.lit(OPEN + CLOSE), word, F.lit(2), F.lit(0))
        behind = F.call_function("substring_index", F.get(buckets, _bucket(word)), entry, F.lit(-1))
        return F.substring_index(behind, OPEN, 1)

    def plain(word: Column, buckets: Column, ids_of: Callable[[Column], Column]) -> Column:
        return let(looked_up(word, buckets), lambda ids: F.when(ids != "", ids).otherwise(ids_of(word)))

    def found(word: Column, buckets: Column, ids_of: Callable[[Column], Column]) -> Column:
        one = F.when(F.octet_length(word) > LONGEST, F.get(F.col("merged"), F.array_position(F.col("long"), word).cast("int") - 1))
        return one.when(F.contains(word, F.lit(OPEN)), ids_of(word)).otherwise(plain(word, buckets, ids_of))

    def joined(buckets: Column, ids_of: Callable[[Column], Column]) -> Column:
        # Few texts have words that need more than a look-up.
        simple = F.array_join(F.transform("words", lambda w: plain(w, buckets, ids_of)), "")
        return F.when(F.col("odd"), F.array_join(F.transform("words", lambda w: found(w, buckets, ids_of)), "")).otherwise(simple)

    signs = let(known, lambda buckets: _folded(ranks, lambda ids_of: joined(buckets, ids_of)))
    row = row.select("row", signs.alias("signs"))

    def number(sign: Column) -> Column:
        code = F.ascii(sign)
        if FIRST_SYMBOL + len(ranks.pieces) <= SURROGATES:
            return code - FIRST_SYMBOL
        return F.when(code < SURROGATES, code).otherwise(code - SKIPPED) - FIRST_SYMBOL

    ids = F.when(F.col("signs") == "", F.array().cast("array<int>")).otherwise(F.transform(F.split("signs", ""), number))
    return row.select("row.*", ids.alias(into))


def decode(ids: Column, ranks: Ranks) -> Column:
    """The bytes of an array of ids."""
    pieces = _strings([piece.hex() for piece in ranks.pieces])
    return let(pieces, lambda pieces: F.unhex(F.array_join(F.transform(ids, lambda i: F.try_element_at(pieces, F.when(i >= 0, i) + 1)), "")))


def little_endian(ids: Column, ranks: Ranks) -> Column:
    """The ids as unsigned 32-bit integers, lowest byte first."""
    numbers = _strings([i.to_bytes(4, "little").hex() for i in range(len(ranks.pieces))])
    return let(numbers, lambda numbers: F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(numbers, i + 1)), "")))
