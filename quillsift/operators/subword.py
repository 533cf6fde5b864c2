"""Byte-level sub-word vocabulary: learn merges on word counts, encode, decode.

While merges are learned a word is a string with one character per symbol. Tasks
keep an index from pairs to the places in their words, do merges in place, and
sum the counts of neighbouring pairs before anything is shuffled.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quillsift.operators.pair_index import BORDER, SHIFT, Merge, PairIndex, pair_key
from quillsift.session import cut

# Special tokens, and the pattern that splits text into pre-tokens.
SPECIALS = ["[PAD]", "[UNK]"]
PRETOKEN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

FIRST_SYMBOL = 0x100
ROUND_PAIRS = 256
GUESSED_WORDS = 500_000
FREE_PAIRS = 256
FIRST_WINDOW, LARGEST_WINDOW = 256, 2048
PENDING_MERGES = 4_000
FIRST_RETAKE, FLOOR_PARTS = 0, (16, 8, 4, 2)
INDEXED_SYMBOLS = 1 << 22
ROWS_AT_ONCE = 100_000
CACHED_WORDS = 1 << 17
LONG_WORD, UNRANKED = 64, 1 << 62


def byte_alphabet() -> list[str]:
    """Printable stand-in of each byte: itself if visible, else the next code from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


ALPHABET = byte_alphabet()
BYTE_TOKENS = sorted(ALPHABET)
BYTE_ID = [len(SPECIALS) + BYTE_TOKENS.index(char) for char in ALPHABET]


def symbol(token_id: int) -> str:
    """Character that stands for a token id; surrogates are skipped."""
    code = FIRST_SYMBOL + token_id
    return chr(code if code < 0xD800 else code + 0x800)


def symbol_id(char: str) -> int:
    code = ord(char)
    return (code if code < 0xD800 else code - 0x800) - FIRST_SYMBOL


LATIN = "".join(map(chr, range(256)))
BYTE_SYMBOLS = "".join(symbol(BYTE_ID[b]) for b in range(256))


@dataclass(frozen=True)
class Subwords:
    """Vocabulary in id order and merges in rank order; both bounded by the vocabulary size."""

    tokens: list[str]
    merges: list[tuple[int, int, int]]

    def token_sizes(self) -> list[int]:
        """Bytes of each token: its byte-level text has one character per byte."""
        return [len(token) for token in self.tokens]

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.tokens)), "id int, token string")

    def merge_table(self, spark: SparkSession) -> DataFrame:
        rows = [(rank, *merge) for rank, merge in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left int, right int, merged int")

    def save(self, spark: SparkSession, path: str) -> None:
        self.vocab_table(spark).write.mode("overwrite").parquet(f"{path}/vocab")
        self.merge_table(spark).write.mode("overwrite").parquet(f"{path}/merges")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Subwords:
        vocab = spark.read.parquet(f"{path}/vocab").orderBy("id").collect()
        merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        return Subwords([r["token"] for r in vocab], [(r["left"], r["right"], r["merged"]) for r in merges])


def pretokens(text: Column) -> Column:
    """Pre-tokens of a text; a space is put in front unless it starts with one or is empty."""
    spaced = F.when((text == "") | text.startswith(" "), text).otherwise(F.concat(F.lit(" "), text))
    return F.regexp_extract_all(spaced, F.lit(PRETOKEN), F.lit(0))


def pretoken_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """(word, n): the corpus shrinks to its distinct pre-tokens before anything else."""
    words = texts.select(F.explode(pretokens(F.col(column))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def as_symbols(word: Column) -> Column:
    """UTF-8 bytes of a word, one symbol character each."""
    return F.translate(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), LATIN, BYTE_SYMBOLS)


def _codes(merges: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Merges of ids as merges of code points."""
    return [tuple(ord(symbol(token)) for token in merge) for merge in merges]


def _indexes(batches: Iterator[pa.RecordBatch]) -> Iterator[PairIndex]:
    """Indexes of a partition's words, each over a bounded number of symbols."""
    words, counts, size = [], [], 0
    for batch in batches:
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            words.append(word)
            counts.append(n)
            size += len(word) + 1
            if size >= INDEXED_SYMBOLS:
                yield PairIndex(words, np.array(counts, dtype=np.int64))
                words, counts, size = [], [], 0
    if words:
        yield PairIndex(words, np.array(counts, dtype=np.int64))


def _merged(words: DataFrame, merges: list[tuple[int, int, int]]) -> DataFrame:
    """The words after the merges; those of one symbol have no pair left and go."""
    steps = _codes(merges)

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index in _indexes(batches):
            starts = np.flatnonzero(index.symbols[:-1] == BORDER) + 1
            counts = index.weights[starts]
            for step in steps:
                index.merge(*step)
            lines = index.words()
            keep = [i for i, line in enumerate(lines) if len(line) > 1]
            columns = [pa.array([lines[i] for i in keep], pa.string()), pa.array(counts[keep], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    return words.mapInArrow(applied, "word string, n long")


def _count_changes(words: DataFrame, pending: list[tuple[int, int, int]], guessed: list[tuple[int, int, int]]) -> DataFrame:
    """(pair, changes, peak): how the count of every pair moves while the guessed merges are done one by one.

    ``changes`` is a sorted array of (step, n): step 0 holds the count after the pending merges, step k
    what the k-th guess adds. ``peak`` is the highest count on the way. Each task does the merges in place in
    its own index, so a merge touches only the words that hold its pair, and sums before the shuffle.
    """
    earlier, steps = _codes(pending), _codes(guessed)

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index in _indexes(batches):
            for merge in earlier:
                index.merge(*merge)
            found = [index.counts(), *[index.merge(*merge)[:2] for merge in steps]]
            step = np.repeat(np.arange(len(found), dtype=np.int32), [len(keys) for keys, _ in found])
            keys, amounts = (np.concatenate(part) for part in zip(*found))
            for begin in range(0, len(keys), ROWS_AT_ONCE):
                part = slice(begin, begin + ROWS_AT_ONCE)
                columns = [pa.array(keys[part], pa.int64()), pa.array(step[part], pa.int32()), pa.array(amounts[part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["pair", "step", "n"])

    # Dealt by pair once; both aggregates then find their rows together.
    found = words.mapInArrow(changes, "pair long, step int, n long").repartition("pair")
    found = found.groupBy("pair", "step").agg(F.sum("n").alias("n")).where("n <> 0")
    found = found.groupBy("pair").agg(F.array_sort(F.collect_list(F.struct("step", "n"))).alias("changes"))
    none = F.struct(F.lit(0).cast("long").alias("now"), F.lit(0).cast("long").alias("peak"))

    def add(done: Column, change: Column) -> Column:
        now = done["now"] + change["n"]
        return F.struct(now.alias("now"), F.greatest(done["peak"], now).alias("peak"))

    return found.withColumn("peak", F.aggregate("changes", none, add, lambda done: done["peak"]))


class Told(NamedTuple):
    """What all words told of one guessed merge: the pairs, by their texts, whose counts it moves."""

    moved: list[tuple[tuple[str, str], int]]
    reported: set[tuple[str, str]]
    highest: int


class Guesser:
    """Foretells the next merges from the last known counts, from what all words told of the merges guessed
    before, and for the others from a bounded number of frequent words.

    Its guesses decide how many merges one job can confirm, never which merges are taken.
    """

    def __init__(self, words: list[str], counts: np.ndarray):
        self.index = PairIndex(words, counts)
        keys, totals = self.index.counts()
        self.count: dict[int, int] = dict(zip(keys.tolist(), totals.tolist()))
        self.journal: list[tuple[Merge, list[tuple[int, int]]]] = []
        self.told: dict[tuple[str, str], Told] = {}
        self.waiting: dict[str, list[tuple[tuple[str, str], int]]] = {}
        self.heap = [(-count, pair) for pair, count in self.count.items()]
        heapq.heapify(self.heap)

    def learn(self, pair: int, count: int) -> None:
        if self.count.get(pair, 0) != count:
            self.count[pair] = count
            if count > 0:
                heapq.heappush(self.heap, (-count, pair))

    def correct(self, counts: dict[int, int], highest: int, foreseen: Vocabulary, vocabulary: Vocabulary) -> None:
        """Takes over known counts, of pairs as ``foreseen`` names them; any other pair has ``highest`` at most."""
        named = ((foreseen.texts(pair), count) for pair, count in counts.items())
        counts = {vocabulary.pair(texts): count for texts, count in named if all(t in vocabulary.known for t in texts)}
        for pair, count in counts.items():
            self.learn(pair, count)
        for pair in [pair for pair, count in self.count.items() if count > highest and pair not in counts]:
            self.learn(pair, highest)

    def listen(self, rows: Changes, guessed: list[tuple[int, int, int]], vocabulary: Vocabulary, highest: int) -> None:
        """Keeps what a job told of its guesses; ``vocabulary`` has their tokens.

        Pairs are kept by their texts: in another order of the same merges the tokens get other ids.
        """
        if not guessed:
            return
        pairs = [vocabulary.texts(pair) for pair in rows.pairs.tolist()]
        moved: list[list[tuple[tuple[str, str], int]]] = [[] for _ in range(len(guessed) + 1)]
        for of, step, by in zip(rows.of.tolist(), rows.steps.tolist(), rows.by.tolist()):
            moved[step].append((pairs[of], by))
        reported = set(pairs)
        for (left, right, _), own in zip(guessed, moved[1:]):
            self.told[vocabulary.tokens[left], vocabulary.tokens[right]] = Told(own, reported, highest)

    def merge(self, pair: int, merged: int, vocabulary: Vocabulary) -> None:
        keys, amounts, done = self.index.merge(pair >> SHIFT, pair & ((1 << SHIFT) - 1), merged)
        before: list[tuple[int, int]] = []

        def move(other: int, by: int, highest: int | None = None) -> None:
            count = self.count.get(other, 0)
            before.append((other, count))
            self.learn(other, count + by if highest is None or by < 0 else max(count, min(count + by, highest)))

        name = vocabulary.texts(pair)
        count, moved, told = self.count.get(pair, 0), list(zip(keys.tolist(), amounts.tolist())), self.told.get(name)
        # These words stand for the others that hold the pair.
        here = -dict(moved).get(pair, 0)
        if here != count:
            moved = [(other, round(by * count / max(1, here))) for other, by in moved]
        for other, by in moved:
            if told is None:
                move(other, by)
            elif vocabulary.texts(other) not in told.reported:
                move(other, by, told.highest)
        text = name[0] + name[1]
        for names, by in [*(told.moved if told else ()), *self.waiting.pop(text, ())]:
            unknown = next((t for t in names if t not in vocabulary.known), None)
            if unknown is None:
                move(vocabulary.pair(names), by)
            else:
                self.waiting.setdefault(unknown, []).append((names, by))
        before.append((pair, self.count.get(pair, 0)))
        self.learn(pair, 0)
        self.journal.append((done, before))

    def back_to(self, steps: int) -> None:
        """Undoes all but the first ``steps`` merges since the last call, which stay."""
        while len(self.journal) > steps:
            done, before = self.journal.pop()
            self.index.undo(done)
            for other, count in reversed(before):
                self.learn(other, count)
        self.settle()

    def settle(self) -> None:
        """The merges done stay."""
        self.journal, self.waiting = [], {}

    def best(self) -> int | None:
        while self.heap:
            count, pair = self.heap[0]
            if self.count[pair] == -count:
                return pair
            heapq.heappop(self.heap)
        return None

    def ahead(self, steps: int, vocabulary: Vocabulary) -> tuple[list[tuple[int, int, int]], Vocabulary]:
        """Does the next merges as far as is known; also gives the vocabulary after them."""
        vocabulary = vocabulary.copy()
        found: list[tuple[int, int, int]] = []
        while len(found) < steps and not vocabulary.full():
            pair = self.best()
            if pair is None:
                break
            found.append(vocabulary.add(pair))
            self.merge(pair, ord(symbol(found[-1][2])), vocabulary)
        return found, vocabulary

    def take(self, least: int, vocabulary: Vocabulary) -> list[tuple[int, int, int]]:
        """Does the best merges one by one until no pair counts for ``least`` or the vocabulary, which is moved on, is full.

        They are certain if the index holds every place of the pairs that ever count for so much.
        """
        count, index = self.count, self.index
        heap = [(-own, pair) for pair, own in count.items() if own >= least]
        heapq.heapify(heap)
        taken: list[tuple[int, int, int]] = []
        while heap and not vocabulary.full():
            rank, pair = heapq.heappop(heap)
            now = count.get(pair, 0)
            if now != -rank:
                # A count that rose was put in again; one that fell waits for its turn.
                if least <= now < -rank:
                    heapq.heappush(heap, (-now, pair))
                continue
            taken.append(vocabulary.add(pair))
            keys, amounts, _ = index.merge(pair >> SHIFT, pair & ((1 << SHIFT) - 1), ord(symbol(taken[-1][2])))
            for other, by in zip(keys.tolist(), amounts.tolist()):
                now = count[other] = count.get(other, 0) + by
                if by > 0 and now >= least:
                    heapq.heappush(heap, (-now, other))
            count.pop(pair, None)
        return taken


class Vocabulary:
    """Tokens in id order while merges are learned."""

    def __init__(self, tokens: list[str], size: int):
        self.tokens, self.size = tokens, size
        self.known = {token: i for i, token in enumerate(tokens)}

    def copy(self) -> Vocabulary:
        return Vocabulary(list(self.tokens), self.size)

    def full(self) -> bool:
        return len(self.tokens) >= self.size

    def texts(self, pair: int) -> tuple[str, str]:
        return self.tokens[symbol_id(chr(pair >> SHIFT))], self.tokens[symbol_id(chr(pair & ((1 << SHIFT) - 1)))]

    def pair(self, texts: tuple[str, str]) -> int:
        left, right = (ord(symbol(self.known[text])) for text in texts)
        return pair_key(left, right)

    def add(self, pair: int) -> tuple[int, int, int]:
        """The merge of a pair; a text that is a token already keeps its id."""
        left, right = symbol_id(chr(pair >> SHIFT)), symbol_id(chr(pair & ((1 << SHIFT) - 1)))
        text = self.tokens[left] + self.tokens[right]
        if text not in self.known:
            self.known[text] = len(self.tokens)
            self.tokens.append(text)
        return left, right, self.known[text]


class Changes(NamedTuple):
    """Pairs by peak, then pair; their counts move by ``by[i]`` at step ``steps[i]``, for the pair ``of[i]``."""

    pairs: np.ndarray
    peaks: np.ndarray
    of: np.ndarray
    steps: np.ndarray
    by: np.ndarray


def _collected(rows: DataFrame) -> Changes:
    table = rows.toArrow().combine_chunks()
    lists = table.column("changes").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.struct([("step", pa.int32()), ("n", pa.int64())])))
    sizes = np.diff(lists.offsets.to_numpy())
    moves = lists.flatten()
    return Changes(
        table.column("pair").to_numpy(), table.column("peak").to_numpy(), np.repeat(np.arange(len(sizes)), sizes),
        moves.field("step").to_numpy(), moves.field("n").to_numpy(),
    )


def _free(ranked: list[int], known: dict[str, int], texts: dict[int, tuple[str, str]]) -> list[int]:
    """The longest beginning of the ranked pairs none of which touches another.

    Such merges can be done in this order without a look at the counts between them: none moves the count of
    another, and a new pair stands where a pair of lower rank stood, so its count and its name, with a newer token, rank
    lower too. A pair of equal tokens, or one whose text is a token already, stands alone.
    """
    chosen: list[int] = []
    lefts: set[str] = set()
    rights: set[str] = set()
    made: set[str] = set()
    for pair in ranked:
        left, right = texts[pair]
        alone = left == right or left + right in known or left + right in made
        if chosen and (alone or left in rights or right in lefts):
            break
        chosen.append(pair)
        if alone:
            break
        lefts.add(left)
        rights.add(right)
        made.add(left + right)
    return chosen


def _confirmed(
    rows: Changes, complete: bool, guesses: list[tuple[int, int, int]], vocabulary: Vocabulary, foreseen: Vocabulary, least: int
) -> tuple[list[int], int, dict[int, int], bool]:
    """Pairs whose merges are certain, in order; how many of them, in some order, are the first guesses; the counts after these;
    and whether no pair is left. Pairs are named as in ``foreseen``.

    ``rows`` are the first pairs by peak, then pair. Any other pair has a lower peak than the last row,
    or the same peak and a later name, so a best is certain if it beats that. A step goes on from a state of the guesses:
    its best pair is the next guess, or its first pairs are the next guesses in another order and do not touch
    (``_free``), after which the words are the same.
    """
    order = np.argsort(rows.pairs)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    table = np.zeros((len(guesses) + 1, len(order)), dtype=np.int64)
    table[rows.steps, place[rows.of]] = rows.by
    table = table.cumsum(axis=0)
    pairs = rows.pairs[order]
    names = [pair_key(left, right) for left, right, _ in _codes(guesses)]
    limit = (0, 0) if complete else (-int(rows.peaks[-1]), int(rows.pairs[-1]))
    after = vocabulary.copy()
    renamed = False
    best: list[int] = []
    step = 0

    # Ids of the tokens as they are really taken; pairs of tokens not yet taken have no count.
    ids = np.arange(len(foreseen.tokens), dtype=np.int64)
    left_ids, right_ids = (np.array([symbol_id(chr(code)) for code in half.tolist()], dtype=np.int64) for half in (pairs >> SHIFT, pairs & ((1 << SHIFT) - 1)))

    def ranked(many: int) -> list[int]:
        """The first pairs of the step that are certain."""
        counts = table[step]
        if not len(counts):
            return []
        border = np.partition(counts, -many)[-many] if 1 < many < len(counts) else counts.max() if many == 1 else 0
        chosen = np.flatnonzero(counts >= max(border, least))
        if not complete:
            own = counts[chosen]
            sure = own > -limit[0]
            chosen = chosen[sure if renamed else sure | ((own == -limit[0]) & (pairs[chosen] <= limit[1]))]
        order = np.lexsort((ids[right_ids[chosen]], ids[left_ids[chosen]], -counts[chosen]))
        found = pairs[chosen[order[:many]]].tolist()
        texts.update((pair, foreseen.texts(pair)) for pair in found)
        return found

    def take(pair: int) -> None:
        best.append(pair)
        taken = after.add(after.pair(texts[pair]))[2]
        text = texts[pair][0] + texts[pair][1]
        if text in foreseen.known:
            ids[foreseen.known[text]] = taken

    while True:
        texts: dict[int, tuple[str, str]] = {}
        first = ranked(1)
        if not first:
            done = (complete or rows.peaks[-1] < least) and not (table[step] >= least).any()
            return best, step, dict(zip(pairs.tolist(), table[step].tolist())), done
        if step < len(guesses) and first[0] == names[step]:
            take(first[0])
            step += 1
            continue
        free = _free(ranked(FREE_PAIRS), after.known, texts)
        open_left: set[int] = set()
        same = 0
        for n, (pair, name) in enumerate(zip(free, names[step:]), 1):
            open_left ^= {pair}
            open_left ^= {name}
            if not open_left:
                same = n
                break
        for pair in free[: same or len(free)]:
            if after.full():
                break
            take(pair)
        if not same or after.full():
            return best, step, dict(zip(pairs.tolist(), table[step].tolist())), False
        step += same
        renamed = True


def _guessed_words(words: DataFrame) -> tuple[list[str], np.ndarray]:
    """At most ``GUESSED_WORDS`` words and what each counts for: where there are more, the frequent half, and a draw of the others."""
    total = words.count()
    if total <= GUESSED_WORDS:
        known = words.toArrow()
        return known.column("word").to_pylist(), known.column("n").to_numpy()
    half = max(1, GUESSED_WORDS // 2)
    ranked = words.orderBy(F.desc("n"), F.xxhash64("word")).limit(half).toArrow()
    least = ranked.column("n")[-1].as_py()
    others = words.where(F.col("n") <= least)
    drawn = others.orderBy(F.xxhash64("word", F.lit(1))).limit(half).toArrow()
    known = dict(zip(ranked.column("word").to_pylist(), ranked.column("n").to_pylist()))
    rest = [(word, n) for word, n in zip(drawn.column("word").to_pylist(), drawn.column("n").to_pylist()) if word not in known]
    share = (total - len(known)) / max(1, len(rest))
    known |= {word: max(1, round(n * share)) for word, n in rest}
    return list(known), np.array(list(known.values()), dtype=np.int64)


def _pair_counts(words: DataFrame) -> DataFrame:
    """(pair, n): the count of every pair over all words."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index in _indexes(batches):
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()) for own in index.counts()], ["pair", "n"])

    return words.mapInArrow(counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _frequent_parts(words: DataFrame, pairs: DataFrame, floor: int, also: list[int] | None = None) -> DataFrame:
    """(word, n): the parts of the words between pairs that count for less than ``floor``, equal parts as one; the pairs of ``also`` are not cut.

    A pair of such a count is not merged before the best count falls below ``floor``, unless ``_risen`` names it. Rare words
    go into parts that many words share, so these are far fewer.
    """
    # Their number is bounded by that of all symbols, divided by the floor.
    common = pairs.where(F.col("n") >= floor).select("pair").toArrow().column("pair").to_numpy()
    frequent = words.sparkSession.sparkContext.broadcast(np.union1d(common, np.array(also or [], dtype=np.int64)))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index in _indexes(batches):
            lines, weights = index.parts(frequent.value)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array(weights, pa.int64())], ["word", "n"])

    return cut(words.mapInArrow(parts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def _ends(merges: list[tuple[int, int, int]], known: int, side: int) -> dict[int, int]:
    """Of the first ``known`` tokens those that ended up, left (side 0) or right (side 1), in a token that has several such ends, with a number of the group."""
    parent: dict[int, int] = {}

    def root(token: int) -> int:
        while token in parent:
            token = parent[token]
        return token

    end: dict[int, int] = {}
    for merge in merges:
        own, made = merge[side], merge[2]
        last = end.get(own, own)
        if made >= known and made not in end:
            end[made] = last
        elif (one := root(end.get(made, made))) != (other := root(last)):
            parent[one] = other
    members = {*parent, *map(root, parent)}
    return {token: root(token) for token in members}


def _risen(pairs: DataFrame, merges: list[tuple[int, int, int]], known: int, floor: int) -> list[int]:
    """Of the counted pairs of the first ``known`` tokens those below ``floor`` which together may have come to count for so much.

    Without merges the count of a pair only falls, and a pair with a new token stands where a pair of the token's end
    stood. Only a text that two ways of merging make, one token, unites the places of several pairs: pairs whose tokens became the
    ends of such tokens are summed. Most often there is none.
    """
    rights, lefts = _ends(merges, known, 1), _ends(merges, known, 0)
    if not rights and not lefts:
        return []
    spark = pairs.sparkSession

    def groups(ends: dict[int, int], name: str) -> DataFrame:
        return F.broadcast(spark.createDataFrame([(ord(symbol(t)), g) for t, g in ends.items()], f"{name} long, {name}_group long"))

    pairs = pairs.where(F.col("n") < floor).select("pair", "n", F.shiftrightunsigned("pair", SHIFT).alias("left"), F.col("pair").bitwiseAND((1 << SHIFT) - 1).alias("right"))
    pairs = pairs.join(groups(rights, "left"), "left", "left").join(groups(lefts, "right"), "right", "left").where("left_group IS NOT NULL OR right_group IS NOT NULL")
    # A token without a group is one of its own; numbers of groups are ids, far from -codes.
    keys = [F.coalesce(F.col(f"{side}_group"), -F.col(side)) for side in ("left", "right")]
    sums = pairs.groupBy(*[k.alias(f"group{i}") for i, k in enumerate(keys)]).agg(F.sum("n").alias("n"), F.collect_list("pair").alias("pairs")).where(F.col("n") >= floor)
    return [pair for row in sums.collect() for pair in row["pairs"]]


def learn(
    texts: DataFrame, column: str = "text", vocab_size: int = 20_000, min_frequency: int = 0
) -> Subwords:
    """Learn byte-pair merges: highest count first, then lowest left id, then lowest right id.

    Merges depend on each other, so one job for each would be needed. Where the distinct words are at most ``GUESSED_WORDS``
    the driver does all merges on them. Where there are more, the first merges are guessed from a bounded number of words, and one
    job does them on all words and reports how the counts of all pairs move step by step. Right guesses are taken, also where
    neighbours that do not touch stand in another order, and the certain pairs after them. Then the words are written anew, cut
    inside every pair whose count is below a floor (``_frequent_parts``). Where these parts are few enough the driver does all
    merges on them whose count reaches the floor: no cut pair can come to such a count before (``_risen`` looks for
    the exceptions, which are then not cut). The floor is lowered and so on. Where they are too many, the guesses come from a draw of
    them. All merges follow from counts over all words; wrong guesses cost jobs only.
    The word table is written anew after every ``PENDING_MERGES`` merges.
    """
    vocabulary = Vocabulary([*SPECIALS, *BYTE_TOKENS], vocab_size)
    merges: list[tuple[int, int, int]] = []
    counted = pretoken_counts(texts, column).select(as_symbols(F.col("word")).alias("word"), "n")
    spark = texts.sparkSession
    # A fixed number of partitions: a small word table would be merged into one task.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    words = cut(counted.where(F.char_length("word") > 1).repartition(parts, "word"))
    least = max(1, min_frequency)
    if words.count() <= GUESSED_WORDS:
        return Subwords(vocabulary.tokens, Guesser(*_guessed_words(words)).take(least, vocabulary))
    guesser = Guesser(*_guessed_words(words)) if FIRST_RETAKE else None
    pending: list[tuple[int, int, int]] = []
    window = FIRST_WINDOW
    floor = math.inf
    while not vocabulary.full():
        due = guesser is None or len(merges) >= FIRST_RETAKE and floor > least and guesser.count.get(guesser.best(), 0) < 2 * floor
        if due or len(pending) >= PENDING_MERGES:
            words, pending = cut(_merged(words, pending)) if pending else words, []
        if due:
            guesser = None
            pairs = cut(_pair_counts(words))
            count = pairs.agg(F.max("n")).first()[0] or 0
            for part in FLOOR_PARTS:
                # Counts fall about as the number of merges grows, so the floor need not lie far below the last one.
                floor = max(least, count // part, count * len(merges) // (4 * vocab_size))
                parts = _frequent_parts(words, pairs, floor)
                known = parts.count() <= GUESSED_WORDS
                if known:
                    break
            also: list[int] = []
            while known:
                after = vocabulary.copy()
                taken = Guesser(*_guessed_words(parts)).take(floor, after)
                risen = _risen(pairs, taken, len(vocabulary.tokens), floor)
                if not risen:
                    break
                also += risen
                parts = _frequent_parts(words, pairs, floor, also)
                known = parts.count() <= GUESSED_WORDS
            if known:
                vocabulary = after
                merges += taken
                pending += taken
                if floor <= least:
                    break
                continue
            guesser = Guesser(*_guessed_words(parts))
        guesses, foreseen = guesser.ahead(window, vocabulary)
        wanted = 4 * (len(guesses) + ROUND_PAIRS)
        rows = _collected(_count_changes(words, pending, guesses).orderBy(F.desc("peak"), "pair").limit(wanted))
        complete = len(rows.pairs) < wanted
        best, steps, counts, done = _confirmed(rows, complete, guesses, vocabulary, foreseen, least)
        highest = 0 if complete else int(rows.peaks[-1])
        guesser.listen(rows, guesses, foreseen, highest)
        names = [foreseen.texts(pair) for pair in best]
        guessed = [pair_key(left, right) for left, right, _ in _codes(guesses)]
        kept = next((i for i, pair in enumerate(best[:steps]) if pair != guessed[i]), steps)
        guesser.back_to(kept)
        taken: list[tuple[int, int, int]] = []
        for i, texts_of in enumerate(names):
            pair = vocabulary.pair(texts_of)
            taken.append(vocabulary.add(pair))
            if i == steps:
                guesser.correct(counts, highest, foreseen, vocabulary)
            if i >= kept:
                guesser.merge(pair, ord(symbol(taken[-1][2])), vocabulary)
        if len(best) == steps:
            guesser.correct(counts, highest, foreseen, vocabulary)
        guesser.settle()
        merges += taken
        pending += taken
        if done:
            break
        # What a job tells of guesses in a wrong order still serves the next ones.
        window = (min(LARGEST_WINDOW, 2 * max(1, window)) if 4 * len(best) > len(guesses) else window) * bool(best)
    return Subwords(vocabulary.tokens, merges)


def merge_ranks(merges: list[tuple[int, int, int]]) -> dict[str, tuple[int, str]]:
    """Pair of symbols to (rank, merged symbol)."""
    return {
        symbol(left) + symbol(right): (rank, symbol(merged))
        for rank, (left, right, merged) in reversed(list(enumerate(merges)))
    }


def segmenter(ranks: dict[str, tuple[int, str]]):
    """Function from one pre-token to its ids: repeat the earliest learned merge that applies."""
    to_symbols = dict(zip(range(256), BYTE_SYMBOLS))

    @lru_cache(maxsize=CACHED_WORDS)
    def segment(word: str) -> tuple[int, ...]:
        line = word.encode("utf-8").decode("latin-1").translate(to_symbols)
        while len(line) > 1:
            found = [(ranks[p][0], p) for p in {line[i : i + 2] for i in range(len(line) - 1)} if p in ranks]
            if not found:
                break
            pair = min(found)[1]
            line = line.replace(pair, ranks[pair][1])
        return tuple(map(symbol_id, line))

    return segment


class RankTable(NamedTuple):
    """The ranks of ``merge_ranks`` as arrays: pairs of ids in order, their ranks and what they merge to."""

    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray

    @staticmethod
    def of(ranks: dict[str, tuple[int, str]]) -> RankTable:
        rows = sorted((symbol_id(pair[0]) << SHIFT | symbol_id(pair[1]), rank, symbol_id(merged)) for pair, (rank, merged) in ranks.items())
        # A last row that no pair equals spares a look at the table's end.
        return RankTable(*np.array([*rows, (1 << 62, UNRANKED, 0)], dtype=np.int64).T.copy())

    def found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, ``UNRANKED`` where it does not merge, and its row."""
        pairs = left.astype(np.int64) << SHIFT | right
        rows = np.searchsorted(self.pairs, pairs)
        return np.where(self.pairs[rows] == pairs, self.ranks[rows], UNRANKED), rows


def segmented(words: pa.StringArray, table: RankTable, segment) -> pa.ListArray:
    """Ids of each word: in every round the earliest learned merge of each word is done at all its places.

    Words of more than ``LONG_WORD`` bytes are left to ``segment``, so that their many rounds do not hold up the others.
    """
    sizes = pc.binary_length(words).to_numpy().astype(np.int64)
    order = np.argsort(sizes > LONG_WORD, kind="stable")
    short = int((sizes <= LONG_WORD).sum())
    words = words.take(pa.array(order))
    texts = words.slice(0, short)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + short + 1].astype(np.int64) if short else np.zeros(1, np.int64)
    ids = np.array(BYTE_ID, dtype=np.int32)[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]] if offsets[-1] > offsets[0] else np.zeros(0, np.int32)
    sizes, own = sizes[order[:short]], order[:short]
    out = [(own[sizes == 0], sizes[sizes == 0], ids[:0])]
    own, sizes = own[sizes > 0], sizes[sizes > 0]
    ranks = rows = None
    while len(own):
        ends = np.cumsum(sizes)
        if ranks is None:
            ranks, rows = table.found(ids, np.append(ids[1:], 0))
            ranks[ends - 1] = UNRANKED
        lowest = np.minimum.reduceat(ranks, ends - sizes)
        open_words = lowest != UNRANKED
        if not open_words.all():
            moving = np.repeat(open_words, sizes)
            out.append((own[~open_words], sizes[~open_words], ids[~moving]))
            own, sizes, lowest = own[open_words], sizes[open_words], lowest[open_words]
            ids, ranks, rows = ids[moving], ranks[moving], rows[moving]
            if not len(own):
                break
        at = np.flatnonzero(ranks == np.repeat(lowest, sizes))
        # In a run of equal symbols every other place merges.
        number = np.arange(len(at))
        breaks = np.concatenate(([True], at[1:] != at[:-1] + 1))
        at = at[(number - np.maximum.accumulate(np.where(breaks, number, 0))) % 2 == 0]
        ids[at] = table.merged[rows[at]]
        kept = np.ones(len(ids), dtype=bool)
        kept[at + 1] = False
        word_of = np.repeat(np.arange(len(own)), sizes)
        sizes = sizes - np.bincount(word_of[at], minlength=len(own))
        place = np.cumsum(kept) - 1
        ids, ranks, rows, word_of = ids[kept], ranks[kept], rows[kept], word_of[kept]
        at = place[at]
        changed = np.unique(np.concatenate((at, at[at > 0] - 1)))
        following = np.minimum(changed + 1, len(ids) - 1)
        ranks[changed], rows[changed] = table.found(ids[changed], ids[following])
        last = (word_of[changed] != word_of[following]) | (following == changed)
        ranks[changed[last]] = UNRANKED
    rest = [segment(word) for word in words.slice(short).to_pylist()]
    out.append((order[short:], np.array(list(map(len, rest)), dtype=np.int64), np.array([i for line in rest for i in line], dtype=np.int32)))
    own, sizes, ids = (np.concatenate(part) for part in zip(*out))
    found = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(ids.astype(np.int32)))
    return found.take(pa.array(np.argsort(own)))


def encode(text: Column, model: Subwords) -> Column:
    """Ids of a text as array<int>.

    Pre-tokens are cut by the JVM; the distinct ones of an Arrow batch are segmented side by
    side, and no token is ever shuffled. The merges travel as a broadcast.
    """
    shared = SparkSession.getActiveSession().sparkContext.broadcast(merge_ranks(model.merges))

    @arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segment, table = segmenter(shared.value), RankTable.of(shared.value)
        for batch in batches:
            words = batch.flatten().dictionary_encode()
            yield _relisted(batch, segmented(words.dictionary.cast(pa.string()), table, segment).take(words.indices))

    return ids(pretokens(text))


def _relisted(lists: pa.ListArray, parts: pa.ListArray) -> pa.ListArray:
    """The lists with each of their values replaced by its part, parts put end to end."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    starts = parts.offsets.to_numpy()[begins] - parts.offsets[0].as_py()
    found = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), parts.flatten())
    return pc.if_else(lists.is_valid(), found, None) if lists.null_count else found


def _valued(lists: pa.ListArray, values: pa.Array) -> pa.ListArray:
    """The lists with other values."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    found = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values)
    return pc.if_else(lists.is_valid(), found, None) if lists.null_count else found


def decode(ids: Column, model: Subwords) -> Column:
    """Text of an id array; special tokens are left out."""
    byte_of = {char: b for b, char in enumerate(ALPHABET)}
    pieces = [b""] * len(SPECIALS) + [bytes(byte_of[c] for c in t) for t in model.tokens[len(SPECIALS) :]]
    shared = SparkSession.getActiveSession().sparkContext.broadcast(pieces)

    @arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pa.array(shared.value, pa.binary())
        for batch in batches:
            joined = pc.binary_join(_valued(batch, table.take(batch.flatten())), b"")
            try:
                yield joined.cast(pa.string())
            except pa.ArrowInvalid:
                yield pa.array([None if own is None else own.decode("utf-8", "replace") for own in joined.to_pylist()], pa.string())

    return text(ids)


def token_strings(encoded: Column, model: Subwords) -> Column:
    """Token texts of an id array, in order."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model.tokens)

    @arrow_udf("array<string>")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pa.array(shared.value, pa.string())
        for batch in batches:
            yield _valued(batch, table.take(batch.flatten()))

    return tokens(encoded)


def pad_truncate(ids: Column, length: int = 3_000, pad: Column | None = None) -> Column:
    """Exactly ``length`` ids: cut on the right, or filled with the padding id 0."""
    fill = F.array_repeat(F.lit(0) if pad is None else pad, length)
    return F.slice(F.concat(ids, fill), 1, length)
