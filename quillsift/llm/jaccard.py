"""N-gram Jaccard join: all texts whose sets of five-word shingles have a similarity of 0.8 or more.

Method: texts with equal shingle sets are one node. Each node has 80 MinHash values; 20 bands of four
bring nodes into buckets (a pair at 0.8 misses all of them with probability 3e-5, a pair at 0.9 with
6e-10, and groups are compared in full). Of each value 16 bits are kept for the comparison. Within a bucket the values are compared incrementally, sixteen at a time: after each step a pair
is dropped when the posterior probability (uniform prior) that its similarity reaches the threshold is
below ``TOLERANCE``. The survivors form candidate groups, in which the shingle sets are compared exactly.

What moves is linear in the texts: a bucket returns a spanning forest of its surviving links, not its
pairs; equal buckets of several bands are looked at once; a group returns one row per member with the
number of its links. Large buckets and groups are dealt as pairs of blocks of bounded size, so no task
holds one whole; nothing is capped. Joins with the list of group members are sort-merge joins at every
size, as that list grows with the texts.

Defined results: null and empty texts, or texts without a word, have no shingles, no link and a class of
their own; a text of one to four words has one shingle of them all; repeated rows are copies, also if
they share their id; a null id takes part like any other and loses against any id; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.llm.grouped import components, roots, runs
from quillsift.llm.words import chunks, mixed, odd_numbers, shingles
from quillsift.session import written

WIDTH = 5
SEED = 23
THRESHOLD = Fraction(4, 5)
HASHES, ROWS = 80, 4
STEP = 16
TOLERANCE = 1e-5
BUCKET_BLOCK = 1024
GROUP_BLOCK = 256
COLUMNS_AT_ONCE = 8192
PRINT = "digest binary, n long, signature binary, bands array<long>"
ARROW_PRINT = pa.struct([("digest", pa.binary()), ("n", pa.int64()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _digest(codes: np.ndarray) -> bytes:
    return hashlib.blake2b(codes.tobytes(), digest_size=16).digest()


def minhashes(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, HASHES) minima; texts without shingles must be left out."""
    out = np.empty((len(first) - 1, HASHES), dtype=np.uint32)
    for j, factor in enumerate(odd_numbers(HASHES, SEED + 1)):
        values = ((codes * factor) >> np.uint64(32)).astype(np.uint32)
        out[:, j] = np.minimum.reduceat(values, first[:-1])
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(texts, bands) hashes of ROWS values each; different bands never share a key by design."""
    parts = signatures.reshape(len(signatures), HASHES // ROWS, ROWS).astype(np.uint64)
    total = np.zeros(parts.shape[:2], dtype=np.uint64)
    for j, factor in enumerate(odd_numbers(ROWS, SEED + 2)):
        total += mixed(parts[:, :, j] + np.uint64(1)) * factor
    return mixed(total + odd_numbers(HASHES // ROWS, SEED + 3)).view(np.int64)


def _fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Digest of the shingle set, its size, MinHash values and band keys; null without shingles."""
    cache: dict = {}
    for texts in batches:
        rows: list = []
        for _, found in chunks(texts.to_pylist(), cache):
            codes, first = shingles(found, WIDTH, SEED)
            filled = np.flatnonzero(np.diff(first))
            own: list = [{"digest": None, "n": 0, "signature": None, "bands": None}] * (len(first) - 1)
            if len(filled):
                signatures = minhashes(codes, np.append(first[filled], first[-1]))
                bands, short = band_keys(signatures), signatures.astype(np.uint16)
                for k, i in enumerate(filled.tolist()):
                    unique = np.unique(codes[first[i] : first[i + 1]])
                    own[i] = {"digest": _digest(unique), "n": len(unique), "signature": short[k].tobytes(), "bands": bands[k]}
            rows += own
        yield pa.array(rows, type=ARROW_PRINT)


def _shingle_sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The sorted set of shingle hashes as bytes, and its digest."""
    cache: dict = {}
    kind = pa.struct([("digest", pa.binary()), ("codes", pa.binary())])
    for texts in batches:
        rows = []
        for _, found in chunks(texts.to_pylist(), cache):
            codes, first = shingles(found, WIDTH, SEED)
            for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
                unique = np.unique(codes[lo:hi])
                rows.append({"digest": _digest(unique) if hi > lo else None, "codes": unique.tobytes()})
        yield pa.array(rows, type=kind)


def fingerprint(text: Column) -> Column:
    """Marked as nondeterministic, as is the next, so that no filter on it is evaluated a second time."""
    return F.arrow_udf(_fingerprints, PRINT).asNondeterministic()(text)


def shingle_set(text: Column) -> Column:
    return F.arrow_udf(_shingle_sets, "struct<digest:binary,codes:binary>").asNondeterministic()(text)


def least_matches(threshold: float = float(THRESHOLD), tolerance: float = TOLERANCE) -> dict[int, int]:
    """Compared values -> fewest matches at which the threshold is still likely enough.

    With a uniform prior, m matches of n give a Beta(m + 1, n - m + 1) posterior, whose tail above the
    threshold is a sum of binomial terms.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        tail = 0.0
        for m in range(n + 2):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                out[n] = m
                break
    return out


def likely_links(left: np.ndarray, right: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rows that stay likely until all values are compared."""
    matches = np.zeros((len(left), len(right)), dtype=np.int16)
    for j in range(STEP):
        matches += left[:, j, None] == right[None, :, j]
    a, b = np.nonzero(matches >= least[STEP])
    same = matches[a, b]
    for n in range(2 * STEP, HASHES + 1, STEP):
        same = same + (left[a, n - STEP : n] == right[b, n - STEP : n]).sum(axis=1)
        keep = same >= least[n]
        a, b, same = a[keep], b[keep], same[keep]
    return a, b


def blocked(rows: DataFrame, size: str, key: str, block: int, spread: str) -> DataFrame:
    """Each row once for every pair of blocks (i, j) of its group that its own block is part of."""
    n = F.ceil(F.col(size) / block).cast("long")
    own = F.pmod(F.xxhash64(spread), n)
    return (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("other", size)
        .repartition(key, "i", "j")
        .sortWithinPartitions(key, "i", "j")
    )


def _sides(own: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    if i == j:
        return np.arange(len(own)), np.arange(len(own))
    return np.flatnonzero(own == i), np.flatnonzero(own == j)


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest (a, b) of the likely links of each pair of blocks."""
    least = least_matches()
    out: tuple[list, list] = ([], [])
    for group in runs(batches, ["key", "i", "j"]):
        if group.num_rows > 1:
            names = group.column("digest").to_pylist()
            values = np.frombuffer(b"".join(group.column("signature").to_pylist()), dtype=np.uint16).reshape(-1, HASHES)
            left, right = _sides(group.column("own").to_numpy(), group.column("i")[0].as_py(), group.column("j")[0].as_py())
            a, b = likely_links(values[left], values[right], least)
            for node, root in enumerate(roots(len(names), left[a], right[b]).tolist()):
                if node != root:
                    out[0].append(names[node])
                    out[1].append(names[root])
        if len(out[0]) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in out], ["a", "b"])
            out = ([], [])
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in out], ["a", "b"])


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, as products of 0/1 matrices."""
    counts = np.zeros((len(left), len(right)))
    sides = [(np.concatenate(x), np.repeat(np.arange(len(x)), [len(s) for s in x])) for x in (left, right)]
    common = np.intersect1d(sides[0][0], sides[1][0])
    for begin in range(0, len(common), COLUMNS_AT_ONCE):
        part = common[begin : begin + COLUMNS_AT_ONCE]
        matrices = []
        for (codes, owner), rows in zip(sides, (len(left), len(right))):
            at = np.minimum(np.searchsorted(part, codes), len(part) - 1)
            in_part = part[at] == codes
            matrix = np.zeros((rows, len(part)), dtype=np.float32)
            matrix[owner[in_part], at[in_part]] = 1
            matrices.append(matrix)
        counts += matrices[0] @ matrices[1].T
    return counts


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold: Fraction = THRESHOLD) -> np.ndarray:
    """Which pairs of sets reach the threshold, in whole numbers."""
    both = np.rint(shared(left, right)).astype(np.int64)
    union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :] - both
    return both * threshold.denominator >= union * threshold.numerator


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, root, links, copies): links of each member within a pair of blocks, and its tree."""
    for group in runs(batches, ["key", "i", "j"]):
        names = group.column("digest").to_pylist()
        single = sorted({name: k for k, name in reversed(list(enumerate(names)))}.values())
        group = group.take(single)
        names = [names[k] for k in single]
        sets = [np.frombuffer(x, dtype=np.uint64) for x in group.column("codes").to_pylist()]
        copies = group.column("copies").to_numpy()
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = _sides(group.column("own").to_numpy(), i, j)
        if not len(left) or not len(right):
            continue
        pairs = linked([sets[k] for k in left], [sets[k] for k in right])
        if i == j:
            np.fill_diagonal(pairs, False)
        a, b = np.nonzero(pairs)
        root = roots(len(names), left[a], right[b])
        texts = np.zeros(len(names), dtype=np.int64)
        docs = np.zeros(len(names), dtype=np.int64)
        texts[left] = pairs.sum(axis=1)
        docs[left] = pairs @ copies[right]
        if i != j:
            texts[right] = pairs.sum(axis=0)
            docs[right] = copies[left] @ pairs
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([names[r] for r in root], pa.binary()), pa.array(texts), pa.array(docs)],
            ["digest", "root", "texts", "docs"],
        )


def prints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, digest, n, signature, bands) of every row, written once."""
    found = docs.select(F.col(key), fingerprint(F.col(text).cast("string")).alias("p"))
    return written(found.select(key, "p.*"), "prints")


def candidates(nodes: DataFrame) -> DataFrame:
    """(digest, root, size): members of the groups of two or more that likely links tie together."""
    keys = nodes.select("digest", F.explode("bands").alias("key"))
    code = F.xxhash64("digest")
    buckets = keys.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(code).alias("members"))
    buckets = buckets.where("size > 1").groupBy("size", "members").agg(F.min("key").alias("key")).select("key", "size")
    members = keys.join(buckets.hint("merge"), "key").join(nodes.select("digest", "signature").hint("merge"), "digest")
    edges = blocked(members, "size", "key", BUCKET_BLOCK, "digest").mapInArrow(_bucket_links, "a binary, b binary")
    groups = written(components(edges).withColumnRenamed("node", "digest"), "groups")
    return groups.join(groups.groupBy("root").agg(F.count("*").alias("size")), "root")


def classes(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(digest, root, class_id, texts, docs) of every shingle set; class_id is the smallest key of its class."""
    nodes = found.where("digest is not null").groupBy("digest").agg(
        F.min(key).alias("rep"), F.count("*").alias("copies"), F.first("signature").alias("signature"), F.first("bands").alias("bands")
    )
    nodes = written(nodes, "nodes")
    groups = written(
        candidates(nodes).join(nodes.select("digest", "rep", "copies"), "digest").select("digest", "rep", "copies", "root", "size"), "members"
    )
    wanted = groups.select(F.col("rep").alias("want"), "digest", "copies", "size", F.xxhash64("root").alias("key"))
    texts = docs.select(F.col(key).alias("have"), F.col(text).cast("string").alias("body"))
    texts = texts.join(wanted.hint("merge"), F.col("have").eqNullSafe(F.col("want")))
    members = texts.select("digest", "copies", "size", "key", shingle_set(F.col("body")).alias("s"))
    members = members.where("s.digest = digest").select("digest", "copies", "size", "key", "s.codes")
    compared = blocked(members, "size", "key", GROUP_BLOCK, "digest").mapInArrow(_group_links, "digest binary, root binary, texts long, docs long")
    compared = written(compared, "compared")
    counts = compared.groupBy("digest").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    trees = components(compared.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    tree = F.coalesce("root", "digest")
    rows = nodes.select("digest", "rep", "copies").join(counts, "digest", "left").join(trees.withColumnRenamed("node", "digest"), "digest", "left")
    rows = rows.select("digest", "rep", "copies", "texts", "docs", tree.alias("root"))
    lowest = rows.groupBy("root").agg(F.min("rep").alias("class_id"))
    return rows.join(lowest, "root").select(
        "digest", "root", "class_id", F.coalesce("texts", F.lit(0)).cast("long").alias("texts"),
        (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).cast("long").alias("docs"),
    )


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, digest, class_root, class_id, n_links (other rows, copies included), n_text_links (other texts)."""
    found = prints(docs, key, text)
    found_classes = written(classes(docs, found, key, text), "classes")
    return found.select(key, "digest").join(found_classes, "digest", "left").select(
        F.col(key),
        F.col("digest"),
        F.col("root").alias("class_root"),
        F.when(F.col("digest").isNull(), F.col(key)).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("docs", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row per class: that of the smallest key. Rows without shingles all stay.

    Where keys are unique the losers are removed by key. Rows that share a key are told apart by digest.
    """
    rows = written(join(docs, key, text), "joined")
    rows = rows.withColumn("loser", F.col("digest").isNotNull() & ~F.col("class_id").eqNullSafe(F.col(key)))
    repeated = rows.groupBy(key).agg(F.count("*").alias("n"), F.max("loser").alias("loser"))
    gone = repeated.where("n > 1 or loser").select(F.col(key).alias("gone"))
    single = docs.join(gone.hint("merge"), F.col(key).eqNullSafe(F.col("gone")), "left_anti")
    shared_keys = repeated.where("n > 1").select(F.col(key).alias("gone"))
    several = docs.join(shared_keys, F.col(key).eqNullSafe(F.col("gone")), "left_semi")
    several = several.withColumn("__print", fingerprint(F.col(text).cast("string"))["digest"])
    winners = rows.where("not loser").select(F.col(key).alias("__key"), F.col("digest").alias("__digest"), "class_root").distinct()
    lowest = winners.groupBy("class_root").agg(F.min("__digest").alias("__digest"))
    winners = winners.join(lowest, "__digest", "left_semi")
    with_words = several.where("__print is not null").join(
        winners, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__print") == F.col("__digest")), "left_semi"
    )
    with_words = with_words.dropDuplicates(["__print"])
    without = several.where("__print is null")
    return single.unionByName(with_words.union(without).select(*docs.columns))
