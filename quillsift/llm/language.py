"""Language identification with a byte convolutional network, trained here in numpy.

Method: a text's UTF-8 bytes are cut into windows of ``LENGTH`` bytes, each byte has a learned vector,
filters of two, three and four bytes slide over it, each filter keeps its largest answer in the window,
and a softmax over these gives the languages. A text's probabilities are the mean over all its windows,
weighted by their bytes, so whole texts are read and the work per byte is constant.

Training data is bounded: about ``PER_LANGUAGE`` documents of each language, chosen by a hash of their
id, and at most ``WINDOWS`` windows of each. The network is a few thousand numbers, sent to the tasks.

Defined results: null, empty and letterless texts are "und" with score 0; rows without language don't
train; repeated rows are judged alike; an empty table gives an empty result; without any row to train
on every text is "und" with score 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
VECTOR = 8
PER_LANGUAGE = 400
WINDOWS = 3
EPOCHS = 12
BATCH = 64
RATE = 0.01
SEED = 7
WINDOWS_AT_ONCE = 256
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def windows_of(raw: bytes) -> list[bytes]:
    return [raw[i : i + LENGTH] for i in range(0, len(raw), LENGTH)]


def as_matrix(parts: list[bytes]) -> np.ndarray:
    """(windows, LENGTH) byte codes, short windows filled with 0."""
    return np.frombuffer(b"".join(p.ljust(LENGTH, b"\0") for p in parts), dtype=np.uint8).reshape(-1, LENGTH)


class Network:
    """Weights: vectors of the 256 bytes, one matrix with all filters (narrow ones end in zeros), softmax."""

    def __init__(self, labels: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.labels = labels
        widest = max(WIDTHS)
        self.vectors = rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32)
        self.vectors[0] = 0
        self.mask = np.zeros((widest * VECTOR, len(WIDTHS) * FILTERS), dtype=np.float32)
        for k, width in enumerate(WIDTHS):
            self.mask[: width * VECTOR, k * FILTERS : (k + 1) * FILTERS] = 1
        self.filters = (rng.normal(0, 0.3, self.mask.shape) * self.mask).astype(np.float32)
        self.shift = np.zeros(self.mask.shape[1], dtype=np.float32)
        self.out = rng.normal(0, 0.1, (self.mask.shape[1], len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), dtype=np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.shift, self.out, self.bias]

    def stretches(self, codes: np.ndarray) -> np.ndarray:
        """(windows, positions, widest * VECTOR): the vectors under the filters at each position."""
        known = np.zeros((len(codes), LENGTH + max(WIDTHS) - 1, VECTOR), dtype=np.float32)
        known[:, :LENGTH] = self.vectors[codes]
        return np.lib.stride_tricks.as_strided(
            known, (len(codes), LENGTH, max(WIDTHS) * VECTOR), (known.strides[0], known.strides[1], known.itemsize), writeable=False
        )

    def answers(self, seen: np.ndarray) -> np.ndarray:
        return (np.ascontiguousarray(seen).reshape(-1, seen.shape[2]) @ self.filters).reshape(len(seen), LENGTH, -1)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        best = self.answers(self.stretches(codes)).max(axis=1)
        return softmax(np.maximum(best + self.shift, 0) @ self.out + self.bias)

    def gradients(self, codes: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
        """Of the cross-entropy; only the position of each filter's largest answer has a part in it."""
        seen = self.stretches(codes)
        answers = self.answers(seen)
        where = answers.argmax(axis=1)
        n = np.arange(len(codes))[:, None]
        raw = answers[n, where, np.arange(answers.shape[2])[None, :]] + self.shift
        kept = np.maximum(raw, 0)
        error = softmax(kept @ self.out + self.bias)
        error[np.arange(len(codes)), truth] -= 1
        error /= len(codes)
        back = (error @ self.out.T) * (raw > 0)
        under = seen[n, where]
        d_filters = np.einsum("nfk,nf->kf", under, back) * self.mask
        widest = max(WIDTHS)
        d_under = back[:, :, None] * (self.filters * self.mask).T[None]
        at = where[:, :, None] + np.arange(widest)
        bytes_there = np.where(at < LENGTH, np.take_along_axis(codes[:, None, :], np.minimum(at, LENGTH - 1), axis=2), 0)
        d_vectors = np.zeros_like(self.vectors)
        np.add.at(d_vectors, bytes_there.ravel(), d_under.reshape(-1, VECTOR))
        d_vectors[0] = 0
        return [d_vectors, d_filters, back.sum(axis=0), kept.T @ error, error.sum(axis=0)]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(windows: list[tuple[bytes, str]], seed: int = SEED) -> Network | None:
    """Adam on shuffled batches; languages weigh alike. The same rows in the same order give the same network."""
    labels = sorted({label for _, label in windows})
    if not labels:
        return None
    net = Network(labels, seed)
    codes = as_matrix([w for w, _ in windows])
    truth = np.array([labels.index(label) for _, label in windows])
    chance = (1 / np.bincount(truth, minlength=len(labels)))[truth]
    chance /= chance.sum()
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    steps = max(20, EPOCHS * len(windows) // BATCH)
    for step in range(1, steps + 1):
        pick = rng.choice(len(windows), BATCH, p=chance)
        rate = RATE * (1 - step / (steps + 1))
        for w, g, m, v in zip(net.weights(), net.gradients(codes[pick], truth[pick]), first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def training_windows(rows: DataFrame, key: str, text: str, lang: str) -> list[tuple[bytes, str]]:
    """A bounded sample: windows of about PER_LANGUAGE documents of each language, by a hash of the key."""
    known = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = known.groupBy(F.col(lang).alias("of")).agg(F.count("*").alias("n"))
    chance = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    picked = known.join(F.broadcast(sizes), F.col(lang) == F.col("of")).where(chance < PER_LANGUAGE / F.col("n"))
    room = F.greatest(F.length(text) - LENGTH, F.lit(0)) + 1
    starts = [F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(k)), room).cast("int") + 1 for k in range(WINDOWS)]
    parts = F.array_distinct(F.array(*[F.substring(F.col(text), s, F.lit(LENGTH)) for s in starts]))
    found = picked.select(F.col(lang).alias("of"), F.explode(parts).alias("part")).distinct().collect()
    pairs = [(r["part"].encode("utf-8", "surrogatepass")[:LENGTH], r["of"]) for r in found if LETTER.search(r["part"])]
    return sorted(pairs)


def train(rows: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    return fit(training_windows(rows, key, text, lang))


def predict(texts: list, net: Network | None) -> list[tuple[str, float]]:
    """(language, mean probability) of each text; windows of several texts go through together."""
    parts: list[bytes] = []
    owner: list[int] = []
    for i, text in enumerate(texts):
        if net is not None and text and LETTER.search(text):
            own = windows_of(text.encode("utf-8", "surrogatepass"))
            parts += own
            owner += [i] * len(own)
    out = [(UNKNOWN, 0.0)] * len(texts)
    if not parts:
        return out
    chances = np.concatenate(
        [net.probabilities(as_matrix(parts[k : k + WINDOWS_AT_ONCE])) for k in range(0, len(parts), WINDOWS_AT_ONCE)]
    )
    share = np.array([len(p) for p in parts], dtype=np.float64)
    owners = np.array(owner)
    total = np.bincount(owners, share, len(texts))
    means = np.stack([np.bincount(owners, share * chances[:, k], len(texts)) for k in range(len(net.labels))], axis=1)
    for i in np.unique(owners).tolist():
        mean = means[i] / total[i]
        best = int(mean.argmax())
        out[i] = (net.labels[best], float(min(1.0, mean[best])))
    return out


def language(text: Column, net: Network | None) -> Column:
    """Struct (lang, score) of each whole text; the network is small and travels with the function."""

    @F.arrow_udf("lang string, score double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])
        for texts in batches:
            rows = []
            values = texts.to_pylist()
            for k in range(0, len(values), 200):
                rows += [{"lang": a, "score": s} for a, s in predict(values[k : k + 200], net)]
            yield pa.array(rows, type=kind)

    return scored(text.cast("string"))


def identify(docs: DataFrame, net: Network | None, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into`` of lang and score."""
    return docs.withColumn(into, language(F.col(text), net))


def keep_known(docs: DataFrame, net: Network | None, least: float = 0.35, text: str = "text") -> DataFrame:
    """``docs`` without texts of unknown language or a score below ``least``."""
    scored = identify(docs.select(F.struct(*docs.columns).alias("row")), net, f"row.`{text}`")
    return scored.where(f"language.lang <> '{UNKNOWN}' and language.score >= {least}").select("row.*")
