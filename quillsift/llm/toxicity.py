"""Toxicity by a weighted finite-state pattern grammar over clauses.

Method: a lexicon transducer (a trie of learned stems and fixed function words) maps words to symbols.
Small transducers for negation, reported speech, target and threat are composed into one table that
reads a clause and gives each insult or threat the reading it has there: plain, aimed at somebody,
negated, reported, a threat, a threat against somebody. A stem's weight is the log of how much more
often toxic texts use it; a text's features are the summed weights of each reading, its matching clauses, its strongest
one and their density, and a logistic model fitted to labels turns them into a score. Clauses without an insult or a
threat can't score, so only clauses around a trie match are read word by word.

Learned from labels: the stems (whole words of any length, and prefixes of at least four letters, that toxic
texts use far more often; a stem of fewer letters counts as a whole word only) and the
logistic weights, on a bounded sample of ``MAX_LABELLED`` labelled documents chosen by a hash of their id.
The function words are fixed, and those of fewer than four letters are never stems.

Defined results: null and empty texts have no match and get the score of a text without one; labels
that are null or for unknown documents don't train; contradictory labels count as toxic; a document
without id never trains and is not held out; repeated rows score alike; without labels the score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.session import written

MAX_LABELLED = 12_000
SEED = 5
STEMS = (4, 5, 6, 7, 8, 9)
LEAST_DOCS = 6
LEAST_RATIO = 2.0
EXPLAINED = 2
ALL_WORDS = ""
SCOPE = 3
WORDS = {
    "t": "you your he she they them him her du dein sie ihr er tu vous il elle ils toi tú usted él ella ellos vosotros",
    "n": "not no never nor without nicht kein keine nie ohne pas jamais sans ne nunca sin ni",
    "q": "said says say wrote claims called quoted sagte sagt schrieb dit disait écrit dijo dice escribió",
    "h": "kill hurt beat destroy burn shoot stab töten schlagen verbrennen tuer frapper brûler matar golpear quemar",
}
SHORT_FIXED = {word for words in WORDS.values() for word in words.split() if len(word) < STEMS[0]}
READINGS = ["plain", "aimed", "negated", "reported", "threat", "threat_aimed"]
CLAUSE = re.compile(r"[.!?;:\n]+")
LETTERS = re.compile(r"[^\W\d_]+")
WORD = re.compile(r"[^\W_]+|[\"“”„«»]")
QUOTES = set('"“”„«»')
PER_WORDS = 100.0


def transducer(symbols: str, start, step) -> dict:
    """Table (state, symbol) -> (state, output) of the states reached from ``start`` by ``step``."""
    table, open_states = {}, [start]
    while open_states:
        state = open_states.pop()
        for symbol in symbols:
            table[state, symbol] = step(state, symbol)
            after = table[state, symbol][0]
            if (after, symbols[0]) not in table and after not in open_states:
                open_states.append(after)
    return table


def composed(first: dict, second: dict, start: tuple, symbols: str) -> dict:
    """The transducer that feeds the outputs of ``first`` to ``second``."""

    def step(state, symbol):
        a, between = first[state[0], symbol]
        b, out = second[state[1], between]
        return (a, b), out

    return transducer(symbols, start, step)


def _negation(state: int, symbol: str):
    if symbol == "n":
        return SCOPE, "w"
    return max(0, state - 1), "N" if symbol == "i" and state else symbol


def _reported(state: int, symbol: str):
    if symbol == "q":
        return 1, "w"
    return state, "R" if symbol in "iN" and state else symbol


def _aimed(state: tuple, symbol: str):
    """state: a target was seen, an insult or threat before it waits for one."""
    seen, waits = state
    if symbol == "t":
        return (True, ""), {"i": "I", "h": "H"}.get(waits, "w")
    if symbol in "ih" and symbol:
        return (seen, "" if seen else symbol), (symbol.upper() if seen else symbol)
    return state, symbol


def grammar() -> tuple[dict, tuple]:
    """The composed table over w t n q i h, and its start. Outputs: i I N R h H as in ``READINGS``, or w.

    An insult whose target follows is given out plain first and as aimed when the target comes.
    """
    negation, reported = transducer("wtnqih", 0, _negation), transducer("wtqihN", 0, _reported)
    aimed = transducer("wtihNR", (False, ""), _aimed)
    both = composed(negation, reported, (0, 0), "wtnqih")
    start = ((0, 0), (False, ""))
    return composed(both, aimed, start, "wtnqih"), start


OUTPUTS = {"i": 0, "I": 1, "N": 2, "R": 3, "h": 4, "H": 5}


def alone(text: str, start: int, end: int) -> bool:
    """Is this part of the text a whole word?"""
    return not (start and text[start - 1].isalnum()) and not text[end : end + 1].isalnum()


class Lexicon:
    """Trie of stems with weights, and the fixed words; ``symbol`` maps a word to (symbol, weight)."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.fixed = {word: symbol for symbol, words in WORDS.items() for word in words.split()}
        self.longest = max([0, *map(len, stems)])
        self.table, self.start = grammar()

    def trie(self):
        """Finds texts with a stem or threat at all; rebuilt by each worker."""
        trie = ahocorasick.Automaton()
        for word in [*self.stems, *WORDS["h"].split()]:
            trie.add_word(word, len(word))
        trie.make_automaton()
        return trie

    def symbol(self, word: str) -> tuple[str, float]:
        for n in range(min(len(word), self.longest), 0, -1):
            weight = self.stems.get(word[:n])
            if weight is not None and (n >= STEMS[0] or n == len(word)):
                return "i", weight
        if word in QUOTES:
            return "q", 0.0
        return self.fixed.get(word, "w"), 1.0

    def clause(self, words: list[str]) -> np.ndarray:
        """Summed weights of each reading in one clause."""
        sums = np.zeros(len(READINGS))
        # ``waiting`` are the weights of the last plain insult and threat: a target behind them moves its own match's.
        state, waiting = self.start, {"i": 0.0, "h": 0.0}
        for word in words:
            symbol, weight = self.symbol(word)
            state, out = self.table[state, symbol]
            if out in OUTPUTS:
                if symbol == "t":
                    weight = waiting[out.lower()]
                    sums[OUTPUTS[out.lower()]] -= weight
                elif out in waiting:
                    waiting[out] = weight
                sums[OUTPUTS[out]] += weight
        return sums

    def features(self, text: str | None, trie) -> list[float]:
        """Logs of the weights of each reading, of matching clauses and of the weight per 100 words, and the strongest clause."""
        sums, clauses, most = np.zeros(len(READINGS)), 0, 0.0
        lowered = (text or "").lower()
        hits = [end for end, n in trie.iter(lowered) if n >= STEMS[0] or alone(lowered, end + 1 - n, end + 1)] if len(trie) else []
        if hits:
            at = 0
            borders = [0, *[m.end() for m in CLAUSE.finditer(lowered)], len(lowered)]
            for begin, end in zip(borders, borders[1:]):
                while at < len(hits) and hits[at] < begin:
                    at += 1
                if at < len(hits) and hits[at] < end:
                    own = self.clause(WORD.findall(lowered, begin, end))
                    if own.any():
                        sums += own
                        clauses += 1
                        most = max(most, float(own.sum()))
        density = PER_WORDS * float(sums.sum()) / max(1, lowered.count(" ")) if hits else 0.0
        return [*np.log1p(np.maximum(sums, 0)).tolist(), math.log1p(clauses), most, math.log1p(max(0.0, density))]


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scale, weights, bias as last weight's column) by damped Newton steps on scaled features."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    a = np.hstack([x / scale, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) / len(y) + penalty * w
        hessian = (a * (p * (1 - p))[:, None]).T @ a / len(y) + penalty * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return scale, w[:-1], w[-1:]


class Model:
    def __init__(self, lexicon: Lexicon, scale: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.lexicon, self.scale, self.weights, self.bias = lexicon, scale, weights, bias

    def scores(self, texts: list, trie) -> np.ndarray:
        x = np.array([self.lexicon.features(t, trie) for t in texts]).reshape(len(texts), -1)
        return 1 / (1 + np.exp(-np.clip((x / self.scale) @ self.weights + self.bias[0], -30, 30)))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, toxic) of at most about MAX_LABELLED labelled documents, chosen by a hash of the key."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("of")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    chance = F.pmod(F.xxhash64(F.col("of").cast("string"), F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    total = max(1, known.count())
    picked = known.where(chance < MAX_LABELLED / total)
    rows = docs.select(F.col(key).alias("have"), F.col(text).cast("string").alias("text"))
    rows = rows.join(F.broadcast(picked), F.col("have") == F.col("of"))
    return written(rows.select("text", "toxic").where("text is not null").repartition(8), "labelled")


def forms(word: str) -> list[str]:
    """The prefixes a stem can be, and the word itself unless it is a short function word."""
    return [word[:n] for n in STEMS if n < len(word)] + [word] * (word not in SHORT_FIXED)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, clean, toxic, docs): uses in clean and toxic texts, and toxic texts with it, summed per task."""
    uses: tuple[Counter, Counter] = (Counter(), Counter())
    docs: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            found = Counter(f for w in LETTERS.findall(text.lower()) for f in forms(w))
            found[ALL_WORDS] = sum(1 for _ in LETTERS.finditer(text))
            uses[int(toxic > 0)].update(found)
            if toxic > 0:
                docs.update(found.keys())
    names = sorted({*uses[0], *uses[1]})
    columns = [pa.array(names, pa.string())] + [pa.array([c[n] for n in names], pa.int64()) for c in (*uses, docs)]
    yield pa.RecordBatch.from_arrays(columns, ["stem", "clean", "toxic", "docs"])


def learn_stems(sample: DataFrame) -> dict[str, float]:
    """Stem -> log of how much more often toxic texts use it than clean ones, per word.

    Words of long or copied toxic texts are more frequent there too, so stems are taken one by one, each
    time the one with the largest product of that log and the number of toxic texts with it that do not
    have EXPLAINED uses of earlier stems, until fewer than LEAST_DOCS such texts are left for any. Then
    stems follow that are as typical as the weakest of these and as widespread as a quarter of their median.
    What reaches the driver is bounded by the sample.
    """
    counts = written(sample.mapInArrow(_counted, "stem string, clean long, toxic long, docs long"), "stems")
    counts = counts.groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("clean", "toxic", "docs")])
    whole = counts.where(F.col("stem") == ALL_WORDS).first()
    if whole is None or not whole["toxic"] or not whole["clean"]:
        return {}
    ratio = F.log((F.col("toxic") + 0.5) / whole["toxic"] / ((F.col("clean") + 0.5) / whole["clean"]))
    sure = counts.where(F.col("docs") >= LEAST_DOCS).withColumn("ratio", ratio).where((F.col("ratio") >= LEAST_RATIO) & (F.col("stem") != ALL_WORDS))
    weight = {r["stem"]: r["ratio"] for r in sure.select("stem", "ratio").collect()}

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted(Counter(f for w in LETTERS.findall(t.lower()) for f in forms(w) if f in weight).items()) for t in batch.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("stem", pa.string()), ("n", pa.int32())]))
            yield pa.RecordBatch.from_arrays([pa.array([[{"stem": f, "n": n} for f, n in row] for row in rows], kind)], ["used"])

    found = sample.where("toxic = 1").select("text").mapInArrow(used, "used array<struct<stem:string,n:int>>").collect()
    texts = [{u["stem"]: u["n"] for u in r["used"]} for r in found]
    with_stem: dict[str, set] = {}
    for k, row in enumerate(texts):
        for stem in row:
            with_stem.setdefault(stem, set()).add(k)
    explained = [0] * len(texts)
    left = {stem: set(rows) for stem, rows in with_stem.items()}
    stems: dict[str, float] = {}

    def related(stem: str) -> bool:
        return stem in stems or any(a.startswith(b) for s in stems for a, b in ((stem, s), (s, stem)) if len(b) >= STEMS[0])

    while left:
        best = max(left, key=lambda x: (len(left[x]) * weight[x], len(x), x))
        if len(left.pop(best)) < LEAST_DOCS:
            break
        stems[best] = weight[best]
        for k in with_stem[best]:
            explained[k] += texts[k][best]
        done = {k for k in with_stem[best] if explained[k] >= EXPLAINED}
        left = {stem: rows - done for stem, rows in left.items() if not related(stem)}
    if stems:
        spread = sorted(len(with_stem[x]) for x in stems)[len(stems) // 2] / 4
        weakest = min(stems.values())
        for stem in sorted(with_stem, key=lambda x: (-len(with_stem[x]) * weight[x], -len(x), x)):
            if weight[stem] >= weakest and len(with_stem[stem]) >= spread and not related(stem):
                stems[stem] = weight[stem]
    return stems


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    sample = labelled_sample(docs, labels, key, text)
    lexicon = Lexicon(learn_stems(sample))
    found = sample.select("toxic", features_of(F.col("text"), lexicon).alias("x"))
    rows = sorted((tuple(r["x"]), r["toxic"]) for r in found.collect())
    if not rows:
        return None
    return Model(lexicon, *fit_logistic(np.array([x for x, _ in rows]), np.array([float(y) for _, y in rows])))


def features_of(text: Column, lexicon: Lexicon) -> Column:
    """The lexicon is small and travels with the function."""

    @F.arrow_udf("array<double>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie = lexicon.trie()
        for texts in batches:
            yield pa.array([lexicon.features(t, trie) for t in texts.to_pylist()], pa.list_(pa.float64()))

    return found(text)


def toxicity(text: Column, model: Model | None) -> Column:
    """Score of each whole text."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie = model.lexicon.trie() if model else None
        for texts in batches:
            values = texts.to_pylist()
            yield pa.array(model.scores(values, trie) if trie is not None and values else np.zeros(len(values)), pa.float64())

    return scored(text.cast("string"))


def score(docs: DataFrame, model: Model | None, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``into``, 0 to 1."""
    return docs.withColumn(into, toxicity(F.col(text), model))
