"""Personal data by patterns and a skip-chain conditional random field.

Method: four patterns give the base spans (email, ip, card, phone). Candidates are the other tokens with an
at-sign, and the other runs of digit groups with seven digits, joined by blanks, dots, hyphens, brackets or up to
three such marks in a line. A part of a run whose digits repeat a base span, or a phone without its
country or area code, is a candidate of its own. Base spans and candidates of a text form a chain in text order; nodes that
repeat or resemble an earlier one (same digits, same last nine digits, same last seven digits of a phone, same address in any case)
get a skip link to the last such node, and each candidate to the nearest such base span before and after it, however far away. Node weights (shape of the token, the word before it), chain weights and the one
skip weight are learned by pseudo-likelihood on a bounded sample of texts, whose base spans carry their
kind and whose candidates count as nothing. Loopy message passing with base spans held fixed gives each
candidate's probabilities, run until no message changes by more than ``STILL``, so a number written in another form takes the kind of its other mentions.
A candidate is added as a span if one kind's probability reaches ``SURE`` and a skip link supports it.
Base spans always stay.

All texts of a batch run through message passing together, in arrays; links are linear in the tokens.

Defined results: null and empty texts have no span; texts without a digit or an at-sign are not
searched further; repeated rows are judged each by itself; without a sample the base spans remain.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.llm.spans import cut

KINDS = ["email", "ip", "card", "phone"]
LABELS = 1 + len(KINDS)
SAMPLE = 3_000
SEED = 13
SURE = 0.9
STILL = 1e-4
SLOWER_AFTER = 400
STEPS = 300
PENALTY = 1e-3
SKIP_PRIOR, SKIP_PENALTY = 5.0, 0.05
LEAST_DIGITS = 7
TAIL = 9
PHONE_TAIL, PHONE_MOST = 7, 15
MOST_DIGITS = 19
TEXTS_AT_ONCE = 500

ANY = re.compile(r"[0-9@]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TOKEN = re.compile(r"[^\s]++")
RUN = re.compile(r"[0-9]++(?:(?:(?:[^\w\n\r]|_){1,3}|[^\s0-9@]{1,3})[0-9]++)*+")
GROUP = re.compile(r"[0-9]++")
NOT_DIGIT = re.compile(r"[^0-9]+")
EDGES = ".,;:!?()[]{}<>\"'*#$%&|="
HINTS = re.compile(r"phone|tel|call|mobile|card|visa|credit|mail|address|contact|server|host|fax|token|key|password|id", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Each at-sign's whole run of local characters before it, and the domain behind it; linear in the text."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        after = at + 1
        if start < at:
            match = DOMAIN.match(text, at)
            if match:
                out.append((start, match.end()))
                after = match.end()
                done = after
        done = max(done, at + 1)
        at = text.find("@", after)
    return out


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points: by kind, then start."""
    if not text or not ANY.search(text):
        return []
    out = [(0, s, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group()) if m.end() - m.start() <= 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def rendered(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def phone_suffixes(digits: str) -> list[str]:
    """A phone's digits, and what is left of them without leading codes."""
    return [digits[i:] for i in range(len(digits) - PHONE_TAIL + 1)]


class Known:
    """Digits of the base spans of a text, by which parts of digit runs are found again."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        self.tails, self.nine, self.whole = set(), set(), set()
        for kind, start, end in base:
            digits = NOT_DIGIT.sub("", text[start:end])
            if kind and len(digits) >= LEAST_DIGITS:
                self.tails.add(digits[-PHONE_TAIL:])
                self.whole.update(phone_suffixes(digits) if KINDS[kind] == "phone" else [digits])
                if len(digits) >= TAIL:
                    self.nine.add(digits[-TAIL:])

    def repeats(self, digits: str) -> bool:
        """The digits of a base span, or the end of a phone; with no, one or two zeros before them."""
        return any(digits[:zeros] == "0" * zeros and digits[zeros:] in self.whole for zeros in (0, 1, 2))


def mentions(text: str, groups: list[tuple[int, int]], known: Known) -> list[tuple[int, int]]:
    """Parts of a run of digit groups, as (first, end) group, that repeat a base span; in order, without overlap.

    For each last group the longest part that repeats one whole, else the shortest with its last nine digits; then
    groups before it that are joined without a blank or a comma.
    """
    ends, digits = [], "".join(text[s:e] for s, e in groups)
    for s, e in groups:
        ends.append((ends[-1] if ends else 0) + e - s)
    begins = [0, *ends[:-1]]
    out, free = [], 0
    for last, end in enumerate(ends):
        if end < LEAST_DIGITS or digits[end - PHONE_TAIL : end] not in known.tails:
            continue
        first = nine = None
        at = last
        while at >= free and end - begins[at] <= MOST_DIGITS:
            part = digits[begins[at] : end]
            if known.repeats(part):
                first = at
            elif nine is None and len(part) >= TAIL and part[-TAIL:] in known.nine:
                nine = at
            at -= 1
        first = nine if first is None else first
        if first is None:
            continue
        while first > free and end - begins[first - 1] <= MOST_DIGITS and not re.search(r"[\s,;]", text[groups[first - 1][1] : groups[first][0]]):
            first -= 1
        out.append((first, last + 1))
        free = last + 1
    return out


def pieces(text: str, groups: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The candidates of groups that repeat nothing: all as one if that can be one number, else those without blanks."""
    if not groups:
        return []
    if sum(e - s for s, e in groups) <= MOST_DIGITS:
        parts = [groups]
    else:
        parts = [[groups[0]]]
        for before, group in zip(groups, groups[1:]):
            if re.search(r"\s", text[before[1] : group[0]]):
                parts.append([])
            parts[-1].append(group)
    return [(part[0][0], part[-1][1]) for part in parts if sum(e - s for s, e in part) >= LEAST_DIGITS]


def nodes_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(label, start, end) in text order: base spans (kind + 1), and candidates outside them (0)."""
    taken = sorted((s, e, k + 1) for k, s, e in base)
    out, cover, last = [], [], -1
    for s, e, k in taken:
        if s >= last:
            out.append((k, s, e))
            cover.append([s, e])
            last = e
        elif e > cover[-1][1]:
            cover[-1][1] = e
    found = []
    if "@" in text:
        at = 0
        for m in TOKEN.finditer(text):
            token = m.group()
            if "@" not in token:
                continue
            s = m.start() + len(token) - len(token.lstrip(EDGES))
            e = m.end() - (len(token) - len(token.rstrip(EDGES)))
            while at < len(cover) and cover[at][1] <= s:
                at += 1
            if e > s and not (at < len(cover) and cover[at][0] < e) and "@" in text[s:e]:
                found.append((s, e))
    out += [(0, s, e) for s, e in found]
    cover = sorted([*map(tuple, cover), *found])
    known, at = Known(text, base), 0
    for m in RUN.finditer(text):
        runs, split = [[]], False
        for g in GROUP.finditer(text, m.start(), m.end()):
            while at < len(cover) and cover[at][1] <= g.start():
                at += 1
                split = True
            if at < len(cover) and cover[at][0] < g.end():
                split = True
                continue
            if split:
                runs.append([])
                split = False
            runs[-1].append(g.span())
        for groups in runs:
            done = 0
            for first, end in mentions(text, groups, known):
                out += [(0, s, e) for s, e in pieces(text, groups[done:first])]
                s, e = groups[first][0], groups[end - 1][1]
                floor = max(groups[first - 1][1] if first else 0, cover[at - 1][1] if at else 0)
                if s > floor and text[s - 1] == "(" and ")" in text[s:e]:
                    s -= 1
                if s > floor and text[s - 1] == "+":
                    s -= 1
                out.append((0, s, e))
                done = end
            out += [(0, s, e) for s, e in pieces(text, groups[done:])]
    return sorted(out, key=lambda x: x[1])


def shape(text: str, start: int, end: int) -> list[float]:
    body = text[start:end]
    digits = NOT_DIGIT.sub("", body)
    n = len(digits)
    letters = any(c.isalpha() for c in body[:200]) or text[max(0, start - 1) : start].isalpha() or text[end : end + 1].isalpha()
    return [
        1.0, float("@" in body), float(body.startswith("+")), float(13 <= n <= 19), float(9 <= n <= 15), float(body.count(".") == 3),
        float(n == len(body)), float(letters), float(" " in body or "-" in body), float(n > 19),
        float(13 <= n <= 19 and luhn(digits)), float(bool(HINTS.search(text, max(0, start - 24), start))),
    ]


FEATURES = 12


def keys_of(body: str, label: int = 0) -> list[str]:
    """What two mentions of the same thing share."""
    if "@" in body:
        return ["a" + body.lower()]
    digits = NOT_DIGIT.sub("", body)
    keys = ["d" + digits]
    if len(digits) >= TAIL:
        keys.append("t" + digits[-TAIL:])
    if label == 1 + KINDS.index("phone") or label == 0 and PHONE_TAIL <= len(digits) <= PHONE_MOST:
        keys.append("n" + digits[-PHONE_TAIL:])
    return keys


class Graph:
    """Nodes and links of many texts: x, fixed labels, chain links and skip links (pairs of node numbers)."""

    def __init__(self, texts: list[str], base: list[list[tuple[int, int, int]]]):
        self.owner, self.spans, labels, x, chain, skip = [], [], [], [], [], []
        for i, (text, spans) in enumerate(zip(texts, base)):
            if not text or not ANY.search(text):
                continue
            first, last_with, last_base, next_base, keys, pairs = len(labels), {}, {}, {}, [], {}
            for label, start, end in nodes_of(text, spans):
                k = len(labels)
                self.owner.append(i)
                self.spans.append((start, end))
                labels.append(label)
                x.append(shape(text, start, end))
                if k > first:
                    chain.append((k - 1, k))
                keys.append(keys_of(text[start:end], label))
                for key in keys[-1]:
                    for known in (last_with, last_base) if label == 0 else (last_with,):
                        if key in known:
                            pairs[known[key], k] = None
                    last_with[key] = k
                    if label:
                        last_base[key] = k
            for k in range(len(labels) - 1, first - 1, -1):
                for key in keys[k - first]:
                    if labels[k]:
                        next_base[key] = k
                    elif key in next_base:
                        pairs[k, next_base[key]] = None
            skip += pairs
        self.labels = np.array(labels, dtype=np.int64)
        self.x = np.array(x, dtype=float).reshape(-1, FEATURES)
        self.chain = np.array(chain, dtype=np.int64).reshape(-1, 2)
        self.skip = np.array(skip, dtype=np.int64).reshape(-1, 2)


class Field:
    """Weights of the nodes, of neighbours in the chain, and of equal labels at the ends of a skip link.

    Texts rarely repeat an entity in two forms, so the skip weight has a prior it is drawn to.
    """

    def __init__(self):
        self.node = np.zeros((FEATURES, LABELS))
        self.chain = np.zeros((LABELS, LABELS))
        self.skip = SKIP_PRIOR

    def fit(self, graph: Graph) -> Field:
        """Pseudo-likelihood: each node given its neighbours' labels, by gradient steps with momentum.

        Candidates tied to a base span by a skip link are no evidence against its kind and are left out.
        """
        y = graph.labels
        if not len(y):
            return self
        one = np.eye(LABELS)[y]
        use = np.ones(len(y), dtype=bool)
        for a, b in graph.skip:
            if y[a] != y[b]:
                use[a if y[a] == 0 else b] = False
        before, after, tied = np.zeros((len(y), LABELS)), np.zeros((len(y), LABELS)), np.zeros((len(y), LABELS))
        before[graph.chain[:, 1]] = one[graph.chain[:, 0]]
        after[graph.chain[:, 0]] = one[graph.chain[:, 1]]
        for here, there in ((0, 1), (1, 0)):
            np.add.at(tied, graph.skip[:, here], one[graph.skip[:, there]])
        speed = [np.zeros_like(self.node), np.zeros_like(self.chain), 0.0]
        for _ in range(STEPS):
            logits = graph.x @ self.node + before @ self.chain + after @ self.chain.T + self.skip * tied
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (one - p / p.sum(axis=1, keepdims=True)) * use[:, None] / use.sum()
            steps = [graph.x.T @ error - PENALTY * self.node, before.T @ error + (after.T @ error).T - PENALTY * self.chain, float((tied * error).sum()) - SKIP_PENALTY * (self.skip - SKIP_PRIOR)]
            speed = [0.9 * v + 0.5 * g for v, g in zip(speed, steps)]
            self.node, self.chain, self.skip = self.node + speed[0], self.chain + speed[1], self.skip + speed[2]
        return self

    def probabilities(self, graph: Graph) -> np.ndarray:
        """Sum-product messages along all links at once, in each text until they stop changing; base spans stay fixed.

        Messages that swing move by half as much after every ``SLOWER_AFTER`` rounds, so each text comes to rest.
        """
        local = graph.x @ self.node
        fixed = graph.labels > 0
        local[fixed] = -50.0
        local[fixed, graph.labels[fixed]] = 50.0
        links = np.concatenate([graph.chain, graph.skip])
        pair = np.concatenate(
            [np.repeat(self.chain[None], len(graph.chain), axis=0), np.repeat(self.skip * np.eye(LABELS)[None], len(graph.skip), axis=0)]
        )
        source = np.concatenate([links[:, 0], links[:, 1]])
        target = np.concatenate([links[:, 1], links[:, 0]])
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
        owner = np.array(graph.owner, dtype=np.int64)[source]
        message = np.zeros((len(source), LABELS))
        belief = local.copy()
        active, rounds = np.flatnonzero(~fixed[target]), 0
        while len(active):
            cavity = belief[source[active]] - message[back[active]]
            new = np.logaddexp.reduce(cavity[:, :, None] + pair[active], axis=1)
            new -= new.max(axis=1, keepdims=True)
            step = (new - message[active]) * 0.5 ** (1 + rounds // SLOWER_AFTER)
            message[active] += step
            np.add.at(belief, target[active], step)
            moving = np.zeros(1 + owner.max(), dtype=bool)
            moving[owner[active[np.abs(step).max(axis=1) > STILL]]] = True
            active = active[moving[owner[active]]]
            rounds += 1
        p = np.exp(belief - belief.max(axis=1, keepdims=True)) if len(belief) else belief
        return p / p.sum(axis=1, keepdims=True) if len(p) else p


def find(texts: list, field: Field | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    every = [list(b) for b in base]
    if field is not None:
        graph = Graph(texts, base)
        if len(graph.skip):
            p = field.probabilities(graph)
            kind = p.argmax(axis=1)
            supported = np.zeros(len(kind), dtype=bool)
            for here, there in ((0, 1), (1, 0)):
                same = kind[graph.skip[:, here]] == kind[graph.skip[:, there]]
                supported[graph.skip[same, here]] = True
            added = (graph.labels == 0) & (kind > 0) & (p.max(axis=1) >= SURE) & supported
            for k in np.flatnonzero(added).tolist():
                start, end = graph.spans[k]
                every[graph.owner[k]].append((int(kind[k]) - 1, start, end))
    return list(zip(base, every))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Field:
    """Fits the field on about SAMPLE texts that hold a digit or an at-sign, chosen by a hash of the key."""
    rows = docs.where(F.col(text).rlike("[0-9@]")).select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    chance = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    found = rows.where(chance < SAMPLE / max(1, docs.count())).limit(4 * SAMPLE).collect()
    texts = sorted(r["text"] for r in found)
    return Field().fit(Graph(texts, [base_spans(t) for t in texts]))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
FOUND = pa.struct([(k, pa.int64()) for k in KINDS] + [("base", pa.string()), ("spans", pa.list_(SPAN))])
FOUND_TYPE = ", ".join(f"{k} long" for k in KINDS) + ", base string, spans array<struct<kind:string,start:int,end:int>>"


def personal_data(text: Column, field: Field | None) -> Column:
    """Struct: number of base spans of each kind, base spans as text, and all spans by kind and start."""

    @F.arrow_udf(FOUND_TYPE)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows, texts = [], batch.to_pylist()
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                for base, every in find(texts[at : at + TEXTS_AT_ONCE], field):
                    row = {kind: sum(k == i for k, _, _ in base) for i, kind in enumerate(KINDS)}
                    row["base"] = rendered(base)
                    row["spans"] = [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(every)]
                    rows.append(row)
            yield pa.array(rows, type=FOUND)

    return found(text.cast("string"))


def redacted(text: Column, field: Field | None) -> Column:
    """The text with its spans replaced, cut by the worker that finds them."""

    @F.arrow_udf("string")
    def hidden(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out, texts = [], batch.to_pylist()
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                part = texts[at : at + TEXTS_AT_ONCE]
                for own, (_, every) in zip(part, find(part, field)):
                    out.append(cut(own, [{"start": s, "end": e, "name": f"<{KINDS[k]}>"} for k, s, e in every]))
            yield pa.array(out, type=pa.string())

    return hidden(text.cast("string"))


def scan(docs: DataFrame, field: Field | None, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with a struct column ``into``."""
    return docs.withColumn(into, personal_data(F.col(text), field))


def digest(scanned: DataFrame) -> DataFrame:
    """Per document: base spans of each kind, their digest, and all spans as text."""
    span = F.transform("pii.spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return scanned.select(
        "doc_id", *[F.col(f"pii.{k}").alias(f"n_{k}") for k in KINDS], F.sha2(F.col("pii.base"), 256).alias("base_sha256"), F.array_join(span, ",").alias("spans")
    )


def redact(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets; overlapping spans become one."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    left = rows.select("row", redacted(F.col(f"row.`{text}`"), field).alias("left"))
    return left.select(*[F.col("left").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
