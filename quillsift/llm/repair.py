"""Repair of the turn structure of conversations at the least cost, by branch and bound.

A repaired conversation is empty, or an optional system turn and then pairs of a user's and an assistant's
turn. Each row is kept, given the expected role, or deleted; empty turns may be inserted anywhere. Blank and
duplicate rows must go; a truncated row that stays costs extra. Among the cheapest edits the one whose
initials (D, I, K, R) come first in ASCII order is taken.

Method: a depth-first search with an explicit stack over (row, state of the grammar). Suffix bounds, from
a backward pass that leaves the audit out, tell the least cost from a row on in each state; branches are tried by bound,
then initial; the incumbent (cost, audit) cuts every branch that can't beat it, and a table per row and
state drops prefixes that reach it at no lower cost. As the initials of a row's edits end with its own, no
audit is a prefix of another, so the first complete path of least cost is the least audit, and an empty
stack proves it.

How it scales: all but the last step works on narrow rows (ids, turn, role, digest of the text). Equal
rows are counted before the shuffle. The rows are dealt by ranges of (conversation, turn, role, digest), so
a conversation of any length is cut into segments of at most ``SEGMENT`` rows; each is searched on its own
for every state it may be entered in, once the bounds of the segments behind it are known: those come from
four-by-four cost tables, one per segment, folded per conversation. Texts move three times: one copy per
distinct row, dealt by range to be joined into chunks of ``CHUNK`` characters, and chunks by conversation,
as one SHA-256 over a conversation must read them in order; it streams them. Each step reads written tables.

Defined results: null role, text, turn or conversation: a null turn comes first, a null role or text is one
space, rows of a null conversation form one; a row whose role is empty can't be kept as it is; rows of equal
turn are ordered by role, then SHA-256 of the text; an empty table gives an empty result; texts of any length are hashed
whole; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillsift.session import written

SEGMENT = 4_096
CHUNK = 1 << 20
OUT_ROWS = 256
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after the system turn, after a user's turn, after an assistant's turn.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Where the expected role leads, and that role.
NEXT = [USER, USER, ASSISTANT, USER]
EXPECTED = ["user", "user", "assistant", "user"]
#: Insertions that finish a conversation.
MISSING = [0, 2, 1, 0]
ENDS = [INSERT * n for n in MISSING]
FAR = 1 << 60

#: A row of a segment: initial of the role, whether it must go, whether it is truncated, copies.
Row = tuple[str, bool, bool, int]


def suffix_bounds(rows: list[Row], ahead: list[int]) -> list[list[int]]:
    """Least cost from each row on in each state, when ``ahead`` is the least cost after the last row."""
    bounds = [list(ahead)]
    for initial, must_go, late, copies in reversed(rows):
        behind = bounds[-1]
        rest, extra = DELETE * (copies - 1), TRUNCATED * late
        here = [DELETE + rest + behind[state] for state in range(4)]
        if not must_go:
            for state in range(4):
                here[state] = min(here[state], REROLE + extra + rest + behind[NEXT[state]])
                kept = MOVES.get((state, initial))
                if kept is not None:
                    here[state] = min(here[state], extra + rest + behind[kept])
            for _ in range(2):
                here = [min(here[state], INSERT + here[NEXT[state]]) for state in range(4)]
        bounds.append(here)
    return bounds[::-1]


def _branches(row: Row, at: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """(row, state, cost, initials) that one edit leads to; further copies of a row always go."""
    initial, must_go, late, copies = row
    rest, more, extra = DELETE * (copies - 1), "D" * (copies - 1), TRUNCATED * late
    yield at + 1, state, DELETE + rest, "D" + more
    if not must_go:
        yield at, NEXT[state], INSERT, "I"
        kept = MOVES.get((state, initial))
        if kept is not None:
            yield at + 1, kept, extra + rest, "K" + more
        yield at + 1, NEXT[state], REROLE + extra + rest, "R" + more


def search(rows: list[Row], ahead: list[int], entered: int) -> tuple[int, str, int]:
    """(least cost, its first audit in ASCII order, state at the end) of a segment entered in a state.

    The cost leaves out what ``ahead`` says of the rows behind the segment.
    """
    bounds = suffix_bounds(rows, ahead)
    reached: list[list[int]] = [[FAR] * 4 for _ in range(len(rows) + 1)]
    incumbent, best = FAR, (FAR, None, entered)
    stack: list[tuple] = [(0, entered, 0, None)]
    while stack:
        at, state, cost, path = stack.pop()
        if cost + bounds[at][state] >= incumbent or cost >= reached[at][state]:
            continue
        reached[at][state] = cost
        if at == len(rows):
            incumbent, best = cost + ahead[state], (cost, path, state)
            continue
        found = [(cost + step + bounds[to][s], letters, to, s, cost + step) for to, s, step, letters in _branches(rows[at], at, state)]
        for _, letters, to, s, total in sorted(found, reverse=True):
            stack.append((to, s, total, (path, letters)))
    cost, path, state = best
    parts = []
    while path is not None:
        path, letters = path
        parts.append(letters)
    return cost, "".join(reversed(parts)), state


def replay(rows: list[Row], audit: str, state: int) -> Iterator[tuple[int, str | None, list[str]]]:
    """(row, its new role or None for its own, roles inserted before it) of every row that stays."""
    letters, inserted = iter(audit), []
    for at, (initial, must_go, _, copies) in enumerate(rows):
        for letter in letters:
            if letter != "I":
                break
            inserted.append(EXPECTED[state])
            state = NEXT[state]
        if letter != "D":
            yield at, None if letter == "K" else EXPECTED[state], inserted
            state, inserted = MOVES[state, initial] if letter == "K" else NEXT[state], []
        for _ in range(copies - 1):
            next(letters)


def over(rows: DataFrame, work: Callable[[Iterator[dict]], Iterable[dict]], fields: str) -> DataFrame:
    """Rows as dicts, one at a time, through a generator per task; results leave in small batches."""
    schema = StructType.fromDDL(fields)
    arrow = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, size = [], 0
        for result in work(batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows)):
            done.append(result)
            size += len(result.get("lines") or "")
            if len(done) >= OUT_ROWS or size > CHUNK:
                yield pa.RecordBatch.from_pylist(done, arrow)
                done, size = [], 0
        if done:
            yield pa.RecordBatch.from_pylist(done, arrow)

    return rows.mapInArrow(task, schema)


def normal(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """(conv_id, turn, role, text, copies): nulls of role and text are one space."""
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    )


ORDER = ["conv_id", "turn", "role", "digest"]


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows of ``normal`` by digest, with copies, blank, first (no equal text and role before) and late."""
    marks = rows.select(
        "conv_id", "turn", "role", _digest().alias("digest"), "copies", (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("late"),
    )
    groups = written(marks.groupBy(*ORDER, "blank", "late").agg(F.sum("copies").alias("copies")), "turns")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = groups.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("earliest"))
    firsts = firsts.select(F.col("conv_id").alias("of"), F.col("role").alias("by"), F.col("digest").alias("what"), "earliest")
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (F.col("digest") == F.col("what"))
    return groups.join(firsts, same).select(*ORDER, "copies", "blank", "late", (turn == F.col("earliest")).alias("first"))


def counted(marked: DataFrame) -> DataFrame:
    """Per conversation: gaps and the rows of each fault."""
    alone = F.col("first") & ~F.col("blank")
    copies = F.col("copies")
    by_turn = marked.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), copies).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(copies - F.col("first").cast("long"))).alias("duplicate"),
        F.sum((alone & F.col("late")).cast("long")).alias("truncated"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    return by_turn.groupBy("conv_id").agg(gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


def _cost_table(rows: list[Row]) -> list[int]:
    """Least cost of a segment from each state to each state, by rows of four."""
    ends = [[0 if state == end else FAR for state in range(4)] for end in range(4)]
    by_end = [suffix_bounds(rows, ahead)[0] for ahead in ends]
    return [min(FAR, by_end[end][state]) for state in range(4) for end in range(4)]


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


ROWS = "array<struct<turn:bigint,role:string,digest:binary,go:boolean,late:boolean,copies:bigint>>"


def _plain(run: list[dict]) -> list[Row]:
    return [(r["role"][:1], r["go"], r["late"], r["copies"]) for r in run]


def segments(marked: DataFrame) -> DataFrame:
    """Runs of at most SEGMENT rows of one conversation, in order: (part, number), with their cost tables.

    Written, as the steps behind it read it again.
    """
    kind = marked.schema["conv_id"].dataType.simpleString()
    rows = marked.select(*ORDER, (F.col("blank") | ~F.col("first")).alias("go"), "late", "copies")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def packed(conv, number: int, run: list[dict]) -> dict:
        plain = _plain(run)
        initials = [row[0] for row in plain]
        again = sum(row[3] - 1 for row in plain)
        return {
            "conv_id": conv, "part": TaskContext.get().partitionId(), "number": number, "rows": run, "costs": _cost_table(plain),
            "head": initials[0], "tail": initials[-1], "illegal": _illegal(initials) + again,
        }

    def cut_up(rows: Iterator[dict]) -> Iterator[dict]:
        conv, run, number = None, [], 0
        for row in rows:
            own = row.pop("conv_id")
            if run and (own != conv or len(run) >= SEGMENT):
                yield packed(conv, number, run)
                run, number = [], number + 1
            conv = own
            run.append(row)
        if run:
            yield packed(conv, number, run)

    fields = f"conv_id {kind}, part int, number int, rows {ROWS}, costs array<bigint>, head string, tail string, illegal bigint"
    return written(over(dealt, cut_up, fields), "segments")


def bounded(cut: DataFrame) -> DataFrame:
    """(part, number) with the least cost behind a segment, by state, whether it is the first, and illegal pairs at its head.

    The cost tables of one conversation, 16 numbers for up to SEGMENT rows, are folded from its end.
    """
    parts = F.sort_array(F.collect_list(F.struct("part", "number", "costs", "head", "tail")))

    def folded(convs: Iterator[dict]) -> Iterator[dict]:
        for run in (conv["parts"] for conv in convs):
            ahead = list(ENDS)
            for i in range(len(run) - 1, -1, -1):
                seam = _illegal([run[i - 1]["tail"], run[i]["head"]]) if i else 0
                yield {"part": run[i]["part"], "number": run[i]["number"], "ahead": ahead, "first": i == 0, "seam": seam}
                costs = run[i]["costs"]
                ahead = [min(costs[4 * state + end] + ahead[end] for end in range(4)) for state in range(4)]

    return over(cut.groupBy("conv_id").agg(parts.alias("parts")), folded, "part int, number int, ahead array<bigint>, first boolean, seam bigint")


def searched(cut: DataFrame) -> DataFrame:
    """Segments with ``options``: cost, audit and last state for each state they may be entered in (START alone for the first)."""
    kind = cut.schema["conv_id"].dataType.simpleString()
    joined = cut.select("conv_id", "part", "number", "rows", "illegal").join(bounded(cut), ["part", "number"])

    def best(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            plain, ahead = _plain(part["rows"]), part.pop("ahead")
            found = [search(plain, ahead, state) for state in ([START] if part.pop("first") else range(4))]
            yield part | {"options": [dict(zip(("cost", "audit", "leave"), one)) for one in found]}

    fields = f"conv_id {kind}, part int, number int, rows {ROWS}, illegal bigint, seam bigint, options array<struct<cost:bigint,audit:string,leave:int>>"
    return written(over(joined, best, fields), "searched")


def entered(found: DataFrame) -> DataFrame:
    """(part, number, enter, missing): the state each segment is entered in; the last one's missing turns at the end."""
    leaves = F.transform("options", lambda o: o["leave"])
    parts = F.sort_array(F.collect_list(F.struct("part", "number", leaves.alias("leaves"))))

    def followed(convs: Iterator[dict]) -> Iterator[dict]:
        for run in (conv["parts"] for conv in convs):
            state = START
            for i, part in enumerate(run):
                leave = part["leaves"][state]
                yield {"part": part["part"], "number": part["number"], "enter": state, "missing": MISSING[leave] if i == len(run) - 1 else 0}
                state = leave

    return over(found.groupBy("conv_id").agg(parts.alias("parts")), followed, "part int, number int, enter int, missing int")


def chosen(found: DataFrame) -> DataFrame:
    """Segments with the cost and audit of their part of the best repair, and the turns that stay or are added."""
    kind = found.schema["conv_id"].dataType.simpleString()

    def staying(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            run, missing, option = part.pop("rows"), part.pop("missing"), part.pop("options")[part["enter"]]
            turns = []
            for at, role, before in replay(_plain(run), option["audit"], part.pop("enter")):
                row = run[at]
                turns.append({"at": at, "turn": row["turn"], "role": row["role"], "digest": row["digest"], "new": role or row["role"], "before": before})
            if missing:
                turns.append({"at": len(run), "new": None, "before": ["user", "assistant"][2 - missing :]})
            cost = option["cost"] + INSERT * missing
            yield part | {"cost": cost, "audit": option["audit"] + "I" * missing, "turns": turns}

    fields = (
        f"conv_id {kind}, part int, number int, illegal bigint, seam bigint, cost bigint, audit string, "
        "turns array<struct<at:int,turn:bigint,role:string,digest:binary,new:string,before:array<string>>>"
    )
    return written(over(found.join(entered(found), ["part", "number"]), staying, fields), "chosen")


def repaired(rows: DataFrame, best: DataFrame) -> DataFrame:
    """(conv_id, part, number, at, role, text, before): the turns of the repaired conversations, in order of the three numbers.

    ``before`` are the roles of the empty turns put before a turn; a null role only carries those.
    """
    turns = best.select("conv_id", "part", "number", F.explode("turns").alias("t"))
    texts = rows.select("conv_id", "turn", "role", _digest().alias("digest"), "text").groupBy(*ORDER).agg(F.first("text").alias("text"))
    texts = texts.select(*[F.col(c).alias(f"own_{c}") for c in ORDER], "text")
    same = F.lit(True)
    for c, column in zip(ORDER, ("conv_id", "t.turn", "t.role", "t.digest")):
        same = same & F.col(f"own_{c}").eqNullSafe(F.col(column))
    kept = turns.where("t.new IS NOT NULL").join(texts, same)
    columns = ["conv_id", "part", "number", F.col("t.at").alias("at"), F.col("t.new").alias("role"), "text", F.col("t.before").alias("before")]
    added = turns.where("t.new IS NULL").withColumn("text", F.lit(None).cast("string"))
    return kept.select(*columns).unionByName(added.select(*columns))


def hashed(turns: DataFrame, best: DataFrame) -> DataFrame:
    """(conv_id, cost, illegal, audit, repaired_sha256) of every conversation with rows."""
    empty = F.transform("before", lambda role: F.concat(role, F.lit(":")))
    own = F.when(F.col("role").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.concat("role", F.lit(":"), "text")))
    lines = turns.select("conv_id", "part", "number", "at", F.concat(F.array_join(F.concat(empty, own), "\n"), F.lit("\n")).alias("lines"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    place = [F.col("conv_id").asc_nulls_first(), "part", "number", "at"]
    dealt = lines.repartitionByRange(*place).sortWithinPartitions(*place)

    def joined(rows: Iterator[dict]) -> Iterator[dict]:
        chunk, held, size = None, [], 0
        for row in rows:
            if held and (row["conv_id"] != chunk["conv_id"] or size > CHUNK):
                yield chunk | {"lines": "".join(held)}
                held, size = [], 0
            if not held:
                chunk = row
            held.append(row["lines"])
            size += len(row["lines"])
        if held:
            yield chunk | {"lines": "".join(held)}

    chunks = over(dealt, joined, f"conv_id {kind}, part int, number int, at int, lines string")
    heads = best.select("conv_id", "part", "number", F.lit(-1).alias("at"), "cost", (F.col("illegal") + F.col("seam")).alias("illegal"), "audit")
    stream = heads.unionByName(chunks, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*place)

    def read(rows: Iterator[dict]) -> Iterator[dict]:
        now, audit, digest, begun = None, [], None, False
        for row in rows:
            if now is None or row["conv_id"] != now["conv_id"]:
                if now is not None:
                    yield now | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                now, audit, digest, begun = {"conv_id": row["conv_id"], "cost": 0, "illegal": 0}, [], hashlib.sha256(), False
            if row["at"] < 0:
                now["cost"] += row["cost"]
                now["illegal"] += row["illegal"]
                audit.append(row["audit"])
            else:
                # Every line ends with a line feed but the last one of a conversation.
                digest.update((("\n" if begun else "") + row["lines"][:-1]).encode())
                begun = True
        if now is not None:
            yield now | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    return over(stream, read, f"conv_id {kind}, cost bigint, illegal bigint, audit string, repaired_sha256 string")


def repair(rows: DataFrame, copies: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The repaired turns, and the report (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    ``copies`` says how many times a row counts.
    """
    plain = normal(rows, copies)
    marked = written(faults(plain), "faults")
    best = chosen(searched(segments(marked)))
    turns = repaired(plain, best)
    counts = counted(marked).withColumnRenamed("conv_id", "of")
    report = hashed(turns, best).join(counts, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    return turns, report


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) with the faults of a row's hash: dropped, emptied, without marks, twice, or given to the user."""
    conv, turn, role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fault = (F.crc32(F.encode(F.concat(conv, F.lit(":"), turn), "UTF-8")) % 20).alias("fault")
    hurt = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


def reports(original: DataFrame, rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """The report of ``rows`` for every conversation of ``original``, those without rows included."""
    every = original.select(F.col("conv_id").alias("every")).distinct()
    found = every.join(repair(rows, copies)[1], F.col("every").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        F.col("every").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
