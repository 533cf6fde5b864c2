import hashlib
import heapq
import random
import zlib

import pytest

from quillsift.llm import queries
from quillsift.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string, copies string, fault int"
BLANK = " \t\n\x0b\x0c\r"
EXPECTED = ["user", "user", "assistant", "user"]
NEXT = [2, 2, 3, 2]


def harmed(rows):
    """The damage of the contract, written anew."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def report(rows):
    """Rows of one conversation by a best-first search over (cost, audit): no bounds, no segments."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(BLANK)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if at == len(rows) and state in (0, 3):
            break
        if (at, state) in done:
            continue
        done.add((at, state))
        heapq.heappush(heap, (cost + 5, audit + "I", at, NEXT[state], (*lines, EXPECTED[state] + ":")))
        if at == len(rows):
            continue
        _, _, role, text = rows[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, lines))
        if faults[at] in ("blank", "duplicate"):
            continue
        late = 5 * (faults[at] == "truncated")
        move = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, role[:1]))
        if move is not None:
            heapq.heappush(heap, (cost + late, audit + "K", at + 1, move, (*lines, f"{role}:{text}")))
        heapq.heappush(heap, (cost + late + 1, audit + "R", at + 1, NEXT[state], (*lines, f"{EXPECTED[state]}:{text}")))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected(rows):
    by_conv = {conv: [] for conv, *_ in rows}
    for row in harmed(rows):
        by_conv[row[0]].append(row)
    return {conv: report(part) for conv, part in by_conv.items()}


def found(frame):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = frame.collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in got}


def sample(seed=4, convs=60):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
            text = rng.choice([None, "", " \t", "Yes.", "No", "What? ", "Tell me", "Ärger!", "a.b", "end. "])
            rows.append((conv, rng.choice([None, turn, turn, turn, turn + 7]), role, text))
    return rows + rows[:5] * 3


def compare(spark, rows):
    frame = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA).repartition(5)
    assert found(R.reports(frame, R.damaged(frame), R.F.col("copies"))) == expected(rows)


def test_reports_equal_a_search_without_bounds(spark):
    compare(spark, sample())


@pytest.mark.parametrize("size", [1, 3])
def test_long_conversations_are_cut_into_segments(spark, monkeypatch, size):
    monkeypatch.setattr(R, "SEGMENT", size)
    monkeypatch.setattr(R, "CHUNK", 20)
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No", f"{t}!", f"{t}?"])) for t in range(120)]
    rows += [(2, None, "user", "same")] * 50 + [(3, 5, "system", "Be kind.")]
    compare(spark, rows + sample(9, 12))


def test_search_equals_all_edits_of_short_rows():
    rng = random.Random(1)
    for _ in range(300):
        rows = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3, rng.choice([1, 1, 2])) for _ in range(rng.randint(0, 6))]
        heap, done = [(0, "", 0, 0)], set()
        while True:
            cost, audit, at, state = heapq.heappop(heap)
            if at == len(rows) and state in (0, 3):
                break
            if (at, state) in done:
                continue
            done.add((at, state))
            heapq.heappush(heap, (cost + 5, audit + "I", at, NEXT[state]))
            if at < len(rows):
                initial, go, late, n = rows[at]
                heapq.heappush(heap, (cost + 2 * n, audit + "D" * n, at + 1, state))
                if not go:
                    more, extra = "D" * (n - 1), 2 * (n - 1) + 5 * late
                    move = R.MOVES.get((state, initial))
                    if move is not None:
                        heapq.heappush(heap, (cost + extra, audit + "K" + more, at + 1, move))
                    heapq.heappush(heap, (cost + extra + 1, audit + "R" + more, at + 1, NEXT[state]))
        least, first, end = R.search(rows, R.ENDS, R.START)
        assert (least + 5 * R.MISSING[end], first + "I" * R.MISSING[end]) == (cost, audit)


def test_texts_of_repaired_turns_long_texts_and_empty_tables(spark):
    long = "word " * 200_000 + "."
    rows = [("a", 1, "user", long), ("a", 2, "user", "Then?"), ("b", 1, "assistant", " ")]
    turns, report = R.repair(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    got = sorted((r["at"], r["role"], r["text"], r["before"]) for r in turns.collect())
    assert got == [(0, "user", long, []), (1, "assistant", "Then?", [])]
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in report.collect()} == {"a": (1, "KR"), "b": (2, "D")}
    none = spark.createDataFrame([], SCHEMA)
    assert R.reports(none, R.damaged(none), R.F.col("copies")).count() == 0


def test_query_over_its_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op13_repair(spark, folder)) == expected(rows)
