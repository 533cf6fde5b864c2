from quillsift.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, chunk int, perspective string"


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t, r or "unknown", x or "") for c, t, r, x in rows if c == conv))
        for me in {r for _, r, _ in turns}:
            at = 0
            for k in range(0, len(turns), C.CHUNK):
                text, spans, first = "", [], at
                for _, role, body in turns[k : k + C.CHUNK]:
                    head = "<|assistant|>\n" if role == me else f"<|user name={role}|>\n"
                    if role == me and body:
                        spans.append((len(text) + len(head), len(text) + len(head) + len(body)))
                    text += head + body + "<|end|>\n"
                at += len(text)
                out[conv, me, k // C.CHUNK] = (first, text, spans)
    return out


def test_every_perspective_of_every_conversation(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 4)
    monkeypatch.setattr(C, "SLICE", 3)
    rows = [(c, t, ["ann", "bob", "é x"][(c * t) % 3], f"text {c} {t} é" * (t % 3)) for c in range(6) for t in range(11)]
    rows += [(1, None, None, None), (None, 0, "ann", "a"), (None, 1, "bob", None), (2, 4, "ann", "tie"), (2, 4, "ann", "tie"), (7, 0, "ann", "x" * 300_000)]
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA)
    got = {(r["conv_id"], r["perspective"], r["chunk"]): (r["start_char"], r["text"], [tuple(s) for s in r["spans"]]) for r in C.rendered(frame).collect()}
    assert got == brute(rows)
    assert C.rendered(frame.where("false")).count() == 0
