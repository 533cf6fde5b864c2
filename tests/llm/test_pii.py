import random
import re

from quillsift.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    def digits(m):
        return re.sub(r"[^0-9]", "", m.group())

    text = text or ""
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and P.luhn(digits(m))]
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_spans_match_the_patterns(spark, folder):
    rng = random.Random(0)
    texts = ["".join(rng.choice("ab1 +-.@4567@..()  0\n٣é") for _ in range(rng.randint(0, 60))) for _ in range(30_000)]
    texts += [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    texts += [None, "", "1" * 100_000, "1." * 50_000, "+1(" * 30_000, "4111 1111 1111 1111", "a@" * 20_000, "a@b@c.d", "x" * 100_000 + "@y.z"]
    assert [t for t in texts if P.base_spans(t) != brute(t)] == []


def test_a_query_row_per_document(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    field = P.train(docs)
    rows = P.digest(P.scan(docs, field)).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(x[0] == i for x in base) for i in range(4)]
        assert set(P.rendered(base).split(",")) <= set(r["spans"].split(","))


def test_distant_mentions_get_the_kind_of_the_base_span(spark, folder):
    field = P.train(spark.read.parquet(f"{folder}/documents.parquet"))
    text = "Pay with 4785 3805 9239 1139 now. " + "word " * 3000 + "It was 4785.3805.9239.1139, ref 123456789012. Call +49 170 1234567 or 0049-170-1234567."
    base, every = P.find([text], field)[0]
    assert {(P.KINDS[k], text[s:e]) for k, s, e in set(every) - set(base)} == {("card", "4785.3805.9239.1139"), ("phone", "0049-170-1234567")}
    alone = "It was 4785.3805.9239.1139, ref 123456789012, or 0049-170-1234567."
    assert P.find([alone], field) == [([], [])]


def test_redaction_and_odd_rows(spark):
    rows = [(1, "mail é a.b@c.org, or +1 (555) 010-9999; done", "p"), (2, None, "p"), (3, "", "p"), (3, "no data", "p"), (4, "1.2.3.4 " * 3000, "p")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    got = P.redact(frame, P.train(frame))
    assert got.columns == frame.columns
    assert [r["text"] for r in got.collect()] == ["mail é <email>, or <phone>; done", None, "", "no data", "<ip> " * 3000]
    empty = frame.where("false")
    assert P.redact(empty, P.train(empty)).count() == 0


def added(text, field):
    base, every = P.find([text], field)[0]
    return [(P.KINDS[k], text[s:e]) for k, s, e in sorted(set(every) - set(base), key=lambda x: x[1])]


def test_every_repeat_of_a_base_span_gets_its_kind(spark, folder):
    field = P.train(spark.read.parquet(f"{folder}/documents.parquet"))
    for kind, base, repeat in (("card", "4785 3805 9239 1139", "4785.3805.9239.1139"), ("phone", "+49 170 1234567", "0049-170-1234567")):
        for text in (f"Note {base} now. " + f"Then {repeat} again. " * 50, f"Then {repeat} again. " * 50 + f"Note {base} now."):
            assert added(text, field) == [(kind, repeat)] * 50


def test_numbers_written_with_blanks(spark, folder):
    field = P.train(spark.read.parquet(f"{folder}/documents.parquet"))
    cases = [
        ("phone", "+49 170 1234567", "0049 170 1234567"), ("phone", "+49 170 1234567", "0170 123 4567"), ("phone", "+49 170 1234567", "0170/1234567"),
        ("phone", "+1 (555) 010-9999", "(555) 010-9999"), ("phone", "+1 (555) 010-9999", "010-9999"), ("card", "4785 3805 9239 1139", "4785. 3805. 9239. 1139"),
    ]
    for kind, base, repeat in cases:
        assert added(f"We noted {base} here. Some words later it was {repeat} again, with ref 99 12345 678.", field) == [(kind, repeat)]
    assert added("We noted +49 170 1234567 here. Rows: 5, 0170 123 4567, 12 77 31 and 2020 2021 2022 2023 2024.", field) == [("phone", "0170 123 4567")]
    assert P.nodes_of("1 2 " * 50_000 + "x" * 200_000 + " 1-" * 50_000, []) == []
