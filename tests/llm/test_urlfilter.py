from quillsift.llm import urlfilter as U

SCHEMA = "page_id long, url string, host int, verdict string, s1 int"


def judged(spark, urls, rules=U.RULES):
    frame = spark.createDataFrame([(i, u, 1, "v", 2) for i, u in enumerate(urls)], SCHEMA)
    return {r["page"]["page_id"]: r for r in U.judged(frame, rules).collect()}


def test_addresses_and_rules(spark):
    urls = [
        "http://A.Example.ORG/es/1?x", "https://example.org/en/12#t", "http://example.org/en/2", "http://x.com/fr/a", "http://x.com/de/", "http://xcom/de/",
        "http://org", "org/path", None, "", "a://b://c/d", "http://x.net/Fr/1", "http://x.com\n/de/1",
    ]
    got = judged(spark, urls)
    assert len(got) == len(urls)
    assert [got[i]["rule"] for i in range(6)] == ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None]
    assert (got[0]["host"], got[0]["path"], got[0]["verdict"]) == ("a.example.org", "/es/1", "block")
    assert (got[6]["host"], got[6]["path"], got[6]["rule"]) == ("org", "", None)
    assert [(got[i]["host"], got[i]["path"]) for i in (7, 8, 9)] == [("", "")] * 3
    assert (got[10]["host"], got[10]["path"]) == ("b:", "//c/d")
    assert got[11]["path"] == "/Fr/1"


def test_wildcards_merging_and_purity(spark):
    spam = [f"http://s.com/{w}/p{i}" for i in range(40) for w in ("win", "bet")] + [f"http://s.com/de/{i}" for i in range(10)]
    fine = [f"http://s.com/fr/{i}" for i in range(60)]
    names = [f"http://n.net/user{chr(97 + i // 26)}{chr(97 + i % 26)}/about" for i in range(60)]
    rules = [("com/de/", "block"), ("com/fr/", "allow"), ("s.com/win/", "block")]
    got = judged(spark, spam + fine + names, rules)
    by_template = {r["template"]: r for r in got.values()}
    assert set(by_template) == {"s.com/win/*", "s.com/bet/*", "s.com/de/*", "s.com/fr/*", "n.net/*/about"}
    assert min(by_template[t]["purity"] for t in ("s.com/win/*", "s.com/de/*")) > 0.9
    assert by_template["s.com/fr/*"]["purity"] < 0.1
    open_branch = by_template["s.com/bet/*"]
    assert open_branch["rule"] is None and 0.1 < open_branch["purity"] < 0.9


def test_empty_and_unlabelled(spark):
    assert U.judged(spark.createDataFrame([], SCHEMA)).count() == 0
    got = judged(spark, ["http://x.net/a", "http://x.net/a", None], [])
    assert [r["verdict"] for r in got.values()] == ["allow"] * 3
    frame = spark.createDataFrame([(1, "http://a.com/de/x", 1, "v", 2), (2, "http://b.net/", 1, "v", 2)], SCHEMA)
    kept = U.allowed(frame)
    assert kept.columns == frame.columns and [r["page_id"] for r in kept.collect()] == [2]


def test_deeper_branches_are_told_apart(spark):
    urls = [f"http://s.com/blog/posts/{w}/{i}{end}" for i in range(30) for w, end in (("spam", ""), ("good", ""), ("good", "/more"))] + ["http://s.com/blog/posts/open/1"]
    rules = [("s.com/blog/posts/spam/1", "block"), ("s.com/blog/posts/good/", "allow")]
    got = judged(spark, urls, rules)
    by_template = {r["template"]: r for r in got.values()}
    assert len(got) == len(urls)
    assert set(by_template) == {f"s.com/blog/posts/{t}" for t in ("spam/*", "good/*", "good/*/more", "open/*")}
    assert by_template["s.com/blog/posts/spam/*"]["purity"] > 0.7 > 0.1 > by_template["s.com/blog/posts/good/*"]["purity"]
    assert got[30 * 3 - 3]["rule"] is None and got[30 * 3 - 3]["verdict"] == "block"
