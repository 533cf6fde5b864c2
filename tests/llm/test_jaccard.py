import random

from test_words_and_groups import plain

from quillsift.llm import jaccard as J

SCHEMA = "doc_id long, text string, digest int, class_id string, own int, size int"


def shingle_set(text):
    words = plain(text)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    sets = [shingle_set(t) for _, t in docs]
    links = [[j for j in range(len(docs)) if j != i and sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])] for i in range(len(docs))]
    classes = []
    for i in range(len(docs)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        classes.append(seen)
    out = []
    for i, (doc, _) in enumerate(docs):
        ids = [docs[j][0] for j in classes[i] if docs[j][0] is not None]
        other = {frozenset(sets[j]) for j in links[i]} - {frozenset(sets[i])}
        out.append((doc, min(ids) if ids and sets[i] else doc, len(links[i]), len(other)))
    return sorted(out, key=str), classes, sets


def sample(seed=2, families=12, n=8):
    rng = random.Random(seed)
    docs = []
    for _ in range(families):
        base = [rng.choice("abcdefghijklmnop") + str(rng.randint(0, 400)) for _ in range(rng.randint(3, 120))]
        for _ in range(n):
            words = base[:]
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 99)}"
            docs.append(" ".join(words).title() if rng.random() < 0.3 else " ".join(words) + ".")
    docs += [None, "", "...", "one", "One!", "one two", "long " * 50_000, "long " * 40_000]
    rows = list(enumerate(docs, 5))
    rng.shuffle(rows)
    return rows + [(None, docs[0]), (None, None), rows[0], rows[1]]


def test_links_and_classes_match_brute_force(spark):
    docs = sample()
    frame = spark.createDataFrame([(d, t, 1, "c", 2, 3) for d, t in docs], SCHEMA)
    got = J.join(frame).select("doc_id", "class_id", "n_links", "n_text_links").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)[0]


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BUCKET_BLOCK", 7)
    monkeypatch.setattr(J, "GROUP_BLOCK", 5)
    docs = sample(seed=9, families=3, n=40)
    frame = spark.createDataFrame([(d, t, 1, "c", 2, 3) for d, t in docs], SCHEMA)
    got = J.join(frame).select("doc_id", "class_id", "n_links", "n_text_links").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)[0]


def test_one_of_each_class_stays(spark):
    docs = sample(seed=5)
    frame = spark.createDataFrame([(d, t, 1, "c", 2, 3) for d, t in docs], SCHEMA)
    kept = J.one_of_each(frame)
    rows = kept.collect()
    assert kept.columns == frame.columns
    want, classes, sets = brute(docs)
    groups = {frozenset(c) for i, c in enumerate(classes) if sets[i]}
    bare = sum(1 for s in sets if not s)
    assert len(rows) == len(groups) + bare
    lowest = sorted(min(docs[j][0] for j in g if docs[j][0] is not None) for g in groups)
    assert sorted(r["doc_id"] for r in rows if shingle_set(r["text"])) == lowest


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert J.join(empty).count() == 0 and J.one_of_each(empty).count() == 0


def test_posterior_bound_falls_only_for_unlikely_pairs():
    least = J.least_matches()
    assert list(least) == list(range(J.STEP, J.HASHES + 1, J.STEP))
    assert all(0 < least[n] < 0.8 * n for n in least)
