"""SQL checks of the operators that SQL can express, written without the operators' code."""

WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = rf"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {WORDS.format("text")} AS w FROM benchmark),
grams AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM grams),
spots AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)
),
found AS (SELECT doc_id, s.n, i, item_id FROM spots s JOIN grams g ON s.n = g.n AND s.gram = g.gram),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS gram
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)
),
sets AS (SELECT doc_id, count(*) AS n, md5(string_agg(gram, '|' ORDER BY gram)) AS body FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b, y.body AS other, x.body <> y.body AS differs
    FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 10 * c >= 8 * (x.n + y.n - c)
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
low AS (SELECT a, min(least(a, b)) AS class_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n_links, count(DISTINCT other) FILTER (WHERE differs) AS n_text_links FROM links GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(n_text_links, 0)::BIGINT AS n_text_links
FROM d LEFT JOIN low ON low.a = doc_id LEFT JOIN counted ON counted.a = doc_id
"""

OP5 = """
WITH t AS (
    SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS pos
    FROM conversations
),
v AS (
    SELECT t.*, p.perspective, t.role = p.perspective AS own,
        CASE WHEN t.role = p.perspective THEN '<|assistant|>' || chr(10) ELSE '<|user name=' || t.role || '|>' || chr(10) END AS head
    FROM t JOIN (SELECT DISTINCT conv_id, role AS perspective FROM t) p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
),
c AS (
    SELECT *, pos // 256 AS chunk, length(head) + length(text) + length('<|end|>') + 1 AS size FROM v
),
o AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY conv_id, perspective ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM c
),
m AS (SELECT *, min(before) OVER (PARTITION BY conv_id, perspective, chunk) AS first FROM o),
q AS (SELECT *, (before - first + length(head))::BIGINT AS a, (before - first + length(head) + length(text))::BIGINT AS z FROM m)
SELECT conv_id, perspective, chunk::BIGINT AS chunk, count(*)::INT AS n_turns, min(first)::BIGINT AS start_char,
    coalesce(sum(length(text)) FILTER (WHERE own), 0)::BIGINT AS n_masked,
    sha256(string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY pos)) AS text_sha256,
    coalesce(string_agg(a || ':' || z, ',' ORDER BY pos) FILTER (WHERE own AND z > a), '') AS mask
FROM q GROUP BY conv_id, perspective, chunk
"""

OP6 = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        greatest(CASE WHEN length(text) > 0 THEN 1 - length(regexp_replace(text, '[\p{L}\p{N}\x20\x09-\x0D.,;:!?''-]+', '', 'g')) / length(text) ELSE 0 END, 0.1) AS w,
        ((('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT)::DOUBLE + 0.5) / 281474976710656.0 AS u,
        coalesce(doc_id::VARCHAR, '') AS doc_key
    FROM documents
),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size, (((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1)::DOUBLE AS weight
    FROM d GROUP BY source
),
r AS (
    SELECT *, 3 * source_size / weight AS ratio, row_number() OVER (ORDER BY 3 * source_size / weight) AS k, sum(source_size) OVER () AS total FROM s
),
levels AS (
    SELECT k, ratio, (total - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM r
),
chosen AS (SELECT coalesce(min_by(level, k), 0) AS level FROM levels WHERE ratio >= level),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, level * weight) AS target FROM s, chosen),
p AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t
),
o AS (
    SELECT d.*, p.source_size, p.target, p.epochs, floor(p.target - p.epochs * p.source_size)::BIGINT AS budget,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / w, doc_key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - before)))::BIGINT AS taken FROM o
"""


def _level(k: int) -> str:
    """One level of the tree: wildcards, merged branches, smoothed purity."""
    above = ["host", *[f"t{j}" for j in range(1, k)]]
    keys = ", ".join(above)
    same = " AND ".join(f"a.{c} = b.{c}" for c in above)
    return f"""
w{k} AS (SELECT {keys} FROM (SELECT {keys}, s{k}, sum(pages) AS n FROM g{k - 1} GROUP BY ALL) GROUP BY ALL HAVING count(*) > 20 AND sum(n) / count(*) < 5),
g{k} AS (
    SELECT a.*, CASE WHEN b.host IS NOT NULL AND s{k} <> '' THEN '*' ELSE s{k} END AS t{k} FROM g{k - 1} a LEFT JOIN w{k} b ON {same}
),"""


def _purity(k: int) -> str:
    above = ", ".join(["host", *[f"t{j}" for j in range(1, k)]])
    names = ["host", *[f"t{j}" for j in range(1, k)]]
    both = " AND ".join(f"a.{c} = b.{c}" for c in names)
    return f"""
n{k} AS (SELECT {above}, t{k}, sum(labelled) AS n, sum(blocked) AS b FROM g3 GROUP BY ALL),
l{k} AS (
    SELECT *, lag(n) OVER (PARTITION BY {above} ORDER BY b / n, t{k}) AS n0, lag(b) OVER (PARTITION BY {above} ORDER BY b / n, t{k}) AS b0
    FROM n{k} WHERE n > 0
),
a{k} AS (
    SELECT *, CASE WHEN n0 IS NULL THEN 0 WHEN b / n - b0 / n0 > 1.96 * sqrt(((b + b0) / (n + n0)) * (1 - (b + b0) / (n + n0)) * (1 / n + 1 / n0)) THEN 1 ELSE 0 END AS apart
    FROM l{k}
),
f{k} AS (SELECT *, sum(apart) OVER (PARTITION BY {above} ORDER BY b / n, t{k}) AS branch FROM a{k}),
m{k} AS (SELECT {above}, t{k}, sum(n) OVER (PARTITION BY {above}, branch) AS bn, sum(b) OVER (PARTITION BY {above}, branch) AS bb FROM f{k}),
p{k} AS (
    SELECT {", ".join("a." + c for c in names)}, a.t{k}, (coalesce(bb, 0) + 4 * b.purity) / (coalesce(bn, 0) + 4) AS purity
    FROM n{k} a JOIN p{k - 1} b ON {both} LEFT JOIN m{k} c ON {" AND ".join(f"a.{c} = c.{c}" for c in [*names, f"t{k}"])}
),"""


OP10 = (
    r"""
WITH u AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
    FROM u
),
named AS (
    SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS label,
        list_filter(string_split(path, '/'), lambda x: x <> '') AS parts
    FROM ruled
),
cut AS (SELECT *, coalesce(parts[1], '') AS r1, coalesce(parts[2], '') AS r2, array_to_string(parts[3:], '/') AS r3 FROM named),
seg AS (
    SELECT *, CASE WHEN regexp_matches(r1, '[0-9]') THEN '*' ELSE r1 END AS s1, CASE WHEN regexp_matches(r2, '[0-9]') THEN '*' ELSE r2 END AS s2,
        CASE WHEN regexp_matches(r3, '[0-9]') THEN '*' ELSE r3 END AS s3
    FROM cut
),
g0 AS (
    SELECT host, s1, s2, s3, count(*) AS pages, count(label) AS labelled, count(*) FILTER (WHERE label = 'block') AS blocked FROM seg GROUP BY ALL
),"""
    + "".join(_level(k) for k in (1, 2, 3))
    + """
whole AS (SELECT (sum(blocked) + 4 * 0.5::DOUBLE) / (sum(labelled) + 4) AS p FROM g3),
p0 AS (SELECT host, (sum(blocked) + 4 * any_value(p)) / (sum(labelled) + 4) AS purity FROM g3, whole GROUP BY host),"""
    + "".join(_purity(k) for k in (1, 2, 3))
    + """
final AS (
    SELECT g3.host, s1, s2, s3, purity, concat_ws('/', g3.host, nullif(g3.t1, ''), nullif(g3.t2, ''), nullif(g3.t3, '')) AS template
    FROM g3 JOIN p3 USING (host, t1, t2, t3)
)
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN purity >= 0.7 THEN 'block' ELSE 'allow' END) AS verdict, template
FROM seg JOIN final USING (host, s1, s2, s3)
"""
)

#: CRC-32 by its byte table; {0} is a text, the table is a row of crc_table.
CRC_TABLE = """
crc_table AS (
    SELECT list(v ORDER BY i) AS crc FROM (
        SELECT i, list_reduce(list_prepend(i, [0, 1, 2, 3, 4, 5, 6, 7]),
            lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v
        FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS i)
    )
)
"""
CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(generate_series(1, length(hex({0})) // 2), lambda i: ('0x' || substr(hex({0}), 2 * i - 1, 2))::BIGINT)),
    lambda a, b: xor(a // 256, crc[xor(a, b) % 256 + 1])))"""

OP11 = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY doc_id, word),
bw AS (SELECT unnest({WORDS.format("coalesce(text, '')")}) AS word FROM benchmark),
every AS (SELECT DISTINCT word FROM (SELECT word FROM dw UNION ALL SELECT word FROM bw)),
hashed AS (SELECT word, {CRC.format("word")} % 10000 AS bucket FROM every, crc_table),
s AS (SELECT bucket, sum(n) AS s FROM dw JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (word) GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain
    FROM (SELECT unnest(generate_series(0, 9999)) AS bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
),
weights AS (SELECT doc_id, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM dw JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM d LEFT JOIN weights USING (doc_id)
),
fit AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM fit) THEN rank END AS rank
FROM scored LEFT JOIN fit USING (doc_id)
"""

#: Grammar of op13: from each state (0 nothing yet, 1 system, 2 user, 3 assistant) the moves of one row after up to two insertions.
OP13_MOVES = ", ".join(
    [f"({state}, 'D', NULL, {state}, 2, 'D', '')" for state in range(4)]
    + [
        f"({state}, '{letter}', '{initial}', {to}, {5 * k + (letter == 'R')}, '{'I' * k}{letter}', '{added}')"
        for state, k, middle, added in (
            (0, 0, 0, ""), (0, 1, 2, "|user:"), (0, 2, 3, "|user:|assistant:"), (1, 0, 1, ""), (1, 1, 2, "|user:"), (1, 2, 3, "|user:|assistant:"),
            (2, 0, 2, ""), (2, 1, 3, "|assistant:"), (3, 0, 3, ""), (3, 1, 2, "|user:"),
        )
        for letter, initial, to in {
            0: (("K", "s", 1), ("K", "u", 2), ("R", "user", 2)), 1: (("K", "u", 2), ("R", "user", 2)),
            2: (("K", "a", 3), ("R", "assistant", 3)), 3: (("K", "u", 2), ("R", "user", 2)),
        }[middle]
    ]
)

OP13 = f"""
WITH RECURSIVE {CRC_TABLE},
plain AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
    FROM conversations
),
hashed AS (SELECT p.*, {CRC.format("k")} % 20 AS fault FROM plain p, crc_table),
harmed AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM hashed WHERE fault <> 0
),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
        rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS body
    FROM harmed
),
judged AS (
    SELECT *, body = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        right(body, 1) NOT IN ('.', '!', '?') AS late, left(role, 1) AS initial,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS ahead
    FROM ordered
),
moves(state, action, needs, new_state, price, letters, added) AS (VALUES {OP13_MOVES}),
best AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}} AS done FROM judged
    UNION ALL
    SELECT b.conv_id, b.i + 1, m.new_state, min({{
        'cost': b.done.cost + m.price + CASE WHEN action <> 'D' AND late THEN 5 ELSE 0 END, 'audit': b.done.audit || letters,
        'lines': b.done.lines || replace(added, '|', chr(10)) || CASE action
            WHEN 'K' THEN chr(10) || role || ':' || text WHEN 'R' THEN chr(10) || needs || ':' || text ELSE '' END
    }})
    FROM best b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.i = b.i + 1 JOIN moves m ON m.state = b.state
    WHERE action = 'D' OR (NOT blank AND NOT again AND (action = 'R' OR needs = initial))
    GROUP BY b.conv_id, b.i + 1, m.new_state
),
ends(state, price, letters, added) AS (VALUES (0, 0, '', ''), (3, 0, '', ''), (2, 5, 'I', '|assistant:'), (1, 10, 'II', '|user:|assistant:')),
last AS (SELECT conv_id, max(i) AS n FROM judged GROUP BY conv_id),
final AS (
    SELECT b.conv_id, min({{'cost': b.done.cost + e.price, 'audit': b.done.audit || e.letters, 'lines': b.done.lines || replace(e.added, '|', chr(10))}}) AS done
    FROM best b JOIN last l ON l.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = l.n JOIN ends e ON e.state = b.state GROUP BY b.conv_id
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
        count(*) FILTER (WHERE NOT blank AND again) AS duplicate, count(*) FILTER (WHERE NOT blank AND NOT again AND late) AS truncated,
        count(*) FILTER (WHERE i > 1 AND ahead || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(f.done.cost, 0)::BIGINT AS cost,
    coalesce(f.done.audit, '') AS audit, sha256(coalesce(substr(f.done.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN final f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLES: dict[str, str] = {
    "op1_decontaminate": OP1,
    "op4_jaccard_join": OP4,
    "op5_chat_format": OP5,
    "op6_mix_sources": OP6,
    "op10_url_filter": OP10,
    "op11_importance": OP11,
    "op13_repair": OP13,
}
