"""DuckDB statements that compute the same results independently, by query name."""

from __future__ import annotations

from quillsift.functions.charsets import BLANK_CLASS, BLANKS, PUNCTUATION, SEPARATOR_CLASS, STOP_WORDS
from quillsift.operators.features import FEATURES, FLAGS, NUMERIC
from quillsift.plans import settings as P

WORD = r"\p{L}\p{N}_"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def named(expressions: dict[str, str]) -> str:
    return ",\n".join(f"{sql} AS {name}" for name, sql in expressions.items())


RAW = """raw AS (
  SELECT d.lang AS Source, d.doc_id AS row_id,
         CASE d.doc_id % 3 WHEN 0 THEN concat('Subject: ', d.text)
                           WHEN 1 THEN concat('SUBJECT:', d.text) ELSE d.text END AS Body,
         l.toxic AS Label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

RAW_ALL = RAW.replace("JOIN labels", "LEFT JOIN labels")
RAW_NULLS = RAW.replace("raw AS", "raw_full AS") + """,
raw AS (
  SELECT Source, row_id, CASE WHEN row_id % 50 = 7 THEN NULL ELSE Body END AS Body, Label FROM raw_full)"""


def plain(sql: str) -> str:
    return f"regexp_replace({sql}, '[{SEPARATOR_CLASS}]', ' ', 'g')"


def words_of(sql: str) -> str:
    return f"len(regexp_extract_all({sql}, '[^{BLANK_CLASS}]+'))"


SUBJECT_SQL = plain(
    f"CASE WHEN prefixed THEN trim(substr(split_part(Body, chr(10), 1), 9), {quoted(BLANKS)}) ELSE '' END"
)
BODY_SQL = plain(
    "CASE WHEN NOT prefixed THEN Body WHEN instr(Body, chr(10)) = 0 THEN '' "
    "ELSE substr(Body, instr(Body, chr(10)) + 1) END"
)
PREP = f"""marked AS (
  SELECT *, regexp_matches(Body, '^(?i)subject:') AS prefixed FROM raw WHERE Body IS NOT NULL),
prep AS (
  SELECT Source, row_id, {SUBJECT_SQL} AS Subject, {BODY_SQL} AS Body, Label FROM marked)"""


def feature_sql(subject: str, body: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for text, prefix in ((subject, "subject"), (body, "body")):
        def matches(pattern: str) -> str:
            return f"len(regexp_extract_all({text}, '{pattern}'))"

        letters, digits = matches("[A-Za-z]"), matches(r"\p{Nd}")
        out[f"{prefix}_length"] = f"length({text})"
        out[f"{prefix}_word_count"] = words_of(text)
        out[f"{prefix}_upper_ratio"] = f"coalesce({matches('[A-Z]')}::DOUBLE / nullif({letters}, 0), 0)"
        out[f"{prefix}_digit_ratio"] = f"coalesce({digits}::DOUBLE / nullif(length({text}), 0), 0)"
        out[f"{prefix}_has_http_url"] = f"regexp_matches({text}, '(?i)https?://')"
        out[f"{prefix}_has_web_url"] = (
            rf"regexp_matches({text}, '(?i)(^|[^{WORD}])www\.[a-z0-9]+\.[a-z]{{2,}}')"
        )
        for char, name in PUNCTUATION.items():
            out[f"{prefix}_{name}_count"] = f"length({text}) - length(replace({text}, {quoted(char)}, ''))"
    out["has_subject"] = f"length({subject}) > 0"
    return out


FEATURED = f"featured AS MATERIALIZED (SELECT *, {named(feature_sql('Subject', 'Body'))} FROM prep)"
TEXTS = """texts AS (SELECT *, concat(Subject, ' ', Body) AS text FROM prep)"""
CLEAN = f"""clean AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY Source, row_id) AS nth FROM texts)
  WHERE nth = 1 AND trim(text, {quoted(BLANKS)}) <> '' AND {words_of('text')} <= 100000)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def long_sql(features: list[str], keys: str = "Label") -> str:
    columns = ", ".join(f"{c}::DOUBLE AS {c}" for c in features)
    return (
        f"long AS (UNPIVOT (SELECT {keys}, {columns} FROM featured) "
        f"ON {', '.join(features)} INTO NAME feature VALUE value)"
    )


def split_sql(source: str, stratum: str, test_size: float, seed: int, name: str = "split_rows") -> str:
    """Quota per stratum by largest remainder; the smallest hashes of a stratum are its test rows."""
    return f"""{name}_ranked AS (
  SELECT *, {stratum} AS stratum,
         row_number() OVER (PARTITION BY {stratum} ORDER BY md5(concat('{seed}:', Source, ':', row_id))) AS place
  FROM {source}),
{name}_sizes AS (SELECT stratum, count(*) AS n FROM {name}_ranked GROUP BY stratum),
{name}_shares AS (
  SELECT stratum, n, sum(n) OVER () AS total, ceil({test_size}::DOUBLE * sum(n) OVER ())::BIGINT AS wanted
  FROM {name}_sizes),
{name}_floors AS (
  SELECT stratum, (n * wanted) // total AS base,
         row_number() OVER (ORDER BY (n * wanted) % total DESC, stratum) AS turn,
         wanted - sum((n * wanted) // total) OVER () AS left_over
  FROM {name}_shares),
{name} AS (
  SELECT r.*, CASE WHEN place <= base + (turn <= left_over)::INT THEN 'test' ELSE 'train' END AS split
  FROM {name}_ranked r JOIN {name}_floors f ON r.stratum = f.stratum)"""


def spread_sql(relation: str) -> str:
    return "spread AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n FROM {relation}" for c in FEATURES
    ) + ")"


AREA = """(sum(CASE WHEN pos THEN mean_rank ELSE 0 END) - count_if(pos) * (count_if(pos) + 1) / 2.0)
  / nullif(count_if(pos) * count_if(NOT pos), 0)"""


def ranked_sql(relation: str, group: str, value: str, label: str) -> str:
    return f"""ranked AS (
  SELECT {group}, {label} = 1 AS pos,
         rank() OVER (PARTITION BY {group} ORDER BY {value})
         + (count(*) OVER (PARTITION BY {group}, {value}) - 1) / 2.0 AS mean_rank
  FROM {relation})"""


def rates_sql(relation: str, group: str, threshold: float = P.THRESHOLD) -> str:
    """Confusion counts and metrics per group of a relation with Label and score."""
    called = f"score >= {threshold}"
    return f"""{ranked_sql(relation, group, 'score', 'Label')},
areas AS (SELECT {group}, {AREA} AS roc_auc FROM ranked GROUP BY {group}),
cells AS (
  SELECT {group}, count_if(Label = 0 AND NOT {called}) AS tn, count_if(Label = 0 AND {called}) AS fp,
         count_if(Label = 1 AND NOT {called}) AS fn, count_if(Label = 1 AND {called}) AS tp
  FROM {relation} GROUP BY {group}),
metrics AS (
  SELECT c.*, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision,
         coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1, a.roc_auc
  FROM cells c JOIN areas a USING ({group}))"""


RULE = "rule AS (SELECT Source, row_id, Label, body_upper_ratio AS score FROM featured)"
REQUESTS = """requests AS (
  SELECT event_id, ts, value AS response_ms, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS failed,
         CASE user_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 5 WHEN 2 THEN 10 WHEN 3 THEN 25 ELSE 50 END AS users,
         CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 5 WHEN 3 THEN 10 ELSE 20 END AS batch_size
  FROM events)"""
REQUEST_SUMMARY = """summary AS (
  SELECT users, batch_size, count(*) AS requests, sum(failed)::BIGINT AS failures,
         count(*) / nullif(date_diff('microsecond', min(ts), max(ts)) / 1000000.0, 0) AS rps,
         quantile_cont(response_ms, 0.5) AS median_ms, quantile_cont(response_ms, 0.95) AS p95_ms,
         quantile_cont(response_ms, 0.99) AS p99_ms
  FROM requests GROUP BY users, batch_size)"""


def rounded(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def wordlist() -> str:
    return ", ".join(quoted(w) for w in STOP_WORDS)


def tfidf_sql(docs: str) -> str:
    """Word counts, document frequencies and unit-length weights of a relation (doc, text)."""
    return f"""words AS (
  SELECT doc, unnest(regexp_extract_all(lower(text), '[{WORD}]{{2,}}')) AS term FROM {docs}),
terms AS (SELECT doc, term, count(*) AS tf FROM words WHERE term NOT IN ({wordlist()}) GROUP BY doc, term)"""


def bayes_sql() -> str:
    """Naive Bayes fitted on the training rows of one source, scores of every other row."""
    return f"""{tfidf_sql('docs')},
fit_docs AS (SELECT * FROM docs WHERE part = 'train'),
idf AS (
  SELECT term, ln((1.0 + (SELECT count(*) FROM fit_docs)) / (1.0 + count(*))) + 1 AS idf
  FROM terms JOIN fit_docs USING (doc) GROUP BY term),
weights AS (
  SELECT doc, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc)) AS w
  FROM terms JOIN idf USING (term)),
sums AS (
  SELECT i.term, coalesce(sum(w) FILTER (Label = 0), 0) + 1 AS s0, coalesce(sum(w) FILTER (Label = 1), 0) + 1 AS s1
  FROM idf i JOIN weights USING (term) JOIN fit_docs USING (doc) GROUP BY i.term),
model AS (
  SELECT term, ln(s0 / sum(s0) OVER ()) AS l0, ln(s1 / sum(s1) OVER ()) AS l1 FROM sums),
priors AS (
  SELECT ln(count_if(Label = 0) / count(*)::DOUBLE) AS p0, ln(count_if(Label = 1) / count(*)::DOUBLE) AS p1
  FROM fit_docs),
logs AS (
  SELECT d.doc, any_value(d.dataset) AS dataset, any_value(d.Label) AS Label,
         any_value(p0) + coalesce(sum(w * l0), 0) AS j0, any_value(p1) + coalesce(sum(w * l1), 0) AS j1
  FROM docs d CROSS JOIN priors LEFT JOIN (SELECT * FROM weights JOIN model USING (term)) x ON d.doc = x.doc
  WHERE d.part <> 'train' GROUP BY d.doc),
scores AS (SELECT dataset, doc, Label, 1 / (1 + exp(j0 - j1)) AS score FROM logs)"""


BAYES_DOCS = f"""per_source AS (
  SELECT *, row_number() OVER (PARTITION BY Source, text ORDER BY row_id) AS nth FROM texts),
unique_docs AS (SELECT * EXCLUDE (nth) FROM per_source WHERE nth = 1),
home AS (SELECT * FROM unique_docs WHERE Source = '{P.HOME}'),
{split_sql('home', 'Label', 0.2, 42, 'home_split')},
docs AS (
  SELECT row_id AS doc, text, Label, split AS part, concat(Source, ' (test)') AS dataset FROM home_split
  UNION ALL SELECT row_id, text, Label, 'other', Source FROM unique_docs WHERE Source <> '{P.HOME}')"""

RAW_ALL_NULLS = RAW_NULLS.replace("JOIN labels", "LEFT JOIN labels")
BASE = (RAW, PREP)
BASE_ALL = (RAW_ALL, PREP)
FULL = (RAW, PREP, FEATURED)
FULL_ALL = (RAW_ALL, PREP, FEATURED)


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["raw_messages"] = with_(RAW) + "SELECT * FROM raw"
    out["csv_roundtrip"] = with_(RAW) + "SELECT Source, Body, Label FROM raw"
    out["csv_named"] = out["csv_roundtrip"]
    out["prep_messages"] = with_(RAW_ALL_NULLS, PREP) + "SELECT * FROM prep"
    injected = "concat(" + ", ".join(
        ["text"] + [f"chr({ord(c)}), 'x'" for c in P.INJECTED]
    ) + ")"
    out["normalise_separators"] = f"SELECT doc_id, {plain(injected)} AS text FROM documents"
    names = ", ".join(FEATURES)
    out["build_dataset"] = with_(*FULL_ALL) + f"SELECT Source, row_id, Subject, Body, Label, {names} FROM featured"
    out["message_features"] = with_(*FULL_ALL) + f"SELECT Source, row_id, {names} FROM featured"
    out["page_features"] = f"SELECT page_id, {named(feature_sql('url', 'html'))} FROM pages"
    out["dedup_first"] = with_(*BASE_ALL, TEXTS) + (
        "SELECT arg_min(Source, (Source, row_id)) AS Source, arg_min(row_id, (Source, row_id)) AS row_id, "
        "first(Label ORDER BY Source, row_id) AS Label, text FROM texts GROUP BY text"
    )
    out["dedup_within_source"] = with_(*BASE_ALL, TEXTS) + (
        "SELECT Source, min(row_id) AS row_id, first(Label ORDER BY row_id) AS Label, text FROM texts GROUP BY Source, text"
    )
    out["low_quality_filter"] = (
        f"SELECT doc_id, text FROM documents WHERE trim(text, {quoted(BLANKS)}) <> '' "
        f"AND {words_of('text')} <= {P.MAX_TOKENS}"
    )
    train = split_sql("clean", "concat(Label, '_', Source)", 0.2, 42)
    trained = "featured_train AS (SELECT f.* FROM featured f JOIN split_rows s ON f.Source = s.Source AND f.row_id = s.row_id WHERE split = 'train')"
    out["varying_features"] = with_(*FULL, TEXTS, CLEAN, train, trained, spread_sql("featured_train")) + (
        "SELECT feature FROM spread WHERE n > 1"
    )
    out["constant_features"] = with_(*FULL_ALL, spread_sql("featured")) + "SELECT feature FROM spread WHERE n = 1"
    out["prepare_experiment"] = with_(*BASE, TEXTS, CLEAN, train) + (
        "SELECT Source, row_id, Label, text, split FROM split_rows"
    )
    out["score_projection"] = (
        "SELECT concat_ws('-', conv_id, turn) AS msg_id, concat(role, ' ', text) AS text, "
        + named({k: v for k, v in feature_sql("role", "text").items() if k in P.SCORE_FEATURES})
        + " FROM conversations"
    )
    category = (
        "CASE WHEN regexp_matches(feature, '(_length|_word_count|_upper_ratio|_digit_ratio)$') THEN 'shape/ratio features' "
        "WHEN regexp_matches(feature, '(_has_http_url|_has_web_url)$') THEN 'embedded/link flags' "
        "WHEN regexp_matches(feature, '_count$') THEN 'punctuation counts' ELSE 'other' END"
    )
    categories = "('shape/ratio features'), ('embedded/link flags'), ('punctuation counts'), ('other')"
    out["feature_summary"] = with_(*FULL) + (
        "SELECT c.category, count(feature) AS count, coalesce(string_agg(feature, ',' ORDER BY feature), '') AS list "
        f"FROM (VALUES {categories}) c(category) LEFT JOIN (SELECT *, {category} AS category FROM (SELECT unnest(json_keys(to_json(f))) AS feature "
        "FROM (SELECT * EXCLUDE (Source, row_id, Subject, Body, Label) FROM featured LIMIT 1) f)) n ON n.category = c.category GROUP BY 1"
    )
    kind = (
        "CASE WHEN regexp_matches(feature, '(_has_http_url|_has_web_url)$') THEN 'flag' "
        "WHEN regexp_matches(feature, '(_upper_ratio|_digit_ratio)$') THEN 'ratio' ELSE 'count' END"
    )
    out["feature_kinds"] = with_(*FULL_ALL, long_sql(FEATURES)) + (
        f"SELECT feature, {kind} AS kind, round(avg(CASE WHEN {kind} = 'count' THEN ln(1 + value) ELSE value END), 6) "
        "AS mean_shown FROM long GROUP BY feature"
    )
    out["source_summary"] = with_(RAW_NULLS) + (
        "SELECT Source, count(*) AS rows, (SELECT len(json_keys(to_json(r))) FROM raw r LIMIT 1)::BIGINT AS cols, count_if(Label = 0) AS ham, count_if(Label = 1) AS spam, "
        "round(avg(Label), 6) AS spam_rate, count_if(Body IS NULL) AS missing_body, "
        "count(*) - count(DISTINCT concat(coalesce(Body, '<none>'), '|', Label)) AS duplicate_rows FROM raw GROUP BY Source"
    )
    out["cleaning_summary"] = with_(RAW_NULLS, PREP) + (
        "SELECT r.Source, r.n AS rows_in, p.n AS rows_out, r.n - p.n AS rows_dropped, round(p.rate, 6) AS empty_subject_rate "
        "FROM (SELECT Source, count(*) AS n FROM raw GROUP BY Source) r JOIN "
        "(SELECT Source, count(*) AS n, avg((Subject = '')::INT) AS rate FROM prep GROUP BY Source) p ON r.Source = p.Source"
    )
    types = {"Source": "string", "row_id": "bigint", "Body": "string", "Label": "int"}
    out["column_profile"] = with_(RAW_NULLS) + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS rows, count_if({c} IS NULL) AS missing_values, "
        f"count(*) - count(DISTINCT {c}) - max(({c} IS NULL)::INT) AS duplicate_values FROM raw"
        for c, t in types.items()
    )
    out["source_columns"] = with_(RAW_NULLS) + " UNION ALL ".join(
        f"SELECT Source, '{c}' AS \"column\", '{types[c]}' AS dtype, count(*) AS rows, count_if({c} IS NULL) AS missing_values, "
        f"count(*) - count(DISTINCT {c}) - max(({c} IS NULL)::INT) AS duplicate_values FROM raw GROUP BY Source"
        for c in ("row_id", "Body", "Label")
    )
    out["label_mix"] = with_(RAW) + (
        "SELECT Source, Label, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY Source), 6) AS share "
        "FROM raw GROUP BY Source, Label"
    )
    out["label_mix_pivot"] = with_(RAW) + (
        "SELECT Source, count(*) AS rows, count_if(Label = 0) AS count_0, count_if(Label = 1) AS count_1, "
        "round(avg((Label = 0)::INT), 6) AS share_0, round(avg((Label = 1)::INT), 6) AS share_1 FROM raw GROUP BY Source"
    )
    out["subject_prefix_rate"] = with_(RAW_ALL_NULLS) + (
        "SELECT Source, round(avg(regexp_matches(Body, '^(?i)subject:')::INT), 6) AS any_case, "
        "round(avg(regexp_matches(Body, '^Subject:')::INT), 6) AS exact_case FROM raw GROUP BY Source"
    )
    fences = """fences AS (
  SELECT feature, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM long GROUP BY feature),
outliers AS (
  SELECT f.feature, any_value(q1 - 1.5 * (q3 - q1)) AS lower_bound, any_value(q3 + 1.5 * (q3 - q1)) AS upper_bound,
         count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outlier_count,
         count_if((value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AND Label = 0) AS ham_count,
         count_if((value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AND Label = 1) AS spam_count,
         any_value(n) AS n
  FROM long l JOIN fences f ON l.feature = f.feature GROUP BY f.feature)"""
    out["outlier_report"] = with_(*FULL, long_sql(NUMERIC), fences) + (
        f"SELECT feature, {rounded('lower_bound', 'upper_bound')}, outlier_count, "
        "round(outlier_count / n, 6) AS outlier_rate, "
        "CASE WHEN ham_count > 0 THEN round(ham_count / outlier_count, 6) END AS ham_share, "
        "CASE WHEN spam_count > 0 THEN round(spam_count / outlier_count, 6) END AS spam_share FROM outliers"
    )
    out["outlier_label_counts"] = with_(*FULL, long_sql(NUMERIC), fences) + (
        "SELECT feature, outlier_count, ham_count, spam_count FROM outliers"
    )
    separation = (
        *FULL,
        long_sql(FEATURES),
        ranked_sql("long", "feature", "value", "Label"),
        f"separation AS (SELECT feature, abs({AREA} - 0.5) AS separation FROM ranked GROUP BY feature)",
    )
    out["label_separation"] = with_(*separation) + f"SELECT feature, {rounded('separation')} FROM separation"
    out["top_features"] = with_(*separation) + (
        f"SELECT feature, {rounded('separation')} FROM separation ORDER BY round(separation, 9) DESC, feature LIMIT 12"
    )
    out["flag_rate_by_label"] = with_(*FULL, long_sql(FLAGS)) + (
        "SELECT Label, feature, round(avg(value), 6) AS rate FROM long GROUP BY Label, feature"
    )
    out["feature_box_stats"] = with_(
        *FULL,
        long_sql(FEATURES),
        f"shown AS (SELECT feature, Label, CASE WHEN {kind} = 'count' THEN ln(1 + value) ELSE value END AS v FROM long)",
        """boxes AS (
  SELECT feature, Label, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
         quantile_cont(v, 0.75) AS q3 FROM shown GROUP BY feature, Label),
inside AS (
  SELECT s.*, n, q1, median, q3, v >= q1 - 1.5 * (q3 - q1) - 1e-12 AND v <= q3 + 1.5 * (q3 - q1) + 1e-12 AS ok
  FROM shown s JOIN boxes b ON s.feature = b.feature AND s.Label = b.Label)""",
    ) + (
        "SELECT feature, Label, any_value(n) AS rows, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, "
        "round(any_value(q3), 6) AS q3, round(min(v) FILTER (ok), 6) AS whisker_low, "
        "round(max(v) FILTER (ok), 6) AS whisker_high, count_if(NOT ok) AS outliers FROM inside GROUP BY feature, Label"
    )
    lengths = f"lengths AS (SELECT {words_of('text')} AS words, length(text) AS chars FROM documents)"
    out["length_percentiles"] = with_(lengths) + " UNION ALL ".join(
        f"SELECT {p} AS percentile, round(quantile_cont(words, {p / 100}), 6) AS words, "
        f"round(quantile_cont(chars, {p / 100}), 6) AS chars, "
        f"round(quantile_cont(chars, {p / 100}) / quantile_cont(words, {p / 100}), 6) AS ratio FROM lengths"
        for p in (50, 90, 95, 99, 100)
    )
    out["length_coverage"] = with_(lengths) + " UNION ALL ".join(
        f"SELECT {c} AS candidate, round(avg((words <= {c})::INT) * 100, 6) AS covered, "
        f"round(100 - avg((words <= {c})::INT) * 100, 6) AS truncated FROM lengths"
        for c in P.CANDIDATES
    )
    out["stratified_split"] = with_(RAW, split_sql("raw", "concat(Label, '_', Source)", 0.2, 42)) + (
        "SELECT Source, row_id, Label, split FROM split_rows"
    )
    out["label_split"] = with_(RAW, split_sql("raw", "Label", 0.2, 42)) + (
        "SELECT Source, row_id, Label, split FROM split_rows"
    )
    out["validation_split"] = with_(
        RAW,
        split_sql("raw", "concat(Label, '_', Source)", 0.2, 42, "outer_split"),
        "fit AS (SELECT Source, row_id, Label FROM outer_split WHERE split = 'train')",
        split_sql("fit", "'all'", 0.1, 7, "inner_split"),
    ) + "SELECT Source, row_id, Label, CASE split WHEN 'test' THEN 'validation' ELSE 'train' END AS split FROM inner_split"
    out["cv_folds"] = with_(RAW, f"""placed AS (
  SELECT *, row_number() OVER (PARTITION BY Label ORDER BY md5(concat('42:', Source, ':', row_id))) - 1 AS i,
         count(*) OVER (PARTITION BY Label) AS n FROM raw)""") + (
        f"SELECT Source, row_id, Label, CASE WHEN i < (n % {P.FOLDS}) * (n // {P.FOLDS} + 1) THEN i // (n // {P.FOLDS} + 1) "
        f"ELSE (i - n % {P.FOLDS}) // (n // {P.FOLDS}) END AS fold FROM placed"
    )
    out["fixed_sample"] = with_(RAW) + (
        f"SELECT Source, row_id, Label FROM raw ORDER BY md5(concat('42:', Source, ':', row_id)) LIMIT {P.SAMPLE}"
    )
    out["class_weights"] = with_(RAW) + (
        "SELECT Source, row_id, Label, round((count(*) OVER ()) / (2.0 * count(*) OVER (PARTITION BY Label)), 6) AS weight FROM raw"
    )
    out["scaled_features"] = with_(*FULL_ALL) + "SELECT Source, row_id, " + ", ".join(
        f"round(({c}::DOUBLE - avg({c}::DOUBLE) OVER ()) / coalesce(nullif(stddev_pop({c}::DOUBLE) OVER (), 0), 1), 6) AS {c}"
        for c in P.SCALED
    ) + " FROM featured"
    out["pad_truncate"] = (
        f"WITH w AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[^{BLANK_CLASS}]+'), lambda x: length(x)) AS a FROM documents) "
        f"SELECT doc_id, array_to_string(list_transform(range(1, {P.PAD} + 1), lambda i: coalesce(a[i], 0)), ' ') AS ids FROM w"
    )
    out["word_tfidf"] = with_(*BASE_ALL, TEXTS, "docs AS (SELECT {'s': Source, 'r': row_id} AS doc, text FROM texts)", tfidf_sql("docs"), """idf AS (
  SELECT term, count(*) AS df, ln((1.0 + (SELECT count(*) FROM docs)) / (1.0 + count(*))) + 1 AS idf FROM terms GROUP BY term)""") + (
        "SELECT doc.s AS Source, doc.r AS row_id, term, tf, df, round(idf, 6) AS idf, "
        "round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc)), 6) AS weight FROM terms JOIN idf USING (term)"
    )
    out["naive_bayes_scores"] = with_(*BASE, TEXTS, BAYES_DOCS, bayes_sql()) + (
        "SELECT dataset, doc AS row_id, Label, round(score, 6) AS score FROM scores"
    )
    crossed = with_(*BASE, TEXTS, BAYES_DOCS, bayes_sql(), rates_sql("scores", "dataset"))
    rates = ", ".join(f"round({m}, 6) AS {m}" for m in ("precision", "recall", "f1", "roc_auc"))
    out["cross_source_metrics"] = crossed + (
        f"SELECT * FROM (UNPIVOT (SELECT dataset, {rates} FROM metrics) "
        "ON precision, recall, f1, roc_auc INTO NAME metric VALUE value)"
    )
    out["metrics_pivot"] = crossed + f"SELECT dataset, {rates} FROM metrics"
    ruled = with_(*FULL, RULE, rates_sql("rule", "Source"))
    out["evaluate_scores"] = ruled + f"SELECT Source, {rates}, {P.THRESHOLD}::DOUBLE AS threshold, tn, fp, fn, tp FROM metrics"
    whole = "whole AS (SELECT Source, false AS overall, row_id, Label, score FROM rule UNION ALL SELECT 'all', true, row_id, Label, score FROM rule)"
    out["evaluate_overall"] = with_(*FULL, RULE, whole, rates_sql("whole", "Source, overall")) + (
        f"SELECT Source, overall, {rates}, {P.THRESHOLD}::DOUBLE AS threshold, tn, fp, fn, tp FROM metrics"
    )
    terms = " + ".join(f"{w} * {c}" for c, w in P.OUTSIDE.items())
    outside = f"outside AS (SELECT Source, row_id, Label, 1 / (1 + exp(-({P.OUTSIDE_BIAS} + {terms}))) AS score FROM featured)"
    out["outside_scores"] = with_(*FULL, outside, rates_sql("outside", "Source", 0.5)) + (
        f"SELECT Source, {rates}, 0.5::DOUBLE AS threshold, tn, fp, fn, tp FROM metrics"
    )
    out["error_rates"] = ruled + (
        "SELECT Source, tn, fp, fn, tp, round(coalesce(fp / nullif(tn + fp, 0)::DOUBLE, 0), 6) AS false_positive_rate, "
        "round(coalesce(fn / nullif(fn + tp, 0)::DOUBLE, 0), 6) AS false_negative_rate FROM metrics"
    )
    out["class_report"] = ruled + """, two AS (
  SELECT Source, '0' AS class, tn AS hit, fn AS wrong, fp AS missed FROM metrics
  UNION ALL SELECT Source, '1', tp, fp, fn FROM metrics),
per_class AS (
  SELECT Source, class, coalesce(hit / nullif(hit + wrong, 0)::DOUBLE, 0) AS precision,
         coalesce(hit / nullif(hit + missed, 0)::DOUBLE, 0) AS recall,
         coalesce(2 * hit / nullif(2 * hit + wrong + missed, 0)::DOUBLE, 0) AS f1, hit + missed AS support, hit
  FROM two),
report AS (
  SELECT Source, class, precision, recall, f1, support FROM per_class
  UNION ALL SELECT Source, 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support)::BIGINT
    FROM per_class GROUP BY Source
  UNION ALL SELECT Source, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM per_class GROUP BY Source
  UNION ALL SELECT Source, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support)::BIGINT FROM per_class GROUP BY Source)
SELECT Source, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report"""
    out["run_ranking"] = ruled + (
        "SELECT Source AS run, 'classic' AS model, concat('feature=body_upper_ratio, threshold=', "
        f"'{P.THRESHOLD}') AS hyperparameters, {rates} FROM metrics"
    )
    other = "other AS (SELECT Source, row_id, Label, body_digit_ratio AS score FROM featured)"
    f1 = f"coalesce(2 * count_if(Label = 1 AND score >= {P.THRESHOLD}) / nullif(count_if(Label = 1) + count_if(score >= {P.THRESHOLD}), 0)::DOUBLE, 0)"
    out["run_delta"] = with_(*FULL, RULE, other, f"a AS (SELECT Source, {f1} AS f1 FROM other GROUP BY Source)",
                             f"b AS (SELECT Source, {f1} AS f1 FROM rule GROUP BY Source)") + (
        "SELECT a.Source AS run, round(a.f1, 6) AS f1_old, round(b.f1, 6) AS f1_new, round(b.f1 - a.f1, 6) AS delta_f1 "
        "FROM a JOIN b ON a.Source = b.Source"
    )
    out["request_summary"] = with_(REQUESTS, REQUEST_SUMMARY) + (
        f"SELECT users, batch_size, requests, failures, {rounded('rps', 'median_ms', 'p95_ms', 'p99_ms')} FROM summary"
    )
    cells = ", ".join(f"round(max(rps) FILTER (users = {u}), 6) AS u{u}" for u in P.USERS)
    out["loadtest_summary"] = out["request_summary"]
    out["request_pivot"] = with_(REQUESTS, REQUEST_SUMMARY) + f"SELECT batch_size, {cells} FROM summary GROUP BY batch_size"
    out["request_peak"] = with_(REQUESTS, REQUEST_SUMMARY) + (
        "SELECT batch_size, users, round(rps, 6) AS rps FROM summary ORDER BY summary.rps DESC, batch_size, users LIMIT 1"
    )
    out["sweep_grid"] = with_(REQUESTS, REQUEST_SUMMARY) + (
        f"SELECT u.users, b.batch_size, s.requests IS NOT NULL AS measured, coalesce(s.requests, 0) AS requests "
        f"FROM (SELECT unnest({P.SWEEP_USERS}) AS users) u CROSS JOIN (SELECT unnest({P.BATCHES}) AS batch_size) b "
        "LEFT JOIN summary s ON s.users = u.users AND s.batch_size = b.batch_size"
    )
    windows = with_(REQUESTS) + (
        "SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) AS requests, sum(failed)::BIGINT AS failures, "
        "round(avg(response_ms), 6) AS mean_ms, max(response_ms) AS max_ms FROM requests GROUP BY 1"
    )
    out["request_windows"] = windows
    out["stream_request_windows"] = windows
    rates_of = "round(requests / 86400.0, 6) AS rps, round(failures / 86400.0, 6) AS failures_per_s"
    daily = with_(REQUESTS, """daily AS (
  SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) AS requests, sum(failed)::BIGINT AS failures,
         quantile_cont(response_ms, 0.5) AS median_ms, quantile_cont(response_ms, 0.95) AS p95_ms,
         quantile_cont(response_ms, 0.99) AS p99_ms
  FROM requests WHERE ts IS NOT NULL GROUP BY 1)""")
    out["request_percentile_windows"] = daily + (
        f"SELECT start, requests, failures, {rates_of}, {rounded('median_ms', 'p95_ms', 'p99_ms')} FROM daily"
    )
    out["stream_percentile_windows"] = daily + (
        f"SELECT start, requests, failures, {rates_of}, true AS median_ms, true AS p95_ms, true AS p99_ms FROM daily"
    )
    out["stream_dedup"] = (
        "SELECT sha256(text) AS digest FROM (SELECT DISTINCT concat(role, ' ', text) AS text FROM conversations)"
    )
    spaced = "SELECT doc_id, CASE WHEN text = '' OR text[1] = ' ' THEN text ELSE ' ' || text END AS text FROM documents"
    out["bpe_decode"] = spaced
    out["bpe_encode"] = f"SELECT doc_id, strlen(text)::BIGINT AS n_bytes FROM ({spaced})"
    held = with_(*BASE, TEXTS, CLEAN, train)
    out["registry_roundtrip"] = held + "SELECT Source, row_id, true AS same FROM split_rows WHERE split = 'test'"
    out["cached_train"] = held + (
        "SELECT a AS attempt, a = 2 AS reused, Source, row_id, true AS same FROM split_rows, (VALUES (1), (2)) v(a) WHERE split = 'test'"
    )
    out["train_report"] = held + (
        "SELECT 'classic train' AS operation, count_if(split = 'train') AS train_rows, count_if(split = 'test') AS test_rows, "
        "count_if(split = 'test') AS judged FROM split_rows"
    )
    out["stream_score"] = "SELECT concat_ws('-', conv_id, turn) AS msg_id, true AS same FROM conversations"
    out["bpe_roundtrip"] = spaced
    # No look-ahead in this dialect: a mark splits off the last blank of a run before a non-blank.
    white = r"\x{9}-\x{d} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    mark = "\ue000"
    pieces = (
        rf"''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^{white}\p{{L}}\p{{N}}{mark}]+|[{white}]+"
    )
    marked = rf"regexp_replace(text, '([{white}]+)([{white}][^{white}])', '\1{mark}\2', 'g')"
    out["pretoken_counts"] = (
        f"WITH spaced AS ({spaced}), "
        f"words AS (SELECT unnest(regexp_extract_all({marked}, '{pieces}')) AS word FROM spaced) "
        "SELECT word, count(*) AS n FROM words GROUP BY word"
    )
    out["run_records"] = ruled + (
        f"SELECT Source AS run, 'classic rule' AS operation, {rates}, {P.THRESHOLD}::DOUBLE AS threshold, "
        "concat_ws(' ', tn, fp, fn, tp) AS confusion, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS spam_f1, "
        "(tp + fn)::BIGINT AS spam_support FROM metrics"
    )
    return out
