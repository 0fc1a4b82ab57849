"""SQL for DuckDB with the results of queries.py. The fragments mirror functions/text.py in RE2's dialect."""

from __future__ import annotations

from .. import lexicons
from .oracle_stages import stages

_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_INLINE = r"[ \t\r\f\x0b\x1c-\x1f\x{85}\p{Z}]"
_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(c: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({c}, {_q(pattern)}, {to}, 'g')"


def strip(c: str) -> str:
    return sub(c, rf"\A{_WS}+|{_WS}+\z")


def strip_lines(c: str) -> str:
    return sub(c, rf"{_INLINE}*\n{_INLINE}*", "chr(10)")


def newlines(c: str) -> str:
    return sub(c, r"\r\n?", "chr(10)")


def blanks(c: str) -> str:
    return sub(c, r"[ \t\x{3000}]+", "' '")


def clean(c: str) -> str:
    return strip(sub(strip_lines(blanks(f"replace({newlines(c)}, chr(65279), '')")), r"\n{3,}", "chr(10) || chr(10)"))


def count(c: str, pattern: str) -> str:
    return f"len(regexp_extract_all({c}, {_q(pattern)}))"


def compact(c: str) -> str:
    return f"trim({sub(c, f'{_WS}+', chr(39) + ' ' + chr(39))})"


def times(c: str, term: str) -> str:
    return f"CAST((length({c}) - length(replace({c}, {_q(term)}, ''))) / {len(term)} AS INTEGER)"


def has(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, {_q(pattern)})"


_T = "coalesce(text, '')"
_LINES = f"list_filter(list_transform(string_split({_T}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
_CITES = f"len(list_filter(lines, lambda x: {has('x', '|'.join(f'(?:{p})' for p in lexicons.REFERENCE_LINES))}))"
_LONG = f"list_filter(list_transform(string_split({_T}, chr(10)), lambda x: {strip('x')}), lambda x: length(x) >= 8)"
_GARBLED = " + ".join(times(_T, x) for x in lexicons.GARBLED_TOKENS)
_RUNS = f"""
runs AS (SELECT id, max(n) AS run FROM (SELECT id, c, grp, count(*) AS n FROM (
  SELECT id, c, pos - row_number() OVER (PARTITION BY id, c ORDER BY pos) AS grp FROM (
    SELECT id, unnest(cs) AS c, unnest(range(len(cs))) AS pos FROM (SELECT id, regexp_extract_all({_T}, '(?s).') AS cs FROM base))) GROUP BY ALL) GROUP BY id)"""
_REPEATED = """
repeated AS (SELECT id, sum(n) FILTER (n > 1) AS again, sum(n) AS n FROM (SELECT id, line, count(*) AS n FROM (
  SELECT id, unnest(long) AS line FROM lined) GROUP BY ALL) GROUP BY id)"""


def _measures(base: str) -> str:
    """CTEs ending in m: the measures of base (id, text, source)."""
    n = f"greatest(length({sub(_T, '[ ' + chr(92) + 'n' + chr(92) + 't]')}), 1)"
    return f"""
base AS ({base}),
lined AS (SELECT id, {_LINES} AS lines, {_LONG} AS long FROM base),{_RUNS},{_REPEATED},
m AS (SELECT b.id, b.text, b.source, length({_T.replace("text", "b.text")}) AS char_count,
  {count(_T.replace("text", "b.text"), "[一-鿿]")} / {n.replace("text", "b.text")} AS chinese_ratio,
  {count(_T.replace("text", "b.text"), "[A-Za-z]")} / {n.replace("text", "b.text")} AS latin_ratio,
  {count(_T.replace("text", "b.text"), chr(92) + "p{Nd}")} / {n.replace("text", "b.text")} AS digit_ratio,
  len(list_distinct(regexp_extract_all({compact(_T.replace("text", "b.text"))}, '(?s).'))) AS distinct_chars,
  greatest(length({compact(_T.replace("text", "b.text"))}), 1) AS compact_chars,
  {count(_T.replace("text", "b.text"), _CONTROL)} AS control_count,
  {count(_T.replace("text", "b.text"), chr(92) + "p{Co}")} AS private_use_char_count,
  {_GARBLED.replace("text", "b.text")} AS mojibake_count,
  coalesce(r.run, 0) AS repeated_char_run,
  CASE WHEN coalesce(p.n, 0) >= 4 THEN coalesce(p.again, 0) / p.n ELSE 0.0 END AS duplicate_line_ratio,
  {has(_T.replace("text", "b.text"), lexicons.REFERENCE_HEADING)} AS reference_heading,
  {_CITES} AS reference_line_count, len(lines) AS line_count,
  {count(_T.replace("text", "b.text"), "(?i)https?://|www[.]")} AS url_count
  FROM base b JOIN lined l ON b.id = l.id LEFT JOIN runs r ON b.id = r.id LEFT JOIN repeated p ON b.id = p.id)"""


_FIRST = "SELECT id, text, source FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at NULLS FIRST) AS k FROM v2_chunks) WHERE k = 1"
_ONCE = "SELECT DISTINCT id, text, source FROM v2_chunks"
_HITS = " + ".join(f"CAST(contains(lower({_T} || chr(10) || coalesce(source, '')), {_q(k.lower())}) AS INTEGER)" for k in lexicons.KEYWORDS)


def _prefilter() -> str:
    """CTEs ending in f: id, score, fatal, dup, issues."""
    flat = strip(_T)
    boiler = " + ".join(f"CAST({has(flat, p)} AS INTEGER)" for p in lexicons.BOILERPLATE_WHOLE) + " + " + " + ".join(f"CAST({has(_T, p)} AS INTEGER)" for p in lexicons.BOILERPLATE_PART)
    risk = " OR ".join(has(_T, p) for p in lexicons.CHUNK_RISKS)
    rules = [
        ("char_count < 120", "too_short", "5", "true"), ("char_count >= 120 AND char_count < 260", "short_text", "2", "false"), ("char_count > 5000", "too_long", "1", "false"), ("blank", "empty_text", "10", "true"),
        ("control_count > 0", "control_chars", "least(3, 0.5 * control_count)", "false"), ("private_use_char_count > 0", "private_use_chars", "least(6, 0.2 * private_use_char_count)", "private_use_char_count >= 5"),
        ("dense AND mojibake_count > 0", "suspected_mojibake", "6", "true"), ("NOT dense AND mojibake_count > 0", "possible_mojibake", "least(2, 0.05 * mojibake_count)", "false"),
        ("chinese_ratio < 0.25 AND latin_ratio < 0.55", "low_chinese_ratio", "2", "false"), ("digit_ratio > 0.35", "digit_heavy", "1.5", "false"), ("distinct_chars / compact_chars < 0.035", "low_unique_char_ratio", "2", "false"),
        ("repeated_char_run >= 12", "repeated_char_noise", "2", "false"), ("duplicate_line_ratio >= 0.35", "duplicate_line_noise", "2", "false"), ("boiler > 0", "low_value_boilerplate", "least(3, boiler)", "false"),
        ("section", "reference_section", "6", "true"), ("NOT section AND listed", "reference_like_list", "5", "true"), ("NOT section AND NOT listed AND heavy", "reference_heavy", "2", "false"), ("url_count >= 4", "url_heavy", "1", "false"),
        ("hits = 0", "weak_military_relevance", "3", "false"), ("risky", "actionable_harm_risk", "6", "true"),
    ]
    penalty = " + ".join(f"CASE WHEN {c} THEN CAST({p} AS DOUBLE) ELSE 0 END" for c, _, p, _ in rules)
    fatal = " OR ".join(f"({c} AND {f})" for c, _, _, f in rules if f != "false")
    issues = "[" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n, _, _ in rules) + "]"
    return f"""
{_measures(_FIRST)},
w AS (SELECT *, {compact(_T)} = '' AS blank, mojibake_count / greatest(char_count, 1) >= 0.012 OR mojibake_count >= 12 AS dense,
  CASE WHEN line_count > 0 THEN reference_line_count / line_count ELSE 0.0 END AS ref_share, {boiler} AS boiler, {_HITS} AS hits, {risk} AS risky FROM m),
x AS (SELECT *, reference_heading AND reference_line_count >= 4 AS section, reference_line_count >= 4 AND ref_share >= 0.45 AS listed, reference_line_count >= 2 AND ref_share >= 0.6 AS heavy FROM w),
y AS (SELECT id, greatest(0, 10 - ({penalty})) AS s0, {fatal} AS fatal, list_filter({issues}, lambda i: i IS NOT NULL) AS found, sha1(lower({compact(_T)})) AS h FROM x),
z AS (SELECT *, coalesce(min(CASE WHEN s0 >= 5 AND NOT fatal THEN id END) OVER (PARTITION BY h) < id, false) AS dup FROM y),
f AS (SELECT id, fatal, dup, CASE WHEN dup THEN greatest(0, s0 - 5) ELSE s0 END AS score, CASE WHEN dup THEN list_append(found, 'duplicate_text') ELSE found END AS issues FROM z)"""


_KEEP = "score >= 5 AND NOT fatal AND NOT dup"


def _weighted(c: str, weights: dict[str, int]) -> str:
    return " + ".join(f"least({times(c, k)}, 5) * {w}" for k, w in weights.items())


_PAIRS = "SELECT id, sft_question.question AS q, sft_answer.answer AS a, sft_question.question_type AS t, sft_question.status AS qs, sft_answer.status AS s, sft_question.risk_label AS qr, sft_answer.risk_label AS ar FROM sft_answers"
_SQ, _SA = strip("coalesce(q, '')"), strip("coalesce(a, '')")
_RISKS = ", ".join(map(_q, lexicons.RISK_LABELS))
_MARKS = lexicons.SENTENCE_ENDS
_HEAD = f"left({compact(_T)}, 6000)"
_TITLE = "coalesce(title, '')"
_TOKENS = "list_distinct(list_concat(regexp_extract_all({0}, '[a-z0-9_]+|[一-鿿]{{2,}}'), list_filter(list_transform(range(1, greatest(length(regexp_replace({0}, '[^一-鿿]', '', 'g')), 1)), lambda i: substring(regexp_replace({0}, '[^一-鿿]', '', 'g'), CAST(i AS BIGINT), 2)), lambda g: length(g) = 2)))"

ORACLE: dict[str, str] = {
    "clean_documents": f"SELECT doc_id, {clean('text')} AS clean FROM documents",
    "clean_plain_documents": f"""SELECT doc_id, {strip(strip_lines(blanks(sub(newlines(sub(sub(sub("text", "<[^>]+>"), "https?://[^" + _WS[1:-1] + "]+"), _CONTROL)), chr(92) + "n{3,}", "chr(10) || chr(10)"))))} AS clean FROM documents""",
    "clean_wiki_documents": f"""SELECT doc_id, {strip(sub(strip_lines(blanks(newlines(sub("text", _CONTROL)))), chr(92) + "n{2,}", "chr(10)"))} AS clean FROM documents""",
    "clean_lines": f"""
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
  {strip(blanks(sub(sub(sub(sub("line", r"!\[[^\]]*\]\([^)]+\)"), r"\[([^\]]+)\]\([^)]+\)", _q(chr(92) + "1")), "<[^>]+>"), _CONTROL)))} AS markdown,
  replace(replace({strip(blanks(sub("line", _CONTROL)))}, 'ﬁ', 'fi'), 'ﬂ', 'fl') AS pdf
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents)""",
    "pdf_noise_lines": f"""
SELECT id, CAST(line_no AS INTEGER) AS line_no FROM (SELECT id, line_no, replace(replace({strip(blanks(sub("line", _CONTROL)))}, 'ﬁ', 'fi'), 'ﬂ', 'fl') AS line
  FROM (SELECT id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM pdf_chunks))
WHERE line = '' OR {" OR ".join(has("line", p) for p in lexicons.PDF_NOISE)}""",
    "text_lengths": f"SELECT doc_id, CAST(length({_T}) AS INTEGER) AS n, CAST(length({sub(_T, f'{_WS}+')}) AS INTEGER) AS ink, CAST(length({compact(_T)}) AS INTEGER) AS compact FROM documents",
    "middle_truncate": f"SELECT doc_id, CASE WHEN length(text) > 500 THEN {strip('left(text, 250)')} || chr(10) || '...' || chr(10) || {strip('right(text, 250)')} ELSE text END AS short FROM documents",
    "file_names": f"""SELECT DISTINCT id, coalesce(nullif(left({sub(sub(sub("title", '[' + chr(92) * 2 + '/:*?"<>|' + chr(92) + 'x00-' + chr(92) + 'x1f]', "'_'"), f"{_WS}+", "'_'"), r"\A[._ ]+|[._ ]+\z")}, 90), ''), 'untitled') AS name FROM v2_chunks""",
    "text_hashes": f"SELECT doc_id, sha1({sub('text', f'{_WS}+')}) AS strict, sha1(lower({compact('text')})) AS compact FROM documents",
    "garbled_scores": f"SELECT DISTINCT id, CAST({count(_T, f'[{lexicons.GARBLED_SIGNS}]')} - {count(_T, f'[{lexicons.COMMON_SIGNS}]')} // 8 AS INTEGER) AS score FROM v2_chunks",
    "wiki_tail_cut": f"SELECT doc_id, CASE WHEN {has('text', lexicons.WIKI_TAIL)} THEN {strip(sub('text', '(?s)' + lexicons.WIKI_TAIL + '.*' + chr(92) + 'z'))} ELSE text END AS kept FROM documents",
    "repeats": f"""
WITH base AS (SELECT doc_id AS id, text FROM documents), lined AS (SELECT id, {_LONG} AS long FROM base),{_RUNS},{_REPEATED}
SELECT b.id AS doc_id, CAST(coalesce(r.run, 0) AS INTEGER) AS longest_run, CASE WHEN coalesce(p.n, 0) >= 4 THEN coalesce(p.again, 0) / p.n ELSE 0.0 END AS duplicate_lines,
  len(list_distinct(regexp_extract_all({compact(_T)}, '(?s).'))) / greatest(length({compact(_T)}), 1) AS unique_ratio
FROM base b LEFT JOIN runs r ON b.id = r.id LEFT JOIN repeated p ON b.id = p.id""",
    "paragraphs": f"""
WITH c AS (SELECT doc_id, {clean("text")} AS t FROM documents),
p AS (SELECT doc_id, CASE WHEN len(a) = 1 THEN regexp_split_to_array(t, '\\n+') ELSE a END AS parts FROM (SELECT doc_id, t, regexp_split_to_array(t, {_q(chr(92) + "n" + _WS + "*" + chr(92) + "n")}) AS a FROM c)),
k AS (SELECT doc_id, list_filter(list_transform(parts, lambda x: {strip("x")}), lambda x: length(x) >= 20) AS kept FROM p)
SELECT doc_id, CAST(unnest(range(len(kept))) AS INTEGER) AS n, unnest(kept) AS paragraph FROM k""",
    "sentences": f"""
WITH k AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([{_MARKS}])', '\\1' || chr(1), 'g'), chr(1)), lambda x: {strip("x")}), lambda x: x <> '') AS kept FROM documents WHERE NOT contains(coalesce(text, ''), chr(1))
  UNION ALL SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([{_MARKS}])', '\\1' || chr(57343 - 2047), 'g'), chr(57343 - 2047)), lambda x: {strip("x")}), lambda x: x <> '') FROM documents WHERE false)
SELECT doc_id, CAST(unnest(range(len(kept))) AS INTEGER) AS n, unnest(kept) AS sentence FROM k""",
    "measures": f"""
WITH {_measures(_ONCE)}
SELECT id, CAST(char_count AS INTEGER) AS char_count, chinese_ratio, latin_ratio, digit_ratio, distinct_chars / compact_chars AS unique_ratio, CAST(control_count AS INTEGER) AS control_count, CAST(private_use_char_count AS INTEGER) AS private_use_char_count,
  CAST(mojibake_count AS INTEGER) AS mojibake_count, mojibake_count / greatest(char_count, 1) AS mojibake_density, CAST(repeated_char_run AS INTEGER) AS repeated_char_run, duplicate_line_ratio, reference_heading,
  CAST(reference_line_count AS INTEGER) AS reference_line_count, CAST(line_count AS INTEGER) AS line_count, CASE WHEN line_count > 0 THEN reference_line_count / line_count ELSE 0.0 END AS reference_line_ratio, CAST(url_count AS INTEGER) AS url_count FROM m""",
    "prefilter_rows": f"WITH {_prefilter()} SELECT id, {_KEEP} AS keep, CAST(round(score * 100) AS BIGINT) AS score100, CASE WHEN score >= 8 THEN 'good' WHEN score >= 5 THEN 'usable' WHEN score >= 3 THEN 'poor' ELSE 'reject' END AS quality_level, array_to_string(issues, ',') AS issues FROM f",
    "prefilter_totals": f"WITH {_prefilter()} SELECT count(*) AS total, count(*) FILTER ({_KEEP}) AS kept, count(*) FILTER (NOT ({_KEEP})) AS rejected FROM f",
    "prefilter_issues": f"WITH {_prefilter()} SELECT issue, count(*) AS n FROM (SELECT unnest(issues) AS issue FROM f) GROUP BY issue",
    "prefilter_sources": "SELECT coalesce(nullif(split_part(replace(source, chr(92), '/'), '/', 1), ''), 'unknown') AS source_prefix, count(DISTINCT id) AS n FROM v2_chunks GROUP BY 1",
    "prefilter_buckets": f"WITH {_prefilter()} SELECT CAST(floor(score) AS INTEGER) AS bucket, count(*) AS n FROM f GROUP BY 1",
    "keyword_hits": " UNION ".join(f"SELECT id, {_q(k)} AS term FROM v2_chunks WHERE contains(lower({_T} || chr(10) || coalesce(source, '')), {_q(k.lower())})" for k in lexicons.KEYWORDS),
    "top_keywords": "SELECT term, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT DISTINCT id, {_q(k)} AS term FROM v2_chunks WHERE contains(lower({_T}), {_q(k.lower())})" for k in lexicons.KEYWORDS) + ") GROUP BY term ORDER BY n DESC, term LIMIT 20",
    "relevant_rows": f"""
WITH b AS (SELECT id, {_TITLE} AS title, {_HEAD} AS head FROM (SELECT DISTINCT id, title, text FROM v2_chunks)),
s AS (SELECT id, {_weighted("title", lexicons.TITLE_WEIGHTS)} AS title_score, {_weighted("head", lexicons.BODY_WEIGHTS)} AS body_score, {has("title", lexicons.EXCLUDED_TITLES)} AS x, {" OR ".join(has("head", p) for p in lexicons.PAGE_RISKS)} AS r FROM b),
t AS (SELECT *, title_score + body_score - CASE WHEN x THEN 20 ELSE 0 END - CASE WHEN r THEN 20 ELSE 0 END AS score FROM s)
SELECT id, CAST(title_score AS INTEGER) AS title_score, CAST(body_score AS INTEGER) AS body_score, CAST(score AS INTEGER) AS score, score >= 12 AND title_score >= 7 AND NOT x AND NOT r AS keep FROM t""",
    "dedup_first_wins": f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha1({sub(_T, f'{_WS}+')})",
    "dedup_skipped": f"SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS distinct_texts, CAST(sum(n - 1) AS BIGINT) AS skipped FROM (SELECT count(*) AS n FROM documents GROUP BY sha1({sub(_T, f'{_WS}+')}))",
    "id_rewrite": """
WITH r AS (SELECT id, dataset_source, row_number() OVER (PARTITION BY id ORDER BY ingested_at NULLS FIRST) > 1 AS again FROM v2_chunks)
SELECT CASE WHEN again THEN concat_ws('/', dataset_source, id) ELSE id END AS id, count(*) AS n, max(CAST(again AS INTEGER)) AS rewritten FROM r GROUP BY 1""",
    "union_provenance": """
SELECT 'v2' AS dataset_version, 'documents' AS dataset_source, 0 AS source_rank, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(0 AS BIGINT) AS paged FROM documents
UNION ALL SELECT 'v2', 'chunks', 1, count(*), CAST(sum(length(text)) AS BIGINT), 0 FROM v2_chunks
UNION ALL SELECT 'v2', 'pdf', 2, count(*), CAST(sum(length(text)) AS BIGINT), count(page_start) FROM pdf_chunks""",
    "resume_rows": "SELECT DISTINCT id FROM v2_chunks WHERE id NOT IN (SELECT id FROM chunk_labels WHERE id IS NOT NULL)",
    "resume_groups": """
WITH g AS (SELECT material_id AS id, max(question_count) AS expected FROM sft_answers GROUP BY 1),
w AS (SELECT id, expected, id || '#q' || lpad(CAST(k AS VARCHAR), 4, '0') AS child FROM (SELECT id, expected, unnest(range(1, expected + 1)) AS k FROM g))
SELECT DISTINCT id, expected FROM w WHERE child NOT IN (SELECT id FROM sft_answers WHERE id IS NOT NULL AND sft_answer.status = 'ok')""",
    "split_parts": "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // ((count(*) OVER () + 3) // 4) + 1 AS INTEGER) AS part FROM documents",
    "rejected_head": f"WITH {_prefilter()} SELECT id FROM f WHERE NOT ({_KEEP}) ORDER BY id LIMIT 200",
    "source_stats": """
WITH d AS (SELECT DISTINCT id, text, dataset_source FROM v2_chunks), r AS (SELECT *, row_number() OVER (PARTITION BY dataset_source ORDER BY id) AS k FROM d)
SELECT dataset_source, count(*) AS chunks, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS chars, string_agg(id, '|' ORDER BY id) FILTER (k <= 3) AS first_ids FROM r GROUP BY 1""",
    "length_stats": f"SELECT count(*) AS n, CAST(min(k) AS INTEGER) AS shortest, CAST(max(k) AS INTEGER) AS longest, CAST(sum(k) AS BIGINT) AS total, round(avg(k), 2) AS average, count(DISTINCT title) AS titles FROM (SELECT title, length({sub('text', f'{_WS}+')}) AS k FROM v2_chunks)",
    "category_counts": "SELECT coalesce(nullif(category, ''), nullif(site, ''), 'unknown') AS category, count(*) AS n FROM v2_chunks GROUP BY 1",
    "url_normal": """
SELECT DISTINCT id, CASE WHEN regexp_matches(u, '^(?i)https?://[^/?]+') THEN lower(regexp_extract(u, '^(?i)(https?://[^/?]+)', 1)) || regexp_replace(u, '^(?i)https?://[^/?]+', '') END AS url,
  coalesce(regexp_matches(url, '^(?i)https?://[^/?#]+/wiki/'), false) AS wiki FROM (SELECT id, url, regexp_replace(trim(url), '#.*$', '') AS u FROM v2_chunks)""",
    "pair_risks": f"SELECT DISTINCT id, CASE WHEN ar IN ({_RISKS}) THEN ar WHEN qr IN ({_RISKS}) THEN qr ELSE 'public_safe' END AS risk FROM ({_PAIRS})",
    "label_numbers": """
SELECT CASE side WHEN 'fact' THEN 'F' WHEN 'operation' THEN 'O' ELSE 'X' END || lpad(CAST(row_number() OVER (PARTITION BY side ORDER BY source_path, level1, level2, level3) AS VARCHAR), 4, '0') AS label_id, side, source_path, level1, level2, level3 FROM taxonomy_leaves""",
    "label_candidates": f"""
WITH q AS (SELECT DISTINCT id, coalesce(sft_question.question, '') AS t, lower(coalesce(sft_question.question, '')) AS w FROM sft_answers),
qt AS (SELECT id, t, w, {_TOKENS.format("w")} AS tt FROM q),
l AS (SELECT label_id, CASE side WHEN 'friendly' THEN '我方' WHEN 'opponent' THEN '他方' ELSE side END AS l0, level1 AS l1, level2 AS l2, level3 AS l3, full_path FROM taxonomy_leaves),
lp AS (SELECT *, lower(concat_ws(' ', full_path, l0, l1, l2, l3)) AS p FROM l),
lt AS (SELECT *, {_TOKENS.format("p")} AS lk FROM lp),
s AS (SELECT id, label_id, {" + ".join(f"CASE WHEN coalesce({c}, '') <> '' AND contains(w, lower({c})) THEN 8.0 ELSE 0 END" for c in ("l0", "l1", "l2", "l3"))} + CASE WHEN contains(t, coalesce(l1, '')) THEN 3.0 ELSE 0 END + CASE WHEN contains(t, coalesce(l2, '')) THEN 4.0 ELSE 0 END
  + 1.5 * len(list_intersect(tt, lk)) AS score FROM qt CROSS JOIN lt),
r AS (SELECT id, label_id, CAST(score AS DOUBLE) AS score, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, label_id) AS INTEGER) AS rank FROM s)
SELECT * FROM r WHERE rank <= 10""",
    "shard_rows": """
WITH RECURSIVE s AS (SELECT doc_id, strlen(CAST(to_json({'doc_id': doc_id, 'text': text}) AS VARCHAR)) + 1 AS size, row_number() OVER (ORDER BY doc_id) AS k FROM documents),
r AS (SELECT doc_id, size, k, size AS used, 0 AS shard FROM s WHERE k = 1
  UNION ALL SELECT s.doc_id, s.size, s.k, CASE WHEN r.used + s.size > 1000000 THEN s.size ELSE r.used + s.size END, r.shard + CASE WHEN r.used + s.size > 1000000 THEN 1 ELSE 0 END FROM r JOIN s ON s.k = r.k + 1)
SELECT CAST(shard AS INTEGER) AS shard, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes, min(doc_id) AS first_id FROM r GROUP BY shard""",
    "chunk_totals": f"SELECT source, count(*) AS chunks, CAST(coalesce(sum(length({sub('text', f'{_WS}+')})), 0) AS BIGINT) AS chars FROM pdf_chunks GROUP BY source",
    "relevance_buckets": """
WITH t AS (SELECT score FROM (relevant_rows_sql))
SELECT CAST(least(greatest(score, 0), 99) // 5 * 5 AS INTEGER) AS bucket, count(*) AS n FROM t GROUP BY 1""",
    "label_forms": """
SELECT label_id AS id, CASE WHEN label_id LIKE 'F%' THEN 'friendly' WHEN label_id LIKE 'O%' THEN 'opponent' ELSE '' END AS side, CASE WHEN label_id LIKE 'F%' THEN '我方' WHEN label_id LIKE 'O%' THEN '他方' ELSE side END AS side_name, level1 AS l1, level2 AS l2, level3 AS leaf,
  CASE WHEN label_id LIKE 'F%' THEN '我方>' WHEN label_id LIKE 'O%' THEN '他方>' ELSE side || '>' END || full_path AS path FROM taxonomy_leaves""",
}
_INK = lambda c: f"length({sub(c, f'{_WS}+')})"
_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
#: Folds over lists, one step of all documents at a time: what is held is passed on, joined or begun anew.
ORACLE["chunks_wiki"] = f"""
WITH RECURSIVE lines AS (SELECT doc_id, list_filter(list_transform(string_split({sub(_T, _BREAKS, "chr(10)")}, chr(10)), lambda x: {strip(blanks("x"))}), lambda x: x <> '') AS ls FROM documents),
flat AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS k FROM lines),
marked AS (SELECT *, CASE WHEN {has("line", "^##+" + chr(92) + "s*(.+?)" + chr(92) + "s*#*$")} THEN trim(regexp_extract(line, '^##+\\s*(.+?)\\s*#*$', 1)) END AS head FROM flat),
grouped AS (SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY k) AS g FROM marked),
units AS (SELECT doc_id, g, max(head) AS section, {strip("string_agg(line, chr(10) ORDER BY k) FILTER (head IS NULL)")} AS t FROM grouped GROUP BY doc_id, g),
held AS (SELECT doc_id, list({{'t': t, 's': section, 'n': {_INK("t")}}} ORDER BY g) AS us FROM units WHERE coalesce(t, '') <> '' GROUP BY doc_id),
fold AS (SELECT doc_id, us, 0 AS i, CAST(NULL AS VARCHAR) AS t, CAST(NULL AS VARCHAR) AS s, CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(t VARCHAR, s VARCHAR, n BIGINT)[]) AS found FROM held
  UNION ALL
  SELECT doc_id, us, i + 1, CASE WHEN now.n >= 900 THEN NULL ELSE now.t END, CASE WHEN now.n >= 900 THEN NULL ELSE now.s END, CASE WHEN now.n >= 900 THEN 0 ELSE now.n END,
    list_concat(found, list_concat(CASE WHEN over AND n >= 180 THEN [{{'t': t, 's': s, 'n': n}}] ELSE [] END, CASE WHEN now.n >= 900 THEN [now] ELSE [] END))
  FROM (SELECT *, t IS NOT NULL AND n + us[i + 1].n > 1600 AS over, CASE WHEN t IS NULL OR n + us[i + 1].n > 1600 THEN {{'t': us[i + 1].t, 's': us[i + 1].s, 'n': us[i + 1].n}}
    ELSE {{'t': t || chr(10) || us[i + 1].t, 's': coalesce(s, us[i + 1].s), 'n': n + us[i + 1].n}} END AS now FROM fold WHERE i < len(us))),
packed AS (SELECT doc_id, list_concat(found, CASE WHEN t IS NOT NULL AND n >= 180 THEN [{{'t': t, 's': s, 'n': n}}] ELSE [] END) AS cs FROM fold WHERE i = len(us)),
chunk AS (SELECT doc_id, unnest(cs) AS c, unnest(range(len(cs))) AS k FROM packed),
sized AS (SELECT doc_id, k, c.s AS s, CASE WHEN c.n <= 1600 THEN [c.t] END AS whole, list_filter(list_transform(string_split(regexp_replace(c.t, '([。！？!?])', '\\1' || chr(57344), 'g'), chr(57344)), lambda x: {strip("x")}), lambda x: x <> '') AS ps FROM chunk),
cut AS (SELECT doc_id, k, s, ps, 0 AS i, '' AS t, CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS found FROM sized WHERE whole IS NULL
  UNION ALL
  SELECT doc_id, k, s, ps, i + 1, CASE WHEN m > 1600 THEN '' WHEN n + m > 1600 THEN p ELSE t || p END, CASE WHEN m > 1600 THEN 0 WHEN n + m > 1600 THEN m ELSE n + m END,
    list_concat(found, list_concat(CASE WHEN t <> '' AND n + m > 1600 THEN [t] ELSE [] END, CASE WHEN m > 1600 THEN list_transform(range(0, length(p), 1600), lambda x: substring(p, CAST(x + 1 AS BIGINT), 1600)) ELSE [] END))
  FROM (SELECT *, ps[i + 1] AS p, {_INK("ps[i + 1]")} AS m FROM cut WHERE i < len(ps))),
pieces AS (SELECT doc_id, k, s, whole AS parts FROM sized WHERE whole IS NOT NULL UNION ALL SELECT doc_id, k, s, list_concat(found, CASE WHEN t <> '' THEN [t] ELSE [] END) FROM cut WHERE i = len(ps)),
spread AS (SELECT doc_id, k, s, unnest(parts) AS t, unnest(range(len(parts))) AS j FROM pieces),
final AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k, j) AS x FROM (SELECT doc_id, k, j, s, {strip("t")} AS t FROM spread) WHERE {_INK("t")} >= 180)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_id || '#' || lpad(CAST(x AS VARCHAR), 5, '0') AS id, CAST(x AS INTEGER) AS chunk_index, t AS text, s AS section, CAST({_INK("t")} AS INTEGER) AS char_count FROM final"""
ORACLE["packed_paragraphs"] = f"""
WITH RECURSIVE p AS ({ORACLE["paragraphs"]}),
cut AS (SELECT doc_id, n, list_filter(list_transform(string_split(regexp_replace(paragraph, '([{_MARKS}])', '\\1' || chr(57344), 'g'), chr(57344)), lambda x: {strip("x")}), lambda x: x <> '') AS ps, 0 AS i, '' AS t, CAST([] AS VARCHAR[]) AS found, CAST(0 AS BIGINT) AS used FROM p WHERE length(paragraph) > 1800
  UNION ALL
  SELECT doc_id, n, ps, i + 1, CASE WHEN t <> '' AND used + length(ps[i + 1]) > 1800 THEN ps[i + 1] ELSE t || ps[i + 1] END, CASE WHEN t <> '' AND used + length(ps[i + 1]) > 1800 THEN list_append(found, t) ELSE found END,
    CASE WHEN t <> '' AND used + length(ps[i + 1]) > 1800 THEN length(ps[i + 1]) ELSE used + length(ps[i + 1]) END FROM cut WHERE i < len(ps)),
long AS (SELECT doc_id, n, list_append(found, t) AS runs FROM cut WHERE i = len(ps)),
runs AS (SELECT doc_id, n, unnest(runs) AS r, unnest(range(len(runs))) AS k FROM long),
slices AS (SELECT doc_id, n, k, list_transform(range(0, length(r), 1800), lambda x: substring(r, CAST(x + 1 AS BIGINT), 1800)) AS ss FROM runs),
parts AS (SELECT doc_id, n, 0 AS k, 0 AS j, paragraph AS t FROM p WHERE length(paragraph) <= 1800 UNION ALL SELECT doc_id, n, k, unnest(range(len(ss))), unnest(ss) FROM slices),
docs AS (SELECT doc_id, list(t ORDER BY n, k, j) AS ts FROM parts GROUP BY doc_id),
fold AS (SELECT doc_id, ts, 0 AS i, CAST(NULL AS VARCHAR) AS t, CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS found FROM docs
  UNION ALL
  SELECT doc_id, ts, i + 1, CASE WHEN now.n >= 900 THEN NULL ELSE now.t END, CASE WHEN now.n >= 900 THEN 0 ELSE now.n END, list_concat(found, list_concat(CASE WHEN over THEN [t] ELSE [] END, CASE WHEN now.n >= 900 THEN [now.t] ELSE [] END))
  FROM (SELECT *, t IS NOT NULL AND n + length(ts[i + 1]) + 2 > 1800 AS over,
    CASE WHEN t IS NULL OR n + length(ts[i + 1]) + 2 > 1800 THEN {{'t': ts[i + 1], 'n': length(ts[i + 1]) + 2}} ELSE {{'t': t || chr(10) || chr(10) || ts[i + 1], 'n': n + length(ts[i + 1]) + 2}} END AS now FROM fold WHERE i < len(ts))),
ended AS (SELECT doc_id, list_filter(list_concat(found, CASE WHEN t IS NOT NULL THEN [t] ELSE [] END), lambda x: length({strip("x")}) >= 80) AS cs FROM fold WHERE i = len(ts)),
flat AS (SELECT doc_id, unnest(cs) AS t, unnest(range(1, len(cs) + 1)) AS x FROM ended)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_id || '#' || lpad(CAST(x AS VARCHAR), 5, '0') AS id, CAST(x AS INTEGER) AS chunk_index, {strip("t")} AS text, CAST({_INK("t")} AS INTEGER) AS char_count FROM flat"""


def _chunks_plain() -> str:
    """As chunks_wiki from the units on, with other sizes and units, and a text that gives no chunk cut as it is."""
    clean_text = ORACLE["clean_plain_documents"]
    heading = f"length(line) <= 80 AND ({has('line', lexicons.CHAPTER)} OR {has('line', lexicons.PAREN_NUMBER)} OR line IN ({', '.join(map(_q, lexicons.SECTION_WORDS))}))"
    speakers = lexicons.SPEAKERS
    head = f"""
WITH RECURSIVE cleaned AS (SELECT doc_id, coalesce(clean, '') AS text FROM ({clean_text})),
lines AS (SELECT doc_id, list_transform(string_split({sub("text", _BREAKS, "chr(10)")}, chr(10)), lambda x: {strip("x")}) AS ls FROM cleaned),
flat AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS k FROM lines),
marked AS (SELECT *, line = '目录' AS toc, line <> '' AND line <> '目录' AND {heading} AS head FROM flat),
stated AS (SELECT *, coalesce(last_value(CASE WHEN toc THEN 1 WHEN head THEN 0 END IGNORE NULLS) OVER w, 0) = 1 AS contents, last_value(CASE WHEN head THEN line END IGNORE NULLS) OVER w AS section, count(CASE WHEN line = '' OR toc OR head THEN 1 END) OVER w AS g
  FROM marked WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
blocks AS (SELECT doc_id, g, max(section) AS section, {strip("string_agg(line, chr(10) ORDER BY k)")} AS body FROM stated WHERE line <> '' AND NOT toc AND NOT head AND NOT contents GROUP BY doc_id, g),
turns AS (SELECT doc_id, g, section, CASE WHEN len(regexp_extract_all(body, {_q(speakers)})) >= 2 THEN list_filter(list_transform(string_split(regexp_replace(body, {_q(speakers)}, chr(57344) || '\\0', 'g'), chr(57344)), lambda x: {strip("x")}), lambda x: x <> '') ELSE [body] END AS ts FROM blocks),
units AS (SELECT doc_id, g * 100000 + unnest(range(len(ts))) AS g, section, unnest(ts) AS t FROM turns),
held AS ("""
    rest = ORACLE["chunks_wiki"].split("\nheld AS (", 1)[1]
    rest = rest.replace("1600", "1800").replace(">= 180)", ">= 60)").replace("n >= 180 ", "n >= 60 ").replace(">= 180", ">= 60").replace("([。！？!?])", f"([{lexicons.SENTENCE_ENDS}])")
    whole = f"SELECT doc_id, 0 AS k, NULL AS s, text AS t, {_INK('text')} AS n FROM cleaned WHERE {_INK('text')} >= 60"
    main, last = rest.rsplit("\nSELECT CAST(doc_id AS VARCHAR)", 1)
    again = main[main.index("sized AS (") :].replace("c.s AS s", "s").replace("c.n", "n").replace("c.t", "t").replace("FROM chunk)", f"FROM ({whole}) WHERE doc_id NOT IN (SELECT doc_id FROM final))")
    for name in ("sized", "cut", "pieces", "spread", "final"):
        again = again.replace(f"{name} AS (", f"{name}2 AS (").replace(f"FROM {name} ", f"FROM {name}2 ").replace(f"FROM {name})", f"FROM {name}2)")
    again = again.replace("NOT IN (SELECT doc_id FROM final2)", "NOT IN (SELECT doc_id FROM final)")
    return f"{head}{main},\n{again}\nSELECT CAST(doc_id AS VARCHAR){last} UNION ALL SELECT CAST(doc_id AS VARCHAR){last}2"


ORACLE["chunks_plain"] = _chunks_plain()
ORACLE["references_cut"] = f"""
WITH c AS (SELECT doc_id, {clean("text")} AS t FROM documents), l AS (SELECT *, string_split(t, chr(10)) AS ls FROM c),
h AS (SELECT *, list_filter(range(len(ls)), lambda i: {has(strip("ls[i + 1]"), lexicons.REFERENCE_CUT)}) AS heads FROM l)
SELECT doc_id, coalesce(list_filter(list_transform(heads, lambda i: {strip("array_to_string(ls[1:i], chr(10))")}), lambda x: length(x) >= 100)[1], t) AS kept FROM h"""
ORACLE["relevance_buckets"] = ORACLE["relevance_buckets"].replace("relevant_rows_sql", ORACLE["relevant_rows"])
ORACLE |= stages(_PAIRS, _SQ, _SA)
