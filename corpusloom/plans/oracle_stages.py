"""SQL for DuckDB of the instruction stages, from their rules: replies are JSON, plans are lists cut by running sums."""

from __future__ import annotations

from .. import lexicons
from . import replies


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(map(_q, values)) + ")"


def _rows(reply: str) -> str:
    return f"SELECT *, row_number() OVER () AS rid, CAST({reply} AS JSON) AS j FROM (SELECT *, {', '.join(replies.NUMBERS)} FROM sft_answers)"


def _s(name: str, j: str = "j") -> str:
    """The text of a field, '' for nothing and zero."""
    return f"coalesce(CASE WHEN json_extract_string({j}, '$.{name}') = '0' AND json_type({j}, '$.{name}') <> 'VARCHAR' THEN '' ELSE json_extract_string({j}, '$.{name}') END, '')"


def _n(name: str, j: str = "j") -> str:
    return f"CAST(round_even(TRY_CAST(trim(json_extract_string({j}, '$.{name}')) AS DOUBLE), 0) AS BIGINT)"


def _enum(text: str, allowed: tuple[str, ...], default: str) -> str:
    return f"CASE WHEN trim({text}) IN {_in(allowed)} THEN trim({text}) ELSE {default} END"


def _list(name: str, j: str = "j") -> str:
    """Issues and the like: a text is a list of one, what is no list is empty."""
    return f"CASE json_type({j}, '$.{name}') WHEN 'VARCHAR' THEN [json_extract_string({j}, '$.{name}')] WHEN 'ARRAY' THEN CAST(json_extract({j}, '$.{name}') AS VARCHAR[]) ELSE [] END"


def _risk(j: str = "j") -> str:
    return f"CASE WHEN {_s('risk_label', j)} = '' THEN 'public_safe' ELSE {_enum(_s('risk_label', j), lexicons.RISK_LABELS, chr(39) + 'needs_caution' + chr(39))} END"


def _judge(threshold: int, blocked: str) -> str:
    """Rows of id, j and a verdict."""
    flag = f"""CASE WHEN json_type(j, '$.pass_filter') IS NULL THEN score >= {threshold} WHEN json_type(j, '$.pass_filter') = 'VARCHAR' THEN lower(trim(json_extract_string(j, '$.pass_filter'))) IN ('true', '1', 'yes', 'y')
  WHEN json_type(j, '$.pass_filter') = 'NULL' THEN false ELSE json_extract_string(j, '$.pass_filter') NOT IN ('false', '0') END"""
    action = _enum(_s("suggested_action"), lexicons.ACTIONS, f"CASE WHEN score >= {threshold} THEN 'keep' ELSE 'drop' END")
    return f"""
SELECT *, array_to_string({_list("issues")}, ',') AS issues, {flag} AND score >= {threshold} AND NOT ({blocked}) AS pass_filter, trim({_s("reason")}) AS reason, {action} AS suggested_action, {_risk()} AS risk_label, coalesce(nullif({_s("status")}, ''), 'ok') AS status,
  coalesce(nullif({_s("quality_level")}, ''), CASE WHEN score <= 2 THEN '不可用' WHEN score <= 4 THEN '较差' WHEN score <= 6 THEN '可用' WHEN score <= 8 THEN '良好' ELSE '优秀' END) AS quality_level,
  trim({_s("rewrite_suggestion")}) AS rewrite_suggestion, {_ISSUE} AS answer_issue_type
FROM (SELECT *, CAST(greatest(0, least(10, coalesce({_n("score")}, 0))) AS INTEGER) AS score FROM ({_rows(replies.VERDICT)}))"""


_ISSUE = _enum(_s("answer_issue_type"), lexicons.ISSUE_TYPES, "'none'")
_FIELDS = "issues, score, pass_filter, quality_level, reason, suggested_action, risk_label, status"


def _plan(separators: str, count: str) -> str:
    """CTEs ending in given: rid, id, j, cnt, plan (a list of t, c, r)."""
    kind = "json_type(j, '$.question_type_plan')"
    counted = "CAST(round_even(TRY_CAST(json_extract_string(x, '$.count') AS DOUBLE), 0) AS BIGINT)"
    types = "json_type(j, '$.recommended_question_types')"
    return f"""
raw AS ({_rows(replies.EVAL)}),
items AS (SELECT *, list_filter(CASE {kind} WHEN 'ARRAY' THEN CAST(json_extract(j, '$.question_type_plan') AS JSON[]) ELSE [] END, lambda x: json_type(x) = 'OBJECT') AS xs,
  list_filter(list_transform(CASE {types} WHEN 'VARCHAR' THEN regexp_split_to_array(json_extract_string(j, '$.recommended_question_types'), '{separators}') WHEN 'ARRAY' THEN CAST(json_extract(j, '$.recommended_question_types') AS VARCHAR[]) ELSE [] END,
    lambda x: trim(x)), lambda x: x IN {_in(lexicons.QUESTION_TYPES)}) AS ts0 FROM raw),
known AS (SELECT *, list_filter(list_transform(xs, lambda x: {{'t': trim(coalesce(json_extract_string(x, '$.question_type'), '')), 'c': coalesce({counted}, 1), 'r': trim(coalesce(json_extract_string(x, '$.reason'), ''))}}), lambda p: p.c >= 1 AND p.t IN {_in(lexicons.QUESTION_TYPES)}) AS ps,
  coalesce(list_sum(list_transform(xs, lambda x: greatest(0, coalesce({counted}, 0)))), 0) AS asked, list_filter(ts0, lambda x, i: list_position(ts0, x) = i) AS ts1 FROM items),
sized AS (SELECT *, {count} AS cnt, CASE WHEN len(ts1) > 0 THEN ts1 ELSE ['qa'] END AS ts FROM known),
given AS (SELECT rid, id, j, cnt, CASE WHEN len(ps) > 0 THEN ps ELSE list_filter(list_transform(ts, lambda t, i: {{'t': t, 'c': CASE WHEN i < len(ts) THEN CASE WHEN i <= coalesce(cnt, 0) THEN 1 ELSE 0 END ELSE greatest(coalesce(cnt, 0) - (i - 1), 0) END, 'r': '{lexicons.FALLBACK_REASON}'}}), lambda p: p.c >= 1) END AS plan FROM sized)"""


def _cut(total: str) -> str:
    return f"""
flat AS (SELECT rid, {total} AS total, unnest(plan) AS p, unnest(range(len(plan))) AS i FROM given),
cut AS (SELECT * FROM (SELECT *, least(p.c, greatest(0, total - coalesce(sum(p.c) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS c FROM flat) WHERE c > 0)"""


_COUNT = f"greatest(0, coalesce({_n('recommended_question_count')}, CASE WHEN asked > 0 THEN asked ELSE 1 END))"
_SPACE = chr(92) + "s"
_TYPES = "coalesce(planned_question_type, '')"
_PREFIX = "^(?:(?:" + "|".join(lexicons.CONTEXT_PREFIXES) + ")[ ：:,，]*)+"


def _verdict_of(cases: list[tuple[str, dict]]) -> str:
    """Columns of a verdict that needs no judge, one CASE each."""
    base = {"pass_filter": "false", "risk_label": "'public_safe'", "status": "'ok'"}
    names = dict.fromkeys(k for _, c in cases for k in (*c, *base))
    return ", ".join("CASE " + " ".join(f"WHEN {w} THEN {({**base, **c})[k]}" for w, c in cases) + f" END AS {k}" for k in names)


def stages(pairs: str, sq: str, sa: str) -> dict[str, str]:
    """pairs: SQL of id, q, a, t, qs, s, qr, ar; sq and sa: the trimmed question and answer."""
    phrases = "(" + " OR ".join(f"contains({{0}}, {_q(p)})" for p in lexicons.CONTEXT_PHRASES) + ")"
    bare = "x"
    for p in lexicons.CONTEXT_PHRASES:
        bare = f"replace({bare}, {_q(p)}, '')"
    why = {k: _q(v) for k, v in lexicons.CHECK_REASONS.items()}
    case = lambda score, level, reason, issue, action, **more: {"score": str(score), "quality_level": _q(level), "reason": reason, "issues": _q(issue), "suggested_action": _q(action), **more}
    question = [
        ("x = ''", case(0, "不可用", why["empty_question"], "empty_question", "drop", rewrite_suggestion="''")),
        (phrases.format("x"), case(2, "不可用", why["depends_on_source_context"], "depends_on_source_context", "rewrite", rewrite_suggestion=f"trim(regexp_replace({bare}, '^[，,。:：\\s]+', ''))")),
        ("length(x) < 8", case(2, "不可用", why["too_short"], "too_short", "rewrite", rewrite_suggestion="''")),
    ]
    answer = [
        ("x = ''", case(0, "不可用", why["pair_without_question"], "empty_question", "drop", answer_issue_type="'empty'")),
        ("y = ''", case(0, "不可用", why["empty_answer"], "empty_answer", "drop", answer_issue_type="'empty'")),
        (phrases.format("y"), case(3, "较差", why["answer_depends_on_source_context"], "answer_depends_on_source_context", "rewrite", answer_issue_type="'format_noise'")),
        ("length(y) < 20", case(3, "较差", why["answer_too_short"], "answer_too_short", "rewrite", answer_issue_type="'too_generic'")),
    ]
    trimmed = f"(SELECT *, {sq} AS x, {sa} AS y FROM ({pairs}))"
    safe = "coalesce(qr <> 'refuse_or_exclude', true)"
    ok = "(qs IS NULL OR qs = 'ok')"
    score = f"CASE WHEN x = '' THEN 0 WHEN {phrases.format('x')} OR length(x) < 8 THEN 2 ELSE 0 END"  # without a verdict 0, too
    failed = f"(x = '' OR {phrases.format('x')} OR length(x) < 8)"
    exported = f"""
SELECT id, sft_question.question_type AS t, score AS av, CASE WHEN {failed} THEN {score} END AS qv, CASE WHEN x = '' THEN 'missing_question' WHEN y = '' THEN 'missing_answer'
  WHEN coalesce(sft_question.status NOT IN ('', 'ok'), false) OR coalesce(sft_answer.status NOT IN ('', 'ok'), false) OR NOT pass_filter OR {failed} THEN 'bad_status' END AS skip
FROM (SELECT *, {sq.replace("coalesce(q,", "coalesce(sft_question.question,")} AS x, {sa.replace("coalesce(a,", "coalesce(sft_answer.answer,")} AS y FROM ({_judge(3, f"{_ISSUE} IN ('empty', 'unsafe', 'off_topic')")})) v"""
    plan_text = "string_agg(concat_ws(':', p.t, CAST(c AS VARCHAR), p.r), ',' ORDER BY i)"
    normal = f"""
WITH {_plan("[,，/、" + _SPACE + "]+", _COUNT)}, {_cut("cnt")},
filled AS (SELECT rid, i, p, CAST(c + CASE WHEN i = max(i) OVER (PARTITION BY rid) THEN total - sum(c) OVER (PARTITION BY rid) ELSE 0 END AS BIGINT) AS c FROM cut),
texts AS (SELECT rid, {plan_text} AS plan, list(p.t ORDER BY i) AS kinds FROM filled GROUP BY rid)
SELECT DISTINCT id, CAST(cnt AS INTEGER) AS n, coalesce(array_to_string(list_filter(kinds, lambda x, i: list_position(kinds, x) = i), ','), '') AS types, coalesce(texts.plan, '') AS plan, array_to_string({_list("issues")}, ',') AS issues, {_s("reason")} AS reason,
  {_s("suggested_use")} AS suggested_use, {_s("question_count_reason")} AS why FROM given LEFT JOIN texts USING (rid)"""
    capped = f"""
WITH {_plan("[,，、]", f"greatest(0, {_n('recommended_question_count')})")}, {_cut("3")}, texts AS (SELECT rid, {plan_text} AS plan FROM cut GROUP BY rid)
SELECT DISTINCT id, coalesce(texts.plan, '') AS plan FROM given LEFT JOIN texts USING (rid)"""
    made = f"""
WITH raw AS ({_rows(replies.QUESTIONS)}),
listed AS (SELECT *, list_filter(CASE WHEN json_type(j, '$.questions') = 'ARRAY' THEN CAST(json_extract(j, '$.questions') AS JSON[]) WHEN {_s("question")} <> '' THEN [j] ELSE [] END, lambda x: json_type(x) = 'OBJECT') AS xs FROM raw),
said AS (SELECT *, list_transform(xs, lambda x: regexp_replace(trim({_s("question", "x")}), {_q(_PREFIX)}, '')) AS qs FROM listed),
flat AS (SELECT rid, id, planned_question_type AS t, coalesce(sft_question.risk_label, 'public_safe') AS risk, coalesce(sft_question.target_label_id, '') AS label, unnest(xs) AS x, unnest(qs) AS question, unnest(range(len(xs))) AS i FROM said),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid, question ORDER BY i) AS k FROM flat WHERE question <> '') WHERE k = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY i) - 1 AS place FROM first)
SELECT DISTINCT id, CAST(place AS INTEGER) AS place, question, CASE WHEN place = 0 AND coalesce(t, '') <> '' THEN {_enum("t", lexicons.QUESTION_TYPES, "'qa'")} ELSE {_enum(_s("question_type", "x"), lexicons.QUESTION_TYPES, "'qa'")} END AS question_type,
  coalesce(nullif({_s("target_label_id", "x")}, ''), label) AS target_label_id, {_enum(_s("expected_answer_format", "x"), lexicons.ANSWER_FORMATS, "'plain_text'")} AS expected_answer_format, {_enum(_s("difficulty", "x"), lexicons.DIFFICULTIES, "'medium'")} AS difficulty,
  {_enum(_s("risk_label", "x"), lexicons.RISK_LABELS, "risk")} AS risk_label, trim({_s("reason", "x")}) AS reason, 'ok' AS status FROM placed WHERE place < 2
UNION ALL
SELECT DISTINCT id, 0, '', coalesce(planned_question_type, ''), coalesce(sft_question.target_label_id, ''), 'plain_text', 'medium', coalesce(sft_question.risk_label, 'public_safe'), '{lexicons.NO_QUESTION_REASON}', 'empty_question' FROM raw WHERE rid NOT IN (SELECT rid FROM placed)"""
    found = f"""
WITH few AS (SELECT label_id, full_path FROM taxonomy_leaves WHERE side = 'fact' ORDER BY label_id LIMIT 5), raw AS ({_rows(replies.CHOICE)})
SELECT DISTINCT id, f.label_id, f.full_path, array_to_string({_list("task_types")}, ',') AS tasks, array_to_string({_list("evidence_keywords")}, ',') AS words, (SELECT string_agg(label_id, ',' ORDER BY label_id) FROM few) AS offered,
  coalesce(nullif({_s("source_type")}, ''), 'other') AS source_type, CASE WHEN {_s("risk_label")} IN ('', 'public_safe') THEN 'public_safe' WHEN {_s("risk_label")} IN {_in(lexicons.RISK_LABELS)} THEN {_s("risk_label")} ELSE 'needs_caution' END AS risk_label,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(TRY_CAST(json_extract_string(j, '$.confidence') AS DOUBLE), 0))) AS confidence, {_s("reason")} AS reason, CASE WHEN f.label_id IS NULL THEN 'no_primary_label' ELSE 'ok' END AS status
FROM raw LEFT JOIN few f ON f.label_id = json_extract_string(j, '$.primary_label_id')"""
    return {
        "question_checks": f"SELECT DISTINCT id, {_verdict_of(question)} FROM {trimmed} WHERE {failed}",
        "answer_checks": f"SELECT DISTINCT id, {_verdict_of(answer)} FROM {trimmed} WHERE x = '' OR y = '' OR {phrases.format('y')} OR length(y) < 20",
        "question_evals": f"SELECT DISTINCT id, rewrite_suggestion, {_FIELDS} FROM ({_judge(7, _risk() + " = 'refuse_or_exclude'")})",
        "answer_evals": f"SELECT DISTINCT id, answer_issue_type, {_FIELDS} FROM ({_judge(7, _ISSUE + " IN ('empty', 'unsafe', 'off_topic')")})",
        "material_evals": normal,
        "capped_plans": capped,
        "normal_questions": made,
        "normal_answers": f"SELECT DISTINCT id, trim({_s('answer')}) AS answer, {_risk()} AS risk_label, trim({_s('quality_notes')}) AS quality_notes, CASE WHEN trim({_s('answer')}) <> '' THEN 'ok' ELSE 'empty_answer' END AS status FROM ({_rows(replies.ANSWER)})",
        "classifications": found,
        "admissions": f"""
SELECT DISTINCT id, x = '' OR NOT {ok} OR {safe} AS filter, x <> '' AND {ok} AND {safe} AS answers, x <> '' AND {ok} AS answers_all, x <> '' AND {ok} AND {safe} AND NOT {failed} AS labels, x <> '' AND {ok} AND {safe} AND {score} >= 2 AS labels_of_two FROM {trimmed}""",
        "stage_input": f"SELECT DISTINCT id FROM {trimmed} WHERE x <> '' AND {ok} AND {safe} AND id NOT IN (SELECT id FROM ({pairs}) WHERE s = 'ok' AND length(a) > 200) ORDER BY id LIMIT 100",
        "export_reasons": f"SELECT coalesce(skip, 'exported') AS reason, coalesce(nullif(t, ''), 'unknown') AS question_type, count(*) AS n FROM ({exported}) GROUP BY 1, 2",
        "export_counters": f"""
WITH e AS ({exported})
SELECT 'skip_reason' AS counter, skip AS value, count(*) AS n FROM e WHERE skip IS NOT NULL GROUP BY 2
UNION ALL SELECT 'question_type', coalesce(nullif(t, ''), 'unknown'), count(*) FROM e WHERE skip IS NULL GROUP BY 2
UNION ALL SELECT 'answer_score', coalesce(CAST(av AS VARCHAR), 'unknown'), count(*) FROM e WHERE skip IS NULL GROUP BY 2
UNION ALL SELECT 'question_score', coalesce(CAST(qv AS VARCHAR), 'unknown'), count(*) FROM e WHERE skip IS NULL GROUP BY 2""",
        "chat_rows": f"""
WITH kept AS (SELECT * FROM {trimmed} WHERE x <> '' AND y <> '' AND coalesce(qs IN ('', 'ok'), true) AND coalesce(s IN ('', 'ok'), true))
SELECT DISTINCT id, 0 AS place, 'system' AS role, '要准确' AS content FROM kept UNION ALL SELECT DISTINCT id, 1, 'user', x FROM kept UNION ALL SELECT DISTINCT id, 2, 'assistant', y FROM kept""",
        "plans_normal": """
WITH m AS (SELECT material_id, max(question_count) AS total, list_sort(list(DISTINCT planned_question_type) FILTER (planned_question_type IS NOT NULL)) AS types FROM sft_answers GROUP BY material_id),
k AS (SELECT material_id, total, CASE WHEN len(types) > 0 THEN types ELSE ['qa'] END AS types, unnest(range(1, total + 1)) AS question_index FROM m WHERE total > 0)
SELECT material_id || '#q' || lpad(CAST(question_index AS VARCHAR), 4, '0') AS id, material_id, CAST(question_index AS INTEGER) AS question_index, CAST(total AS INTEGER) AS question_count, types[least(question_index, len(types))] AS planned_question_type FROM k""",
    }
