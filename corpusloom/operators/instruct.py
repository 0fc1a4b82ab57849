"""Instruction rows: plans, expansion, coercion of model output, checks of pairs, and chat export.

Model output is a variant and untyped: every value is tried, never cast. What isn't there, or of another type, becomes a
defined default; a reply that couldn't be parsed (null) is one without fields.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons
from ..functions import text as T
from .relational import not_done

PLAN = "array<struct<question_type:string,count:int,reason:string>>"
QUESTION = "array<struct<question:string,question_type:string,target_label_id:string,expected_answer_format:string,difficulty:string,risk_label:string,reason:string,status:string>>"


def field(raw: Column, name: str) -> Column:
    """A field of a variant object: null if it is missing, a null variant if it is there without a value."""
    return F.try_variant_get(raw, f"$.{name}", "variant")


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _read(v: Column) -> Column:
    """Kind and text of a value, for let()."""
    return F.struct(_kind(v).alias("k"), _as(v, "string").alias("s"))


def _said(x: Column, v: Column) -> Column:
    return F.when(x["k"].isin("STRING", "BIGINT"), x["s"]).when(x["k"] == "BOOLEAN", F.initcap(x["s"])).when(x["k"] == "VOID", "None").when(x["k"].rlike("^(ARRAY|OBJECT)"), F.to_json(v)).otherwise(x["s"].try_cast("double").cast("string"))


def item_text(v: Column) -> Column:
    """Any value as text; what isn't there is 'None'."""
    return let(_read(v), lambda x: _said(x, v))


def text_of(v: Column) -> Column:
    """A value as text; '' for what is missing, null, false, zero or empty."""
    nothing = F.lit("None"), F.lit("False"), F.lit("0"), F.lit("0.0"), F.lit("-0.0"), F.lit("[]"), F.lit("{}")
    told = lambda x: F.when(x["k"] == "STRING", x["s"]).otherwise(let(_said(x, v), lambda t: F.when(t.isin(*nothing), "").otherwise(t)))
    return let(_read(v), told)


def number_of(v: Column) -> Column:
    """A number from a number, a boolean or text that is one; null for all else."""
    k = _kind(v)
    text = T.strip(_as(v, "string"))
    from_text = F.when(text.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
    return F.when(k == "STRING", from_text).when(k == "BOOLEAN", _as(v, "boolean").cast("double")).when(k.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), _as(v, "double"))


def whole_of(v: Column) -> Column:
    """The number of a value, rounded half to even; null if it is none."""
    return F.rint(number_of(v)).cast("int")


def is_list(v: Column) -> Column:
    return _kind(v).startswith("ARRAY")


def texts_of(v: Column) -> Column:
    """A list of texts: of a list its items, of a text the text alone, of all else nothing."""
    k = _kind(v)
    none = F.array().cast("array<string>")
    return F.when(k == "STRING", F.array(_as(v, "string"))).when(k.startswith("ARRAY"), F.coalesce(F.transform(_as(v, "array<variant>"), item_text), none)).otherwise(none)


def or_default(c: Column, default: str | Column) -> Column:
    """The value, or the default for null and ''."""
    return F.coalesce(F.nullif(c, F.lit("")), default if isinstance(default, Column) else F.lit(default))


def enum(c: Column, allowed: tuple[str, ...], default: str | Column) -> Column:
    """The trimmed value if it is allowed, else the default."""
    c = T.strip(c)
    return F.when(c.isin(*allowed), c).otherwise(default if isinstance(default, Column) else F.lit(default))


def risk_of(v: Column) -> Column:
    """A risk label: public_safe if there is none, needs_caution if it is unknown."""
    return enum(or_default(text_of(v), "public_safe"), lexicons.RISK_LABELS, "needs_caution")


def score_of(v: Column) -> Column:
    """A score from 0 to 10: rounded half to even and clamped; 0 for what is no number."""
    return F.coalesce(F.least(F.greatest(whole_of(v), F.lit(0)), F.lit(10)), F.lit(0))


def flag_of(v: Column, default: Column) -> Column:
    """A boolean: of text whether it says yes, of all else whether it is anything; the default if the field is missing."""
    k = _kind(v)
    yes = F.lower(T.strip(_as(v, "string"))).isin("true", "1", "yes", "y")
    return F.when(v.isNull(), default).when(k == "STRING", yes).otherwise(text_of(v) != "")


def extract_json(c: Column) -> Column:
    """The JSON of a reply as text: without a fence, else from the first brace to the last; null if it can't be parsed."""
    bare = T.strip(F.regexp_replace(c, r"\A\s*`{3}(?i:json)?\s*|\s*`{3}\s*\z", ""))
    inner = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    whole = F.to_json(F.try_parse_json(bare))
    return F.when(whole.isNotNull() & bare.startswith("{"), bare).when(F.try_parse_json(F.nullif(inner, F.lit(""))).isNotNull(), inner)


def _item(kind: Column, count: Column, reason: Column) -> Column:
    return F.struct(kind.alias("question_type"), count.cast("int").alias("count"), reason.alias("reason"))


def _planned(plan: Column) -> Column:
    return F.aggregate(plan, F.lit(0), lambda a, p: a + p["count"])


def plan_items(raw: Column, allowed: tuple[str, ...] = lexicons.QUESTION_TYPES) -> Column:
    """The items of an untyped plan: known types with a count of 1 and more. A count that is no number is 1."""
    item = lambda v: _item(T.strip(text_of(field(v, "question_type"))), F.coalesce(whole_of(field(v, "count")), F.lit(1)), T.strip(text_of(field(v, "reason"))))
    items = F.transform(F.filter(_as(raw, "array<variant>"), lambda v: _kind(v).startswith("OBJECT")), item)
    return F.coalesce(F.filter(items, lambda p: p["question_type"].isin(*allowed) & (p["count"] >= 1)), F.array().cast(PLAN))


def _or_types(plan: Column, total: Column, types: Column) -> Column:
    """The plan, or without one each type once and the rest on the last, as far as the total goes; qa without types."""
    types = F.when(F.size(F.coalesce(types, F.array().cast("array<string>"))) > 0, types).otherwise(F.array(F.lit("qa")))
    last = F.size(types) - 1
    spread = F.transform(types, lambda t, i: _item(t, F.when(i < last, F.when(i < total, 1).otherwise(0)).otherwise(F.greatest(total - i, F.lit(0))), F.lit(lexicons.FALLBACK_REASON)))
    return F.when(F.size(plan) > 0, plan).otherwise(F.filter(spread, lambda p: p["count"] > 0))


def _cut_plan(plan: Column, total: Column) -> Column:
    def cut(items: Column) -> Column:
        before = lambda i: _planned(F.slice(items, F.lit(1), i))
        return F.filter(F.transform(items, lambda p, i: _item(p["question_type"], F.least(p["count"], F.greatest(total - before(i), F.lit(0))), p["reason"])), lambda p: p["count"] > 0)

    return let(plan, cut)


def normal_plan(plan: Column, total: Column, types: Column | None = None) -> Column:
    """A plan of ``total`` questions from items (question_type, count, reason), see plan_items; without any, from types.

    What is over the total is taken from the tail, what is under is added to the last item. Nothing is planned for 0.
    """
    none = F.array().cast(PLAN)
    listed = lambda n: _or_types(F.coalesce(plan, none), n, none.cast("array<string>") if types is None else types)

    def filled(cut: Column, n: Column) -> Column:
        short, last = n - _planned(cut), F.size(cut) - 1
        return F.transform(cut, lambda p, i: _item(p["question_type"], p["count"] + F.when(i == last, short).otherwise(0), p["reason"]))

    return let(F.coalesce(total, F.lit(0)), lambda n: F.when(n <= 0, none).otherwise(let(_cut_plan(listed(n), n), lambda cut: filled(cut, n))))


def _known_types(v: Column, separators: str) -> Column:
    texts = F.when(_kind(v) == "STRING", F.split(_as(v, "string"), separators)).otherwise(texts_of(v))
    return F.array_distinct(F.filter(F.transform(texts, T.strip), lambda t: t.isin(*lexicons.QUESTION_TYPES)))


def material_eval(raw: Column) -> Column:
    """A model's evaluation of a material: reason, issues, suggested_use, recommended_question_count and _types,

    question_type_plan, question_count_reason. Without a count that is a number, the plan's sum counts, without that 1.
    """
    items = F.coalesce(F.filter(_as(field(raw, "question_type_plan"), "array<variant>"), lambda v: _kind(v).startswith("OBJECT")), F.array().cast("array<variant>"))
    asked = F.aggregate(items, F.lit(0), lambda a, v: a + F.greatest(F.coalesce(whole_of(field(v, "count")), F.lit(0)), F.lit(0)))
    count = F.greatest(F.coalesce(whole_of(field(raw, "recommended_question_count")), F.when(asked > 0, asked).otherwise(1)), F.lit(0))
    types = _known_types(field(raw, "recommended_question_types"), rf"[,，/、{T.WS}]+")
    texts = {k: text_of(field(raw, k)).alias(k) for k in ("reason", "suggested_use", "question_count_reason")}

    def evaluated(x: Column) -> Column:
        used = F.array_distinct(F.transform(x["plan"], lambda p: p["question_type"]))
        return F.struct(texts["reason"], texts_of(field(raw, "issues")).alias("issues"), texts["suggested_use"], x["n"].alias("recommended_question_count"), used.alias("recommended_question_types"), x["plan"].alias("question_type_plan"), texts["question_count_reason"])

    planned = let(count, lambda n: F.struct(n.alias("n"), normal_plan(plan_items(field(raw, "question_type_plan")), n, types).alias("plan")))
    return let(planned, evaluated)


def capped_plan(raw: Column, most: int = 0) -> Column:
    """The plan of an evaluation (variant) as it is, at most ``most`` questions of it (0: all); never filled up.

    Without a plan it comes from the recommended count and types; without a count there is none.
    """
    count = F.greatest(whole_of(field(raw, "recommended_question_count")), F.lit(0))
    plan = plan_items(field(raw, "question_type_plan"))
    plan = F.when((F.size(plan) > 0) | count.isNotNull(), _or_types(plan, F.coalesce(count, F.lit(0)), _known_types(field(raw, "recommended_question_types"), "[,，、]"))).otherwise(F.array().cast(PLAN))
    return _cut_plan(plan, F.lit(most)) if most > 0 else plan


def type_sequence(plan: Column) -> Column:
    """Each type of a plan as often as planned, in order."""
    return F.flatten(F.transform(plan, lambda p: F.array_repeat(p["question_type"], p["count"])))


def fallback_count(plan: Column, recommended: Column, refused: Column, size: Column) -> Column:
    """Planned questions, else recommended, else 1 if refused, else 1, 2 or 3 by size (600, 1000)."""
    planned = F.aggregate(F.coalesce(plan, F.array().cast(PLAN)), F.lit(0), lambda a, p: a + p["count"])
    by_size = F.when(size >= 1000, 3).when(size >= 600, 2).otherwise(1)
    return F.when(planned > 0, planned).when(recommended.isNotNull(), F.greatest(recommended, F.lit(0))).when(refused, 1).otherwise(by_size)


def expand(df: DataFrame, types: Column, id_col: str = "id") -> DataFrame:
    """One row for each planned type: material_id, question_index (from 1), question_count, planned_question_type, id."""
    rows = df.withColumn("__types", types).withColumn("question_count", F.size("__types"))
    rows = rows.select("*", F.posexplode("__types").alias("__pos", "planned_question_type")).drop("__types")
    rows = rows.withColumn("material_id", F.col(id_col)).withColumn("question_index", F.col("__pos") + 1).drop("__pos")
    return rows.withColumn(id_col, F.format_string("%s#q%04d", "material_id", "question_index"))


def distinct_questions(questions: Column, limit: Column) -> Column:
    """Non-empty questions, the first of equal ones, at most ``limit``."""
    kept = F.array_distinct(F.filter(F.transform(questions, T.strip), lambda q: q != ""))
    return F.slice(kept, F.lit(1), F.greatest(limit, F.lit(0)))


def strip_prefixes(c: Column, prefixes: tuple[str, ...] = lexicons.CONTEXT_PREFIXES) -> Column:
    """Trimmed, without any of the prefixes at the start, however often, and the signs after them."""
    return F.regexp_replace(T.strip(c), r"\A(?:(?:" + "|".join(prefixes) + r")[ ：:,，]*)+", "")


def normal_questions(raw: Column, types: Column, count: Column, risk: Column, label: Column) -> Column:
    """The questions of a model's reply (variant), at most ``count`` (one at least), equal ones once; see QUESTION.

    raw is an object with a list of questions, or one question itself. types: the planned type of each, which goes
    before the model's own; risk, label: the material's, for want of better. Without a usable question there is one row
    with the status empty_question.
    """
    listed = field(raw, "questions")
    items = F.when(_kind(listed).startswith("ARRAY"), F.filter(_as(listed, "array<variant>"), lambda v: _kind(v).startswith("OBJECT"))).when(text_of(field(raw, "question")) != "", F.array(raw))
    texts = F.coalesce(F.transform(items, lambda v: F.struct(strip_prefixes(text_of(field(v, "question"))).alias("q"), v.alias("v"))), F.array().cast("array<struct<q:string,v:variant>>"))
    said = F.transform(texts, lambda t: t["q"])
    kept = F.slice(F.filter(texts, lambda t, i: (t["q"] != "") & (F.array_position(said, t["q"]) == i + 1)), F.lit(1), F.greatest(count, F.lit(1)))
    known = lambda c, allowed, default: enum(or_default(c, default), allowed, default)
    risk = F.when(risk.isin(*lexicons.RISK_LABELS), risk).otherwise("public_safe")
    label = F.coalesce(label, F.lit(""))

    def question(t: Column, i: Column) -> Column:
        v = t["v"]
        planned = F.try_element_at(types, i + 1)
        kind = enum(or_default(planned, or_default(text_of(field(v, "question_type")), "qa")), lexicons.QUESTION_TYPES, "qa")
        return F.struct(
            t["q"].alias("question"), kind.alias("question_type"), or_default(text_of(field(v, "target_label_id")), label).alias("target_label_id"),
            known(text_of(field(v, "expected_answer_format")), lexicons.ANSWER_FORMATS, "plain_text").alias("expected_answer_format"), known(text_of(field(v, "difficulty")), lexicons.DIFFICULTIES, "medium").alias("difficulty"),
            known(text_of(field(v, "risk_label")), lexicons.RISK_LABELS, risk).alias("risk_label"), T.strip(text_of(field(v, "reason"))).alias("reason"), F.lit("ok").alias("status"),
        )

    none = F.struct(
        F.lit("").alias("question"), F.coalesce(F.try_element_at(types, F.lit(1)), F.lit("refusal")).alias("question_type"), label.alias("target_label_id"), F.lit("plain_text").alias("expected_answer_format"),
        F.lit("medium").alias("difficulty"), risk.alias("risk_label"), F.lit(lexicons.NO_QUESTION_REASON).alias("reason"), F.lit("empty_question").alias("status"),
    )
    return F.when(F.size(kept) > 0, F.transform(kept, question)).otherwise(F.array(none)).cast(QUESTION)


def without_context(c: Column, phrases: tuple[str, ...] = lexicons.CONTEXT_PHRASES) -> Column:
    """A question without the phrases that point to a context, one after another, and without the signs then at its start."""
    for p in phrases:
        c = F.replace(c, F.lit(p), F.lit(""))
    return T.strip(F.regexp_replace(c, rf"\A[，,。:：{T.WS}]+", ""))


def _verdict(**fields: Column | str | int | bool) -> Column:
    return F.struct(*(v.alias(k) if isinstance(v, Column) else F.lit(v).alias(k) for k, v in fields.items()))


def question_check(question: Column, phrases: tuple[str, ...] = lexicons.CONTEXT_PHRASES, least: int = 8) -> Column:
    """The verdict (as question_eval) on a question that needs no judge; null for the others."""
    q = T.strip(F.coalesce(question, F.lit("")))

    def verdict(score: int, code: str, action: str, rewrite: Column | str = "") -> Column:
        return _verdict(score=score, pass_filter=False, quality_level=lexicons.LEVELS[0], reason=lexicons.CHECK_REASONS[code], issues=F.array(F.lit(code)), suggested_action=action, rewrite_suggestion=rewrite, risk_label="public_safe", status="ok")

    return F.when(q == "", verdict(0, "empty_question", "drop")).when(q.rlike("|".join(phrases)), verdict(2, "depends_on_source_context", "rewrite", without_context(q, phrases))).when(F.length(q) < least, verdict(2, "too_short", "rewrite"))


def answer_check(question: Column, answer: Column, phrases: tuple[str, ...] = lexicons.CONTEXT_PHRASES, least: int = 20) -> Column:
    """The verdict (as answer_eval) on a pair that needs no judge; null for the others."""
    q, a = T.strip(F.coalesce(question, F.lit(""))), T.strip(F.coalesce(answer, F.lit("")))

    def verdict(score: int, code: str, reason: str, action: str, issue: str) -> Column:
        return _verdict(score=score, pass_filter=False, quality_level=lexicons.LEVELS[score // 2], reason=lexicons.CHECK_REASONS[reason], issues=F.array(F.lit(code)), suggested_action=action, answer_issue_type=issue, risk_label="public_safe", status="ok")

    return (
        F.when(q == "", verdict(0, "empty_question", "pair_without_question", "drop", "empty"))
        .when(a == "", verdict(0, "empty_answer", "empty_answer", "drop", "empty"))
        .when(a.rlike("|".join(phrases)), verdict(3, "answer_depends_on_source_context", "answer_depends_on_source_context", "rewrite", "format_noise"))
        .when(F.length(a) < least, verdict(3, "answer_too_short", "answer_too_short", "rewrite", "too_generic"))
    )


def _judged(raw: Column, threshold: int, blocked: Column, **more: Column) -> Column:
    score = score_of(field(raw, "score"))
    band = F.element_at(F.array(*map(F.lit, lexicons.LEVELS)), F.when(score <= 2, 1).when(score <= 4, 2).when(score <= 6, 3).when(score <= 8, 4).otherwise(5))
    passed = flag_of(field(raw, "pass_filter"), score >= threshold) & (score >= threshold) & ~blocked
    action = enum(text_of(field(raw, "suggested_action")), lexicons.ACTIONS, F.when(score >= threshold, "keep").otherwise("drop"))
    return _verdict(
        score=score, pass_filter=passed, quality_level=or_default(text_of(field(raw, "quality_level")), band), reason=T.strip(text_of(field(raw, "reason"))), issues=texts_of(field(raw, "issues")), suggested_action=action,
        **more, risk_label=risk_of(field(raw, "risk_label")), status=or_default(text_of(field(raw, "status")), "ok"),
    )


def question_eval(raw: Column, threshold: int) -> Column:
    """A judge's verdict on a question from its reply (variant): score, pass_filter, quality_level, reason, issues,

    suggested_action, rewrite_suggestion, risk_label, status. refuse_or_exclude never passes.
    """
    return _judged(raw, threshold, risk_of(field(raw, "risk_label")) == "refuse_or_exclude", rewrite_suggestion=T.strip(text_of(field(raw, "rewrite_suggestion"))))


def answer_eval(raw: Column, threshold: int) -> Column:
    """As question_eval, of a pair, with answer_issue_type; empty, unsafe and off_topic never pass, whatever the risk."""
    issue = enum(text_of(field(raw, "answer_issue_type")), lexicons.ISSUE_TYPES, "none")
    return _judged(raw, threshold, issue.isin("empty", "unsafe", "off_topic"), answer_issue_type=issue)


def normal_answer(raw: Column) -> Column:
    """answer, risk_label, quality_notes, status from a model's reply (variant)."""
    answer = T.strip(text_of(field(raw, "answer")))
    return _verdict(answer=answer, risk_label=risk_of(field(raw, "risk_label")), quality_notes=T.strip(text_of(field(raw, "quality_notes"))), status=F.when(answer != "", "ok").otherwise("empty_answer"))


def classification(raw: Column, candidates: Column, id_field: str = "label_id") -> Column:
    """A model's choice among candidates (array of structs): primary (the candidate, null if it is none of them),

    task_types, source_type, risk_label, confidence (0 to 1), reason, evidence_keywords, candidate_label_ids, status.
    """
    chosen = field(raw, "primary_label_id")
    name = F.when(_kind(chosen) != "VOID", item_text(chosen))
    primary = F.try_element_at(F.filter(candidates, lambda c: c[id_field].cast("string") == name), F.lit(-1))
    sure = F.coalesce(F.least(F.greatest(number_of(field(raw, "confidence")), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    risk = or_default(text_of(field(raw, "risk_label")), "public_safe")
    return _verdict(
        primary=primary, task_types=texts_of(field(raw, "task_types")), source_type=or_default(text_of(field(raw, "source_type")), "other"), risk_label=F.when(risk.isin(*lexicons.RISK_LABELS), risk).otherwise("needs_caution"), confidence=sure,
        reason=text_of(field(raw, "reason")), evidence_keywords=texts_of(field(raw, "evidence_keywords")), candidate_label_ids=F.transform(candidates, lambda c: c[id_field]), status=F.when(primary.isNotNull(), "ok").otherwise("no_primary_label"),
    )


def admitted(question: Column, status: Column, risk: Column, empty_too: bool = False, any_status: bool = False, refused_too: bool = False) -> Column:
    """Whether a stage takes a row: it has a question, its status is ok or null, and it isn't to be refused.

    ``empty_too`` and ``any_status`` let rows through whatever else they hold, as the filter of questions does.
    """
    has = T.strip(F.coalesce(question, F.lit(""))) != ""
    ok = F.coalesce(status == "ok", F.lit(True))
    safe = F.lit(True) if refused_too else F.coalesce(risk != "refuse_or_exclude", F.lit(True))
    rest = (F.lit(True) if any_status else ok) & safe
    taken = rest | ~ok if any_status else rest
    return taken | ~has if empty_too else taken & has


def admitted_to_labels(question: Column, status: Column, risk: Column, passed: Column, score: Column, least: int = 0, refused_too: bool = False) -> Column:
    """Whether a question is classified: admitted, not failed by its verdict, and of the least score (0: any)."""
    taken = admitted(question, status, risk, refused_too=refused_too) & F.coalesce(passed, F.lit(True))
    return taken & (F.coalesce(score, F.lit(0)) >= least) if least > 0 else taken


def stage_rows(df: DataFrame, admits: Column, done: DataFrame | None, limit: int, *order: str, id_col: str = "id") -> DataFrame:
    """What a stage works on: admitted rows, without those done, and of these the first ``limit`` in order (0: all)."""
    rows = df.where(admits)
    if done is not None:
        rows = not_done(rows, done, id_col)
    return rows.orderBy(*order).limit(limit) if limit > 0 else rows


def pair_risk(answer_risk: Column, question_risk: Column) -> Column:
    """The answer's risk label if valid, else the question's, else public_safe."""
    valid = lambda c: F.when(c.isin(*lexicons.RISK_LABELS), c)
    return F.coalesce(valid(answer_risk), valid(question_risk), F.lit("public_safe"))


def skip_reason(question: Column, answer: Column, statuses: list[Column], passed: tuple[Column, ...] = ()) -> Column:
    """Why a pair isn't exported: missing_question, missing_answer, bad_status; null if it is.

    A status other than null, '' and ok is bad, and so is a verdict (passed) that is false.
    """
    bad = F.lit(False)
    for s in statuses:
        bad = bad | F.coalesce(~s.isin("", "ok"), F.lit(False))
    for p in passed:
        bad = bad | F.coalesce(~p, F.lit(False))
    empty = lambda c: T.strip(F.coalesce(c, F.lit(""))) == ""
    return F.when(empty(question), "missing_question").when(empty(answer), "missing_answer").when(bad, "bad_status")


def export_counts(df: DataFrame, reason: Column, **counted: Column) -> DataFrame:
    """counter, value, n: rows by skip reason, and of those exported by each of ``counted``; 'unknown' for null and ''."""
    pairs = [F.struct(F.lit("skip_reason").alias("counter"), reason.alias("value"))]
    pairs += [F.struct(F.lit(k).alias("counter"), F.when(reason.isNull(), or_default(T.strip(c.cast("string")), "unknown")).alias("value")) for k, c in counted.items()]
    return df.select(F.explode(F.array(*pairs)).alias("p")).where("p.value is not null").groupBy("p.counter", "p.value").agg(F.count("*").alias("n"))


def chat_messages(question: Column, answer: Column, system: str = "") -> Column:
    """The messages of a pair: an optional system message, the user's, the assistant's."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    turns = [message("system", F.lit(system))] if system else []
    return F.array(*turns, message("user", T.strip(question)), message("assistant", T.strip(answer)))


def prompt_of(df: DataFrame, template: str, *fields: str) -> Column:
    """A prompt: the template, a line feed, and the fields as one JSON object."""
    return F.concat_ws("\n", F.lit(template), F.to_json(F.struct(*fields)))
