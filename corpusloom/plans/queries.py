"""The registry: every query runs over its whole tables. Each has SQL in oracle.py where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons
from ..functions import text as T
from ..operators import chunking, html, instruct, prefilter, relational, taxonomy
from . import replies

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(reads: str):
    """Registers a function of the one table it reads."""

    def register(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(table(spark, sf_dir, reads))
        return f

    return register


def query_all(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
    """Registers a function of a reader of tables."""
    QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
    return f


# --- cleaning and measuring


@query("documents")
def clean_documents(d):
    return d.select("doc_id", T.clean_text(F.col("text")).alias("clean"))


@query("documents")
def clean_plain_documents(d):
    return d.select("doc_id", T.clean_plain(F.col("text")).alias("clean"))


@query("documents")
def clean_wiki_documents(d):
    return d.select("doc_id", T.clean_wiki(F.col("text"), True).alias("clean"))


@query("documents")
def clean_lines(d):
    """Markdown and PDF lines share their steps: one row a line."""
    lines = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("doc_id", "line_no", T.clean_markdown_line(F.col("line")).alias("markdown"), T.clean_pdf_line(F.col("line")).alias("pdf"))


@query("pdf_chunks")
def pdf_noise_lines(p):
    lines = p.select("id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.where(T.is_pdf_noise(T.clean_pdf_line(F.col("line")))).select("id", "line_no")


@query("documents")
def text_lengths(d):
    t = F.coalesce("text", F.lit(""))
    return d.select("doc_id", F.length(t).alias("n"), T.text_length(t).alias("ink"), F.length(T.compact(t)).alias("compact"))


@query("documents")
def middle_truncate(d):
    return d.select("doc_id", T.truncate_middle(F.col("text"), 500).alias("short"))


@query("v2_chunks")
def file_names(v):
    return v.select("id", T.safe_filename(F.col("title")).alias("name")).distinct()


@query("documents")
def text_hashes(d):
    return d.select("doc_id", T.hash_strict(F.col("text")).alias("strict"), T.hash_compact(F.col("text")).alias("compact"))


@query("v2_chunks")
def garbled_scores(v):
    return v.select("id", T.garbled_score(F.coalesce("text", F.lit(""))).alias("score")).distinct()


@query("v2_chunks")
def garbled_repair(v):
    """Rows that the cheap repair of UTF-8 read as GBK changes."""
    fixed = v.select("id", "text", T.repair_garbled(F.col("text")).alias("fixed"))
    return fixed.where("fixed != text").select("id", "fixed").distinct()


@query("documents")
def references_cut(d):
    return d.select("doc_id", T.strip_references(T.clean_text(F.col("text"))).alias("kept"))


@query("documents")
def wiki_tail_cut(d):
    return d.select("doc_id", T.strip_wiki_tail(F.col("text")).alias("kept"))


@query("documents")
def repeats(d):
    t = F.coalesce("text", F.lit(""))
    return d.select("doc_id", T.longest_run(t).alias("longest_run"), T.duplicate_line_ratio(t).alias("duplicate_lines"), T.unique_ratio(t).alias("unique_ratio"))


# --- segmentation and chunking


@query("documents")
def paragraphs(d):
    return d.select("doc_id", F.posexplode(T.paragraphs(T.clean_text(F.col("text")))).alias("n", "paragraph"))


@query("documents")
def sentences(d):
    return d.select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("n", "sentence"))


@query("documents")
def chunks_raw(d):
    fixed = d.select("doc_id", T.repair_garbled(F.col("text")).alias("text"))
    cleaned = fixed.select("doc_id", T.clean_text(F.col("text")).alias("text")).select("doc_id", T.strip_references(F.col("text")).alias("text"))
    return chunking.chunk_documents(cleaned, chunking.chunk_raw, "doc_id")


@query("documents")
def packed_paragraphs(d):
    """chunks_raw of clean texts as they are, without the repair and the cut of references that go before."""
    chunks = chunking.chunk_documents(d.select("doc_id", T.clean_text(F.col("text")).alias("text")), chunking.chunk_raw, "doc_id")
    return chunks.drop("section")


@query("documents")
def chunks_plain(d):
    return chunking.chunk_documents(d.select("doc_id", T.clean_plain(F.col("text")).alias("text")), chunking.chunk_plain, "doc_id")


@query("documents")
def chunks_wiki(d):
    return chunking.chunk_documents(d, chunking.chunk_wiki, "doc_id")


@query("documents")
def chunks_markdown(d):
    return chunking.chunk_documents(d, chunking.chunk_markdown, "doc_id")


@query("pdf_chunks")
def chunks_pages(p):
    return chunking.chunk_pages(p.select("source", F.coalesce("page_start", F.col("chunk_index")).alias("page_no"), "text"))


# --- scores and filters


@query("v2_chunks")
def measures(v):
    m = prefilter.measures(F.col("text"), F.col("source"))
    names = [k for k in m if k not in ("mojibake_tokens", "military_keyword_hits")]
    return v.select("id", *[m[k].alias(k) for k in names]).distinct()


def _prefiltered(v):
    return prefilter.prefilter(relational.first_wins(v.select("id", "text", "source", "ingested_at"), F.col("id"), "ingested_at"))


@query("v2_chunks")
def prefilter_rows(v):
    r = F.col("rule_prefilter")
    return _prefiltered(v).select("id", r["keep"].alias("keep"), F.round(r["score"] * 100).cast("long").alias("score100"), r["quality_level"].alias("quality_level"), F.array_join(r["issues"], ",").alias("issues"))


@query("v2_chunks")
def prefilter_totals(v):
    return prefilter.prefilter_stats(_prefiltered(v))["total"]


@query("v2_chunks")
def prefilter_issues(v):
    return prefilter.prefilter_stats(_prefiltered(v))["issues"]


@query("v2_chunks")
def prefilter_sources(v):
    return prefilter.prefilter_stats(_prefiltered(v))["sources"]


@query("v2_chunks")
def prefilter_buckets(v):
    return prefilter.prefilter_stats(_prefiltered(v))["buckets"]


@query("v2_chunks")
def keyword_hits(v):
    hits = T.keyword_hits(F.concat_ws("\n", F.coalesce("text", F.lit("")), F.coalesce("source", F.lit(""))), lexicons.KEYWORDS)
    return v.select("id", F.explode(hits).alias("term")).distinct()


@query("v2_chunks")
def top_keywords(v):
    return relational.top_terms(v.dropDuplicates(["id"]), lexicons.KEYWORDS, 20)


@query("v2_chunks")
def relevant_rows(v):
    r = F.col("relevance")
    scored = relational.relevance(v.select("id", "title", "text").distinct(), lexicons.TITLE_WEIGHTS, lexicons.BODY_WEIGHTS, lexicons.EXCLUDED_TITLES, lexicons.PAGE_RISKS)
    return scored.select("id", r["title_score"].alias("title_score"), r["body_score"].alias("body_score"), r["score"].alias("score"), r["keep"].alias("keep"))


# --- deduplication, union, resumption, splits


@query("documents")
def dedup_first_wins(d):
    return relational.first_wins(d.select("doc_id", "text"), T.hash_strict(F.coalesce("text", F.lit(""))), "doc_id").select("doc_id")


@query("documents")
def dedup_skipped(d):
    return relational.duplicates_skipped(d, T.hash_strict(F.coalesce("text", F.lit(""))))


@query("v2_chunks")
def id_rewrite(v):
    rows = relational.rewrite_ids(v.select("id", "dataset_source", "ingested_at"), "dataset_source", "ingested_at")
    return rows.groupBy("id").agg(F.count("*").alias("n"), F.max(F.col("rewritten").cast("int")).alias("rewritten"))


@query_all
def union_provenance(read):
    parts = {"documents": read("documents").select(F.col("doc_id").cast("string").alias("id"), "text"), "chunks": read("v2_chunks").select("id", "text", "title"), "pdf": read("pdf_chunks").select("id", "text", "page_start")}
    rows = relational.union_tagged(parts, "v2")
    return rows.groupBy("dataset_version", "dataset_source", "source_rank").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.count("page_start").alias("paged"))


@query_all
def resume_rows(read):
    return relational.not_done(read("v2_chunks").select("id").distinct(), read("chunk_labels")).select("id")


@query_all
def resume_groups(read):
    answers = read("sft_answers")
    materials = answers.groupBy(F.col("material_id").alias("id")).agg(F.max("question_count").alias("expected"))
    return relational.groups_not_done(materials, answers.where("sft_answer.status = 'ok'").select("id")).select("id", "expected")


@query("documents")
def split_parts(d):
    return relational.split_even(d.select("doc_id"), 4, "doc_id")


@query("documents")
def shard_rows(d):
    """Rows and bytes of shards of at most a million bytes each."""
    rows = relational.shard_by_bytes(d.select("doc_id", "text"), 1_000_000, "doc_id")
    return rows.groupBy("shard").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.min("doc_id").alias("first_id"))


@query("v2_chunks")
def rejected_head(v):
    """The first 200 rejected rows, as a report shows them."""
    return relational.head_of(_prefiltered(v).where("not rule_prefilter.keep").select("id"), 200, "id")


@query("v2_chunks")
def source_stats(v):
    rows = relational.source_stats(relational.first_wins(v.select("id", "text", "dataset_source", "ingested_at"), F.col("id"), "ingested_at"))
    return rows.select("dataset_source", "chunks", "chars", F.array_join("first_ids", "|").alias("first_ids"))


@query("v2_chunks")
def length_stats(v):
    return relational.length_stats(v)


@query("pdf_chunks")
def chunk_totals(p):
    return relational.chunk_stats(p)


@query("v2_chunks")
def relevance_buckets(v):
    scored = relational.relevance(v.select("id", "title", "text").distinct(), lexicons.TITLE_WEIGHTS, lexicons.BODY_WEIGHTS, lexicons.EXCLUDED_TITLES, lexicons.PAGE_RISKS)
    return relational.score_buckets(scored, F.col("relevance.score"))


@query("taxonomy_leaves")
def label_forms(leaves):
    """Catalog entries as JSON, with the names that another catalog has, brought to one form."""
    raw = F.try_parse_json(F.to_json(F.struct("label_id", F.struct("label_id").alias("other"), "level1", "level2", F.col("level3").alias("name"), "full_path")))
    x = F.col("x")
    return leaves.select(taxonomy.normal_label(raw).alias("x")).select(*(x[k].alias(k) for k in ("id", "side", "side_name", "l1", "l2", "leaf")), F.array_join(x["path"], ">").alias("path"))


@query("v2_chunks")
def category_counts(v):
    return relational.category_counts(v)


@query("v2_chunks")
def url_normal(v):
    return v.select("id", html.normal_url(F.col("url")).alias("url"), html.url_matches(F.col("url"), (), "/wiki/").alias("wiki")).distinct()


# --- instruction rows


def _pairs(a):
    q, s = F.col("sft_question"), F.col("sft_answer")
    return a.select("id", q["question"].alias("q"), s["answer"].alias("a"), q["question_type"].alias("t"), q["status"].alias("qs"), s["status"].alias("s"), q["risk_label"].alias("qr"), s["risk_label"].alias("ar"))


def _verdict_columns(c, *names):
    return [F.array_join(c["issues"], ",").alias("issues"), *(c[k].alias(k) for k in ("score", "pass_filter", "quality_level", "reason", "suggested_action", "risk_label", "status", *names))]


def _replies(a, reply):
    """Rows with raw, a reply as a variant."""
    return a.selectExpr("*", *replies.NUMBERS).withColumn("raw", F.try_parse_json(F.expr(reply)))


@query("sft_answers")
def question_checks(a):
    c = instruct.question_check(F.col("q"))
    return _pairs(a).where(c.isNotNull()).select("id", *_verdict_columns(c, "rewrite_suggestion")).distinct()


@query("sft_answers")
def answer_checks(a):
    c = instruct.answer_check(F.col("q"), F.col("a"))
    return _pairs(a).where(c.isNotNull()).select("id", *_verdict_columns(c, "answer_issue_type")).distinct()


@query("sft_answers")
def question_evals(a):
    rows = _replies(a, replies.VERDICT).select("id", instruct.question_eval(F.col("raw"), 7).alias("v"))
    return rows.select("id", *_verdict_columns(F.col("v"), "rewrite_suggestion")).distinct()


@query("sft_answers")
def answer_evals(a):
    rows = _replies(a, replies.VERDICT).select("id", instruct.answer_eval(F.col("raw"), 7).alias("v"))
    return rows.select("id", *_verdict_columns(F.col("v"), "answer_issue_type")).distinct()


def _plan_text(plan):
    return F.array_join(F.transform(plan, lambda p: F.concat_ws(":", p["question_type"], p["count"].cast("string"), p["reason"])), ",")


@query("sft_answers")
def material_evals(a):
    v = F.col("v")
    rows = _replies(a, replies.EVAL).select("id", instruct.material_eval(F.col("raw")).alias("v"))
    return rows.select("id", v["recommended_question_count"].alias("n"), F.array_join(v["recommended_question_types"], ",").alias("types"), _plan_text(v["question_type_plan"]).alias("plan"), F.array_join(v["issues"], ",").alias("issues"), v["reason"].alias("reason"), v["suggested_use"].alias("suggested_use"), v["question_count_reason"].alias("why")).distinct()


@query("sft_answers")
def capped_plans(a):
    return _replies(a, replies.EVAL).select("id", _plan_text(instruct.capped_plan(F.col("raw"), 3)).alias("plan")).distinct()


@query("sft_answers")
def normal_questions(a):
    """Questions of replies with the type planned for the row, two at most."""
    made = instruct.normal_questions(F.col("raw"), F.array(F.coalesce("planned_question_type", F.lit(""))), F.lit(2), F.col("sft_question.risk_label"), F.col("sft_question.target_label_id"))
    rows = _replies(a, replies.QUESTIONS).select("id", "created_at", F.posexplode(made).alias("place", "x"))
    return rows.select("id", "place", "x.*").distinct()


@query("sft_answers")
def normal_answers(a):
    return _replies(a, replies.ANSWER).select("id", instruct.normal_answer(F.col("raw")).alias("v")).select("id", "v.*").distinct()


@query_all
def classifications(read):
    """Replies to the first candidates of the catalog."""
    leaves = read("taxonomy_leaves").where("side = 'fact'").orderBy("label_id").limit(5)
    few = leaves.agg(F.array_sort(F.collect_list(F.struct("label_id", "full_path"))).alias("candidates"))
    v = F.col("v")
    rows = _replies(read("sft_answers"), replies.CHOICE).join(F.broadcast(few)).select("id", instruct.classification(F.col("raw"), F.col("candidates")).alias("v"))  # one row
    return rows.select("id", v["primary"]["label_id"].alias("label_id"), v["primary"]["full_path"].alias("full_path"), F.array_join(v["task_types"], ",").alias("tasks"), F.array_join(v["evidence_keywords"], ",").alias("words"), F.array_join(v["candidate_label_ids"], ",").alias("offered"), *(v[k].alias(k) for k in ("source_type", "risk_label", "confidence", "reason", "status"))).distinct()


@query("sft_answers")
def admissions(a):
    """Which stage takes which row; the verdict on a question is the one that needs no judge."""
    p, c = _pairs(a), instruct.question_check(F.col("q"))
    three = (F.col("q"), F.col("qs"), F.col("qr"))
    labels = instruct.admitted_to_labels(*three, c["pass_filter"], c["score"], 0)
    scored = instruct.admitted_to_labels(*three, F.lit(None).cast("boolean"), c["score"], 2)
    return p.select("id", instruct.admitted(*three, empty_too=True, any_status=True).alias("filter"), instruct.admitted(*three).alias("answers"), instruct.admitted(*three, refused_too=True).alias("answers_all"), labels.alias("labels"), scored.alias("labels_of_two")).distinct()


@query_all
def stage_input(read):
    """The next hundred questions to answer: admitted, not answered yet, in order of id."""
    rows = _pairs(read("sft_answers"))
    done = rows.where("s = 'ok'").where(F.length("a") > 200).select("id")
    return instruct.stage_rows(rows.select("id", "q", "qs", "qr").distinct(), instruct.admitted(F.col("q"), F.col("qs"), F.col("qr")), done, 100, "id").select("id")


@query("sft_answers")
def pair_risks(a):
    return _pairs(a).select("id", instruct.pair_risk(F.col("ar"), F.col("qr")).alias("risk")).distinct()


def _exported(a):
    """Rows with verdicts and skip reason: the judge's of the answer, and the one of the question that needs none."""
    rows = _replies(a, replies.VERDICT).select("*", instruct.answer_eval(F.col("raw"), 3).alias("av"), instruct.question_check(F.col("sft_question.question")).alias("qv"))
    q, s = F.col("sft_question"), F.col("sft_answer")
    reason = instruct.skip_reason(q["question"], s["answer"], [q["status"], s["status"]], (F.col("av.pass_filter"), F.col("qv.pass_filter")))
    return rows.withColumn("skip", reason)


@query("sft_answers")
def export_reasons(a):
    p = _exported(a)
    return p.groupBy(F.coalesce("skip", F.lit("exported")).alias("reason"), F.coalesce(F.nullif("sft_question.question_type", F.lit("")), F.lit("unknown")).alias("question_type")).agg(F.count("*").alias("n"))


@query("sft_answers")
def export_counters(a):
    p = _exported(a)
    return instruct.export_counts(p, F.col("skip"), question_type=F.col("sft_question.question_type"), answer_score=F.col("av.score"), question_score=F.col("qv.score"))


@query("sft_answers")
def chat_rows(a):
    rows = _pairs(a).where(instruct.skip_reason(F.col("q"), F.col("a"), [F.col("qs"), F.col("s")]).isNull())
    turns = instruct.chat_messages(F.col("q"), F.col("a"), "要准确")
    return rows.select("id", F.posexplode(turns).alias("place", "x")).select("id", "place", "x.role", "x.content").distinct()


@query("sft_answers")
def plans_normal(a):
    """Each material's plan from its planned types, to the number of questions it should have; then one row a question."""
    plan = a.groupBy("material_id").agg(F.max("question_count").alias("total"), F.array_sort(F.collect_set("planned_question_type")).alias("types"))
    items = F.transform("types", lambda t: F.struct(t.alias("question_type"), F.lit(1).alias("count"), F.lit("").alias("reason")))
    normal = plan.select(F.col("material_id").alias("id"), "total", instruct.normal_plan(items, F.col("total")).alias("plan"))
    rows = instruct.expand(normal, instruct.type_sequence(F.col("plan")))
    return rows.select("id", "material_id", "question_index", "question_count", "planned_question_type")


@query("taxonomy_leaves")
def label_numbers(leaves):
    numbered = taxonomy.numbered_labels(leaves.drop("label_id"), {"fact": "F", "operation": "O"})
    return numbered.select("label_id", "side", "source_path", "level1", "level2", "level3")


@query_all
def label_candidates(read):
    """The ten best labels of each question."""
    questions = _pairs(read("sft_answers")).select("id", "q").distinct()
    return taxonomy.candidates(questions, read("taxonomy_leaves"), 10, "id", "q").select("id", "label_id", "score", "rank")
