import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as t

from corpusloom import lexicons
from corpusloom.operators import chunking, html, instruct, prefilter, provider, relational, taxonomy
from corpusloom.sources import files

PROSE = "军事训练是国防建设的重要内容，部队应当稳妥组织演习，检验指挥流程与后勤保障。"


def varied(n, seed=0):
    """n characters of text with many different characters."""
    random.seed(seed)
    return "".join(random.choice("军事训练国防建设演习指挥后勤保障天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏") for _ in range(n))


def scored(spark, *texts):
    df = spark.createDataFrame([(f"{k:03}", x, "a/b") for k, x in enumerate(texts)], "id string, text string, source string")
    return [r["rule_prefilter"] for r in prefilter.prefilter(df).orderBy("id").collect()]


@pytest.mark.parametrize(
    "text, issue, present",
    [
        (varied(119), "too_short", True), (varied(120), "too_short", False), (varied(259), "short_text", True), (varied(260), "short_text", False), (varied(5001), "too_long", True), (varied(5000), "too_long", False),
        (varied(300) + "" * 4, "private_use_chars", True), (varied(300) + "哈" * 12, "repeated_char_noise", True), (varied(300) + "哈" * 11, "repeated_char_noise", False), (varied(300) + "\x01", "control_chars", True),
        (varied(300) + "http://a " * 4, "url_heavy", True), (varied(300) + "http://a " * 3, "url_heavy", False), ("天地玄黄" * 80, "weak_military_relevance", True), (varied(300) + "制作炸药", "actionable_harm_risk", True), ("", "empty_text", True), (None, "empty_text", True),
    ],
)
def test_prefilter_bounds(spark, text, issue, present):
    (r,) = scored(spark, text)
    assert (issue in r["issues"]) == present


def test_prefilter_fatal_counts(spark):
    a, b, c, d = scored(spark, varied(300) + "" * 4, varied(300, 1) + "" * 5, varied(3000, 2) + "€" * 11, varied(3000, 3) + "€" * 12)
    assert a["keep"] and not b["keep"]
    assert "possible_mojibake" in c["issues"] and "suspected_mojibake" in d["issues"] and not d["keep"]


def test_prefilter_first_kept_wins(spark):
    good, bad = varied(400), "短"
    rows = scored(spark, bad, good, good + " ", bad)
    assert [r["keep"] for r in rows] == [False, True, False, False]
    assert "duplicate_text" in rows[2]["issues"] and "duplicate_text" not in rows[3]["issues"]


def test_prefilter_empty_and_stats(spark):
    empty = spark.createDataFrame([], "id string, text string, source string")
    assert prefilter.prefilter(empty).count() == 0
    stats = prefilter.prefilter_stats(prefilter.prefilter(spark.createDataFrame([("1", varied(300), "txt/a"), ("2", "x", None)], "id string, text string, source string")))
    assert stats["total"].first()[:] == (2, 1, 1)
    assert {r[0] for r in stats["sources"].collect()} == {"txt", "unknown"}


def test_reference_lines(spark):
    cite = "[1] Smith J. Title[J]. Journal, 2001, 3(2): 1-9"
    assert not scored(spark, varied(400) + "\n" + "\n".join([cite] * 3))[0]["issues"].count("reference_like_list")
    assert "reference_like_list" in scored(spark, varied(400) + "\n" + "\n".join([cite] * 4))[0]["issues"]
    assert "reference_section" in scored(spark, varied(400) + "\n参考文献\n" + "\n".join([cite] * 4))[0]["issues"]


def test_cut_long_keeps_everything():
    policy = chunking.ChunkPolicy(10, 50, 60)
    text = "".join(f"这是第{k}句话内容若干。" for k in range(30)) + "长" * 150
    parts = chunking.cut_long(text, policy)
    assert "".join(parts) == text and all(chunking.ink(p) <= 60 for p in parts)
    raw = chunking.cut_long(text, policy, len)
    assert "".join(raw) == text and all(len(p) <= 60 for p in raw)


def test_pack_raw_boundaries():
    policy = chunking.ChunkPolicy(5, 20, 30)
    assert chunking.pack_raw(["a" * 18], policy) == ["a" * 18]
    assert chunking.pack_raw(["a" * 10, "b" * 16], policy) == ["a" * 10 + "\n\n" + "b" * 16]  # 12 + 16 + 2 = 30
    assert chunking.pack_raw(["a" * 10, "b" * 17], policy) == ["a" * 10, "b" * 17]
    assert chunking.pack_raw(["a" * 4], policy) == []


def test_pending_short_unit_is_dropped():
    policy = chunking.ChunkPolicy(10, 30, 40)
    units = [chunking.Unit("x" * 5, ("s",)), chunking.Unit("y" * 38, ("t",))]
    assert [u.text for u in chunking.pack_units(units, policy, chunking.first_section)] == ["y" * 38]


def test_plain_units():
    text = "目录\n第一章 甲\n第一章 甲\n正文一行\n正文二行\n\n记者：问题一？答：回答一。"
    units = list(chunking.plain_units(text))
    assert units[0].text == "正文一行\n正文二行" and units[0].context == ("第一章 甲",)
    assert [u.text for u in units[1:]] == ["记者：问题一？", "答：回答一。"]


def test_markdown_paths():
    text = "# 甲\n\n段一\n\n```\ncode\n```\n## 乙\n段二\n\n---\n段三"
    assert [(u.text, u.context) for u in chunking.markdown_units(text)] == [("段一", ("甲",)), ("段二", ("甲", "乙")), ("段三", ("甲", "乙"))]
    assert chunking.chunk_markdown("a" * 100 + "\n\n" + "b" * 100) == [("a" * 100, None), ("b" * 100, None)]
    assert len(chunking.chunk_markdown("# t\n" + "a" * 100 + "\n\n" + "b" * 100)) == 1


def test_page_units():
    pages = [(1, "第 1 页 / 共 2 页\n摘要：内容\n国防建设是\n重要任务。\nspare-\nparts"), (2, "正文参考文献\n[1] x"), (3, "later")]
    assert [(u.text, u.context) for u in chunking.page_units(pages)] == [("摘要：内容", (1, 1)), ("国防建设是重要任务。", (1, 1)), ("spareparts", (1, 1)), ("正文", (2, 2))]


def test_chunks_cover_and_are_numbered(spark):
    text = "\n\n".join(f"{PROSE * 5}{k}" for k in range(12))
    df = spark.createDataFrame([("d", text), ("e", None), ("f", "")], "doc_id string, text string")
    rows = chunking.chunk_documents(df, chunking.chunk_raw, "doc_id").orderBy("chunk_index").collect()
    assert [r["chunk_index"] for r in rows] == list(range(1, len(rows) + 1)) and {r["doc_id"] for r in rows} == {"d"}
    assert "\n\n".join(r["text"] for r in rows) == text and rows[0]["id"] == "d#00001"


def test_chunk_pages(spark):
    pages = spark.createDataFrame([("s", 2, PROSE * 4), ("s", 1, PROSE * 4), ("u", 1, None)], "source string, page_no int, text string")
    rows = chunking.chunk_pages(pages).collect()
    assert {(r["page_start"], r["page_end"], r["id"], r["title"]) for r in rows} == {(1, 2, "s#00001", "s")}
    assert chunking.chunk_pages(pages.limit(0)).count() == 0


def test_page_paragraphs():
    units = list(chunking.page_units([(1, "核心是信息优\n\n势，部队要\n跟上。\n12\n下一段"), (2, "完。")]))
    assert [(u.text, u.context) for u in units] == [("核心是信息优势，部队要跟上。", (1, 1)), ("下一段", (1, 1)), ("完。", (2, 2))]
    assert chunking.page_title("a/b.pdf", []) == "b" and chunking.page_title("a/.pdf", [chunking.Unit("摘要：某"), chunking.Unit("标题是它")]) == "标题是它"


def test_relational(spark):
    df = spark.createDataFrame([(1, "a", "s"), (2, "a", "s"), (3, None, "t"), (4, None, "t")], "n int, id string, dataset_source string")
    assert sorted(r["n"] for r in relational.first_wins(df, F.col("id"), "n").collect()) == [1, 3]
    assert relational.duplicates_skipped(df, F.col("id")).first()[:] == (4, 2, 2)
    assert sorted(r["id"] for r in relational.rewrite_ids(df.where("id is not null"), "dataset_source", "n").collect()) == ["a", "s/a"]
    done = spark.createDataFrame([("a",), (None,)], "id string")
    assert relational.not_done(df, done).count() == 2
    assert [r["part"] for r in relational.split_even(df, 3, "n").orderBy("n").collect()] == [1, 1, 2, 2]
    assert sorted(r["n2"] for r in relational.numbered(df.withColumnRenamed("n", "k"), "k").withColumnRenamed("n", "n2").collect()) == [1, 2, 3, 4]


def test_groups_not_done(spark):
    df = spark.createDataFrame([("a", 2), ("b", 1), ("c", 0)], "id string, expected int")
    done = spark.createDataFrame([("a#q0001",), ("b#q0001",)], "id string")
    assert [r["id"] for r in relational.groups_not_done(df, done).collect()] == ["a"]


def test_shards(spark):
    df = spark.createDataFrame([(k, "x" * n) for k, n in enumerate([701] * 40 + [30, 5000, 1, 1])], "id int, text string")
    size = F.length("text")
    rows = relational.shard_by_bytes(df, 1000, "id", size=size).orderBy("id").collect()
    want, used, shard = [], 0, 0
    for r in rows:
        if used and used + r["bytes"] > 1000:
            used, shard = 0, shard + 1
        want.append(shard)
        used += r["bytes"]
    assert [r["shard"] for r in rows] == want
    big = relational.shard_by_bytes(spark.range(30_000).withColumn("text", F.lit("y" * 20)), 5000, "id", size=F.lit(21)).groupBy("shard").agg(F.sum("bytes").alias("b"), F.min("id").alias("low"), F.max("id").alias("high")).orderBy("shard").collect()
    assert all(r["b"] <= 5000 for r in big) and [r["shard"] for r in big] == list(range(len(big))) and all(a["high"] + 1 == b["low"] for a, b in zip(big, big[1:]))
    assert relational.shard_by_bytes(df.limit(0), 1000, "id").count() == 0
    assert df.limit(1).select(relational.line_bytes("id", "text")).first()[0] == len('{"id":0,"text":"' + "x" * 701 + '"}\n')


def test_first_wins_limits_groups_before_its_shuffle(spark):
    plan = relational.first_wins(spark.range(10), F.col("id") % 2, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_events_and_buckets(spark):
    rows = [("1", "dev", " a  b ", [("x",), ("y",), ("x",), (None,)]), ("2", "dev", " ", [("x",)]), ("3", None, "c", None)]
    got = relational.event_chunks(spark.createDataFrame(rows, "id string, split string, text string, event_list array<struct<event_type:string>>"))
    found = {r["id"]: (r["text"], r["event_types"], r["event_count"]) for r in got.collect()}
    assert found == {"events/dev/1": ("a b", ["x", "y"], 4), "events/3": ("c", [], 0)}
    assert {(r["event_type"], r["n"]) for r in relational.event_type_counts(got).collect()} == {("x", 1), ("y", 1)}
    assert relational.event_stats(got).where("split is null").orderBy(F.desc("n")).first()["event_count_avg"] == 2.0
    buckets = relational.score_buckets(spark.createDataFrame([(-3,), (4,), (5,), (250,)], "s int"), F.col("s")).collect()
    assert {(r["bucket"], r["n"]) for r in buckets} == {(0, 2), (5, 1), (95, 1)}


def test_relevance(spark):
    df = spark.createDataFrame([("军事理论", "军队 " * 9), ("军事列表", "军队 " * 9), ("无关", None)], "title string, text string")
    rows = relational.relevance(df, lexicons.TITLE_WEIGHTS, lexicons.BODY_WEIGHTS, lexicons.EXCLUDED_TITLES, lexicons.PAGE_RISKS).collect()
    assert [r["relevance"]["keep"] for r in rows] == [True, False, False] and rows[0]["relevance"]["score"] == 30


@pytest.mark.parametrize("total, counts", [(3, [2, 1]), (1, [1]), (6, [2, 4]), (0, []), (None, [])])
def test_plan_counts(spark, total, counts):
    plan = '[{"question_type": "qa", "count": 2}, {"question_type": "unknown", "count": 3}, {"question_type": "summary", "count": null, "reason": "r"}]'
    df = spark.createDataFrame([(plan, total)], "p string, n int")
    got = df.select(instruct.normal_plan(instruct.plan_items(F.try_parse_json("p")), F.col("n")).alias("x")).first()["x"]
    assert [i["count"] for i in got] == counts


def test_plan_fallback_and_expand(spark):
    df = spark.createDataFrame([("m", ["qa", "plan"], 4)], "id string, types array<string>, n int")
    df = df.withColumn("plan", instruct.normal_plan(F.lit(None).cast(instruct.PLAN), F.col("n"), F.col("types")))
    rows = instruct.expand(df.select("id", "plan"), instruct.type_sequence(F.col("plan"))).collect()
    assert [(r["id"], r["question_index"], r["planned_question_type"]) for r in rows] == [("m#q0001", 1, "qa"), ("m#q0002", 2, "plan"), ("m#q0003", 3, "plan"), ("m#q0004", 4, "plan")]


def test_plan_without_anything(spark):
    got = spark.range(1).select(instruct.normal_plan(F.lit(None).cast(instruct.PLAN), F.lit(3)).alias("x")).first()["x"]
    assert [(i["question_type"], i["count"], i["reason"]) for i in got] == [("qa", 3, lexicons.FALLBACK_REASON)]


def replies_of(spark, *rows):
    return spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, r string").withColumn("v", F.try_parse_json("r"))


@pytest.mark.parametrize("raw, score", [('"7"', 7), ("6.5", 6), ("7.5", 8), ("null", 0), ('"x"', 0), ("-1", 0), ("11", 10), ("true", 1), ('"7d"', 0), ("[3]", 0), ('" 8 "', 8)])
def test_scores(spark, raw, score):
    assert replies_of(spark, f'{{"s": {raw}}}').select(instruct.score_of(instruct.field(F.col("v"), "s"))).first()[0] == score


def test_judge(spark):
    df = replies_of(spark, '{"score": 8, "pass_filter": " Yes", "risk_label": "odd"}', '{"score": 6, "pass_filter": true}', None, '{"score": 9}', '{"score": 9, "risk_label": "refuse_or_exclude"}', '{"score": 9, "answer_issue_type": "unsafe"}', '{"score": 9, "pass_filter": "是"}').orderBy("k")
    q = [r["x"] for r in df.select(instruct.question_eval(F.col("v"), 7).alias("x")).collect()]
    assert [r["pass_filter"] for r in q] == [True, False, False, True, False, True, False]
    assert q[0]["risk_label"] == "needs_caution" and q[1]["suggested_action"] == "drop" and [r["quality_level"] for r in q[:4]] == ["良好", "可用", "不可用", "优秀"]
    a = [r["x"]["pass_filter"] for r in df.select(instruct.answer_eval(F.col("v"), 7).alias("x")).collect()]
    assert a == [True, False, False, True, True, False, False]


def test_untyped_values(spark):
    df = replies_of(spark, '{"a": true}', '{"a": false}', '{"a": 0}', '{"a": 1.5}', '{"a": []}', '{"a": ["x", null, 2]}', '{"a": "[]"}', '{"a": null}', "{}").orderBy("k")
    a = instruct.field(F.col("v"), "a")
    got = df.select(instruct.text_of(a).alias("t"), instruct.texts_of(a).alias("l"), instruct.flag_of(a, F.lit(True)).alias("f")).collect()
    assert [r["t"] for r in got] == ["True", "", "", "1.5", "", '["x",null,2]', "[]", "", ""]
    assert got[5]["l"] == ["x", "None", "2"] and got[6]["l"] == ["[]"] and got[0]["l"] == []
    assert [r["f"] for r in got] == [True, False, False, True, False, True, False, False, True]


def test_questions_of_a_reply(spark):
    df = replies_of(spark, '{"questions": [{"question": "根据材料：  甲"}, {"question": "甲"}, {"question": "材料中的乙"}]}', None).orderBy("k")
    made = instruct.normal_questions(F.col("v"), F.array(F.lit("plan")), F.lit(5), F.lit("needs_caution"), F.lit("L"))
    rows = [r[0] for r in df.select(made).collect()]
    assert [(x["question"], x["question_type"], x["risk_label"], x["target_label_id"]) for x in rows[0]] == [("甲", "plan", "needs_caution", "L"), ("材料中的乙", "qa", "needs_caution", "L")]
    assert [(x["question"], x["status"]) for x in rows[1]] == [("", "empty_question")]


@pytest.mark.parametrize("reply, ok", [('```json\n{"a": 1}\n```', True), ('text {"a": 1} more', True), ("no json", False), (None, False), ('{"a": ', False)])
def test_extract_json(spark, reply, ok):
    got = spark.createDataFrame([(reply,)], "r string").select(instruct.extract_json(F.col("r"))).first()[0]
    assert (got is not None) == ok and (not ok or '"a"' in got)


def test_pair_checks(spark):
    df = spark.createDataFrame([("", "x"), ("问题" * 4, "短"), ("根据材料回答问题", "答" * 30), ("问" * 7, "答" * 20), ("问" * 8, "答" * 20), (None, None)], "q string, a string")
    q = [r[0] and r[0]["issues"][0] for r in df.select(instruct.question_check(F.col("q"))).collect()]
    a = [r[0] and r[0]["issues"][0] for r in df.select(instruct.answer_check(F.col("q"), F.col("a"))).collect()]
    assert q == ["empty_question", None, "depends_on_source_context", "too_short", None, "empty_question"] and a == ["empty_question", "answer_too_short", None, None, None, "empty_question"]


def test_export(spark):
    df = spark.createDataFrame([("q", "a", None), ("q", "a", "api_error"), ("", "a", "ok"), ("q", " ", "ok"), ("q", "a", "")], "q string, a string, s string")
    assert [r[0] for r in df.select(instruct.skip_reason(F.col("q"), F.col("a"), [F.col("s")])).collect()] == [None, "bad_status", "missing_question", "missing_answer", None]
    assert df.limit(1).select(instruct.skip_reason(F.col("q"), F.col("a"), [], (F.lit(None).cast("boolean"), F.lit(False)))).first()[0] == "bad_status"
    turns = df.select(instruct.chat_messages(F.col("q"), F.col("a"), "sys").alias("m")).first()["m"]
    assert [x["role"] for x in turns] == ["system", "user", "assistant"]
    assert df.limit(1).select(instruct.distinct_questions(F.array(F.lit(" a"), F.lit("a"), F.lit(""), F.lit("b")), F.lit(5))).first()[0] == ["a", "b"]
    assert df.limit(1).select(instruct.strip_prefixes(F.lit("根据材料，结合材料：甲"))).first()[0] == "甲"


def test_taxonomy(spark):
    lines = spark.createDataFrame([("fact", "f.md", k, x) for k, x in enumerate(["- early", "# 甲", "- 一", "## 乙", "- 二", "# 丙", "- 三"])], "side string, path string, line_no int, line string")
    rows = taxonomy.read_markdown(lines).orderBy("level3").collect()
    assert {(r["level1"], r["level2"], r["level3"]) for r in rows} == {("甲", "未分组", "一"), ("甲", "乙", "二"), ("丙", "乙", "三")}
    labels = spark.createDataFrame([("F1", "friendly", "国防", "制度", "兵役制度"), ("F2", "fact", "历史", None, "战史")], "label_id string, side string, level1 string, level2 string, level3 string").withColumn("full_path", F.concat_ws(">", "side", "level1", "level2", "level3"))
    texts = spark.createDataFrame([("t", "国防与兵役制度"), ("n", None)], "id string, text string")
    best = taxonomy.candidates(texts, labels, 1).orderBy("id").collect()
    assert [(r["id"], r["label_id"], r["score"], r["rank"]) for r in best] == [("n", "F2", 4.0, 1), ("t", "F1", 8 * 3 + 1.5 * 4 + 3 + 4, 1)]
    side = taxonomy.candidates(texts.limit(1).withColumn("text", F.lit("我方的事")), labels, 2).orderBy("rank").collect()
    assert [(r["label_id"], r["score"]) for r in side] == [("F1", 9.5), ("F2", 4.0)] and taxonomy.candidates(texts, labels.limit(0)).count() == 0


def test_labels_of_any_form(spark):
    raw = ['{"id": "F7", "path": "甲/乙/丙"}', '{"label_id": "Z1", "side": "opponent", "level1": "甲", "name": "丁"}', '{"id": "X1", "full_path": ["边", " 甲 ", "", "乙", "丙"]}', "{}"]
    rows = [r["x"] for r in spark.createDataFrame(list(enumerate(raw)), "k int, r string").orderBy("k").select(taxonomy.normal_label(F.try_parse_json("r")).alias("x")).collect()]
    assert [tuple(r) for r in rows] == [
        ("F7", "friendly", "我方", "乙", "丙", "丙", ["我方", "甲", "乙", "丙"]), ("Z1", "opponent", "他方", "甲", "", "丁", ["他方", "甲", "丁"]),
        ("X1", "", "边", "甲", "乙", "丙", ["边", "边", "甲", "乙", "丙"]), ("", "", "", "", "", "", []),
    ]


def test_html(spark):
    page = '<html><head><title>站点-20标题 - 中国军网 某</title><meta name="pubdate" content="2024-1-5"></head><body><script>x</script><p>被丢弃<p>第一段正文内容足够长了<br>第二行</p><a href="/b#c">l</a><p>第一段正文内容足够长了<br>第二行</p></body></html>'
    df = spark.createDataFrame([("http://A.com/x/", page), (None, None)], "url string, html string")
    a, b = html.articles(df).collect()
    assert a["text"] == "第一段正文内容足够长了\n第二行" and a["publish_date"] == "2024-1-5" and a["links"] == ["http://A.com/b"] and a["title"] == "站点-20标题" and b["text"] == ""
    urls = spark.createDataFrame([("HTTP://A.com/X#f",), ("ftp://a",), (None,)], "u string")
    assert [r[0] for r in urls.select(html.normal_url(F.col("u"))).collect()] == ["http://a.com/X", None, None]
    assert [r[0] for r in urls.select(html.url_matches(F.col("u"), ("a.com",))).collect()] == [True, False, False]
    assert urls.limit(1).select(html.list_pages(F.lit("http://a/index.shtml"), F.lit(3))).first()[0] == ["http://a/index.shtml", "http://a/index_2.shtml", "http://a/index_3.shtml"]


def test_frontier(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    got = {r["url"]: r["depth"] for r in html.frontier(links, spark.createDataFrame([("a",)], "url string"), 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_providers(spark):
    df = spark.createDataFrame([("1", "p"), ("2", None)], "id string, prompt string")
    rows = provider.complete(df, provider.RuleProvider(len)).collect() if False else provider.complete(df, provider.RuleProvider(str.upper)).collect()
    assert [(r["reply"], r["status"]) for r in rows] == [("P", "ok"), (None, "api_error")]
    recorded = df.where("id = '1'").select(F.sha2("prompt", 256).alias("prompt_hash"), F.lit("R").alias("reply"))
    assert {r["id"]: r["status"] for r in provider.replay(df, recorded).collect()} == {"1": "ok", "2": "api_error"}


def test_json_policies(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": "1", "text": "x"}\n\nbroken\n{"id": "2", "text": "y"}\n')
    schema = "id string, text string"
    assert files.read_lenient(spark, [str(path), str(tmp_path / "missing")], schema).count() == 2
    rows = files.read_quarantined(spark, str(path), schema).collect()
    assert len(rows) == 3 and sum(r["id"].startswith("__invalid") for r in rows) == 1
    with pytest.raises(Exception):
        files.read_strict(spark, str(path), schema).collect()
    files.write_lines(spark.createDataFrame([("1", None)], schema), str(tmp_path / "out"))
    assert any('"text":null' in p.read_text() for p in (tmp_path / "out").glob("part-*"))


def test_charsets_and_dump(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/u.TXT").write_bytes("﻿国防".encode())
    (tmp_path / "d/g.txt").write_bytes("国防建设".encode("gb18030"))
    got = {r["path"]: r["text"] for r in files.read_texts(spark, str(tmp_path / "d")).collect()}
    assert got == {"u.TXT": "国防", "g.txt": "国防建设"}
    (tmp_path / "d/x.txt").write_bytes(b"ab\xff\xfe\xfa")
    got = files.read_texts(spark, str(tmp_path / "d"), charsets=("utf-8-sig", "gb18030"), errors="ignore", in_order=True).collect()
    assert [(r["path"], r["text"]) for r in got] == [("g.txt", "国防建设"), ("u.TXT", "国防"), ("x.txt", "ab")]
    pages = spark.createDataFrame([("0", "x", "y" * 80), ("0", "x", "y"), ("1", "x", "y" * 80), ("0", None, None)], "ns string, raw_text string, text string")
    assert files.page_counts(files.admitted_pages(pages)).first()[:] == (4, 1, 1, 1, 1)
    (tmp_path / "w.xml").write_text('<mediawiki><page><title>T</title><ns>0</ns><id>007</id><revision><id>9</id><text bytes="3">abc</text></revision></page></mediawiki>')
    assert files.read_wiki_dump(spark, str(tmp_path / "w.xml")).first()[:] == ("007", "9", "T", "0", "abc")
    assert files.byte_size("2K") == 2048


def test_stream_equals_batch(spark, tmp_path):
    from corpusloom.streaming import incremental

    schema = "id string, text string"
    spark.createDataFrame([("1", "a  b"), ("2", "c")], schema).write.json(str(tmp_path / "in"))
    got = []
    stream = incremental.clean_stream(incremental.read_stream(spark, str(tmp_path / "in"), schema))
    incremental.run_available(stream, lambda df, _: got.extend(r["text"] for r in df.collect()), str(tmp_path / "check"))
    spark.createDataFrame([("3", "a b"), ("4", "d")], schema).write.mode("append").json(str(tmp_path / "in"))
    incremental.run_available(incremental.clean_stream(incremental.read_stream(spark, str(tmp_path / "in"), schema)), lambda df, _: got.extend(r["text"] for r in df.collect()), str(tmp_path / "check"))
    assert sorted(got) == ["a b", "c", "d"]
    assert t.StringType() == stream.schema["text"].dataType
