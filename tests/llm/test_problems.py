"""The operators against brute force, round trips and hand-made cases; nulls, empty tables, repeated rows, clashing columns."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bpe, encoding, lines, mixing, neardup, pairs, quality, scans, spans, splitting, vec

SIGNS = "军事训练国防建设演习指挥后勤保障天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余成岁律吕调阳云腾致雨露结为霜"
CLASHING = ("c", "t", "key", "h", "__key", "pos", "s", "n")


def clash(df, without=()):
    """df with columns named like those the operators make."""
    return df.withColumns({k: F.lit(1) for k in CLASHING if k not in without})


def words(n, seed):
    r = random.Random(seed)
    return "".join(r.choice(SIGNS) for _ in range(n))


def frame(spark, rows, schema="id string, text string"):
    return spark.createDataFrame(rows, schema)


# --- 8


def tiktoken_reference():
    import base64

    tiktoken = pytest.importorskip("tiktoken")
    P = pytest.importorskip("public_tokenizers")
    with open(bpe.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_a_reference():
    t = tiktoken_reference()
    texts = ["", None, "it's  we'll\n\n 's ''s x's't I'VE  \t end  ", "<|endoftext|>", "　 x 12３ ١٢", "  ", "a\n", "\n a", "l'll", "'", " '", "￾\x00\u0085 x", "a" * 3000, "中" * 2000, "é̈́ 😀👩‍👩‍👧", "\r\n\r\n x"]
    r = random.Random(5)
    texts += ["".join(r.choice("ab 'sz1。\n\t中ж🙂") for _ in range(r.randint(0, 60))) for _ in range(400)]
    got = bpe.Encoder().encode(pa.array(texts, pa.string())).to_pylist()
    assert got == [t.encode_ordinary(x or "") for x in texts]


def test_encoding_cache_and_round_trip():
    e = bpe.Encoder()
    texts = pa.array([words(50, k % 7) for k in range(40)])
    first, second = e.encode(texts).to_pylist(), e.encode(texts).to_pylist()
    assert first == second
    t = tiktoken_reference()
    assert [t.decode(x) for x in first] == texts.to_pylist()


def test_encode_corpus(spark):
    df = frame(spark, [(1, "x y"), (2, None), (2, None), (3, "")], "doc_id long, text string").transform(clash)
    rows = bpe.encode_corpus(df).collect()
    assert sorted((r["doc_id"], len(r["ids"])) for r in rows) == [(1, 2), (2, 0), (2, 0), (3, 0)]
    assert bpe.encode_corpus(df.limit(0)).count() == 0


# --- 10


def brute_spans(docs, span):
    seen = {}
    for i, t in docs:
        for k in range(len(t or "") - span + 1):
            seen.setdefault(t[k : k + span], set()).add(i)
    return {(a, b) for s in seen.values() for a in s for b in s if a < b}


@pytest.mark.parametrize("span", [40, 160])
def test_spans_equal_brute_force(spark, span):
    r = random.Random(span)
    common = [words(r.choice([span - 1, span, span + 1, 3 * span]), 100 + k) for k in range(8)]
    docs = [(i, words(r.randint(0, 300), i) + r.choice(["", *common]) + words(r.randint(0, 80), 999 + i)) for i in range(60)] + [(60, None), (61, ""), (62, common[0]), (63, common[0]), (64, common[3] * 2)]
    df = frame(spark, docs, "doc_id long, text string").transform(clash)
    got = {(r["id_a"], r["id_b"]) for r in spans.sharing_pairs(df, span=span).collect()}
    assert got == brute_spans(docs, span)


def test_share_of_text(spark):
    common = words(200, 1)
    docs = [(1, words(50, 2) + common), (2, common + words(70, 3)), (3, words(300, 4)), (4, None), (5, words(170, 6)), (6, words(170, 6))]
    rows = {r["id"]: r["shared_chars"] for r in spans.shared_share(frame(spark, docs, "doc_id long, text string")).collect()}
    assert rows == {1: 200, 2: 200, 3: 0, 4: 0, 5: 170, 6: 170}
    assert spans.sharing_pairs(frame(spark, [], "doc_id long, text string")).count() == 0


# --- 2


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(20):
        e = rng.integers(1, 2**62, 200).astype(np.uint64)
        a, b = rng.integers(0, 7, 200), rng.integers(0, 7, 200)
        b = np.where(rng.random(200) < 0.6, a, b)
        s = neardup.signatures(np.concatenate([e[a > 0], e[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), np.array([0, (a > 0).sum(), (a > 0).sum() + (b > 0).sum()]), 400)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04


def jaccard(a, b):
    x, y = ({s[i : i + 5] for i in range(len(s) - 4)} for s in (a, b))
    return len(x & y) / len(x | y)


def test_near_duplicates(spark):
    r = random.Random(1)
    rows = []
    for g in range(25):
        text = words(r.randint(100, 400), g)
        for v in range(r.randint(1, 4)):
            chars = list(text)
            for _ in range(r.randint(0, 12)):
                chars[r.randrange(len(chars))] = r.choice(SIGNS)
            rows.append((f"{g}-{v}", " ".join(["".join(chars[:50]), "".join(chars[50:])])))
    rows += [("copy", rows[0][1] + "\n"), ("n", None), ("e", ""), ("s", words(79, 3)), ("s2", words(79, 3)), rows[0]]
    df = frame(spark, rows).transform(clash)
    got = {(x["id_a"], x["id_b"]) for x in neardup.similar_pairs(df).collect()}
    plain = {i: re.sub(r"\s", "", t) for i, t in rows if t}
    want = {(a, b) for a in plain for b in plain if a < b and len(plain[a]) >= 80 and len(plain[b]) >= 80 and jaccard(plain[a], plain[b]) >= 0.7}
    assert got == want
    found = {x["id"]: (x["group_id"], x["n_links"]) for x in neardup.groups(df).collect()}
    assert len(found) == len({i for i, _ in rows}) and found["copy"][0] == found["0-0"][0] and found["s"][0] != found["s2"][0]
    assert neardup.similar_pairs(df.limit(0)).count() == 0 and neardup.groups(df.limit(0)).count() == 0


def test_multiset_similarity():
    bag, alike = neardup.similarities(pa.array(["aaaaaaaa", "abcdefg", ""]), pa.array(["aaaaaaaaaa", "abcdefh", ""]), 5)
    assert bag.tolist() == pytest.approx([4 / 6, 0.5, 0]) and alike.tolist() == pytest.approx([1, 0.5, 0])


def test_hot_groups_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(vec, "PAIR_ROWS", 3)
    rows = frame(spark, [(1, k) for k in range(20)] + [(2, 5), (2, 7), (3, 1)], "k bigint, m bigint")
    assert {tuple(r) for r in vec.pairs_of(rows, ["k"], "m", "o").collect()} == {(1, a, b) for a in range(20) for b in range(a + 1, 20)} | {(2, 5, 7)}
    many = spark.range(4000).select(F.lit(1).cast("long").alias("g"), "id").unionByName(spark.range(3).select((F.col("id") + 5).alias("g"), "id")).unionByName(spark.range(1).select(F.lit(6).cast("long").alias("g"), F.lit(9).cast("long").alias("id")))
    got = vec.shared_by_two(many, "g", "id", "hot")
    assert got.where("g = 1").count() == 4000 and got.where("g = 1 and not hot").count() == 0
    assert {(r["g"], r["id"]) for r in got.where("g > 1").collect()} == {(6, 1), (6, 9)}
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_components(spark):
    edges = frame(spark, [(k, k + 1) for k in range(1, 20)] + [(30, 31), (31, 30), (40, 40)], "a long, b long")
    got = {r["node"]: r["root"] for r in neardup.components(edges).collect()}
    assert set(got.values()) == {1, 30} and got[20] == 1 and 40 not in got


# --- 4


def test_lines_and_increments(spark):
    notice = "版权声明 2024　ABC"
    rows = [(f"a{k}", "s", f"正文{k}号内容甲\n{notice.replace('2024', str(k)).lower() if k % 2 else notice}\nabc") for k in range(6)] + [(f"b{k}", "s", f"别的内容第{k}行甲乙") for k in range(40)] + [("n", None, None), ("m", None, "行行行行"), ("a0", "s", "正文0号内容甲\n" + notice + "\nabc")]
    rows += [(f"u{k}", None, "无来源的行") for k in range(5)]
    df = frame(spark, rows, "id string, source string, text string").transform(clash)
    whole = lines.count_partition(df)
    got = {(r["id"], r["line_no"]) for r in lines.repeated_lines(df, whole).collect()}
    want = {(f"a{k}", n) for k in range(6) for n in (0, 1)} | {(f"u{k}", 0) for k in range(5)} | {(f"b{k}", 0) for k in range(40)}
    assert got == want  # digits are one digit: the bodies recur, too
    first = lines.count_partition(df.where("id < 'a3'"))
    rest = df.where("id >= 'a3' or id = 'a0'")
    merged = lines.merge(first, lines.count_partition(lines.unseen(rest, first)))
    assert {tuple(r) for r in lines.excessive(merged).collect()} == {tuple(r) for r in lines.excessive(whole).collect()}
    new, gone = lines.crossings(first, merged)
    assert new.count() == lines.excessive(whole).count() and gone.count() == 0
    clean = {r["id"]: r["clean_text"] for r in lines.rebuild(df, lines.repeated_lines(df, whole)).collect()}
    assert clean["a1"] == "abc" and "m" not in clean
    assert lines.repeated_lines(df.limit(0), lines.count_partition(df.limit(0))).count() == 0


def test_updates_touch_only_what_crosses(spark, tmp_path):
    rows = [(f"a{k}", "s", f"甲乙丙丁\n本行属于{chr(0x4E00 + k)}", False) for k in range(5)] + [(f"b{k}", "s", f"独有内容{chr(0x5000 + k)}号", False) for k in range(42)]
    rows += [(f"c{k}", "t", "将要常见", False) for k in range(4)]
    new = [("a9", "s", "甲乙丙丁\n别样行", True), ("c8", "t", "将要常见", True), ("a0", "s", "甲乙丙丁", True)] + [(f"d{k}", "s", f"后来的内容{chr(0x6000 + k)}", True) for k in range(20)]
    df = frame(spark, rows + new, "id string, source string, text string, late boolean")
    done = lines.maintained(df, F.col("late"))
    whole = lines.count_partition(df)
    want = {tuple(r) for r in lines.repeated_lines(df, whole).collect()}
    assert {tuple(r) for r in done.hits.collect()} == want and {i for i, _ in want} == {f"c{k}" for k in (0, 1, 2, 3, 8)}
    # the line of a0 .. a4 was excessive and no longer is, the one of c0 .. c3 has become so; b0 .. b41 aren't touched
    assert {r[0] for r in done.concerned.collect()} == {f"a{k}" for k in (0, 1, 2, 3, 4, 9)} | {f"c{k}" for k in (0, 1, 2, 3, 8)} | {f"d{k}" for k in range(20)}
    lines.save(done.state, str(tmp_path / "state"))
    again = lines.load(spark, str(tmp_path / "state"))
    assert {tuple(r) for r in lines.excessive(again).collect()} == {tuple(r) for r in lines.excessive(whole).collect()}
    assert lines.maintained(df.limit(0), F.col("late")).hits.count() == 0


# --- 5


@pytest.mark.parametrize("overlap", [0, 7, 39, 40, 100])
def test_pieces(overlap):
    r = random.Random(overlap)
    for n in (40, 41, 60, 79, 80, 200, 1001):
        text = "".join(r.choice("甲乙丙丁。，\n 戊己") for _ in range(n))
        chars = np.frombuffer(text.encode("utf-32-le"), "<u4")
        pieces = splitting.cut(chars, 40, overlap)
        kept = min(overlap, 39)
        assert pieces[0][0] == 0 and pieces[-1][1] == n and all(b - a <= 40 for a, b in pieces)
        assert all(p[1] - q[0] == kept for p, q in zip(pieces, pieces[1:], strict=False)) and (len(pieces) > 1) == (n > 40)


def test_cuts_at_boundaries():
    text = "\n\n".join("甲" * 45 + "。" for _ in range(6))
    for a, _ in splitting.cut(np.frombuffer(text.encode("utf-32-le"), "<u4"), 110, 0)[1:]:
        assert text[a - 2 : a] == "\n\n"


def test_split_oversized(spark):
    limits = frame(spark, [("x", 10, 2), ("y", None, 1)], "dataset_source string, max_chars int, overlap_chars int")
    docs = frame(spark, [("1", "甲" * 25, "x"), ("1", "甲" * 25, "x"), ("2", "short", "x"), ("3", None, "x"), ("4", "z" * 99, "y"), ("5", "z" * 99, "q"), ("6", "😀" * 11, "x")], "id string, text string, dataset_source string").transform(clash)
    rows = splitting.split_oversized(docs, limits).orderBy("id", "piece_no").collect()
    assert [(r["id"], len(r["piece"])) for r in rows if r["id"] == "1"][:1] and {r["id"] for r in rows} == {"1", "6"} and len({(r["id"], r["piece_no"]) for r in rows}) == len(rows)
    assert splitting.split_oversized(docs.limit(0), limits).count() == 0


# --- 1


def sentences(n, seed):
    r = random.Random(seed)
    terms = ["国防建设", "军事训练", "后勤保障", "指挥流程", "水文资料", "战术条令", "稳妥推进", "同步完善", "按计划", "提前"]
    return "".join("".join(r.choice(terms) for _ in range(4)) + "。" for _ in range(n))


@pytest.mark.parametrize("wrong, right", [("latin-1", "utf-8"), ("cp1252", "utf-8"), ("mac_roman", "utf-8"), ("gb18030", "utf-8"), ("latin-1", "gb18030"), ("cp1251", "utf-8")])
def test_round_trip_of_encodings(spark, wrong, right):
    original = sentences(3, 77)
    raw = original.encode(right)
    table, size = encoding._encoder(wrong)
    if wrong in encoding.SINGLE:
        back = {int(table[c]): chr(c) for c in range(65536) if size[c]}
        broken = "".join(back[b] for b in raw)
    else:
        broken = raw.decode(wrong, "ignore")
    rows = [(str(k), sentences(6, k), "s") for k in range(60)] + [("bad", "开头。" + broken, "s"), ("fr", "L’été dernier, l’école a été fermée à Pau. " * 3, None), ("lost", "内容��内容", "s"), ("n", None, None), ("e", "", "")]
    got = {(r["id"], r["field"]): r for r in encoding.repaired(frame(spark, rows, "id string, text string, source string").transform(clash)).collect()}
    assert set(got) == {("bad", "text"), ("lost", "text")}
    if wrong in encoding.SINGLE:
        assert got["bad", "text"]["restored"] == "开头。" + original and got["bad", "text"]["complete"]
    assert not got["lost", "text"]["complete"]


def test_margins_come_from_all_clean_values(spark):
    # the 400 values whose ids have the least hashes are English, in which no chain reads anything; only the others tell what a reading must gain
    r = random.Random(5)
    stems = "отряд патруль берег вечер дорога письмо работа станция правило история порядок корабль пас ярус".split()
    texts = [f"the patrol reached station {k} before noon and returned" for k in range(450)] + [" ".join(r.choice(stems) for _ in range(12)) + "." for _ in range(300)]
    ids = [x["id"] for x in frame(spark, [(str(k), "") for k in range(750)]).orderBy(F.xxhash64("id", F.lit(0))).collect()]
    docs = frame(spark, [*zip(ids, texts, strict=True), ("odd", "отряд \x81 змгу берег."), ("bad", "отряд " + "патруль берег".encode().decode("latin-1") + " пас."), ("n", None), ("e", "")])
    assert [(x["id"], x["restored"]) for x in encoding.repaired(docs, ("text",)).collect()] == [("bad", "отряд патруль берег пас.")]
    values = docs.select("text").where("text is not null")
    model = encoding.count_characters(values)
    margins = encoding.corpus_margins(values.repartition(7), model)
    assert margins == encoding.validated_margins(model, texts) and margins.total > 0 and margins.mean > 0
    assert encoding.validated_margins(model, texts[:450]).accept(0.1, 0.1)


def test_gains_of_a_batch_are_those_of_each_value():
    texts = [words(50, k) + "Été à Pau" + words(9, k).encode("gb18030").decode("big5", "replace") for k in range(20)] + ["патруль берег" * 9, words(40, 1).encode().decode("gb18030", "replace"), "L’été", "海", "Ä", "\ue000" * 3]
    texts += [words(30, k).encode(right, "ignore").decode(wrong, "replace") for k, (wrong, right) in enumerate(encoding.CHAINS) if not right.startswith(("cp", "koi"))]
    flat = vec.codepoints(pa.array(["\n".join(texts[:9])]))[0]
    model = encoding.CharModel(np.bincount(encoding._slots(flat), minlength=1 << encoding.BIGRAM_BITS).astype(np.float32), np.bincount(encoding._single(flat), minlength=1 << encoding.UNIGRAM_BITS).astype(np.float32))
    want = []
    for text in texts:
        chars = vec.codepoints(pa.array([text]))[0]
        for chain in encoding.CHAINS:
            want += [encoding._gain(model, text[max(0, a - 1) : a] or "\n", text[a:b], new, text[b : b + 1] or "\n") for a, b, new in encoding._readings(text, chars, *chain)]
    total, mean = encoding._gains(model, texts, encoding.CHAINS)
    assert len(want) > 500 and np.allclose(sorted(total), sorted(x for x, _ in want), atol=0.01) and np.allclose(sorted(mean), sorted(x for _, x in want), atol=0.01)
    assert (encoding.gain_counts(model, texts) == sum(encoding.gain_counts(model, [x]) for x in texts)).mean() > 0.999
    r = random.Random(1)
    data = bytes(r.choice(b"\x41\x80\xbf\xc1\xc2\xdf\xe0\xef\xf0\xf4\xf5\xa1") for _ in range(30_000))
    assert encoding._stretches(data, "utf-8", 6) == [m.span() for m in encoding._UTF8.finditer(data) if m.end() - m.start() >= 6] != []
    assert encoding._stretches(b"\x41" * 2000, "utf-8") == [] and encoding._stretches(b"", "utf-8") == []


def test_encoding_of_an_empty_table(spark):
    assert encoding.repaired(frame(spark, [], "id string, text string, source string")).count() == 0


# --- 7


def test_statistics():
    lang, v = quality.statistics(pa.array(["国防建设。\n的了。", "The cat is on the mat.", None, "", "a\tb\tc\nd\te\tf", "- x\n- y"]), [("en", "the"), ("en", "is"), ("zh", "的"), ("zh", "了")])
    s = {k: v[:, i] for i, k in enumerate(quality.STATS)}
    assert [quality.LANGS[k] for k in lang[:2]] == ["zh", "en"]
    assert s["true_length"].tolist()[:4] == [9, 22, 0, 0] and s["n_lines"].tolist() == [2, 1, 0, 0, 2, 2]
    assert s["end_share"][0] == 1 and s["common_share"][1] == pytest.approx(3 / 6) and s["mean_word"][1] == pytest.approx(16 / 6)
    assert s["separators"][4] == 2 and s["marker_share"][5] == 1 and not np.isnan(v).any() and not v[2, 1:].any()


def test_sketches_merge_and_percentiles(spark):
    docs = frame(spark, [(str(k), words(k + 5, k)) for k in range(200)])
    stats = quality.measured(docs, [])
    whole = sorted(map(tuple, quality.sketches(stats).collect()))
    parts = quality.sketches(stats.where("id < '5'")).unionByName(quality.sketches(stats.where("id >= '5'"))).groupBy("lang", "stat", "bucket").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, parts.collect())) == whole
    scale = quality.Scale(whole)
    p = scale.percentiles(np.array(["zh", "zh", "xx"]), np.tile(np.array([[104.0] + [0.0] * (len(quality.STATS) - 1)]), (3, 1)))
    assert p[0, 0] == pytest.approx(50, abs=1.5) and p[2, 0] == 50


def test_kinds_with_few_labels_or_none(spark):
    docs = frame(spark, [("p", sentences(9, 1)), ("p", sentences(9, 1)), ("t", "\n".join(f"项目{k}\t{k}.5\t{k * 7}\t{k}" for k in range(20))), ("n", None), ("b", " \n")]).transform(clash)
    labels, common = frame(spark, [], "id string, kind string"), frame(spark, [], "lang string, word string")
    got = {r["id"]: r["kind"] for r in quality.scored(docs, labels, common).collect()}
    assert got == {"p": "prose", "t": "prose", "n": None, "b": None}
    two = frame(spark, [("p", "prose"), ("t", "table")], "id string, kind string")  # a kind without a label is never named
    got = {r["id"]: r["kind"] for r in quality.scored(docs, two, common).collect()}
    assert got == {"p": "prose", "t": "table", "n": None, "b": None}
    assert quality.scored(docs.limit(0), labels, common).count() == 0


def test_training_separates():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (100, 5)), rng.normal(2.5, 1, (100, 5))])
    w = quality.train(np.concatenate([x, np.ones((200, 1))], 1), np.repeat([0, 1], 100), 2)
    assert ((np.concatenate([x, np.ones((200, 1))], 1) @ w).argmax(1) == np.repeat([0, 1], 100)).mean() > 0.95


# --- 9


def test_prefix_sums(spark):
    r = random.Random(2)
    rows = [(k, "hot" if k % 3 else f"s{k % 5}", r.randint(1, 9)) for k in range(500)]
    got = mixing.prefix_sums(frame(spark, rows, "doc_id long, source string, n_tokens long")).collect()
    for source in {x[1] for x in rows}:
        own = sorted(r["before"] for r in got if r["source"] == source)
        sizes = {r["before"]: r["n_tokens"] for r in got if r["source"] == source}
        assert own[0] == 0 and all(a + sizes[a] == b for a, b in zip(own, own[1:], strict=False))


def test_mix(spark):
    rows = [(k, "a" if k < 80 else "b", 10) for k in range(100)] + [(200, None, 10), (201, "a", 0)]
    targets = frame(spark, [("m", 0.5, "a", 0.5, 1), ("m", 0.5, "b", 0.5, 2), ("m", 0.5, "none", 0.1, 3), ("big", 3.0, "b", 1.0, 4)], "mix_name string, size_ratio double, source string, target_share double, max_repeats int")
    mixed = mixing.mix(frame(spark, rows, "doc_id long, source string, n_tokens long").withColumn("extra", F.lit(1)), targets)
    report = {(r["mix_name"], r["source"]): r for r in mixing.report(mixed).collect()}
    assert abs(report["m", "a"]["tokens"] - 252.5) <= 5 and abs(report["m", "b"]["tokens"] - 252.5) <= 5
    assert report["m", "none"]["tokens"] == 0 and report["big", "b"]["tokens"] == 800 and report["big", "b"]["most_uses"] == 4
    assert mixed.members.where("uses > 2 and mix_name = 'm'").count() == 0
    empty = mixing.mix(frame(spark, [], "doc_id long, source string, n_tokens long"), targets)
    assert empty.members.count() == 0 and mixing.report(empty).count() == 4


# --- 6


def qa_rows(n=160):
    r = random.Random(4)
    rows = []
    for k in range(n):
        q = f"为什么说{words(4, k)}是{words(4, k + 1)}的基础？"
        a = "".join(sentences(1, r.randrange(10**6)) for _ in range(r.randint(2, 5)))
        if k % 4 == 0:
            q, a = f"Why did the {k}th unit move to the old harbour?", f"The unit moved because the harbour was larger. It stayed for {k} days and then it returned to the depot."
        rows.append((q, a, "qa"))
    return rows + [("什么是甲？" + str(k), "抱歉，我无法回答这个问题。", "refusal") for k in range(12)] + [(f"What is item {k}?", "I'm sorry, but I can't help with that.", "refusal") for k in range(12)]


def test_defects(spark):
    rows = qa_rows()
    ends = pairs.count_endings(frame(spark, [(a,) for _, a, _ in rows], "a string"))
    ends2, seen = pairs._ending_counts(pa.array([a for _, a, _ in rows]))
    assert (ends.ends == ends2).all() and (ends.seen == seen).all()
    usual = next(a for _, a, _ in rows if a.strip().endswith("。"))
    assert ends.oddness(usual.strip()) < ends.oddness(usual.strip()[:-1])
    model = pairs.train(rows, ends)
    q = "为什么说水文资料是国防建设的基础？"
    a = sentences(4, 5)
    cases = [(a, "qa", None), (None, "qa", "empty"), (" ", "qa", "empty"), ("N/A", "qa", "empty"), (q, "qa", "copy"), ("答：" + q, "qa", "copy"), (a[:-9], "qa", "truncated"), ("抱歉，我无法回答这个问题。", "qa", "refusal"), ("抱歉，我无法回答这个问题。", "refusal", None), ("The unit moved because the harbour was larger. It stayed for 5 days and then it returned to the depot.", "qa", "other_language")]
    got = pairs.classify(model, [(q, x, t) for x, t, _ in cases])
    assert sum(g == w for g, (_, _, w) in zip(got, cases, strict=True)) >= 9
    assert pairs.expected_language("请用英文作答：" + q) == "en" and pairs.language("Где находится отряд наблюдения") == "ru"


def test_defects_on_tables(spark):
    schema = "id string, sft_question struct<question:string,question_type:string>, sft_answer struct<answer:string>, q string, a string"
    rows = [(str(k), (q, t), (a,), "x", "y") for k, (q, a, t) in enumerate(qa_rows(60))] + [("null", None, None, None, None), ("null", None, None, None, None)]
    got = {r["id"]: r["defect"] for r in pairs.defects(frame(spark, rows, schema)).collect()}
    assert got["null"] == "empty"
    assert pairs.defects(frame(spark, [], schema)).count() == 0


# --- 3


def test_line_kinds():
    text = "第 3 页 共 9 页\n2003    Notes on Reserve Deterrence\nThe unit moved to the har-\nbour and stayed.\n— 4 —\n\n国 防 纪 要\n12\n75 per cent of\n正文，内容。"
    assert scans.classify_lines(text, 3, 4, set()) == ["page_number", "header", "text", "text", "page_number", "blank", "header", "text", "text", "text"]
    assert scans.classify_lines("5", 4, 6, set()) == ["page_number"] and scans.classify_lines("5", None, None, set()) == ["page_number"]


def scanned(k):
    r = random.Random(k)
    things = ["harbour", "logistics", "reserve", "battalion", "squadron", "quartermaster", "training", "availability"]
    return "\n".join(f"The {r.choice(things)} of the {r.choice(things)} moved to the {r.choice(things)} in good" + f"\norder and the {r.choice(things)} stayed near the {r.choice(things)}." for _ in range(8))


def test_noise_found_and_repaired(spark):
    rows = [(f"d{k}", "src", scanned(k), k, k) for k in range(60)]
    bad = "The rcserve of the batta-\nlion moved to the l0gistics in good\norder and the medium-\nlift plan stayed. The medium-lift plan and the medium-lift plan hold.\n\n　　New text begins here and the medium-lift plan goes on."
    rows += [("bad", "src", bad, 1, 2), ("null", None, None, None, None), ("empty", "src", "", 1, 1), ("null", None, None, None, None)]
    df = frame(spark, rows, "id string, source string, text string, page_start int, page_end int").withColumns({"lines": F.lit("x"), "h": F.lit(1)})
    got = {(r["line_no"], r["kind"]) for r in scans.noisy_lines(df).where("id = 'bad'").collect()}
    assert got == {(0, "misread"), (1, "misread"), (0, "hyphen")}
    out = {r["id"]: r["paragraphs"] for r in scans.repaired(df).collect()}
    assert out["bad"][0].startswith("The reserve of the battalion moved to the logistics in good order and the medium-lift plan") and len(out["bad"]) == 2
    assert "null" not in out
    assert scans.noisy_lines(df.limit(0)).count() == 0


def scan_model(words, threes=(), latin=None, cjk=None):
    m = scans.Model(np.zeros(1 << scans.WORD_BITS, np.int32), np.zeros(1 << scans.GRAM_BITS, np.int32), latin or {}, cjk or {})
    for w, n in words.items():
        m.words[scans._word_slot(w)] += n
    for text, n in threes:
        m.grams[scans._gram_slots(scans._points(text))] += n
    return m


def scan_stream(text):
    found = text.split("\n")
    return scans.de_lined(found, ["text"] * len(found))


def test_errors_of_a_stream_are_weighed_together():
    """Words broken or run together, cut over a line's end and misread at once; two misread characters in a row."""
    common = {"the": 5000, "in": 2000, "to": 3000, "into": 200, "logistics": 300, "reserve": 200, "battalion": 80, "medium-lift": 40}
    m = scan_model({**common, "logi": 1, "stlcs": 1, "thclogistics": 1, "moved": 400}, latin={"l": "i", "c": "e"})
    for text, right, misread, cut in (
        ("the logi stlcs moved", "the logistics moved", {0}, set()),
        ("the logi\nstlcs moved", "the logistics moved", {1}, set()),
        ("thclogistics moved", "the logistics moved", {0}, set()),
        ("in to the batta-\nlion in the rcs-\nerve", "in to the battalion in the reserve", {1}, {0, 1}),
        ("the medlum-\nlift moved", "the medium-lift moved", {0}, set()),
    ):
        stream = scan_stream(text)
        path = scans.best_path(stream, m)
        assert (scans.decode(stream, m), scans.misread_lines(stream, path), scans.cut_lines(stream, path, m)) == (right, misread, cut)
    good, bad = "今天军事训练在国防部门进行", "今天军亊绦练在国防部门进行"
    m = scan_model({}, [(good, 400), (bad, 1)], cjk={"亊": "事", "绦": "训"})
    assert scans.decode(scan_stream(bad), m) == good and scans.decode(scan_stream(good), m) == good


def test_decisions_on_counts_are_the_same_at_ten_times_the_corpus():
    common = {"the": 200_000, "of": 66_000, "11": 400, "1969": 90, "3": 10, "logistics": 300, "logi": 1, "stlcs": 1, "cut": 2}
    forms = {"l1": 3, "l969": 2, "B52": 40, "Z46": 3, "52nd": 5, "qu4rtzzz": 2}
    threes = [("军事训", 3), ("军亊训", 1), ("天军事", 200), ("的一是", 900_000)]
    models = [scan_model({w: k * n for w, n in {**common, **forms}.items()}, [(t, k * n) for t, n in threes], latin={"l": "i"}, cjk={"亊": "事"}) for k in (1, 10)]
    for text in (*forms, "the logi stlcs", "cut-", "天军亊训练"):
        paths = [scans.best_path(scan_stream(text), m) for m in models]
        assert paths[0] == paths[1]
        assert scans.cut_lines(scan_stream(text), paths[0], models[0]) == scans.cut_lines(scan_stream(text), paths[1], models[1])
    assert [m.edges("l1")[-1][1] for m in models] == ["11", "11"] and [len(m.edges("B52")) for m in models] == [1, 1]


def test_every_reading_of_a_character_is_learned(spark):
    """A character that six others are misread as keeps six readings."""
    r = random.Random(5)
    rows = []
    for k, sign in enumerate("甲乙丙丁戊己"):
        for j in range(4):
            a, b = r.sample(SIGNS, 2)
            rows += [(f"{k}-{j}", "s", "\n".join([f"{a}{sign}{b}。"] * 40 + [f"{a}亊{b}。"]), 1, 1)]
    model = scans.learn(scans.prepare(frame(spark, rows, "id string, source string, text string, page_start int, page_end int")))
    assert set(model.cjk["亊"]) == set("甲乙丙丁戊己")


def test_the_middle_of_a_long_answer_reaches_the_classifier():
    long = ["军事训练" * 20 + middle + "后勤保障" * 20 for middle in ("我无法回答这个问题", "天地玄黄宇宙洪荒日")]
    slots, at = pairs.gram_slots(pa.array(long), np.array([False, False]))
    assert slots[at[0] : at[1]].tolist() != slots[at[1] :].tolist()


def test_slots_depend_on_the_answer_alone():
    texts = ["The old harbour was quiet, the NEW one not.", "", "甲", "第12条规定如下。", None, "x y z’s étage ёлка"]
    slots, at = pairs.gram_slots(pa.array(texts, pa.string()), np.zeros(6, bool))
    for k, t in enumerate(texts):
        alone, _ = pairs.gram_slots(pa.array([t], pa.string()), np.zeros(1, bool))
        assert alone.tolist() == slots[at[k] : at[k + 1]].tolist()
    copied, ends = pairs.gram_slots(pa.array(texts, pa.string()), np.ones(6, bool))
    assert ends[1] <= 6 and set(copied[: ends[1]]) <= set(slots[: at[1]]) and pairs.gram_slots(pa.array([], pa.string()), np.zeros(0, bool))[0].size == 0


# --- shared


def test_window_primitives():
    x = np.array([5, 3, 8, 1, 9, 2], np.uint64)
    for w in range(1, 7):
        assert vec.window_min(x, w).tolist() == [min(x[i : i + w]) for i in range(7 - w)]
    c = np.frombuffer("abcabcabd".encode("utf-32-le"), "<u4")
    for w in range(1, 9):
        h = vec.window_hashes(c, w)
        s = ["abcabcabd"[i : i + w] for i in range(10 - w)]
        assert len(set(h.tolist())) == len(set(s)) and len(h) == len(s)
    assert vec.ragged(np.array([3, 0]), np.array([2, 3])).tolist() == [3, 4, 0, 1, 2]


def test_very_long_text(spark):
    text = words(400_000, 9)
    df = frame(spark, [(1, text), (2, text[:1000])], "doc_id long, text string")
    assert spans.sharing_pairs(df).count() == 1
    assert len(bpe.encode_corpus(df).where("doc_id = 1").first()["ids"]) > 400_000
    v = df.select(F.col("doc_id").cast("string").alias("id"), "text")
    assert neardup.similar_pairs(v).count() == 0 and quality.measured(v, []).count() == 2


def test_margins_are_validated():
    rows = [words(60, k) + "，部队装备。" for k in range(40)] + ["Le général a réuni l'état-major à l'aube près du canal."] * 5
    flat = vec.codepoints(pa.array(rows))
    counts = np.zeros((1 << encoding.BIGRAM_BITS) + (1 << encoding.UNIGRAM_BITS), np.float32)
    framed = np.concatenate([[10], *[np.append(flat[0][a:b], 10) for a, b in zip(flat[1], flat[1][1:])]]).astype(np.uint32)
    counts[: 1 << encoding.BIGRAM_BITS] += np.bincount(encoding._slots(framed), minlength=1 << encoding.BIGRAM_BITS)
    counts[1 << encoding.BIGRAM_BITS :] += np.bincount(encoding._single(framed), minlength=1 << encoding.UNIGRAM_BITS)
    model = encoding.CharModel(counts[: 1 << encoding.BIGRAM_BITS], counts[1 << encoding.BIGRAM_BITS :])
    margins = encoding.validated_margins(model, rows)
    assert margins.total > 0 and margins.mean > 0
    assert not encoding.best_reading(rows[-1], model, margins, odd=True)[1]
    assert encoding.best_reading(rows[1][:10] + "��" + rows[1][10:], model, margins) == (rows[1][:10] + "��" + rows[1][10:], True)
    assert encoding.best_reading(rows[0].encode().decode("latin-1"), model, margins)[0] == rows[0]
    assert encoding.validated_margins(model, []).accept(1, 1)


def test_share_equals_sql(spark, data):
    duckdb = pytest.importorskip("duckdb")
    from corpusloom.llm import queries

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    got = sorted(tuple(r[k] for k in ("doc_id", "n_chars", "shared_chars")) for r in queries.p10_share(spark, data).collect())
    assert got == sorted(db.execute(queries.P10_SHARE).fetchall()) and any(k for _, _, k in got)
