"""Cleaning, measuring and hashing of text columns. Null in, null out, unless a function says otherwise."""

from __future__ import annotations

from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lexicons

#: White space as Unicode has it, for Java's and RE2's classes; and without the line feed.
WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
_WS = f"[{WS}]"
_INLINE = r"[ \t\r\f\x0b\x1c-\x1f\x{85}\p{Z}]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
BLANKS = r"[ \t\x{3000}]+"
URL = r"(?i)https?://|www\."


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, rf"\A{_WS}+|{_WS}+\z", "")


def _strip_lines(c: Column) -> Column:
    return F.regexp_replace(c, rf"{_INLINE}*\n{_INLINE}*", "\n")


def _newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n?", "\n")


def clean_text(c: Column) -> Column:
    """Line feeds alone, no byte order mark, single blanks, trimmed lines, one blank line at most between paragraphs."""
    c = F.regexp_replace(F.replace(_newlines(c), F.lit("﻿"), F.lit("")), BLANKS, " ")
    return strip(F.regexp_replace(_strip_lines(c), r"\n{3,}", "\n\n"))


def clean_plain(c: Column) -> Column:
    """For plain text files: tags, addresses and control characters go, too."""
    c = F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", ""), rf"https?://[^{WS}]+", "")
    c = F.regexp_replace(_newlines(F.regexp_replace(c, CONTROL, "")), r"\n{3,}", "\n\n")
    return strip(_strip_lines(F.regexp_replace(c, BLANKS, " ")))


def clean_markdown_line(c: Column) -> Column:
    """One line of Markdown: images go, links leave their text, tags and control characters go."""
    c = F.regexp_replace(F.regexp_replace(c, r"!\[[^\]]*\]\([^)]+\)", ""), r"\[([^\]]+)\]\([^)]+\)", "$1")
    return strip(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", ""), CONTROL, ""), BLANKS, " "))


def clean_wiki(c: Column, drop_control: bool = False) -> Column:
    """Single blanks, trimmed lines, no blank lines."""
    c = F.regexp_replace(c, CONTROL, "") if drop_control else c
    return strip(F.regexp_replace(_strip_lines(F.regexp_replace(_newlines(c), BLANKS, " ")), r"\n{2,}", "\n"))


def clean_pdf_line(c: Column) -> Column:
    """One line of a PDF: control characters go, single blanks, the ligatures of fi and fl spelt out."""
    c = strip(F.regexp_replace(F.regexp_replace(c, CONTROL, ""), BLANKS, " "))
    return F.replace(F.replace(c, F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl"))


def garbled_score(c: Column) -> Column:
    """Signs typical of UTF-8 read as GBK, less an eighth of the common characters."""
    return F.regexp_count(c, F.lit(f"[{lexicons.GARBLED_SIGNS}]")) - F.floor(F.regexp_count(c, F.lit(f"[{lexicons.COMMON_SIGNS}]")) / 8).cast("int")


def _score(text: str) -> int:
    """garbled_score() of a Python string."""
    count = lambda signs: sum(map(text.count, dict.fromkeys(signs)))
    return count(lexicons.GARBLED_SIGNS) - count(lexicons.COMMON_SIGNS) // 8


@cache
def _regarbled():
    """Re-encodes as GBK, in its wider and its narrower form, and reads as UTF-8: the better of the two that keep most.

    Marked as nondeterministic, so that it is evaluated once, on its own.
    """

    def run(texts: pd.Series) -> pd.Series:
        def read(t: str, codec: str) -> str:
            try:
                return t.encode(codec).decode("utf-8")
            except UnicodeError:
                return t.encode(codec, "ignore").decode("utf-8", "ignore")

        def back(t: str | None) -> str | None:
            found = [x for codec in ("gb18030", "gbk") if len(x := read(t, codec)) > 0.65 * len(t)] if t else []
            return min(found, key=_score, default=None)

        return texts.map(back)

    return F.pandas_udf(run, "string").asNondeterministic()


def repair_garbled(c: Column) -> Column:
    """Text of UTF-8 read as GBK, restored where that makes it clearly better. Python sees suspicious texts only."""
    suspicious = garbled_score(c) >= 4
    other = _regarbled()(F.when(suspicious, c))
    better = suspicious & other.isNotNull() & (garbled_score(other) + 3 < garbled_score(c))
    return F.when(better, other).otherwise(c)


def strip_references(c: Column, least: int = 100) -> Column:
    """Cuts at the first heading of references that leaves ``least`` characters; else the text stays whole."""
    lines = F.split(c, "\n")
    heads = F.array_compact(F.transform(lines, lambda x, i: F.when(strip(x).rlike(lexicons.REFERENCE_CUT), i)))
    before = F.transform(heads, lambda i: strip(F.array_join(F.slice(lines, F.lit(1), i), "\n")))
    kept = F.get(F.filter(before, lambda t: F.length(t) >= least), F.lit(0))
    return F.coalesce(F.when(c.rlike(f"(?m){lexicons.REFERENCE_HINT}"), kept), c)


def strip_wiki_tail(c: Column) -> Column:
    """Cuts at the first section of references, notes, links or related articles."""
    at = F.regexp_instr(c, F.lit(lexicons.WIKI_TAIL))
    return F.when(at > 0, strip(F.substring(c, F.lit(1), at - 1))).otherwise(c)


def is_pdf_noise(line: Column) -> Column:
    """Whether a cleaned line of a PDF is empty or page furniture."""
    hit = line == ""
    for pattern in lexicons.PDF_NOISE:
        hit = hit | line.rlike(pattern)
    return hit


def text_length(c: Column) -> Column:
    """Characters without white space."""
    return F.length(F.regexp_replace(c, f"{_WS}+", ""))


def compact(c: Column) -> Column:
    """Single blanks for white space of any kind, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{_WS}+", " "))


def truncate_middle(c: Column, limit: int, mark: str = "\n...\n") -> Column:
    """Beyond the limit, the first and the last half of it, trimmed, with a mark between."""
    half = limit // 2
    return F.when(F.length(c) > limit, F.concat(strip(F.substring(c, 1, half)), F.lit(mark), strip(F.right(c, F.lit(half))))).otherwise(c)


def safe_filename(c: Column, limit: int = 90) -> Column:
    """A title as a file name; 'untitled' where nothing is left of it, or it is null."""
    c = F.regexp_replace(F.regexp_replace(c, r'[\\/:*?"<>|\x00-\x1f]', "_"), f"{_WS}+", "_")
    c = F.substring(F.regexp_replace(c, r"\A[._ ]+|[._ ]+\z", ""), 1, limit)
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("untitled"))


def hash_strict(c: Column) -> Column:
    """SHA-1 of the text without white space."""
    return F.sha1(F.encode(F.regexp_replace(c, f"{_WS}+", ""), "UTF-8"))


def hash_compact(c: Column) -> Column:
    """SHA-1 of the text in lower case with single blanks."""
    return F.sha1(F.encode(F.lower(compact(c)), "UTF-8"))


def paragraphs(c: Column, least: int = 20) -> Column:
    """The paragraphs with ``least`` characters: between blank lines, or lines if there is no blank line."""
    parts = F.split(c, rf"\n{_WS}*\n")
    parts = F.when(F.size(parts) == 1, F.split(c, r"\n+")).otherwise(parts)
    return F.filter(F.transform(parts, strip), lambda p: F.length(p) >= least)


def sentences(c: Column, ends: str = lexicons.SENTENCE_ENDS) -> Column:
    """The sentences, each with its sign, trimmed, none empty."""
    return F.filter(F.transform(F.split(c, f"(?<=[{ends}])"), strip), lambda s: s != "")


def count_of(c: Column, term: str) -> Column:
    """How often the term occurs without overlap."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(term), F.lit("")))) / len(term)).cast("int")


def longest_run(c: Column) -> Column:
    """The length of the longest run of one character; 0 for an empty text."""
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(c, F.lit(r"(?s)((.)\2*)"), F.lit(1)), F.length)), F.lit(0))


def unique_ratio(c: Column) -> Column:
    """Distinct characters of the compact text by its length; 0 for an empty one."""
    t = compact(c)
    return F.when(t == "", F.lit(0.0)).otherwise(F.size(F.array_distinct(F.split(t, ""))) / F.length(t))


def duplicate_line_ratio(c: Column, least_chars: int = 8, least_lines: int = 4) -> Column:
    """Share of the longer lines that occur more than once; 0 with fewer than ``least_lines`` of them."""
    lines = F.array_sort(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: F.length(x) >= least_chars))
    state = lambda line, run, n, again: F.struct(line.alias("line"), run.alias("run"), n.alias("n"), again.alias("again"))

    def step(acc: Column, x: Column) -> Column:
        same = F.coalesce(acc["line"] == x, F.lit(False))
        more = F.when(same, F.when(acc["run"] == 1, 2).otherwise(1)).otherwise(0)
        return state(x, F.when(same, acc["run"] + 1).otherwise(1), acc["n"] + 1, acc["again"] + more)

    start = state(F.lit(None).cast("string"), F.lit(0), F.lit(0), F.lit(0))
    return F.aggregate(lines, start, step, lambda acc: F.when(acc["n"] >= least_lines, acc["again"] / acc["n"]).otherwise(F.lit(0.0)))


def keyword_hits(c: Column, terms: tuple[str, ...]) -> Column:
    """The terms that occur, whatever their case, sorted. Dozens of searches in one text: Arrow batches are faster here."""
    pairs = [(t.lower(), t) for t in sorted(set(terms))]

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else [name for low, name in pairs if low in t] for t in texts.str.lower()])

    return F.pandas_udf(run, "array<string>").asNondeterministic()(c)


def weighted_score(c: Column, weights: dict[str, int], most: int = 5) -> Column:
    """The sum over the terms of their weight times their count without overlap, of which ``most`` matter."""
    pairs = list(weights.items())

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else sum(min(t.count(term), most) * w for term, w in pairs) for t in texts], dtype="Int32")

    return F.pandas_udf(run, "int").asNondeterministic()(c)
