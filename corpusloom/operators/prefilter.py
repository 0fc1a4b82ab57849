"""Rule-based scoring of chunks: eighteen measures, issues with penalties, and a duplicate rule on what is kept.

A null text counts as ''. Rows need an order column for the duplicate rule; equal order values are broken by id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicons
from ..functions import text as T


@dataclass(frozen=True)
class PrefilterConfig:
    min_score: float = 5.0
    min_chars: int = 120
    soft_min_chars: int = 260
    max_chars: int = 5000
    min_chinese_ratio: float = 0.25
    min_latin_ratio: float = 0.55
    max_digit_ratio: float = 0.35
    min_unique_ratio: float = 0.035
    max_repeated_run: int = 12
    max_duplicate_lines: float = 0.35
    max_urls: int = 4
    min_reference_lines: int = 4
    max_reference_ratio: float = 0.45
    max_private_use: int = 5
    max_garbled_hits: int = 12
    max_garbled_density: float = 0.012
    irrelevance_penalty: float = 3.0
    keywords: tuple[str, ...] = lexicons.KEYWORDS
    risks: tuple[str, ...] = lexicons.CHUNK_RISKS
    dedupe: bool = True


def measures(text: Column, source: Column, config: PrefilterConfig = PrefilterConfig()) -> dict[str, Column]:
    """The measures of a text by name, unrounded."""
    text = F.coalesce(text, F.lit(""))
    base = F.greatest(F.length(F.regexp_replace(text, r"[ \n\t]", "")), F.lit(1))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    lines = F.filter(F.transform(F.split(text, "\n"), T.strip), lambda x: x != "")
    cites = F.size(F.filter(lines, lambda x: x.rlike("|".join(f"(?:{p})" for p in lexicons.REFERENCE_LINES))))
    garbled = F.lit(0)
    for token in lexicons.GARBLED_TOKENS:
        garbled = garbled + T.count_of(text, token)
    return {
        "char_count": F.length(text),
        "chinese_ratio": count(r"[\x{4e00}-\x{9fff}]") / base,
        "latin_ratio": count("[A-Za-z]") / base,
        "digit_ratio": count(r"\p{Nd}") / base,
        "unique_ratio": T.unique_ratio(text),
        "control_count": count(T.CONTROL),
        "private_use_char_count": count(r"[\x{e000}-\x{f8ff}]"),
        "mojibake_count": garbled,
        "mojibake_density": garbled / F.greatest(F.length(text), F.lit(1)),
        "mojibake_tokens": F.slice(F.array_sort(F.array_compact(F.array(*[F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in lexicons.GARBLED_TOKENS]))), 1, 12),
        "repeated_char_run": T.longest_run(text),
        "duplicate_line_ratio": T.duplicate_line_ratio(text),
        "reference_heading": text.rlike(lexicons.REFERENCE_HEADING),
        "reference_line_count": cites,
        "line_count": F.size(lines),
        "reference_line_ratio": F.when(F.size(lines) > 0, cites / F.size(lines)).otherwise(F.lit(0.0)),
        "url_count": count(T.URL),
        "military_keyword_hits": T.keyword_hits(F.concat_ws("\n", text, F.coalesce(source, F.lit(""))), config.keywords),
    }


def _issues(m: dict[str, Column], text: Column, config: PrefilterConfig) -> list[tuple[Column, str, Column, bool | Column]]:
    """(condition, issue, penalty, fatal) in the order they are reported."""
    text = F.coalesce(text, F.lit(""))
    flat = T.strip(text)
    n, pua, hits, density = m["char_count"], m["private_use_char_count"], m["mojibake_count"], m["mojibake_density"]
    dense = (density >= config.max_garbled_density) | (hits >= config.max_garbled_hits)
    refs, share = m["reference_line_count"], m["reference_line_ratio"]
    section = m["reference_heading"] & (refs >= config.min_reference_lines)
    listed = (refs >= config.min_reference_lines) & (share >= config.max_reference_ratio)
    heavy = (refs >= 2) & (share >= 0.6)
    boilerplate = F.lit(0)
    for p in lexicons.BOILERPLATE_WHOLE:
        boilerplate = boilerplate + flat.rlike(p).cast("int")
    for p in lexicons.BOILERPLATE_PART:
        boilerplate = boilerplate + text.rlike(p).cast("int")
    risk = F.lit(False)
    for p in config.risks:
        risk = risk | text.rlike(p)
    lit = lambda x: F.lit(float(x))
    return [
        (n < config.min_chars, "too_short", lit(5), True),
        ((n >= config.min_chars) & (n < config.soft_min_chars), "short_text", lit(2), False),
        (n > config.max_chars, "too_long", lit(1), False),
        (T.compact(text) == "", "empty_text", lit(10), True),
        (m["control_count"] > 0, "control_chars", F.least(lit(3), 0.5 * m["control_count"]), False),
        (pua > 0, "private_use_chars", F.least(lit(6), 0.2 * pua), pua >= config.max_private_use),
        (dense & (hits > 0), "suspected_mojibake", lit(6), True),
        (~dense & (hits > 0), "possible_mojibake", F.least(lit(2), 0.05 * hits), False),
        ((m["chinese_ratio"] < config.min_chinese_ratio) & (m["latin_ratio"] < config.min_latin_ratio), "low_chinese_ratio", lit(2), False),
        (m["digit_ratio"] > config.max_digit_ratio, "digit_heavy", lit(1.5), False),
        (m["unique_ratio"] < config.min_unique_ratio, "low_unique_char_ratio", lit(2), False),
        (m["repeated_char_run"] >= config.max_repeated_run, "repeated_char_noise", lit(2), False),
        (m["duplicate_line_ratio"] >= config.max_duplicate_lines, "duplicate_line_noise", lit(2), False),
        (boilerplate > 0, "low_value_boilerplate", F.least(lit(3), boilerplate.cast("double")), False),
        (section, "reference_section", lit(6), True),
        (~section & listed, "reference_like_list", lit(5), True),
        (~section & ~listed & heavy, "reference_heavy", lit(2), False),
        (m["url_count"] >= config.max_urls, "url_heavy", lit(1), False),
        (F.size(m["military_keyword_hits"]) == 0, "weak_military_relevance", lit(config.irrelevance_penalty), False),
        (risk, "actionable_harm_risk", lit(6), True),
    ]


def level(score: Column) -> Column:
    return F.when(score >= 8, "good").when(score >= 5, "usable").when(score >= 3, "poor").otherwise("reject")


def prefilter(df: DataFrame, config: PrefilterConfig = PrefilterConfig(), id_col: str = "id", text: str = "text", source: str = "source", order: str | None = None) -> DataFrame:
    """df with rule_prefilter: keep, score, quality_level, issues and the measures.

    A row is a duplicate if an earlier row (by ``order``, by default the id) with the same compact text would be kept.
    One shuffle, of hashes with the rows; a hot text is one window group, streamed with two values of state.
    """
    m = measures(F.col(text), F.col(source), config)
    wide = df.withColumns({f"__m_{k}": c for k, c in m.items()})  # columns of their own: used often, computed once
    named = {k: F.col(f"__m_{k}") for k in m}
    rules = _issues(named, F.col(text), config)
    issues = F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name, _, _ in rules]))
    penalty, fatal = F.lit(0.0), F.lit(False)
    for c, _, p, f in rules:
        penalty = penalty + F.when(c, p).otherwise(0.0)
        fatal = fatal | (c & (f if isinstance(f, Column) else F.lit(f)))
    wide = wide.withColumn("__issues", issues).withColumn("__score", F.greatest(F.lit(0.0), 10.0 - penalty)).withColumn("__fatal", fatal)
    keep = (F.col("__score") >= config.min_score) & ~F.col("__fatal")
    duplicate = F.lit(False)
    if config.dedupe:
        place = F.struct(F.col(order or id_col), F.col(id_col))
        wide = wide.withColumn("__keep", keep).withColumn("__hash", T.hash_compact(F.coalesce(F.col(text), F.lit(""))))
        first = F.min(F.when(F.col("__keep"), place)).over(Window.partitionBy("__hash"))
        duplicate = F.coalesce(first < place, F.lit(False))
    wide = wide.withColumn("__dup", duplicate)
    score = F.when(F.col("__dup"), F.greatest(F.lit(0.0), F.col("__score") - 5)).otherwise(F.col("__score"))
    kept = (score >= config.min_score) & ~F.col("__fatal") & ~F.col("__dup")
    found = F.when(F.col("__dup"), F.array_append("__issues", F.lit("duplicate_text"))).otherwise(F.col("__issues"))
    out = F.struct(kept.alias("keep"), score.alias("score"), level(score).alias("quality_level"), found.alias("issues"), F.array_join(found, ", ").alias("reason"), F.struct(*[F.col(f"__m_{k}").alias(k) for k in m]).alias("metrics"))
    return wide.withColumn("rule_prefilter", out).drop(*[c for c in wide.columns if c.startswith("__")])


def prefilter_stats(scored: DataFrame, source: str = "source") -> dict[str, DataFrame]:
    """total, issues, sources (first part of the path) and buckets (whole scores) of prefiltered rows."""
    r = F.col("rule_prefilter")
    total = scored.agg(F.count("*").alias("total"), F.count_if(r["keep"]).alias("kept"), F.count_if(~r["keep"]).alias("rejected"))
    issues = scored.select(F.explode(r["issues"]).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))
    prefix = F.coalesce(F.nullif(F.get(F.split(source, r"[/\\]"), F.lit(0)), F.lit("")), F.lit("unknown"))
    sources = scored.groupBy(prefix.alias("source_prefix")).agg(F.count("*").alias("n"))
    buckets = scored.groupBy(F.floor(r["score"]).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    return {"total": total, "issues": issues, "sources": sources, "buckets": buckets}
