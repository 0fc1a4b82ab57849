"""Deduplication, union with provenance, resumption, splits and top lists. All state is relational; nothing is collected."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def first_wins(df: DataFrame, key: Column, *order: str) -> DataFrame:
    """One row for each key, the first in order. Ties are settled by all columns in order; only key and order are ranked."""
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("__rank = 1").drop("__rank")


def duplicates_skipped(df: DataFrame, key: Column) -> DataFrame:
    """total, distinct and skipped rows by key; null keys are one key."""
    groups = df.groupBy(key.alias("k")).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct_texts"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("skipped"))


def rewrite_ids(df: DataFrame, prefix: str = "dataset_source", *order: str, id_col: str = "id") -> DataFrame:
    """Repeated ids, all but the first in order, become prefix/id; rewritten says which. No row is lost."""
    again = F.row_number().over(Window.partitionBy(id_col).orderBy(*order)) > 1
    df = df.withColumn("rewritten", again)
    return df.withColumn(id_col, F.when(F.col("rewritten"), F.concat_ws("/", F.col(prefix), F.col(id_col))).otherwise(F.col(id_col)))


def union_tagged(parts: dict[str, DataFrame], version: str) -> DataFrame:
    """All rows of all parts by column name, with dataset_version, dataset_source and source_rank (the part's place)."""
    out = None
    for rank, (name, df) in enumerate(parts.items()):
        tagged = df.withColumns({"dataset_version": F.lit(version), "dataset_source": F.lit(name), "source_rank": F.lit(rank)})
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def not_done(df: DataFrame, done: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows whose id isn't among the ids done; rows without an id are never done."""
    return df.join(done.select(done[id_col].alias("__done")).distinct(), F.col(id_col) == F.col("__done"), "left_anti")


def groups_not_done(df: DataFrame, done: DataFrame, expected: str = "expected", id_col: str = "id") -> DataFrame:
    """The rows of which any expected child id (id#q0001 ...) is missing among the ids done."""
    child = F.explode(F.sequence(F.lit(1), F.col(expected)))
    wanted = df.where(F.col(expected) > 0).select(F.col(id_col).alias("__id"), child.alias("k")).select("__id", F.format_string("%s#q%04d", "__id", "k").alias("__child"))
    missing = wanted.join(done.select(done[id_col].alias("__done")).distinct(), F.col("__child") == F.col("__done"), "left_anti").select("__id").distinct()
    return df.join(missing, F.col(id_col) == F.col("__id"), "left_semi")


#: Rows of a range that one task orders, about.
RANGE_ROWS = 1_000_000


def _ranges(rows: int) -> int:
    return max(1, -(-rows // RANGE_ROWS))


def _offsets(counts: DataFrame) -> DataFrame:
    """__part, __before: the sum of __n over the ranges before; one row a range."""
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    return F.broadcast(counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before")))


def numbered(df: DataFrame, *order: str, ranges: int = 64) -> DataFrame:
    """df with n, its place from 1 in order: rows are range-partitioned, counted by partition, and numbered within it.

    No task sees all rows; the order must tell rows apart for the numbers to be determinate. Both uses of the ranges share
    one shuffle.
    """
    placed = df.repartitionByRange(ranges, *order).withColumn("__part", F.spark_partition_id())
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    counts = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    return placed.join(_offsets(counts), "__part").withColumn("n", F.col("__before") + within).drop("__part", "__before")


def split_even(df: DataFrame, parts: int, *order: str) -> DataFrame:
    """df with part: contiguous runs of ceil(rows / parts) rows in order, numbered from 1."""
    rows = df.count()
    return numbered(df, *order, ranges=_ranges(rows)).withColumn("part", (F.floor((F.col("n") - 1) / max(1, -(-rows // parts))) + 1).cast("int")).drop("n")


def line_bytes(*columns: str) -> Column:
    """The bytes of a row as a line of JSON, line feed included; nulls are written out."""
    return F.octet_length(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})) + 1


def shard_by_bytes(df: DataFrame, limit: int, *order: str, size: Column | None = None) -> DataFrame:
    """df with bytes and shard (from 0): contiguous in order, each of at most ``limit`` bytes, or of one row that has more.

    A row that would pass the limit opens the next shard. Rows are cut into ranges of about 64 limits, and a new range
    opens a new shard, so ranges are filled independently of each other; up to that size the result is that of one scan.
    size: the bytes of a row, by default of its line of JSON.
    """
    sized = df.withColumn("bytes", (size if size is not None else line_bytes(*df.columns)).cast("long"))
    total = sized.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema.fields)
    at = sized.columns.index("bytes")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, used = 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = np.cumsum(batch.column(at).to_numpy())
            out, done = np.zeros(len(ends), np.int64), 0
            while done < len(ends):
                base = ends[done - 1] if done else 0
                stop = int(np.searchsorted(ends, base + limit - used, "right"))
                if stop <= done and used:  # the row doesn't fit
                    shard, used = shard + 1, 0
                    continue
                stop = max(stop, done + 1)  # a row beyond the limit is alone
                out[done:stop] = shard
                used += int(ends[stop - 1] - base)
                done = stop
            yield batch.append_column("__local", pa.array(out))

    ranges = max(1, total // (limit * 64))
    local = sized.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(run, f"{kinds}, __local bigint").withColumn("__part", F.spark_partition_id())
    counts = local.groupBy("__part").agg((F.max("__local") + 1).alias("__n"))
    return local.join(_offsets(counts), "__part").withColumn("shard", (F.col("__before") + F.col("__local")).cast("int")).drop("__part", "__before", "__local")


def head_of(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in order (a top-k, without a full sort)."""
    return df.orderBy(*order).limit(n)


def source_stats(df: DataFrame, by: str = "dataset_source", id_col: str = "id", text: str = "text") -> DataFrame:
    """chunks, chars and the three first ids (in their order) of each source; at most three ids are ever held for one."""
    ranked = df.select(by, id_col, F.length(text).alias("chars")).withColumn("__k", F.row_number().over(Window.partitionBy(by).orderBy(id_col)))
    first = ranked.where("__k <= 3").groupBy(by).agg(F.array_sort(F.collect_list(id_col)).alias("first_ids"))
    sums = df.groupBy(by).agg(F.count("*").alias("chunks"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars"))
    return sums.alias("s").join(first.alias("f"), F.expr(f"s.{by} <=> f.{by}")).select(f"s.{by}", "chunks", "chars", "first_ids")


def length_stats(df: DataFrame, text: str = "text", title: str = "title") -> DataFrame:
    """Rows, shortest, longest, total and average length (two decimals) without white space, distinct titles."""
    n = T.text_length(F.col(text))
    return df.agg(F.count("*").alias("n"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.sum(n).alias("total"), F.round(F.avg(n), 2).alias("average"), F.countDistinct(title).alias("titles"))


def chunk_stats(df: DataFrame, by: str = "source", text: str = "text") -> DataFrame:
    """by, chunks and chars (without white space) of each file or source; null texts have none."""
    return df.groupBy(by).agg(F.count("*").alias("chunks"), F.coalesce(F.sum(T.text_length(F.col(text))), F.lit(0)).alias("chars"))


def score_buckets(df: DataFrame, score: Column) -> DataFrame:
    """bucket, n: rows by score in steps of 5 from 0 to 95; scores beyond are taken as 0 and 99."""
    return df.groupBy((F.floor(F.least(F.greatest(score, F.lit(0)), F.lit(99)) / 5) * 5).cast("int").alias("bucket")).agg(F.count("*").alias("n"))


def event_chunks(df: DataFrame, split: str = "split") -> DataFrame:
    """id, text, char_count, split, event_types, event_count of (id, split, text, event_list: array of (event_type)).

    Rows without text go; types are distinct and sorted, null and empty ones left out; a null list has no events.
    """
    named = F.filter(F.transform("event_list", lambda e: e["event_type"]), lambda t: F.coalesce(t != "", F.lit(False)))
    rows = df.withColumn("text", T.clean_wiki(F.coalesce("text", F.lit("")))).where("text <> ''")
    return rows.select(
        F.concat_ws("/", F.lit("events"), split, F.col("id").cast("string")).alias("id"), "text", T.text_length(F.col("text")).alias("char_count"), F.col(split).alias("split"),
        F.coalesce(F.array_sort(F.array_distinct(named)), F.array().cast("array<string>")).alias("event_types"), F.greatest(F.coalesce(F.size("event_list"), F.lit(0)), F.lit(0)).alias("event_count"),
    )


def event_stats(chunks: DataFrame) -> DataFrame:
    """split, n, least, greatest and average (two decimals) of characters and events; the null split is the total."""
    of = lambda c: (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.round(F.avg(c), 2).alias(f"{c}_avg"))
    return chunks.rollup("split").agg(F.count("*").alias("n"), *of("char_count"), *of("event_count"))


def event_type_counts(chunks: DataFrame) -> DataFrame:
    return chunks.select(F.explode("event_types").alias("event_type")).groupBy("event_type").agg(F.count("*").alias("n"))


def category_counts(df: DataFrame) -> DataFrame:
    """Rows by category, else site, else 'unknown'; empty strings count as missing."""
    name = F.coalesce(F.nullif(F.col("category"), F.lit("")), F.nullif(F.col("site"), F.lit("")), F.lit("unknown"))
    return df.groupBy(name.alias("category")).agg(F.count("*").alias("n"))


def relevance(df: DataFrame, title_weights: dict[str, int], body_weights: dict[str, int], excluded: str, risks: tuple[str, ...], body_chars: int = 6000, min_score: int = 12, min_title: int = 7, title: str = "title", text: str = "text") -> DataFrame:
    """df with relevance: title and body scores, whether the title is excluded, whether risky, and keep."""
    head = F.substring(T.compact(F.coalesce(F.col(text), F.lit(""))), 1, body_chars)
    name = F.coalesce(F.col(title), F.lit(""))
    risky = F.lit(False)
    for p in risks:
        risky = risky | head.rlike(p)
    df = df.withColumn("__t", T.weighted_score(name, title_weights)).withColumn("__b", T.weighted_score(head, body_weights)).withColumn("__x", name.rlike(excluded)).withColumn("__r", risky)
    score = F.col("__t") + F.col("__b") - F.when(F.col("__x"), 20).otherwise(0) - F.when(F.col("__r"), 20).otherwise(0)
    keep = (score >= min_score) & (F.col("__t") >= min_title) & ~F.col("__x") & ~F.col("__r")
    out = F.struct(keep.alias("keep"), score.alias("score"), F.col("__t").alias("title_score"), F.col("__b").alias("body_score"), F.col("__x").alias("excluded_title"), F.col("__r").alias("risky"))
    return df.withColumn("relevance", out).drop("__t", "__b", "__x", "__r")


def top_terms(df: DataFrame, terms: tuple[str, ...], k: int = 50, text: str = "text") -> DataFrame:
    """The k terms that occur in most texts, with their number; equal numbers in the terms' order."""
    hits = df.select(F.explode(T.keyword_hits(F.coalesce(F.col(text), F.lit("")), terms)).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return hits.orderBy(F.desc("n"), "term").limit(k)
