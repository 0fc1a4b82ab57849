"""Reading and writing: JSON lines under three policies, text of unknown charset, dumps, shards, statistics."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = "id string, title string, ns string, revision struct<id:string, text:struct<_VALUE:string>>"


def read_strict(spark: SparkSession, path: str, schema: str, required: str | None = "text") -> DataFrame:
    """JSON lines; a line that is no JSON, or lacks the required field, fails the job. Blank lines are skipped."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if required:
        df = df.withColumn(required, F.when(F.col(required).isNull(), F.raise_error(F.lit(f"a row has no {required}"))).otherwise(F.col(required)))
    return df


def read_lenient(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """JSON lines; bad lines and missing files give no rows."""
    df = spark.createDataFrame([], schema)
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop):
            df = df.unionByName(spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path), allowMissingColumns=True)
    return df


def read_quarantined(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; a bad line becomes a row with its text in ``error`` and an id made of file and content."""
    df = spark.read.schema(f"{schema}, __bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad").json(path)
    name = F.concat(F.lit("__invalid_json_line_"), F.substring(F.sha1(F.concat_ws("|", F.col("_metadata.file_name"), F.encode("__bad", "UTF-8").cast("string"))), 1, 12))
    df = df.withColumn("id", F.when(F.col("__bad").isNotNull(), name).otherwise(F.col("id"))).withColumn("text", F.when(F.col("__bad").isNotNull(), "").otherwise(F.col("text")))
    return df.withColumnRenamed("__bad", "error")


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one JSON array each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def decode(content: bytes, charsets: tuple[str, ...], errors: str = "replace") -> str:
    """By the first charset that fits; else as UTF-8 with what is bad replaced, or left out (errors="ignore")."""
    for name in charsets:
        try:
            return content.decode(name)
        except UnicodeDecodeError:
            continue
    return content.decode("utf-8", errors)


def read_texts(spark: SparkSession, root: str, suffixes: tuple[str, ...] = (".txt",), charsets: tuple[str, ...] = ("utf-8-sig", "utf-8", "gb18030", "big5"), errors: str = "replace", in_order: bool = False) -> DataFrame:
    """path (below root), text of all files with one of the suffixes in root and below, on request in the order of path.

    errors: see decode().
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([decode(b, charsets, errors) for b in batch.column(1).to_pylist()], pa.string())], ["path", "text"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    ends = F.lit(False)
    for s in suffixes:
        ends = ends | F.lower("path").endswith(s)
    base = root.rstrip("/").removeprefix("file://")
    below = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), rf"^\Q{base}\E/", "")
    texts = files.where(ends).select(below.alias("path"), "content").mapInArrow(run, "path string, text string")
    return texts.orderBy("path") if in_order else texts


def read_wiki_dump(spark: SparkSession, path: str) -> DataFrame:
    """id, revid, title, ns, raw_text of the pages of an XML dump (.xml, .xml.bz2)."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(PAGE).load(path)
    return pages.select("id", F.col("revision.id").alias("revid"), "title", "ns", F.col("revision.text._VALUE").alias("raw_text"))


def admitted_pages(pages: DataFrame, text: str = "text", least: int = 80) -> DataFrame:
    """pages with skip: other_namespace, empty, short, or null for those to keep."""
    n = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\s+", ""))
    return pages.withColumn("skip", F.when(F.col("ns") != "0", "other_namespace").when(F.coalesce(F.col("raw_text"), F.lit("")) == "", "empty").when(n < least, "short"))


def page_counts(admitted: DataFrame) -> DataFrame:
    """seen, written, and the pages skipped by each reason, of admitted_pages()."""
    skipped = [F.count_if(F.col("skip") == k).alias(f"skipped_{k}") for k in ("other_namespace", "empty", "short")]
    return admitted.agg(F.count("*").alias("seen"), F.count_if(F.col("skip").isNull()).alias("written"), *skipped)


def write_lines(df: DataFrame, path: str, keep_nulls: bool = True) -> None:
    """JSON lines, with null fields where they are part of the contract."""
    df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def write_split(scored: DataFrame, keep, kept_path: str, rejected_path: str, table_path: str) -> None:
    """Scored rows once as a table, kept and rejected ones from it as JSON lines."""
    scored.write.mode("overwrite").parquet(table_path)
    stored = scored.sparkSession.read.parquet(table_path)
    write_lines(stored.where(keep), kept_path)
    write_lines(stored.where(~keep), rejected_path)


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """JSON lines in a folder for each shard."""
    df.write.mode("overwrite").partitionBy(shard).json(path)


def stats_json(stats: dict[str, DataFrame]) -> str:
    """Aggregates (each a few rows) as one JSON object."""
    import json

    return json.dumps({k: [r.asDict(True) for r in df.collect()] for k, df in stats.items()}, ensure_ascii=False, default=str)


def byte_size(text: str) -> int:
    """A number of bytes with an optional K, M or G."""
    units = {"K": 1 << 10, "M": 1 << 20, "G": 1 << 30}
    text = text.strip().upper()
    return int(float(text[:-1]) * units[text[-1]]) if text[-1:] in units else int(text)
