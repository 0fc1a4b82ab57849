"""The pN_ queries, over the whole tables with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, encoding, lines, mixing, neardup, pairs, quality, scans, spans, splitting

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, field, restored, complete of every garbled value."""
    return encoding.repaired(table(spark, sf_dir, "v2_chunks").select("id", "text", "source")).dropDuplicates(["id", "field"])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.repaired(table(spark, sf_dir, "v2_chunks").select("id", "text", "source")).select("id", "field").distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by signatures of bags; the sets that define a case are compared last."""
    return neardup.similar_pairs(table(spark, sf_dir, "v2_chunks").select("id", "text"), measure="set")


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, group_id, n_links of every record."""
    return neardup.groups(table(spark, sf_dir, "v2_chunks").select("id", "text"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.noisy_lines(table(spark, sf_dir, "pdf_chunks"))


def p3_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, paragraphs of every chunk."""
    return scans.repaired(table(spark, sf_dir, "pdf_chunks"))


#: Rows that come in later than this after they were built are the partition that is merged into the rest.
LATE_DAYS = 7


def _maintained(docs: DataFrame) -> lines.Update:
    """The rows in time as the first partition, the late ones merged as a delta."""
    late = F.coalesce(F.col("ingested_at") > F.col("built_at") + F.make_dt_interval(F.lit(LATE_DAYS)), F.lit(False))
    return lines.maintained(docs, late)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _maintained(table(spark, sf_dir, "v2_chunks").select("id", "source", "text", "built_at", "ingested_at")).hits


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, clean_text of the records that hold an excessive line."""
    docs = table(spark, sf_dir, "v2_chunks").select("id", "source", "text", "built_at", "ingested_at")
    return lines.rebuild(docs.select("id", "text"), _maintained(docs).hits).select("id", "clean_text").dropDuplicates(["id"])


def p4_concerned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id of the records that the late partition concerns: its own, and those with a line that crossed the threshold by it."""
    return _maintained(table(spark, sf_dir, "v2_chunks").select("id", "source", "text", "built_at", "ingested_at")).concerned


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_oversized(table(spark, sf_dir, "v2_chunks"), table(spark, sf_dir, "size_limits"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_pieces(spark, sf_dir).where("n_pieces > 1").select("id").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.defects(table(spark, sf_dir, "sft_answers").select("id", "sft_question", "sft_answer"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "v2_chunks").select("id", "text"), table(spark, sf_dir, "chunk_labels"), table(spark, sf_dir, "common_words"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).where(F.col("kind") != "prose").select("id", "kind").distinct()


def p7_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's statistics, percentiles within its language, kind, and its true length beside char_count."""
    scored = _scored(spark, sf_dir).dropDuplicates(["id"])
    names = [*(F.col("stats")[k].alias(s) for k, s in enumerate(quality.STATS)), *(F.col("percentiles")[k].alias(f"{s}_percentile") for k, s in enumerate(quality.STATS))]
    counts = table(spark, sf_dir, "v2_chunks").groupBy("id").agg(F.max("char_count").alias("char_count"))
    return scored.select("id", "lang", "kind", *names).join(counts, "id")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, sf_dir, "documents"))


def _mixed(spark: SparkSession, sf_dir: str) -> mixing.Mix:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(bpe.count_tokens(docs, "text", bpe.VOCABULARY, "doc_id", "source"), table(spark, sf_dir, "mix_targets"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mix_name, source, doc_id, n_tokens, uses of every document in a mix."""
    return _mixed(spark, sf_dir).members


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actual shares of every source in every mix beside its target."""
    return mixing.report(_mixed(spark, sf_dir))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans.sharing_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b"))


def p10_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, end of the stretches of each document that also stand in others."""
    return spans.shared_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("id", "doc_id")


def p10_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, shared_chars of every document."""
    return spans.shared_share(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_groups, p3_found, p3_paragraphs, p4_found, p4_clean, p4_concerned, p5_found, p5_pieces, p6_found, p7_found, p7_stats, p8_ids, p9_mix, p9_shares, p10_found, p10_spans, p10_share)}


def oracle_sql() -> dict[str, str]:
    return {"p2_found": P2_FOUND, "p4_found": P4_FOUND, "p4_clean": P4_CLEAN, "p5_found": P5_FOUND, "p10_found": P10_FOUND}


P4_FOUND = r"""
WITH docs AS (SELECT DISTINCT id, source, text FROM v2_chunks),
pos AS (SELECT id, source, string_split(text, chr(10)) AS parts FROM docs WHERE text IS NOT NULL),
flat AS (SELECT id, source, unnest(parts) AS raw, unnest(range(len(parts))) AS line_no FROM pos),
norm AS (SELECT id, source, line_no, trim(regexp_replace(regexp_replace(lower(raw), '[0-9０-９]+', '0', 'g'), '[ \t\r\x{3000}\x{00A0}]+', ' ', 'g')) AS line FROM flat),
held AS (SELECT * FROM norm WHERE length(line) >= 4),
counts AS (SELECT source, line, count(DISTINCT id) AS n FROM held GROUP BY ALL),
sizes AS (SELECT source, count(DISTINCT id) AS n_ids FROM docs GROUP BY ALL)
SELECT DISTINCT h.id, CAST(h.line_no AS INTEGER) AS line_no
FROM held h JOIN counts c ON h.line = c.line AND h.source IS NOT DISTINCT FROM c.source
JOIN sizes z ON z.source IS NOT DISTINCT FROM h.source
WHERE c.n >= 5 AND c.n * 10 >= z.n_ids
"""

P5_FOUND = "SELECT DISTINCT v.id FROM v2_chunks v JOIN size_limits s USING (dataset_source) WHERE length(v.text) > s.max_chars"

P4_CLEAN = rf"""
WITH hits AS ({P4_FOUND}),
docs AS (SELECT DISTINCT id, string_split(text, chr(10)) AS parts FROM v2_chunks WHERE id IN (SELECT id FROM hits)),
flat AS (SELECT id, unnest(parts) AS line, CAST(unnest(range(len(parts))) AS INTEGER) AS line_no FROM docs)
SELECT id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT hit), '') AS clean_text
FROM (SELECT f.*, h.id IS NOT NULL AS hit FROM flat f LEFT JOIN hits h USING (id, line_no)) GROUP BY id
"""

P2_FOUND = r"""
WITH t AS (SELECT DISTINCT id, regexp_replace(text, '[ \t\r\n\x{3000}\x{00A0}]+', '', 'g') AS t FROM v2_chunks WHERE text IS NOT NULL),
texts AS (SELECT t, row_number() OVER () AS c FROM (SELECT DISTINCT t FROM t WHERE length(t) >= 80)),
runs AS (SELECT c, list_distinct(list_transform(range(1, CAST(length(t) - 3 AS BIGINT)), lambda i: substring(t, i, 5))) AS s FROM texts),
sizes AS (SELECT c, len(s) AS n FROM runs),
flat AS (SELECT c, unnest(s) AS s FROM runs),
common AS (SELECT a.c, b.c AS d, count(*) AS k FROM flat a JOIN flat b ON a.s = b.s AND a.c < b.c GROUP BY ALL),
alike AS (SELECT x.c, x.d FROM common x JOIN sizes p ON p.c = x.c JOIN sizes q ON q.c = x.d WHERE k >= 0.7 * (p.n + q.n - k)),
members AS (SELECT id, c FROM t JOIN texts USING (t)),
linked AS (SELECT c, d FROM alike UNION ALL SELECT d, c FROM alike UNION ALL SELECT c, c FROM texts)
SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM linked l JOIN members a ON a.c = l.c JOIN members b ON b.c = l.d WHERE a.id < b.id
"""

_WINDOWS = """
t AS (SELECT doc_id, text FROM documents WHERE length(text) >= 160),
texts AS (SELECT text, row_number() OVER () AS c FROM (SELECT DISTINCT text FROM t)),
places AS (SELECT c, text, CAST(unnest(range(1, CAST(length(text) - 158 AS BIGINT))) AS BIGINT) AS pos FROM texts),
windows AS (SELECT c, pos, md5_number(substring(text, pos, 160)) AS w FROM places),
shared AS (SELECT w FROM windows GROUP BY w HAVING count(DISTINCT c) > 1),
held AS (SELECT c, pos, w FROM windows SEMI JOIN shared USING (w)),
members AS (SELECT doc_id, c, length(text) AS n FROM t JOIN texts USING (text))"""

P10_FOUND = f"""
WITH {_WINDOWS},
once AS (SELECT DISTINCT c, w FROM held),
pairs AS (SELECT DISTINCT a.c, b.c AS d FROM once a JOIN once b ON a.w = b.w UNION SELECT c, c FROM texts)
SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM pairs p JOIN members a ON a.c = p.c JOIN members b ON b.c = p.d WHERE a.doc_id < b.doc_id
"""

#: Held against p10_share by a test; its null lengths have other types in the two engines' data frames.
P10_SHARE = f"""
WITH {_WINDOWS},
copied AS (SELECT c FROM members GROUP BY c HAVING count(*) > 1),
gaps AS (SELECT c, least(160, coalesce(lead(pos) OVER (PARTITION BY c ORDER BY pos) - pos, 160)) AS own FROM (SELECT DISTINCT c, pos FROM held)),
covered AS (SELECT c, sum(own) AS k FROM gaps GROUP BY c)
SELECT d.doc_id, CAST(length(d.text) AS INTEGER) AS n_chars, CAST(coalesce(CASE WHEN x.c IS NOT NULL THEN m.n ELSE k END, 0) AS BIGINT) AS shared_chars
FROM documents d LEFT JOIN members m ON m.doc_id = d.doc_id LEFT JOIN copied x ON x.c = m.c LEFT JOIN covered v ON v.c = m.c
"""
