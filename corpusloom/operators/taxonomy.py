"""Labels of a taxonomy: reading them from Markdown, and candidate labels for a text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import instruct as I

def tokens(c: Column) -> Column:
    """Runs of ASCII word characters and of CJK from two characters, in lower case, and CJK bigrams across gaps."""
    low = F.lower(c)
    runs = F.regexp_extract_all(low, F.lit(r"([a-z0-9_]+|[\x{4e00}-\x{9fff}]{2,})"), F.lit(1))
    cjk = F.regexp_replace(low, r"[^\x{4e00}-\x{9fff}]", "")
    bigrams = F.when(F.length(cjk) >= 2, F.transform(F.sequence(F.lit(1), F.length(cjk) - 1), lambda i: F.substring(cjk, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(runs, bigrams))


#: Names of the sides.
SIDE_NAMES = {"friendly": "我方", "opponent": "他方"}


def candidates(df: DataFrame, labels: DataFrame, k: int = 60, id_col: str = "id", text: str = "text") -> DataFrame:
    """id, label_id, score, rank of the k best labels of each text.

    A label gains 8 for each non-empty part of its path (name of its side, three levels) that the text contains, letter
    case aside; 1.5 for each token they share; 3 for its first and 4 for its second level in the text as they are
    written, an empty one being in every text. Ties go to the label that comes first in the catalog (by label_id). The
    catalog is a table of fixed size; it goes to the tasks as an index from tokens and parts to labels, and each text is
    scored in its task: no row is made for a label that isn't among the best, and nothing is shuffled. Null texts are ''.
    """
    side = F.coalesce(*[F.when(F.col("side") == s, n) for s, n in SIDE_NAMES.items()], F.nullif("side", F.lit("")), F.lit(""))
    parts = [T.strip(side), *(T.strip(F.coalesce(c, F.lit(""))) for c in ("level1", "level2", "level3"))]
    rows = labels.select("label_id", *(p.alias(f"p{i}") for i, p in enumerate(parts)), tokens(F.concat_ws(" ", "full_path", *parts)).alias("tokens")).orderBy("label_id").collect()
    names = [r["label_id"] for r in rows]
    by_token: dict[str, list[int]] = {}
    by_part: dict[str, np.ndarray] = {}
    by_level: dict[str, np.ndarray] = {}
    for i, r in enumerate(rows):
        for t in r["tokens"]:
            by_token.setdefault(t, []).append(i)
        for p in (r["p0"], r["p1"], r["p2"], r["p3"]):
            if p:
                by_part.setdefault(p.lower(), np.zeros(len(rows)))[i] += 8
        for p, gain in ((r["p1"], 3), (r["p2"], 4)):
            by_level.setdefault(p, np.zeros(len(rows)))[i] += gain

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, scores = [], []
            for body, held in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                low = body.lower()
                score = np.bincount([i for t in held for i in by_token.get(t, ())], minlength=len(names)) * 1.5 if names else np.zeros(0)
                for p, gain in by_part.items():
                    if p in low:
                        score = score + gain
                for p, gain in by_level.items():
                    if p in body:
                        score = score + gain
                best = np.argsort(-score, kind="stable")[:k]
                which.append(best)
                scores.append(score[best])
            sizes = np.array([len(x) for x in which], np.int64)
            if sizes.sum():
                row, label = np.repeat(np.arange(len(sizes)), sizes), np.concatenate(which)
                rank = np.concatenate([np.arange(1, n + 1) for n in sizes]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(names, pa.string()).take(pa.array(label)), pa.array(np.concatenate(scores)), pa.array(rank)], ["id", "label_id", "score", "rank"])

    told = df.select(df[id_col].alias("id"), F.coalesce(df[text], F.lit("")).alias("t"))
    return told.withColumn("tokens", tokens(F.col("t"))).mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, label_id string, score double, rank int")


def normal_label(raw: Column) -> Column:
    """A label from an untyped catalog entry (variant): id, side, side_name, l1, l2, leaf, path.

    Names may come as id or label_id, l1 or level1, l2 or level2, leaf, level3, name or leaf_name; a path as a list or as
    text with > or / between its parts. What is missing comes from the path, the side from the id's first letter. An id
    that is missing stays '' (see numbered_labels).
    """
    names = ("id", "label_id", "path", "full_path", "side", "side_name", "l1", "level1", "l2", "level2", "leaf", "level3", "name", "leaf_name")
    read = F.struct(*(I.text_of(I.field(raw, n)).alias(n) for n in names))
    listed = F.struct(*(F.coalesce(F.filter(F.transform(F.when(I.is_list(I.field(raw, n)), I.texts_of(I.field(raw, n))), T.strip), lambda x: x != ""), F.array().cast("array<string>")).alias(n) for n in ("path", "full_path")))

    def begun(x: Column) -> Column:
        first = lambda *of: T.strip(F.coalesce(*(F.nullif(x["t"][n], F.lit("")) for n in of), F.lit("")))
        own = F.when(x["t"]["path"] != "", x["l"]["path"]).otherwise(x["l"]["full_path"])
        text = first("path", "full_path")
        parts = F.when(text.contains(">"), F.split(text, ">")).otherwise(F.split(text, "/"))
        path = F.when(F.size(own) > 0, own).when(text.startswith("[") & text.endswith("]"), own).otherwise(F.filter(F.transform(parts, T.strip), lambda p: p != ""))
        label_id, side = first("id", "label_id"), first("side")
        side = F.when(side != "", side).when(label_id.startswith("F"), "friendly").when(label_id.startswith("O"), "opponent").otherwise("")
        return F.struct(label_id.alias("id"), side.alias("side"), first("side_name").alias("named"), first("l1", "level1").alias("l1"), first("l2", "level2").alias("l2"), first("leaf", "level3", "name", "leaf_name").alias("leaf"), path.alias("path"))

    def ended(x: Column) -> Column:
        at = lambda i: F.coalesce(F.try_element_at(x["path"], F.lit(i)), F.lit(""))
        named = F.when(x["named"] != "", x["named"]).when(x["side"] == "friendly", SIDE_NAMES["friendly"]).when(x["side"] == "opponent", SIDE_NAMES["opponent"]).otherwise(at(1))
        l1, l2, leaf = (F.when(x[k] != "", x[k]).otherwise(at(i)) for k, i in (("l1", 2), ("l2", 3), ("leaf", -1)))
        whole = F.when(F.size(x["path"]) == 0, F.filter(F.array(named, l1, l2, leaf), lambda p: p != "")).when(~at(1).isin(*SIDE_NAMES.values()) & (named != ""), F.concat(F.array(named), x["path"])).otherwise(x["path"])
        return F.struct(x["id"], x["side"], named.alias("side_name"), l1.alias("l1"), l2.alias("l2"), leaf.alias("leaf"), whole.alias("path"))

    return I.let(I.let(F.struct(read.alias("t"), listed.alias("l")), begun), ended)


def read_markdown(lines: DataFrame) -> DataFrame:
    """side, source_path, level1, level2, level3, full_path of each bullet of taxonomy files, from (side, path, line_no, line).

    A bullet needs a first heading before it; without a second heading its level2 is '未分组'. A second heading stays in
    force after a new first one.
    """
    flow = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    take = lambda pattern: F.nullif(T.strip(F.regexp_extract("line", pattern, 1)), F.lit(""))
    marked = lines.withColumn("level1", F.last(take(r"^#\s+(.+)$"), True).over(flow)).withColumn("level2", F.last(take(r"^##\s+(.+)$"), True).over(flow)).withColumn("level3", take(r"^\s*[-*]\s+(.+)$"))
    leaves = marked.where("level1 is not null and level3 is not null").withColumn("level2", F.coalesce("level2", F.lit("未分组")))
    return leaves.select("side", F.col("path").alias("source_path"), "level1", "level2", "level3", F.concat_ws(">", "side", "level1", "level2", "level3").alias("full_path"))


def numbered_labels(leaves: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """leaves with label_id: a letter for the side (X for others) and four digits in the order of path and leaf."""
    letter = F.lit("X")
    for side, mark in prefixes.items():
        letter = F.when(F.col("side") == side, mark).otherwise(letter)
    n = F.row_number().over(Window.partitionBy("side").orderBy("source_path", "level1", "level2", "level3"))
    return leaves.withColumn("label_id", F.format_string("%s%04d", letter, n))
