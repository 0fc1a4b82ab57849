"""Problem 4: lines that one source repeats in too many of its documents.

State is a set of tables that are stored: the counts of lines in each source, the number of documents in each source, the
ids counted, and an index of which document holds which line where. A new partition is read once, for its index; its
counts are added as a delta. Lines that cross the threshold with it, in either direction, are found by comparing the
counts before and after; results change for the documents that hold such a line, and for those of the new partition.

Lines are kept as two 64-bit hashes of their normal form, so that no text is shuffled. A null source is a source of its
own. Null texts have no lines; blank and short lines never count. An id that arrives again counts once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vec

LEAST_CHARS, LEAST_IDS, LEAST_SHARE_PERCENT = 4, 5, 10
_KEY = ["s", "h1", "h2"]


@dataclass(frozen=True)
class LineState:
    """counts: s, h1, h2, n; sources: s, n_ids; seen: i. s and i are hashes of source and id."""

    counts: DataFrame
    sources: DataFrame
    seen: DataFrame


def normal_form(text: Column) -> Column:
    """Lower case, one digit for a run of digits, one blank for a run of blanks; lines stay apart and aren't trimmed."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9０-９]+", "0"), "[ \\t\\r\\u3000\\u00A0]+", " ")


def lines_of(docs: DataFrame, id_col: str = "id", source: str = "source", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row of id, s, i, line_no, h1, h2 (and the columns to keep) for each line that is long enough to count."""
    split = docs.select(
        docs[id_col].alias("id"),
        F.xxhash64(docs[source], docs[source].isNull()).alias("s"),
        F.xxhash64(docs[id_col]).alias("i"),
        *keep,
        F.posexplode(F.split(normal_form(docs[text]), "\n")).alias("line_no", "line"),
    )
    line = F.trim("line")
    return split.where(F.length(line) >= LEAST_CHARS).select("id", "s", "i", "line_no", *keep, F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2"))


def count_lines(index: DataFrame, members: DataFrame) -> LineState:
    """The state of one partition alone. index: s, i, h1, h2 of its lines; members: s, i of its documents.

    Each id counts once for a line; no group is gathered anywhere.
    """
    counts = index.select(*_KEY, "i").distinct().groupBy(_KEY).agg(F.count("*").alias("n"))
    members = members.select("s", "i").distinct()
    return LineState(counts, members.groupBy("s").agg(F.count("*").alias("n_ids")), members.select("i"))


def members_of(docs: DataFrame, id_col: str = "id", source: str = "source") -> DataFrame:
    """s, i (hashes of source and id) of each row."""
    return docs.select(F.xxhash64(docs[source], docs[source].isNull()).alias("s"), F.xxhash64(docs[id_col]).alias("i"))


def count_partition(docs: DataFrame, id_col: str = "id", source: str = "source", text: str = "text") -> LineState:
    """The state of one partition alone, from its documents."""
    return count_lines(lines_of(docs, id_col, source, text), members_of(docs, id_col, source))


def unseen(docs: DataFrame, state: LineState, id_col: str = "id") -> DataFrame:
    """The rows of a new partition whose ids the state doesn't hold yet."""
    return docs.join(state.seen, F.xxhash64(docs[id_col]) == state.seen["i"], "left_anti")


def save(state: LineState, folder: str) -> None:
    """Writes the state's tables below a folder, which must be another one than the state was read from."""
    for name in ("counts", "sources", "seen"):
        getattr(state, name).write.mode("overwrite").parquet(f"{folder}/{name}")


def load(spark: SparkSession, folder: str) -> LineState:
    return LineState(*(spark.read.parquet(f"{folder}/{name}") for name in ("counts", "sources", "seen")))


def merge(old: LineState, delta: LineState) -> LineState:
    """Adds the counts of a new partition, which must not share ids with the old state (see unseen)."""
    return LineState(
        old.counts.unionByName(delta.counts).groupBy(_KEY).agg(F.sum("n").alias("n")),
        old.sources.unionByName(delta.sources).groupBy("s").agg(F.sum("n_ids").alias("n_ids")),
        old.seen.unionByName(delta.seen),
    )


def excessive(state: LineState) -> DataFrame:
    """The lines (s, h1, h2) beyond the threshold. Which can't reach it at all is dropped before the join."""
    common = state.counts.where(F.col("n") >= LEAST_IDS)
    return common.join(state.sources, "s").where(F.col("n") * 100 >= F.col("n_ids") * LEAST_SHARE_PERCENT).select(*_KEY)


def crossings(before: LineState, after: LineState) -> tuple[DataFrame, DataFrame]:
    """Lines that became excessive with the last merge, and lines that no longer are."""
    was, now = excessive(before), excessive(after)
    return now.join(was, _KEY, "left_anti"), was.join(now, _KEY, "left_anti")


def repeated_lines(docs: DataFrame, state: LineState, id_col: str = "id", source: str = "source", text: str = "text") -> DataFrame:
    """id, line_no of every excessive line of docs; repeated rows give one."""
    return held_lines(lines_of(docs, id_col, source, text), excessive(state)).distinct()


def held_lines(index: DataFrame, lines: DataFrame) -> DataFrame:
    """id, line_no of the index's lines that are among ``lines``."""
    return index.join(lines, _KEY, "left_semi").select("id", "line_no")


@dataclass(frozen=True)
class Update:
    """state: after the merge. hits: id, line_no of all excessive lines now. concerned: the ids whose hits changed or are new."""

    state: LineState
    hits: DataFrame
    concerned: DataFrame


def update(before: LineState, hits: DataFrame, index: DataFrame, delta: LineState, new_index: DataFrame) -> Update:
    """Takes a new partition in: merges its counts, and changes the hits of documents with newly crossed lines alone.

    hits: those of the documents before; index, new_index: the lines of the documents before and of the new ones. What
    is merged is written to the shared folder, as are the crossings.
    """
    merged = merge(before, delta)
    state = LineState(merged.counts.checkpoint(), merged.sources, merged.seen)
    risen, fallen = (x.checkpoint() for x in crossings(before, state))
    gained, lost, fresh = held_lines(index, risen), held_lines(index, fallen), held_lines(new_index, excessive(state))
    kept = hits.join(lost.distinct(), ["id", "line_no"], "left_anti")
    now = kept.unionByName(gained).unionByName(fresh).distinct()
    return Update(state, now, gained.select("id").union(lost.select("id")).union(new_index.select("id")).distinct())


def maintained(docs: DataFrame, is_new: Column, id_col: str = "id", source: str = "source", text: str = "text") -> Update:
    """The excessive lines of docs, whose rows marked ``is_new`` are a partition that comes after the rest was counted.

    Texts are read once, for the index, which is written to the shared folder. New rows of ids held already change nothing.
    """
    vec.shared_dir(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), docs[source].alias("source"), docs[text].alias("text"), is_new.alias("new"))
    split = lines_of(rows, keep=("new",)).checkpoint()
    old, new = split.where("not new"), split.where("new")
    members = docs.select(F.xxhash64(docs[source], docs[source].isNull()).alias("s"), F.xxhash64(docs[id_col]).alias("i"), is_new.alias("new"))
    first = count_lines(old, members.where("not new"))
    first = LineState(first.counts.checkpoint(), first.sources, first.seen)
    late = members.where("new").join(first.seen, "i", "left_anti").select("s", "i")
    new = new.join(late.select("i").distinct(), "i", "left_semi")
    return update(first, held_lines(old, excessive(first)), old, count_lines(new, late), new)


def rebuild(docs: DataFrame, hits: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """docs that have a hit (id, line_no), with clean_text: the text without these lines."""
    numbers = hits.groupBy("id").agg(F.collect_set("line_no").alias("__drop"))  # at most the lines of one text
    both = docs.join(numbers.withColumnRenamed("id", "__id"), F.col(id_col) == F.col("__id")).drop("__id")
    kept = F.filter(F.split(F.col(text), "\n"), lambda _, n: ~F.array_contains("__drop", n))
    return both.withColumn("clean_text", F.array_join(kept, "\n")).drop("__drop")
