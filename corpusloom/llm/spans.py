"""Problem 10: long exact spans that several documents share.

Equal texts are one class, so copies cost nothing. From each text, anchors are taken: of the windows of a quarter of the
span, the one with the least hash in every stretch as long as the span, so that two texts with a common span share one
of its anchors. Anchors that occur in two classes survive; only around them windows of twice the length are taken, and
so on up to the span itself, where every window counts. What survives there is shared, and exactly that.

Null and shorter texts share nothing. A span repeated within one text alone isn't shared. Positions and lengths are in
code points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vec

LEAST_SPAN = 160
#: Positions that are broadcast to the scan of the texts at most; more of them are joined by a shuffle.
BROADCAST_POSITIONS = 2_000_000


def _class_members(docs: DataFrame, id_col: str, text: str, span: int) -> DataFrame:
    long = docs.where(F.length(docs[text]) >= span)
    return long.select(docs[id_col].alias("id"), F.xxhash64(docs[text]).alias("c"), docs[text].alias("text"))


def _anchors(texts: DataFrame, width: int, span: int) -> DataFrame:
    """c, pos, h of each text's anchors. Where texts has a column near (start positions of surviving windows of half the

    width), only those that share a stretch of ``span`` with one of them. At width = span each window is its own. A
    task treats a text once, however many copies of it it sees.
    """
    limited = "near" in texts.columns

    def make():
        seen: set[int] = set()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            batch = batch.take(vec.fresh_rows(seen, batch.column(0).to_pylist()))
            chars, offsets = vec.codepoints(batch.column(1))
            n = len(chars) - width + 1
            if n <= 0:
                return None
            h = vec.window_hashes(chars, width)
            room = offsets[1:] - width  # last start in each row
            if limited:
                lists = batch.column(2)
                count = lists.value_lengths().to_numpy()
                near = lists.flatten().to_numpy() + np.repeat(offsets[:-1], count)
                row = np.repeat(np.arange(batch.num_rows), count)
                edge = np.zeros(len(chars) + 1, np.int32)
                np.add.at(edge, np.maximum(near + width // 2 - span, offsets[row]), 1)
                np.add.at(edge, np.minimum(near + span, offsets[row + 1]), -1)
                total = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
            if width == span:
                pos = np.flatnonzero(total[width:] - total[:n] == width) if limited else np.arange(n)
                row = np.searchsorted(offsets, pos, "right") - 1
                pos, row = pos[pos <= room[row]], row[pos <= room[row]]
            else:
                stretch = span - width + 1
                least = vec.window_min(h, stretch)
                # a stretch counts if it lies in one text (and in its candidate region)
                start = np.arange(len(least))
                row = np.searchsorted(offsets, start, "right") - 1
                ok = start + span <= offsets[row + 1]
                if limited:
                    ok &= total[start + span] - total[start] == span
                pos = _argmins(h, least, np.flatnonzero(ok), stretch)
                row = np.searchsorted(offsets, pos, "right") - 1
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array((pos - offsets[row]).astype(np.int32)), pa.array(h[pos].view(np.int64))], ["c", "pos", "h"])

        return run

    return vec.map_steps(texts.select("c", "text", *["near"] * limited), make, "c bigint, pos int, h bigint")


def _argmins(h: np.ndarray, least: np.ndarray, starts: np.ndarray, stretch: int) -> np.ndarray:
    """Places whose hash is the least of some stretch that begins at one of starts."""
    if not len(starts):
        return np.zeros(0, np.int64)
    # h[p] is the least of a wanted stretch [s, s + stretch) iff some s in p - stretch + 1 .. p has least[s] == h[p]:
    # the greatest of those least values is h[p] itself, since each is at most h[p]
    masked = np.zeros(len(h), np.uint64)
    masked[starts] = least[starts] + np.uint64(1)
    padded = np.concatenate([np.zeros(stretch - 1, np.uint64), masked])
    most = ~vec.window_min(~padded, stretch)
    return np.flatnonzero((most == h + np.uint64(1)) & (most > 0))


def _surviving(anchors: DataFrame) -> DataFrame:
    """The anchors whose hash occurs in two classes, and whether it is hot, written to the shared folder."""
    return vec.shared_by_two(anchors, "h", "c", "hot").checkpoint()


def shared_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = LEAST_SPAN) -> tuple[DataFrame, DataFrame]:
    """members (id, c, text) and the windows (c, pos, h) of length span that occur in two classes of equal texts."""
    held = _class_members(docs, id_col, text, span)
    texts = held.select("c", "text")
    vec.shared_dir(docs.sparkSession)
    width = max(1, span // 4)
    found = _surviving(_anchors(texts, width, span))
    while width < span:
        width = span if width * 4 > span * 2 else width * 2
        near = found.groupBy("c").agg(F.collect_set("pos").alias("near"))  # at most the positions of one text
        if found.count() <= BROADCAST_POSITIONS:
            near = F.broadcast(near)
        found = _surviving(_anchors(texts.join(near, "c"), width, span))
    return held, found


def _sets(windows: DataFrame) -> DataFrame:
    """s1, s2 (two sums over the classes that hold a window), c: neighbouring windows held by the same classes are one set.

    One shuffle by window serves all steps; hot windows are summed up on their own, partially before their shuffle.
    """
    small = lambda h: F.shiftright(h, 20)  # noqa: E731  sums of many don't overflow

    def summed(one: DataFrame) -> DataFrame:
        sums = one.groupBy("h").agg(F.sum(small(F.xxhash64("c"))).alias("s1"), F.sum(small(F.xxhash64(F.lit(3), "c"))).alias("s2"))
        return one.join(sums, "h").select("s1", "s2", "c").distinct()

    cold = windows.where("not hot").select("h", "c").repartition("h").distinct()
    return summed(cold).unionByName(summed(windows.where("hot").select("h", "c").distinct()))


def sharing_pairs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = LEAST_SPAN) -> DataFrame:
    """id_a < id_b of all documents with a common span. Copies are expanded from their class, as every pair is asked for."""
    held, windows = shared_windows(docs, id_col, text, span)
    members = held.select("id", "c").distinct()
    sets = _sets(windows).distinct().checkpoint()
    classes = vec.pairs_of(sets, ["s1", "s2"], "c", "d").select("c", "d").distinct()
    left = members.select(F.col("id").alias("a"), "c")
    across = classes.join(left, "c").join(members.select(F.col("id").alias("b"), F.col("c").alias("d")), "d").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
    within = vec.pairs_of(left, ["c"], "a", "b").select(F.col("a").alias("id_a"), F.col("b").alias("id_b"))
    return across.unionByName(within).where("id_a < id_b").distinct()


def shared_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = LEAST_SPAN) -> DataFrame:
    """id, start, end of the maximal stretches of each document that lie in spans shared with others; a copy is shared whole."""
    held, windows = shared_windows(docs, id_col, text, span)
    by_class = Window.partitionBy("c").orderBy("pos")  # at most the windows of one text
    islands = windows.select("c", "pos").withColumn("new", F.when(F.col("pos") > F.lag("pos").over(by_class) + span, 1).otherwise(0)).withColumn("island", F.sum("new").over(by_class))
    spans = islands.groupBy("c", "island").agg(F.min("pos").alias("start"), (F.max("pos") + span).alias("end")).drop("island")
    sized = held.select("id", "c", F.length("text").alias("n")).distinct()
    copied = sized.groupBy("c").agg((F.min("id") != F.max("id")).alias("copied")).where("copied").select("c")
    whole = sized.join(copied, "c", "left_semi").select("id", F.lit(0).alias("start"), F.col("n").alias("end"))
    partly = sized.join(copied, "c", "left_anti").join(spans, "c").select("id", "start", "end")
    return whole.unionByName(partly)


def shared_share(docs: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = LEAST_SPAN) -> DataFrame:
    """id, n_chars, shared_chars of every document: how much of it also stands in others. Null texts have 0 of null."""
    found = shared_spans(docs, id_col, text, span).groupBy("id").agg(F.sum(F.col("end") - F.col("start")).alias("shared"))
    sizes = docs.select(docs[id_col].alias("id"), F.length(docs[text]).alias("n_chars")).dropDuplicates(["id"])
    return sizes.join(found, "id", "left").select("id", "n_chars", F.coalesce("shared", F.lit(0)).alias("shared_chars"))
