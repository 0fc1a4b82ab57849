"""Problem 2: near-duplicate records by BagMinHash signatures, banding and verification of the overlap.

A signature has SLOTS minima. Each shingle has, for each level of the discretised weights ([0,1), [1,2), [2,4), ...), a
Poisson process whose points carry a time, a slot and a height in the level; a point counts for a record if its height
lies below the shingle's weight there. All of it comes from hashes of shingle, level and number of the point, so
records share a minimum with a probability equal to their weighted Jaccard similarity. Points are made in the order of
time, for all records of a batch at once, only as far as the slots still need them.

Equal texts are one class (a 64-bit hash of the text without blanks); bands, links and components hold classes, and
copies are expanded from their class only where pairs of ids are asked for. Null and short texts are alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec

SHINGLE, LEAST_CHARS, THRESHOLD = 5, 80, 0.7
#: P(a pair at similarity s shares a band) = 1 - (1 - s ** ROWS) ** BANDS: 0.9994 at 0.7, 0.99998 at 0.75, 0.0004 at 0.1.
ROWS, BANDS = 5, 40
#: The characters left out before texts are compared.
BLANKS = " \t\r\n　 "


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(shingles: np.ndarray, weights: np.ndarray | None, offsets: np.ndarray, slots: int = ROWS * BANDS) -> np.ndarray:
    """A row of minima (float32 times) for each record. shingles: hashes, those of record k from offsets[k] to offsets[k + 1];

    weights: their positive integer weights, none for sets (a repeated shingle then changes nothing). Records without a
    shingle get infinity.
    """
    n = len(offsets) - 1
    sig = np.full(n * slots, np.inf)
    record = vec.row_ids(offsets)
    if weights is None:
        element, rec, width, below = shingles, record, np.ones(len(shingles)), None
    else:
        parts, level = [], 0
        while True:
            low, size = (0, 1) if not level else (1 << level - 1, 1 << level - 1)
            at = np.flatnonzero(weights > low)
            if not len(at):
                break
            parts.append((vec.mix64(shingles[at] + np.uint64(level * 0x9E3779B9)), record[at], np.full(len(at), float(size)), np.minimum(1.0, (weights[at] - low) / size)))
            level += 1
        if not parts:
            return sig.reshape(n, slots).astype(np.float32)
        element, rec, width, below = (np.concatenate(x) for x in zip(*parts, strict=True))
    total = vec.segment_sum(np.ones(len(record)) if weights is None else weights.astype(np.float64), offsets)
    horizon = np.where(total > 0, slots / np.maximum(total, 1) * (np.log(slots) + 1), 0)
    time = np.zeros(len(element))
    with np.errstate(over="ignore"):
        state = vec.mix64(element)
        waiting = None
        while True:
            live, late_i, late_t = np.arange(len(element)), [], []
            number = state
            now = time
            if waiting is not None:
                live, number, now = waiting
            while len(live):
                fresh = now < 0  # a point already drawn, beyond the last horizon: its time is kept negated
                number = np.where(fresh, number, vec.mix64(number + np.uint64(0x9E3779B97F4A7C15)))
                now = np.where(fresh, -now, now - np.log(_uniform(number)) / width[live])
                soon = now <= horizon[rec[live]]
                late_i.append(live[~soon]), late_t.append((number[~soon], -now[~soon]))
                live, number, now = live[soon], number[soon], now[soon]
                draw = vec.mix64(number ^ np.uint64(0xA5A5A5A5A5A5A5A5))
                slot = (draw & np.uint64(0xFFFFFFFF)).astype(np.int64) * slots >> 32
                if below is None:
                    np.minimum.at(sig, rec[live] * slots + slot, now)
                else:
                    counts = _uniform(vec.mix64(draw)) < below[live]
                    np.minimum.at(sig, (rec[live] * slots + slot)[counts], now[counts])
            missing = np.isinf(sig.reshape(n, slots)).any(1) & (total > 0)
            if not missing.any():
                return sig.reshape(n, slots).astype(np.float32)
            horizon = np.where(missing, horizon * 1.6, horizon)
            live = np.concatenate(late_i)
            number, now = (np.concatenate(x) for x in zip(*late_t, strict=True))
            keep = missing[rec[live]]
            waiting = live[keep], number[keep], now[keep]


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each band of each row of sig, the band's number included."""
    n, slots = sig.shape
    bits = sig.view(np.uint32).astype(np.uint64).reshape(n, slots // rows, rows)
    key = np.broadcast_to(np.arange(slots // rows, dtype=np.uint64), (n, slots // rows)).copy()
    with np.errstate(over="ignore"):
        for k in range(rows):
            key = vec.mix64(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, k])
    return key


def shingle_hashes(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` characters of each text, and the offsets of the texts in them."""
    chars, offsets = vec.codepoints(column)
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    return vec.window_hashes(chars, size)[vec.ragged(offsets[:-1], counts)] if len(chars) >= size else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)])


def _keyed(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Record (16 bits) and hash (its 48 high bits) of each shingle in one sortable number; a step has fewer records than that."""
    return (vec.row_ids(offsets).astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16))


def _bag(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each record (as _keyed), their counts and the new offsets."""
    keys = np.sort(_keyed(h, offsets))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return keys, counts, np.searchsorted(keys, np.arange(len(offsets), dtype=np.uint64) << np.uint64(48))


def similarities(left: pa.Array, right: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The exact Jaccard similarity of each pair of texts, as multisets and as sets of shingles. At most 65,536 pairs at once."""
    (a, m, _), (b, n, _) = (_bag(*shingle_hashes(x, size)) for x in (left, right))
    keys, counts = np.concatenate([a, b]), np.concatenate([m, n])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    both = np.flatnonzero(keys[1:] == keys[:-1])
    record = lambda k: (k >> np.uint64(48)).astype(np.int64)
    out = []
    for weight, shared in ((counts, np.minimum(counts[both], counts[both + 1])), (np.ones_like(counts), np.ones(len(both), np.int64))):
        common = np.bincount(record(keys[both]), shared, len(left))
        total = np.bincount(record(keys), weight, len(left)) - common
        out.append(common / np.maximum(total, 1))
    return out[0], out[1]


#: Classes that are broadcast at most (8 bytes each); more of them are joined by a shuffle.
BROADCAST_CLASSES = 1_000_000


def prepared(docs: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """id, c (the class), t (the text without blanks) of the texts that are long enough."""
    t = docs.select(docs[id_col].alias("id"), F.translate(docs[text], BLANKS, "").alias("t")).where(F.length("t") >= LEAST_CHARS)
    return t.select("id", F.xxhash64("t").alias("c"), "t")


def bands(held: DataFrame) -> DataFrame:
    """key, c of each band of each class's bag of shingles. A task signs a text once, however many copies of it it sees."""

    def make():
        seen: set[int] = set()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            batch = batch.take(vec.fresh_rows(seen, batch.column(0).to_pylist()))
            h, weights, offsets = _bag(*shingle_hashes(batch.column(1)))
            h = vec.mix64(h & np.uint64((1 << 48) - 1))
            keys = band_keys(signatures(h, weights, offsets))
            return pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))], ["key", "c"])

        return run

    return vec.map_steps(held.select("c", "t"), make, "key bigint, c bigint", "t")


def class_links(held: DataFrame, threshold: float = THRESHOLD, measure: str = "multiset") -> DataFrame:
    """c < d, multiset, set (similarities) of each pair of classes (of prepared()) whose ``measure`` reaches the threshold.

    One shuffle brings bands together; those of one class alone, nearly all, are dropped before pairs are made, and the
    rest is written to the shared folder, as are the distinct candidates. Both texts of a candidate are compared in
    full; the classes needed for that are broadcast to the scan of the texts only up to BROADCAST_CLASSES of them.
    """

    def verify():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            bag, alike = similarities(batch.column(2), batch.column(3))
            out = pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(bag), pa.array(alike)], ["c", "d", "multiset", "set"])
            return out.filter(pa.array((bag if measure == "multiset" else alike) >= threshold))

        return run

    vec.shared_dir(held.sparkSession)
    shared = vec.shared_by_two(bands(held), "key", "c").distinct().checkpoint()
    pairs = vec.pairs_of(shared, ["key"], "c", "d").select("c", "d").distinct().checkpoint()
    needed = pairs.select("c").union(pairs.select("d")).distinct()
    if needed.count() <= BROADCAST_CLASSES:
        needed = F.broadcast(needed)
    texts = held.select("c", "t").join(needed, "c", "left_semi").groupBy("c").agg(F.max("t").alias("t"))
    full = pairs.join(texts, "c").join(texts.select(F.col("c").alias("d"), F.col("t").alias("u")), "d").select("c", "d", "t", "u")
    return vec.map_steps(full, verify, "c bigint, d bigint, multiset double, set double", "t")


def similar_pairs(docs: DataFrame, id_col: str = "id", text: str = "text", threshold: float = THRESHOLD, measure: str = "multiset") -> DataFrame:
    """id_a < id_b of all pairs of ids at least that similar, copies included. Classes of many copies are paired in parts."""
    held = prepared(docs, id_col, text)
    members = held.select("id", "c").distinct()
    left = members.select(F.col("id").alias("a"), "c")
    right = members.select(F.col("id").alias("b"), F.col("c").alias("d"))
    across = class_links(held, threshold, measure).join(left, "c").join(right, "d").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
    within = vec.pairs_of(left, ["c"], "a", "b").select(F.col("a").alias("id_a"), F.col("b").alias("id_b"))
    return across.unionByName(within).where("id_a < id_b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root of the connected components of edges (two columns of one type): alternating large and small stars.

    Each round is cut by a checkpoint in the shared folder; the driver sees counts alone.
    """
    vec.shared_dir(edges.sparkSession)
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v").distinct().checkpoint()
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct().checkpoint()
        unchanged = small.count() == links.count() and small.exceptAll(links).isEmpty()
        links = small
        if unchanged:
            break
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def groups(docs: DataFrame, id_col: str = "id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, group_id, n_links of every id: the group is the connected component of similar classes, n_links the number of

    other classes the record is similar to. Null and short texts are groups of their own.
    """
    held = prepared(docs, id_col, text)
    links = class_links(held, threshold).select("c", "d").checkpoint()
    degree = links.select("c").union(links.select("d")).groupBy("c").agg(F.count("*").alias("n_links"))
    roots = components(links, "c", "d").select(F.col("node").alias("c"), "root")
    members = held.select("id", "c").distinct()
    rooted = members.join(roots, "c", "left").join(degree, "c", "left").select("id", F.coalesce("root", "c").alias("root"), "n_links")
    joined = docs.select(docs[id_col].alias("id")).distinct().join(rooted, "id", "left")
    group = F.when(F.col("root").isNull(), F.concat(F.lit("alone:"), F.col("id").cast("string"))).otherwise(F.hex("root"))
    return joined.select("id", group.alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
