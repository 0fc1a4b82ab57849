"""Problem 5: pieces of oversized texts, cut at natural boundaries and overlapping by a given number of characters.

The least number of pieces gives equal-length targets; each target moves to the strongest boundary near it (paragraph,
line, sentence, clause, blank, else none; the nearest of equals). Should a piece exceed the limit then, one more piece
is tried, with shorter targets and so more room.

A null text or a source without a limit gives no piece; a text within its limit one piece, as it is. An overlap of
max_chars or more is taken as max_chars - 1. Lengths are in code points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec

#: Share of a piece's length within which a target may move.
REACH = 0.15


def boundary_strengths(chars: np.ndarray) -> np.ndarray:
    """For each place between characters (0 .. len), how good a cut there is."""
    n = len(chars)
    strength = np.zeros(n + 1, np.int8)
    if not n:
        return strength

    def after(signs: str) -> np.ndarray:
        return np.flatnonzero(np.isin(chars, [ord(c) for c in signs])) + 1

    strength[after(" \t　 ")] = 1
    strength[after("，,、：:；;）)】")] = 2
    stops = after("。！？!?…")
    strength[stops] = 3
    dots = after(".")
    strength[dots[(dots == n) | np.isin(chars[np.minimum(dots, n - 1)], [32, 10])]] = 3
    quotes = after("”’」』\"»")
    quotes = quotes[strength[quotes - 1] == 3]
    strength[quotes - 1], strength[quotes] = 0, 3
    spaced = after(" ")
    spaced = spaced[strength[spaced - 1] == 3]
    strength[spaced] = 3
    breaks = after("\n")
    strength[breaks] = np.where((breaks >= 2) & (chars[np.maximum(breaks - 2, 0)] == 10), 5, 4)
    return strength


def cut(chars: np.ndarray, max_chars: int, overlap: int) -> list[tuple[int, int]]:
    """The pieces' (start, end). Consecutive ones share exactly the overlap; none is longer than max_chars."""
    n = len(chars)
    if n <= max_chars:
        return [(0, n)]
    overlap = max(0, min(overlap, max_chars - 1))
    strength = boundary_strengths(chars)
    pieces = -(-(n - overlap) // (max_chars - overlap))
    while True:
        step = (n - overlap) / pieces
        reach = int(min(REACH * (step + overlap), 0.45 * step))
        ends = []
        for i in range(1, pieces):
            target = round(i * step + overlap)
            low, high = max(1, target - reach), min(n - 1, target + reach)
            places = np.arange(low, high + 1)
            ends.append(int(places[np.argmax(strength[low : high + 1] - np.abs(places - target) / (2 * reach + 2))]))
        out = list(zip([0, *(e - overlap for e in ends)], [*ends, n], strict=True))
        if all(0 <= a < b and b - a <= max_chars for a, b in out) and all(x < y for x, y in zip(ends, ends[1:], strict=False)):
            return out
        pieces += 1


def split_oversized(docs: DataFrame, limits: DataFrame, id_col: str = "id", text: str = "text", by: str = "dataset_source") -> DataFrame:
    """id, piece_no (from 0), n_pieces, start, piece of each text beyond its limit. limits: by, max_chars, overlap_chars;

    one row for each dataset_source, a handful, hence broadcast. Texts within their limit are settled in the JVM and
    left out; only oversized ones reach Python, each alone. Ids that arrive again come out once.
    """
    sized = docs.select(docs[id_col].alias("id"), docs[by].alias("__by"), docs[text].alias("text"))
    limits = limits.groupBy(limits[by].alias("__by")).agg(F.min("max_chars").alias("max_chars"), F.max("overlap_chars").alias("overlap_chars"))
    oversized = sized.join(F.broadcast(limits), "__by").where((F.col("max_chars") > 0) & (F.length("text") > F.col("max_chars")))

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for key, text, most, overlap in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pieces = cut(np.frombuffer(text.encode("utf-32-le"), "<u4"), most, overlap or 0)
                out += [(key, k, len(pieces), a, text[a:b]) for k, (a, b) in enumerate(pieces)]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int32(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "piece_no", "n_pieces", "start", "piece"])

        return run

    kind = docs.schema[id_col].dataType.simpleString()
    pieces = vec.map_steps(oversized.select("id", "text", "max_chars", "overlap_chars"), make, f"id {kind}, piece_no int, n_pieces int, start int, piece string")
    return pieces.dropDuplicates(["id", "piece_no"])
