"""Batch primitives shared by the operators: Arrow text to flat code-point arrays, window hashes, ragged gathers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import shared_dir  # noqa: F401  for the operators

#: Characters that one vectorised step works on; bounds a Python worker's memory, whatever the batch holds.
STEP_CHARS = 400_000


def steps(batch: pa.RecordBatch, column: str | int = 0, limit: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` characters each (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64) + 16)
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit * 2, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_steps(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, column: str = "text") -> DataFrame:
    """``mapInArrow`` whose function sees bounded slices; ``make`` runs once in each task and may load a model."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            fn = fn or make()
            for part in steps(batch, column):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def codepoints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All characters of a string column as one uint32 array, and the row offsets in it; nulls count as empty."""
    column = pc.fill_null(column, "")
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return np.frombuffer("".join(column.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4"), offsets


def utf8_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one uint8 array, and the row offsets in it; nulls count as empty."""
    raw = [x.encode() if x else b"" for x in column.to_pylist()]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)), out=offsets[1:])
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def row_ids(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0]..starts[0]+lengths[0]-1, starts[1].., one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1


def window_hashes(chars: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` characters (polynomial by doubling, then finalised); len - width + 1 of them."""
    if len(chars) < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power, size = mix64(chars.astype(np.uint64) + np.uint64(0x1234567)), 1
        done, done_size, rest = None, 0, width
        while rest:
            if rest & 1:
                if done is None:
                    done, done_size = power, size
                else:
                    n = len(chars) - done_size - size + 1
                    done = done[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + power[done_size : done_size + n]
                    done_size += size
            rest >>= 1
            if rest:
                n = len(chars) - 2 * size + 1
                power = power[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + power[size : size + n]
                size *= 2
        return mix64(done)


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values; len - width + 1 of them."""
    size, least = 1, x
    while size * 2 <= width:
        n = len(least) - size
        least = np.minimum(least[:n], least[size : size + n])
        size *= 2
    if size < width:
        n = len(x) - width + 1
        least = np.minimum(least[:n], least[width - size : width - size + n])
    return least


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between offsets; 0 for empty segments."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


#: Rows that a task holds at most to settle groups, and rows of one group that it sends to one place at most.
SETTLE_ROWS, GROUP_ROWS = 1_500_000, 256


def shared_by_two(rows: DataFrame, group: str, member: str, mark: str | None = None) -> DataFrame:
    """The rows (of long and int columns) whose group has two members or more, wherever they are.

    Rows of a group meet in one place, found by one shuffle. Of a hot group, one with more than GROUP_ROWS rows and two
    members in a task, the task already knows that it is shared: its rows are spread by a salt, and those of its least
    and greatest member go to the meeting place once more as witnesses. So GROUP_ROWS rows of a group come from a task
    at most. (A long task does so for each SETTLE_ROWS rows.) ``mark`` names a column that says which groups are hot.
    """
    names = rows.columns

    def settle(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        g, m = table.column(group).to_numpy(), table.column(member).to_numpy()
        salt = np.zeros(len(g), np.int8)
        order = np.argsort(g, kind="stable")
        gs = g[order]
        start = np.flatnonzero(np.concatenate([[True], gs[1:] != gs[:-1]]))
        sizes = np.diff(np.append(start, len(gs)))
        witness = []
        for at, n in zip(start[sizes > GROUP_ROWS], sizes[sizes > GROUP_ROWS], strict=True):
            own = order[at : at + n]
            low, high = own[np.argmin(m[own])], own[np.argmax(m[own])]
            if m[low] < m[high]:
                salt[own] = 1 + mix64(own.astype(np.uint64)) % np.uint64(120)
                witness += [low, high]
        for at, where in ((None, salt), (np.array(witness, np.int64), np.full(len(witness), -1, np.int8))):
            part = table if at is None else table.take(pa.array(at))
            yield from part.append_column("__salt", pa.array(where)).to_batches(max_chunksize=50_000)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n > SETTLE_ROWS:
                yield from settle(held)
                held, n = [], 0
        if held:
            yield from settle(held)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    marked = rows.mapInArrow(run, f"{fields}, __salt tinyint").withColumn("__part", F.greatest("__salt", F.lit(0).cast("tinyint")))
    whole = Window.partitionBy(group, "__part")  # a column of its own: over an expression each function would get a window, and an exchange, to itself
    met = marked.withColumns({"__low": F.min(member).over(whole), "__high": F.max(member).over(whole), "__witness": F.min("__salt").over(whole)})
    hot = [(F.col("__witness") != 0).alias(mark)] if mark else []
    return met.where("__salt > 0 or (__salt = 0 and __low < __high)").select(*names, *hot)


def fresh_rows(seen: set[int], values: Iterable[int], most: int = 500_000) -> pa.Array:
    """The places of values not seen before; what is remembered is bounded, so that a long task may take a value again."""
    if len(seen) > most:
        seen.clear()
    out = []
    for k, v in enumerate(values):
        if v not in seen:
            seen.add(v)
            out.append(k)
    return pa.array(out, pa.int32())


#: Members of a group that one task pairs with each other at most.
PAIR_ROWS = 500


def pairs_of(rows: DataFrame, keys: list[str], member: str, other: str) -> DataFrame:
    """keys, member < other of each two of a group's rows. The rows of a group beyond PAIR_ROWS are cut into parts, each

    of which meets all rows of the group in a place of its own: no pair is lost, and no task makes all pairs of a group.
    """
    hot = rows.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > PAIR_ROWS).select(*keys, F.ceil(F.col("__n") / PAIR_ROWS).cast("int").alias("__parts"))
    split = rows.select(*keys, member).join(hot, keys, "left").withColumn("__parts", F.coalesce("__parts", F.lit(1)))
    left = split.select(*keys, member, F.pmod(F.xxhash64(member), F.col("__parts")).cast("int").alias("__part"))
    right = split.select(*keys, F.col(member).alias(other), F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"))
    return left.join(right, [*keys, "__part"]).where(F.col(member) < F.col(other)).drop("__part")
