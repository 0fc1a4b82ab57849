"""Problem 8: byte-level BPE encoding of a whole corpus.

Every pre-token is a row of a batch of segment trees over its byte positions. A leaf holds the rank of the pair that
starts at a live position, an inner node the least of its children as rank * width + position, so the root is the
leftmost minimum. A step merges the root's pair in every row at once: three leaves change (the pair itself, the right
member that dies, the live left neighbour), and each change is carried up one path. Pre-tokens seen before in a task
are looked up by their hash; equal ones in a batch are encoded once.

A null or empty text gives an empty list. Strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import os
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import vec

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
#: Unicode's White_Space.
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_NONE = np.int64(1) << 60
_CELLS = 1 << 19
_CACHE_TOKENS = 400_000


@cache
def char_classes() -> np.ndarray:
    """The pre-tokenizer's class of every code point."""
    table = np.full(0x110000, _OTHER, np.uint8)
    everything = np.arange(0x110000, dtype="<u4")
    everything[0xD800:0xE000] = 0
    text = everything.tobytes().decode("utf-32-le")
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, text):
            table[m.start() : m.end()] = kind
    table[_WHITE] = _SPACE
    return table


def pretoken_starts(chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags of the characters at which a pre-token starts. offsets: of the texts."""
    n = len(chars)
    kind = char_classes()[chars]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    first = first[:n]
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    last = np.ones(n, bool)
    last[:-1] = run[1:]
    text_end = np.zeros(n + 1, bool)
    text_end[offsets] = True
    ends_text = text_end[1:]
    space = kind == _SPACE
    start = run.copy()
    # the last white space before other text stands alone, or, as a blank, joins what follows
    tail = space & last & ~ends_text
    start |= tail
    joins = tail & (chars == 32)
    start[1:] &= ~(joins[:-1] & ~first[1:])
    # contractions: an apostrophe alone that no blank joins
    mark = np.flatnonzero((chars == 39) & run & last & start & ~ends_text)
    if len(mark):
        padded = np.concatenate([chars, np.zeros(3, chars.dtype)])
        a, b = padded[mark + 1], padded[mark + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        inside = ~np.concatenate([text_end, [True, True, True]])[mark + 2]
        two = inside & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        size = np.where(one, 1, np.where(two, 2, 0))
        hit, size = mark[size > 0], size[size > 0]
        start[hit + 1] = False
        after = hit + 1 + size
        after = after[after < n]
        start[after] = True
    return start


class Encoder:
    """One vocabulary (token bytes and rank in each line, base64) and the tables for encoding in batches."""

    def __init__(self, path: str = VOCABULARY):
        self.path = path
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        key = (np.array(left, np.uint64) << np.uint64(17)) | np.array(right, np.uint64)
        self._fill(key, np.array(rank, np.int64))
        self._forget()

    def _forget(self) -> None:
        """Empties the cache of pre-tokens."""
        self.known = np.zeros(0, np.uint64)
        self.known_start = np.zeros(0, np.int64)
        self.known_size = np.zeros(0, np.int64)
        self.arena = np.zeros(0, np.int32)

    def _fill(self, key: np.ndarray, rank: np.ndarray) -> None:
        """An open-addressing table of the pairs."""
        bits = 20
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, np.uint64(2**64 - 1)), np.full(1 << bits, _NONE)
        slot, todo = self._slot(key), np.arange(len(key))
        self.probes = 0
        while len(todo):
            self.probes += 1
            at = slot[todo]
            free = self.keys[at] == np.uint64(2**64 - 1)
            self.keys[at[free]] = key[todo[free]]
            placed = self.keys[at] == key[todo]
            self.ranks[at[placed]] = rank[todo[placed]]
            todo = todo[~placed]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.uint64) << np.uint64(17)) | right.astype(np.uint64)
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.ranks[slot], _NONE)
        open_ = np.flatnonzero((found != key) & (found != np.uint64(2**64 - 1)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64(2**64 - 1))]
        return out

    def merge(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the byte strings at start, one after another, and their number in each."""
        counts = np.ones(len(start), np.int64)
        order, parts = [], []
        single = np.flatnonzero(size == 1)
        if len(single):
            order.append(single), parts.append(self.byte_ids[data[start[single]]])
        level = np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)
        for bits in np.unique(level[size > 1]):
            rows = np.flatnonzero((level == bits) & (size > 1))
            step = max(1, _CELLS >> int(bits))
            for at in range(0, len(rows), step):
                own = rows[at : at + step]
                ids, counts[own] = self._trees(data, start[own], size[own], int(bits))
                order.append(own), parts.append(ids)
        if not order:
            return np.zeros(0, np.int32), counts
        order = np.concatenate(order)
        ids = np.concatenate(parts)
        inverse_start = np.zeros(len(start), np.int64)
        inverse_start[order] = np.cumsum(counts[order]) - counts[order]
        return ids[vec.ragged(inverse_start, counts)], counts

    def _trees(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        n, width = len(start), 1 << bits
        column = np.arange(width)
        inside = column[None, :] < size[:, None]
        tokens = np.full((n, width), -1, np.int32)
        tokens[inside] = self.byte_ids[data[vec.ragged(start, size)]]
        following = np.repeat(np.minimum(column + 1, width)[None, :].astype(np.int32), n, 0)
        following[np.arange(n), size - 1] = width
        previous = np.repeat((column - 1)[None, :].astype(np.int32), n, 0)
        tree = np.full((n, 2 * width), _NONE)
        pairs = inside[:, 1:]
        rank = self.pair_ranks(tokens[:, :-1][pairs], tokens[:, 1:][pairs])
        leaves = tree[:, width : 2 * width - 1]
        leaves[pairs] = np.where(rank < _NONE, (rank << bits) | np.broadcast_to(column[:-1], leaves.shape)[pairs], _NONE)
        at = width
        while at > 1:
            tree[:, at // 2 : at] = np.minimum(tree[:, at : 2 * at : 2], tree[:, at + 1 : 2 * at : 2])
            at //= 2
        tokens, following, previous, tree = tokens.reshape(-1), following.reshape(-1), previous.reshape(-1), tree.reshape(-1)
        live = np.arange(n)
        while True:
            root = tree[live * (2 * width) + 1]
            keep = root < _NONE
            if not keep.all():
                live, root = live[keep], root[keep]
            if not len(live):
                break
            pos, rank = root & (width - 1), root >> bits
            row, base = live * width, live * (2 * width) + width
            dead = following[row + pos].astype(np.int64)
            after = following[row + dead].astype(np.int64)
            before = previous[row + pos].astype(np.int64)
            tokens[row + pos] = rank
            tokens[row + dead] = -1
            following[row + pos] = after
            tree[base + dead] = _NONE
            has = after < width
            previous[(row + after)[has]] = pos[has]
            pair = np.full(len(live), _NONE)
            new = self.pair_ranks(rank[has], tokens[(row + after)[has]])
            pair[has] = np.where(new < _NONE, (new << bits) | pos[has], _NONE)
            tree[base + pos] = pair
            had = before >= 0
            new = self.pair_ranks(tokens[(row + before)[had]], rank[had])
            tree[(base + before)[had]] = np.where(new < _NONE, (new << bits) | before[had], _NONE)
            root_of = base - width
            node = np.concatenate([pos, dead, before[had]]) + width
            root_of = np.concatenate([root_of, root_of, root_of[had]])
            for _ in range(bits):
                node >>= 1
                child = root_of + 2 * node
                tree[root_of + node] = np.minimum(tree[child], tree[child + 1])
        alive = tokens >= 0
        return tokens[alive], alive.reshape(n, width).sum(1)

    def encode(self, column: pa.Array) -> pa.ListArray:
        """The ids of each text; an empty list for an empty or null one."""
        data, byte_offsets = vec.utf8_bytes(column)
        rows = len(byte_offsets) - 1
        if not len(data):
            return pa.ListArray.from_arrays(np.zeros(rows + 1, np.int32), pa.array([], pa.int32()))
        lead = (data & 0xC0) != 0x80
        at_byte = np.flatnonzero(lead)
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        offsets = np.searchsorted(at_byte, byte_offsets)
        start = at_byte[pretoken_starts(chars, offsets)]
        size = np.diff(np.append(start, len(data)))
        with np.errstate(over="ignore"):
            forth, back = _powers(len(data))
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_BYTE_HASH[data] * forth[: len(data)], out=total[1:])
            key = vec.mix64((total[start + size] - total[start]) * back[start] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        if len(self.known) > _CACHE_TOKENS:
            self._forget()
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        at[at == len(self.known)] = 0
        new = np.ones(len(distinct), bool) if not len(self.known) else self.known[at] != distinct
        if new.any():
            self._learn(distinct[new], *self.merge(data, start[first[new]], size[first[new]]))
        at = np.searchsorted(self.known, distinct)
        token_start, token_size = self.known_start[at][which], self.known_size[at][which]
        ids = self.arena[vec.ragged(token_start, token_size)]
        ends = np.concatenate([[0], np.cumsum(token_size)])
        return pa.ListArray.from_arrays(pa.array(ends[np.searchsorted(start, byte_offsets)].astype(np.int32)), pa.array(ids, pa.int32()))

    def _learn(self, keys: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        starts = len(self.arena) + np.cumsum(counts) - counts
        self.arena = np.concatenate([self.arena, ids])
        known = np.concatenate([self.known, keys])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.known_start = np.concatenate([self.known_start, starts])[order]
        self.known_size = np.concatenate([self.known_size, counts])[order]


_BYTE_HASH = vec.mix64(np.arange(1, 257, dtype=np.uint64))
_MULTIPLIER = 0x2545F4914F6CDD1D


@cache
def _power_table(bits: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        n = 1 << bits
        out = []
        for m in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            x = np.full(n, np.uint64(m))
            x[0] = 1
            out.append(np.cumprod(x, dtype=np.uint64))
        return out[0], out[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _power_table(max(21, int(n).bit_length()))


@cache
def encoder(path: str) -> Encoder:
    """One encoder in each Python worker."""
    return Encoder(os.fspath(path))


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """key and ids of each row of df: the token ids of its text, [] for an empty or null text. Other columns are left out.

    Rows stay where they are: nothing is shuffled, and no text is cut.
    """

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), encoder(path).encode(batch.column(1))], ["key", "ids"])

        return run

    kind = df.schema[key].dataType.simpleString()
    return vec.map_steps(df.select(df[key].alias("key"), df[text].alias("text")), make, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def count_tokens(df: DataFrame, text: str = "text", path: str = VOCABULARY, *keys: str) -> DataFrame:
    """The columns keys of df, and n_tokens of its text; 0 for an empty or null text."""

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = encoder(path).encode(batch.column(batch.num_columns - 1))
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], ids.value_lengths().cast(pa.int64())], [*keys, "n_tokens"])

        return run

    fields = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return vec.map_steps(df.select(*keys, df[text].alias("__text")), make, f"{fields}, n_tokens bigint", "__text")
