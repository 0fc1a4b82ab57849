"""Problem 1: text that was decoded with a wrong character encoding.

A chain is a pair of codecs: the one the bytes were wrongly decoded with, and the one they were written in. Values in
which no chain finds anything to undo are clean and train a smoothed bigram model of characters. In the others every
stretch that a chain can undo is scored, as it is and as each chain (or two of them in turn) would restore it, within its
context; the likeliest reading is accepted if it gains more than a margin that is set on all clean values. Replacement
characters and the remains of them are reported even where nothing can be restored. Chains without a telling pattern are
tried where the model itself finds a stretch odd.

Nulls and empty values are clean. Values are treated whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec

#: Codecs that text is wrongly decoded with: those of single bytes, and those of one or two.
SINGLE = ("latin-1", "cp1252", "cp1251", "mac_roman", "koi8-r", "cp437", "cp850", "cp1250")
DOUBLE = ("gb18030", "big5", "cp932")
#: Single-byte codecs in which two bytes of UTF-8 alone are telling; in the others ordinary text has such pairs.
TELLING = ("latin-1", "cp1252")
#: Single-byte codecs that text in two-byte codecs is wrongly decoded with.
LATIN = ("latin-1", "cp1252", "mac_roman")
#: Bits of the model's tables; sizes are fixed, whatever the corpus.
BIGRAM_BITS, UNIGRAM_BITS = 20, 16
#: What share of the readings of clean values may gain more than where a margin begins, as chains without a telling
#: pattern leave damaged values among the clean ones, and how much of the damaged stretches a margin may miss.
MARGIN_STRAY, MARGIN_MISS = 0.0001, 0.02
#: Characters of a stretch that is damaged to set the margins, and how many stretches of each clean value are.
MARGIN_LENGTHS, MARGIN_TURNS = (4, 8, 20, 60, 200), 3
#: Tables of gains: bins, and how many of them there are to a factor e of 1 + gain; sizes are fixed, whatever the corpus.
GAIN_BINS, GAIN_STEPS = 1 << 16, 4096
#: Characters that UTF-8 read as Latin-1 or cp1252 begins with.
_LEADS = re.compile("[\u00c2-\u00f4]")
#: Replacement characters, as they are and as UTF-8 read as GBK.
_LOST = re.compile("\ufffd+|(?:锟斤拷)+锟?")
_UTF8 = re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+")
_RIGHT = {
    "utf-8": _UTF8,
    "gb18030": re.compile(rb"(?:[\xa1-\xf7][\xa1-\xfe]){2,}"),
    "big5": re.compile(rb"(?:[\xa1-\xf9][\x40-\x7e\xa1-\xfe]){3,}"),
    "cp1251": re.compile(rb"[\xa8\xb8\xc0-\xff]{3,}"),
    "koi8-r": re.compile(rb"[\xa3\xb3\xc0-\xff]{3,}"),
    "cp866": re.compile(rb"[\x80-\xaf\xe0-\xf1]{3,}"),
}
#: Chains that leave no telling pattern; they are tried where the model finds a stretch odd.
UNTOLD = (("big5", "gb18030"), ("gb18030", "big5"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp866", "koi8-r"), ("koi8-r", "cp866"))
#: An odd stretch: so many of so many neighbouring pairs are rare in clean text.
ODD_PAIRS, ODD_WINDOW = 9, 12
#: The chains (wrong codec, right codec), each with its bit in what suspects() finds.
CHAINS = UNTOLD + tuple([(w, "utf-8") for w in (*SINGLE, *DOUBLE)] + [(w, r) for w in LATIN for r in ("gb18030", "big5", "cp1251", "koi8-r")])
_BIT = {**dict.fromkeys(UNTOLD, 0), **{(w, "utf-8"): 1 << k for k, w in enumerate((*SINGLE, *DOUBLE))}, **{(w, r): 1 << 16 + k for k, w in enumerate(LATIN) for r in ("gb18030", "big5", "cp1251", "koi8-r")}}
MARKED = 1 << 30


@cache
def _encoder(codec: str) -> tuple[np.ndarray, np.ndarray]:
    """For every code point below 65536, its bytes in the codec (high * 256 + low) and their number; 0 where it has none.

    Bytes that a single-byte codec leaves undefined stand for the control character of the same number.
    """
    code, size = np.zeros(65536, np.int32), np.zeros(65536, np.int8)
    if codec not in DOUBLE:
        for b in range(256):
            try:
                c = ord(bytes([b]).decode(codec))
            except UnicodeDecodeError:
                c = b
            if c < 65536 and not size[c]:
                code[c], size[c] = b, 1
        return code, size
    code[:128], size[:128] = np.arange(128), 1
    for high in range(0x81, 0xFF):
        for low in range(0x40, 0xFF):
            try:
                s = bytes([high, low]).decode(codec)
            except UnicodeDecodeError:
                continue
            if len(s) == 1 and ord(s) < 65536 and not size[ord(s)]:
                code[ord(s)], size[ord(s)] = high << 8 | low, 2
    for b in range(0xA1, 0xE0) if codec == "cp932" else ():
        c = ord(bytes([b]).decode(codec))
        code[c], size[c] = b, 1
    return code, size


@cache
def _marks() -> np.ndarray:
    """Characters that only a wrong decoding leaves: the replacement character and the private use area."""
    table = np.zeros(65536, bool)
    table[0xFFFD] = True
    table[0xE000:0xF900] = True
    table[0x80:0xA0] = True
    table[0x85] = False
    return table


def suspects(chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bits of the chains that could undo anything in each value, and MARKED; 0 for clean ones.

    Cheap: table lookups on neighbouring characters, for all values of a batch at once.
    """
    low = np.minimum(chars, 65535).astype(np.int64)
    n = len(low)
    found = np.zeros(len(offsets) - 1, np.int64)
    if not n:
        return found

    def note(hit: np.ndarray, bit: int) -> None:
        at = np.flatnonzero(hit)
        if len(at):
            found[np.searchsorted(offsets, at, "right") - 1] |= bit

    note(_marks()[low], MARKED)
    high = low > 127
    if not high.any():
        return found
    last = np.zeros(n + 1, bool)
    last[offsets[1:]] = True
    last = last[1:]  # the last character of a value: what follows isn't its own

    def shift(x: np.ndarray, k: int) -> np.ndarray:
        for _ in range(k):
            x = np.append(x[1:], False) & ~last
        return x

    for codec in SINGLE:
        code, size = _encoder(codec)
        b = np.where((size[low] == 1) & high, code[low], 0)
        cont = (b >= 0x80) & (b < 0xC0)
        pair = (b >= 0xC2) & (b < 0xE0) & shift(cont, 1)
        triple = (b >= 0xE0) & (b < 0xF5) & shift(cont & shift(cont, 1), 1)
        latin = pair & (b < 0xC4) if codec not in ("cp1251", "koi8-r") else np.zeros(n, bool)  # letters of Latin-1
        note(triple | (pair if codec in TELLING else latin | pair & shift(pair, 2)), _BIT[codec, "utf-8"])
        if codec in LATIN:
            upper = (b >= 0xA1) & ~np.isin(low, [0x2013, 0x2014, 0x2026])
            run = upper & shift(upper, 1)
            note(run & shift(run, 2), _BIT[codec, "gb18030"])
    lead = lambda x: (x >= 0xE0) & (x < 0xF0)
    tail = lambda x: (x >= 0x80) & (x < 0xC0)
    for codec in DOUBLE:
        code, size = _encoder(codec)
        two = size[low] == 2
        a, z = np.where(two, code[low] >> 8, 0), np.where(two, code[low] & 255, 0)
        # three characters are two sequences of UTF-8, in either alignment
        even = lead(a) & tail(z) & shift(tail(a) & lead(z) & shift(tail(a) & tail(z), 1), 1)
        odd = lead(z) & shift(tail(a) & tail(z) & shift(lead(a) & tail(z), 1), 1)
        note(even | odd if codec != "cp932" else (even | odd) & shift(even | odd, 3), _BIT[codec, "utf-8"])
    return found


def _slots(chars: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = chars[:-1].astype(np.uint64) << np.uint64(21) | chars[1:].astype(np.uint64)
        return (vec.mix64(key) >> np.uint64(64 - BIGRAM_BITS)).astype(np.int64)


def _single(chars: np.ndarray) -> np.ndarray:
    return (vec.mix64(chars.astype(np.uint64)) >> np.uint64(64 - UNIGRAM_BITS)).astype(np.int64)


@dataclass
class CharModel:
    """Smoothed bigram probabilities: p(b | a) from hashed counts, backed off to p(b), and that to a floor."""

    pairs: np.ndarray
    singles: np.ndarray
    strength: float = 20.0

    def __post_init__(self):
        total = max(float(self.singles.sum()), 1.0)
        self.base = ((self.singles + 0.01) / (total + 0.01 * len(self.singles))).astype(np.float32)

    def odd(self, chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether each value has a stretch of pairs that are rare in clean text, ASCII pairs aside."""
        n = len(chars) - 1
        if n < ODD_WINDOW:
            return np.zeros(len(offsets) - 1, bool)
        rare = self.pairs[_slots(chars)] <= max(2.0, 1e-6 * float(self.singles.sum()))
        rare &= (chars[:-1] > 127) | (chars[1:] > 127)
        edges = offsets[1:-1]
        rare[edges[(edges > 0) & (edges <= n)] - 1] = False
        total = np.concatenate([[0], np.cumsum(rare)])
        at = np.flatnonzero(total[ODD_WINDOW:] - total[:-ODD_WINDOW] >= ODD_PAIRS)
        out = np.zeros(len(offsets) - 1, bool)
        out[np.searchsorted(offsets, at + ODD_WINDOW // 2, "right") - 1] = True
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log likelihood of each text after its first character, all in one pass."""
        sizes = np.array([len(x) for x in texts], np.int64)
        chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        if len(chars) < 2:
            return np.zeros(len(texts))
        of = _single(chars)
        p = np.log((self.pairs[_slots(chars)] + self.strength * self.base[of[1:]]) / (self.singles[of[:-1]] + self.strength))
        ends = np.cumsum(sizes)
        return vec.segment_sum(p.astype(np.float64), np.stack([ends - sizes, np.maximum(ends - 1, ends - sizes)], 1).reshape(-1))[::2]

    def score(self, text: str) -> float:
        """Log likelihood of the text after its first character."""
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        if len(chars) < 2:
            return 0.0
        of = _single(chars)
        p = (self.pairs[_slots(chars)] + self.strength * self.base[of[1:]]) / (self.singles[of[:-1]] + self.strength)
        return float(np.log(p).sum())


def _summed(values: DataFrame, size: int, count: Callable[[pa.Array, np.ndarray], None]) -> np.ndarray:
    """One table of the size over all values (one string column); count adds those of a step to a task's table."""

    def run(batches):
        table = np.zeros(size, np.int64)
        for batch in batches:
            for part in vec.steps(batch):
                count(part.column(0), table)
        at = np.flatnonzero(table)
        for k in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[k : k + 100_000].astype(np.int32)), pa.array(table[at[k : k + 100_000]])], ["slot", "n"])

    found = values.mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(size, np.int64)
    table[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return table


def count_characters(values: DataFrame) -> CharModel:
    """Trains on all clean values (one string column) of the whole corpus; only tables of a fixed size reach the driver."""

    def count(column: pa.Array, table: np.ndarray) -> None:
        chars, offsets = vec.codepoints(column)
        if not len(chars):
            return
        clean = suspects(chars, offsets) == 0
        # a line feed before and after each value
        row = vec.row_ids(offsets)
        chars = chars[clean[row]]
        size = np.diff(offsets)[clean]
        framed = np.full(int(size.sum()) + len(size) + 1, 10, np.uint32)
        framed[np.arange(len(chars)) + np.repeat(np.arange(len(size)), size) + 1] = chars
        table[: 1 << BIGRAM_BITS] += np.bincount(_slots(framed), minlength=1 << BIGRAM_BITS)
        table[1 << BIGRAM_BITS :] += np.bincount(_single(framed), minlength=1 << UNIGRAM_BITS)

    counts = _summed(values, (1 << BIGRAM_BITS) + (1 << UNIGRAM_BITS), count).astype(np.float32)
    return CharModel(counts[: 1 << BIGRAM_BITS], counts[1 << BIGRAM_BITS :])


@cache
def _beyond(wrong: str) -> np.ndarray:
    """The characters beyond ASCII that a wrong codec of two bytes has; for the others, those that any of them has."""
    table = np.any([_encoder(w)[1] > 0 for w in ([wrong] if wrong in DOUBLE else sorted({w for w, _ in CHAINS} - {*DOUBLE}))], 0)
    table[:128] = False
    return table


def _stretches(data: bytes, right: str, least: int = 1) -> list[tuple[int, int]]:
    """Where the bytes match the pattern of the right codec, in at least so many bytes; for UTF-8 by table, as the pattern is slow."""
    if right != "utf-8" or len(data) < 1000:
        return [m.span() for m in _RIGHT[right].finditer(data) if m.end() - m.start() >= least]
    x = np.frombuffer(data + b"\0\0\0\0", np.uint8)
    tail = (x & 0xC0) == 0x80
    size = np.zeros(len(data), np.int8)
    held = tail[1:-3]
    for n, low, high in ((2, 0xC2, 0xDF), (3, 0xE0, 0xEF), (4, 0xF0, 0xF4)):
        size[(x[:-4] >= low) & (x[:-4] <= high) & held] = n
        held = held & tail[n : len(data) + n]
    at = np.flatnonzero(size)
    ends = at + size[at]
    cut = np.flatnonzero(at[1:] != ends[:-1])  # sequences don't overlap: neighbours that touch are one stretch
    a, b = at[np.append(0, cut + 1)[: len(at)]], ends[np.append(cut, len(at) - 1)[: len(at)]]
    long = b - a >= least
    return list(zip(a[long].tolist(), b[long].tolist(), strict=True))


def _undecoded(chars: np.ndarray, wrong: str) -> tuple[bytes, np.ndarray | None, np.ndarray | None]:
    """The bytes of the characters in the wrong codec (0 for those that it lacks); if it may use two, also where each

    character begins in them and which one holds each byte.
    """
    code, size = _encoder(wrong)
    low = np.minimum(chars, 65535)
    n, code = size[low], code[low]
    if wrong not in DOUBLE:
        return np.where(n == 1, code, 0).astype(np.uint8).tobytes(), None, None
    width = np.maximum(n, 1)
    at = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    two = n == 2
    flat = np.zeros(at[-1], np.uint8)
    flat[at[:-1]] = np.where(two, code >> 8, np.where(n == 1, code & 255, 0))
    flat[at[:-1][two] + 1] = code[two] & 255
    return flat.tobytes(), at, np.repeat(np.arange(len(chars), dtype=np.int32), width)


def _readings(text: str, chars: np.ndarray, wrong: str, right: str) -> list[tuple[int, int, str]]:
    """(start, end, restored) of each stretch of the text that the chain can undo."""
    if not (_encoder(wrong)[1][np.minimum(chars[chars > 127], 65535)] > 0).any():
        return []
    return _restored(*_undecoded(chars, wrong), right)


def _restored(data: bytes, at: np.ndarray | None, owner: np.ndarray | None, right: str) -> list[tuple[int, int, str]]:
    """(start, end, restored) of each stretch of undecoded characters that the right codec reads."""
    out = []
    for a, b in _stretches(data, right, 1 if at is None else 6):
        try:
            restored = data[a:b].decode(right, "strict" if right == "utf-8" else "replace")
            lost = right != "utf-8" and "�" in restored
        except UnicodeDecodeError:
            restored, lost = data[a:b].decode(right, "replace"), True
        if lost and restored.count("�") * 4 > len(restored):
            continue
        if at is None:
            out.append((a, b, restored))
            continue
        first, last = int(owner[a]), int(owner[b - 1]) + 1
        before, after = data[at[first] : a], data[b : at[last]]
        if before and before[0] > 127:  # a character has two bytes at most
            first, before = first + 1, b""
            cut = _UTF8.search(data, int(at[first]), b) if right == "utf-8" else None
            if not cut:
                continue
            before, restored = data[at[first] : cut.start()], data[cut.start() : b].decode(right, "replace")
        if before or after:
            restored = before.decode("ascii", "replace") + restored + after.decode("ascii", "replace")
        out.append((first, last, restored))
    return out


@dataclass(frozen=True)
class Margins:
    """What a reading must gain in log likelihood: in all, or in the mean of a character; nothing may be lost in the other."""

    total: float
    mean: float

    def accept(self, gain: float, mean: float) -> bool:
        return gain > 0 and mean > 0 and (gain > self.total or mean > self.mean)


def best_reading(text: str, model: CharModel, margins: Margins, depth: int = 3, odd: bool = False) -> tuple[str, bool]:
    """The likeliest restoration of the text, and whether any stretch of it was found to be garbled.

    odd: all chains are tried, not only those that left a pattern. A stretch of replacement characters can't be undone:
    it is weighed, as a line, against an empty line, and if that gains beyond the margins, stays and counts as garbled.
    """
    garbled = False
    for _ in range(depth):
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        bits = int(suspects(chars, np.array([0, len(chars)]))[0])
        choices: dict[tuple[int, int], list[str]] = {}
        for wrong, right in CHAINS:
            if not odd and not bits & (_BIT[wrong, right] | MARKED):
                continue
            for a, b, restored in _readings(text, chars, wrong, right):
                more = [restored]
                if _LEADS.search(restored):
                    inner = np.frombuffer(restored.encode("utf-32-le", "surrogatepass"), "<u4")
                    for w in ("cp1252", "latin-1"):
                        again = _splice(restored, _readings(restored, inner, w, "utf-8"))
                        if again != restored:
                            more.append(again)
                choices.setdefault((a, b), []).extend(more)
        if not choices:
            break
        gains = []
        options = [(a, b, o) for (a, b), found in choices.items() for o in dict.fromkeys(found)]
        framed = lambda a, b, x: (text[max(0, a - 1) : a] or "\n") + x + (text[b : b + 1] or "\n")
        stored = dict(zip(choices, model.scores([framed(a, b, text[a:b]) for a, b in choices]), strict=True))
        best: dict[tuple[int, int], tuple[float, float, str]] = {}
        for (a, b, o), now in zip(options, model.scores([framed(*x) for x in options]), strict=True):
            now -= 8.0 * o.count("�")
            own = (now - stored[a, b], now / (len(o) + 1) - stored[a, b] / (b - a + 1), o)
            best[a, b] = max(best.get((a, b), own), own)
        for (a, b), (gain, mean, new) in best.items():
            telling = len(set(new)) > 1 or b - a < 4
            if telling and margins.accept(gain, mean):
                gains.append((gain, a, b, new))
        if not gains:
            break
        garbled = True
        taken: list[tuple[int, int, str]] = []
        for _, a, b, new in sorted(gains, key=lambda g: (-g[0], g[1], g[2])):
            if all(b <= x or a >= y for x, y, _ in taken):
                taken.append((a, b, new))
        text = _splice(text, taken)
    if not garbled:
        for m in _LOST.finditer(text):
            a, b = m.span()
            if margins.accept(*_gain(model, "\n", text[a:b], "", "\n")):
                return text, True
    return text, garbled


def _gain(model: CharModel, left: str, old: str, new: str, after: str) -> tuple[float, float]:
    """What reading new for old gains in log likelihood, in all and in the mean of a character."""
    was, now = model.score(left + old + after), model.score(left + new + after) - 8.0 * new.count("�")
    return now - was, now / (len(new) + 1) - was / (len(old) + 1)


def _splice(text: str, parts: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, new in sorted(parts):
        if a >= at:
            out += [text[at:a], new]
            at = b
    return "".join([*out, text[at:]])


def _gains(model: CharModel, texts: list[str], chains: tuple[tuple[str, str], ...], spans: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """What every reading of the texts by the chains gains, in all and in the mean; with spans only readings within those of their texts.

    The texts are read as one, a line feed before and after each, and of it only what wrong codecs have beyond ASCII, with the
    two characters that follow: no reading holds anything else.
    """
    text = "\n".join(["", *texts, ""])
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    starts = np.cumsum([1, *[len(x) + 1 for x in texts]])
    low = np.minimum(chars, 65535)
    gains, means = [np.zeros(0)], [np.zeros(0)]
    places: dict[str, np.ndarray] = {}
    parts: dict[str, tuple] = {}
    for wrong, right in chains:
        group = wrong if wrong in DOUBLE else ""
        if group not in places:
            own = _beyond(wrong)[low]
            near = own.copy()
            near[1:] |= own[:-1]
            near[2:] |= own[:-2]
            places[group] = np.flatnonzero(near)
        at = places[group]
        if wrong not in parts:
            parts[wrong] = _undecoded(chars[at], wrong)
        found = _restored(*parts[wrong], right)
        if not found:
            continue
        a, b = at[[x[0] for x in found]], at[[x[1] - 1 for x in found]] + 1
        new = [x[2] for x in found]
        if spans is not None:
            of = np.searchsorted(starts, a, "right") - 1
            inside = np.flatnonzero((a - starts[of] >= spans[of, 0]) & (b - starts[of] <= spans[of, 1]))
            a, b, new = a[inside], b[inside], [new[k] for k in inside]
        ends = list(zip(a.tolist(), b.tolist(), strict=True))
        was = model.scores([text[x - 1 : y + 1] for x, y in ends])
        now = model.scores([text[x - 1] + o + text[y] for (x, y), o in zip(ends, new, strict=True)]) - 8.0 * np.array([o.count("�") for o in new])
        gains.append(now - was)
        means.append(now / (np.array([len(o) for o in new]) + 1) - was / (b - a + 1))
    return np.concatenate(gains), np.concatenate(means)


def gain_counts(model: CharModel, clean: list[str]) -> np.ndarray:
    """Tables of the gains, in all and in the mean, of what every chain reads in the clean values as they are (rows 0, 1)

    and of right readings once stretches of them are damaged (rows 2, 3). A hash of the value chooses stretches and chains.
    """
    counts = np.zeros((4, GAIN_BINS), np.int64)

    def note(row: int, found: tuple[np.ndarray, np.ndarray]) -> None:
        for k, x in enumerate(found):
            bins = (np.log1p(np.maximum(x, 0)) * GAIN_STEPS).astype(np.int64)
            counts[row + k] += np.bincount(np.minimum(bins, GAIN_BINS - 1), minlength=GAIN_BINS)

    clean = [x for x in clean if x]
    note(0, _gains(model, clean, CHAINS))
    keys = np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in clean], np.uint64)
    bad: dict[tuple[str, str], list[tuple[str, int, int]]] = {}
    for turn in range(MARGIN_TURNS):
        for text, draw in zip(clean, vec.mix64(keys << np.uint64(8) | np.uint64(turn)).tolist(), strict=True):
            draw, chain = divmod(draw, len(CHAINS))
            draw, length = divmod(draw, len(MARGIN_LENGTHS))
            wrong, right = CHAINS[chain]
            size = min(len(text), MARGIN_LENGTHS[length])
            at = draw % (len(text) - size + 1)
            part = text[at : at + size]
            try:
                new = part.encode(right).decode(wrong)
            except UnicodeError:
                continue
            if new != part:
                bad.setdefault((wrong, right), []).append((text[:at] + new + text[at + size :], at - 2, at + len(new) + 2))
    for chain, damaged in bad.items():
        note(2, _gains(model, [x[0] for x in damaged], (chain,), np.array([x[1:] for x in damaged])))
    return counts


def margins_of(counts: np.ndarray) -> Margins:
    """Margins a third of the way from what readings of clean values gain to what right readings of damaged ones gain.

    A share of MARGIN_STRAY of the former may gain more, one of MARGIN_MISS of the latter less. Gains are those of their bins.
    """

    def quantile(row: np.ndarray, share: float) -> float:
        total = np.cumsum(row)
        return float(np.expm1(np.searchsorted(total, max(share * total[-1], 1)) / GAIN_STEPS)) if total[-1] else 0.0

    least = [quantile(row, 1 - MARGIN_STRAY) for row in counts[:2]]  # 0 at least: what loses is no reading anyway
    most = [quantile(row, MARGIN_MISS) for row in counts[2:]]
    return Margins(*[a + (max(b, a) - a) / 3 for a, b in zip(least, most, strict=True)])


def validated_margins(model: CharModel, clean: list[str]) -> Margins:
    """The margins of clean values at hand."""
    return margins_of(gain_counts(model, clean))


def corpus_margins(values: DataFrame, model: CharModel) -> Margins:
    """The margins of all clean values (one string column) of the whole corpus; only tables of a fixed size reach the driver."""

    def count(column: pa.Array, table: np.ndarray) -> None:
        clean = np.flatnonzero(suspects(*vec.codepoints(column)) == 0)
        table += gain_counts(model, [x for x in column.take(pa.array(clean)).to_pylist() if x]).reshape(-1)

    return margins_of(_summed(values, 4 * GAIN_BINS, count).reshape(4, -1))


def repaired(docs: DataFrame, fields: tuple[str, ...] = ("text", "source"), id_col: str = "id") -> DataFrame:
    """id, field, restored, complete of every garbled value; restored equals the stored value where nothing can be done,

    complete says whether no trace of the damage is left. Rows that arrive again come out as often.
    """
    values = docs.select(F.explode(F.array(*[docs[f] for f in fields])).alias("v")).where("v is not null")
    model = count_characters(values)
    margins = corpus_margins(values, model)

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for k, field in enumerate(fields):
                column = batch.column(k + 1)
                flat = vec.codepoints(column)
                strange = model.odd(*flat)
                at = np.flatnonzero((suspects(*flat) != 0) | strange)
                if not len(at):
                    continue
                marks = _marks()
                for key, text, odd in zip(batch.column(0).take(pa.array(at)).to_pylist(), column.take(pa.array(at)).to_pylist(), strange[at], strict=True):
                    restored, garbled = best_reading(text, model, margins, odd=bool(odd))
                    if garbled:
                        left = np.minimum(np.frombuffer(restored.encode("utf-32-le", "surrogatepass"), "<u4"), 65535)
                        out.append((key, field, restored, not marks[left].any() and "锟斤拷" not in restored))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (batch.schema.field(0).type, pa.string(), pa.string(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["id", "field", "restored", "complete"])

        return run

    kind = docs.schema[id_col].dataType.simpleString()
    return vec.map_steps(docs.select(docs[id_col].alias("id"), *fields), make, f"id {kind}, field string, restored string, complete boolean", fields[0])
