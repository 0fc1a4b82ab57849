"""Problem 3: noise in text from scanned pages.

Lines are told apart first: page numbers by their form, running headers by their form and by being repeated in their
source once misreadings are evened out. What is left is running text, one character stream for each chunk. Word counts
and counts of three characters in a row, over all chunks, and the confusions learned from them (rare forms that differ in
one character from a far more frequent one, always the same two characters) decode the stream: words may be joined over
a hyphen, split, merged or read with a confusion, whatever is likeliest. Paragraph boundaries are chosen by dynamic
programming over the lines.

Null and blank texts give nothing; a null page_start only drops the comparison with expected page numbers.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vec

#: Bits of the hashed count tables, which bound what is broadcast.
WORD_BITS, GRAM_BITS = 22, 22
#: A form is rare beside another that is this many times as frequent.
RATIO = 15
#: Counts that decide beside RATIO are shares: a count below is that of a corpus of so many words (threes of characters),
#: and grows with the corpus. In a smaller one it stays, as fewer occurrences would tell nothing.
WORDS_OF_COUNTS, THREES_OF_COUNTS = 224_000, 832_000
#: Costs, in natural logs: what a reading must gain, a split and each letter that it saves spelling, a reading that is barred.
LEAST_GAIN, SPLIT, SPELLED, BARRED = 1e-3, 5.5, 0.5, 1e3
#: What a changed character other than in words must gain: RATIO against a form seen once.
SIGN_GAIN = float(np.log((RATIO + 1) / 2)) - LEAST_GAIN
KINDS = ("hyphen", "misread", "header", "page_number")
HYPHENS = "-¬­‐‑‒⁃﹣－"
_BLOCKS = "■□▪▫▯�●◆＊〓"
_D = r"[0-9０-９OoIl!SBZz|]"
_EDGE = r"[\s\-—–―·•.\[\]［］()（）|~_*＊<>《》〈〉]*"
_PAGE = re.compile(rf"{_EDGE}(?:(?:p|pp|page|pg|第|页码|- ?)\s*[.．:：]?\s*)?({_D}{{1,4}})\s*(?:页|頁)?(?:\s*(?:of|/|／|共)\s*{_D}{{1,4}}\s*(?:页|頁)?)?{_EDGE}", re.I)
_ROMAN = re.compile(rf"{_EDGE}[ivxlc]{{1,6}}{_EDGE}")
_STOPS = re.compile(r"[。！？；，、]|[,;]\s|[.!?][”\"’]?\s|[.]$")
_ISSUE = re.compile(r"\bvol\b|\bno\.\s*\d|quarterly|journal|bulletin|papers\s+[\dOolIS]+/|review\s*$|第\s*[\dOolI]+\s*[卷期]|总第|年第|卷第", re.I)
_SPACED = re.compile(r"^(?:[一-鿿][ 　]){2,}[一-鿿]$")
_CELLS = re.compile(r"(?:\s{2,}|\t)[\dOolISB.,%]+")
_SAME = str.maketrans({"0": "o", "1": "l", "!": "l", "i": "l", "|": "l", "5": "s", "8": "b", "c": "e", "f": "t", "g": "q", "6": "b", "3": "s", "2": "z", "u": "n", "v": "y", "h": "b", "9": "q", "入": "人", "己": "已", "末": "未", "曰": "日", "士": "土", "千": "干", "カ": "力"})
#: Runs of characters that are misread for each other beside single ones.
_RUNS = (("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("vv", "w"), ("w", "vv"), ("li", "h"), ("ii", "u"), ("nn", "m"), ("ri", "n"), ("lc", "k"), ("tl", "d"))
_SINGLE = {"0": "oO", "1": "lIit", "!": "il", "|": "lI", "5": "sS", "8": "BS", "6": "b", "3": "B", "9": "g", "2": "zZ", "$": "s", "@": "a", "4": "A", "7": "T", "c": "e", "f": "t", "b": "h"}


def is_page_number(line: str, first: int | None, last: int | None) -> bool:
    """Nothing but a page number. A bare number must be near the pages of the chunk, where those are known."""
    text = line.strip()
    m = _PAGE.fullmatch(text)
    if not m or not re.search(r"[0-9０-９]", text):
        return False
    digits = re.sub(r"\D", "", m.group(1).translate(str.maketrans("OoIlSB", "001158")))
    if re.fullmatch(r"\S*", text) and re.fullmatch(r"[0-9０-９]+\.?", text) and first is not None and digits:
        return first - 2 <= int(digits) <= (last if last is not None else first + 10) + 2
    return True


def edge_numbers(text: str) -> tuple[str, list[str]]:
    """The line without a page number set apart at its start or end, and those numbers."""
    numbers = []
    m = re.match(rf"\s*({_D}{{1,4}})(?:\s{{2,}}|　+|\t)(?=\S)", text)
    if m and re.search(r"\d", m.group(1)):
        numbers.append(m.group(1))
        text = text[m.end() :]
    m = re.search(rf"(?:\s{{2,}}|　+|\t)({_D}{{1,4}})\s*$", text)
    if m and re.search(r"\d", m.group(1)):
        numbers.append(m.group(1))
        text = text[: m.start()]
    return text.strip(), numbers


def template(line: str) -> str | None:
    """The line as a running header would repeat it, evened out for misreadings; None for what can't be one."""
    text, _ = edge_numbers(line)
    if not 3 <= len(text) <= 90 or _STOPS.search(text) or text[-1] in HYPHENS or len(_CELLS.findall(line)) >= 2:
        return None
    if text[-1] in ".:：,，" or text.count("，") or re.search(r"[¬­]", text):
        return None
    plain = re.sub(r"\s+", "", text.lower().translate(_SAME)).replace("rn", "m")
    return plain or None


def header_form(line: str) -> bool:
    """The look of a running header: volume and issue, capitals, spaced letters, a title with its page number."""
    text, numbers = edge_numbers(line)
    if template(line) is None:
        return bool(_ISSUE.search(text)) and len(text) < 90 and not re.search(r"[。；]", text) and text[-1:] not in HYPHENS and text[:1].upper() == text[:1] and bool(re.search(r"vol|no\.|第|总第", text, re.I)) and not re.search(r"\b(?:the|was|were|had)\b", text)
    letters = re.sub(r"[^A-Za-z]", "", text)
    capitals = len(letters) >= 6 and sum(c.isupper() for c in letters) >= 0.85 * len(letters)
    words = re.findall(r"[A-Za-z0-9!|’'-]{2,}", text)
    titled = len(words) >= 3 and sum(w[0].isupper() for w in words if len(w) > 3) == sum(len(w) > 3 for w in words) and len(letters) > 0.6 * len(text)
    return bool(_ISSUE.search(text)) or capitals or bool(_SPACED.match(text)) or bool(numbers) and len(text) < 70 and (titled or not letters)


def classify_lines(text: str, first: int | None, last: int | None, repeated: set[int]) -> list[str]:
    """'blank', 'page_number', 'header' or 'text' of each line. repeated: the lines whose template recurs in the source."""
    lines = text.split("\n")
    kinds = []
    for k, line in enumerate(lines):
        if not line.strip():
            kinds.append("blank")
        elif is_page_number(line, first, last):
            kinds.append("page_number")
        elif header_form(line):
            kinds.append("header")
        else:
            kinds.append("maybe" if k in repeated else "text")
    for k, kind in enumerate(kinds):
        if kind != "maybe":
            continue
        beside = any(kinds[j] in ("page_number", "header") for j in (k - 1, k + 1) if 0 <= j < len(kinds))
        stripped, numbers = edge_numbers(lines[k])
        after = next((lines[j] for j in range(k - 1, -1, -1) if kinds[j] == "text"), "")
        continues = bool(after) and not after.rstrip().endswith(tuple("。.！？!?”"))
        kinds[k] = "header" if beside or numbers or continues or k in (0, len(lines) - 1) else "text"
    return kinds


@dataclass(frozen=True)
class Stream:
    """Running text of a chunk without its line ends; line[i] is the line of character i. joins: hyphens at line ends

    (line, left part, right part or "", mark, position in text); only those with a right part are left out of the text."""

    text: str
    line: np.ndarray
    joins: list


_WIDE = re.compile(r"[一-鿿　-〿＀-￯]")


def de_lined(lines: list[str], kinds: list[str]) -> Stream:
    out, where, joins = [], [], []
    rows = [k for k, kind in enumerate(kinds) if kind == "text"]
    for n, k in enumerate(rows):
        line = lines[k].strip()
        following = lines[rows[n + 1]].strip() if n + 1 < len(rows) else ""
        m = re.search(rf"([A-Za-zÀ-ÿ0-9!|’']+(?:-[A-Za-zÀ-ÿ0-9!|]+)*)([{HYPHENS}])$", line)
        rest = re.match(r"[A-Za-zÀ-ÿ0-9!|’']+", following)
        if m and re.search(r"[A-Za-zÀ-ÿ]", m.group(1)[-2:]) and (rest or not following):
            right = rest.group(0) if rest else ""
            joins.append((k, m.group(1), right, m.group(2), len(where) + m.end(1)))
            keep = m.group(1) + m.group(2) if not right else m.group(1)
            line = line[: m.start()] + keep
            glue = "" if right else ""
        elif following and _WIDE.match(following) or line and _WIDE.match(line[-1]):
            glue = ""
        elif following and _WIDE.search(line) and _WIDE.search(following) and (line[-1].isdigit() or following[0].isdigit()):
            glue = ""
        else:
            glue = " " if following else ""
        out.append(line + glue)
        where += [k] * (len(line) + len(glue))
    return Stream("".join(out), np.array(where, np.int32), joins)


_TOKEN = re.compile(r"[A-Za-zÀ-ÿ0-9!|$@]*[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ0-9!|$@]*(?:[’'-][A-Za-zÀ-ÿ0-9!|$@]*[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ0-9!|$@]*)*")

_NUMBER = re.compile(r"(?<![A-Za-zÀ-ÿ0-9!|$@])[0-9]+(?![A-Za-zÀ-ÿ0-9!|$@])")


def _word_slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) >> 32 - WORD_BITS


def _gram_slots(chars: np.ndarray) -> np.ndarray:
    return (vec.window_hashes(chars, 3) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


def _points(text: str) -> np.ndarray:
    """Code points with digits evened out."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").copy()
    x[(x >= 48) & (x <= 57)] = 48
    return x


@dataclass
class Model:
    """Hashed counts of words and of three characters, and the readings of a character: {seen: those it may stand for}.

    numbers: how many of the words are numbers, which don't count for the size of the corpus."""

    words: np.ndarray
    grams: np.ndarray
    latin: dict[str, str]
    cjk: dict[str, str]
    numbers: int = 0

    def count(self, word: str) -> int:
        return _count(self, word)

    @cached_property
    def size(self) -> int:
        return max(int(self.words.sum(dtype=np.int64)) - self.numbers, 1)

    @cached_property
    def scale(self) -> float:
        """What a count of words that decides is multiplied by."""
        return max(self.size / WORDS_OF_COUNTS, 1.0)

    @cached_property
    def sign_scale(self) -> float:
        return max(int(self.grams.sum(dtype=np.int64)) / THREES_OF_COUNTS, 1.0)

    def cost(self, word: str, least: float = 1.0) -> float:
        """Negative log of the word's share of the corpus; one never seen counts as seen ``least`` times."""
        return float(np.log(self.size) - np.log(max(self.count(word), least)))

    def variants(self, word: str) -> list[str]:
        """The words that this one may be a misreading of."""
        out = []
        for i, c in enumerate(word):
            for y in dict.fromkeys(_SINGLE.get(c, "") + self.latin.get(c, "") + (self.latin.get(c.lower(), "").upper() if c.isupper() else "")):
                out.append(word[:i] + y + word[i + 1 :])
        for a, b in _RUNS:
            at = word.find(a)
            while at >= 0:
                out.append(word[:at] + b + word[at + len(a) :])
                at = word.find(a, at + 1)
        return out

    def edges(self, word: str) -> tuple[tuple[float, str, bool], ...]:
        """(cost, text, misread) of the word as it stands, first, and of its readings."""
        return _edges(self, word)

    def __hash__(self):
        return id(self)

    def __eq__(self, other):
        return self is other


@lru_cache(maxsize=200_000)
def _count(model: Model, word: str) -> int:
    return int(model.words[_word_slot(word)])


@lru_cache(maxsize=200_000)
def _edges(model: Model, word: str) -> tuple[tuple[float, str, bool], ...]:
    stands = model.cost(word)
    plain = ((stands, word, False),)
    if len(word) < 3 and not re.search(r"\d", word):
        return plain
    if re.fullmatch(r"\d+(?:st|nd|rd|th|s|er|e|e?me|mm|km|kg|m|cm|h)?", word):
        return plain
    if re.fullmatch(r"[0-9OolI|!SsBZz]+", word) and re.search(r"\d", word):
        number = word.translate(str.maketrans("OolI|!SsBZz", "00111155822"))
        if model.count(word) >= 20 * model.scale and model.count(word) * RATIO > model.count(number):
            return plain
        return (*plain, (stands - LEAST_GAIN, number, True))
    own = max(model.count(word), 1)
    strange = bool(re.search(r"[A-Za-zÀ-ÿ][0-9!|$@]|[0-9|$@][A-Za-zÀ-ÿ]{2}", word))
    change = 0.0 if strange else float(np.log(6 if word[0].isupper() else RATIO))
    first = model.variants(word)
    found = {v for v in first if not re.search(r"[0-9!|$@]", v) and model.count(v)}
    if strange and not found:
        found = {u for v in first for u in model.variants(v) if not re.search(r"[0-9!|$@]", u) and model.count(u)}
    out = [(model.cost(v) + change - LEAST_GAIN, v, True) for v in sorted(found)]
    if "-" in word and not found:
        gain, parts = 0.0, []
        for part in word.split("-"):
            own_edges = model.edges(part)
            low = min(own_edges)
            gain += own_edges[0][0] - low[0]
            parts.append(low[1])
        if gain:
            out.append((stands - gain, "-".join(parts), True))
    if strange and len(re.findall(r"[A-Za-zÀ-ÿ]", word)) >= 4 and not word[0].isdigit() and own <= 3 * model.scale:
        out.append((stands - LEAST_GAIN, min(out)[1] if out else word, True))
    return (*plain, *out)


@dataclass(frozen=True)
class Step:
    """An edge of a best path: stream[start:end] stands for text. joins: hyphens at line ends that it takes for a cut."""

    start: int
    end: int
    text: str
    misread: bool = False
    joins: tuple[int, ...] = ()


def _half(model: Model, word: str) -> tuple[float, str, bool]:
    """The cheapest edge of a half of a split word."""
    return min(model.edges(word)) if len(word) >= 3 else model.edges(word)[0]


def _splits(word: str, start: int, model: Model):
    """(cost, steps) of the word as two words that were run together, each as it is or misread."""
    if len(word) < 5 or not word.isalpha() or model.count(word) > 3 * model.scale:
        return
    for i in range(2, len(word) - 1):
        if max(model.count(word[:i]), model.count(word[i:])) <= 20 * model.scale:
            continue
        left, right = _half(model, word[:i]), _half(model, word[i:])
        if min(model.count(left[1]), model.count(right[1])) > 20 * model.scale:
            at = start + i
            yield left[0] + right[0] + SPLIT - SPELLED * len(word), (Step(start, at, left[1], left[2]), Step(at, at, " "), Step(at, start + len(word), right[1], right[2]))


def _hyphen_edges(word: str, start: int, n: int, join: tuple, model: Model):
    """(cost, steps) of a word over a line's end: joined (a cut, in every reading or split), or a compound."""
    _, left, right, mark, at = join
    i = at - start
    tail = left.rsplit("-", 1)[-1]
    joined, compound, known = model.count(tail + right), model.count(f"{left}-{right}"), (model.count(tail), model.count(right))
    base, cut = float(np.log(model.size)), (n,)
    as_joined = base - np.log(max(joined, 0.5 * model.scale))
    inner = model.edges(word)
    for cost, text, misread in inner:
        yield as_joined + (cost - inner[0][0] - (np.log(2.0) if misread and not joined else 0.0)), (Step(start, start + len(word), text, misread, cut),)
    for cost, steps in _splits(word, start, model):
        yield as_joined + (cost - inner[0][0]), (*steps[:-1], Step(steps[-1].start, steps[-1].end, steps[-1].text, steps[-1].misread, cut))
    for cost, text, misread in model.edges(f"{left}-{right}")[1:]:
        if "-" in text and model.count(text) and word == left + right:
            yield cost, (Step(start, start + len(word), text, misread),)
    if compound:
        whole = base - np.log(compound) - LEAST_GAIN + (0.0 if compound >= 2 * model.scale or min(known) >= model.scale else 1.5)
    elif not joined and mark in "-‐‑" and min(known) >= 3 * model.scale and min(len(tail), len(right)) > 2:
        whole = base - np.log(model.scale) + 0.5
    else:
        return
    a, b = model.edges(word[:i]), model.edges(word[i:])
    for x in a:
        for y in b:
            yield whole + (x[0] - a[0][0]) + (y[0] - b[0][0]), (Step(start, at, x[1], x[2]), Step(at, at, "-"), Step(at, start + len(word), y[1], y[2]))


def _word_path(stream: Stream, model: Model) -> list[Step]:
    """The cheapest path over the words of a stream (Viterbi). Its nodes are the gaps between words; an edge takes a word

    as it is, misread, split in two, or, over a line's end, joined or as a compound, or takes two words as one that was
    broken. The steps that change something come out.
    """
    text = stream.text
    words = []
    for m in _TOKEN.finditer(text):
        word = m.group(0).rstrip("!|")
        words.append((m.start(), m.start() + len(word), word))
    hyphens = sorted((j[4], n) for n, j in enumerate(stream.joins) if j[2])
    best: list[tuple[float, int, tuple[Step, ...]]] = [(0.0, 0, ())] + [(np.inf, 0, ())] * len(words)

    def relax(k: int, to: int, cost: float, steps: tuple[Step, ...]) -> None:
        if best[k][0] + cost < best[to][0]:
            best[to] = (best[k][0] + cost, k, steps)

    h = 0
    over = []
    for a, b, _ in words:
        while h < len(hyphens) and hyphens[h][0] <= a:
            h += 1
        over.append([n for at, n in hyphens[h:] if at < b] if h < len(hyphens) and hyphens[h][0] < b else [])
    for k, (a, b, word) in enumerate(words):
        if len(over[k]) == 1:
            for cost, steps in _hyphen_edges(word, a, over[k][0], stream.joins[over[k][0]], model):
                relax(k, k + 1, cost, steps)
        else:
            for cost, one, misread in model.edges(word):
                relax(k, k + 1, cost, (Step(a, b, one, misread, tuple(over[k])),) if misread or over[k] else ())
            for cost, steps in _splits(word, a, model):
                relax(k, k + 1, cost, steps)
        if k + 1 == len(words) or over[k] or over[k + 1] or text[b : words[k + 1][0]] != " ":
            continue
        c, d, second = words[k + 1]
        both, counts = word + second, (model.count(word), model.count(second))
        if len(both) >= 5 and model.count(both) >= RATIO * max(min(counts), 1):
            relax(k, k + 2, model.cost(both) + np.log(RATIO), (Step(b, c, ""),))
        if len(both) >= 6 and max(counts) <= 3 * model.scale:
            for cost, one, misread in model.edges(both)[1:]:
                if model.count(one) >= RATIO * max(*counts, 1):
                    relax(k, k + 2, cost + np.log(RATIO), (Step(a, d, one, misread),))
    out: list[Step] = []
    k = len(words)
    while k:
        _, k, steps = best[k]
        out += steps[::-1]
    return out[::-1]


def _worthwhile(text: str, options: dict[int, list[str]], forced: set[int], model: Model) -> dict[int, list[str]]:
    """The options without the readings that are in no three which gains: a change costs, so none of these is on the cheapest path.

    The threes of all choices are counted in one step. Places that can't stand as they are keep all their readings.
    """
    n = len(text)
    places = np.array(sorted(options))
    chars = _points(text)
    sizes, row = np.ones(n, np.int64), np.full(n, -1)
    row[places] = np.arange(len(places))
    sizes[places] = [len(options[i]) for i in places.tolist()]
    table = np.zeros((len(places), int(sizes.max())), np.uint32)
    table[np.arange(table.shape[1]) < sizes[places][:, None]] = _points("".join(chain.from_iterable(options[i] for i in places.tolist())))
    at = np.unique(np.concatenate([places, places + 1, places + 2]))
    at = at[(at >= 2) & (at < n)]
    if not len(at):
        return {i: options[i] for i in options if i in forced}
    every = sizes[at - 2] * sizes[at - 1] * sizes[at]
    i = np.repeat(at, every)
    r = np.arange(len(i)) - np.repeat(np.cumsum(every) - every, every)
    choice = np.column_stack([r // (sizes[i] * sizes[i - 1]), r // sizes[i] % sizes[i - 1], r % sizes[i]])
    place = np.column_stack([i - 2, i - 1, i])
    signs = np.where(row[place] >= 0, table[np.maximum(row[place], 0), choice], chars[place])
    count = model.grams[_gram_slots(np.ascontiguousarray(signs).reshape(-1))[::3]]
    stored = model.grams[_gram_slots(chars)][i - 2]
    gaining = (count >= 6 * model.sign_scale) & (count >= RATIO * stored) & (signs != chars[place]).any(1)
    kept: dict[int, list[str]] = {j: options[j] for j in options if j in forced}
    found = {(j, c) for j, c in zip(place[gaining].ravel().tolist(), choice[gaining].ravel().tolist(), strict=True) if c and j in options and j not in forced}
    for j, c in sorted(found):
        kept.setdefault(j, [text[j]]).append(options[j][c])
    return kept


_KANA = re.compile(r"[ぁ-ヿ]")


def _sign_path(text: str, model: Model) -> list[Step]:
    """The cheapest path over the other characters (Viterbi); a node is a place with the last two characters as read.

    Each three characters that a reading changes cost what their counts say: they gain where they become RATIO times as
    frequent, and a reading is barred that makes frequent ones rare. Blocks and lone kana can't stand as they are.
    """
    n = len(text)
    forced = {i for i, c in enumerate(text) if c in _BLOCKS}
    for m in _KANA.finditer(text):
        i = m.start()
        if 0 < i < n - 1 and n >= 5 and ("一" <= text[i - 1] <= "鿿" or "一" <= text[i + 1] <= "鿿") and text[i] not in "・ー":
            forced.add(i)
    options = {i: (["?"] if c in _BLOCKS else list(model.cjk.get(c, "?"))) if i in forced else [c, *model.cjk[c]] for i, c in enumerate(text) if i in forced or n >= 5 and c in model.cjk}
    options = _worthwhile(text, options, forced, model) if options else {}
    if not options:
        return []
    # the counts of all threes that any choice can make, in one step
    threes: list[tuple[int, tuple[str, str, str]]] = []
    for i in sorted({j for at in options for j in (at, at + 1, at + 2) if 2 <= j < n}):
        threes += [(i, t) for t in product(*(options.get(j, [text[j]]) for j in (i - 2, i - 1, i)))]
    costs: dict[tuple[int, tuple[str, str, str]], float] = {}
    if threes:
        count = model.grams[_gram_slots(_points("".join("".join(t) for _, t in threes)))[::3]]
        stored = {i: int(c) for (i, t), c in zip(threes, count, strict=True) if "".join(t) == text[i - 2 : i + 1]}
        if lacking := [i for i in {i for i, _ in threes} if i not in stored]:  # those with a place that can't stand
            stored |= dict(zip(lacking, map(int, model.grams[_gram_slots(_points("".join(text[i - 2 : i + 1] for i in lacking)))[::3]]), strict=True))
        counted = {key: int(c) for key, c in zip(threes, count, strict=True)}
        for (i, t), new in counted.items():
            old = tuple(text[i - 2 : i + 1])
            if t == old:
                continue
            fewer = (counted.get((i, u), 0) for u in product(*({x, y} for x, y in zip(t, old, strict=True))) if u != t)
            now = max(stored[i], *fewer)  # with a part of the changes, too, so that each has to pay
            if now >= 4 * model.sign_scale and now * 4 > new:
                costs[i, t] = BARRED
            elif new >= 6 * model.sign_scale and new >= RATIO * now:
                costs[i, t] = -float(np.log((new + 1) / (stored[i] + 1)))
    out: list[Step] = []
    places = sorted(options)
    k = 0
    while k < len(places):
        last = k
        while last + 1 < len(places) and places[last + 1] - places[last] <= 2:
            last += 1
        low, high = places[k], min(places[last] + 3, n)
        nodes: dict[tuple[str, str], tuple[float, str]] = {(text[low - 2 : low - 1] if low > 1 else "", text[low - 1 : low] if low else ""): (0.0, "")}
        for i in range(low, high):
            after: dict[tuple[str, str], tuple[float, str]] = {}
            for (x, y), (cost, path) in nodes.items():
                for z in options.get(i, [text[i]]):
                    total = cost + costs.get((i, (x, y, z)), 0.0) + (SIGN_GAIN if z != text[i] else 0.0)
                    if (y, z) not in after or total < after[y, z][0]:
                        after[y, z] = (total, path + z)
            nodes = after
        _, path = min(nodes.values(), key=lambda v: v[0])
        out += [Step(i, i + 1, z, True) for i, z in enumerate(path, low) if z != text[i] or i in forced]
        k = last + 1
    return out


def best_path(stream: Stream, model: Model) -> list[Step]:
    """What the likeliest reading of a stream changes, in order. Words and other characters share no cost, so that the

    cheapest path through both is that of the words beside that of the rest.
    """
    return sorted(_word_path(stream, model) + _sign_path(stream.text, model), key=lambda s: (s.start, s.end))


def misread_lines(stream: Stream, path: list[Step]) -> set[int]:
    """The lines with a misread character. Where a reading has another length, the characters between those that agree."""
    out = set()
    for s in path:
        if not s.misread:
            continue
        old, new = stream.text[s.start : s.end], s.text
        if len(old) == len(new):
            at = [i for i in range(len(old)) if old[i] != new[i]] or [0]
        else:
            head = next((i for i, (x, y) in enumerate(zip(old, new, strict=False)) if x != y), min(len(old), len(new)))
            tail = next((i for i, (x, y) in enumerate(zip(old[:head:-1], new[:head:-1], strict=False)) if x != y), 0)
            at = [i for i in range(head, max(len(old) - tail, head + 1)) if old[i : i + 1] != " "] or [0]
        out |= {int(stream.line[min(s.start + i, s.end - 1)]) for i in at}
    return out


def cut_lines(stream: Stream, path: list[Step], model: Model) -> set[int]:
    """The lines whose hyphen cuts a word, as the path takes it; at the end of a chunk, where no rest follows, by the left part."""
    cut = {n for s in path for n in s.joins}
    return {j[0] for n, j in enumerate(stream.joins) if n in cut or not j[2] and ends_cut(j[1], j[3], model)}


def ends_cut(left: str, mark: str, model: Model) -> bool:
    """Whether a hyphen that nothing follows cuts a word."""
    return model.count(left) < 3 * model.scale and len(left) > 1 or mark not in "-‐‑"


def decode(stream: Stream, model: Model) -> str:
    """The likeliest text of a stream: its best path read out. What is misread for nothing known stays."""
    out, at = [], 0
    for s in best_path(stream, model):
        out += [stream.text[at : s.start], stream.text[s.start : s.end] if s.text == "?" else s.text]
        at = s.end
    return "".join([*out, stream.text[at:]])


def paragraph_starts(lines: list[str], kinds: list[str]) -> list[int]:
    """The lines that begin a paragraph: the cheapest choice of breaks, by dynamic programming over breaking or not."""
    rows = [k for k, kind in enumerate(kinds) if kind == "text"]
    if not rows:
        return []
    width = float(np.percentile([len(lines[k].rstrip()) for k in rows], 80))
    stay = {True: 0.0}  # cost so far by whether the current line begins a paragraph
    back: list[dict[bool, bool]] = [{True: True}]
    for n in range(1, len(rows)):
        a, b = lines[rows[n - 1]], lines[rows[n]]
        indent = b[:1] in " 　\t" and b.strip() != ""
        closed = a.rstrip().endswith(tuple("。！？.!?”\""))
        short = len(a.rstrip()) < 0.75 * width
        blank = any(kinds[j] == "blank" for j in range(rows[n - 1], rows[n]))
        cells = len(_CELLS.findall(a)) >= 2 or len(_CELLS.findall(b)) >= 2
        gain = 2.5 * indent + 1.2 * (closed and short) + 2.0 * (blank and closed) + 3.0 * cells - 2.5 * (not closed and not cells) - 0.3
        new, trace = {}, {}
        for begins in (True, False):
            options = {was: c - (gain if begins else 0.0) + (0.8 if begins and was else 0.0) * (not cells) for was, c in stay.items()}
            trace[begins] = min(options, key=options.get)
            new[begins] = options[trace[begins]]
        stay = new
        back.append(trace)
    state = min(stay, key=stay.get)
    starts = []
    for n in range(len(rows) - 1, -1, -1):
        if state:
            starts.append(rows[n])
        state = back[n][state] if n else True
    return sorted({rows[0], *starts})


def _header_lines(chunks: DataFrame) -> DataFrame:
    """id, lines: the lines whose template recurs on another page of the source. Templates are counted, never gathered."""

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for key, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(key, source, n, t) for n, line in enumerate((text or "").split("\n")) if (t := template(line))]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.string()), strict=True)], ["id", "source", "n", "template"])

        return run

    found = vec.map_steps(chunks.select(F.col("id").cast("string").alias("id"), F.coalesce("source", F.lit("")).alias("source"), "text"), make, "id string, source string, n int, template string")
    found = found.select("id", "n", F.xxhash64("source", "template").alias("h")).distinct()
    often = found.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h")
    return found.join(often, "h", "left_semi").groupBy("id").agg(F.collect_set("n").alias("lines"))  # at most a text's lines


def _streams(batch: pa.RecordBatch):
    """(id, lines, kinds, stream) of each row of id, text, page_start, page_end, lines."""
    for key, text, first, last, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        if text and text.strip():
            kinds = classify_lines(text, first, last, set(repeated or ()))
            lines = text.split("\n")
            yield key, lines, kinds, de_lined(lines, kinds)


def _confusions(forms: DataFrame, least: int) -> DataFrame:
    """seen, meant, times, occurs, everywhere from forms (w, n): in how many forms, and how often, a rare one has ``seen``

    where a frequent one has ``meant``, beside how often ``seen`` occurs at all."""
    places = forms.select("w", "n", F.explode(F.sequence(F.lit(1), F.length("w"))).alias("i"))
    masked = places.select("n", F.concat(F.substring("w", 1, 100), F.lit("")).alias("w"), "i", F.expr("concat(substr(w, 1, i - 1), '\\u0001', substr(w, i + 1))").alias("m"), F.expr("substr(w, i, 1)").alias("c"))
    top = masked.groupBy("m").agg(F.max(F.struct("n", "c")).alias("top")).where(F.col("top.n") >= least)
    rare = masked.join(top, "m").where((F.col("n") * RATIO <= F.col("top.n")) & (F.col("c") != F.col("top.c")))
    pairs = rare.groupBy(F.col("c").alias("seen"), F.col("top.c").alias("meant")).agg(F.count("*").alias("times"), F.sum("n").alias("occurs"))
    whole = masked.groupBy(F.col("c").alias("seen")).agg(F.sum("n").alias("everywhere"))
    return pairs.join(whole, "seen")


def learn(prepared: DataFrame) -> Model:
    """The model from all chunks (id, text, page_start, page_end, lines). Tables of a fixed size reach the driver."""

    def run(batches):
        words: dict[str, int] = {}
        grams: dict[str, int] = {}
        for batch in batches:
            for part in vec.steps(batch, 1):
                for _, _, _, stream in _streams(part):
                    cut = {j[1] for j in stream.joins} | {j[2] for j in stream.joins}
                    for w in chain(_TOKEN.findall(stream.text), _NUMBER.findall(stream.text)):
                        if w not in cut:
                            words[w] = words.get(w, 0) + 1
                    text = re.sub(r"\d", "0", stream.text)
                    for i in range(len(text) - 2):
                        if text[i] > "⺀" or text[i + 1] > "⺀" or text[i + 2] > "⺀":
                            g = text[i : i + 3]
                            grams[g] = grams.get(g, 0) + 1
            if len(words) + len(grams) > 500_000:
                yield _counted(words, grams)
                words, grams = {}, {}
        yield _counted(words, grams)

    vec.shared_dir(prepared.sparkSession)
    counts = prepared.select("id", "text", "page_start", "page_end", "lines").mapInArrow(run, "kind int, w string, n bigint").groupBy("kind", "w").agg(F.sum("n").alias("n")).checkpoint()
    latin = _confusions(counts.where("kind = 0 and length(w) between 4 and 30 and w = lower(w) and not w rlike '[0-9!|$@]'").select("w", "n"), 20)
    cjk = _confusions(counts.where("kind = 1").select("w", "n"), 20).where("seen rlike '[\\u3041-\\u30fa\\u4e00-\\u9fff]' and meant rlike '[\\u4e00-\\u9fff]'")
    def chosen(pairs: DataFrame, times: int, part: float) -> list:
        """Those that a character mostly stands for, and, of characters that hardly occur otherwise, lesser ones.

        By the shares at most eight for each character, so that the alphabet bounds them."""
        both = pairs.withColumn("all", F.sum("times").over(Window.partitionBy("seen"))).withColumn("rare", F.sum("occurs").over(Window.partitionBy("seen")))
        odd = F.col("rare") >= 0.5 * F.col("everywhere")
        kept = both.where((F.col("times") >= times) & ((F.col("times") >= part * F.col("all")) | odd & (F.col("times") >= 0.12 * F.col("all"))))
        return kept.orderBy(F.desc("times"), "seen", "meant").collect()

    readings: list[dict[str, str]] = [{}, {}]
    for k, rows in enumerate((chosen(latin, 4, 0.12), chosen(cjk, 3, 0.5))):
        for r in rows:
            readings[k][r["seen"]] = readings[k].get(r["seen"], "") + r["meant"]

    def slots(batches):
        for batch in batches:
            kind, w, n = (c.to_pylist() for c in batch.columns)
            at = [(_word_slot(x) if not k else (1 << WORD_BITS) + int(_gram_slots(_points(x))[0])) for k, x in zip(kind, w, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n, pa.int64())], ["slot", "n"])

    summed = counts.where("kind = 0 or length(w) = 3").mapInArrow(slots, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((1 << WORD_BITS) + (1 << GRAM_BITS), np.int32)
    table[summed.column("slot").to_numpy()] = np.minimum(summed.column("n").to_numpy(), 2**31 - 1)
    numbers = counts.where("kind = 0 and w rlike '^[0-9]+$'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return Model(table[: 1 << WORD_BITS], table[1 << WORD_BITS :], *readings, numbers)


def _counted(words: dict[str, int], grams: dict[str, int]) -> pa.RecordBatch:
    kind = [0] * len(words) + [1] * len(grams)
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array([*words, *grams], pa.string()), pa.array([*words.values(), *grams.values()], pa.int64())], ["kind", "w", "n"])


def prepare(chunks: DataFrame) -> DataFrame:
    """id, text, page_start, page_end, lines of every chunk; lines: those whose template recurs in the source."""
    rows = chunks.select(F.col("id").cast("string").alias("id"), "source", "text", "page_start", "page_end")
    heads = _header_lines(rows)
    return rows.drop("source").join(heads, "id", "left").select("id", "text", "page_start", "page_end", "lines")


def noisy_lines(chunks: DataFrame) -> DataFrame:
    """id, line_no, kind of every line with noise."""
    prepared = prepare(chunks)
    model = learn(prepared)

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for key, _, kinds, stream in _streams(batch):
                out += [(key, n, kind) for n, kind in enumerate(kinds) if kind in ("header", "page_number")]
                path = best_path(stream, model)
                out += [(key, n, "hyphen") for n in sorted(cut_lines(stream, path, model))]
                out += [(key, n, "misread") for n in sorted(misread_lines(stream, path))]
            columns = list(zip(*out, strict=True)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.string()), strict=True)], ["id", "line_no", "kind"])

        return run

    return vec.map_steps(prepared, make, "id string, line_no int, kind string").distinct()


def repaired(chunks: DataFrame) -> DataFrame:
    """id, paragraphs (array) of every chunk with text: furniture dropped, words joined and read, paragraphs continuous."""
    prepared = prepare(chunks)
    model = learn(prepared)

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, paragraphs = [], []
            for key, lines, kinds, _ in _streams(batch):
                starts = paragraph_starts(lines, kinds)
                out = []
                for n, a in enumerate(starts):
                    b = starts[n + 1] if n + 1 < len(starts) else len(lines)
                    own = [k if a <= i < b else "blank" for i, k in enumerate(kinds)]
                    out.append(decode(de_lined(lines, own), model))
                ids.append(key), paragraphs.append(out)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(paragraphs, pa.list_(pa.string()))], ["id", "paragraphs"])

        return run

    return vec.map_steps(prepared, make, "id string, paragraphs array<string>")
