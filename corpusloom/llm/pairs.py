"""Problem 6: prompt and response pairs unfit for training, with the type of defect.

A multi-label linear classifier on hashed character n-grams of the answer and on features of the pair. Its training rows
are made from the corpus itself: pairs as they are, and the same pairs with the answer cut off, replaced by its question
(plain, framed, altered), by an answer in another language, by nothing, and by a refusal, for which answers to questions
of type refusal serve. Pairs that the first model takes for defective are left out of the clean ones of the second.
Logits are calibrated and thresholds set on pairs of which nothing was trained on. Training sees at most SAMPLE pairs;
line endings are counted in all answers, and every pair is classified by the n-grams of its whole answer.

A null or blank answer (or struct) is 'empty', whatever its status says. A null question counts as ''. A refusal is no
defect where question_type is refusal.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec

DEFECTS = ("empty", "truncated", "refusal", "copy", "other_language")
#: At most so many pairs are trained on.
SAMPLE = 3_000
HASH_BITS = 14
#: Answers that say nothing, for training.
PLACEHOLDERS = (
    "", " ", "\n\n", "　", "null", "None", "N/A", "n/a", "nan", "-", "--", "—", "…", "……", "...", ".", "。", "空", "无", "略", "暂无", "暂无。", "无。", "待补充", "未知", "没有", "答：", "答案：", "回答：", "A:", "Answer:",
    "[]", "{}", '""', "''", "()", "<p></p>", "<br>", "(no answer)", "(empty)", "no answer", "TODO", "TBD", "undefined", "#", "/", "?", "？", "\\n", "```", "```\n```", "空白", "（空）", "（无）", "无答案", "暂无答案", "нет", "Нет ответа", "sans réponse",
)
#: Names of languages in requests.
_NAMES = {
    "en": r"英文|英语|English|anglais|английск", "zh": r"中文|汉语|Chinese|chinois|китайск", "fr": r"法文|法语|French|français|французск", "ru": r"俄文|俄语|Russian|russe|русск",
}
_REQUEST = {k: re.compile(rf"(?:用|以|成|为|译|in |into |en |auf |на |по-)\s*(?:{v})(?!\s*(?:tables?|officer|fleet))", re.I) for k, v in _NAMES.items()}
_FUNCTION = {"en": re.compile(r"\b(?:the|of|and|to|in|that|was|is|for|at|only|by)\b", re.I), "fr": re.compile(r"\b(?:le|la|les|de|du|des|et|a|à|une?|au|pour|avec|où)\b|[lLdD]’", re.I)}
_MARKER = re.compile(r"\s*(?:[-*•·]\s|\d{1,2}[.、)）]|[（(][\d一二三四五六七八九十]{1,3}[）)]|[①-⑳]|[一二三四五六七八九十]{1,2}[、.])")
_PROSE_END = "。！？.!?…；;”’\"』」）)】]}|：:>`"
_WORDS = re.compile(r"\w", re.UNICODE)


def language(text: str) -> str:
    """zh, ru, en, fr, or '' where there is too little to tell."""
    cjk = len(re.findall(r"[一-鿿]", text))
    cyrillic = len(re.findall(r"[А-Яа-яЁё]", text))
    latin = len(re.findall(r"[A-Za-zÀ-ÿ]", text))
    if cjk >= 3 and cjk * 2 >= max(latin, cyrillic):
        return "zh"
    if cyrillic >= 8 and cyrillic >= latin:
        return "ru"
    if latin >= 12:
        return "fr" if len(_FUNCTION["fr"].findall(text)) > len(_FUNCTION["en"].findall(text)) else "en"
    return ""


def expected_language(question: str) -> str:
    """The language that the question asks for, else its own."""
    for k, pattern in _REQUEST.items():
        if pattern.search(question):
            return k
    return language(question)


def _grams(text: str, n: int = 3) -> Counter:
    return Counter(text[i : i + n] for i in range(len(text) - n + 1))


def _plain(text: str) -> str:
    return re.sub(r"[\W_]+", "", text.lower())


def _content(answer: str) -> str:
    """The answer without keys of JSON, tags and marks, for telling its language."""
    return re.sub(r'"\w+"\s*:|</?\w+>', " ", answer)


#: Bits of the tables of line endings, whose size is fixed.
END_BITS = 18
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _end_slot(tail: str) -> int:
    return (sum(ord(c) * m for c, m in zip(tail, _MIX, strict=True)) & (2**64 - 1)) >> 64 - END_BITS


@dataclass(frozen=True)
class Endings:
    """How often a run of three characters (by slot) ends a line, and how often it occurs in one, in all answers."""

    ends: np.ndarray
    seen: np.ndarray

    def oddness(self, line: str) -> float:
        tail = re.sub(r"\d", "0", line[-3:])
        if len(tail) < 3:
            return float(np.log(2.0 / 0.2))
        slot = _end_slot(tail)
        return float(np.log((self.seen[slot] + 2.0) / (self.ends[slot] + 0.2)))


def _ending_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counts by slot: of the last three characters of each line, and of each three in a line."""
    raw, offsets = vec.codepoints(column)
    n = len(offsets) - 1
    chars = np.full(len(raw) + n + 2, 10, np.uint32)
    chars[np.arange(len(raw)) + vec.row_ids(offsets) + 2] = raw
    chars[(chars >= 0x30) & (chars <= 0x39)] = 0x30
    blank = np.isin(chars, (9, 11, 12, 13, 32, 0x85, 0xA0, 0x3000))
    at = np.arange(len(chars))
    last = np.maximum.accumulate(np.where(~blank, at, 0))  # the last sign up to here, a line feed at least
    with np.errstate(over="ignore"):
        slot = (chars[:-2] * np.uint64(_MIX[0]) + chars[1:-1] * np.uint64(_MIX[1]) + chars[2:] * np.uint64(_MIX[2])) >> np.uint64(64 - END_BITS)
    inside = (chars[:-2] != 10) & (chars[1:-1] != 10) & (chars[2:] != 10)
    ended = last[np.flatnonzero(chars[1:] == 10)] - 2
    ended = ended[ended >= 0]
    ended = ended[inside[ended]]
    return np.bincount(slot[ended].astype(np.int64), minlength=1 << END_BITS), np.bincount(slot[inside].astype(np.int64), minlength=1 << END_BITS)


def count_endings(answers: DataFrame, text: str = "a") -> Endings:
    """Counts of all answers: summed up in each task, then by slot; the tables' size is fixed."""

    def run(batches):
        both = np.zeros(2 << END_BITS, np.int64)
        for batch in batches:
            for part in vec.steps(batch):
                both += np.concatenate(_ending_counts(part.column(0)))
        at = np.flatnonzero(both)
        for k in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[k : k + 100_000].astype(np.int32)), pa.array(both[at[k : k + 100_000]])], ["slot", "n"])

    found = answers.select(text).mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    both = np.zeros(2 << END_BITS, np.float32)
    both[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return Endings(both[: 1 << END_BITS], both[1 << END_BITS :])


DENSE = 52


def features(question: str, answer: str, endings: Endings) -> tuple[np.ndarray, bool]:
    """The dense features of a pair, and whether the answer copies the question."""
    x = np.zeros(DENSE)
    text = answer.strip()
    content = _plain(re.sub(r"<[^>]*>", "", text))
    n = len(content)
    x[0] = 1
    x[1], x[2] = min(len(text), 2000) / 500, np.log1p(n) / 5
    x[3], x[4], x[5] = n == 0, n <= 1, n <= 2
    x[6] = n <= 6 and not any(c.isdigit() for c in content)
    lines = [s for s in text.split("\n") if s.strip()]
    last = text[-1:] or ""
    is_json = text[:1] in ("{", "[") and len(text) > 2
    marked = [bool(_MARKER.match(s)) for s in lines]
    is_list = not is_json and len(lines) >= 2 and sum(marked) >= max(1, 0.6 * len(lines))
    is_table = not is_json and len(lines) >= 2 and sum(s.lstrip().startswith("|") for s in lines) >= 2
    prose = not (is_json or is_list or is_table)
    json_ok = False
    if is_json:
        try:
            json.loads(text)
            json_ok = True
        except ValueError:
            pass
    x[7], x[8], x[9] = is_json and not json_ok, json_ok, is_table
    if is_table:
        pipes = [s.count("|") for s in lines if s.lstrip().startswith("|")]
        x[10] = lines[-1].count("|") < max(pipes[0], 2) or not lines[-1].rstrip().endswith("|")
        x[11] = len(lines) <= 2
    if is_list:
        others, end = [s.strip() for s in lines[:-1]], lines[-1].strip()
        x[12] = 1
        size = float(np.median([len(s) for s in others]))
        x[13] = len(end) < 0.5 * size
        x[14] = len(end) < 0.8 * size
        colon = sum(":" in s or "：" in s for s in others) / len(others)
        x[15] = colon > 0.7 and ":" not in end and "：" not in end
        x[16] = bool(re.fullmatch(_MARKER.pattern + r"?\s*[^：:]*[：:]?\s*", end)) and colon > 0.7
        closed = sum(s[-1] in "。.；;" for s in others) / len(others)
        x[17] = closed > 0.7 and last not in "。.；;"
        x[18] = not _plain(_MARKER.sub("", end))
        odd = endings.oddness(end)
        x[19], x[20], x[21] = odd / 5, odd > 2.5, odd > 4
    grams_q = _grams(_plain(question))
    grams_a = Counter(g for i in range(n - 2) if (g := content[i : i + 3]) in grams_q)
    common = sum(min(k, grams_q[g]) for g, k in grams_a.items())
    of_answer, of_question = common / max(n - 2, 1), common / max(sum(grams_q.values()), 1)
    rest = content
    bare = _plain(question)
    if bare and len(bare) > 5:
        rest = content.replace(bare, "")
    x[22], x[23], x[24] = of_answer, of_question, of_answer * of_question
    x[25] = of_question > 0.7 and of_answer > 0.45
    x[26] = of_question > 0.8 and of_answer > 0.6
    x[27] = of_question > 0.8 and len(rest) <= 12 and n > 5
    x[28] = len(content) > 3 * max(len(bare), 1)
    copied = of_question > 0.7 and of_answer > 0.45 or x[27]
    ended = last in _PROSE_END
    x[29] = prose and not ended and n > 14 and not copied
    x[30] = prose and not ended and n > 40 and not copied
    x[31] = prose and last in "，,、：:；;" and n > 5 and not copied
    x[32] = answer != answer.rstrip() and n > 14 and not copied
    x[33] = prose and n <= 14 and not ended
    opened = sum(text.count(c) for c in "（(【「『“") - sum(text.count(c) for c in "）)】」』”")
    marker_ends = sum(bool(re.match(r"\s*\d{1,2}[)）]", s)) for s in lines)
    x[34] = opened + marker_ends > 0 and not is_json and n > 14
    x[35] = text.count('"') % 2 == 1 and n > 14
    odd = endings.oddness(lines[-1].strip()) if lines else 0.0
    x[36], x[37] = prose * odd / 5 * (n > 14), (prose and odd > 4 and n > 14)
    x[38] = prose and bool(re.search(r"[a-zа-яà-ÿ]$", text)) and n > 30
    want, got = expected_language(question), language(_content(text))
    if bare and len(bare) > 5 and of_question > 0.7 and not copied:
        got = language(_content(text.replace(question, " "))) or got
    x[39] = bool(want and got and want != got)
    x[40] = bool(want and got and want == got)
    x[41] = not got
    x[42] = want != language(question)
    x[43] = x[39] and n > 30
    x[44] = x[39] and x[42]
    for k, lang in enumerate(("zh", "en", "fr", "ru")):
        x[45 + k] = got == lang
    x[49] = n < 60
    x[50] = bool(re.search(r"\d", text)) and n < 30
    x[51] = len(lines) == 1
    return x, bool(copied)


def _folded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Characters in lower case, digits as 0, and the row offsets; white space at the ends is left out."""
    texts = [re.sub(r"\d", "0", (t or "").strip().lower()) for t in column.to_pylist()]
    return vec.codepoints(pa.array(texts, pa.string()))


def gram_slots(answers: pa.Array, copied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct slots of each answer's n-grams, and the offsets of the answers in them.

    All runs of three characters of the whole answer and all pairs of neighbouring words; runs of two in short answers;
    in long ones also the runs of the beginning and the end by their place. Of answers that copy their question only
    how they begin and end.
    """
    chars, offsets = _folded(answers)
    n, sizes = len(offsets) - 1, np.diff(offsets)
    row = vec.row_ids(offsets)
    found_row, found = [], []

    def add(rows: np.ndarray, hashes: np.ndarray, salt: int) -> None:
        found_row.append(rows)
        found.append(vec.mix64(hashes ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (2**64 - 1))) >> np.uint64(64 - HASH_BITS))

    place = np.arange(len(chars)) - offsets[row] if len(chars) else np.zeros(0, np.int64)
    for width in (1, 2, 3):  # beginnings and ends
        h = vec.window_hashes(chars, width)
        long = np.flatnonzero(sizes >= width)
        add(long, h[offsets[long]], width)
        add(long, h[offsets[long + 1] - width], 10 + width)
    own = ~copied
    if len(chars) >= 3:
        h = vec.window_hashes(chars, 3)
        at = np.flatnonzero((row[: len(h)] == row[2 : len(h) + 2]) & own[row[: len(h)]])
        add(row[at], h[at], 20)
        long = at[sizes[row[at]] > 90]
        head, tail = long[place[long] <= 27], long[place[long] >= sizes[row[long]] - 20]
        add(row[head], h[head], 21)
        add(row[tail], h[tail], 22)
        h = vec.window_hashes(chars, 2)
        at = np.flatnonzero((row[: len(h)] == row[1 : len(h) + 1]) & own[row[: len(h)]] & (sizes[row[: len(h)]] <= 90))
        add(row[at], h[at], 23)
    # words: a word's hash is the sum of its characters' hashes with their places, so of any length
    letter = ((chars >= 97) & (chars <= 122)) | ((chars >= 0xE0) & (chars <= 0xFF)) | ((chars >= 0x430) & (chars <= 0x451)) | (chars == 0x27) | (chars == 0x2019)
    first = np.flatnonzero(letter & np.concatenate([[True], ~letter[:-1] | (row[1:] != row[:-1])])) if len(chars) else np.zeros(0, np.int64)
    if len(first) > 1:
        word = np.cumsum(np.isin(np.arange(len(chars)), first)) - 1
        inside = np.flatnonzero(letter)
        with np.errstate(over="ignore"):
            part = vec.mix64(chars[inside].astype(np.uint64) + ((inside - first[word[inside]]).astype(np.uint64) << np.uint64(32)))
            h = np.add.reduceat(part, np.searchsorted(inside, first))
            last = np.append(inside[np.searchsorted(inside, first[1:]) - 1], inside[-1])
            pair = np.flatnonzero((first[1:] == last[:-1] + 2) & (chars[np.minimum(last[:-1] + 1, len(chars) - 1)] == 32) & (row[first[1:]] == row[first[:-1]]) & own[row[first[:-1]]])
            add(row[first[pair]], h[pair] * np.uint64(3) + h[pair + 1], 24)
    keys = np.unique((np.concatenate(found_row).astype(np.int64) << HASH_BITS) | np.concatenate(found).astype(np.int64))
    return keys & ((1 << HASH_BITS) - 1), np.searchsorted(keys, np.arange(n + 1) << HASH_BITS)


@dataclass
class Inputs:
    """Dense features of pairs, and the slots of their n-grams with offsets."""

    dense: np.ndarray
    slots: np.ndarray
    offsets: np.ndarray

    def logits(self, dense: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        sizes = np.maximum(np.diff(self.offsets), 1)
        return self.dense @ dense + _sums(hashed[self.slots], self.offsets) / np.sqrt(sizes)[:, None]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of rows of values between offsets, 0 for none."""
    out = np.zeros((len(offsets) - 1, values.shape[1]), np.float32)
    some = offsets[1:] > offsets[:-1]
    if some.any():
        out[some] = np.add.reduceat(values, offsets[:-1][some], axis=0)
    return out


def inputs(pairs: list[tuple[str, str]], endings: Endings) -> Inputs:
    both = [features(q, a, endings) for q, a in pairs]
    slots, offsets = gram_slots(pa.array([a for _, a in pairs], pa.string()), np.array([c for _, c in both], bool))
    return Inputs(np.array([x for x, _ in both], np.float32).reshape(-1, DENSE), slots, offsets)


@dataclass
class PairModel:
    """scale, shift: the calibration of each defect's logit; thresholds: on the calibrated probabilities."""

    dense: np.ndarray
    hashed: np.ndarray
    scale: np.ndarray
    shift: np.ndarray
    thresholds: np.ndarray
    endings: Endings

    def probabilities(self, pairs: list[tuple[str, str]]) -> np.ndarray:
        z = inputs(pairs, self.endings).logits(self.dense, self.hashed) * self.scale + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _corrupt(q: str, a: str, kind: str, rng: np.random.Generator, refusals: list[str], answers: dict[str, list[str]]) -> str | None:
    if kind == "empty":
        return PLACEHOLDERS[rng.integers(len(PLACEHOLDERS))]
    if kind == "refusal":
        return refusals[rng.integers(len(refusals))] if refusals else None
    if kind == "truncated":
        if len(a) < 30 or len(_plain(a)) < 20:
            return None
        at = int(len(a) * rng.uniform(0.3, 0.97))
        cut = a[:at]
        if cut.rstrip()[-1:] in "。！？.!?}]" or a[at : at + 1] == "\n" and not cut.endswith(("\n", "：", ":", "、")):
            cut = a[: at - 2]
        if not cut.strip() or cut.rstrip()[-1] in "。！？.!?}]|" and cut.count("\n"):
            return None
        return cut + rng.choice(["", "", "", "\n"])
    if kind == "copy":
        if len(q) < 6:
            return None
        bare = q.rstrip("？?。.")
        changed = "".join(c for c in q if rng.random() > 0.06)
        forms = [q, bare, bare + "。", bare + ".", q + "\n" + q, q + q, "答：" + q, "问题：" + q, f"关于您的问题“{q}”", f"“{q}”", q.lower(), changed, q.replace("，", " ").replace("？", ""), q.replace("，", ",").replace("？", "?"), "Question: " + q, "You asked: " + q, "您问的是：" + q, "好的，" + q, "A: " + q]
        return forms[rng.integers(len(forms))]
    other = [k for k in answers if k != expected_language(q) and answers[k]]
    if not other or not expected_language(q):
        return None
    pool = answers[other[rng.integers(len(other))]]
    return rng.choice(["", "", "", "好的。\n", "Sure. "]) + pool[rng.integers(len(pool))]


def _solve(x: Inputs, y: np.ndarray, penalty: float = 2.0, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions, one for each column of y, by limited-memory quasi-Newton steps; the rarer positives count threefold."""
    sizes = np.maximum(np.diff(x.offsets), 1)
    scale = (1 / np.sqrt(sizes))[:, None].astype(np.float32)
    order = np.argsort(x.slots, kind="stable")
    row = vec.row_ids(x.offsets)[order]
    bounds = np.searchsorted(x.slots[order], np.arange((1 << HASH_BITS) + 1))
    weight = 1 + 2.0 * y
    cut = DENSE * y.shape[1]
    split = lambda w: (w[:cut].reshape(DENSE, -1), w[cut:].reshape(1 << HASH_BITS, -1).astype(np.float32))

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        wd, wh = split(w)
        z = np.clip(x.logits(wd, wh), -30, 30).astype(np.float64)
        p = 1 / (1 + np.exp(-z))
        g = weight * (p - y)
        value = float((weight * (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z)).sum() + penalty / 2 * (w @ w))
        lift = (g * scale).astype(np.float32)
        return value, np.concatenate([(x.dense.T @ g).ravel(), _sums(lift[row], bounds).ravel()]) + penalty * w

    w = np.zeros(cut + (1 << HASH_BITS) * y.shape[1])
    value, g = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        step, used = g.copy(), []
        for s, t in reversed(past):
            a = (s @ step) / (s @ t)
            used.append(a)
            step -= a * t
        step *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(np.abs(g).max(), 1e-9)
        for (s, t), a in zip(past, reversed(used), strict=True):
            step += (a - (t @ step) / (s @ t)) * s
        pace, slope = 1.0, g @ step
        while True:
            new = w - pace * step
            new_value, new_g = loss(new)
            if new_value <= value - 1e-4 * pace * slope or pace < 1e-3:
                break
            pace /= 2
        s, t = new - w, new_g - g
        if s @ t > 1e-10:
            past = [*past[-7:], (s, t)]
        w, g, gain, value = new, new_g, value - new_value, new_value
        if gain < 1e-4 * abs(value):
            break
    return split(w)


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make a logit a probability, from pairs that weren't trained on (Newton steps, held near 1 and 0)."""
    a = np.array([1.0, 0.0])
    x = np.column_stack([z, np.ones_like(z)])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        gradient = x.T @ (p - y) + 0.5 * (a - [1.0, 0.0])
        a = a - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.5 * np.eye(2), gradient)
    return float(max(a[0], 0.1)), float(a[1])


#: Share of the pairs, each with all that is made of it, that calibrates and sets thresholds instead of training.
HELD = 0.25


def train(rows: list[tuple[str, str, str]], endings: Endings, seed: int = 7) -> PairModel:
    """rows: (question, answer, question_type) of a sample of the corpus; endings: of all answers.

    Pairs are dealt to training and holding out before anything is made of them; what is made on one side uses questions,
    answers and refusals of that side alone.
    """
    rng = np.random.default_rng(seed)
    rows = [(q or "", a or "", t or "") for q, a, t in rows]
    aside = rng.random(len(rows)) < HELD
    k = len(DEFECTS)

    def side(of: np.ndarray) -> tuple[list, list, dict]:
        own = [r for r, x in zip(rows, of, strict=True) if x]
        refusals = [a for _, a, t in own if t == "refusal" and 4 < len(a.strip()) < 160]
        base = [(q, a) for q, a, t in own if t != "refusal" and (len(_plain(a)) > 2 or re.search(r"\d", a))]
        answers: dict[str, list[str]] = {}
        for _, a in base:
            if lang := language(_content(a)):
                answers.setdefault(lang, []).append(a)
        return base, refusals, answers

    def spoilt(clean: list, refusals: list, answers: dict) -> tuple[list, np.ndarray]:
        made: list[tuple[str, str, int]] = []
        for q, a in clean:
            for label, kind in enumerate(DEFECTS):
                if rng.random() < (0.9 if kind == "truncated" else 0.4):
                    bad = _corrupt(q, a, kind, rng, refusals, answers)
                    if bad is not None:
                        made.append((q, bad, label))
        goal = np.zeros((len(clean) + len(made), k))
        goal[np.arange(len(made)) + len(clean), [m[2] for m in made]] = 1
        return [*clean, *((q, a) for q, a, _ in made)], goal

    base, *pools = side(~aside)
    model = PairModel(np.zeros((DENSE, k)), np.zeros((1 << HASH_BITS, k), np.float32), np.ones(k), np.zeros(k), np.full(k, 0.5), endings)
    if not base:
        return model
    clean = base
    for rounds in (15, 40):  # the second time without pairs that the first model takes for defective
        pairs, goal = spoilt(clean, *pools)
        model.dense, model.hashed = _solve(inputs(pairs, endings), goal, rounds=rounds)
        if rounds == 15:
            clean = [c for c, own in zip(base, model.probabilities(base), strict=True) if own.max() < 0.5] or base
    held, *pools = side(aside)
    held = [c for c, own in zip(held, model.probabilities(held), strict=True) if own.max() < 0.9] if held else held
    if not held:
        return model
    pairs, goal = spoilt(held, *pools)
    z = inputs(pairs, endings).logits(model.dense, model.hashed).astype(np.float64)
    for c in range(k):
        model.scale[c], model.shift[c] = _calibrate(z[:, c], goal[:, c])
    p = 1 / (1 + np.exp(-np.clip(z * model.scale + model.shift, -30, 30)))
    for c in range(k):
        own, good = np.sort(p[goal[:, c] == 1, c]), np.sort(p[goal.sum(1) == 0, c])
        best = (-1.0, 0.0)
        for t in np.linspace(0.2, 0.9, 29):
            hit, wrong = len(own) - np.searchsorted(own, t), len(good) - np.searchsorted(good, t)
            best = max(best, (2 * hit / max(len(own) + hit + 4 * wrong, 1), -abs(t - 0.5)))
            if best[1] == -abs(t - 0.5):
                model.thresholds[c] = t
    return model


def classify(model: PairModel, pairs: list[tuple[str | None, str | None, str | None]]) -> list[str | None]:
    """The defect of each (question, answer, question_type), or None."""
    told = [(q or "", a or "") for q, a, _ in pairs]
    out: list[str | None] = []
    refusal = DEFECTS.index("refusal")
    for (_, a), (_, _, kind), p in zip(told, pairs, model.probabilities(told) if told else (), strict=True):
        above = p - model.thresholds
        if kind == "refusal":
            above[refusal] = -1
        k = int(above.argmax())
        if not a.strip():
            out.append("empty")
        elif kind == "refusal" and p[refusal] > 0.5:  # a refusal as wanted, however short
            out.append(None)
        else:
            out.append(DEFECTS[k] if above[k] > 0 else None)
    return out


def defects(rows: DataFrame, id_col: str = "id", question: str = "sft_question", answer: str = "sft_answer") -> DataFrame:
    """id, defect of the defective pairs, ids that arrive again once. question and answer: the two struct columns."""
    flat = rows.select(rows[id_col].alias("id"), F.col(f"{question}.question").alias("q"), F.col(f"{answer}.answer").alias("a"), F.col(f"{question}.question_type").alias("t"))
    sample = flat.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("q", "a", "t").collect()
    model = train([tuple(r) for r in sample], count_endings(flat.where("a is not null")))

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            q, a, t = (batch.column(k).to_pylist() for k in (1, 2, 3))
            kinds = classify(model, list(zip(q, a, t, strict=True)))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(kinds, pa.string())], ["id", "defect"])

        return run

    kind = rows.schema[id_col].dataType.simpleString()
    return vec.map_steps(flat, make, f"id {kind}, defect string", "a").where("defect is not null").distinct()
