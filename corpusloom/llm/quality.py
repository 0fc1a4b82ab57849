"""Problem 7: statistics of each text, and texts that are lists, tables or junk rather than prose.

One vectorised pass gives the statistics. They are summed into quantile sketches for each language: counts of values in
logarithmic buckets, which are merged by adding. From these each value gets its percentile in its language; a small
linear model on the tails (which percentile band of each statistic a text falls in), trained on labelled records, names
the kind. Sketches and model have a fixed size, whatever the corpus.

Null and blank texts have statistics of 0 and no kind. Lengths are in code points.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec

LANGS = ("zh", "en", "ru", "fr", "other")
KINDS = ("prose", "list", "table", "junk")
STATS = (
    "true_length", "n_lines", "mean_line", "end_share", "stop_line_share", "clause_ratio", "stop_ratio", "digit_ratio", "symbol_ratio", "latin_ratio", "common_share", "mean_word",
    "marker_share", "separators", "colons", "tight_commas", "long_run_share", "code_ratio", "line_spread", "short_line_share", "nav_marks", "dot_leaders", "prose_mass", "numbers", "words", "doubled_marks",
    "field_share", "indent_share", "longest_share", "cjk_ratio",
)
#: Percentiles that bound the bands of each statistic.
CUTS = (0.5, 1, 2, 3, 5, 8, 12, 20, 35, 50, 65, 80, 88, 92, 95, 97, 98, 99, 99.5)
#: Relative width of a sketch's buckets.
BUCKET = 0.01
#: At most so many labelled records train the model.
MOST_LABELS = 20_000

_OTHER, _LATIN, _CJK, _CYRILLIC, _LETTER, _DIGIT, _SPACE, _BREAK = range(8)


@cache
def _classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    every = np.arange(0x110000, dtype="<u4")
    every[0xD800:0xE000] = 0
    text = every.tobytes().decode("utf-32-le")
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_LATIN, r"\p{Latin}+"), (_CJK, r"\p{Han}+"), (_CYRILLIC, r"\p{Cyrillic}+"), (_DIGIT, r"\p{Nd}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            table[m.start() : m.end()] = kind
    table[10] = _BREAK
    return table


@cache
def _flags() -> dict[str, np.ndarray]:
    def of(signs: str) -> np.ndarray:
        out = np.zeros(0x110000, bool)
        out[[ord(c) for c in signs]] = True
        return out

    return {
        "stop": of("。！？.!?…"), "closer": of("”’」』\"»）)】"), "clause": of("，,、；;"), "code": of("{}<>=_;()[]/\\#$%&*+@^~|`"), "separator": of("\t|"), "colon": of("：:"),
        "bullet": of("-*•·●○◆◇■□▪►▶–—+※★☆"), "number_end": of(".、)）．:："), "open": of("(（[【〔"), "chinese_number": of("一二三四五六七八九十百"), "nav": of("/>|"),
        "circled": (lambda x: (x.__setitem__(slice(0x2460, 0x24FF), True), x)[1])(np.zeros(0x110000, bool)),
    }


def _word_hash(word: str) -> int:
    h = 0
    for c in word:
        h = (h * 1_000_003 + ord(c)) & (2**64 - 1)
    return h


def statistics(column: pa.Array, common: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """The language (index in LANGS) and the statistics (columns as STATS) of each text. common: (lang, word)."""
    raw, offsets = vec.codepoints(column)
    n = len(offsets) - 1
    # a break after each text keeps lines and windows within it
    chars = np.full(len(raw) + n, 10, np.uint32)
    chars[np.arange(len(raw)) + vec.row_ids(offsets)] = raw
    offsets = offsets + np.arange(n + 1)
    kind, flag = _classes()[chars], _flags()
    on = {k: f[chars] for k, f in flag.items()}
    ends = np.flatnonzero(chars == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    line_offsets = np.concatenate([starts, [len(chars)]])
    space = (kind == _SPACE) | (kind == _BREAK)
    ink = ~space
    per_line = lambda x: vec.segment_sum(x, line_offsets)
    inked = per_line(ink)
    keep = inked > 0
    doc_of = np.searchsorted(offsets, starts, "right") - 1
    # first and last character of each line besides white space
    at = np.arange(len(chars))
    last_ink = np.maximum.accumulate(np.where(ink, at, -1))
    next_ink = np.minimum.accumulate(np.where(ink, at, len(chars))[::-1])[::-1]
    first = np.minimum(next_ink[starts], len(chars) - 1) if len(starts) else starts
    last = np.maximum(last_ink[ends], 0) if len(ends) else ends
    pad = np.concatenate([chars, np.full(4, 10, chars.dtype)])
    pad_kind = np.concatenate([kind, np.full(4, _BREAK, np.uint8)])
    stop, closer = on["stop"], on["closer"]
    ends_well = stop[last] | (closer[last] & stop[np.maximum(last - 1, 0)]) if len(ends) else np.zeros(0, bool)
    c0, c1, c2 = pad[first], pad[first + 1], pad[first + 2]
    number_end, digit = flag["number_end"], kind == _DIGIT
    d = lambda c: _classes()[c] == _DIGIT
    chinese = flag["chinese_number"]
    marker = (
        (flag["bullet"][c0] & (_classes()[c1] == _SPACE)) | flag["circled"][c0] | (d(c0) & number_end[c1] & ~d(c2)) | (d(c0) & d(c1) & number_end[c2])
        | (chinese[c0] & number_end[c1]) | (chinese[c0] & chinese[c1] & number_end[c2]) | (flag["open"][c0] & (d(c1) | chinese[c1])) | ((c0 == ord("第")) & (d(c1) | chinese[c1]))
    )
    wide = space & (chars != 10)
    doubled = wide & np.concatenate([wide[1:], [False]]) & np.concatenate([[True], ~wide[:-1]]) & (last_ink > np.repeat(starts, np.diff(line_offsets)) - 1) if len(chars) else wide
    separators = per_line(on["separator"] | doubled)
    length = np.diff(line_offsets) - 1
    next_space = np.concatenate([space[1:], [True]])
    stop_inside = stop & ((chars > 127) | next_space)
    stops = per_line(stop_inside)
    ascii_ink = ink & (chars < 128)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], ascii_ink.view(np.int8), [0]])))
    run_start, run_end = edge[::2], edge[1::2]
    long = np.zeros(len(chars) + 1, np.int32)
    is_long = run_end - run_start >= 24
    np.add.at(long, run_start[is_long], 1), np.add.at(long, run_end[is_long], -1)
    in_long = np.cumsum(long[:-1]) > 0
    letters = (kind == _LATIN) | (kind == _CYRILLIC) | (kind == _LETTER)
    word_start = letters & ~np.concatenate([[False], letters[:-1]])
    cjk = kind == _CJK
    number_start = digit & ~np.concatenate([[False], digit[:-1]])
    mark = ink & ~letters & ~cjk & ~digit
    doubled_mark = mark & np.concatenate([[False], mark[:-1]])
    dots = (chars == 0x2026) | ((chars == 46) & np.concatenate([[False], chars[:-1] == 46]))
    tight = (chars == 44) & ~next_space
    code_mark = on["code"]
    nav = on["nav"] & next_space
    per_doc = lambda x: vec.segment_sum(x, offsets).astype(float)
    total = per_doc(ink)
    safe = np.maximum(total, 1)
    lines = np.bincount(doc_of[keep], minlength=n).astype(float)
    safe_lines = np.maximum(lines, 1)
    of_lines = lambda x: np.bincount(doc_of[keep], x[keep].astype(float), n)
    mean = of_lines(length) / safe_lines
    spread = np.sqrt(np.maximum(of_lines(length.astype(float) ** 2) / safe_lines - mean**2, 0)) / np.maximum(mean, 1)
    # common words: single letters and pairs of Chinese, whole words elsewhere
    lang_words = {}
    for lang, word in common:
        lang_words.setdefault(lang, set()).add(word.lower())
    zh = lang_words.get("zh", set())
    table = np.zeros(0x110000, bool)
    table[[ord(w) for w in zh if len(w) == 1]] = True
    zh_common = table[chars]
    for size in {len(w) for w in zh} - {0, 1}:  # a common word of several characters counts where it begins
        if len(chars) >= size:
            words = np.array([[ord(c) for c in w] for w in zh if len(w) == size], np.uint32)
            hit = cjk[: len(chars) - size + 1] & np.isin(vec.window_hashes(chars, size), np.concatenate([vec.window_hashes(w, size) for w in words]))
            zh_common[: len(hit)] |= hit
    words_at = np.flatnonzero(word_start)
    edges = np.flatnonzero(np.diff(np.concatenate([letters.view(np.int8), [0]])) == -1) + 1
    sizes = edges - words_at
    lower = _lower()[chars].astype(np.uint64)
    longest_word = max((len(w) for lang in ("en", "ru", "fr") for w in lang_words.get(lang, ())), default=0)
    h = np.zeros(len(words_at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(longest_word):  # a longer word is no common one
            own = sizes > k
            h[own] = h[own] * np.uint64(1_000_003) + lower[words_at[own] + k]
    word_doc = np.searchsorted(offsets, words_at, "right") - 1
    matches = {}
    for lang in ("en", "ru", "fr"):
        own = np.array([_word_hash(w) for w in lang_words.get(lang, ())], np.uint64)
        matches[lang] = np.bincount(word_doc, np.isin(h, own) & (sizes <= longest_word), n)
    n_words, n_cjk = np.bincount(word_doc, minlength=n).astype(float), per_doc(cjk)
    latin, cyrillic = per_doc(kind == _LATIN), per_doc(kind == _CYRILLIC)
    language = np.full(n, LANGS.index("other"))
    is_latin = latin > np.maximum(2 * n_cjk, cyrillic)
    language[is_latin] = np.where(matches["fr"] > matches["en"], LANGS.index("fr"), LANGS.index("en"))[is_latin]
    language[cyrillic > np.maximum(2 * n_cjk, latin)] = LANGS.index("ru")
    language[(n_cjk * 2 >= np.maximum(latin, cyrillic)) & (n_cjk > 0)] = LANGS.index("zh")
    found = np.choose(language, [per_doc(zh_common), matches["en"], matches["ru"], matches["fr"], np.maximum.reduce(list(matches.values()))])
    base = np.where(language == 0, n_cjk, n_words)
    word_chars = per_doc(letters)
    prose_line = (stops > 0) | (length >= 60)
    indent = (first - starts > 0) if len(starts) else np.zeros(0, bool)
    longest = np.zeros(n)
    np.maximum.at(longest, doc_of[keep], inked[keep].astype(float))
    out = np.column_stack([
        np.diff(offsets) - 1, lines, mean, of_lines(ends_well) / safe_lines, of_lines(stops > 0) / safe_lines, per_doc(on["clause"]) / safe, per_doc(stop_inside) / safe, per_doc(digit) / safe,
        per_doc(mark) / safe, latin / safe, found / np.maximum(base, 1), (word_chars + n_cjk) / np.maximum(n_words + n_cjk, 1), of_lines(marker) / safe_lines, of_lines(separators) / safe_lines,
        per_doc(on["colon"]) / safe_lines, per_doc(tight) / safe_lines, per_doc(in_long) / safe, per_doc(code_mark) / safe, spread, of_lines(length < 30) / safe_lines, per_doc(nav) / safe_lines,
        per_doc(dots) / safe_lines, of_lines(prose_line * inked) / safe, per_doc(number_start) / safe_lines, n_words + n_cjk, per_doc(doubled_mark) / safe,
        of_lines(separators >= 2) / safe_lines, of_lines(indent) / safe_lines, longest / safe, n_cjk / safe,
    ])
    out[total == 0, 1:] = 0
    return language, out


@cache
def _lower() -> np.ndarray:
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x530):
        if len(x := chr(c).lower()) == 1:
            table[c] = ord(x)
    return table


def buckets(values: np.ndarray) -> np.ndarray:
    """The sketch's bucket of each value (0 and more): 0 for 0, else by its logarithm."""
    return np.where(values <= 1e-6, 0, np.ceil(np.log(np.maximum(values, 1e-6) * 1e6) / np.log1p(BUCKET))).astype(np.int32)


def measured(docs: DataFrame, common: list[tuple[str, str]], id_col: str = "id", text: str = "text") -> DataFrame:
    """id, lang, stats (array, as STATS) of every row. common: the function words, a table of fixed size."""

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            language, values = statistics(batch.column(1), common)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, len(STATS), dtype=np.int32)), pa.array(values.reshape(-1)))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(LANGS)[language]), lists], ["id", "lang", "stats"])

        return run

    kind = docs.schema[id_col].dataType.simpleString()
    return vec.map_steps(docs.select(docs[id_col].alias("id"), docs[text].alias("text")), make, f"id {kind}, lang string, stats array<double>")


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), len(STATS))


def sketches(stats: DataFrame) -> DataFrame:
    """lang, stat, bucket, n: the mergeable sketches of measured() rows, texts with no ink left out. Add n to merge."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column(1))
            language = np.array([LANGS.index(x) for x in batch.column(0).to_pylist()])
            inked = values[:, 1] > 0
            values, language = values[inked], language[inked]
            if not len(values):
                continue
            key = (language[:, None] * len(STATS) + np.arange(len(STATS))[None, :]) * 100_000 + buckets(values)
            distinct, n = np.unique(key, return_counts=True)
            group = distinct // 100_000
            yield pa.RecordBatch.from_arrays([pa.array(np.array(LANGS)[group // len(STATS)]), pa.array((group % len(STATS)).astype(np.int32)), pa.array((distinct % 100_000).astype(np.int32)), pa.array(n)], ["lang", "stat", "bucket", "n"])

    parts = stats.select("lang", "stats").mapInArrow(run, "lang string, stat int, bucket int, n bigint")
    return parts.groupBy("lang", "stat", "bucket").agg(F.sum("n").alias("n"))


class Scale:
    """The percentiles and robust z-scores of each statistic in each language, from collected sketches."""

    def __init__(self, rows: list):
        self.tables = {}
        by = {}
        for lang, stat, bucket, n in rows:
            by.setdefault((lang, stat), []).append((bucket, n))
        for key, pairs in by.items():
            pairs.sort()
            edge, n = np.array([b for b, _ in pairs]), np.array([c for _, c in pairs], float)
            self.tables[key] = edge, (np.cumsum(n) - n / 2) / n.sum() * 100

    def z_scores(self, lang: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Distance from the median in half-widths of the middle 68 %, on a signed logarithmic scale; 0 without a sketch.

        Where the middle has no width, a bucket's counts.
        """
        out = np.zeros(values.shape)
        b = buckets(values)
        for name in np.unique(lang):
            own = np.flatnonzero(lang == name)
            for k in range(values.shape[1]):
                if (name, k) in self.tables:
                    edge, rank = self.tables[name, k]
                    low, middle, high = np.interp((16, 50, 84), rank, edge)
                    out[own, k] = (b[own, k] - middle) / max((high - low) / 2, 10.0)
        return np.sign(out) * np.log1p(np.abs(out))

    def percentiles(self, lang: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The percentile (mid rank, 0 to 100) of each value; 50 where the language has no sketch."""
        out = np.full(values.shape, 50.0)
        b = buckets(values)
        for name in np.unique(lang):
            own = np.flatnonzero(lang == name)
            for k in range(values.shape[1]):
                if (name, k) in self.tables:
                    edge, rank = self.tables[name, k]
                    out[own, k] = np.interp(b[own, k], edge, rank)
        return out


def _inputs(z: np.ndarray, percentile: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Model inputs: the percentile band and the robust z-score of each statistic, and the language; no value as it is."""
    band = np.searchsorted(CUTS, percentile)
    hot = np.zeros((len(z), len(STATS) * (len(CUTS) + 1)))
    hot[np.arange(len(z))[:, None], np.arange(len(STATS)) * (len(CUTS) + 1) + band] = 1
    return np.concatenate([hot, z, np.maximum(z, 0), (lang[:, None] == np.array(LANGS)[None, :]).astype(float), np.ones((len(z), 1))], 1)


def train(x: np.ndarray, y: np.ndarray, classes: int, penalty: float = 1.0, rounds: int = 300) -> np.ndarray:
    """Weights of a multinomial logistic regression by accelerated gradient steps; deterministic."""
    w = np.zeros((x.shape[1], classes))
    goal = np.eye(classes)[y]
    v = np.ones(x.shape[1])
    for _ in range(12):  # the largest eigenvalue of x'x, by power steps
        v = x.T @ (x @ (v / np.linalg.norm(v)))
    rate = 1.0 / (0.55 * np.linalg.norm(v) + penalty)
    ahead, pace = w, 1.0
    for _ in range(rounds):
        z = x @ ahead
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        new = ahead - rate * (x.T @ (p - goal) + penalty * ahead)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, w, pace = new + (pace - 1) / faster * (new - w), new, faster
    return w


def fit(rows: list[tuple[str, list[float], str]], scale: Scale) -> np.ndarray:
    """Weights from labelled rows (lang, stats, kind), however few: a kind without any is never named, without labels all is prose."""
    rows = [r for r in rows if r[2] in KINDS and r[1][1] > 0]
    lang, values, y = np.array([r[0] for r in rows], object), np.array([r[1] for r in rows]).reshape(-1, len(STATS)), np.array([KINDS.index(r[2]) for r in rows], np.int64)
    weights = train(_inputs(scale.z_scores(lang, values), scale.percentiles(lang, values), lang), y, len(KINDS)) if rows else np.zeros((_inputs(values, values, lang).shape[1], len(KINDS)))
    for k in range(len(KINDS)):
        if k not in y:
            weights[:, k], weights[-1, k] = 0, -1e6 if k or len(y) else 0
    return weights


def classify(lang: np.ndarray, values: np.ndarray, scale: Scale, weights: np.ndarray) -> np.ndarray:
    """Index in KINDS of each row."""
    return (_inputs(scale.z_scores(lang, values), scale.percentiles(lang, values), lang) @ weights).argmax(1)


def scored(docs: DataFrame, labels: DataFrame, common: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """id, lang, kind (null for null and blank texts), stats and percentiles (arrays as STATS) of every distinct id.

    The statistics are written once, to the shared checkpoint folder; sketches, training and scoring read them there.
    Only the sketches (at most languages x statistics x buckets rows) and MOST_LABELS labelled rows reach the driver.
    """
    vec.shared_dir(docs.sparkSession)
    words = [(r[0], r[1]) for r in common.select("lang", "word").distinct().orderBy("lang", "word").collect()]
    stats = measured(docs, words, id_col, text).checkpoint()
    scale = Scale(sketches(stats).collect())
    sample = labels.where(F.col("kind").isin(*KINDS)).select(F.col("id").alias("__id"), "kind").orderBy(F.xxhash64("__id"), "kind").limit(MOST_LABELS)
    known = stats.join(sample, stats["id"] == sample["__id"]).select("id", "lang", "stats", "kind").dropDuplicates(["id"]).orderBy("id").collect()
    weights = fit([(r["lang"], r["stats"], r["kind"]) for r in known], scale)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, values = np.array(batch.column(1).to_pylist()), _matrix(batch.column(2))
            kinds = np.array(KINDS, object)[classify(lang, values, scale, weights)]
            kinds[values[:, 1] == 0] = None
            ranks = scale.percentiles(lang, values)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, ranks.size + 1, len(STATS), dtype=np.int32)), pa.array(ranks.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kinds, pa.string()), batch.column(2), lists], ["id", "lang", "kind", "stats", "percentiles"])

    kind = docs.schema[id_col].dataType.simpleString()
    return stats.mapInArrow(run, f"id {kind}, lang string, kind string, stats array<double>, percentiles array<double>")
