"""Documents to chunks: units are read off a text, packed to a target length, and cut where one is too long.

The scanning of one text is sequential by nature, so it runs in Arrow batches; every document stays in its task and
nothing is shuffled. A null text counts as ''. Lengths are raw, or without white space where a policy says so.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame

from .. import lexicons

_SPACE = re.compile(r"\s+")
_BLANKS = re.compile(r"[ \t　]+")


def ink(text: str) -> int:
    """Length without white space."""
    return len(_SPACE.sub("", text))


@dataclass(frozen=True)
class ChunkPolicy:
    """min, target and max characters; ends: the signs after which a long unit may be cut."""

    min_chars: int = 80
    target_chars: int = 900
    max_chars: int = 1800
    ends: str = lexicons.SENTENCE_ENDS


@dataclass
class Unit:
    """A piece of text with what it carries along: a section, a heading path, or a range of pages."""

    text: str
    context: tuple = ()


def cut_long(text: str, policy: ChunkPolicy, size: Callable[[str], int] = ink) -> list[str]:
    """Pieces of at most max_chars by size: sentences are gathered greedily, a sentence beyond the limit is sliced.

    By raw size (len) sentences are trimmed and an oversized one is gathered first and sliced after; by ink it interrupts
    the gathering, and slices have max_chars raw characters.
    """
    if size(text) <= policy.max_chars:
        return [text]
    parts = [s.strip() for s in re.split(f"(?<=[{policy.ends}])", text)]
    runs: list[list[str]] = [[]]
    used = 0
    for part in filter(None, parts):
        n = size(part)
        if runs[-1] and used + n > policy.max_chars:
            runs.append([])
            used = 0
        if size is not len and n > policy.max_chars:
            if runs[-1]:
                runs.append([])
                used = 0
            runs[-1:] = [[part[i : i + policy.max_chars]] for i in range(0, len(part), policy.max_chars)] + [[]]
            continue
        runs[-1].append(part)
        used += n
    joined = [t for t in ("".join(r).strip() for r in runs) if t]
    if size is len:
        return [t[i : i + policy.max_chars] for t in joined or [text] for i in range(0, len(t), policy.max_chars)]
    return joined


def pack_raw(parts: Iterable[str], policy: ChunkPolicy) -> list[str]:
    """Paragraphs joined by a blank line, each charged two characters for it, until the target is reached."""
    out: list[list[str]] = [[]]
    used = 0
    for piece in (p for part in parts for p in cut_long(part, policy, len)):
        if out[-1] and used + len(piece) + 2 > policy.max_chars:
            out.append([])
            used = 0
        out[-1].append(piece)
        used += len(piece) + 2
        if used >= policy.target_chars:
            out.append([])
            used = 0
    return [t for t in ("\n\n".join(x).strip() for x in out) if len(t) >= policy.min_chars]


def pack_units(units: Iterable[Unit], policy: ChunkPolicy, merge: Callable[[tuple, tuple], tuple | None]) -> Iterator[Unit]:
    """Units joined by a line feed until the target is reached. merge gives the context of two units together, or None

    if they may not be joined; what is pending is then passed on, or dropped if it is shorter than min_chars.
    """
    held: Unit | None = None
    for unit in units:
        if held is None:
            held = Unit(unit.text, unit.context)
            if ink(unit.text) < policy.min_chars:
                continue
        else:
            both = merge(held.context, unit.context)
            joined = f"{held.text}\n{unit.text}".strip()
            if both is None or ink(joined) > policy.max_chars:
                if ink(held.text) >= policy.min_chars:
                    yield held
                held = Unit(unit.text, unit.context)
            else:
                held = Unit(joined, both)
        if ink(held.text) >= policy.target_chars:
            if ink(held.text) >= policy.min_chars:
                yield held
            held = None
    if held and ink(held.text) >= policy.min_chars:
        yield held


def first_section(a: tuple, b: tuple) -> tuple:
    return a if a and a[0] is not None else b


def common_path(a: tuple, b: tuple) -> tuple | None:
    """The headings that two paths share; None where there are none."""
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) if a else len(b)
    path = b[:n] if not a else a[:n]
    return path or None


def page_span(a: tuple, b: tuple) -> tuple:
    return (a[0], b[1])


def speaker_turns(text: str) -> list[str]:
    """The prefix and one unit for each speaker, if two at least are marked; else nothing."""
    at = [m.start() for m in re.finditer(lexicons.SPEAKERS, text)]
    if len(at) < 2:
        return []
    return [t for t in (text[a:b].strip() for a, b in zip([0, *at], [*at, len(text)], strict=True)) if t]


def _section(line: str) -> bool:
    return len(line) <= 80 and (bool(re.match(lexicons.CHAPTER, line) or re.match(lexicons.PAREN_NUMBER, line)) or line in lexicons.SECTION_WORDS)


def plain_units(text: str) -> Iterator[Unit]:
    """Paragraphs of plain text between blank lines, with their section; headings and tables of contents aren't text."""
    section: str | None = None
    contents = False
    block: list[str] = []

    def take() -> list[Unit]:
        body = "\n".join(block).strip()
        block.clear()
        return [Unit(t, (section,)) for t in speaker_turns(body) or ([body] if body else [])]

    for line in [*(x.strip() for x in text.splitlines()), ""]:
        heading = bool(line) and _section(line)
        if not line or line == "目录" or heading and not contents:
            yield from take()
        if line == "目录":
            contents = True
        elif heading:
            section, contents = line, False
        elif line and not contents:
            block.append(line)


def wiki_units(text: str) -> Iterator[Unit]:
    """What stands between headings of the form '## title', with the heading before it."""
    section: str | None = None
    block: list[str] = []
    for line in [*(_BLANKS.sub(" ", x).strip() for x in text.splitlines()), None]:
        m = re.match(r"^##+\s*(.+?)\s*#*$", line) if line else None
        if line is None or m:
            body = "\n".join(block).strip()
            block.clear()
            if body:
                yield Unit(body, (section,))
            if m:
                section = m.group(1).strip()
        elif line:
            block.append(line)


def heading_level(title: str, level: int, depth: int) -> int:
    """The level of a Markdown heading: by its own numbering, else its marks, but below what it would close."""
    ranks = ((lexicons.MD_CHAPTER, 1), (lexicons.MD_SECTION, 2), *zip(lexicons.MD_LEVELS, (3, 4, 5), strict=True))
    for pattern, rank in ranks:
        if re.match(pattern, title):
            return rank
    return min(depth + 1 if depth and level <= depth else level, 6)


def markdown_line(line: str) -> str:
    line = re.sub(r"\[([^\]]+)\]\([^)]+\)", r"\1", re.sub(r"!\[[^\]]*\]\([^)]+\)", "", line))
    return _BLANKS.sub(" ", re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "", re.sub(r"<[^>]+>", "", line))).strip()


def markdown_units(text: str) -> Iterator[Unit]:
    """Paragraphs of Markdown with their heading path; fenced code is left out."""
    path: list[str] = []
    block: list[str] = []
    fenced = False
    for raw in [*text.splitlines(), None]:
        line = "" if raw is None else raw.rstrip()
        if line.strip().startswith("```"):
            fenced = not fenced
            continue
        if fenced and raw is not None:
            continue
        m = re.match(r"^(#{1,6})\s+(.+?)\s*$", line)
        plain = "" if m else markdown_line(line)
        if m or not plain or re.fullmatch(r"[-*_]{3,}", plain):
            body = "\n".join(block).strip()
            block.clear()
            if body:
                yield Unit(body, tuple(path))
            if m and (title := markdown_line(m.group(2))):
                path[heading_level(title, len(m.group(1)), len(path)) - 1 :] = [title]
        else:
            block.append(plain)


def page_units(pages: Iterable[tuple[int, str]], keep_author: bool = False) -> Iterator[Unit]:
    """Paragraphs of (page, text): furniture, metadata and sentence ends divide them, blank lines don't; all after the

    references is left out.
    """
    cut = False
    for page, text in pages:
        block: list[str] = []

        def take(block=block, page=page) -> list[Unit]:
            body = ""
            for line in block:
                if body.endswith("-") and re.match("[A-Za-z]", line):
                    body = body[:-1] + line
                elif not body or re.search("[，,、（(“\"《：:；;]$", body) or re.search("[一-鿿]$", body) and re.match("[一-鿿A-Za-z0-9]", line):
                    body += line
                else:
                    body += "\n" + line
            block.clear()
            return [Unit(body, (page, page))] if body.strip() else []

        for raw in text.splitlines() if not cut else ():
            line = _BLANKS.sub(" ", re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "", raw)).strip().replace("ﬁ", "fi").replace("ﬂ", "fl")
            inline = re.search(lexicons.PDF_REFERENCES_INLINE, line)
            if inline or not keep_author and re.match(lexicons.PDF_AUTHOR, line):
                cut = True
                head = line[: inline.start()].strip() if inline else ""
                if head:
                    block.append(head)
                break
            if not line:
                continue
            if any(re.search(p, line) for p in lexicons.PDF_NOISE):
                yield from take()
            elif re.match(lexicons.PDF_METADATA, line):
                yield from take()
                yield Unit(line, (page, page))
            else:
                block.append(line)
                if line[-1] in "。！？!?":
                    yield from take()
        yield from take()
        if cut:
            return


def chunk_plain(text: str, policy: ChunkPolicy = ChunkPolicy(60)) -> list[tuple[str, str | None]]:
    """(chunk, section) of plain text; a text that gives none but is long enough is cut as it is."""
    packed = [(part, u.context[0]) for u in pack_units(plain_units(text), policy, first_section) for part in cut_long(u.text, policy)]
    kept = [p for p in packed if ink(p[0]) >= policy.min_chars]
    return kept or [(part, None) for part in cut_long(text, policy) if ink(text) >= policy.min_chars and ink(part) >= policy.min_chars]


def chunk_wiki(text: str, policy: ChunkPolicy = ChunkPolicy(180, 900, 1600, "。！？!?")) -> list[tuple[str, str | None]]:
    return [(part, u.context[0]) for u in pack_units(wiki_units(text), policy, first_section) for part in cut_long(u.text, policy) if ink(part) >= policy.min_chars]


def chunk_markdown(text: str, policy: ChunkPolicy = ChunkPolicy(), merge_small: bool = True) -> list[tuple[str, str | None]]:
    """(chunk, heading path) of Markdown. Without headings, paragraphs are never joined."""
    units = list(markdown_units(text))
    if merge_small:
        units = [x for x in pack_units(units, policy, common_path)]
    return [(part, " > ".join(u.context) or None) for u in units for part in cut_long(u.text, policy) if ink(part) >= policy.min_chars]


def chunk_documents(df: DataFrame, split: Callable[[str], list[tuple[str, str | None]]], id_col: str = "id", text: str = "text") -> DataFrame:
    """doc_id, id, chunk_index (from 1), text, section, char_count (without white space) of the chunks of each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32())
        names = ("doc_id", "id", "chunk_index", "text", "section", "char_count")
        for batch in batches:
            rows = []
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(key, f"{key}#{k:05d}", k, t, s, ink(t)) for k, (t, s) in enumerate(split(body or ""), 1)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))

    return df.select(df[id_col].cast("string").alias("id"), df[text].alias("text")).mapInArrow(run, "doc_id string, id string, chunk_index int, text string, section string, char_count int")


def chunk_raw(text: str, policy: ChunkPolicy = ChunkPolicy()) -> list[tuple[str, str | None]]:
    """Chunks of cleaned text by raw length: paragraphs of 20 characters, packed with blank lines between them."""
    parts = re.split(r"\n\s*\n", text)
    if len(parts) == 1:
        parts = re.split(r"\n+", text)
    return [(t, None) for t in pack_raw([p.strip() for p in parts if len(p.strip()) >= 20], policy)]


def page_title(source: str, units: list[Unit]) -> str:
    """The file's name without its ending, else the first of eight paragraphs that may be one: of 4 to 120 characters, no metadata."""
    stem = _BLANKS.sub(" ", re.sub(r"\.[^./]*$", "", source.rsplit("/", 1)[-1])).strip()
    fit = (u.text for u in units[:8] if ink(u.text) >= 4 and not re.match(lexicons.PDF_METADATA, u.text) and len(u.text) <= 120)
    return stem or next(fit, "")


def chunk_pages(pages: DataFrame, policy: ChunkPolicy = ChunkPolicy(), keep_author: bool = False) -> DataFrame:
    """id, source, title, chunk_index, text, page_start, page_end, char_count of (source, page_no, text).

    Pages meet by source in the order of page_no and stream through their task: units are packed as they come, so that a
    source, however long, is never held as a whole. Null texts are empty pages, a null source is a source of its own.
    """
    names = ("id", "source", "title", "chunk_index", "text", "page_start", "page_end", "char_count")
    kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32())

    def chunks(source: str | None, rows: Iterable[tuple]) -> Iterator[tuple]:
        units = page_units(((page, text or "") for _, page, text in rows), keep_author)
        ahead = list(islice(units, 8))
        title, k = page_title(source or "", ahead), 0
        for u in pack_units(chain(ahead, units), policy, page_span):
            for part in cut_long(u.text, policy):
                if ink(part) >= policy.min_chars:
                    k += 1
                    yield f"{source or ''}#{k:05d}", source, title, k, part, *u.context, ink(part)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        found = (c for source, own in groupby(rows, lambda r: r[0]) for c in chunks(source, own))
        while some := list(islice(found, 1000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], list(names))

    placed = pages.select("source", "page_no", "text").repartition("source").sortWithinPartitions("source", "page_no", "text")
    return placed.mapInArrow(run, "id string, source string, title string, chunk_index int, text string, page_start int, page_end int, char_count int")
