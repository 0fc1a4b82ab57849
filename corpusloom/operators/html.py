"""Articles from web pages: blocks, links, titles, dates, address rules. Pages are parsed in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicons
from ..functions import text as T
from ..functions.shared import shared_dir


@dataclass(frozen=True)
class PageRules:
    """blocks: tags whose text is a block; skipped: tags whose text is dropped; boilerplate: a block with one of these goes.

    titles: where a title is looked for, in order: names of meta values, 'page' (the title tag) and 'heading' (the first
    ``most_headings`` of them). site_names go from a title's end, with the sign before them and all that follows;
    generic_titles are none. dates, sources: names of meta values in order; the value is kept as it is written.
    """

    blocks: tuple[str, ...] = ("p", "li", "h1", "h2", "h3")
    headings: tuple[str, ...] = ("h1", "h2")
    skipped: tuple[str, ...] = ("script", "style", "noscript", "svg", "iframe")
    boilerplate: tuple[str, ...] = ("责任编辑", "版权所有", "扫一扫", "Copyright")
    titles: tuple[str, ...] = ("og:title", "twitter:title", "heading", "page")
    most_headings: int = 2
    site_names: tuple[str, ...] = lexicons.SITE_NAMES
    generic_titles: tuple[str, ...] = ()
    title_chars: int = 40
    dates: tuple[str, ...] = ("article:published_time", "pubdate", "publishdate", "publish_date", "date", "createdate")
    sources: tuple[str, ...] = ("source", "mediaid", "author")
    source_pattern: str = r"来源[:：]\s*([^<\n\r]{2,40})"
    default_source: str = ""
    min_block: int = 8
    min_body: int = 120
    distinct_blocks: bool = True


#: The rules for pages of several sites at once.
MANY_SITES = PageRules(
    titles=("og:title", "twitter:title", "title", "page", "heading"), most_headings=5, site_names=lexicons.MANY_SITE_NAMES, generic_titles=lexicons.GENERIC_TITLES, title_chars=50,
    dates=("article:published_time", "pubdate", "publishdate", "publish_date", "date", "createdate", "publish-time"), sources=("source", "mediaid", "author", "og:site_name"),
    source_pattern=r"(?:来源|稿件来源|信息来源)\s*[:：]\s*([^<\n\r]{2,60})",
)


class _Page(HTMLParser):
    """Collects blocks, headings, links, meta values and the title. A block that a new one interrupts is dropped."""

    def __init__(self, rules: PageRules):
        super().__init__(convert_charrefs=True)
        self.rules, self.open, self.hidden, self.in_title = rules, None, 0, False
        self.buffer: list[str] = []
        self.blocks: list[str] = []
        self.headings: list[str] = []
        self.links: list[str] = []
        self.meta: dict[str, str] = {}
        self.title = ""

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag in self.rules.skipped:
            self.hidden += 1
        elif tag == "meta" and (name := attrs.get("property") or attrs.get("name")):
            self.meta.setdefault(name.lower(), attrs.get("content") or "")
        elif tag == "a" and attrs.get("href"):
            self.links.append(attrs["href"])
        elif tag == "title":
            self.in_title = True
        elif tag == "br":
            self.buffer.append("\n")
        if tag in self.rules.blocks:
            self.open, self.buffer = tag, []

    def handle_endtag(self, tag):
        if tag in self.rules.skipped:
            self.hidden = max(0, self.hidden - 1)
        elif tag == "title":
            self.in_title = False
        elif tag == self.open:
            text = "\n".join(filter(None, (re.sub(r"[ \t　]+", " ", x).strip() for x in "".join(self.buffer).splitlines())))
            if text:
                (self.headings if tag in self.rules.headings else self.blocks).append(text)
            self.open, self.buffer = None, []

    def handle_data(self, data):
        if self.hidden:
            return
        if self.in_title:
            self.title += data
        elif self.open:
            self.buffer.append(data)


def _spaced(text: str) -> str:
    return "\n".join(filter(None, (re.sub(r"[ \t　]+", " ", x).strip() for x in text.splitlines())))


def _bare_title(title: str, rules: PageRules) -> str:
    """A title without the names of sites at its end; a hyphen within it stays."""
    for name in rules.site_names:
        title = re.sub(rf"\s*[-_—|]\s*{re.escape(name)}.*$", "", title)
    return title.strip(" -_|—")


def parse_page(html: str, url: str, rules: PageRules) -> dict:
    page = _Page(rules)
    page.feed(html)
    page.close()
    places = {"heading": page.headings[: rules.most_headings], "page": [page.title]}
    options = [_spaced(t) for k in rules.titles for t in places.get(k, [page.meta.get(k) or ""])]
    titles = [_bare_title(t, rules) for t in options if t]
    blocks = list(dict.fromkeys(page.blocks)) if rules.distinct_blocks else page.blocks
    title = next((t for t in titles if t not in rules.generic_titles and len(re.sub(r"\s", "", t)) >= 4), "")
    kept = [b for b in blocks if b != title and len(b) >= rules.min_block and not any(m in b for m in rules.boilerplate)]
    body = "\n\n".join(kept)
    date = next((page.meta[k].strip() for k in rules.dates if page.meta.get(k)), None)
    if date is None:
        date = m.group(0) if (m := re.search(lexicons.PAGE_DATE, html)) else ""
    source = next((_spaced(page.meta[k]) for k in rules.sources if page.meta.get(k)), None)
    if source is None:
        source = _spaced(m.group(1)) if (m := re.search(rules.source_pattern, html)) else rules.default_source
    links = [urldefrag(urljoin(url, x.strip()))[0] for x in page.links]
    return {"title": title or body.split("\n", 1)[0][: rules.title_chars], "publish_date": date, "source": source, "text": body, "links": list(dict.fromkeys(x for x in links if x.startswith(("http://", "https://"))))}


def articles(pages: DataFrame, rules: PageRules = PageRules()) -> DataFrame:
    """url, title, publish_date, source, text, links, is_article of (url, html). Null pages give empty values."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column(0).to_pylist()
            rows = [parse_page(h or "", u or "", rules) for u, h in zip(urls, batch.column(1).to_pylist(), strict=True)]
            column = lambda k, t=pa.string(), rows=rows: pa.array([r[k] for r in rows], t)
            yield pa.RecordBatch.from_arrays([batch.column(0), column("title"), column("publish_date"), column("source"), column("text"), column("links", pa.list_(pa.string()))], ["url", "title", "publish_date", "source", "text", "links"])

    out = pages.select("url", "html").mapInArrow(run, "url string, title string, publish_date string, source string, text string, links array<string>")
    return out.withColumn("is_article", T.text_length(F.col("text")) >= rules.min_body)


def normal_url(c: Column) -> Column:
    """Without fragment, scheme and host in lower case; null for what isn't http."""
    bare = F.regexp_replace(T.strip(c), "#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^(?i)(https?://[^/?]+)", 1))
    return F.when(host != "", F.concat(host, F.regexp_replace(bare, r"^(?i)https?://[^/?]+", "")))


def url_matches(c: Column, hosts: tuple[str, ...] = (), path_prefix: str = "", extensions: tuple[str, ...] = ()) -> Column:
    """Whether an address is on one of the hosts (or below), under the path, with one of the extensions."""
    host, path = F.lower(F.try_parse_url(c, F.lit("HOST"))), F.coalesce(F.try_parse_url(c, F.lit("PATH")), F.lit(""))
    ok = host.isNotNull()
    if hosts:
        ok = ok & (host.isin(*hosts) | F.lit(False if not hosts else True) & host.rlike(r"(?:^|\.)(?:" + "|".join(re.escape(h) for h in hosts) + ")$"))
    if path_prefix:
        ok = ok & path.startswith(path_prefix)
    if extensions:
        ok = ok & F.lower(path).rlike(r"\.(?:" + "|".join(extensions) + ")$")
    return F.coalesce(ok, F.lit(False))


def list_pages(seed: Column, pages: Column) -> Column:
    """The seed and index_2 .. index_n beside it, for a seed that ends in index.html or index.shtml."""
    stem, end = F.regexp_extract(seed, r"^(.*/index)(\.s?html)$", 1), F.regexp_extract(seed, r"^(.*/index)(\.s?html)$", 2)
    more = F.transform(F.sequence(F.lit(2), F.greatest(pages, F.lit(2))), lambda n: F.concat(stem, F.lit("_"), n.cast("string"), end))
    return F.when((stem != "") & (pages >= 2), F.concat(F.array(seed), more)).otherwise(F.array(seed))


def distinct_articles(df: DataFrame) -> DataFrame:
    """The first article (by url) of each text, of each url."""
    one = df.dropDuplicates(["url"]).withColumn("__h", F.sha1(F.encode("text", "UTF-8")))
    return one.withColumn("__n", F.row_number().over(Window.partitionBy("__h").orderBy("url"))).where("__n = 1").drop("__n", "__h")


def frontier(links: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """url, depth of what is reached over links (src, dst) from the seeds (url): breadth first, each url once.

    Each round is cut by a checkpoint in the shared folder.
    """
    shared_dir(links.sparkSession)
    reached = seeds.select("url", F.lit(0).alias("depth")).distinct().checkpoint()
    edge = reached
    for d in range(1, depth + 1):
        step = edge.join(links, edge["url"] == links["src"]).select(F.col("dst").alias("url")).distinct()
        edge = step.join(reached.select("url"), "url", "left_anti").withColumn("depth", F.lit(d)).checkpoint()
        reached = reached.unionByName(edge)
    return reached


def papers(df: DataFrame) -> DataFrame:
    """Articles of e-paper day files (paperInfo: array of pages, each with xyList: array of articles), pages padded to two digits."""
    page = df.select(F.explode("paperInfo").alias("p"))
    item = page.select("p.paperNumber", "p.paperName", F.explode("p.xyList").alias("a"))
    return item.select(F.lpad("paperNumber", 2, "0").alias("page"), "paperName", "a.*")


def rendered(title: Column, date: Column, source: Column, url: Column, body: Column) -> Column:
    """An article as a text file: a line for each field, a blank line, the body."""
    head = [F.concat(F.lit(f"{k}: "), F.coalesce(c, F.lit(""))) for k, c in (("title", title), ("date", date), ("source", source), ("url", url))]
    return F.concat_ws("\n", *head, F.lit(""), body)


def article_filename(date: Column, title: Column, url: Column) -> Column:
    """date_title_hash.txt"""
    return F.concat(F.coalesce(date, F.lit("undated")), F.lit("_"), T.safe_filename(title), F.lit("_"), F.substring(F.sha1(F.encode(url, "UTF-8")), 1, 10), F.lit(".txt"))
