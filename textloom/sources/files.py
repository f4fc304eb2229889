"""Readers of Markdown chapters, TeX pages, HTML blocks, chapter lists and page surveys."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import as_markdown, u
from ..operators import tables

KINDS = ("h1", "p", "b", "li")


def markdown_chapters(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, title, body) of each Markdown file but index.md: the first ``# `` line or the file's stem, and what follows the first rule line."""
    d = spark.read.text(path, wholetext=True).select("value", F.regexp_extract("_metadata.file_path", r"([^/]+)\.[^./]*$", 1).alias("doc_id"))
    title = F.coalesce(F.nullif(F.regexp_extract("value", r"(?m)^# (.+)$", 1), F.lit("")), F.col("doc_id"))
    at = F.instr("value", "\n---\n")
    body = F.when(at > 0, F.substring("value", at + 5, F.length("value"))).otherwise(F.col("value"))
    return d.where("doc_id <> 'index'").select("doc_id", title.alias("title"), body.alias("body"))


def chapter_links(text: DataFrame, column: str = "value") -> DataFrame:
    """(nth, title, href) of the ``| [title](href) |`` rows of an index page."""
    pattern = r"\|\s*\[([^\]]+)\]\(([^)]+)\)\s*\|"
    both = F.arrays_zip(F.regexp_extract_all(column, F.lit(pattern), 1).alias("title"), F.regexp_extract_all(column, F.lit(pattern), 2).alias("href"))
    return text.select(F.posexplode(both).alias("nth", "x")).select((F.col("nth") + 1).alias("nth"), "x.title", "x.href")


def tex_pages(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """(doc_id, page_ix, leaf, folio, line_ix, raw, brk): the lines of each page environment; brk is nl after a whole word, cc after a broken one, pf at a paragraph's end, null on a page's last line. low and high bound the leaf before lines are made."""
    d = spark.read.text(path, wholetext=True).select("value", F.regexp_extract("_metadata.file_path", r"([^/]+)\.[^./]*$", 1).alias("doc_id"))
    page = r"(?s)\\begin\{VUpage\}\[([^\]]*)\]\{([^}]*)\}(.*?)\\end\{VUpage\}"
    parts = F.arrays_zip(*[F.regexp_extract_all("value", F.lit(page), i).alias(n) for i, n in enumerate(("leaf", "folio", "body"), 1)])
    d = d.select("doc_id", F.posexplode(parts).alias("page_ix", "p")).select("doc_id", "page_ix", "p.*")
    if low is not None or high is not None:
        d = d.where(F.col("leaf").try_cast("int").between(low if low is not None else -(1 << 31), high if high is not None else (1 << 31) - 1))
    marked = F.regexp_replace(F.regexp_replace(F.regexp_replace("body", r"\n[ \t]*\n\s*", "\u0001pf\u0002"), r"\\nl\b[ \t]*\n?", "\u0001nl\u0002"), r"\\cc\b[ \t]*\n?", "\u0001cc\u0002")
    lines = F.filter(F.split(marked, "\u0002"), lambda x: F.regexp_replace(x, "\u0001..$", "").rlike(r"\S"))
    d = d.select("doc_id", "page_ix", "leaf", "folio", F.posexplode(lines).alias("line_ix", "x"))
    return d.select("doc_id", "page_ix", "leaf", "folio", "line_ix", F.trim(F.regexp_replace(F.regexp_replace("x", "\u0001..$", ""), "\n", " ")).alias("raw"), F.nullif(F.regexp_extract("x", "\u0001(..)$", 1), F.lit("")).alias("brk"))


class Blocks(HTMLParser):
    """Blocks of a page: the text of each element of the wanted kinds, in the order they open; script, style and comments are left out, an element that is not closed ends where the next of its kind opens or its container closes."""

    def __init__(self, kinds: tuple[str, ...]) -> None:
        super().__init__(convert_charrefs=True)
        self.kinds, self.skip, self.open, self.out = kinds, 0, [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag in self.kinds:
            self._close(tag)
            self.open.append((tag, len(self.out)))
            self.out.append([tag, ""])

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in self.kinds:
            self._close(tag)
        elif tag in ("article", "body", "div", "ul"):
            self.open = []

    def _close(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if not self.skip:
            for _, at in self.open:
                self.out[at][1] += data


class Divisions(HTMLParser):
    """Where the divisions of the wanted classes lie in a page: (kind, data-ch, id, begin, end of what is inside). The first class counts; divisions inside one belong to it."""

    def __init__(self, kinds: tuple[str, ...]) -> None:
        super().__init__(convert_charrefs=False)
        self.kinds, self.depth, self.out = kinds, 0, []

    def read(self, html: str) -> list[tuple]:
        self.lines = [0, *(i + 1 for i, x in enumerate(html) if x == "\n")]
        self.feed(html)
        return [x for x in self.out if len(x) == 5]

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        if tag != "div":
            return
        a = dict(attrs)
        kind = next(iter((a.get("class") or "").split()), None)
        if self.depth:
            self.depth += 1
        elif kind in self.kinds:
            self.depth = 1
            self.out.append((kind, a.get("data-ch"), a.get("id"), self._at() + len(self.get_starttag_text())))

    def handle_startendtag(self, tag, attrs):
        """<div/> opens nothing."""

    def handle_endtag(self, tag):
        if tag == "div" and self.depth:
            self.depth -= 1
            if not self.depth:
                self.out[-1] += (self._at(),)


def class_blocks(pages: DataFrame, kinds: tuple[str, ...] = ("tit", "p", "noto"), page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, rank, kind, ch, id, text): the divisions of <main> (without one, of the page) whose first class is a kind, up to the end of the same depth, as Markdown. A division that is not closed is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                main = re.search(r"<main\b.*?</main>", h or "", re.S)
                h = main.group() if main else h or ""
                rows += [(i, rank, kind, ch, name, h[begin:end]) for rank, (kind, ch, name, begin, end) in enumerate(Divisions(kinds).read(h), 1)]
            names = [page, "rank", "kind", "ch", "id", "text"]
            kind = [pa.int64(), pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], x) for k, x in enumerate(kind)], names)

    d = pages.select(page, html).mapInArrow(run, f"{page} long, rank long, kind string, ch string, id string, text string")
    return d.withColumn("text", as_markdown(F.regexp_replace("text", "(?s)<!--.*?-->", "")))


class Searched(HTMLParser):
    """What a search looks at in a page: (kind, text) of the elements of the wanted classes, each with all the text inside it but that of the dropped classes' elements."""

    def __init__(self, kinds: tuple[str, ...], dropped: Callable[[list[str]], bool]) -> None:
        super().__init__(convert_charrefs=True)
        self.kinds, self.dropped, self.out = kinds, dropped, []
        self.stack: list[tuple[str, int | None, bool]] = []  # tag, the entry it opened, whether its text is dropped

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        classes = (dict(attrs).get("class") or "").split()
        kind = next((c for c in classes if c in self.kinds), None)
        self.stack.append((tag, len(self.out) if kind else None, tag in ("script", "style") or self.dropped(classes)))
        if kind:
            self.out.append([kind, ""])

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        for _, at, dropped in reversed(self.stack):  # what is dropped is so for all that lies around it
            if dropped:
                return
            if at is not None:
                self.out[at][1] += data


#: The classes a search looks at, and elements without an end.
SEARCHED = ("p", "tit", "cen", "rangi", "noto", "sub2", "fer", "avizo", "legendo")
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))


def _not_searched(classes: list[str]) -> bool:
    """Folio marks, and a table's rendering that stands there a second time."""
    return "fol" in classes or ("grupi" in classes and "sola" not in classes)


def searched_blocks(pages: DataFrame, kinds: tuple[str, ...] = SEARCHED, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, rank, kind, text): the blocks of a page that a search looks at, white space collapsed, without folio marks and doubled tables; empty ones take no rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                p = Searched(kinds, _not_searched)
                p.feed(h or "")
                p.close()
                found = [(k, " ".join(x.split())) for k, x in p.out if x.split()]
                rows += [(i, rank, k, x) for rank, (k, x) in enumerate(found, 1)]
            kind = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], x) for k, x in enumerate(kind)], [page, "rank", "kind", "text"])

    return pages.select(page, html).mapInArrow(run, f"{page} long, rank long, kind string, text string")


def by_name(files: DataFrame, name: str) -> DataFrame:
    """files (a list of them, one row each) with ``nth`` in the order of their names. Names are cut into ranges and counted inside each, with the number of those before."""
    d = files.repartitionByRange(name).withColumn("_p", F.spark_partition_id())
    d = tables.written(d, tables.folder(files.sparkSession, "names"))  # so that both sides see the same ranges
    own = d.groupBy("_p").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    w = Window.partitionBy("_p").orderBy(name)
    d = d.join(F.broadcast(own.select("_p", before.alias("_before"))), "_p")
    return d.withColumn("nth", (F.row_number().over(w) + F.col("_before")).cast("long")).drop("_p", "_before")


def parse_blocks(html: str, kinds: tuple[str, ...] = KINDS) -> list[tuple[str, str]]:
    p = Blocks(kinds)
    p.feed(html)
    p.close()
    return [(k, " ".join(t.split())) for k, t in p.out if t.split()]


def html_blocks(pages: DataFrame, kinds: tuple[str, ...] = KINDS, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, rank, kind, text). The markup is not well-formed, so a parser reads it, in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ranks, names, texts = [], [], [], []
            for i, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for rank, (kind, text) in enumerate(parse_blocks(h or "", kinds), 1):
                    ids.append(i)
                    ranks.append(rank)
                    names.append(kind)
                    texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ranks, pa.int64()), pa.array(names, pa.string()), pa.array(texts, pa.string())], [page, "rank", "kind", "text"])

    return pages.select(page, html).mapInArrow(run, f"{page} long, rank long, kind string, text string")


def without_scripts(c):
    """HTML without scripts, styles and comments; before any pattern looks at tags."""
    return F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>", ""), r"(?s)<!--.*?-->", "")


def index_rows(blocks: DataFrame) -> DataFrame:
    """Search rows: white space collapsed, empties out, with the lower-cased text that queries look at."""
    t = F.trim(F.regexp_replace("text", u(r"\s+"), " "))
    return blocks.withColumn("text", t).where("text <> ''").withColumn("lowered", F.lower("text"))


def leaf_survey(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """(leaf, folio, raw, nlines, skew) of JSON objects keyed by leaf, one a file or, with whole false, one a line."""
    schema = "map<string,struct<folio:int,raw:string,nlines:int,skew:double>>"
    d = spark.read.text(path, wholetext=whole).select(F.explode(F.from_json("value", schema)).alias("leaf", "x"))
    return d.select(F.col("leaf").cast("int").alias("leaf"), "x.*")


def folio_of(text, lines: int = 3):
    """The first number alone on one of the first lines that are not empty; null without."""
    head = F.slice(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"\S")), 1, lines)
    return F.try_element_at(F.filter(F.transform(head, lambda x: F.regexp_extract(x, r"^\s*(\d{1,3})\s*$", 1).try_cast("int")), lambda x: x.isNotNull()), F.lit(1))
