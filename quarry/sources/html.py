"""HTML topics: articles as page events, contents files and link trees as outlines."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.fields import EVENTS
from ..operators.matching import preorder

#: Classes of the articles' parts, elements that are dropped, and those without an end tag.
ARTICLE, SYNTAX, TABLES, CODE = "articleBoxWithoutHead", "cliformat", "cliparam", "cliexample"
DROPPED = frozenset("script style link iframe object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset("p div li ul ol dl dt dd h1 h2 h3 h4 h5 h6 tr table pre br section article blockquote caption".split())
KEYWORD, VARIABLE = ("cmdname", "keyword"), ("varname", "parmname")
STEP, HEIGHT, WIDE = 20.0, 10.0, 6.0


class Article(HTMLParser):
    """Reads an article's lines and tables; each line is a paragraph of its own, each line of an example one too."""

    def __init__(self, boxed: bool):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, frozenset[str]]] = []
        self.boxed = boxed
        self.out: list[tuple[str, object]] = []
        self.line: list[tuple[str, int, float, str]] = []
        self.rows: list[list[str]] | None = None
        self.headings: list[str] = []
        self.title: str | None = None

    def within(self, name: str) -> bool:
        return any(name in classes for _, classes in self.stack)

    def inside(self, *tags: str) -> bool:
        return any(tag in tags for tag, _ in self.stack)

    @property
    def open(self) -> bool:
        return (self.within(ARTICLE) if self.boxed else self.inside("body")) and not self.inside(*DROPPED)

    def end_line(self) -> None:
        shown = "".join(t for t, *_ in self.line).strip()
        if shown:
            self.out.append(("line", self.line))
            if any(size == 16.0 for _, _, size, _ in self.line) and self.title is None:
                self.title = " ".join(shown.split())
            if any(size == 13.0 for _, _, size, _ in self.line):
                self.headings.append(" ".join(shown.split()))
        self.line = []

    def handle_starttag(self, tag, attrs):
        if tag in BREAKS and self.open and self.rows is None:
            self.end_line()
        if tag == "img" and self.open:
            self.handle_data(dict(attrs).get("alt") or "[Image unavailable]")
        if tag in VOID:
            if tag == "br" and self.rows and self.rows[-1]:
                self.rows[-1][-1] += "\n"
            return
        if tag == "table" and self.open and self.rows is None:
            self.rows = []
        if self.rows is not None and tag == "tr":
            self.rows.append([])
        if self.rows and tag in ("td", "th"):
            self.rows[-1].append("")
        self.stack.append((tag, frozenset((dict(attrs).get("class") or "").split())))

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.stack):
            return
        if tag in BREAKS and tag != "table" and self.open and self.rows is None:
            self.end_line()
        while self.stack.pop()[0] != tag:
            pass
        if tag == "table" and self.rows is not None and not self.inside("table"):
            rows = [[c.strip() for c in r] for r in self.rows if r]
            self.rows = None
            if self.within(TABLES):
                self.out.append(("table", rows))
            else:
                self.out += [("line", [(" | ".join(" ".join(c.split()) for c in r), 0, 10.0, "Times")]) for r in rows]

    def handle_data(self, data):
        if not self.open:
            return
        if self.rows is not None:
            if self.rows and self.rows[-1]:
                self.rows[-1][-1] += data
            elif data.strip():
                self.out.append(("line", [(" ".join(data.split()), 0, 10.0, "Times")]))
            return
        if self.within(CODE) and self.inside("pre"):
            for i, part in enumerate(data.split("\n")):
                if i:
                    self.end_line()
                if part:
                    self.line.append((part, 8, 10.0, "Courier"))
            return
        data = re.sub(r"\s+", " ", data)
        if not data.strip() and not self.line:
            return
        if self.inside("h1"):
            self.line.append((data, 16, 16.0, "Times"))
        elif self.inside("h2"):
            self.line.append((data, 16, 13.0, "Times"))
        else:
            bold = self.inside("b", "strong") or any(self.within(k) for k in KEYWORD)
            plain = self.inside("i", "em") or any(self.within(k) for k in VARIABLE)
            self.line.append((data, 16 if bold and not plain else 2 if plain else 0, 10.0, "Times"))


def article(html: str) -> Article:
    """The parsed article; ValueError if it has no title."""
    a = Article(re.search(rf'class\s*=\s*["\'][^"\']*\b{ARTICLE}\b', html) is not None)
    a.feed(html if re.search("<body", html, re.I) else f"<body>{html}</body>")
    a.close()
    a.end_line()
    if a.title is None:
        raise ValueError("an article needs a title (h1)")
    return a


def article_events(doc_id: str, number: int, html: str) -> Iterator[tuple]:
    """The events of one topic, on a page of its own number; its title is headed by `1.number`."""
    y, titled = 60.0, False
    for ord_, (kind, value) in enumerate(article(html).out):
        y += STEP
        if kind == "table":
            yield (doc_id, number, ord_, "table", None, 50.0, y, 500.0, y + HEIGHT, None, value)
            continue
        if not titled and value[0][2] == 16.0:
            value, titled = [(f"1.{number} ", 16, 16.0, "Times"), *value], True
        x, spans = 50.0, []
        for t, flags, size, font in value:
            spans.append((t, flags, size, font, x, x + WIDE * len(t)))
            x = spans[-1][5]
        yield (doc_id, number, ord_, "line", "".join(s[0] for s in spans), 50.0, y, x, y + HEIGHT, spans, None)


def topic_events(topics: DataFrame) -> DataFrame:
    """The events of HTML topics (doc_id, number, html), ready for parsing with the profile of rendered topics.

    Null pages give nothing; a page without a title is an error that names it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.strip().split()[0] for c in re.split(r",(?![^<]*>)", EVENTS)]
        for b in batches:
            for d, n, h in zip(b["doc_id"], b["number"], b["html"], strict=True):
                if h is not None:
                    try:
                        rows = list(article_events(d, int(n), h))
                    except ValueError as e:
                        raise ValueError(f"{d}, topic {n}: {e}") from e
                    spans = ("text", "flags", "size", "font", "x0", "x1")
                    rows = [(*r[:9], None if r[9] is None else [dict(zip(spans, s, strict=True)) for s in r[9]], r[10]) for r in rows]
                    yield pd.DataFrame(rows, columns=names)

    return topics.select(F.col("doc_id").cast("string"), "number", "html").mapInPandas(run, EVENTS)


def is_command_topic(html: Column) -> Column:
    """Whether a page describes a command: it has both a function's and a syntax's part."""
    has = lambda name: html.rlike(rf"""(?i)class\s*=\s*["'][^"']*\b{name}\b""")
    return has("clifunc") & has(SYNTAX)


class Contents(HTMLParser):
    """Reads a contents file: (depth, title, local, params) of its sitemap objects."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth = 0
        self.object: dict[str, str] | None = None
        self.entries: list[tuple[int, str, str | None]] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "ul":
            self.depth += 1
        elif tag == "object" and (a.get("type") or "").casefold() == "text/sitemap":
            self.object = {}
        elif tag == "param" and self.object is not None and a.get("name"):
            self.object.setdefault(a["name"].casefold(), a.get("value") or "")

    def handle_endtag(self, tag):
        if tag == "ul":
            self.depth -= 1
        elif tag == "object" and self.object is not None:
            if self.object.get("name"):
                self.entries.append((self.depth, self.object["name"], self.object.get("local")))
            self.object = None


def contents_entries(files: DataFrame) -> DataFrame:
    """doc_id, ord, depth, title, local of contents files (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for d, t in zip(b["doc_id"], b["text"], strict=True):
                c = Contents()
                c.feed(t or "")
                yield pd.DataFrame([(d, n, depth, title, local) for n, (depth, title, local) in enumerate(c.entries)], columns=["doc_id", "ord", "depth", "title", "local"])

    return files.select("doc_id", "text").mapInPandas(run, "doc_id string, ord int, depth int, title string, local string")


def subtree(entries: DataFrame, start: Column) -> DataFrame:
    """The entry where `start` first holds and all below it, in each document; none where it never holds."""
    by = Window.partitionBy("doc_id")
    e = entries.withColumn("__first", F.min(F.when(start, F.struct("ord", "depth"))).over(by))
    after = (F.col("ord") > F.col("__first.ord")) & (F.col("depth") <= F.col("__first.depth"))
    e = e.withColumn("__end", F.min(F.when(after, F.col("ord"))).over(by))
    return e.filter((F.col("ord") >= F.col("__first.ord")) & (F.col("__end").isNull() | (F.col("ord") < F.col("__end")))).drop("__first", "__end")


def topics_of(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """The command topics of contents in order, each page once, numbered from 1.  pages: doc_id, path, html."""
    e = entries.filter("local IS NOT NULL").withColumn("path", F.regexp_replace(F.regexp_replace("local", r"[#?].*$", ""), r"\\", "/"))
    e = e.groupBy("doc_id", "path").agg(F.min("ord").alias("ord"), F.min_by("title", "ord").alias("title"))
    e = e.join(pages.filter(is_command_topic(F.col("html"))), ["doc_id", "path"])
    return e.withColumn("number", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))).select("doc_id", "number", "path", "title", "html")


def resolved(directory: str, link: str) -> str | None:
    """The path that a link on a page of the directory leads to; None if it leads out of the root or to another host."""
    u = urlsplit(link)
    if u.scheme or u.netloc:
        return None
    path = posixpath.normpath(posixpath.join(directory, unquote(u.path)))
    return None if path.startswith(("..", "/")) else path


def tree_topics(children: DataFrame, roots: DataFrame, pages: DataFrame) -> DataFrame:
    """node, pos, depth, command of the pages that roots reach by links; a command with children is an error.

    children: parent, ord, child; roots: ord, node; pages: path, html.
    """
    parents = children.select(F.col("parent").alias("node")).distinct().withColumn("__parent", F.lit(True))
    d = preorder(children, roots).join(pages.select(F.col("path").alias("node"), is_command_topic(F.col("html")).alias("command")), "node").join(parents, "node", "left")
    bad = F.col("command") & F.coalesce("__parent", F.lit(False))
    return d.withColumn("command", F.when(bad, F.raise_error(F.concat(F.lit("a command has topics below it: "), "node")).cast("boolean")).otherwise(F.col("command"))).drop("__parent")
