"""Main text of HTML pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .files import as_documents

#: Elements without text of their own, and elements that never close.
DROPPED = frozenset("script style nav footer header aside form noscript".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEAST_CHARS = 20
_OPEN = re.compile(r"&(?!#[0-9]+;|#[xX][0-9a-fA-F]+;)([a-zA-Z][a-zA-Z0-9]*;)?")


class _Node:
    __slots__ = ("tag", "attrs", "parts")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.parts = tag, attrs, []


class _Tree(HTMLParser):
    """A forgiving tree: an end tag closes the nearest open element of its name."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs))
        self.open[-1].parts.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].parts.append(_Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def _find(node: _Node, test) -> _Node | None:
    todo = [node]
    while todo:
        at = todo.pop()
        if at.tag in DROPPED:
            continue
        if at.tag and test(at):
            return at
        todo.extend(p for p in reversed(at.parts) if isinstance(p, _Node))
    return None


def _texts(node: _Node) -> Iterator[str]:
    todo: list = [node]
    while todo:
        at = todo.pop()
        if isinstance(at, str):
            yield at
        elif at.tag not in DROPPED:
            todo.extend(reversed(at.parts))


def without_open_references(html: str) -> str:
    """``html`` where only references that end in a semicolon, and are known, count as such."""
    return _OPEN.sub(lambda m: m[0] if m[1] in html5 else f"&amp;{m[1] or ''}", html)


def main_text(html: str | None, open_references: bool = True) -> str | None:
    """Texts of the main element, joined by line ends (white space not yet normal).

    A reference without its semicolon, as where a title was cut within ``&amp;``, counts
    as in browsers; without ``open_references`` it stays as it is written.
    """
    if html is None:
        return None
    tree = _Tree()
    tree.feed(html if open_references else without_open_references(html))
    tree.close()
    tests = (
        lambda n: n.tag == "main", lambda n: n.tag == "article", lambda n: n.attrs.get("role") == "main",
        lambda n: n.attrs.get("id") == "content", lambda n: n.tag == "body",
    )
    for test in tests:
        if (found := _find(tree.root, test)) is not None:
            return "\n".join(_texts(found))
    return "\n".join(_texts(tree.root))


def extract_main_content(html: Column | str, open_references: bool = True) -> Column:
    @F.pandas_udf("string")
    def extracted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda page: main_text(page, open_references))

    return tx.normalize_whitespace(extracted(tx.col(html)))


def strip_markup(html: Column | str) -> Column:
    """The fallback without a parser: tags go, script bodies stay."""
    return tx.normalize_whitespace(tx.strip_html_tags(html))


def page_documents(
    pages: DataFrame, *, url: str = "url", body: str = "html", kind: str = "documentation", format: str = "html", category: str = "uncategorized",
    framework: str | None = None, author: str | None = None, parser: bool = True, open_references: bool = True,
) -> DataFrame:
    """Documents of fetched pages; those under 20 letters are dropped.

    URLs that end in .md or .mdx are Markdown, whatever ``format`` says; formats other
    than markdown and html give no documents.
    """
    markdown = F.col(url).endswith(".md") | F.col(url).endswith(".mdx") | F.lit(format == "markdown")
    rows = pages if format in ("markdown", "html") else pages.where(markdown)
    html = extract_main_content(body, open_references) if parser else strip_markup(body)
    out = rows.withColumn("text", F.when(markdown, tx.normalize_whitespace(body)).otherwise(html))
    out = out.where(F.length(tx.strip("text")) >= LEAST_CHARS)
    return as_documents(
        out.select(
            tx.document_id(F.lit(kind), url).alias("document_id"), "text", F.lit(kind).alias("source"), F.lit(author).alias("author"), F.lit(category).alias("category"),
            F.lit(framework).alias("framework"), F.col(url).alias("url"),
        )
    )
