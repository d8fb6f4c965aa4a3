"""Paragraphs of HTML and EPUB documents.

Every ``p`` and ``div`` with text gives a paragraph in document order: its text nodes, each stripped, joined by one space. A ``p``
inside a ``div`` therefore shows up twice.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = ("p", "div")


class _Paragraphs(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[list[str]] = []
        self.open: list[tuple[str, list[str] | None]] = []
        self.quiet = 0

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        if tag == "p":  # a paragraph ends where the next one begins
            while any(t == "p" for t, _ in self.open):
                self._close_top()
        parts = None
        if tag in BLOCKS:
            parts = []
            self.found.append(parts)
        self.open.append((tag, parts))
        self.quiet += tag in ("script", "style")

    def _close_top(self):
        tag, _ = self.open.pop()
        self.quiet -= tag in ("script", "style")

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.open):
            while self.open[-1][0] != tag:
                self._close_top()
            self._close_top()

    def handle_data(self, data):
        text = data.strip()
        if text and not self.quiet:
            for _, parts in self.open:
                if parts is not None:
                    parts.append(text)


def html_paragraphs(html: str | None) -> list[str]:
    parser = _Paragraphs()
    parser.feed(html or "")
    parser.close()
    return [" ".join(p) for p in parser.found if p]


def epub_paragraphs(content: bytes) -> list[str]:
    """Paragraphs of the documents of an EPUB, in the order of its spine if it has one."""
    import posixpath
    import re

    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in z.namelist() if n.lower().endswith((".xhtml", ".html", ".htm"))]
        for opf in [n for n in z.namelist() if n.lower().endswith(".opf")]:
            text = z.read(opf).decode("utf-8", "replace")
            items = {}
            for tag in re.findall(r"<(?:\w+:)?item\b[^>]*>", text):
                i, href = re.search(r'\bid="([^"]*)"', tag), re.search(r'\bhref="([^"]*)"', tag)
                if i and href:
                    items[i[1]] = posixpath.normpath(posixpath.join(posixpath.dirname(opf), href[1]))
            spine = [items.get(r) for r in re.findall(r'<(?:\w+:)?itemref\b[^>]*\bidref="([^"]*)"', text)]
            ordered = [s for s in spine if s in names]
            names = ordered + [n for n in names if n not in ordered]
        return [p for n in names for p in html_paragraphs(z.read(n).decode("utf-8", "replace"))]


def _explode(df: DataFrame, key: str, column: str, split) -> DataFrame:
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, v in zip(pdf[key], pdf[column], strict=True):
                try:
                    rows += [(k, i, p, "ok") for i, p in enumerate(split(v))]
                except Exception as e:  # noqa: BLE001
                    rows.append((k, None, None, f"error:{type(e).__name__}"))
            out = pd.DataFrame(rows, columns=[key, "para_idx", "text", "parse_status"])
            out["para_idx"] = out["para_idx"].astype("Int64")
            yield out

    return df.select(key, column).mapInPandas(run, f"{key} {kind}, para_idx bigint, text string, parse_status string")


def paragraphs_of_html(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, para_idx, text, parse_status) rows."""
    return _explode(df, key, html, html_paragraphs)


def paragraphs_of_epubs(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("path_book"), "content")
    return _explode(files, "path_book", "content", epub_paragraphs)
