"""Visible text and links of HTML pages.

Two variants. ``parsed_page`` runs the standard library's HTML parser in Arrow
batches and copes with nesting, unclosed tags and all entities. ``native_text``
and ``native_hrefs`` are regular expressions inside the JVM for well-formed
pages; they decode the entities in ``NATIVE_ENTITIES`` only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from html import unescape
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import WHITESPACE, normalize_text

# Elements removed with everything inside them.
DROP_TAGS = (
    "script",
    "style",
    "noscript",
    "svg",
    "header",
    "footer",
    "nav",
    "form",
    "button",
    "input",
)
# Elements whose own text is not page text, though links in them count.
SILENT_TAGS = ("template", "rt", "rp")
# Elements that never have content.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)
# Entities the native variant decodes; ``amp`` has to stay last.
NATIVE_ENTITIES = {
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "nbsp": "\xa0",
    "copy": "©",
    "middot": "·",
    "amp": "&",
}


class _PageReader(HTMLParser):
    """Collects text runs and hrefs while keeping the stack of open elements."""

    def __init__(self, drop_tags: Sequence[str]) -> None:
        super().__init__(convert_charrefs=False)
        self._drop = frozenset(drop_tags)
        self._open: list[str] = []
        self._dropped_at: int | None = None
        self._body_at: int | None = None
        self.saw_body = False
        self.all_text: list[str] = []
        self.body_text: list[str] = []
        self.hrefs: list[str] = []

    def _write(self, piece: str) -> None:
        if self._dropped_at is None:
            self.all_text.append(piece)
            if self._body_at is not None:
                self.body_text.append(piece)

    def _text(self, piece: str) -> None:
        if not any(tag in SILENT_TAGS for tag in self._open):
            self._write(piece)

    def _enter(self, tag: str, attrs: list, stays_open: bool) -> None:
        self._write(" ")
        if self._dropped_at is None and tag not in self._drop:
            if tag == "a":
                self.hrefs.append(dict(attrs).get("href") or "")
            elif tag == "body" and not self.saw_body:
                self.saw_body = True
                self._body_at = len(self._open) if stays_open else None
        elif self._dropped_at is None and stays_open:
            self._dropped_at = len(self._open)
        if stays_open:
            self._open.append(tag)

    def handle_starttag(self, tag, attrs):
        self._enter(tag, attrs, tag not in VOID_TAGS)

    def handle_startendtag(self, tag, attrs):
        self._enter(tag, attrs, False)

    def handle_endtag(self, tag):
        self._write(" ")
        if tag in self._open:
            while self._open.pop() != tag:
                pass
            depth = len(self._open)
            if self._dropped_at is not None and depth <= self._dropped_at:
                self._dropped_at = None
            if self._body_at is not None and depth <= self._body_at:
                self._body_at = None

    def handle_data(self, data):
        self._text(data)

    def handle_entityref(self, name):
        self._text(html5.get(f"{name};", f"&{name}"))

    def handle_charref(self, name):
        self._text(unescape(f"&#{name};"))

    def unknown_decl(self, data):
        self._write(" ")
        if data.upper().startswith("CDATA["):
            self._text(data[6:])
            self._write(" ")

    def handle_comment(self, data):
        self._write(" ")

    handle_decl = handle_pi = handle_comment


_DECLARATION = re.compile(r"<!(?!--|\[CDATA\[)[^>]*(?:>|\Z)")


def _read(html: str, drop_tags: Sequence[str]) -> _PageReader:
    reader = _PageReader(drop_tags)
    reader.feed(html)
    reader.close()
    return reader


def read_page(html: str, url: str, drop_tags: Sequence[str] = DROP_TAGS) -> tuple[str, list[str]]:
    """Raw text (not normalized) and absolute hrefs of one page, in page order."""
    try:
        reader = _read(html, drop_tags)
    except AssertionError:
        # A markup declaration that the parser gives up on; browsers pass over it up to ">".
        reader = _read(_DECLARATION.sub(" ", html), drop_tags)
    links = []
    for href in map(str.strip, reader.hrefs):
        if href:
            try:
                links.append(urljoin(url, href))
            except ValueError:
                continue  # malformed host
    return "".join(reader.body_text if reader.saw_body else reader.all_text), links


def parsed_page(drop_tags: Sequence[str] = DROP_TAGS) -> Callable[[Column, Column], Column]:
    """Arrow-batched ``(html, url) -> struct<text, links>``; both parts from one parse."""
    drop = tuple(drop_tags)

    @F.pandas_udf("text string, links array<string>")
    def parse(html: pd.Series, url: pd.Series) -> pd.DataFrame:
        pages = [read_page(h or "", u or "", drop) for h, u in zip(html, url)]
        return pd.DataFrame(pages, columns=["text", "links"])

    return parse


def native_strip(html: Column, drop_tags: Sequence[str] = DROP_TAGS) -> Column:
    """Page source without comments and the dropped elements."""
    names = "|".join(drop_tags)
    return F.regexp_replace(
        html, rf"(?is)<({names})(?=[\s/>])[^>]*>.*?</\1\s*>|<!--.*?-->", " "
    )


def native_text(html: Column, drop_tags: Sequence[str] = DROP_TAGS) -> Column:
    """Normalized visible text, without leaving the JVM."""
    kept = native_strip(html, (*drop_tags, *SILENT_TAGS))
    body = F.regexp_extract(kept, r"(?is)<body(?=[\s/>])[^>]*>(.*?)(?:</body\s*>|\z)", 1)
    inner = F.when(kept.rlike(r"(?i)<body[\s/>]"), body).otherwise(kept)
    text = F.regexp_replace(inner, "(?s)<[A-Za-z/!?][^>]*>", " ")
    for name, character in NATIVE_ENTITIES.items():
        text = F.regexp_replace(text, f"&{name};?", character)
    return normalize_text(text)


def native_hrefs(html: Column, drop_tags: Sequence[str] = DROP_TAGS) -> Column:
    """Stripped, non-empty href values in page order, without leaving the JVM."""
    pattern = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
    quoted = F.regexp_extract_all(native_strip(html, drop_tags), F.lit(pattern), F.lit(1))
    bare = F.transform(
        quoted,
        lambda h: F.regexp_replace(h, rf"""^["']?[{WHITESPACE}]*|[{WHITESPACE}]*["']?\z""", ""),
    )
    return F.array_remove(bare, "")
