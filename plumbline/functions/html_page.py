"""The one place where Python runs inside tasks: reading a single HTML page.

Spark has no HTML functions, and patterns cannot follow nested tables, open
tags or entities. ``read_page`` feeds one page to the standard library's
tolerant parser and notes text, images, tables, structured data, titles and the
link to the next page on the way; no document tree is kept.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Collection
from html.parser import HTMLParser

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("base link meta noscript script style template title".split())
INVISIBLE = ("script", "style", "template", "rt", "rp")  # and noscript
JSON_LD = "application/ld+json"

_RUN_OF_BLANKS = re.compile(r"\s{2,}")


class _Span:
    """A stretch of one of the page's lists, open until ``end`` is set."""

    __slots__ = ("start", "end")

    def __init__(self, start: int) -> None:
        self.start, self.end = start, -1


class _Row:
    """A table row: its header cells and its cells are stretches of all cells, inner tables' cells included."""

    __slots__ = ("table", "heads", "cells")

    def __init__(self, table: _Span, heads: int, cells: int) -> None:
        self.table, self.heads, self.cells = table, _Span(heads), _Span(cells)


class _Page(HTMLParser):
    """Collects what the operators ask for while the tags go by.

    Text, cells and rows are kept once, in page order. A cell is a stretch of the texts, a
    row one of the cells, a table one of the rows, so tables within tables cost no copies.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.words: list[tuple[bool, str]] = []  # (in the head?, text between two tags)
        self.images: list[tuple[str, str]] = []
        self.tables: list[_Span] = []  # of rows
        self.rows: list[_Row] = []
        self.heads: list[_Span] = []  # of words
        self.cells: list[_Span] = []  # of words
        self.json_ld: list[str] = []
        self.title: list[str] | None = None
        self.description: str | None = None
        self.headings: list[list[str]] = []
        self.next_link: tuple[str] | None = None
        self._open: list[tuple[str, bool]] = []  # (tag, is it the list item of the next link?)
        self._depth: dict[str, int] = {}  # open elements per tag
        self._in_head = True
        self._noscript = 0
        self._text: list[str] = []
        self._open_tables: list[_Span] = []
        self._open_rows: list[_Row] = []
        self._open_cells: list[tuple[_Row, _Span]] = []
        self._heading: list[str] | None = None
        self._in_title = False
        self._script_type: str | None = None

    # Text is gathered until the next tag or comment, as one piece.
    def handle_data(self, data: str) -> None:
        self._text.append(data)

    def handle_comment(self, data: str) -> None:
        self._end_text()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)  # <![...]> is a comment in HTML, whatever it says

    def _end_text(self) -> None:
        if not self._text:
            return
        raw = "".join(self._text)
        self._text = []
        inside = self._open[-1][0] if self._open else ""
        if inside == "script" and self._script_type == JSON_LD and not self._noscript:
            self.json_ld.append(raw)
        piece = raw.strip()
        if not piece or self._noscript or any(self._depth.get(tag) for tag in INVISIBLE):
            return
        if self._in_title:
            self.title.append(piece)
        elif self._in_head:
            self._in_head = False
        self.words.append((self._in_head, piece))
        if self._heading is not None:
            self._heading.append(piece)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_text()
        values: dict[str, str] = {}
        for name, value in attrs:
            values.setdefault(name, value or "")
        if tag not in HEAD and tag not in ("html", "head"):
            self._in_head = False
        if tag == "noscript":
            self._noscript += 1
        if not self._noscript:
            self._note(tag, values)
        if tag not in VOID:
            if tag == "li" and self._open and self._open[-1][0] == "li":
                self._pop()
            self._open.append((tag, tag == "li" and "next" in values.get("class", "").split()))
            self._depth[tag] = self._depth.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash of <div/>

    def _note(self, tag: str, values: dict[str, str]) -> None:
        if tag == "img":
            self.images.append((values.get("src", ""), values.get("alt", "").strip()))
        elif tag == "script":
            self._script_type = values.get("type")
        elif tag == "title" and self.title is None:
            self.title, self._in_title = [], True
        elif tag == "meta" and self.description is None and values.get("name") == "description":
            self.description = values.get("content", "")
        elif tag == "h1":
            self._heading = []
            self.headings.append(self._heading)
        elif tag == "a" and self.next_link is None and self._open and self._open[-1][1]:
            self.next_link = (values.get("href", ""),)
        elif tag == "table":
            self.tables.append(_Span(len(self.rows)))
            self._open_tables.append(self.tables[-1])
        elif tag == "tr" and self._open_tables:
            self._close_rows(self._open_tables[-1])
            self.rows.append(_Row(self._open_tables[-1], len(self.heads), len(self.cells)))
            self._open_rows.append(self.rows[-1])
        elif tag in ("td", "th") and self._open_rows and self._open_rows[-1].table is self._open_tables[-1]:
            self._close_cells(self._open_rows[-1])
            cell = _Span(len(self.words))
            self._open_cells.append((self._open_rows[-1], cell))
            (self.cells if tag == "td" else self.heads).append(cell)

    def _close_cell(self) -> None:
        self._open_cells.pop()[1].end = len(self.words)

    def _close_cells(self, row: _Row) -> None:
        while self._open_cells and self._open_cells[-1][0] is row:
            self._close_cell()

    def _close_rows(self, table: _Span) -> None:
        while self._open_rows and self._open_rows[-1].table is table:
            row = self._open_rows.pop()
            self._close_cells(row)
            row.heads.end, row.cells.end = len(self.heads), len(self.cells)

    def _close_table(self) -> None:
        table = self._open_tables.pop()
        self._close_rows(table)
        table.end = len(self.rows)

    def _pop(self) -> str:
        name, _ = self._open.pop()
        self._depth[name] -= 1
        return name

    def handle_endtag(self, tag: str) -> None:
        self._end_text()
        if tag == "noscript":
            self._noscript = max(0, self._noscript - 1)
        elif tag == "head":
            self._in_head = False
        elif tag == "title":
            self._in_title = False
        elif tag == "h1":
            self._heading = None
        elif tag in ("td", "th") and self._open_cells:
            self._close_cell()
        elif tag == "tr" and self._open_tables:
            self._close_rows(self._open_tables[-1])
        elif tag == "table" and self._open_tables:
            self._close_table()
        if self._depth.get(tag):
            while self._pop() != tag:
                pass

    def close(self) -> None:
        super().close()
        self._end_text()
        while self._open_tables:
            self._close_table()
        while self._open_cells:
            self._close_cell()


def _text(page: _Page, with_head: bool) -> str:
    pieces = [piece for in_head, piece in page.words if with_head or not in_head]
    return _RUN_OF_BLANKS.sub(" ", " ".join(pieces)).strip()


def _images(page: _Page) -> list[dict[str, str]]:
    return [{"src": src, "alt": alt} for src, alt in page.images if src and not src.startswith("data:")]


def _tables(page: _Page) -> list[list[dict[str, str]]]:
    size = lambda span: span.end - span.start
    # Rows by number of cells: a record has as many cells as its table has names.
    rows_of: dict[int, list[int]] = {}
    for i, row in enumerate(page.rows):
        rows_of.setdefault(size(row.cells), []).append(i)

    def texts(cells: list[_Span], span: _Span) -> list[str]:
        return ["".join(piece for _, piece in page.words[c.start : c.end]) for c in cells[span.start : span.end]]

    result = []
    for table in page.tables:
        if not size(table):
            continue
        head = page.rows[table.start]
        cells, names = (page.heads, head.heads) if size(head.heads) else (page.cells, head.cells)
        fitting = rows_of.get(size(names), [])
        wanted = fitting[bisect_left(fitting, table.start + 1) : bisect_left(fitting, table.end)]
        if wanted and size(names):
            keys = texts(cells, names)
            result.append([dict(zip(keys, texts(page.cells, page.rows[i].cells))) for i in wanted])
    return result


def _json_ld(page: _Page) -> list[str]:
    """One text per block: lists are flattened, what is no JSON is left out, what is too deep or long stays as written."""
    blocks: list[str] = []
    for text in page.json_ld:
        try:
            data = json.loads(text)
            found = data if isinstance(data, list) else [data] if isinstance(data, dict) else []
            blocks += [json.dumps(block, ensure_ascii=False) for block in found]
        except json.JSONDecodeError:
            continue
        except (ValueError, RecursionError):
            blocks.append(text.strip())
    return blocks


def read_page(html: str, with_head: bool = False, fields: Collection[str] | None = None) -> dict[str, object]:
    """What the page operators need from one page: the named fields, or all."""
    page = _Page()
    page.feed(html)
    page.close()
    visible = _text(page, with_head)
    makers = {
        "text": lambda: visible,
        "images": lambda: _images(page),
        "tables": lambda: _tables(page),
        "json_ld": lambda: _json_ld(page),
        "title": lambda: "".join(page.title or []),
        "description": lambda: page.description or "",
        "h1s": lambda: ["".join(heading) for heading in page.headings],
        "word_count": lambda: len(visible.split()),
        "next_link": lambda: (page.next_link[0] or None) if page.next_link else None,
    }
    return {name: make() for name, make in makers.items() if fields is None or name in fields}
