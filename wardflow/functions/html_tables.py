"""Tables of web pages as a browser reads them.

A scan over the tags that matter to tables keeps a stack of open tables.  End tags may be missing: a new cell, row or section closes what was
open.  A table inside a cell is a table of its own, and its text is no part of that cell.  The module is sent to executors by value.
"""

from __future__ import annotations

import html
import re
import sys
from dataclasses import dataclass, field

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The greatest spans that the HTML standard allows.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.I | re.S)
TAG = re.compile(r"""<(/?)(table|thead|tbody|tfoot|tr|td|th|caption|br|p|div|li)\b((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.I)
ANY_TAG = re.compile(r"""</?[a-zA-Z!?](?:[^>"']|"[^"]*"|'[^']*')*>""")
SECTIONS = ("thead", "tbody", "tfoot")


@dataclass
class Cell:
    header: bool
    rows: int
    columns: int
    text: list[str] = field(default_factory=list)

    def plain(self) -> str:
        return re.sub(r"\s+", " ", html.unescape("".join(self.text))).strip()


@dataclass
class Table:
    number: int
    inside: int | None
    #: Rows as (section, cells).
    rows: list[tuple[str, list[Cell]]] = field(default_factory=list)
    section: str = "tbody"
    row: list[Cell] | None = None
    cell: Cell | None = None

    def open_row(self) -> list[Cell]:
        self.cell, self.row = None, []
        self.rows.append((self.section, self.row))
        return self.row

    def sections(self) -> list[tuple[str, list[list[Cell]]]]:
        """Head, body and foot; without a head of its own, the rows of header cells at the top are the head."""
        parts = {s: [cells for part, cells in self.rows if part == s] for s in SECTIONS}
        if not parts["thead"]:
            body = parts["tbody"]
            n = next((i for i, cells in enumerate(body) if not all(c.header for c in cells)), len(body))
            parts["thead"], parts["tbody"] = body[:n], body[n:]
        return list(parts.items())

    def grid(self):
        """(section, row, column, header, text), a span's text in every place that it covers; rows that only a span reaches follow the section."""
        number = 0
        for section, rows in self.sections():
            reaching: dict[int, tuple[int, Cell]] = {}
            rows = list(rows)
            while rows or reaching:
                cells = rows.pop(0) if rows else []
                places, later, column = {}, {}, 0
                for at, (left, cell) in reaching.items():
                    places[at] = cell
                    if left > 1:
                        later[at] = (left - 1, cell)
                for cell in cells:
                    while column in places:
                        column += 1
                    for at in range(column, column + cell.columns):
                        if at not in places:
                            places[at] = cell
                            if cell.rows > 1:
                                later[at] = (cell.rows - 1, cell)
                    column += cell.columns
                for at in sorted(places):
                    yield section[1:], number, at, places[at].header, places[at].plain()
                reaching = later
                number += 1


def _span(attributes: str, name: str, most: int) -> int:
    found = re.search(rf"""(?:^|\s){name}\s*=\s*["']?\s*([0-9]+)""", attributes, re.I)
    return min(max(int(found[1]), 1), most) if found else 1


def tables(page: str) -> list[Table]:
    """All tables of a page, in the order in which they begin."""
    page, out, stack, at = HIDDEN.sub("", page), [], [], 0
    for tag in TAG.finditer(page):
        if stack and stack[-1].cell:
            stack[-1].cell.text.append(ANY_TAG.sub("", page[at : tag.start()]))
        at, closes, name, top = tag.end(), bool(tag[1]), tag[2].lower(), stack[-1] if stack else None
        if name == "table" and not closes:
            out.append(Table(len(out), top.number if top else None))
            stack.append(out[-1])
        elif top is None:
            continue
        elif name == "table":
            stack.pop()
        elif name in SECTIONS:
            top.section, top.row, top.cell = "tbody" if closes else name, None, None
        elif name == "tr":
            top.row, top.cell = None, None
            if not closes:
                top.open_row()
        elif name in ("td", "th"):
            top.cell = None
            if not closes:
                row = top.row if top.row is not None else top.open_row()
                top.cell = Cell(name == "th", _span(tag[3], "rowspan", MOST_ROWS), _span(tag[3], "colspan", MOST_COLUMNS))
                row.append(top.cell)
        elif name == "caption":
            top.cell = None
        elif top.cell and not closes:
            top.cell.text.append("\n")
    if stack and stack[-1].cell:
        stack[-1].cell.text.append(ANY_TAG.sub("", page[at:]))
    return out


def grid_rows(pages: list[str | None]):
    """(page index, table, enclosing table, section, row, column, header, text) of each cell."""
    for i, page in enumerate(pages):
        for t in tables(page or ""):
            for cell in t.grid():
                yield (i, t.number, t.inside, *cell)
