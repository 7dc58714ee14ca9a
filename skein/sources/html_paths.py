"""Rows chosen by a path through a page's elements (SRC7, SRC9), as a Spark job.

``select_rows`` takes a path such as ``//div[@id='report']//table//tr[5]//table//tr``:
``/`` is a child, ``//`` a descendant, ``*`` any element, ``[@name='value']`` an
attribute, ``[n]`` the n-th element of its name among its siblings. The path
runs while the page is parsed: an open element carries the set of steps that
it, and the elements around it, have reached (bit masks), so a page is read
once and no tree is built.

Elements left open close as browsers close them (cells, rows, sections and
list items); an end tag never closes an element outside its own table.
``imply_tbody`` puts a ``tbody`` around rows that stand in a table directly, as a
browser's document has it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skein.session import ship_package

# Fixed values of the format: elements without content, and which open elements a start tag ends (up to which).
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "li": ("li",), "option": ("option",),
        "thead": ("td", "th", "tr", *SECTIONS), "tbody": ("td", "th", "tr", *SECTIONS), "tfoot": ("td", "th", "tr", *SECTIONS)}
WITHIN = {"td": "tr", "th": "tr", "tr": "table", "li": "list", "option": "select", "thead": "table", "tbody": "table", "tfoot": "table"}
OUT_PAGES = 64

ROW_TYPE = ("struct<row_no:int,row_pos:int,table_no:int,depth:int,container:string,cells:array<string>,"
            "cell_divs:array<int>,cell_spans:array<int>,n_div:int,n_span:int>")
_ROW_ARROW = pa.struct([("row_no", pa.int32()), ("row_pos", pa.int32()), ("table_no", pa.int32()), ("depth", pa.int32()),
                        ("container", pa.string()), ("cells", pa.list_(pa.string())), ("cell_divs", pa.list_(pa.int32())),
                        ("cell_spans", pa.list_(pa.int32())), ("n_div", pa.int32()), ("n_span", pa.int32())])

_STEP = re.compile(r"(//?)([\w*-]+)((?:\[[^\]]*\])*)")
_TEST = re.compile(r"""\[(?:@([\w-]+)=['"]([^'"]*)['"]|([0-9]+))\]""")


@dataclass(frozen=True)
class Step:
    child: bool
    tag: str
    attrs: tuple[tuple[str, str], ...]
    nth: int | None

    def takes(self, tag: str, attrs: dict, nth: int) -> bool:
        return self.tag in ("*", tag) and self.nth in (None, nth) and all(attrs.get(k) == v for k, v in self.attrs)


def steps_of(path: str) -> tuple[Step, ...]:
    """The steps of a path; a path that is not wholly made of steps is an error."""
    found = _STEP.findall(path)
    tests = [_TEST.findall(t) for _, _, t in found]
    if not found or "".join("".join(x) for x in found) != path or any(len(x) != t.count("[") for x, (_, _, t) in zip(tests, found, strict=True)):
        raise ValueError(f"not a path: {path!r}")
    return tuple(Step(axis == "/", tag.lower(), tuple((k.lower(), v) for k, v, n in own if not n), next((int(n) for _, _, n in own if n), None))
                 for (axis, tag, _), own in zip(found, tests, strict=True))


class _Open:
    """An open element: the steps it reached, those reached around it, and what it collects."""

    __slots__ = ("tag", "at", "above", "children", "row", "cell", "table_no", "container")

    def __init__(self, tag: str, at: int, above: int, table_no: int | None, container: str | None):
        self.tag, self.at, self.above = tag, at, above
        self.table_no, self.container = table_no, container
        self.children: dict[str, int] = {}
        self.row = self.cell = None


class RowSelector(HTMLParser):
    """Collects the elements that a path selects, with their cells."""

    def __init__(self, steps: Sequence[Step], cell_tags: Sequence[str], direct: bool, imply_tbody: bool):
        super().__init__(convert_charrefs=True)
        self.steps, self.cell_tags, self.direct, self.imply_tbody = steps, frozenset(cell_tags), direct, imply_tbody
        self.stack = [_Open("", 0, 0, None, None)]
        self.rows: list[dict] = []
        self.tables = self.raw = 0

    def _close(self, tags: Sequence[str], within: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag == "table" or tag == within or within == "list" and tag in ("ul", "ol"):
                break
            if tag in tags:
                del self.stack[i:]  # an outer one of them may be open too

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.raw += 1
            return
        if tag in ENDS:
            self._close(ENDS[tag], WITHIN[tag])
        if tag == "tr" and self.imply_tbody and self.stack[-1].tag == "table":
            self.handle_starttag("tbody", [])
        around, named = self.stack[-1], {k: v or "" for k, v in attrs}
        nth = around.children[tag] = around.children.get(tag, 0) + 1
        at = 0
        for k, step in enumerate(self.steps):
            reached = (around.at if step.child else around.above) >> (k - 1) & 1 if k else not step.child or len(self.stack) == 1
            if reached and step.takes(tag, named, nth):
                at |= 1 << k
        new = _Open(tag, at, around.above | at, around.table_no, named.get("id") or around.container)
        if tag == "table":
            new.table_no, self.tables = self.tables, self.tables + 1
        if tag in ("div", "span"):
            for x in self.stack:
                for counted in (x.row, x.cell):
                    if counted is not None:
                        counted[tag] += 1
        if tag in self.cell_tags:
            rows = [x.row for x in self.stack if x.row is not None]
            if self.direct:
                rows = [around.row] if around.row is not None else []
            if rows:
                new.cell = {"text": [], "div": 0, "span": 0}
                for row in rows:
                    row["cells"].append(new.cell)
        if at >> (len(self.steps) - 1):
            depth = sum(x.tag == "table" for x in self.stack)
            new.row = {"row_pos": nth, "table_no": new.table_no, "depth": depth, "container": around.container, "cells": [], "div": 0, "span": 0}
            self.rows.append(new.row)
        if tag not in VOID:
            self.stack.append(new)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("script", "style"):
            self.stack.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.raw = max(0, self.raw - 1)
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return
            if self.stack[i].tag == "table":
                return

    def handle_data(self, data: str) -> None:
        if not self.raw:
            for x in self.stack:
                if x.cell is not None:
                    x.cell["text"].append(data)

    def selected(self, html: str) -> list[dict]:
        self.feed(html)
        self.close()
        return [{"row_no": i, "row_pos": r["row_pos"], "table_no": r["table_no"], "depth": r["depth"], "container": r["container"],
                 "cells": ["".join(c["text"]) for c in r["cells"]], "cell_divs": [c["div"] for c in r["cells"]],
                 "cell_spans": [c["span"] for c in r["cells"]], "n_div": r["div"], "n_span": r["span"]} for i, r in enumerate(self.rows)]


def select_rows(pages: DataFrame, path: str, id_col: str = "page_id", html_col: str = "html", cell_tags: Sequence[str] = ("td",),
                direct: bool = False, imply_tbody: bool = False) -> DataFrame:
    """The elements of each page that ``path`` selects, in document order: one row a page, ``id_col`` and ``rows``.

    A selected row has its number, its position among its siblings, the number
    of its table and how deep it is nested, the id of the nearest element around
    it that has one (``container``), its cells' texts and counts of ``div`` and
    ``span``. Cells are all ``cell_tags`` elements below it, a nested table's cells
    beside the cell that holds them, or with ``direct`` its children only.

    ``id_col`` keeps its type. Pages without a match have no rows; a page whose
    html is null has none either.
    """
    steps = steps_of(path)
    keep = pages.select(id_col, F.col(html_col).cast("string").alias(html_col))
    key = keep.schema[id_col]
    schema = pa.schema([(id_col, to_arrow_type(key.dataType)), ("rows", pa.list_(_ROW_ARROW))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_PAGES):
                part = batch.slice(at, OUT_PAGES)
                rows = [RowSelector(steps, cell_tags, direct, imply_tbody).selected(html) if html is not None else []
                        for html in part.column(html_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(id_col).cast(schema.field(0).type), pa.array(rows, pa.list_(_ROW_ARROW))], schema=schema)

    ship_package(pages.sparkSession)
    return keep.mapInArrow(run, f"`{id_col}` {key.dataType.simpleString()}, rows array<{ROW_TYPE}>")
