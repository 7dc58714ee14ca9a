"""HTML pages -> tables, list items and form inputs, as a Spark job.

Input: a DataFrame of pages (``page_id``, ``html``). Each page is parsed in
one Python task by a small stdlib ``html.parser`` state machine inside
``mapInArrow`` (Arrow batches in and out). Output is one row per *table*
with its rows nested, so everything after the parse (picking the header row,
skipping rows, zipping header and cells) is row-local array work: no shuffle
and no join between a table's header and its body.

Parsing rules (lenient HTML):
* an open ``td``/``th`` is closed by the next cell, row, section or table end
  of the same table; an open ``tr`` by the next row or section;
* a cell's text includes the text of everything inside it (nested tables too),
  with character references decoded (``&nbsp;`` -> U+00A0);
* ``row_pos`` is the 1-based position of a row among its siblings
  (``tr:nth-of-type``); ``depth`` counts enclosing tables (outermost = 1);
* ``div``/``span`` starts are counted per row and per cell, at any depth;
* text inside ``script``/``style`` is not element text; ``</ul>``/``</ol>``
  closes an open ``li``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from skein.session import ship_package

_SECTIONS = {"thead", "tbody", "tfoot"}
# Output Arrow batches are cut at these sizes so a task never holds all of its output.
OUT_TABLES = 256
OUT_ITEMS = 8192
_CELLS = {"td", "th"}


class _Frame:
    __slots__ = ("tag", "kind", "info", "texts", "n_div", "n_span", "cells", "tr_count", "table")

    def __init__(self, tag, kind, table=None):
        self.tag, self.kind, self.table = tag, kind, table
        self.info = None
        self.texts = None
        self.n_div = self.n_span = 0
        self.cells = None
        self.tr_count = 0


class PageParser(HTMLParser):
    """Collects tables (with rows and cells), text of chosen elements and
    ``input`` attributes from one page."""

    def __init__(self, element_tags: Sequence[str] = (), want_tables: bool = True, want_inputs: bool = False):
        super().__init__(convert_charrefs=True)
        self.element_tags = set(element_tags)
        self.want_tables = want_tables
        self.want_inputs = want_inputs
        self.stack: list[_Frame] = []
        self.tables: list[dict] = []
        self.elements: list[tuple[str, str]] = []
        self.inputs: list[dict] = []
        self.in_raw = 0  # inside <script>/<style>: their text is not element text

    # -- helpers -------------------------------------------------------------------------------
    def _innermost(self, kinds, stop_at_table=True):
        for i in range(len(self.stack) - 1, -1, -1):
            f = self.stack[i]
            if f.kind in kinds:
                return i
            if stop_at_table and f.kind == "table":
                return -1
        return -1

    def _row_path(self):
        """(depth of its table, position) of every row around the place."""
        path, depth = [], 0
        for f in self.stack:
            if f.kind == "table":
                depth += 1
            elif f.kind == "tr":
                path.append((depth, f.info))
        return path

    def _close_to(self, idx):
        while len(self.stack) > idx:
            self._pop()

    def _pop(self):
        f = self.stack.pop()
        if f.kind == "cell":
            row_i = self._innermost({"tr"})
            if row_i >= 0:
                self.stack[row_i].cells.append(("".join(f.texts), f.n_div, f.n_span))
        elif f.kind == "tr":
            t = f.table
            t["rows"].append({"row_no": len(t["rows"]), "row_pos": f.info, "cells": [c[0] for c in f.cells],
                              "cell_divs": [c[1] for c in f.cells], "cell_spans": [c[2] for c in f.cells],
                              "n_div": f.n_div, "n_span": f.n_span})
        elif f.kind == "elem":
            self.elements.append((f.tag, "".join(f.texts)))

    # -- callbacks -----------------------------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.in_raw += 1
            return
        if tag == "input" and self.want_inputs:
            self.inputs.append({k: (v if v is not None else "") for k, v in attrs})
        if tag in ("div", "span"):
            for f in self.stack:
                if f.kind in ("tr", "cell"):
                    if tag == "div":
                        f.n_div += 1
                    else:
                        f.n_span += 1
        if self.want_tables:
            if tag == "table":
                row_i = self._innermost({"tr"}, stop_at_table=False)
                t = {"table_no": len(self.tables), "depth": 1 + sum(1 for f in self.stack if f.kind == "table"),
                     "attrs": {k: (v if v is not None else "") for k, v in attrs},
                     "parent_row_pos": self.stack[row_i].info if row_i >= 0 else None,
                     "row_path": self._row_path(), "rows": []}
                self.tables.append(t)
                self.stack.append(_Frame(tag, "table", t))
                return
            if tag in _SECTIONS:
                ti = self._innermost({"table"}, stop_at_table=False)
                if ti < 0:
                    return
                self._close_to(ti + 1)
                self.stack.append(_Frame(tag, "section", self.stack[ti].table))
                return
            if tag == "tr":
                ti = self._innermost({"table"}, stop_at_table=False)
                if ti < 0:
                    return
                si = self._innermost({"section"})
                self._close_to((si if si > ti else ti) + 1)
                parent = self.stack[-1]
                parent.tr_count += 1
                fr = _Frame(tag, "tr", parent.table)
                fr.info = parent.tr_count
                fr.cells = []
                self.stack.append(fr)
                return
            if tag in _CELLS:
                ri = self._innermost({"tr"})
                if ri < 0:
                    return
                self._close_to(ri + 1)
                fr = _Frame(tag, "cell", self.stack[ri].table)
                fr.texts = []
                self.stack.append(fr)
                return
        if tag in ("ul", "ol") and "li" in self.element_tags:
            self.stack.append(_Frame(tag, "list"))
            return
        if tag in self.element_tags:
            top = self.stack[-1] if self.stack else None
            if top is not None and top.kind == "elem" and top.tag == tag and tag == "li":
                self._pop()
            fr = _Frame(tag, "elem")
            fr.texts = []
            self.stack.append(fr)

    def handle_startendtag(self, tag, attrs):
        # <br/>, <input .../>: no content, never pushed.
        if tag == "input" and self.want_inputs:
            self.inputs.append({k: (v if v is not None else "") for k, v in attrs})

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.in_raw = max(0, self.in_raw - 1)
            return
        if tag in ("ul", "ol"):
            i = max((i for i, f in enumerate(self.stack) if f.kind == "list"), default=-1)
            if i >= 0:  # closes its own open items, never the item around the list
                self._close_to(i)
        if self.want_tables and (tag == "table" or tag in _SECTIONS or tag == "tr" or tag in _CELLS):
            kind = {"table": "table", "tr": "tr"}.get(tag, "section" if tag in _SECTIONS else "cell")
            i = self._innermost({kind}, stop_at_table=(kind != "table"))
            if i >= 0:
                self._close_to(i)
            return
        if tag in self.element_tags:
            for i in range(len(self.stack) - 1, -1, -1):
                if tag == "li" and self.stack[i].kind == "list":
                    break
                if self.stack[i].kind == "elem" and self.stack[i].tag == tag:
                    self._close_to(i)
                    break

    def handle_data(self, data):
        if self.in_raw:
            return
        for f in self.stack:
            if f.texts is not None:
                f.texts.append(data)

    def finish(self):
        self.close()
        self._close_to(0)
        return self


# ---- Spark side ------------------------------------------------------------------------------

ROW_TYPE = ("struct<row_no:int,row_pos:int,cells:array<string>,cell_divs:array<int>,cell_spans:array<int>,"
            "n_div:int,n_span:int>")
TABLE_SCHEMA = (f"page_id long, table_no int, depth int, attrs map<string,string>, parent_row_pos int, "
                f"rows array<{ROW_TYPE}>")

_ROW_ARROW = pa.struct([("row_no", pa.int32()), ("row_pos", pa.int32()), ("cells", pa.list_(pa.string())),
                        ("cell_divs", pa.list_(pa.int32())), ("cell_spans", pa.list_(pa.int32())),
                        ("n_div", pa.int32()), ("n_span", pa.int32())])
_TABLE_ARROW = pa.schema([("page_id", pa.int64()), ("table_no", pa.int32()), ("depth", pa.int32()),
                          ("attrs", pa.map_(pa.string(), pa.string())), ("parent_row_pos", pa.int32()),
                          ("rows", pa.list_(_ROW_ARROW))])


def _table_matches(t, min_depth, attrs):
    if t["depth"] < min_depth:
        return False
    return all(t["attrs"].get(k) == v for k, v in (attrs or {}).items())


def parse_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", min_depth: int = 1,
                 table_attrs: Mapping[str, str] | None = None, first_only: bool = False,
                 parent_row_pos: int | None = None) -> DataFrame:
    """One row per table: ``page_id, table_no, depth, attrs, parent_row_pos, rows``.

    Filters on depth, attributes (exact text match) and the position of an
    enclosing row are applied inside the parse, so unwanted tables are never
    materialised; ``first_only`` keeps the first matching table of a page.
    ``parent_row_pos`` asks for any row around the table at that position whose
    own table is nested ``min_depth - 1`` deep or more, so tables inside further
    tables of that row are found as well. ``id_col`` keeps its type.
    """
    attrs = dict(table_attrs or {})
    key = pages.schema[id_col].dataType
    out_schema = pa.schema([pa.field("page_id", to_arrow_type(key)), *list(_TABLE_ARROW)[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {k: [] for k in out_schema.names}
        for b in batches:
            ids = b.column(id_col).to_pylist()
            docs = b.column(html_col).to_pylist()
            for pid, doc in zip(ids, docs):
                if len(out["page_id"]) >= OUT_TABLES:
                    yield pa.RecordBatch.from_pydict(out, schema=out_schema)
                    out = {k: [] for k in out_schema.names}
                if doc is None:
                    continue
                p = PageParser()
                p.feed(doc)
                p.finish()
                for t in p.tables:
                    if not _table_matches(t, min_depth, attrs):
                        continue
                    if parent_row_pos is not None and not any(d >= min_depth - 1 and pos == parent_row_pos for d, pos in t["row_path"]):
                        continue
                    out["page_id"].append(pid)
                    out["table_no"].append(t["table_no"])
                    out["depth"].append(t["depth"])
                    out["attrs"].append(list(t["attrs"].items()))
                    out["parent_row_pos"].append(t["parent_row_pos"])
                    out["rows"].append(t["rows"])
                    if first_only:
                        break
        if out["page_id"]:
            yield pa.RecordBatch.from_pydict(out, schema=out_schema)

    ship_package(pages.sparkSession)
    return pages.select(id_col, html_col).mapInArrow(run, TABLE_SCHEMA.replace("page_id long", f"`{id_col}` {key.simpleString()}", 1))


def parse_elements(pages: DataFrame, tag: str = "li", id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Text of every ``tag`` element: ``page_id, item_no, text`` (document order)."""
    key = pages.schema[id_col].dataType
    schema = pa.schema([(id_col, to_arrow_type(key)), ("item_no", pa.int32()), ("text", pa.string())])

    def run(batches):
        out = {id_col: [], "item_no": [], "text": []}
        for b in batches:
            for pid, doc in zip(b.column(id_col).to_pylist(), b.column(html_col).to_pylist()):
                if len(out[id_col]) >= OUT_ITEMS:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)
                    out = {id_col: [], "item_no": [], "text": []}
                if doc is None:
                    continue
                p = PageParser(element_tags=(tag,), want_tables=False)
                p.feed(doc)
                p.finish()
                for i, (_, text) in enumerate(p.elements):
                    out[id_col].append(pid)
                    out["item_no"].append(i)
                    out["text"].append(text)
        if out[id_col]:
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    ship_package(pages.sparkSession)
    return pages.select(id_col, html_col).mapInArrow(run, f"`{id_col}` {key.simpleString()}, item_no int, text string")


def parse_inputs(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Attributes of every ``input`` element of a page, in document order:
    ``page_id, inputs array<map<string,string>>`` (one row per page)."""
    key = pages.schema[id_col].dataType
    schema = pa.schema([(id_col, to_arrow_type(key)), ("inputs", pa.list_(pa.map_(pa.string(), pa.string())))])

    def run(batches):
        for b in batches:
            out = {id_col: [], "inputs": []}
            for pid, doc in zip(b.column(id_col).to_pylist(), b.column(html_col).to_pylist()):
                p = PageParser(want_tables=False, want_inputs=True)
                if doc is not None:
                    p.feed(doc)
                    p.finish()
                out[id_col].append(pid)
                out["inputs"].append([list(a.items()) for a in p.inputs])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    ship_package(pages.sparkSession)
    return pages.select(id_col, html_col).mapInArrow(run, f"`{id_col}` {key.simpleString()}, inputs array<map<string,string>>")

