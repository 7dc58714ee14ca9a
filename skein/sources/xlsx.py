"""Workbooks (.xlsx) as a Spark source, and a distributed writer.

Reading: ``binaryFile`` lists and loads the files (any Hadoop file system, glob
and path filters applied before content is read), then one Python task per
batch of files unzips each workbook and streams the chosen sheet's XML
(stdlib ``zipfile`` + ``xml.etree.iterparse``) into ragged rows:

    source STRING, file_name STRING, sheet STRING, row_no INT, cells ARRAY<STRING>

``row_no`` is the 0-based physical row; every row between the first and last
non-empty one is emitted (empty rows as ``[]``) so positions stay exact.
Cells are text as stored: numbers as written in the file (Excel keeps them
as doubles), shared and inline strings, booleans ``TRUE``/``FALSE``; a missing
cell inside a row is NULL, and so is an error cell (``#N/A``, ``#DIV/0!``).
Numbers with a date style come as ISO text (``yyyy-MM-dd``, with the time of
day when there is one). Row counts come from the rows, never from the
``dimension`` element, which writers may leave stale.

Writing: each task writes its partition as one workbook into a shared folder
(``mapInArrow``), so workbook building is spread over the cluster.
"""

from __future__ import annotations

import datetime as dt
import io
import os
import re
import uuid
import zipfile
import zlib
from decimal import Decimal
from collections.abc import Sequence
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import ship_package

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
_M = "{%s}" % _NS["m"]
_REF = re.compile(r"([A-Z]+)(\d+)")

# Fixed values of the format: built-in number formats that show a date or time.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
# Parts of a custom number format that are text, colour or locale, not date codes.
_FORMAT_TEXT = re.compile(r'"[^"]*"|\\.|_.|\[[^\]]*\]')

CHUNK_CELLS = 1 << 18  # cells in one Arrow batch of the reader (about 10 MB of short texts)

WORKBOOK_SUFFIX = ".xlsx"


def col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _sheet_paths(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels.findall("rel:Relationship", _NS)}
    out = []
    for s in wb.findall("m:sheets/m:sheet", _NS):
        t = targets[s.get("{%s}id" % _NS["r"])]
        t = t.lstrip("/")
        out.append((s.get("name"), t if t.startswith("xl/") else "xl/" + t))
    return out


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    for _, el in ET.iterparse(io.BytesIO(z.read("xl/sharedStrings.xml"))):
        if el.tag == _M + "si":
            out.append(_rich_text(el))
            el.clear()
    return out


def _rich_text(el) -> str:
    """Text of a string item: its own ``t`` or its runs' ``t``; phonetic
    guides (``rPh``) are not part of the value."""
    parts = [t.text or "" for t in el.findall(_M + "t")]
    parts += [t.text or "" for r in el.findall(_M + "r") for t in r.findall(_M + "t")]
    return "".join(parts)


def _open_sheet(content: bytes, sheet: str | None):
    z = zipfile.ZipFile(io.BytesIO(content))
    sheets = _sheet_paths(z)
    if sheet is None:
        name, path = sheets[0]
    else:
        match = [s for s in sheets if s[0] == sheet]
        if not match:
            raise ValueError(f"sheet {sheet!r} not found; sheets: {[s[0] for s in sheets]}")
        name, path = match[0]
    return z, name, path


def _date_styles(z: zipfile.ZipFile) -> tuple[frozenset[str], dt.datetime]:
    """Style numbers (as in the ``s`` attribute of a cell) that show a date, and day 0 of the workbook."""
    epoch = dt.datetime(1899, 12, 30)
    pr = ET.fromstring(z.read("xl/workbook.xml")).find(_M + "workbookPr")
    if pr is not None and pr.get("date1904", "0") in ("1", "true"):
        epoch = dt.datetime(1904, 1, 1)
    if "xl/styles.xml" not in z.namelist():
        return frozenset(), epoch
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")): _FORMAT_TEXT.sub("", f.get("formatCode") or "").lower()
              for f in root.iter(_M + "numFmt")}
    styles = root.find(_M + "cellXfs")
    out = set()
    for i, xf in enumerate(() if styles is None else styles.findall(_M + "xf")):
        fmt = int(xf.get("numFmtId", "0"))
        if any(c in "dmyhs" for c in custom[fmt]) if fmt in custom else fmt in DATE_FORMATS:
            out.add(str(i))
    return frozenset(out), epoch


def _date_text(serial: str, epoch: dt.datetime) -> str:
    """ISO text of a serial number; a number outside the calendar stays as stored."""
    try:
        when = epoch + dt.timedelta(seconds=round(float(serial) * 86400))
    except (ValueError, OverflowError):
        return serial
    return when.strftime("%Y-%m-%d" if when.time() == dt.time() else "%Y-%m-%d %H:%M:%S")


def _cell_value(c, shared, dates=(frozenset(), None)):
    t = c.get("t", "n")
    v = c.find(_M + "v")
    if t == "e":
        return None
    if t == "n" and c.get("s") in dates[0] and v is not None and v.text:
        return _date_text(v.text, dates[1])
    if t == "s":
        return shared[int(v.text)] if v is not None else None
    if t == "inlineStr":
        is_ = c.find(_M + "is")
        return _rich_text(is_) if is_ is not None else None
    if t == "b":
        return None if v is None else ("TRUE" if v.text == "1" else "FALSE")
    return v.text if v is not None else None


def iter_sheet(content: bytes, sheet: str | None = None):
    """``(sheet_name, iterator of (row_no, cells))``: rows streamed from the
    compressed sheet in order; empty rows between the first and last stored
    row come as ``[]``. Memory holds one row at a time."""
    z, name, path = _open_sheet(content, sheet)
    shared, dates = _shared_strings(z), _date_styles(z)

    def rows():
        prev = None
        with z.open(path) as fh:
            for _, el in ET.iterparse(fh):
                if el.tag != _M + "row":
                    continue
                r_attr = el.get("r")  # optional in the format: then the row follows the previous one
                r_no = int(r_attr) - 1 if r_attr else (0 if prev is None else prev + 1)
                cells: dict[int, str | None] = {}
                for pos, c in enumerate(el.findall(_M + "c")):
                    ref = c.get("r")
                    cells[col_index(_REF.match(ref).group(1)) if ref else pos] = _cell_value(c, shared, dates)
                el.clear()
                if prev is not None:
                    for gap in range(prev + 1, r_no):
                        yield gap, []
                prev = r_no
                width = max((i for i, v in cells.items() if v is not None), default=-1) + 1
                yield r_no, [cells.get(i) for i in range(width)]

    return name, rows()


UNREADABLE = (zipfile.BadZipFile, zlib.error, LookupError, ValueError, ET.ParseError, OSError)


def sheet_summary(content: bytes, sheet: str | None, header_row: int, hold: list | None = None
                  ) -> tuple[str | None, int, int, str | None]:
    """``(reason, last row with a value, widest row, sheet name)`` of one sheet by
    a streaming pass over its rows. ``reason`` says why the sheet cannot be read
    as asked (None when it can). ``hold`` gets the rows of a sheet of at most
    ``CHUNK_CELLS`` cells, which then need not be parsed again; a larger sheet
    leaves it empty."""
    last, width, seen_header, size, name = -1, 0, False, 0, None
    try:
        name, rows = iter_sheet(content, sheet)
        for r_no, cells in rows:
            seen_header = seen_header or r_no == header_row
            if r_no >= header_row and cells:
                last, width = r_no, max(width, len(cells))
            size += len(cells) + 1
            if hold is not None and size <= CHUNK_CELLS:
                hold.append((r_no, cells))
    except UNREADABLE as e:
        return f"unreadable: {type(e).__name__}: {e}", last, width, name
    if hold is not None and size > CHUNK_CELLS:
        hold.clear()
    if not seen_header:
        return "no_header_row", last, width, name
    return (None if last > header_row else "no_body_rows"), last, width, name


def sheet_runs(content: bytes, sheet: str | None = None, header_row: int | None = None, on_error: str = "fail",
               headers_only: bool = False):
    """``(sheet name, context, error, rows)`` of one workbook, a run of at most
    CHUNK_CELLS cells at a time (see ``read_xlsx``). A workbook is parsed once;
    one of more than CHUNK_CELLS cells whose context is asked for, twice."""
    context = header_row is not None and not headers_only
    if headers_only:
        hold: list = []
        reason, _, width, name = sheet_summary(content, sheet, header_row or 0, hold)
        if reason and reason.startswith("unreadable"):
            return  # an unreadable file has no labels to offer
        rows = hold or iter_sheet(content, sheet)[1]
        hdr = next((c + [None] * (width - len(c)) for r_no, c in rows if r_no >= (header_row or 0)), None)
        if hdr is not None:
            yield name, {}, None, [(header_row or 0, hdr)]
        return
    last, width, hold = None, 0, []
    if context or on_error == "reject":
        reason, last, width, name = sheet_summary(content, sheet, header_row or 0, hold)
        if reason == "no_body_rows" and header_row is None:
            reason = None  # without a header row the first row is data
        if reason is not None:
            if on_error == "fail":
                raise ValueError(reason)
            yield None, {}, reason, [(-1, [])]
            return
    rows = hold
    if not hold:
        name, rows = iter_sheet(content, sheet)
    ctx, run, size = {}, [], 0
    for r_no, cells in rows:
        if context:
            if r_no == header_row:
                ctx["hdr"] = cells + [None] * (width - len(cells))
            if r_no <= header_row or r_no > last:
                continue
            if "first_row_no" not in ctx:
                ctx.update(first_row_no=r_no, first_cells=cells, last_row_no=last)
        run.append((r_no, cells))
        size += len(cells) + 1
        if size >= CHUNK_CELLS:
            yield name, ctx, None, run
            run, size = [], 0
    if run:
        yield name, ctx, None, run


def workbook_schema(header_row: int | None, on_error: str, headers_only: bool = False) -> tuple[pa.Schema, str]:
    """Arrow schema and DDL of the reader's nested rows."""
    fields = [("source", pa.string()), ("file_name", pa.string()), ("sheet", pa.string())]
    ddl = "source string, file_name string, sheet string"
    if header_row is not None and not headers_only:
        fields += [("hdr", pa.list_(pa.string())), ("first_row_no", pa.int32()),
                   ("first_cells", pa.list_(pa.string())), ("last_row_no", pa.int32())]
        ddl += ", " + CONTEXT_SCHEMA
    if on_error == "reject" and not headers_only:
        fields += [("error", pa.string())]
        ddl += ", error string"
    fields += [("body", pa.list_(_ROW))]
    return pa.schema(fields), ddl + ", body array<struct<row_no int, cells array<string>>>"


def read_sheet(content: bytes, sheet: str | None = None) -> tuple[str, list[tuple[int, list]]]:
    """``(sheet_name, [(row_no, cells)])`` of one workbook (first sheet by default)."""
    name, rows = iter_sheet(content, sheet)
    return name, list(rows)


def list_files(spark: SparkSession, path: str, exclude: str | None = None, glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    """Files of a directory as ``binaryFile`` rows (content read lazily).

    Not recursive by default: only files directly in ``path`` (SRC3). File
    names containing ``exclude`` (case-sensitive substring of the name, not the
    path) are pruned by their metadata, before their content is read.
    """
    reader = spark.read.format("binaryFile")
    base = path.rstrip("/")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob or "*")
        df = reader.load(base)
    elif base.lower().endswith(WORKBOOK_SUFFIX):
        df = reader.load(base)  # one named file (SRC4)
    else:
        # only files directly in the folder: sub folders, such as an earlier run's output, are not even listed
        df = reader.load(f"{base}/{glob or '*' + WORKBOOK_SUFFIX}")
    if exclude:
        df = df.filter(~F.col("_metadata.file_name").contains(exclude))
    return df.withColumn("file_name", F.element_at(F.split(F.col("path"), "/"), -1))


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None, exclude: str | None = None,
              glob: str | None = None, recursive: bool = False, header_row: int | None = None,
              on_error: str = "fail", headers_only: bool = False, nested: bool = False) -> DataFrame:
    """Ragged rows of one sheet of every workbook under ``path`` (SRC1/SRC2/SRC3).

    With ``header_row`` (0-based physical row) only the rows below it are
    emitted, each carrying its file's context, computed in the task that parsed
    the file: ``hdr`` (header cells), ``first_row_no`` / ``first_cells`` (first
    body row) and ``last_row_no`` (last row with a value). ``hdr`` is as long as
    the widest row. Operators then need no header join. ``nested=True`` keeps
    the body rows of a file in runs (``body ARRAY<STRUCT<row_no, cells>>``), so
    header analysis is done once a run, not once a row.
    """
    files = list_files(spark, path, exclude=exclude, glob=glob, recursive=recursive)
    return read_xlsx_files(files, sheet, header_row=header_row, on_error=on_error, headers_only=headers_only,
                           nested=nested)


CONTEXT_SCHEMA = "hdr array<string>, first_row_no int, first_cells array<string>, last_row_no int"


_ROW = pa.struct([("row_no", pa.int32()), ("cells", pa.list_(pa.string()))])


def read_xlsx_files(files: DataFrame, sheet: str | None = None, header_row: int | None = None,
                    on_error: str = "fail", headers_only: bool = False, nested: bool = False) -> DataFrame:
    """``on_error="reject"``: a workbook that cannot be read (or lacks the header
    row / body) gives one row with ``row_no = -1`` and the reason in ``error``
    instead of failing the job; the other files go on. ``"fail"`` raises for it.

    Arrow batches are cut by cells (``CHUNK_CELLS``); a file's header travels
    once a batch and is repeated on its rows by Spark, if at all."""
    if on_error not in ("fail", "reject"):
        raise ValueError("on_error must be fail or reject")
    if nested and (header_row is None or headers_only):
        raise ValueError("nested rows need header_row")
    schema, ddl = workbook_schema(header_row, on_error, headers_only)

    def parse(batches):
        out, size = [], 0
        for b in batches:
            for p, fn, content in zip(b.column("path").to_pylist(), b.column("file_name").to_pylist(),
                                      b.column("content").to_pylist()):
                try:
                    for name, ctx, error, rows in sheet_runs(content, sheet, header_row, on_error, headers_only):
                        row = {"source": p, "file_name": fn, "sheet": name, **ctx, "error": error,
                               "body": [{"row_no": n, "cells": c} for n, c in rows]}
                        out.append({k: row.get(k) for k in schema.names})
                        size += sum(len(c) + 1 for _, c in rows)
                        if size >= CHUNK_CELLS:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out, size = [], 0
                except (zipfile.BadZipFile, zlib.error, LookupError, ValueError, ET.ParseError) as e:
                    raise ValueError(f"workbook {p}: {e}") from e
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    ship_package(files.sparkSession)
    read = files.select("path", "file_name", "content").mapInArrow(parse, ddl)
    if nested:
        return read
    return read.select("source", "file_name", "sheet", *[c for c in read.columns[3:] if c != "body"],
                       F.inline("body"))


# ---- writer ----------------------------------------------------------------------------------

def _cell_xml(ref: str, v, strings: dict) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float, Decimal)):
        return f'<c r="{ref}"><v>{repr(v) if isinstance(v, float) else v}</v></c>'
    s = str(v)
    idx = strings.setdefault(s, len(strings))
    return f'<c r="{ref}" t="s"><v>{idx}</v></c>'


def _local_folder(directory: str) -> str:
    """Workbooks are written by Python in the tasks, so the folder must be a
    path every executor has mounted (``file:`` or a plain path)."""
    if "://" in directory and not directory.startswith("file:"):
        raise ValueError(f"write_xlsx needs a mounted shared folder, not {directory!r}")
    return directory.replace("file:", "", 1)


def build_workbook(sheets: Sequence[tuple[str, Sequence[Sequence]]]) -> bytes:
    """A minimal .xlsx (shared strings, numeric and boolean cells) from
    ``[(sheet_name, rows)]``; a row is a list of values (None = no cell)."""
    strings: dict[str, int] = {}
    sheet_xml = []
    for _, rows in sheets:
        parts = []
        for i, row in enumerate(rows):
            cells = "".join(_cell_xml(f"{col_letters(j)}{i + 1}", v, strings) for j, v in enumerate(row))
            parts.append(f'<row r="{i + 1}">{cells}</row>')
        width = max((len(r) for r in rows), default=1) or 1
        dim = f'<dimension ref="A1:{col_letters(width - 1)}{max(len(rows), 1)}"/>'
        sheet_xml.append('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                         f'<worksheet xmlns="{_NS["m"]}">{dim}<sheetData>{"".join(parts)}</sheetData></worksheet>')
    sst = "".join(f"<si><t xml:space=\"preserve\">{escape(s)}</t></si>" for s in strings)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        over = "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/'
                       f'vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(len(sheets)))
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/'
                   'content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.'
                   'relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName='
                   '"/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.'
                   'sheet.main+xml"/><Override PartName="/xl/sharedStrings.xml" ContentType="application/'
                   'vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>' + over + '</Types>')
        z.writestr("_rels/.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_NS["rel"]}"><Relationship Id="rId1" '
                   'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
                   'Target="xl/workbook.xml"/></Relationships>')
        sheets_el = "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>'
                            for i, (n, _) in enumerate(sheets))
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}">'
                   f'<sheets>{sheets_el}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
                       f'relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(sheets)))
        rels += (f'<Relationship Id="rId{len(sheets) + 1}" Type="http://schemas.openxmlformats.org/officeDocument/'
                 '2006/relationships/sharedStrings" Target="sharedStrings.xml"/>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_NS["rel"]}">{rels}</Relationships>')
        for i, x in enumerate(sheet_xml):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", x)
        z.writestr("xl/sharedStrings.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><sst xmlns="{_NS["m"]}" count="{len(strings)}" '
                   f'uniqueCount="{len(strings)}">{sst}</sst>')
    return buf.getvalue()


def write_xlsx(df: DataFrame, directory: str, name_pattern: str = "part_{part:05d}_{file:04d}_{uid}.xlsx",
               sheet: str = "Sheet1", lead_rows: Sequence[Sequence] = (), cover_sheet: str | None = None,
               rows_per_file: int = 100_000) -> DataFrame:
    """Write each partition of ``df`` as one workbook in ``directory`` (a
    folder every executor can reach, e.g. under ``spark.checkpoint.dir``).

    ``lead_rows`` are written above the header (title rows to skip when
    reading); ``cover_sheet`` adds a first sheet so the data sheet must be
    chosen by name. A partition is split into workbooks of at most
    ``rows_per_file`` rows (a sheet holds at most 1,048,576), so no shuffle is
    needed to size files. Returns the lazy list of written files
    (``path, n_rows``); an action on it writes them.
    """
    cols = df.columns
    local_dir = _local_folder(directory)
    uid = uuid.uuid4().hex[:8]

    def run(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        part, attempt = ctx.partitionId(), ctx.taskAttemptId()
        out_schema = pa.schema([("path", pa.string()), ("n_rows", pa.int64())])
        state = {"file": 0, "rows": []}

        def flush():
            rows = state["rows"]
            if not rows:
                return None
            body = [list(lr) for lr in lead_rows] + [list(cols)] + rows
            sheets = ([(cover_sheet, [["cover"]])] if cover_sheet else []) + [(sheet, body)]
            os.makedirs(local_dir, exist_ok=True)
            path = os.path.join(local_dir, name_pattern.format(part=part, file=state["file"], uid=uid))
            # per attempt (a speculative twin never shares it) and hidden (Spark's file listing skips it)
            tmp = os.path.join(local_dir, f".{os.path.basename(path)}.{attempt}.tmp")
            with open(tmp, "wb") as f:
                f.write(build_workbook(sheets))
            os.replace(tmp, path)
            state["file"] += 1
            state["rows"] = []
            return pa.RecordBatch.from_pydict({"path": [path], "n_rows": [len(rows)]}, schema=out_schema)

        for b in batches:
            data = b.to_pydict()
            for i in range(b.num_rows):
                state["rows"].append([data[f"_c{j}"][i] for j in range(len(cols))])
                if len(state["rows"]) >= rows_per_file:
                    yield flush()
        last = flush()
        if last is not None:
            yield last

    # Header labels may hold dots, which column resolution reads as struct fields: hand
    # positional names to the Arrow function and write the real labels as the header.
    safe = df.toDF(*[f"_c{i}" for i in range(len(cols))])
    ship_package(safe.sparkSession)
    return safe.mapInArrow(run, "path string, n_rows long")


def write_xlsx_rows(rows: DataFrame, directory: str, file_col: str = "source", sheet: str = "Sheet1",
                    cover_sheet: str | None = None) -> DataFrame:
    """Ragged rows (``file_col, row_no, cells``) to one workbook per file, each
    row at its ``row_no``. A file's rows are brought to one task (a workbook
    has one writer) and sorted there. Returns the lazy list of written files."""
    local_dir = _local_folder(directory)
    r = rows.select(F.col(file_col).alias("_f"), "row_no", "cells").repartition("_f") \
        .sortWithinPartitions("_f", "row_no")
    out_schema = pa.schema([("path", pa.string()), ("n_rows", pa.int64())])

    def run(batches):
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        cur, body = None, []

        def flush():
            sheets = ([(cover_sheet, [["cover"]])] if cover_sheet else []) + [(sheet, body)]
            os.makedirs(local_dir, exist_ok=True)
            path = os.path.join(local_dir, os.path.basename(cur))
            tmp = os.path.join(local_dir, f".{os.path.basename(path)}.{attempt}.tmp")
            with open(tmp, "wb") as f:
                f.write(build_workbook(sheets))
            os.replace(tmp, path)
            return pa.RecordBatch.from_pydict({"path": [path], "n_rows": [len(body)]}, schema=out_schema)

        for b in batches:
            d = b.to_pydict()
            for f, n, cells in zip(d["_f"], d["row_no"], d["cells"]):
                if f != cur:
                    if cur is not None:
                        yield flush()
                    cur, body = f, []
                while len(body) < n:
                    body.append([])
                body.append(list(cells or []))
        if cur is not None:
            yield flush()

    ship_package(r.sparkSession)
    return r.mapInArrow(run, "path string, n_rows long")
