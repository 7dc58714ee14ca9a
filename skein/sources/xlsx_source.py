"""Workbooks as a Spark data source: ``spark.read.format("xlsx")`` and ``readStream``.

    from skein.sources.xlsx_source import register
    register(spark)
    spark.read.format("xlsx").option("headerRow", "0").option("exclude", "pivoted").load("/in/JP2")

Options: ``sheet`` (the first), ``headerRow`` (0-based; adds the file's header
context to every row, see ``read_xlsx``), ``exclude`` (text in names to skip),
``onError`` (``fail`` or ``reject``), ``nested`` (``true`` keeps runs of rows together).
Rows: source, file_name, sheet, [hdr, first_row_no, first_cells, last_row_no,]
[error,] row_no, cells, or ``body`` when nested.

One partition reads one workbook, so files spread over the cluster whatever
their sizes. Files are pruned by ``files`` and ``exclude``, before they are opened.
Filters are not pushed into the listing: Spark 4.1 keeps one read plan for each
loaded relation, so two filters on one relation in a query (a union of its parts)
would read each other's files. A stream reads each file once; its offset is the
time and name of the last file.

The planning process and the tasks list and open files through pyarrow's file
systems, so the folder is one that every executor has mounted, or a store that
pyarrow knows. ``read_xlsx`` goes through Spark's own file listing instead.
"""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)
from pyspark.sql.types import StructType

from skein.session import ship_package
from skein.sources.xlsx import WORKBOOK_SUFFIX, sheet_runs, workbook_schema

_ROW_FIELDS = [pa.field("row_no", pa.int32()), pa.field("cells", pa.list_(pa.string()))]


@dataclass
class Workbook(InputPartition):
    path: str

    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


@dataclass(frozen=True)
class Settings:
    path: str
    sheet: str | None
    header_row: int | None
    exclude: str | None
    names: str
    on_error: str
    nested: bool

    @classmethod
    def of(cls, options) -> Settings:
        if not options.get("path"):
            raise ValueError("xlsx: load(path) needs a folder or a workbook")
        row = options.get("headerRow")
        made = cls(options["path"], options.get("sheet"), None if row is None else int(row), options.get("exclude"),
                   options.get("files", "*"), options.get("onError", "fail"), options.get("nested", "false").lower() == "true")
        if made.on_error not in ("fail", "reject"):
            raise ValueError("xlsx: onError must be fail or reject")
        return made

    def arrow(self) -> pa.Schema:
        schema, _ = workbook_schema(self.header_row, self.on_error)
        return schema if self.nested else pa.schema([*list(schema)[:-1], *_ROW_FIELDS])

    def files(self) -> list[tuple[int, str]]:
        """(time in microseconds, path) of the workbooks directly in the folder, or of the one named."""
        system, root, prefix = _system(self.path)
        if root.lower().endswith(WORKBOOK_SUFFIX):
            found = [system.get_file_info(root)]
        else:
            found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted((int((f.mtime_ns or 0) // 1000), prefix + f.path) for f in found if f.type == fs.FileType.File
                      and f.base_name.lower().endswith(WORKBOOK_SUFFIX) and f.base_name[0] not in "._" and fnmatch.fnmatchcase(f.base_name, self.names)
                      and not (self.exclude and self.exclude in f.base_name))


def _system(path: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path in it, what stands before such paths)."""
    if "://" in path and not path.startswith("file:"):
        system, inner = fs.FileSystem.from_uri(path.rstrip("/"))
        return system, inner, path.rstrip("/").removesuffix(inner)
    return fs.LocalFileSystem(), "/" + path.removeprefix("file:").strip("/"), "file:"


def _read(settings: Settings, path: str) -> Iterator[pa.RecordBatch]:
    system, inner, _ = _system(path)
    with system.open_input_file(inner) as f:
        content = f.read()
    schema, name = settings.arrow(), os.path.basename(path)
    try:
        for sheet, context, error, rows in sheet_runs(content, settings.sheet, settings.header_row, settings.on_error):
            head = {"source": path, "file_name": name, "sheet": sheet, **context, "error": error}
            lines = [{"body": [{"row_no": n, "cells": c} for n, c in rows]}] if settings.nested else [{"row_no": n, "cells": c} for n, c in rows]
            yield pa.RecordBatch.from_pylist([{k: x for k, x in (head | line).items() if k in schema.names} for line in lines], schema=schema)
    except Exception as e:
        raise ValueError(f"workbook {path}: {e}") from e


class XlsxReader(DataSourceReader):
    def __init__(self, settings: Settings):
        self.settings = settings

    def partitions(self) -> list[Workbook]:
        return [Workbook(path) for _, path in self.settings.files()]

    def read(self, partition: Workbook | None) -> Iterator[pa.RecordBatch]:
        return _read(self.settings, partition.path) if partition else iter(())  # Spark hands out None where there is no file


class XlsxStreamReader(DataSourceStreamReader):
    """Files by (time, path). A file must get its place in the folder with a later time than those before it, as a rename after writing gives it."""

    def __init__(self, settings: Settings):
        self.settings = settings

    def initialOffset(self) -> dict:  # noqa: N802
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        files = self.settings.files()
        return {"time": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Workbook]:
        low, high = ((x["time"], x["path"]) for x in (start, end))
        return [Workbook(path) for when, path in self.settings.files() if low < (when, path) <= high]

    def read(self, partition: Workbook | None) -> Iterator[pa.RecordBatch]:
        return _read(self.settings, partition.path) if partition else iter(())  # Spark hands out None where there is no file


class XlsxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        settings = Settings.of(self.options)
        _, ddl = workbook_schema(settings.header_row, settings.on_error)
        return ddl if settings.nested else ddl[: ddl.rindex(", body ")] + ", row_no int, cells array<string>"

    def reader(self, schema: StructType) -> XlsxReader:
        return XlsxReader(Settings.of(self.options))

    def streamReader(self, schema: StructType) -> XlsxStreamReader:  # noqa: N802
        return XlsxStreamReader(Settings.of(self.options))


def register(spark: SparkSession) -> None:
    """Make the format ``xlsx`` known to the session, and the package to its workers."""
    ship_package(spark)
    spark.dataSource.register(XlsxSource)
