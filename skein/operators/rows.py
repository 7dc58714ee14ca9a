"""The ragged-row relation: tables whose header differs per file or page.

Shape: ``(<keys>..., row_no INT, cells ARRAY<STRING>)``; ``keys`` name the
table a row belongs to (e.g. ``source`` or ``page_id, table_no``). Header rows
are rows of it. Row and column position are data (``row_no``, array index).

Joining a header to its body rows is an equi-join on the keys: Catalyst/AQE
broadcasts the header side only when its measured size is under the broadcast
threshold, otherwise sort-merge with skew splitting of a hot table. The rest is
row-local array work (``transform``/``filter``/``inline``): no shuffle and no
plan that grows with the table width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


# ---- FLT3 / FLT4 / JON2 ----------------------------------------------------------------------

def split_header(rows: DataFrame, keys: Sequence[str], header_row: int = 0, cells: str = "cells",
                 hdr: str = "hdr") -> tuple[DataFrame, DataFrame]:
    """``(header, body)``: header = row ``header_row`` of each table (as ``hdr``),
    body = rows after it. Rows before it are skipped."""
    header = rows.filter(F.col("row_no") == header_row).select(*keys, F.col(cells).alias(hdr))
    body = rows.filter(F.col("row_no") > header_row)
    return header, body


def attach_header(body: DataFrame, header: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JON2: give each body row its table's header (inner equi-join on the keys)."""
    return body.join(header, list(keys), "inner")


def with_header(rows: DataFrame, keys: Sequence[str], header_row: int = 0, cells: str = "cells",
                hdr: str = "hdr") -> DataFrame:
    """Body rows with their table's header as ``hdr``.

    When the source already attached it (``read_xlsx(header_row=...)`` does,
    inside the task that parsed the file) this is a plain filter; otherwise
    the header rows are joined to the body rows on the table keys.
    """
    if hdr in rows.columns:
        return rows.filter(F.col("row_no") > header_row)
    header, body = split_header(rows, keys, header_row, cells, hdr)
    return attach_header(body, header, keys)


CONTEXT_COLS = ("hdr", "first_row_no", "first_cells", "last_row_no")


def table_context(rows: DataFrame, keys: Sequence[str], header_row: int = 0, cells: str = "cells") -> DataFrame:
    """Body rows with per-table context: ``hdr`` (header cells), ``first_row_no``
    / ``first_cells`` (first body row) and ``last_row_no``.

    Sources that read a whole table in one task attach these columns
    themselves (no shuffle). Otherwise they come from one ``groupBy`` over the
    rows (map-side partial aggregate: a table holding a third of all rows is
    still combined on every mapper) joined back on the keys.
    """
    if all(c in rows.columns for c in CONTEXT_COLS):
        return rows.filter(F.col("row_no") > header_row)
    body_no = F.when(F.col("row_no") > header_row, F.col("row_no"))
    info = rows.groupBy(*keys).agg(
        F.first(F.when(F.col("row_no") == header_row, F.col(cells)), ignorenulls=True).alias("hdr"),
        F.min(body_no).alias("first_row_no"),
        F.min_by(F.col(cells), body_no).alias("first_cells"),
        F.max(body_no).alias("last_row_no"))
    return rows.filter(F.col("row_no") > header_row).join(info, list(keys))


# ---- UNP1 over ragged rows -------------------------------------------------------------------

def unpivot_rows(rows: DataFrame, keys: Sequence[str], id_labels: Sequence[str], header_row: int = 0,
                 label_col: str = "label", value_col: str = "value", cells: str = "cells",
                 keep_col_no: bool = False) -> DataFrame:
    """Melt tables with different headers in one job.

    Id cells are found by label in each table's own header (NULL when a table
    lacks one); every other header cell is a value column. Output:
    ``keys..., row_no, <id_labels>..., label, value`` with nulls kept. A body row
    shorter than its header gives NULL values (``get`` never raises).
    """
    joined = with_header(rows, keys, header_row, cells, "hdr").withColumnRenamed("hdr", "_hdr")
    ids = F.array(*[F.lit(x) for x in id_labels])
    id_cols = [F.get(F.col(cells), F.array_position(F.col("_hdr"), F.lit(x)).cast("int") - 1).alias(x)
               for x in id_labels]
    fields = lambda h, i: [h.alias(label_col), F.get(F.col(cells), i).alias(value_col)] + (
        [i.alias("col_no")] if keep_col_no else [])
    melted = F.filter(F.transform(F.col("_hdr"), lambda h, i: F.struct(*fields(h, i))),
                      lambda s: ~F.array_contains(ids, s[label_col]))
    return joined.select(*keys, "row_no", *id_cols, F.inline(melted))


# ---- FLT5 / FLT6 / PRJ16 on cell arrays ------------------------------------------------------

def compact_cells(arr, drop: Sequence[str] = ("",)) -> Column:
    """Remove cells equal to any of ``drop``; later cells move left."""
    bad = F.array(*[F.lit(d) for d in drop])
    return F.filter(_c(arr), lambda x: ~F.array_contains(bad, x))


def blank_cells(arr, value: str = "\u00a0", as_null: bool = False) -> Column:
    """PRJ16 on an array: a cell exactly equal to ``value`` becomes '' (or NULL)."""
    repl = F.lit(None).cast("string") if as_null else F.lit("")
    return F.transform(_c(arr), lambda x: F.when(x == F.lit(value), repl).otherwise(x))


# ---- PRJ12 / PRJ13 / PRJ14: header + cells -> record -----------------------------------------

def zip_record(hdr, cells) -> Column:
    """ARRAY<STRUCT<key, value>> pairing header and cells; the shorter side wins."""
    h, c = _c(hdr), _c(cells)
    n = F.least(F.size(h), F.size(c))
    return F.arrays_zip(F.slice(h, F.lit(1), n).alias("key"), F.slice(c, F.lit(1), n).alias("value"))


def record_get(record, key: str) -> Column:
    """Value for ``key``; with repeated keys the last wins (dict semantics)."""
    hits = F.filter(_c(record), lambda e: e["key"] == F.lit(key))
    return F.try_element_at(hits, F.lit(-1))["value"]


def select_record(df: DataFrame, record: str, keys: Sequence[str], names: Sequence[str] | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Records to columns for a known key list; absent keys are NULL."""
    names = list(names or keys)
    return df.select(*keep, *[record_get(record, k).alias(n) for k, n in zip(keys, names)])


def record_keys(df: DataFrame, record: str) -> list[str]:
    """Discover the union of record keys (distinct labels: vocabulary-sized).

    This reads every record; when records come from a parsed source, take the
    labels from the header rows instead (one row per table) and parse once
    (see the ``html_records_discovered`` query)."""
    ks = (df.select(F.explode(F.col(record)["key"]).alias("k")).distinct()
          .orderBy("k").collect())
    return [r["k"] for r in ks]


# ---- FLT11 -----------------------------------------------------------------------------------

def ragged_reason(hdr, cells) -> Column:
    """NULL when row and header have the same length, else 'short_row' / 'long_row'."""
    h, c = F.size(_c(hdr)), F.size(_c(cells))
    return F.when(c < h, F.lit("short_row")).when(c > h, F.lit("long_row"))


def split_rejects(df: DataFrame, reason: Column, reason_col: str = "reject_reason"
                  ) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` by a reason expression (NULL = good). Both sides are
    lazy filters of one plan; cache or write the input once if both are used."""
    tagged = df.withColumn(reason_col, reason)
    return tagged.filter(F.col(reason_col).isNull()).drop(reason_col), tagged.filter(F.col(reason_col).isNotNull())


# ---- tables with nested rows (one row per table, as the HTML source emits) -------------------

def nested_row(rows, index: int) -> Column:
    """Row ``index`` (0-based) of a nested rows array, NULL when absent."""
    return F.get(_c(rows), index)


def explode_body(tables: DataFrame, keep: Sequence[str], body_from: int, rows: str = "rows",
                 extra: dict | None = None) -> DataFrame:
    """One output row per nested row at position >= ``body_from`` (FLT3/FLT4),
    carrying ``keep`` columns and per-table ``extra`` expressions (e.g. the
    header); row-local, no shuffle."""
    extra = extra or {}
    body = F.filter(_c(rows), lambda r: r["row_no"] >= body_from)
    return tables.select(*keep, *[v.alias(k) for k, v in extra.items()], F.explode(body).alias("_row")) \
        .select(*keep, *extra.keys(), "_row.*")


def report_rejects(tables: DataFrame, header_row: int, id_col: str = "page_id", rows: str = "rows") -> DataFrame:
    """FLT11 over nested rows: what a report page cannot give, one line each.

    ``no_table`` (no row at all) and ``short_table`` (no row after the header) are
    lines of the page, with ``row_no`` NULL; ``short_row`` and ``long_row`` are body
    rows that differ from the header in length. Columns: ``id_col``, row_no,
    cells, reason.
    """
    r = _c(rows)
    hdr = nested_row(rows, header_row)["cells"]
    none = F.lit(None)
    page = F.struct(none.cast("int").alias("row_no"), none.cast("array<string>").alias("cells"),
                    F.when(F.coalesce(F.size(r), F.lit(0)) < 1, F.lit("no_table")).otherwise(F.lit("short_table")).alias("reason"))
    lines = F.transform(F.filter(r, lambda x: x["row_no"] > header_row), lambda x: F.struct(
        x["row_no"].alias("row_no"), x["cells"].alias("cells"), ragged_reason(hdr, x["cells"]).alias("reason")))
    whole = F.coalesce(F.size(r), F.lit(0)) > header_row + 1
    listed = F.when(whole, F.filter(lines, lambda x: x["reason"].isNotNull())).otherwise(F.array(page))
    return tables.select(id_col, F.inline(listed))


def drop_keys(record, keys: Sequence[str]) -> Column:
    """PRJ10 on records: remove entries whose key is one of ``keys`` (e.g. the
    column with an empty name)."""
    bad = F.array(*[F.lit(k) for k in keys])
    return F.filter(_c(record), lambda e: ~F.array_contains(bad, e["key"]))
