"""Registered queries: each reads the given tables, builds the human-made
input the operator expects from them (wide panels, ragged rows, HTML pages,
text blocks, files) and runs the operator over the whole tables.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
columns match the oracle SQL in ``skein.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from skein.functions.labels import NBSP, entry_value, kv_entries
from skein.operators import concat_by_rank, pivot_back, pivot_back_discovered, qcol, unpivot_wide
from skein.operators.convert import convert_folder
from skein.operators.filters import drop_placeholder as _drop_placeholder
from skein.operators.filters import report_filter as _report_filter
from skein.operators.filters import truncate_after_first as _truncate_after_first
from skein.operators.headers import classify_row, drop_first_empty, flatten_two_level, occurrences
from skein.operators.panel import CN, JP, JP2, MX, unpivot_panel, unpivot_panel_rows
from skein.operators.rows import (
    blank_cells,
    compact_cells,
    drop_keys,
    explode_body,
    nested_row,
    ragged_reason,
    report_rejects,
    record_get,
    select_record,
    unpivot_rows,
    with_header,
    zip_record,
)
from skein.plans import html_inputs as H
from skein.plans import inputs as I
from skein.plans.tables import table
from skein.session import scratch_path
from skein.sources.delimited import read_pipe_csv, write_pipe_csv
from skein.sources.files import parent_dir, start_year
from skein.sources.html import parse_elements, parse_inputs, parse_tables
from skein.sources.html_paths import select_rows
from skein.sources.xlsx import read_xlsx, write_xlsx, write_xlsx_rows
from skein.sources.xlsx_source import register as register_xlsx
from skein.streaming.sources_split import start_sequence_stream, start_split_stream
from skein.streaming.unpivot_stream import (
    start_batch_stream,
    start_sink,
    start_unpivot_stream,
    stream_files,
    stream_workbooks,
)

LINEITEM_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def as_double(df: DataFrame, *cols: str) -> DataFrame:
    """Panel cells are handed out as DOUBLE, as a spreadsheet stores numbers:
    money is summed exactly as DECIMAL(18,2) first (the double is the correctly
    rounded exact sum), and a nullable count reads the same in every client."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})
LINEITEM_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def unpivot_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNP1 on lineitem: four measures to (measure, value), nulls kept."""
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_IDS, *LINEITEM_MEASURES)
    return unpivot_wide(li, LINEITEM_IDS, LINEITEM_MEASURES, "measure", "value")


def unpivot_paired_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MX layout (UNP2, PRJ1, PRJ5, SCA1, SCA4) over a weekly panel with one row per customer."""
    return as_double(unpivot_panel(I.weekly_paired_panel(spark, sf_dir), MX), "Unit", "Value")


def unpivot_month_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JP layout (PRJ2, SCA2, SCA3, SCA10, UNP1) over a monthly priority x status panel."""
    return as_double(unpivot_panel(I.monthly_panel(spark, sf_dir), JP), "Value")


def unpivot_week_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JP2 layout (PRJ3, PRJ6, SCA5, SCA6, SCA9, WIN2, FLT1) over a weekly text panel."""
    cells, names, year = I.weekly_text_cells(spark, sf_dir)
    panel = cells.selectExpr("o_orderstatus", "o_orderpriority",
                             *[f"get(cells, {i}) AS `{n}`" for i, n in enumerate(names)])
    return unpivot_panel(panel, JP2, source=f"orders_status_priority_weekly_{year}0101-x.xlsx")


REGION_BLOCK_SPEC = CN.replace(value_names=I.SEGMENTS, cutoff="200012", country="ASIA", value_type="double")


def unpivot_region_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CN layout (PRJ4, PRJ7-10, SCA7-9, WIN3, FLT2, UNP3, SRT1) on ragged rows:
    third block of repeated headers, dates +1 month per row, cut after 200012."""
    rows = I.region_block_rows(spark, sf_dir)
    return unpivot_panel(rows, REGION_BLOCK_SPEC, keys=["source"]).drop("source")


def unpivot_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON2 + UNP1: one job over tables whose headers differ (order) per nation."""
    rows = I.ragged_nation_rows(spark, sf_dir)
    long = unpivot_rows(rows, ["source"], ["segment"], header_row=0)
    return long.select(F.col("source").alias("n_name"), F.col("segment").alias("c_mktsegment"),
                       F.col("label").alias("o_orderpriority"), F.col("value").cast("double").alias("n_orders"))


def pair_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON1: n-th returned ('R') line of an order beside its n-th accepted ('A')
    line; the longer side's tail is dropped (positional inner concat).
    Position = rank inside one order (a bounded group); one shuffle."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_quantity", "l_returnflag")

    def side(flag, tag):
        return li.filter(F.col("l_returnflag") == flag).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.col("l_linenumber").alias(f"{tag}_linenumber"), F.col("l_quantity").alias(f"{tag}_quantity"))

    return concat_by_rank(side("R", "left"), side("A", "right"), ["l_orderkey"],
                          ["l_linenumber", "l_partkey", "l_suppkey"],
                          ["left_linenumber", "left_quantity"], ["right_linenumber", "right_quantity"])


def pivot_back_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNP5: the melted measures pivoted back per line (round trip).

    The line keys are not unique in every table, so each scanned row gets a
    row id straight after the scan (before any shuffle, hence stable across
    task retries) and the pivot groups by keys + row id."""
    li = (table(spark, sf_dir, "lineitem").select(*LINEITEM_IDS, *LINEITEM_MEASURES)
          .withColumn("_rid", F.monotonically_increasing_id()))
    ids = LINEITEM_IDS + ["_rid"]
    long = unpivot_wide(li, ids, LINEITEM_MEASURES, "measure", "value")
    return pivot_back(long, ids, "measure", "value", LINEITEM_MEASURES).drop("_rid")


def _events_text(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    txt = (F.when(F.col("event_type") == "error", F.lit("-"))
           .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
           .otherwise(F.col("value").cast("decimal(18,2)").cast("string")))
    return ev.select("event_id", "user_id", "event_type", txt.alias("value_text"))


def drop_placeholder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT1: '-' placeholders go, NULLs stay."""
    return _drop_placeholder(_events_text(spark, sf_dir), "value_text", "-")


def truncate_after_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2: each user's events up to and including the first error by (ts, event_id)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    kept = _truncate_after_first(ev, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error",
                                 on_missing="all")
    return kept.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def header_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ4 + PRJ11: header per order = '' + line flags (by line) + ''; the first
    empty cell is dropped, then each cell gets the occurrence number of its label."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")))
    hdr = li.groupBy("l_orderkey").agg(lines.alias("lines")).select(
        "l_orderkey",
        F.concat(F.array(F.lit("")), F.transform("lines", lambda x: x["l_returnflag"]), F.array(F.lit(""))).alias("hdr"))
    return hdr.select("l_orderkey", F.inline(occurrences(drop_first_empty("hdr"))))


def flatten_two_level_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ15 + WIN1: per region, upper = Place + nation names, lower = Country,
    Week, then (Cases|Geospread, Deaths) per nation; flattened by running count."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nat = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    per = n.groupBy("n_regionkey").agg(nat.alias("nat")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    upper = F.concat(F.array(F.lit("Place")), F.transform("nat", lambda x: x["n_name"]))
    lower = F.concat(F.array(F.lit("Country"), F.lit("Week")), F.flatten(F.transform("nat", lambda x: F.array(
        F.when(x["n_nationkey"] % 2 == 0, F.lit("Cases")).otherwise(F.lit("Geospread")), F.lit("Deaths")))))
    return per.select("r_name", F.posexplode(flatten_two_level(upper, lower)).alias("col_no", "column_name"))


def kv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCA13: 'Key: value' text blocks per order; blank lines skipped, a repeated
    key keeps the last value, a second ': ' stays in the value."""
    o = table(spark, sf_dir, "orders")
    block = F.concat(
        F.lit("Order: "), F.col("o_orderkey").cast("string"), F.lit("\n"),
        F.lit("Status: "), F.col("o_orderstatus"), F.lit("\n\n"),
        F.lit("Priority: "), F.col("o_orderpriority"), F.lit("\n"),
        F.lit("Note: total: "), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        F.when(F.col("o_orderpriority") == "1-URGENT",
               F.concat(F.lit("\nStatus: URGENT-"), F.col("o_orderstatus"))).otherwise(F.lit("")))
    e = o.select(kv_entries(block).alias("e"))
    return e.select(entry_value("e", "Order").cast("bigint").alias("o_orderkey"),
                    entry_value("e", "Status").alias("status"),
                    entry_value("e", "Priority").alias("priority"),
                    entry_value("e", "Note").alias("note"))


REPORT_START, REPORT_END = (1996, 10), (1997, 20)
REPORT_OPTIONS = {"n_name": "  nation_7\t", "c_mktsegment": "Building "}


def report_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT9 + FLT10 + SCA11: ISO week range 1996-W10 .. 1997-W20 (pushed to the
    scan as a date range) and options matched ignoring case and outer blanks."""
    o = _report_filter(table(spark, sf_dir, "orders"), date_col="o_orderdate", start=REPORT_START, end=REPORT_END)
    j = I.orders_placed(spark, sf_dir, o)
    j = _report_filter(j, options=REPORT_OPTIONS)
    return j.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
                    "n_name", "c_mktsegment")


ORDER_HEADER = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]


def _ragged_orders(spark, sf_dir):
    """Orders as rows of cells: '5-LOW' rows lost their last cell, '1-URGENT' rows carry an extra one."""
    o = table(spark, sf_dir, "orders")
    full = F.array(F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority",
                   F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    cells = (F.when(F.col("o_orderpriority") == "5-LOW", F.slice(full, 1, 3))
             .when(F.col("o_orderpriority") == "1-URGENT", F.concat(full, F.array(F.lit("x"))))
             .otherwise(full))
    return o.select("o_orderkey", cells.alias("cells"))


def ragged_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT11: rows whose length differs from the header get a reject reason."""
    hdr = F.array(*[F.lit(h) for h in ORDER_HEADER])
    return _ragged_orders(spark, sf_dir).select(
        "o_orderkey", F.size("cells").alias("n_cells"), ragged_reason(hdr, F.col("cells")).alias("reject_reason"))


QUERIES = {
    "unpivot_measures": unpivot_measures,
    "unpivot_paired_weeks": unpivot_paired_weeks,
    "unpivot_month_labels": unpivot_month_labels,
    "unpivot_week_sequence": unpivot_week_sequence,
    "unpivot_region_block": unpivot_region_block,
    "unpivot_ragged": unpivot_ragged,
    "pair_by_position": pair_by_position,
    "pivot_back": pivot_back_measures,
    "drop_placeholder": drop_placeholder,
    "truncate_after_first": truncate_after_first,
    "header_occurrence": header_occurrence,
    "flatten_two_level": flatten_two_level_header,
    "kv_text": kv_text,
    "report_filter": report_filter,
    "ragged_rejects": ragged_rejects,
}


# ---- HTML ------------------------------------------------------------------------------------


def html_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7 + FLT3-5 + PRJ12/13: the inner table (5th row of a table nested four
    deep) of each page; rows 1-2 skipped (row 1 gives the nation), row 3 is the
    header, empty cells removed (compact mode), header zipped with each row."""
    t = parse_tables(H.customer_pages(spark, sf_dir), min_depth=5, parent_row_pos=5)
    hdr = compact_cells(nested_row("rows", 2)["cells"])
    body = explode_body(t, ["page_id"], 3, extra={"title": nested_row("rows", 0)["cells"][0], "hdr": hdr})
    rec = body.select("title", zip_record("hdr", compact_cells("cells")).alias("r"))
    return rec.select(F.col("title").alias("n_name"),
                      record_get("r", "Key").cast("bigint").alias("c_custkey"),
                      record_get("r", "Name").alias("c_name"),
                      record_get("r", "Segment").alias("c_mktsegment"),
                      record_get("r", "Balance").cast("decimal(18,2)").cast("double").alias("c_acctbal"))


def html_path_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC9 + SRC7 by a path: pages with text ids, whose report stands inside the
    container ``report`` below a decoy container with a report of its own, and
    whose inner table stands in one more table of the 5th row. The path picks
    the innermost rows of the right container; browsers' ``tbody`` is implied."""
    pages = H.customer_pages(spark, sf_dir)
    decoy = F.concat(F.lit('<div id="other">'), F.regexp_replace("html", "</?(html|body|div)[^>]*>", ""), F.lit("</div>"))
    inner = F.regexp_replace("html", '<table class="data">(.*?)</table>', '<table><tr><td><table class="data">$1</table></table>')
    pages = pages.select(F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("page_id"), F.concat(decoy, inner).alias("html"))
    t = select_rows(pages, "//div[@id='report']//table//table//table//table/tbody/tr[5]//table//table/tbody/tr", imply_tbody=True)
    hdr = compact_cells(nested_row("rows", 2)["cells"])
    body = explode_body(t, ["page_id"], 3, extra={"title": nested_row("rows", 0)["cells"][0], "hdr": hdr})
    rec = body.select("page_id", "container", "title", zip_record("hdr", compact_cells("cells")).alias("r"))
    return rec.select("page_id", "container", F.col("title").alias("n_name"), record_get("r", "Key").cast("bigint").alias("c_custkey"),
                      record_get("r", "Segment").alias("c_mktsegment"), record_get("r", "Balance").cast("decimal(18,2)").cast("double").alias("c_acctbal"))


def html_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT11 over pages: the reject list itself. Pages of one nation lost their
    report, another's tables were cut after the title, and customers whose key
    ends in 7 lost their last cell: no_table, short_table and short_row."""
    pages = H.customer_pages(spark, sf_dir)
    nation = F.col("page_id") % 100
    cut = F.regexp_replace("html", '(<table class="data"><tr>.*?</tr>).*?</table>', "$1</table>")
    short = F.regexp_replace("html", "(<tr><td>[0-9]*7</td>(?:<td>(?:(?!</td>).)*</td>){2})<td>(?:(?!</td>).)*</td></tr>", "$1</tr>")
    pages = pages.select("page_id", F.when(nation == 3, F.lit("<html><body>no data</body></html>")).when(nation == 4, cut).otherwise(short).alias("html"))
    t = select_rows(pages, "//table[@class='data']//tr", direct=True)
    t = t.withColumn("rows", F.transform("rows", lambda r: r.withField("cells", compact_cells(r["cells"]))))
    return report_rejects(t, header_row=2).select("page_id", "row_no", "reason", F.get("cells", 0).alias("first_cell"))


def report_pages_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2: report pages to records to pipe CSV, one folder for each report and
    country. The first run writes outdated pages of some countries, the second
    run the other countries, the third replaces the outdated ones; each run
    leaves the countries alone that it has no pages of."""
    pages = H.customer_pages(spark, sf_dir)
    out, nation = scratch_path(spark, "report_csv") + "/out", F.col("page_id") % 100
    old = pages.where(nation < 9).withColumn("html", F.regexp_replace("html", "Customer#", "Outdated#"))
    for run in (old, pages.where(nation >= 9), pages.where(nation < 9)):
        t = parse_tables(run, min_depth=5, parent_row_pos=5)
        body = explode_body(t, [], 3, extra={"country": nested_row("rows", 0)["cells"][0], "hdr": compact_cells(nested_row("rows", 2)["cells"])})
        rec = body.select("country", zip_record("hdr", compact_cells("cells")).alias("r"))
        flat = rec.select(F.lit("report12").alias("report"), "country", *[record_get("r", k).alias(k) for k in ("Key", "Name", "Segment", "Balance")])
        write_pipe_csv(flat, out, partition_by=["report", "country"], mode="partitions")
    back = read_pipe_csv(spark, out, "Key long, Name string, Segment string, Balance string, report string, country string")
    return back.select("report", "country", "Key", "Name", "Segment", F.col("Balance").cast("decimal(18,2)").cast("double").alias("Balance"))


def html_table_by_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC8: first table with attribute cols="16" of each page, its rows as records."""
    t = parse_tables(H.part_pages(spark, sf_dir), table_attrs={"cols": "16"}, first_only=True)
    hdr = compact_cells(nested_row("rows", 2)["cells"])
    body = explode_body(t, ["page_id"], 3, extra={"brand": nested_row("rows", 1)["cells"][0], "hdr": hdr})
    rec = body.select("brand", zip_record("hdr", compact_cells("cells")).alias("r"))
    return rec.select(F.col("brand").alias("p_brand"),
                      record_get("r", "Key").cast("bigint").alias("p_partkey"),
                      record_get("r", "Name").alias("p_name"),
                      record_get("r", "Type").alias("p_type"),
                      record_get("r", "Size").cast("int").alias("p_size"),
                      record_get("r", "Price").cast("decimal(18,2)").cast("double").alias("p_retailprice"))


def _report_rows(spark, sf_dir):
    """SRC9 + FLT7 + FLT8: rows of the depth-5 report table, classified."""
    t = parse_tables(H.region_report_pages(spark, sf_dir), min_depth=5)
    rows = explode_body(t, ["page_id"], 0)
    kind = classify_row(F.col("n_div"), F.col("n_span"))
    cleaned = (F.when(kind == "header", compact_cells("cells", ("", NBSP)))
               .otherwise(compact_cells("cells", ("",))))
    return rows.select("page_id", "row_no", kind.alias("row_kind"), cleaned.alias("cells")) \
        .filter(F.col("row_kind").isNotNull())


def html_classify_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT6-8: header rows (divs, no span) lose '' and NBSP cells, body rows
    (divs and a span) lose '' cells, other rows are dropped."""
    r = _report_rows(spark, sf_dir)
    return r.select("page_id", "row_no", "row_kind", F.size("cells").alias("n_cells"),
                    F.get(F.col("cells"), 0).alias("first_cell"))


REPORT_COLUMNS = ["Place Country", "Place Region"] + [f"{s} {m}" for s in I.SEGMENTS for m in ("Cases", "Deaths")]


def html_report_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ14-16 + WIN1: two header rows flattened by the running marker count,
    body rows turned into records under the flat names, NBSP cells blanked."""
    t = parse_tables(H.region_report_pages(spark, sf_dir), min_depth=5)
    kind = lambda r: classify_row(r["n_div"], r["n_span"])
    heads = F.filter("rows", lambda r: kind(r) == "header")
    bodies = F.filter("rows", lambda r: kind(r) == "body")
    clean_h = lambda i: compact_cells(F.get(heads, i)["cells"], ("", NBSP))
    flat = flatten_two_level(clean_h(0), clean_h(1))
    rec = t.select(flat.alias("flat"), F.explode(bodies).alias("b")).select(
        zip_record("flat", blank_cells(compact_cells(F.col("b")["cells"]))).alias("r"))
    return rec.select(*[record_get("r", k).alias(k) for k in REPORT_COLUMNS])


def page_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7 on the given pages: text of every <li> (tags stripped, entities decoded)."""
    return parse_elements(table(spark, sf_dir, "pages"), "li")


def form_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10: each expected hidden field per page with its count; the value only
    when it occurs exactly once, else status 'missing' / 'duplicate'."""
    inp = parse_inputs(H.form_pages(spark, sf_dir))

    def field(name):
        hits = F.filter("inputs", lambda m: m["id"] == F.lit(name))
        n = F.size(hits)
        return F.struct(F.lit(name).alias("field"), n.alias("n"),
                        F.when(n == 1, F.get(hits, 0)["value"]).alias("value"),
                        F.when(n == 1, F.lit("ok")).when(n == 0, F.lit("missing")).otherwise(F.lit("duplicate"))
                        .alias("status"))

    return inp.select("page_id", F.inline(F.array(*[field(f) for f in H.HIDDEN_FIELDS])))


QUERIES.update({
    "html_records": html_records,
    "html_path_records": html_path_records,
    "html_rejects": html_rejects,
    "report_pages_csv": report_pages_csv,
    "html_table_by_attr": html_table_by_attr,
    "html_classify_rows": html_classify_rows,
    "html_report_matrix": html_report_matrix,
    "page_list_items": page_list_items,
    "form_fields": form_fields,
})


# ---- files: workbooks, delimited text, paths, streams ----------------------------------------


PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def _run_writes(files: DataFrame) -> None:
    files.agg(F.sum("n_rows")).collect()


def _part_records(rows: DataFrame, header_row: int) -> DataFrame:
    j = with_header(rows, ["source"], header_row=header_row)
    r = j.select("source", zip_record("hdr", "cells").alias("r"))
    return r.select("source", record_get("r", "p_partkey").cast("bigint").alias("p_partkey"),
                    record_get("r", "p_name").alias("p_name"), record_get("r", "p_brand").alias("p_brand"),
                    record_get("r", "p_type").alias("p_type"), record_get("r", "p_size").cast("int").alias("p_size"),
                    record_get("r", "p_retailprice").cast("double").alias("p_retailprice"))


def xlsx_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1 + SRC2: part written as workbooks (cover sheet first; data sheet
    'Data' with 3 title rows, an ignored row, header on the 5th row), read
    back by sheet name, header matched per file."""
    root = scratch_path(spark, "xlsx_roundtrip")
    part = table(spark, sf_dir, "part").select(*PART_COLS)
    _run_writes(write_xlsx(part, root, sheet="Data", cover_sheet="Cover", rows_per_file=500,
                           lead_rows=[["Parts list"], ["all brands"], [], ["(not read)"]]))
    rows = read_xlsx(spark, root, sheet="Data", header_row=4)
    return _part_records(rows, header_row=4).drop("source")


def path_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3-6: a provider folder MX holding workbooks named
    ``panel_<part>_w_k_19960101-x.xlsx``, an already converted ``*_pivoted*``
    workbook (skipped by name) and a sub folder (not read); country from the
    parent folder, start year from the 5th ``_`` token of the name."""
    root = scratch_path(spark, "path_columns")
    part = table(spark, sf_dir, "part").select(*PART_COLS)
    _run_writes(write_xlsx(part, f"{root}/MX", name_pattern="panel_{part:05d}{file:03d}_w_k_19960101-x.xlsx",
                           rows_per_file=500))
    _run_writes(write_xlsx(part, f"{root}/MX", name_pattern="panel_{part:05d}{file:03d}_pivoted.xlsx",
                           rows_per_file=500))
    _run_writes(write_xlsx(part, f"{root}/MX/sub", rows_per_file=500))
    rows = read_xlsx(spark, f"{root}/MX", exclude="pivoted", header_row=0)
    recs = _part_records(rows, header_row=0)
    return recs.select(parent_dir("source").alias("country"), start_year("source").alias("start_year"),
                       "p_partkey", "p_name")


CSV_SCHEMA = StructType([StructField("p_partkey", LongType()), StructField("p_name", StringType()),
                         StructField("p_type", StringType()), StructField("p_size", IntegerType()),
                         StructField("p_retailprice", DoubleType()), StructField("note", StringType())])


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1-3: part (plus a note with quotes, and '' for small parts) written as
    pipe CSV partitioned by brand, read back with the same options."""
    root = scratch_path(spark, "csv_roundtrip")
    p = table(spark, sf_dir, "part")
    note = (F.when(F.col("p_size") < 10, F.lit("")).when(F.col("p_size") > 45, F.lit('say "hi" | bye'))
            .otherwise(F.col("p_type")))
    write_pipe_csv(p.select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice", note.alias("note"), "p_brand"),
                   root, partition_by=["p_brand"])
    return read_pipe_csv(spark, root, CSV_SCHEMA)


def stream_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1: lineitem files streamed (availableNow) through the unpivot into a
    parquet sink with a checkpoint; the sink is read back."""
    root = scratch_path(spark, "stream_unpivot")
    schema = table(spark, sf_dir, "lineitem").schema
    s = stream_files(spark, sf_dir, schema, glob="lineitem.parquet")
    q = start_unpivot_stream(s, LINEITEM_IDS, LINEITEM_MEASURES, "measure", "value", f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


QUERIES.update({
    "xlsx_roundtrip": xlsx_roundtrip,
    "path_columns": path_columns,
    "csv_roundtrip": csv_roundtrip,
    "stream_unpivot": stream_unpivot,
})


# ---- folders of provider workbooks with different headers ------------------------------------


def unpivot_panel_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MX layout over a folder of workbooks whose headers differ (one per ISO year
    with orders, 52 or 53 weeks): one job, each file with its own header."""
    root = scratch_path(spark, "panel_files")
    _run_writes(write_xlsx_rows(I.weekly_paired_rows(spark, sf_dir), f"{root}/MX"))
    rows = read_xlsx(spark, f"{root}/MX", header_row=0, nested=True)
    long = unpivot_panel_rows(rows, MX, id_labels=["n_name", "c_mktsegment"],
                              value_types={"Unit": "bigint", "Value": "decimal(18,2)"})
    return as_double(long.drop("source", "row_no"), "Unit", "Value")


ORDER_STATUSES = ("F", "O", "P")


def convert_folder_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end (SRC3-5, UNP4, SNK1): a JP folder with one monthly workbook
    per order status and an already converted file; layout picked from the
    folder name, all files in one job, pipe CSV per file, read back."""
    root = scratch_path(spark, "convert_folder")
    panel = I.cut_lineage(spark, I.monthly_panel(spark, sf_dir))  # priorities x statuses, written to several files
    for s in ORDER_STATUSES:
        part = panel.filter(F.col("o_orderstatus") == s).drop("o_orderstatus")
        _run_writes(write_xlsx(part, f"{root}/JP", name_pattern=f"orders_{s}_{{part:05d}}{{file:03d}}.xlsx"))
    _run_writes(write_xlsx(panel.drop("o_orderstatus"), f"{root}/JP",
                           name_pattern="orders_all_{part:05d}{file:03d}_pivoted.xlsx"))
    convert_folder(spark, f"{root}/JP", out_dir=f"{root}/out", id_labels=["o_orderpriority"],
                   value_types={"Value": "decimal(18,2)"})
    back = read_pipe_csv(spark, f"{root}/out", "o_orderpriority string, YearMonth string, Value decimal(18,2)")
    return as_double(back.select(F.get(F.split("file", "_"), 1).alias("o_orderstatus"), "o_orderpriority",
                                 "YearMonth", "Value"), "Value")


QUERIES.update({
    "unpivot_panel_files": unpivot_panel_files,
    "convert_folder": convert_folder_monthly,
})


# ---- browser variants of the reports ---------------------------------------------------------


def _kinds(rows_col: str, kind: str):
    return F.filter(rows_col, lambda r: classify_row(r["n_div"], r["n_span"]) == kind)


def html_header_rows_as_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report-2 browser variant (row kinds as a parameter, PRJ10, PRJ14, PRJ16):
    all rows classify as 'header'; header row 1 names the columns, header rows
    2+ are the data, transposed by index; the empty-named column is dropped and
    NBSP cells blanked."""
    t = parse_tables(H.supplier_browser_pages(spark, sf_dir), min_depth=5)
    heads = _kinds("rows", "header")
    body = t.select(F.get(heads, 0)["cells"][1].alias("n_name"), F.get(heads, 1)["cells"].alias("cols"),
                    F.explode(F.slice(heads, 3, 1 << 30)).alias("b"))
    rec = body.select("n_name", drop_keys(zip_record("cols", blank_cells(F.col("b")["cells"])), [""]).alias("r"))
    return rec.select("n_name", record_get("r", "Supplier").cast("bigint").alias("s_suppkey"),
                      record_get("r", "Name").alias("s_name"), record_get("r", "Balance").alias("balance"))


def html_skip_first_body_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report-12 browser variant (PRJ11, FLT3, FLT5, PRJ14, PRJ16): the first
    empty header cell is removed, the first body row ('Data from : all sources')
    is dropped, empty body cells are removed, cells are matched to the header
    by index and NBSP cells blanked."""
    t = parse_tables(H.order_browser_pages(spark, sf_dir), min_depth=5)
    heads, bodies = _kinds("rows", "header"), _kinds("rows", "body")
    body = t.select(drop_first_empty(F.get(heads, 1)["cells"]).alias("cols"),
                    F.explode(F.slice(bodies, 2, 1 << 30)).alias("b"))
    rec = body.select(zip_record("cols", blank_cells(compact_cells(F.col("b")["cells"]))).alias("r"))
    return rec.select(*[record_get("r", k).alias(k) for k in ("Country", "Year", "Orders", "Urgent")])


QUERIES.update({
    "html_header_rows_as_body": html_header_rows_as_body,
    "html_skip_first_body_row": html_skip_first_body_row,
})


def stream_panel_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1 over workbooks: the MX folder of unpivot_panel_files consumed as a
    file stream (availableNow; the checkpoint remembers processed files), each workbook parsed
    once with its header attached, melted without joins, appended to parquet."""
    root = scratch_path(spark, "stream_panel_files")
    _run_writes(write_xlsx_rows(I.weekly_paired_rows(spark, sf_dir), f"{root}/MX"))
    rows = stream_workbooks(spark, f"{root}/MX", header_row=0, max_files_per_trigger=4, nested=True)
    long = unpivot_panel_rows(rows, MX, id_labels=["n_name", "c_mktsegment"],
                              value_types={"Unit": "bigint", "Value": "decimal(18,2)"})
    q = start_sink(long.drop("source", "row_no"), f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    return as_double(spark.read.parquet(f"{root}/out"), "Unit", "Value")


QUERIES["stream_panel_files"] = stream_panel_files


def xlsx_source_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1/SRC2 as a data source: the MX folder of unpivot_panel_files read with
    ``spark.read.format("xlsx")``, the first workbook by a pattern and the others
    by an exclusion, both applied to the listing."""
    root = scratch_path(spark, "source_files")
    _run_writes(write_xlsx_rows(I.weekly_paired_rows(spark, sf_dir), f"{root}/MX"))
    register_xlsx(spark)
    read = spark.read.format("xlsx").option("headerRow", "0").option("nested", "true")
    first = f"weekly_{I.order_span(spark, sf_dir)[0].isocalendar()[0]}.xlsx"
    both = [unpivot_panel_rows(rows, MX, id_labels=["n_name", "c_mktsegment"], value_types={"Unit": "bigint", "Value": "decimal(18,2)"})
            for rows in (read.load(f"{root}/MX", files=first), read.load(f"{root}/MX", files="*", exclude=first))]
    return as_double(both[0].unionByName(both[1]).drop("source", "row_no"), "Unit", "Value")


def xlsx_source_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1 by the data source: the same folder with ``readStream.format("xlsx")``,
    its offsets kept in the checkpoint; a second run finds nothing new."""
    root = scratch_path(spark, "source_stream")
    _run_writes(write_xlsx_rows(I.weekly_paired_rows(spark, sf_dir), f"{root}/MX"))
    register_xlsx(spark)
    for _ in range(2):
        rows = spark.readStream.format("xlsx").option("headerRow", "0").option("nested", "true").load(f"{root}/MX")
        long = unpivot_panel_rows(rows, MX, id_labels=["n_name", "c_mktsegment"],
                                  value_types={"Unit": "bigint", "Value": "decimal(18,2)"})
        start_sink(long.drop("source", "row_no"), f"{root}/out", f"{root}/ckpt").awaitTermination()
    return as_double(spark.read.parquet(f"{root}/out"), "Unit", "Value")


QUERIES |= {"xlsx_source_panel": xlsx_source_panel, "xlsx_source_stream": xlsx_source_stream}


CN_FILES = {"visitors_a.xlsx": (0, 1, 2), "visitors_b.xlsx": (2, 3, 4)}


def _cn_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = I.region_month_counts(spark, sf_dir)  # one aggregation shared by both sheets
    rows = None
    for name, regions in CN_FILES.items():
        r = I.region_block_rows(spark, sf_dir, regions=regions, source=name, counts=counts)
        rows = r if rows is None else rows.unionByName(r)
    return rows


def convert_folder_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CN end to end (SRC2 + the region block layout through files): a CN folder
    of two workbooks (cover sheet first, data on sheet 'Asia' below three title
    rows and an ignored row), third header block of each melted in one job,
    written as pipe CSV per file and read back."""
    root = scratch_path(spark, "convert_blocks")
    rows = _cn_sheets(spark, sf_dir)
    _run_writes(write_xlsx_rows(rows, f"{root}/CN", sheet="Asia", cover_sheet="Notes"))
    convert_folder(spark, f"{root}/CN", out_dir=f"{root}/out", spec=REGION_BLOCK_SPEC)
    return read_pipe_csv(spark, f"{root}/out", "Country string, Date string, Visit_Purpose string, Visitors double")


QUERIES["convert_folder_blocks"] = convert_folder_blocks


def convert_folder_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad-input routing: a JP2 folder with one weekly workbook per order status
    plus a copy whose name has no date token and a file that is not a
    workbook. The two bad files go to a reject list, the others are converted
    in the same job (the good rows are returned)."""
    root = scratch_path(spark, "convert_rejects")
    cells, names, year = I.weekly_text_cells(spark, sf_dir)
    rows = I.cut_lineage(spark, cells)  # statuses x priorities, written to several files
    date = f"{year}0101-x.xlsx"
    file = F.concat(F.lit("orders_"), F.col("o_orderstatus"))
    body = rows.select(F.concat(file, F.lit(f"_w_000_{date}")).alias("source"), "o_orderpriority", "cells").unionByName(
        rows.filter(F.col("o_orderstatus") == "F").select(F.lit("orders_F_nodate.xlsx").alias("source"),
                                                          "o_orderpriority", "cells"))
    by_priority = Window.partitionBy("source").orderBy("o_orderpriority")  # bounded: the priorities of one status
    sheet = body.select("source", F.row_number().over(by_priority).cast("int").alias("row_no"),
                        F.concat(F.array("o_orderpriority"), "cells").alias("cells"))
    head = body.select("source").distinct().select(
        "source", F.lit(0).alias("row_no"),
        F.lit(["o_orderpriority", *names]).alias("cells"))
    _run_writes(write_xlsx_rows(head.unionByName(sheet), f"{root}/JP2"))
    local = f"{root}/JP2".replace("file:", "", 1)
    with open(f"{local}/orders_X_w_000_{date}", "wb") as f:
        f.write(b"this is not a workbook")
    long = convert_folder(spark, f"{root}/JP2", spec=JP2, id_labels=["o_orderpriority"],
                          rejects_dir=f"{root}/rejects")
    return long.select(F.get(F.split("file", "_"), 1).alias("o_orderstatus"), "o_orderpriority", "Date", "Value")


QUERIES["convert_folder_rejects"] = convert_folder_rejects


def stream_region_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1 with a whole-file operator: the CN workbooks arrive as a file stream
    (availableNow); each micro-batch runs the sorted region-block
    layout through ``foreachBatch`` and appends to parquet. A batch id column
    makes a replayed batch overwrite, not duplicate, its own output."""
    root = scratch_path(spark, "stream_blocks")
    rows = _cn_sheets(spark, sf_dir)
    _run_writes(write_xlsx_rows(rows, f"{root}/CN", sheet="Asia", cover_sheet="Notes"))
    spec = REGION_BLOCK_SPEC
    stream = stream_workbooks(spark, f"{root}/CN", sheet=spec.sheet, header_row=spec.header_row)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = unpivot_panel(batch, spec, keys=["source"])
        (out.withColumn("file", F.element_at(F.split("source", "/"), -1)).drop("source")
         .withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{root}/out"))

    start_batch_stream(stream, per_batch, f"{root}/ckpt").awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch_id")


QUERIES["stream_region_blocks"] = stream_region_blocks


def html_records_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ13 with discovered columns: the union of header labels of all pages
    becomes the columns, text as read. The schema must be known before the
    plan, so the parsed tables are written once (checkpoint in the shared
    folder) and both the label discovery (header rows only: one row per table,
    a vocabulary-sized result) and the records read them: one parse."""
    t = I.cut_lineage(spark, parse_tables(H.customer_pages(spark, sf_dir), min_depth=5, parent_row_pos=5))
    hdr = compact_cells(nested_row("rows", 2)["cells"])
    keys = [r["k"] for r in t.select(F.explode(hdr).alias("k")).distinct().orderBy("k").collect()]
    body = explode_body(t, ["page_id"], 3, extra={"title": nested_row("rows", 0)["cells"][0], "hdr": hdr})
    rec = body.select(F.col("title").alias("n_name"), zip_record("hdr", compact_cells("cells")).alias("r"))
    return select_record(rec, "r", keys, keep=["n_name"])


QUERIES["html_records_discovered"] = html_records_discovered


def pivot_back_without_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNP5 with discovered labels: the round trip of ``pivot_back`` without its label list."""
    li = (table(spark, sf_dir, "lineitem").select(*LINEITEM_IDS, *LINEITEM_MEASURES)
          .withColumn("_rid", F.monotonically_increasing_id()))
    ids = LINEITEM_IDS + ["_rid"]
    return pivot_back_discovered(unpivot_wide(li, ids, LINEITEM_MEASURES, "measure", "value"), ids, "measure", "value").drop("_rid")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT11 on a stream: ragged order rows arrive as files, good rows and rejects
    go to a sink each; the reject list is returned, the good rows not among them."""
    root = scratch_path(spark, "stream_rejects")
    _ragged_orders(spark, sf_dir).repartition(6).write.parquet(f"{root}/in")
    rows = stream_files(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema, max_files_per_trigger=2)
    reason = ragged_reason(F.array(*[F.lit(h) for h in ORDER_HEADER]), F.col("cells"))
    start_split_stream(rows, reason, f"{root}/good", f"{root}/rejects", f"{root}/ckpt").awaitTermination()
    return spark.read.parquet(f"{root}/rejects").select("o_orderkey", F.size("cells").alias("n_cells"), "reject_reason")


def stream_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2 and the first row of WIN3 on a stream: each user's events arrive in
    three runs by time; rows after the user's first error go, whichever run it
    came in, and every row carries the user's first time."""
    root = scratch_path(spark, "stream_truncate")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    low, high = ev.agg(F.min("ts"), F.max("ts")).first()
    edges = [low + (high - low) * k / 3 for k in (1, 2)] if low is not None else [None, None]
    part = F.when(F.col("ts") <= F.lit(edges[0]), 0).when(F.col("ts") <= F.lit(edges[1]), 1).otherwise(2)
    for k in range(3):
        ev.where(part == k).write.mode("append").parquet(f"{root}/in")
        rows = stream_files(spark, f"{root}/in", ev.schema)
        start_sequence_stream(rows, ["user_id"], ["ts", "event_id"], f"{root}/out", f"{root}/state", f"{root}/ckpt",
                              stop=F.col("event_type") == "error", first=F.col("ts")).awaitTermination()
    text = lambda c, name: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
    return spark.read.parquet(f"{root}/out").select("event_id", "user_id", text("ts", "ts"), "event_type", text("first_value", "first_ts"))


QUERIES |= {"pivot_back_discovered": pivot_back_without_labels, "stream_rejects": stream_rejects, "stream_truncate": stream_truncate}
