"""HTML report pages built from the given tables with Spark string functions
(JVM side). Every page holds a bounded group: one block of keys per page,
the nations of one region per report page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.plans.inputs import SEGMENTS
from skein.plans.tables import table

# A page holds the rows of one key block of PAGE_KEYS consecutive keys (customer or
# part keys) of one nation / brand: at most PAGE_KEYS rows, a proven bound.
PAGE_KEYS = 1000


def spread(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages built by an aggregation are few and small, so AQE would coalesce
    them into one task; an explicit round-robin spread keeps the Python parse
    on every core. (Pages read from files are already split by the scan.)"""
    return pages.repartition(spark.sparkContext.defaultParallelism)


def esc(c) -> Column:
    c = c if isinstance(c, Column) else F.col(c)
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def td(c, inner=None) -> Column:
    v = esc(c if isinstance(c, Column) else F.lit(c))
    if inner:
        v = F.concat(F.lit(f"<{inner}>"), v, F.lit(f"</{inner}>"))
    return F.concat(F.lit("<td>"), v, F.lit("</td>"))


def tr(*cells) -> Column:
    return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))


def raw(s: str) -> Column:
    return F.lit(s)


def _wrap(inner: Column, levels: int, filler_rows: int) -> Column:
    """Put ``inner`` in the ``filler_rows + 1``-th row of a table, itself nested
    in ``levels - 1`` more one-cell tables."""
    t = F.concat(raw("<table>"), *[raw(f"<tr><td>filler {i}</td></tr>") for i in range(filler_rows)],
                 raw("<tr><td>"), inner, raw("</td></tr></table>"))
    for _ in range(levels - 1):
        t = F.concat(raw("<table><tbody><tr><td>"), t, raw("</td></tr></tbody></table>"))
    return t


def money(col: str) -> Column:
    return F.col(col).cast("decimal(18,2)").cast("string")


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report-12 style pages: per nation and block of customer keys, an inner
    table (title, subtitle, header with an empty cell, one row per customer)
    in the 5th row of a table nested four deep."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey).withColumn("blk", F.floor(F.col("c_custkey") / PAGE_KEYS))
    g = j.groupBy("n_nationkey", "n_name", "blk").agg(
        F.array_sort(F.collect_list(F.struct("c_custkey", "c_name", "c_mktsegment", money("c_acctbal").alias("bal"))))
        .alias("cs"))
    body = F.array_join(F.transform("cs", lambda x: tr(td(x["c_custkey"].cast("string")), td(x["c_name"], "b"),
                                                      td(x["c_mktsegment"]), td(x["bal"]))), "")
    inner = F.concat(raw("<table class=\"data\">"), tr(td(F.col("n_name"))), tr(td("Customers"), raw("<td></td>")),
                     tr(td("Key"), td("Name"), raw("<td></td>"), td("Segment"), td("Balance")), body, raw("</table>"))
    html = F.concat(raw("<html><body><div id=\"report\">"), _wrap(inner, 4, 4), raw("<br></div></body></html>"))
    page_id = (F.col("blk") * 100 + F.col("n_nationkey")).cast("long")
    return spread(spark, g.select(page_id.alias("page_id"), html.alias("html")))


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report-2 style pages: a decoy table, then the first ``cols="16"`` table
    (title, brand, header, one row per part), then a second ``cols="16"`` table."""
    p = table(spark, sf_dir, "part").withColumn("blk", F.floor(F.col("p_partkey") / PAGE_KEYS))
    g = p.groupBy("p_brand", "blk").agg(F.array_sort(F.collect_list(F.struct(
        "p_partkey", "p_name", "p_type", F.col("p_size").cast("string").alias("size"),
        money("p_retailprice").alias("price")))).alias("ps"))
    body = F.array_join(F.transform("ps", lambda x: tr(td(x["p_partkey"].cast("string")), td(x["p_name"]),
                                                      td(x["p_type"]), td(x["size"]), td(x["price"]))), "")
    html = F.concat(
        raw("<html><body><table cols=\"4\"><tr><td>Legend</td></tr><tr><td>a</td><td>b</td></tr></table>"),
        raw("<table border=\"0\" cols=\"16\">"), tr(td("Parts")), tr(td(F.col("p_brand"))),
        tr(td("Key"), td("Name"), td("Type"), td("Size"), td("Price")), body, raw("</table>"),
        raw("<table cols=\"16\"><tr><td>Other</td></tr><tr><td>x</td></tr><tr><td>K</td></tr><tr><td>1</td></tr></table>"),
        raw("</body></html>"))
    brand_no = F.regexp_extract(F.col("p_brand"), r"(\d+)$", 1).cast("long")
    return spread(spark, g.select((F.col("blk") * 1000 + brand_no).alias("page_id"), html.alias("html")))


def _div(v: Column, span: bool = False) -> Column:
    inner = F.concat(raw("<span>"), v, raw("</span>")) if span else v
    return F.concat(raw("<td><div>"), inner, raw("</div></td>"))


def _count_cell(c: Column) -> Column:
    return F.when(c.isNull() | (c == 0), raw("&nbsp;")).otherwise(c.cast("string"))


def region_report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report-16 style pages, one per region: a banner row (one div), two header
    rows (divs, no span; the upper one with an empty and NBSP cells), one body
    row per nation (divs and a span): customers (Cases) and customers with a
    negative balance (Deaths) per segment, NBSP when zero."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    cnt = c.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("cases"), F.count_if(F.col("c_acctbal") < 0).alias("deaths"))
    per_nation = cnt.groupBy("c_nationkey").agg(
        F.map_from_entries(F.collect_list(F.struct("c_mktsegment", F.struct("cases", "deaths")))).alias("m"))
    nat = per_nation.join(n, per_nation.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    cells = [_div(esc(F.col("n_name")), span=True), _div(esc(F.col("r_name")))]
    for s in SEGMENTS:
        cells += [_div(_count_cell(F.col("m")[s]["cases"])), _div(_count_cell(F.col("m")[s]["deaths"]))]
    rows = nat.select("r_regionkey", "r_name", "n_nationkey", F.concat(raw("<tr>"), *cells, raw("</tr>")).alias("row"))
    pages = rows.groupBy("r_regionkey", "r_name").agg(
        F.array_sort(F.collect_list(F.struct("n_nationkey", "row"))).alias("rs"))
    banner = "<tr><td><div>Weekly report</div></td></tr>"
    h0 = "<tr><td><div>Place</div></td><td><div></div></td>" + "".join(
        f"<td><div>{s}</div></td><td><div>&nbsp;</div></td>" for s in SEGMENTS) + "</tr>"
    h1 = "<tr><td><div>Country</div></td><td><div>Region</div></td>" + "".join(
        "<td><div>Cases</div></td><td><div>Deaths</div></td>" for _ in SEGMENTS) + "</tr>"
    inner = F.concat(raw("<table>" + banner + h0 + h1), F.array_join(F.transform("rs", lambda x: x["row"]), ""),
                     raw("</table>"))
    html = F.concat(raw("<html><body><div id=\"report-content\"><div>"),
                    _wrap(inner, 4, 0), raw("</div></div></body></html>"))
    return spread(spark, pages.select(F.col("r_regionkey").cast("long").alias("page_id"), html.alias("html")))


# Ids of the hidden form fields a report page must carry exactly once.
HIDDEN_FIELDS = ("__VIEWSTATE", "__VIEWSTATEGENERATOR", "__EVENTVALIDATION")


def form_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages with hidden inputs injected after <body>: the generator
    field is missing on '/de/' pages, the validation field is doubled on https
    pages; attribute order and quoting vary."""
    pg = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    pid = F.col("page_id").cast("string")
    vs = F.concat(raw("<input type=\"hidden\" name=\"__VIEWSTATE\" id=\"__VIEWSTATE\" value=\"vs-"), pid, raw("\" />"))
    gen = F.when(F.col("url").contains("/de/"), raw("")).otherwise(
        F.concat(raw("<input id='__VIEWSTATEGENERATOR' type=hidden value='gen-"), pid, raw("'>")))
    ev = F.concat(raw("<input value=\"ev-"), pid, raw("\" type=\"hidden\" id=\"__EVENTVALIDATION\">"))
    ev2 = F.when(F.col("url").startswith("https:"),
                 F.concat(raw("<input type=\"hidden\" id=\"__EVENTVALIDATION\" value=\"ev2-"), pid, raw("\">"))) \
        .otherwise(raw(""))
    form = F.concat(raw("<form method=\"post\">"), vs, gen, ev, ev2, raw("</form>"))
    html = F.replace(F.col("html"), raw("<body>"), F.concat(raw("<body>"), form))
    return pg.select("page_id", html.alias("html"))


def supplier_browser_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report-2 browser pages: every row has divs and no span, so all rows are
    'header' rows; row 1 holds the column names (the first one empty), rows 2+
    are data; a negative balance is shown as NBSP."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey).withColumn("blk", F.floor(F.col("s_suppkey") / PAGE_KEYS))
    bal = F.when(F.col("s_acctbal") < 0, raw("&nbsp;")).otherwise(esc(money("s_acctbal")))
    row = F.concat(raw("<tr>"), _div(raw("&nbsp;")), _div(F.col("s_suppkey").cast("string")),
                   _div(esc(F.col("s_name"))), _div(bal), raw("</tr>"))
    g = j.groupBy("n_nationkey", "n_name", "blk").agg(
        F.array_sort(F.collect_list(F.struct("s_suppkey", row.alias("row")))).alias("rs"))
    head = F.concat(raw("<tr>"), _div(raw("Report")), _div(esc(F.col("n_name"))), raw("</tr>"),
                    raw("<tr>"), _div(raw("")), _div(raw("Supplier")), _div(raw("Name")), _div(raw("Balance")),
                    raw("</tr>"))
    inner = F.concat(raw("<table>"), head, F.array_join(F.transform("rs", lambda x: x["row"]), ""), raw("</table>"))
    html = F.concat(raw("<html><body><div id=\"report-content\"><div>"),
                    _wrap(inner, 4, 0), raw("</div></div></body></html>"))
    page_id = (F.col("blk") * 100 + F.col("n_nationkey")).cast("long")
    return spread(spark, g.select(page_id.alias("page_id"), html.alias("html")))


def order_browser_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report-12 browser pages, one per region: a title header row, a column
    header row starting with an empty cell, a first body row 'Data from : All
    sites', then one body row per nation and year (orders, urgent orders; NBSP
    when zero), each starting with an empty cell."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    agg = j.groupBy("n_regionkey", "n_nationkey", "n_name", F.year("o_orderdate").alias("yr")).agg(
        F.count(F.lit(1)).alias("cnt"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    row = F.concat(raw("<tr>"), _div(raw("")), _div(esc(F.col("n_name")), span=True),
                   _div(F.col("yr").cast("string")), _div(F.col("cnt").cast("string")),
                   _div(_count_cell(F.col("urgent"))), raw("</tr>"))
    g = agg.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "yr", row.alias("row"))))
                                       .alias("rs"))
    head = ("<tr><td><div>Flu report</div></td><td><div>by country</div></td></tr>"
            "<tr><td><div></div></td><td><div>Country</div></td><td><div>Year</div></td>"
            "<td><div>Orders</div></td><td><div>Urgent</div></td></tr>"
            "<tr><td><div><span>Data from : all sources</span></div></td><td><div></div></td></tr>")
    inner = F.concat(raw("<table>" + head), F.array_join(F.transform("rs", lambda x: x["row"]), ""), raw("</table>"))
    html = F.concat(raw("<html><body><div id=\"report-content\"><div>"),
                    _wrap(inner, 4, 0), raw("</div></div></body></html>"))
    return spread(spark, g.select(F.col("n_regionkey").cast("long").alias("page_id"), html.alias("html")))
