"""Build the human-made inputs the operators expect (wide panels, ragged
rows) from the given tables, as Spark jobs whose work grows with the tables.

Weeks and months run from the first to the last order (two scalars of one
aggregate); segments, priorities and regions are the fixed TPC-H domains.
Every aggregate is a
``groupBy`` with a map-side partial aggregate; the grouped cells that are
collected into one row are bounded by the label list (e.g. 5 priorities).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.plans.tables import table
from skein.session import shared_dir

# Fixed domain values of the TPC-H tables used as header labels.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

REGIONS = (0, 1, 2, 3, 4)


def order_span(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    """Days of the first and last order (one row reaches the driver); without orders a single day."""
    d = F.to_date("o_orderdate")
    lo, hi = table(spark, sf_dir, "orders").agg(F.min(d), F.max(d)).first()
    return (lo, hi) if lo is not None else (dt.date(1996, 1, 1), dt.date(1996, 1, 1))


def order_weeks(spark: SparkSession, sf_dir: str) -> list[dt.date]:
    """The Mondays of all weeks with orders between the first and the last."""
    lo, hi = order_span(spark, sf_dir)
    first = lo - dt.timedelta(days=lo.weekday())
    return [first + dt.timedelta(days=7 * i) for i in range((hi - first).days // 7 + 1)]


def week_no(first: dt.date):
    return F.floor(F.datediff(F.to_date("o_orderdate"), F.lit(first)) / 7).cast("int")


def cut_lineage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write a small derived aggregate once (reliable checkpoint in the shared
    folder) so the several branches that read it do not recompute the joins
    and aggregation under it."""
    shared_dir(spark)
    return df.checkpoint(eager=True)


def price(col: str = "o_totalprice"):
    return F.col(col).cast("decimal(18,2)")


def orders_placed(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """orders with the customer's segment, nation and region (keys joined;
    strategy left to Catalyst/AQE: nation is broadcast by measured size)."""
    o = orders if orders is not None else table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .drop("c_custkey", "c_nationkey", "n_nationkey"))


def weekly_paired_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide panel (MX layout): one row per customer with orders, a
    ``Un SEM - WW/YYYY`` (orders) and a ``Lc SEM - WW/YYYY`` (value) column per
    ISO week from the first to the last order; empty cells NULL."""
    mondays = order_weeks(spark, sf_dir)
    j = orders_placed(spark, sf_dir).withColumn("wk", week_no(mondays[0]))
    ids = ["o_custkey", "n_name", "c_mktsegment"]
    agg = j.groupBy(*ids, "wk").agg(F.count(F.lit(1)).alias("u"), F.sum(price()).cast("decimal(18,2)").alias("v"))
    per_row = agg.groupBy(*ids).agg(F.map_from_entries(F.collect_list(F.struct("wk", F.struct("u", "v")))).alias("m"))
    weeks = F.sequence(F.lit(0), F.lit(len(mondays) - 1))
    # Arrays first, columns from them: two short expressions in the plan, not two a week.
    wide = per_row.select(*ids, *[F.transform(weeks, lambda w: F.col("m")[w][x]).alias(x) for x in ("u", "v")])
    labels = ["{1:02d}/{0}".format(*d.isocalendar()) for d in mondays]
    return wide.selectExpr(*ids, *[f"get({g}, {i}) AS `{token} SEM - {x}`"
                                   for g, token in (("u", "Un"), ("v", "Lc")) for i, x in enumerate(labels)])


def weekly_paired_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MX panels of all ISO years with orders as ragged rows, one table (file
    ``weekly_<year>.xlsx``) per year, all from one aggregation: header
    ``n_name, c_mktsegment, Un SEM - WW/YYYY..., Lc SEM - WW/YYYY...`` with as
    many weeks as the year has; one body row per nation x segment; empty
    cells NULL. Rows per year are bounded by the nation x segment domain."""
    first, last = (d.isocalendar()[0] for d in order_span(spark, sf_dir))
    years = range(first, last + 1)
    n_weeks = {y: dt.date(y, 12, 28).isocalendar()[1] for y in years}
    yr = F.date_part(F.lit("YEAROFWEEK"), F.col("o_orderdate")).cast("int")
    j = orders_placed(spark, sf_dir).select("n_name", "c_mktsegment", yr.alias("yr"),
                                            F.weekofyear("o_orderdate").alias("wk"), price().alias("p"))
    agg = (j.groupBy("yr", "n_name", "c_mktsegment", "wk")
           .agg(F.count(F.lit(1)).alias("u"), F.sum("p").cast("decimal(18,2)").alias("v")))
    per_row = agg.groupBy("yr", "n_name", "c_mktsegment").agg(
        F.map_from_entries(F.collect_list(F.struct("wk", F.struct("u", "v")))).alias("m"))
    nweeks = F.lit(52)
    for y, nw in n_weeks.items():
        nweeks = F.when(F.col("yr") == y, F.lit(nw)).otherwise(nweeks)
    weeks = F.sequence(F.lit(1), nweeks)
    body = per_row.select(
        "yr", "n_name", "c_mktsegment",
        F.concat(F.array("n_name", "c_mktsegment"),
                 F.transform(weeks, lambda w: F.col("m")[w]["u"].cast("string")),
                 F.transform(weeks, lambda w: F.col("m")[w]["v"].cast("string"))).alias("cells"))
    # Row order inside one year's table: a window over one year (bounded: nations x segments).
    body = body.select("yr", (F.row_number().over(Window.partitionBy("yr").orderBy("n_name", "c_mktsegment")))
                       .cast("int").alias("row_no"), "cells")

    def label(prefix):
        return lambda w: F.concat(F.lit(prefix), F.lpad(w.cast("string"), 2, "0"), F.lit("/"),
                                  F.col("yr").cast("string"))

    head = (spark.createDataFrame([(y,) for y in years], "yr int")
            .select("yr", F.lit(0).alias("row_no"),
                    F.concat(F.array(F.lit("n_name"), F.lit("c_mktsegment")),
                             F.transform(weeks, label("Un SEM - ")), F.transform(weeks, label("Lc SEM - ")))
                    .alias("cells")))
    return head.unionByName(body).select(
        F.concat(F.lit("weekly_"), F.col("yr").cast("string"), F.lit(".xlsx")).alias("source"), "row_no", "cells")


def order_months(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """``(year, month)`` of all months from the first to the last order."""
    lo, hi = order_span(spark, sf_dir)
    return [(k // 12, k % 12 + 1) for k in range(lo.year * 12 + lo.month - 1, hi.year * 12 + hi.month)]


def monthly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide panel (JP layout): priority x status rows, ``YYYY/M-`` month columns
    holding the order value; empty cells NULL. Status is an id column, so one
    folder file per status is a filter on it."""
    months = order_months(spark, sf_dir)
    o = table(spark, sf_dir, "orders")
    lbl = F.concat(F.year("o_orderdate").cast("string"), F.lit("/"), F.month("o_orderdate").cast("string"), F.lit("-"))
    labels = [f"{y}/{m}-" for y, m in months]
    return (o.withColumn("m", lbl).groupBy("o_orderpriority", "o_orderstatus")
            .pivot("m", labels).agg(F.sum(price()).cast("decimal(18,2)")))


def weekly_text_cells(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str], int]:
    """A text panel (JP2 layout) as cell arrays, its headers and its start year:
    status x priority rows, ``M.d-`` week columns (no year in the header; a day
    that comes again in a later year gets ``.1``, ``.2``, as a sheet reader
    names repeats). Cell: order count as text, ``-`` when the week has no
    order, NULL (unknown) when it has exactly one."""
    mondays = order_weeks(spark, sf_dir)
    agg = (table(spark, sf_dir, "orders").withColumn("wk", week_no(mondays[0]))
           .groupBy("o_orderstatus", "o_orderpriority", "wk").count())
    per_row = agg.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.map_from_entries(F.collect_list(F.struct("wk", "count"))).alias("m"))
    n = lambda w: F.col("m")[w]
    cells = F.transform(F.sequence(F.lit(0), F.lit(len(mondays) - 1)), lambda w: F.when(n(w).isNull(), F.lit("-"))
                        .when(n(w) != 1, n(w).cast("string")))
    days = [f"{d.month}.{d.day}-" for d in mondays]
    names = [x if x not in days[:i] else f"{x}.{days[:i].count(x)}" for i, x in enumerate(days)]
    return per_row.select("o_orderstatus", "o_orderpriority", cells.alias("cells")), names, mondays[0].year


def region_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per month ``k`` (year * 12 + month - 1), region and segment: the only
    part of the region-block sheets that grows with the data, aggregated once
    and written to the shared checkpoint folder."""
    k = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("int")
    return cut_lineage(spark, orders_placed(spark, sf_dir).withColumn("k", k)
                       .groupBy("k", "n_regionkey", "c_mktsegment").count())


def region_block_rows(spark: SparkSession, sf_dir: str, regions=REGIONS,
                      source: str = "asia_visitors.xlsx", counts: DataFrame | None = None) -> DataFrame:
    """Ragged rows (CN layout) of one sheet: 4 title rows, a header row
    ``No, Period`` + (``Total`` + segments) per region block, one body row per
    month (every calendar month from the first to the last order) and a summary
    row. Cells hold order counts as text, '' when zero. ``counts`` (from
    ``region_month_counts``) lets several sheets share one aggregation."""
    months = order_months(spark, sf_dir)
    k0 = months[0][0] * 12 + months[0][1] - 1
    regions = tuple(regions)
    counts = (counts if counts is not None else region_month_counts(spark, sf_dir)) \
        .withColumn("k", F.col("k") - k0)
    key = F.concat(F.col("n_regionkey").cast("string"), F.lit("|"), F.col("c_mktsegment"))
    seg = counts.filter(F.col("n_regionkey").isin(*regions)).withColumn("key", key)
    # Segment counts per month in one bounded map (regions x 5 segments); the
    # region totals are sums inside that map, so no second aggregation is needed.
    cells_by_k = seg.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("key", "count"))).alias("m"))

    def cell(m, r, x):
        if x == "Total":
            total = sum((F.coalesce(m[f"{r}|{g}"], F.lit(0)) for g in SEGMENTS[1:]),
                        F.coalesce(m[f"{r}|{SEGMENTS[0]}"], F.lit(0)))
            return F.when(total > 0, total.cast("string")).otherwise(F.lit(""))
        return F.coalesce(m[f"{r}|{x}"].cast("string"), F.lit(""))

    cells = [(r, x) for r in regions for x in ("Total",) + SEGMENTS]
    cal = spark.range(len(months)).select(F.col("id").cast("int").alias("k"))
    body = cal.join(cells_by_k, "k", "left")
    first_cells = [F.lit(f"{months[0][0]} \u3000\uff0e{MONTH_NAMES[months[0][1] - 1]}")]
    period = F.when(F.col("k") == 0, first_cells[0]).otherwise(
        F.concat(F.lit(""), F.floor((F.col("k") + k0) / 12).cast("string"), F.lit("/"),
                 ((F.col("k") + k0) % 12 + 1).cast("string")))
    body_rows = body.select(
        (F.col("k") + 5).alias("row_no"),
        F.array((F.col("k") + 1).cast("string"), period, *[cell(F.col("m"), r, x) for r, x in cells]).alias("cells"))
    summary = (seg.groupBy("key").agg(F.sum("count").alias("count"))
               .agg(F.map_from_entries(F.collect_list(F.struct("key", "count"))).alias("m"))
               .select(F.lit(5 + len(months)).alias("row_no"),
                       F.array(F.lit(""), F.lit("Total"), *[cell(F.col("m"), r, x) for r, x in cells]).alias("cells")))
    header = ["No", "Period"] + [x for _ in regions for x in ("Total",) + SEGMENTS]
    top = spark.createDataFrame(
        [(0, ["Visitor arrivals"]), (1, ["by region and purpose"]), (2, [""]), (3, ["(persons)"]),
         (4, header)], "row_no int, cells array<string>")
    return (top.unionByName(body_rows).unionByName(summary)
            .select(F.lit(source).alias("source"), "row_no", "cells"))


def ragged_nation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ragged rows, one table per nation: header ``segment`` + the five
    priorities in a nation-specific order (rotated by nation key); one body row
    per segment with order counts as text (NULL when none)."""
    j = orders_placed(spark, sf_dir)
    cnt = cut_lineage(spark, j.groupBy("n_name", "n_regionkey", "c_mktsegment", "o_orderpriority").count())
    nat = table(spark, sf_dir, "nation").select("n_name", "n_nationkey")
    pr = F.array(*[F.lit(p) for p in PRIORITIES])
    rot = F.transform(pr, lambda p, i: F.element_at(pr, ((i + F.col("n_nationkey")) % 5 + 1).cast("int")))
    hdr = nat.select("n_name", F.concat(F.array(F.lit("segment")), rot).alias("hdr"))
    header_rows = hdr.select(F.col("n_name").alias("source"), F.lit(0).alias("row_no"), F.col("hdr").alias("cells"))
    by_segment = Window.partitionBy("n_name").orderBy("c_mktsegment")  # bounded: the segments of one nation
    body = (cnt.groupBy("n_name", "c_mktsegment")
            .agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "count"))).alias("m"))
            .join(hdr, "n_name")
            .select(F.col("n_name").alias("source"),
                    F.row_number().over(by_segment).cast("int").alias("row_no"),
                    F.concat(F.array(F.col("c_mktsegment")),
                             F.transform(F.slice(F.col("hdr"), 2, 5), lambda p: F.col("m")[p].cast("string")))
                    .alias("cells")))
    return header_rows.unionByName(body)
