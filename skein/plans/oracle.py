"""DuckDB SQL oracles, written from the base tables (never by replaying the
operator's own steps). Column names and types equal the Spark query's."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_SEGMENTS = "(VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY')) s(seg)"
_PRIORITIES = "(VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) p(pri)"
_PLACED = """orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
# First and last order day, the months and the Mondays between them.
_SPAN = "span AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders)"
_MONTHS = """m AS (SELECT CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi),
                                 INTERVAL 1 MONTH)) AS DATE) AS mon FROM span)"""
_WEEKS = """w AS (SELECT CAST(unnest(generate_series(date_trunc('week', lo), hi, INTERVAL 7 DAY)) AS DATE) AS mon FROM span)"""

ORACLE["unpivot_measures"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_quantity' AS measure, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_extendedprice', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_tax', l_tax FROM lineitem
"""

# One panel row per customer with orders, every ISO week between the first and last order; empty cells NULL.
ORACLE["unpivot_paired_weeks"] = f"""
WITH {_SPAN}, {_WEEKS},
j AS (SELECT o_custkey, n_name, c_mktsegment, o_totalprice, CAST(date_trunc('week', o_orderdate) AS DATE) AS mon FROM {_PLACED}),
g AS (SELECT DISTINCT o_custkey, n_name, c_mktsegment FROM j),
a AS (SELECT o_custkey, mon, count(*) AS u,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS v
      FROM j GROUP BY ALL)
SELECT g.o_custkey, g.n_name, g.c_mktsegment,
       CAST(isoyear(w.mon) AS VARCHAR) || '_' || lpad(CAST(week(w.mon) AS VARCHAR), 2, '0') AS WeekOfYear,
       CAST(a.u AS DOUBLE) AS Unit, CAST(a.v AS DOUBLE) AS Value
FROM g CROSS JOIN w
LEFT JOIN a ON a.o_custkey = g.o_custkey AND a.mon = w.mon
"""

ORACLE["unpivot_month_labels"] = f"""
WITH {_SPAN}, {_MONTHS},
g AS (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders),
a AS (SELECT o_orderpriority, o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS mon,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS v
      FROM orders GROUP BY ALL)
SELECT g.o_orderpriority, g.o_orderstatus, strftime(m.mon, '%Y/%m') AS YearMonth, CAST(a.v AS DOUBLE) AS Value
FROM g CROSS JOIN m
LEFT JOIN a ON a.o_orderpriority = g.o_orderpriority AND a.o_orderstatus = g.o_orderstatus AND a.mon = m.mon
"""

# Weeks without an order are placeholders and go; weeks with exactly one order are unknown (NULL).
ORACLE["unpivot_week_sequence"] = """
SELECT o_orderstatus, o_orderpriority, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS Date,
       CASE WHEN count(*) = 1 THEN NULL ELSE CAST(count(*) AS VARCHAR) END AS Value
FROM orders GROUP BY o_orderstatus, o_orderpriority, date_trunc('week', o_orderdate)
"""

# Third region block = region 2; months from the first order to 2000-12 (cut-off 200012); zero counts are empty -> NULL.
ORACLE["unpivot_region_block"] = f"""
WITH {_SPAN}, {_MONTHS},
a AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mon, c_mktsegment AS seg, count(*) AS n
      FROM {_PLACED} WHERE n_regionkey = 2 GROUP BY ALL)
SELECT 'ASIA' AS Country, strftime(m.mon, '%Y%m') AS Date, s.seg AS Visit_Purpose, CAST(a.n AS DOUBLE) AS Visitors
FROM m CROSS JOIN {_SEGMENTS}
LEFT JOIN a ON a.mon = m.mon AND a.seg = s.seg
WHERE m.mon <= DATE '2000-12-01'
"""

ORACLE["unpivot_ragged"] = f"""
WITH a AS (SELECT n_name, c_mktsegment, o_orderpriority, count(*) AS n FROM {_PLACED} GROUP BY ALL),
g AS (SELECT DISTINCT n_name, c_mktsegment FROM a)
SELECT g.n_name, g.c_mktsegment, p.pri AS o_orderpriority, CAST(a.n AS DOUBLE) AS n_orders
FROM g CROSS JOIN {_PRIORITIES}
LEFT JOIN a ON a.n_name = g.n_name AND a.c_mktsegment = g.c_mktsegment AND a.o_orderpriority = p.pri
"""

ORACLE["pair_by_position"] = """
WITH r AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS pos,
                  l_linenumber AS left_linenumber, l_quantity AS left_quantity FROM lineitem WHERE l_returnflag = 'R'),
a AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS pos,
             l_linenumber AS right_linenumber, l_quantity AS right_quantity FROM lineitem WHERE l_returnflag = 'A')
SELECT r.l_orderkey, r.pos, left_linenumber, left_quantity, right_linenumber, right_quantity
FROM r JOIN a ON r.l_orderkey = a.l_orderkey AND r.pos = a.pos
"""

ORACLE["pivot_back"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
"""

ORACLE["drop_placeholder"] = """
SELECT event_id, user_id, event_type,
       CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value_text
FROM events WHERE event_type <> 'error'
"""

ORACLE["truncate_after_first"] = """
WITH e AS (SELECT event_id, user_id, ts, event_type,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
c AS (SELECT *, min(CASE WHEN event_type = 'error' THEN rn END) OVER (PARTITION BY user_id) AS cut FROM e)
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type FROM c
WHERE cut IS NULL OR rn <= cut
"""

ORACLE["header_occurrence"] = """
WITH x AS (SELECT l_orderkey, l_returnflag AS label,
                  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS col_no
           FROM lineitem)
SELECT l_orderkey, col_no, label,
       CAST(row_number() OVER (PARTITION BY l_orderkey, label ORDER BY col_no) AS INTEGER) AS occurrence FROM x
UNION ALL
SELECT l_orderkey, CAST(count(*) AS INTEGER) AS col_no, '' AS label, 1 AS occurrence FROM lineitem GROUP BY l_orderkey
"""

ORACLE["flatten_two_level"] = """
WITH n AS (SELECT r_name, n_name, n_nationkey,
                  CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER) AS k
           FROM nation JOIN region ON n_regionkey = r_regionkey),
r AS (SELECT DISTINCT r_name FROM n)
SELECT r_name, 0 AS col_no, 'Place Country' AS column_name FROM r
UNION ALL SELECT r_name, 1, 'Place Week' FROM r
UNION ALL SELECT r_name, 2 * k, n_name || ' ' || CASE WHEN n_nationkey % 2 = 0 THEN 'Cases' ELSE 'Geospread' END FROM n
UNION ALL SELECT r_name, 2 * k + 1, n_name || ' Deaths' FROM n
"""

ORACLE["kv_text"] = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'URGENT-' || o_orderstatus ELSE o_orderstatus END AS status,
       o_orderpriority AS priority,
       'total: ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS note
FROM orders
"""

ORACLE["report_filter"] = f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, n_name, c_mktsegment FROM {_PLACED}
WHERE isoyear(o_orderdate) * 100 + week(o_orderdate) BETWEEN 199610 AND 199720
  AND lower(n_name) = 'nation_7' AND lower(c_mktsegment) = 'building'
"""

ORACLE["ragged_rejects"] = """
SELECT o_orderkey,
       CASE o_orderpriority WHEN '5-LOW' THEN 3 WHEN '1-URGENT' THEN 5 ELSE 4 END AS n_cells,
       CASE o_orderpriority WHEN '5-LOW' THEN 'short_row' WHEN '1-URGENT' THEN 'long_row' END AS reject_reason
FROM orders
"""

ORACLE["html_records"] = """
SELECT n_name, c_custkey, c_name, c_mktsegment, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS c_acctbal
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

ORACLE["html_path_records"] = """
SELECT 'page ' || CAST(c_custkey // 1000 * 100 + n_nationkey AS VARCHAR) AS page_id, 'report' AS container, n_name, c_custkey, c_mktsegment,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS c_acctbal
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

# Rows 0 to 2 are title, subtitle and header; customers follow by key.
ORACLE["html_rejects"] = """
WITH c AS (SELECT c_custkey // 1000 * 100 + c_nationkey AS page_id, c_nationkey, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
r AS (SELECT *, CAST(2 + row_number() OVER (PARTITION BY page_id ORDER BY c_custkey) AS INTEGER) AS row_no FROM c)
SELECT DISTINCT page_id, CAST(NULL AS INTEGER) AS row_no, 'no_table' AS reason, CAST(NULL AS VARCHAR) AS first_cell FROM c WHERE c_nationkey = 3
UNION ALL SELECT DISTINCT page_id, CAST(NULL AS INTEGER), 'short_table', CAST(NULL AS VARCHAR) FROM c WHERE c_nationkey = 4
UNION ALL SELECT page_id, row_no, 'short_row', CAST(c_custkey AS VARCHAR) FROM r WHERE c_nationkey NOT IN (3, 4) AND c_custkey % 10 = 7
"""

ORACLE["report_pages_csv"] = """
SELECT 'report12' AS report, n_name AS country, c_custkey AS "Key", c_name AS "Name", c_mktsegment AS "Segment",
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS "Balance"
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

ORACLE["html_table_by_attr"] = """
SELECT p_brand, p_partkey, p_name, p_type, p_size, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS p_retailprice
FROM part
"""

# Row numbers: 0 banner (dropped), 1-2 headers, then nations of the region in key order (3, 4, ...).
ORACLE["html_classify_rows"] = """
WITH n AS (SELECT DISTINCT n_regionkey, n_nationkey, n_name FROM nation JOIN customer ON c_nationkey = n_nationkey),
r AS (SELECT DISTINCT n_regionkey FROM n)
SELECT CAST(n_regionkey AS BIGINT) AS page_id, 1 AS row_no, 'header' AS row_kind, 6 AS n_cells, 'Place' AS first_cell FROM r
UNION ALL SELECT CAST(n_regionkey AS BIGINT), 2, 'header', 12, 'Country' FROM r
UNION ALL SELECT CAST(n_regionkey AS BIGINT),
       CAST(2 + row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER), 'body', 12, n_name FROM n
"""


def _matrix_sql():
    segs = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    cols = []
    for s in segs:
        for m, cond in (("Cases", "TRUE"), ("Deaths", "c_acctbal < 0")):
            cols.append(f"""CASE WHEN count(*) FILTER (WHERE c_mktsegment = '{s}' AND {cond}) = 0 THEN ''
             ELSE CAST(count(*) FILTER (WHERE c_mktsegment = '{s}' AND {cond}) AS VARCHAR) END AS "{s} {m}" """)
    return ("SELECT n_name AS \"Place Country\", r_name AS \"Place Region\", " + ", ".join(cols) +
            " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
            " GROUP BY n_name, r_name")


ORACLE["html_report_matrix"] = _matrix_sql()

ORACLE["page_list_items"] = """
SELECT page_id, CAST(i - 1 AS INTEGER) AS item_no, regexp_replace(x, '<[^>]*>', '', 'g') AS text
FROM pages, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) WITH ORDINALITY AS t(x, i)
"""

ORACLE["form_fields"] = """
SELECT page_id, '__VIEWSTATE' AS field, 1 AS n, 'vs-' || page_id AS value, 'ok' AS status FROM pages
UNION ALL
SELECT page_id, '__VIEWSTATEGENERATOR',
       CASE WHEN url LIKE '%/de/%' THEN 0 ELSE 1 END,
       CASE WHEN url LIKE '%/de/%' THEN NULL ELSE 'gen-' || page_id END,
       CASE WHEN url LIKE '%/de/%' THEN 'missing' ELSE 'ok' END FROM pages
UNION ALL
SELECT page_id, '__EVENTVALIDATION',
       CASE WHEN url LIKE 'https:%' THEN 2 ELSE 1 END,
       CASE WHEN url LIKE 'https:%' THEN NULL ELSE 'ev-' || page_id END,
       CASE WHEN url LIKE 'https:%' THEN 'duplicate' ELSE 'ok' END FROM pages
"""

ORACLE["xlsx_roundtrip"] = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"

ORACLE["path_columns"] = "SELECT 'MX' AS country, '1996' AS start_year, p_partkey, p_name FROM part"

ORACLE["csv_roundtrip"] = """
SELECT p_partkey, p_name, p_type, p_size, p_retailprice,
       CASE WHEN p_size < 10 THEN NULL WHEN p_size > 45 THEN 'say "hi" | bye' ELSE p_type END AS note, p_brand
FROM part
"""

ORACLE["stream_unpivot"] = ORACLE["unpivot_measures"]

ORACLE["unpivot_panel_files"] = f"""
WITH {_SPAN},
j AS (SELECT n_name, c_mktsegment, o_totalprice, isoyear(o_orderdate) AS yr, week(o_orderdate) AS wk FROM {_PLACED}),
g AS (SELECT DISTINCT yr, n_name, c_mktsegment FROM j),
y AS (SELECT unnest(generate_series(isoyear(lo), isoyear(hi))) AS yr FROM span),
w AS (SELECT y.yr, r.range AS wk FROM y, range(1, 54) r WHERE r.range <= week(make_date(y.yr, 12, 28))),
a AS (SELECT n_name, c_mktsegment, yr, wk, count(*) AS u,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS v FROM j GROUP BY ALL)
SELECT g.n_name, g.c_mktsegment, CAST(g.yr AS VARCHAR) || '_' || lpad(CAST(w.wk AS VARCHAR), 2, '0') AS WeekOfYear,
       CAST(a.u AS DOUBLE) AS Unit, CAST(a.v AS DOUBLE) AS Value
FROM g JOIN w ON w.yr = g.yr
LEFT JOIN a ON a.yr = g.yr AND a.n_name = g.n_name AND a.c_mktsegment = g.c_mktsegment AND a.wk = w.wk
"""

ORACLE["convert_folder"] = ORACLE["unpivot_month_labels"]

ORACLE["html_header_rows_as_body"] = """
SELECT n_name, s_suppkey, s_name,
       CASE WHEN s_acctbal < 0 THEN '' ELSE CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS balance
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

ORACLE["html_skip_first_body_row"] = f"""
SELECT n_name AS "Country", CAST(year(o_orderdate) AS VARCHAR) AS "Year", CAST(count(*) AS VARCHAR) AS "Orders",
       CASE WHEN count(*) FILTER (WHERE o_orderpriority = '1-URGENT') = 0 THEN ''
            ELSE CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS VARCHAR) END AS "Urgent"
FROM {_PLACED} GROUP BY n_name, year(o_orderdate)
"""

ORACLE["stream_panel_files"] = ORACLE["xlsx_source_panel"] = ORACLE["xlsx_source_stream"] = ORACLE["unpivot_panel_files"]

ORACLE["convert_folder_blocks"] = f"""
WITH {_SPAN}, {_MONTHS},
a AS (SELECT n_regionkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mon, c_mktsegment AS seg, count(*) AS n
      FROM {_PLACED} WHERE n_regionkey IN (2, 4) GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('visitors_a.xlsx', 2), ('visitors_b.xlsx', 4)) f(file, reg))
SELECT 'ASIA' AS Country, strftime(m.mon, '%Y%m') AS Date, s.seg AS Visit_Purpose, CAST(a.n AS DOUBLE) AS Visitors, f.file
FROM f CROSS JOIN m CROSS JOIN {_SEGMENTS}
LEFT JOIN a ON a.n_regionkey = f.reg AND a.mon = m.mon AND a.seg = s.seg
WHERE m.mon <= DATE '2000-12-01'
"""

ORACLE["convert_folder_rejects"] = ORACLE["unpivot_week_sequence"]

ORACLE["stream_region_blocks"] = ORACLE["convert_folder_blocks"]

ORACLE["html_records_discovered"] = """
SELECT n_name, CAST(c_custkey AS VARCHAR) AS "Key", c_name AS "Name", c_mktsegment AS "Segment",
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS "Balance"
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

ORACLE["pivot_back_discovered"] = ORACLE["pivot_back"]

ORACLE["stream_rejects"] = """
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 3 ELSE 5 END AS n_cells,
       CASE o_orderpriority WHEN '5-LOW' THEN 'short_row' ELSE 'long_row' END AS reject_reason
FROM orders WHERE o_orderpriority IN ('5-LOW', '1-URGENT')
"""

ORACLE["stream_truncate"] = """
WITH e AS (SELECT event_id, user_id, ts, event_type, min(ts) OVER (PARTITION BY user_id) AS first_ts,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
c AS (SELECT *, min(CASE WHEN event_type = 'error' THEN rn END) OVER (PARTITION BY user_id) AS cut FROM e)
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type,
       strftime(first_ts, '%Y-%m-%d %H:%M:%S.%f') AS first_ts FROM c
WHERE cut IS NULL OR rn <= cut
"""
