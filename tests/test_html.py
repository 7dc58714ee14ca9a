"""HTML source and report operators (FIXTURES.md sections 5-7)."""

from pyspark.sql import functions as F

from skein.functions.labels import NBSP, entry_value, kv_entries
from skein.operators.headers import classify_row, flatten_two_level
from skein.operators.rows import blank_cells, compact_cells, explode_body, nested_row, record_get, zip_record
from skein.sources.html import PageParser, parse_elements, parse_inputs, parse_tables


def nest(inner, levels=4, fillers=4):
    t = "<table>" + "".join(f"<tr><td>f{i}</td></tr>" for i in range(fillers)) + "<tr><td>" + inner + "</td></tr></table>"
    for _ in range(levels - 1):
        t = "<table><tr><td>" + t + "</td></tr></table>"
    return t


REPORT12 = ("<table><tr><td>Title</td></tr><tr><td>Sub</td><td></td></tr>"
            "<tr><td>Country</td><td>Week</td><td>Cases</td></tr>"
            "<tr><td>X<td>1<td>&nbsp;</tr>"            # unclosed cells
            "<tr><td>Y</td><td></td><td>9</td></tr>"
            "<tr><td>Z &amp; co<br></td><td>2</td></tr></table>")


def pages(spark, *docs):
    return spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "page_id long, html string")


def test_parser_rows_cells_and_entities():
    p = PageParser()
    p.feed(nest(REPORT12))
    p.finish()
    inner = [t for t in p.tables if t["depth"] == 5]
    assert len(inner) == 1 and inner[0]["parent_row_pos"] == 5
    cells = [r["cells"] for r in inner[0]["rows"]]
    assert cells == [["Title"], ["Sub", ""], ["Country", "Week", "Cases"], ["X", "1", NBSP], ["Y", "", "9"],
                     ["Z & co", "2"]]


def test_records_compact_and_keep(spark):
    t = parse_tables(pages(spark, "<html><body>" + nest(REPORT12) + "</body></html>", "<p>no table</p>"),
                     min_depth=5, parent_row_pos=5)
    hdr = compact_cells(nested_row("rows", 2)["cells"])
    body = explode_body(t, ["page_id"], 3, extra={"hdr": hdr})
    keys = ["Country", "Week", "Cases"]

    def recs(cells):
        r = body.select(zip_record("hdr", cells).alias("r"))
        return [tuple(x) for x in r.select(*[record_get("r", k) for k in keys]).collect()]

    assert recs(compact_cells("cells")) == [("X", "1", NBSP), ("Y", "9", None), ("Z & co", "2", None)]
    assert recs(F.col("cells")) == [("X", "1", NBSP), ("Y", "", "9"), ("Z & co", "2", None)]


def test_table_by_attribute_first_only(spark):
    doc = ('<table cols="4"><tr><td>a</td></tr></table><table cols="16"><tr><td>one</td></tr></table>'
           '<table cols="16"><tr><td>two</td></tr></table>')
    t = parse_tables(pages(spark, doc), table_attrs={"cols": "16"}, first_only=True)
    got = t.select(nested_row("rows", 0)["cells"][0].alias("c")).collect()
    assert [r["c"] for r in got] == ["one"]


REPORT16 = ("<tr><td><div>banner</div></td></tr>"
            "<tr><td><div>Place</div></td><td><div></div></td><td><div>All sites</div></td>"
            "<td><div>&nbsp;</div></td><td><div>Sentinel</div></td></tr>"
            "<tr>" + "".join(f"<td><div>{x}</div></td>" for x in
                             ["Country", "Week", "Cases", "Deaths", "Cases", "Deaths"]) + "</tr>"
            "<tr>" + "".join(f"<td><div><span>{x}</span></div></td>" for x in
                             ["X", "1", "5", "&nbsp;", "6", "0"]) + "</tr>")


def test_report16_classify_flatten_blank(spark):
    t = parse_tables(pages(spark, nest("<table>" + REPORT16 + "</table>", fillers=0)), min_depth=5)
    kind = lambda r: classify_row(r["n_div"], r["n_span"])
    r = t.select(F.transform("rows", kind).alias("kinds"),
                 F.filter("rows", lambda x: kind(x) == "header").alias("h"),
                 F.filter("rows", lambda x: kind(x) == "body").alias("b"))
    row = r.collect()[0]
    assert row["kinds"] == [None, "header", "header", "body"]
    up = compact_cells(F.get(F.col("h"), 0)["cells"], ("", NBSP))
    lo = compact_cells(F.get(F.col("h"), 1)["cells"], ("", NBSP))
    flat = r.select(flatten_two_level(up, lo).alias("f"),
                    blank_cells(compact_cells(F.get(F.col("b"), 0)["cells"])).alias("v")).collect()[0]
    assert flat["f"] == ["Place Country", "Place Week", "All sites Cases", "All sites Deaths",
                         "Sentinel Cases", "Sentinel Deaths"]
    assert flat["v"] == ["X", "1", "5", "", "6", "0"]


def test_flatten_geospread_and_too_many_markers(spark):
    df = spark.createDataFrame([(["G", "A"], ["c", "Geospread", "x", "Cases", "Cases"])], "u array<string>, l array<string>")
    assert df.select(flatten_two_level("u", "l")).collect()[0][0] == ["G c", "A Geospread", "A x", None, None]


def test_list_items_and_inputs(spark):
    doc = ('<ul><li><a href="/a">one</a></li><li>two &amp; three</li><li>open<li>last</ul>'
           '<input type="hidden" id="__VIEWSTATE" value="v1"><input id=\'__EVENTVALIDATION\' value=\'e\'/>'
           '<script>var s = "<li>not an item</li>";</script>')
    items = parse_elements(pages(spark, doc), "li").orderBy("item_no").collect()
    assert [r["text"] for r in items] == ["one", "two & three", "open", "last"]
    inp = parse_inputs(pages(spark, doc)).collect()[0]["inputs"]
    assert [m["id"] for m in inp] == ["__VIEWSTATE", "__EVENTVALIDATION"]
    assert inp[1]["value"] == "e"


def test_kv_entries(spark):
    df = spark.createDataFrame([("A: 1\n\nB: x: y\nA: 2\nbare",)], "t string")
    e = df.select(kv_entries("t").alias("e"))
    got = e.select(entry_value("e", "A"), entry_value("e", "B"), entry_value("e", "bare"),
                   entry_value("e", "missing")).collect()[0]
    assert tuple(got) == ("2", "x: y", None, None)


def test_blank_is_whole_cell_only_and_short_tables_give_no_records(spark):
    df = spark.createDataFrame([([NBSP, NBSP + "a", ""],)], "c array<string>")
    assert df.select(blank_cells("c")).collect()[0][0] == ["", NBSP + "a", ""]
    assert df.select(blank_cells("c", as_null=True)).collect()[0][0] == [None, NBSP + "a", ""]
    short = "<table><tr><td>Title</td></tr><tr><td>Sub</td></tr></table>"
    t = parse_tables(pages(spark, nest(short)), min_depth=5, parent_row_pos=5)
    assert t.count() == 1 and explode_body(t, ["page_id"], 3).count() == 0


def test_nested_table_text_and_row_positions():
    p = PageParser()
    p.feed("<table><tbody><tr><td>a<table><tr><td>x</td><td>y</td></tr></table></td><td>b</td></tr>"
           "<tr><td>c</td></tr></tbody></table>")
    p.finish()
    outer, inner = p.tables
    assert [r["cells"] for r in outer["rows"]] == [["axy", "b"], ["c"]]
    assert [r["row_pos"] for r in outer["rows"]] == [1, 2]
    assert inner["depth"] == 2 and inner["parent_row_pos"] == 1


def test_nested_lists_keep_the_text_after_the_inner_list(spark):
    from skein.sources.html import parse_elements

    pages = spark.createDataFrame([(1, "<ul><li>a<ul><li>b<li>d</ul>c</li><li>e</ul><li>f")], "page_id long, html string")
    got = {r["text"] for r in parse_elements(pages).collect()}
    assert got == {"abdc", "b", "d", "e", "f"}
