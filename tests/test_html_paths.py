"""Rows by path: axes, positions, containers, lenient HTML, text page ids, nested tables."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skein.operators.rows import report_rejects
from skein.sources.html import parse_elements, parse_inputs, parse_tables
from skein.sources.html_paths import RowSelector, select_rows, steps_of


def cells(html, path, **kw):
    options = {"cell_tags": ("td",), "direct": False, "imply_tbody": False} | kw
    return [r["cells"] for r in RowSelector(steps_of(path), **options).selected(html)]


NEST = "<table><tr><td>1<tr><td>2<table><tr><td>a</td><td>b<tr><td>c</table>after</table>"


def test_axes_and_cells():
    assert cells(NEST, "//tr") == [["1"], ["2abcafter", "a", "b", "c"], ["a", "b"], ["c"]]
    assert cells(NEST, "//tr", direct=True) == [["1"], ["2abcafter"], ["a", "b"], ["c"]]
    assert cells(NEST, "/table/tr") == [["1"], ["2abcafter", "a", "b", "c"]]
    assert cells(NEST, "//table//table/tr") == [["a", "b"], ["c"]]
    assert cells(NEST, "//tr[2]//tr") == [["a", "b"], ["c"]]
    assert cells(NEST, "//tr[2]//tr[2]") == [["c"]]
    assert cells(NEST, "//tbody/tr") == [] and len(cells(NEST, "//tbody/tr", imply_tbody=True)) == 4
    assert cells(NEST, "//*/td/table//tr[1]") == [["a", "b"]]
    assert cells("<p>x", "//tr") == []


def test_a_table_inside_a_named_container():
    html = "<div id=a><div><table><tr><td>no</table></div></div><div id='b'><div><table><tr><td>yes</div><td>too</table></div><table><tr><td>also</table></div><table><tr><td>out</table>"
    assert cells(html, "//div[@id='b']//table//tr") == [["yes", "too"], ["also"]]
    assert cells(html, "//*[@id='b']/div/table/tr") == [["yes", "too"]]
    found = RowSelector(steps_of("//tr"), ("td",), False, False).selected(html)
    assert [(r["container"], r["table_no"]) for r in found] == [("a", 0), ("b", 1), ("b", 2), (None, 3)]


def test_counts_sections_and_raw_text():
    html = "<table><thead><tr><th>h<tbody><tr><td><div><span>x</span></div><script>if (a<b) '</td>'</script><td/>y<br/>z<tfoot><tr><td>&nbsp;&amp;"
    found = RowSelector(steps_of("//tr"), ("td", "th"), False, False).selected(html)
    assert [r["cells"] for r in found] == [["h"], ["x", ""], [" &"]]
    assert [(r["row_pos"], r["n_div"], r["n_span"], r["cell_divs"]) for r in found] == [(1, 0, 0, [0]), (1, 1, 1, [1, 0]), (1, 0, 0, [0])]


@pytest.mark.parametrize("path", ["", "tr", "//tr[", "//tr[x]", "//tr/text()", "//tr[@id=3]", "//tr//"])
def test_paths_that_are_none(path):
    with pytest.raises(ValueError):
        steps_of(path)


def test_pages_keep_their_ids(spark):
    pages = spark.createDataFrame([("u1", NEST), (None, NEST), ("u2", None), ("u3", "")], "page_id string, html string")
    got = select_rows(pages, "//table//table//tr")
    assert rows(got.select("page_id", F.size("rows").alias("n"))) == [(None, 2), ("u1", 2), ("u2", 0), ("u3", 0)]
    assert rows(parse_tables(pages), "page_id", "depth") == [(None, 1), (None, 2), ("u1", 1), ("u1", 2)]
    assert rows(parse_elements(pages, "td").where("item_no = 0"), "page_id") == [(None,), ("u1",)]
    assert parse_inputs(pages).schema["page_id"].dataType.simpleString() == "string"


def test_rows_of_every_table_inside_the_fifth_row(spark):
    inner = "<table><tr><td>title<tr><td>K<tr><td>1</table>"
    wrap = lambda t: "<table><tr><td>" * 3 + "<table>" + "<tr><td>f" * 4 + f"<tr><td>{t}</table>" + "</table>" * 3
    pages = spark.createDataFrame([(1, wrap(inner)), (2, wrap(f"<table><tr><td>{inner}</table>"))], "page_id long, html string")
    t = parse_tables(pages, min_depth=5, parent_row_pos=5)
    assert rows(t.select("page_id", "depth", F.size("rows").alias("n"))) == [(1, 5, 3), (2, 5, 1), (2, 6, 3)]
    by_path = select_rows(pages, "//table//table//table//table//tr[5]//table//tr")
    assert rows(by_path.select("page_id", F.size("rows").alias("n"))) == [(1, 3), (2, 4)]


def test_reject_list(spark):
    row = lambda i, *c: (i, list(c))
    data = [(1, []), (2, None), (3, [row(0, "t"), row(1, "h", "i")]), (4, [row(0, "t"), row(1, "h", "i"), row(2, "a"), row(3, "a", "b"), row(4, "a", "b", "c")])]
    t = spark.createDataFrame(data, "page_id long, rows array<struct<row_no:int,cells:array<string>>>")
    got = rows(report_rejects(t, header_row=1), "page_id", "row_no", "reason")
    assert got == [(1, None, "no_table"), (2, None, "no_table"), (3, None, "short_table"), (4, 2, "short_row"), (4, 4, "long_row")]
