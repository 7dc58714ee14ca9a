"""Workbooks as other writers make them: stale or missing ``dimension``, date
styles, error cells, unlabelled and repeated id columns, files without a body."""

import io
import re
import time
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skein.operators.convert import convert_folder, convert_path, discover_id_labels
from skein.operators.panel import CN, JP, MX, unpivot_panel, unpivot_panel_rows
from skein.sources.xlsx import build_workbook, read_sheet, read_xlsx


def patched(book: bytes, **parts: str) -> bytes:
    """The workbook with parts replaced or added, or (a function) rewritten."""
    src, out = zipfile.ZipFile(io.BytesIO(book)), io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        names = {n.rsplit("/", 1)[-1].split(".")[0]: n for n in src.namelist() if not n.endswith(".rels")}
        for n in src.namelist():
            edit = next((v for k, v in parts.items() if names.get(k) == n), None)
            text = src.read(n).decode()
            z.writestr(n, edit(text) if callable(edit) else edit if edit is not None else text)
        for k, v in parts.items():
            if k not in names:
                z.writestr(f"xl/{k}.xml", v)
    return out.getvalue()


def cn_book(months: int) -> bytes:
    head = ["No", "Period"] + ["Tourist", "Business"] * 3
    body = [["1", "2021．Dec"] + [str(i) for i in range(6)]] + [[str(k), ""] + ["7"] * 6 for k in range(2, months + 1)]
    return build_workbook([("Asia", [["t"], ["t"], ["t"], ["t"], head, *body])])


@pytest.mark.parametrize("dimension", ['<dimension ref="A1"/>', "", '<dimension ref="A1:H900"/>'])
def test_row_count_comes_from_the_rows(spark, tmp_path, dimension):
    spec = CN.replace(value_names=("Tourist", "Business"))
    for months, found in ((4, True), (1, False)):
        folder = tmp_path / f"b{months}"
        folder.mkdir()
        book = patched(cn_book(months), sheet1=lambda t: re.sub("<dimension[^>]*/>", dimension, t))
        (folder / "f.xlsx").write_bytes(book)
        data = read_xlsx(spark, str(folder), sheet="Asia", header_row=4)
        if found:
            got = unpivot_panel(data, spec)
            assert {r["Date"] for r in got.collect()} == {"202112", "202201"}
        else:
            with pytest.raises(Exception, match="cut-off 202201 not found"):
                unpivot_panel(data, spec).collect()
            assert unpivot_panel(data, spec.replace(on_missing="none")).count() == 0
            assert unpivot_panel(data, spec.replace(on_missing="all")).count() == 2


def test_date_styles_and_error_cells():
    styles = ('<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts count="2">'
              '<numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd hh:mm"/><numFmt numFmtId="171" formatCode="0.0 &quot;days&quot;"/>'
              '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
              "</styleSheet>")
    cells = ('<c r="A1" s="1"><v>43466</v></c><c r="B1" s="2"><v>43466.75</v></c><c r="C1" s="3"><v>43466</v></c>'
             '<c r="D1" t="e"><v>#DIV/0!</v></c><c r="E1"><v>1.5</v></c>')
    book = patched(build_workbook([("S", [["x"]])]), styles=styles,
                   sheet1=lambda t: re.sub("<row.*</row>", f'<row r="1">{cells}</row>', t))
    assert read_sheet(book)[1] == [(0, ["2019-01-01", "2019-01-01 18:00:00", "43466", None, "1.5"])]
    mac = patched(book, workbook=lambda t: t.replace("<sheets>", '<workbookPr date1904="1"/><sheets>'))
    assert read_sheet(mac)[1][0][1][0] == "2023-01-02"


def test_unlabelled_and_repeated_id_columns_stay(spark, tmp_path):
    folder = tmp_path / "JP"
    folder.mkdir()
    (folder / "f.xlsx").write_bytes(build_workbook([("S", [["p", "p", None, "2019/1-"], ["a", "b", "c", 1, "tail"]])]))
    assert discover_id_labels(spark, str(folder), JP) == ["Unnamed: 2", "Unnamed: 4", "p", "p.1"]
    want = [("c", "tail", "a", "b", "2019/01", "1")]
    cols = ("Unnamed: 2", "Unnamed: 4", "p", "p.1", "YearMonth", "Value")
    for got in (convert_path(spark, f"{folder}/f.xlsx", out_dir=str(tmp_path / "one")), convert_folder(spark, str(folder))):
        assert [tuple(r[c] for c in cols) for r in got.collect()] == want


def test_file_without_body_fails_or_is_listed(spark, tmp_path):
    folder = tmp_path / "JP"
    folder.mkdir()
    (folder / "ok.xlsx").write_bytes(build_workbook([("S", [["p", "2019/1-"], ["a", 1]])]))
    (folder / "empty.xlsx").write_bytes(build_workbook([("S", [["p", "2019/1-"]])]))
    with pytest.raises(Exception, match="no_body_rows"):
        convert_folder(spark, str(folder), id_labels=["p"]).collect()
    good = convert_folder(spark, str(folder), id_labels=["p"], rejects_dir=str(tmp_path / "rej"))
    assert rows(good, "p", "Value") == [("a", "1")]
    assert [tuple(r) for r in spark.read.option("sep", "|").option("header", True).csv(str(tmp_path / "rej")).collect()] \
        == [("empty.xlsx", "no_body_rows")]


def test_excluded_file_is_not_opened(spark, tmp_path):
    folder = tmp_path / "JP"
    folder.mkdir()
    (folder / "ok.xlsx").write_bytes(build_workbook([("S", [["p", "2019/1-"], ["a", 1]])]))
    (folder / "ok_pivoted.xlsx").write_bytes(b"x" * 200_000)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100000")
    try:
        assert read_xlsx(spark, str(folder), exclude="pivoted", header_row=0).count() == 1
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_paired_columns_with_equal_labels(spark, tmp_path):
    head = ["p", "Un AAA - 01/2019", "Un BBB - 01/2019", "Lc AAA - 01/2019", "Lc AAA - 02/2019"]
    flat = spark.createDataFrame([("f", 0, head), ("f", 1, ["a", "1", "2", "3", "4"])],
                                 "source string, row_no int, cells array<string>")
    want = [("a", "2019_01", "1", "3"), ("a", "2019_01", "2", None), ("a", "2019_02", None, "4")]
    assert rows(unpivot_panel_rows(flat, MX, id_labels=["p"]), "p", "WeekOfYear", "Unit", "Value") == want
    wide = spark.createDataFrame([("a", "1", "2", "3", "4")], ", ".join(f"`{h}` string" for h in head))
    assert rows(unpivot_panel(wide, MX), "p", "WeekOfYear", "Unit", "Value") == want


def test_wide_paired_panel_time_is_linear_in_width(spark, tmp_path):
    times = {}
    for weeks in (52, 312):
        folder = tmp_path / f"w{weeks}"
        folder.mkdir()
        labels = [f"{w % 52 + 1:02d}/{2000 + w // 52}" for w in range(weeks)]
        head = ["p"] + [f"{g} SEM - {x}" for g in ("Un", "Lc") for x in labels]
        body = [[f"r{i}"] + [i] * (2 * weeks) for i in range(1000)]
        (folder / "f.xlsx").write_bytes(build_workbook([("S", [head, *body])]))
        t0 = time.time()
        data = read_xlsx(spark, str(folder), header_row=0, nested=True)
        got = unpivot_panel_rows(data, MX, id_labels=["p"]).agg(F.count("*"), F.countDistinct("WeekOfYear"),
                                                                F.sum("Value")).first()
        times[weeks] = time.time() - t0
        assert tuple(got) == (1000 * weeks, weeks, weeks * 499500.0)
    assert times[312] < 30
