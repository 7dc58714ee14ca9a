"""Workbook reader/writer, delimited sink, path columns."""

import os
import tempfile
import zipfile

import pytest

from skein.sources.delimited import read_pipe_csv, write_pipe_csv
from skein.sources.files import parent_dir, start_year
from skein.sources.xlsx import build_workbook, col_index, col_letters, read_sheet, read_xlsx


def test_column_letters_round_trip():
    for i in (0, 25, 26, 27, 701, 702, 16383):
        assert col_index(col_letters(i)) == i
    assert col_letters(27) == "AB"


def test_read_sheet_types_gaps_and_sheet_choice():
    wb = build_workbook([("Cover", [["x"]]),
                         ("Asia", [["a", None, 1.5], [], [True, "é & <b>", 3]])])
    name, rows = read_sheet(wb)
    assert name == "Cover" and rows == [(0, ["x"])]
    name, rows = read_sheet(wb, "Asia")
    assert rows == [(0, ["a", None, "1.5"]), (1, []), (2, ["TRUE", "é & <b>", "3"])]
    with pytest.raises(ValueError):
        read_sheet(wb, "Europe")


def test_inline_strings_are_read():
    wb = build_workbook([("S", [["placeholder"]])])
    buf = tempfile.mktemp(suffix=".xlsx")
    with zipfile.ZipFile(buf, "w") as z, zipfile.ZipFile(__import__("io").BytesIO(wb)) as src:
        for n in src.namelist():
            data = src.read(n)
            if n == "xl/worksheets/sheet1.xml":
                data = data.replace(b'<c r="A1" t="s"><v>0</v></c>',
                                    b'<c r="B1" t="inlineStr"><is><t>in</t><t>line</t></is></c>')
            z.writestr(n, data)
    with open(buf, "rb") as f:
        assert read_sheet(f.read())[1] == [(0, [None, "inline"])]


def test_reader_skips_names_and_subfolders_and_attaches_context(spark):
    root = tempfile.mkdtemp(prefix="skein-src-")
    os.makedirs(f"{root}/MX/sub")
    good = build_workbook([("S", [["t"], ["id", "v"], ["a", 1], ["b", 2]])])
    for path in (f"{root}/MX/a_b_c_d_20181231-x.xlsx", f"{root}/MX/a_pivoted.xlsx", f"{root}/MX/sub/c.xlsx"):
        with open(path, "wb") as f:
            f.write(good)
    rows = read_xlsx(spark, f"{root}/MX", exclude="pivoted", header_row=1)
    got = rows.select(parent_dir("source").alias("c"), start_year("source").alias("y"), "row_no", "cells", "hdr",
                      "first_row_no", "last_row_no").orderBy("row_no").collect()
    assert [(r["c"], r["y"], r["row_no"], r["cells"]) for r in got] == [("MX", "2018", 2, ["a", "1"]),
                                                                         ("MX", "2018", 3, ["b", "2"])]
    assert got[0]["hdr"] == ["id", "v"] and got[0]["first_row_no"] == 2 and got[0]["last_row_no"] == 3


def test_pipe_csv_round_trip_with_quotes_and_empties(spark):
    out = tempfile.mkdtemp(prefix="skein-csv-") + "/o"
    df = spark.createDataFrame([(1, 'say "hi" | x', "k"), (2, "", "k"), (3, None, "m")], "a int, b string, p string")
    write_pipe_csv(df, out, partition_by=["p"])
    back = read_pipe_csv(spark, out, "a int, b string").orderBy("a").collect()
    assert [(r["a"], r["b"], r["p"]) for r in back] == [(1, 'say "hi" | x', "k"), (2, None, "k"), (3, None, "m")]
    text = "".join(open(os.path.join(dp, f)).read() for dp, _, fs in os.walk(out) for f in fs if f.endswith(".csv"))
    assert '"say ""hi"" | x"' in text


def test_single_file_path(spark):
    root = tempfile.mkdtemp(prefix="skein-one-")
    with open(f"{root}/x_pivoted.xlsx", "wb") as f:
        f.write(build_workbook([("S", [["id"], ["a"]])]))
    # a file named on purpose is read even if its name holds the skip text (no exclusion given)
    assert read_xlsx(spark, f"{root}/x_pivoted.xlsx").count() == 2


def test_convert_path_file_and_folder(spark):
    from skein.operators.convert import convert_path

    root = tempfile.mkdtemp(prefix="skein-conv-") + "/JP"
    os.makedirs(root)
    for name, rows in (("a.xlsx", [["product", "2019/1-", "2019/10-"], ["A", 1.0, 2.0]]),
                       ("b.xlsx", [["product", "2020/2-"], ["B", 3.0]])):
        with open(f"{root}/{name}", "wb") as f:
            f.write(build_workbook([("S", rows)]))
    one = convert_path(spark, f"{root}/a.xlsx", id_labels=["product"])
    assert sorted((r["YearMonth"], r["Value"]) for r in one.collect()) == [("2019/01", "1.0"), ("2019/10", "2.0")]
    convert_path(spark, f"{root}/", out_dir=f"{root}/out", id_labels=["product"])
    back = read_pipe_csv(spark, f"{root}/out", "product string, YearMonth string, Value string").collect()
    assert sorted((r["file"], r["YearMonth"]) for r in back) == [
        ("a.xlsx", "2019/01"), ("a.xlsx", "2019/10"), ("b.xlsx", "2020/02")]


def test_convert_folder_routes_bad_files(spark):
    from skein.operators.convert import convert_folder
    from skein.operators.panel import JP2

    root = tempfile.mkdtemp(prefix="skein-rej-") + "/JP2"
    os.makedirs(root)
    good = build_workbook([("S", [["shop", "12.31-", "1.7-"], ["s1", "5", "-"], ["s2", "6", "7"]])])
    files = {"a_b_c_d_20181231-x.xlsx": good,            # fine
             "short_name.xlsx": good,                    # no year token in the name
             "a_b_c_d_20190107-y.xlsx": b"not a zip",     # unreadable
             "a_b_c_d_20190114-z.xlsx": build_workbook([("S", [["shop", "total"], ["s1", "1"]])])}  # no dates
    for name, data in files.items():
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)
    out = convert_folder(spark, root, spec=JP2, id_labels=["shop"], rejects_dir=f"{root}/rejects")
    assert sorted((r["file"], r["shop"], r["Date"], r["Value"]) for r in out.collect()) == [
        ("a_b_c_d_20181231-x.xlsx", "s1", "2018-12-31", "5"), ("a_b_c_d_20181231-x.xlsx", "s2", "2018-12-31", "6"),
        ("a_b_c_d_20181231-x.xlsx", "s2", "2019-01-07", "7")]
    rej = {r["file"]: r["reason"] for r in read_pipe_csv(spark, f"{root}/rejects", "file string, reason string")
           .collect()}
    assert rej["short_name.xlsx"] == "no_start_date"
    assert rej["a_b_c_d_20190114-z.xlsx"] == "no_value_columns"
    assert rej["a_b_c_d_20190107-y.xlsx"].startswith("unreadable")
    assert len(rej) == 3


def test_sorted_layout_output_files_are_in_date_order(spark):
    from skein.operators.convert import convert_folder
    from skein.operators.panel import CN

    root = tempfile.mkdtemp(prefix="skein-cn-") + "/CN"
    os.makedirs(root)
    hdr = ["No", "Period"] + ["Total", "Tourist", "Business", "Others", "Short Excursion"] * 3
    body = [[str(i + 1), "2021\uff0eDec" if i == 0 else "x"] + ["1"] * 15 for i in range(3)]
    rows = [["t"], [], [], ["ignored"], hdr] + body
    with open(f"{root}/asia.xlsx", "wb") as f:
        f.write(build_workbook([("Cover", [["c"]]), ("Asia", rows)]))
    convert_folder(spark, root, out_dir=f"{root}/out")
    files = [os.path.join(dp, x) for dp, _, fs in os.walk(f"{root}/out") for x in fs if x.endswith(".csv")]
    lines = [ln for p in sorted(files) for ln in open(p).read().splitlines() if ln and not ln.startswith("Country")]
    dates = [ln.split("|")[1] for ln in lines]
    assert dates == sorted(dates) and set(dates) == {"202112", "202201"}


def test_rich_text_phonetics_and_rows_without_numbers():
    import io as _io

    wb = build_workbook([("S", [["x"]])])
    src = zipfile.ZipFile(_io.BytesIO(wb))
    buf = _io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for n in src.namelist():
            data = src.read(n)
            if n == "xl/sharedStrings.xml":
                data = data.replace(b'<si><t xml:space="preserve">x</t></si>',
                                    b"<si><r><t>ab</t></r><r><t>c</t></r><rPh><t>PHON</t></rPh></si>")
            if n == "xl/worksheets/sheet1.xml":
                data = data.replace(b'<row r="1">', b"<row>") + b""
                data = data.replace(b"</sheetData>", b'<row><c t="inlineStr"><is><t>next</t></is></c></row></sheetData>')
            z.writestr(n, data)
    assert read_sheet(buf.getvalue())[1] == [(0, ["abc"]), (1, ["next"])]


def test_id_columns_discovered_across_files(spark):
    from skein.operators.convert import convert_folder

    root = tempfile.mkdtemp(prefix="skein-ids-") + "/JP"
    os.makedirs(root)
    with open(f"{root}/a.xlsx", "wb") as f:
        f.write(build_workbook([("S", [["product", "2019/1-"], ["A", 1.0]])]))
    with open(f"{root}/b.xlsx", "wb") as f:
        f.write(build_workbook([("S", [["maker", "product", "2020/2-"], ["m", "B", 3.0]])]))
    out = convert_folder(spark, root)
    assert out.columns[:2] == ["maker", "product"]
    assert sorted((r["maker"] or "", r["product"], r["YearMonth"]) for r in out.collect()) == [
        ("", "A", "2019/01"), ("m", "B", "2020/02")]
