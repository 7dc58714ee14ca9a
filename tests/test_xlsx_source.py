"""The data source ``xlsx``: rows as the reader gives them, pruned files, streams by offsets, one parse a workbook."""

import pytest
from conftest import rows

from skein.sources import xlsx
from skein.sources.xlsx import build_workbook, read_xlsx, sheet_runs
from skein.sources.xlsx_source import Settings, XlsxStreamReader, register


@pytest.fixture
def folder(spark, tmp_path):
    register(spark)
    for name, value in (("b.xlsx", "2"), ("a.xlsx", "1"), ("x_pivoted.xlsx", "9")):
        (tmp_path / name).write_bytes(build_workbook([("Cover", [["no"]]), ("Data", [["shop", "2019/1-"], [f"s{value}", value], [], ["t", None, "w"]])]))
    (tmp_path / "note.txt").write_text("x")
    (tmp_path / "sub").mkdir()
    return str(tmp_path)


def test_same_rows_as_the_reader(spark, folder):
    of = lambda **o: spark.read.format("xlsx").options(sheet="Data", exclude="pivoted", **o).load(folder)
    cols = ["file_name", "sheet", "row_no", "cells"]
    assert rows(of(), *cols) == rows(read_xlsx(spark, folder, sheet="Data", exclude="pivoted"), *cols)
    cols += ["source", "hdr", "first_row_no", "first_cells", "last_row_no"]
    assert rows(of(headerRow="0"), *cols) == rows(read_xlsx(spark, folder, sheet="Data", exclude="pivoted", header_row=0), *cols)
    assert rows(of(headerRow="0", nested="true").selectExpr("file_name", "size(body) AS n")) == [("a.xlsx", 3), ("b.xlsx", 3)]
    one = spark.read.format("xlsx").load(folder + "/x_pivoted.xlsx")
    assert rows(one, "file_name", "sheet") == [("x_pivoted.xlsx", "Cover")]
    assert of().rdd.getNumPartitions() == 2


def test_names_prune_files(spark, folder):
    with open(folder + "/broken.xlsx", "wb") as f:
        f.write(b"no workbook")
    read = lambda **o: spark.read.format("xlsx").options(sheet="Data", **o).load(folder)
    assert read(files="a.xlsx").count() == 4  # the broken one is not opened
    assert read(files="[ab].xlsx").where("row_no > 0").count() == 6
    assert read(exclude="broken").count() == 12 and read(files="none*").count() == 0
    with pytest.raises(Exception, match="broken.xlsx"):
        read().count()
    listed = read(headerRow="0", onError="reject")
    assert rows(listed.where("error IS NOT NULL"), "file_name", "row_no") == [("broken.xlsx", -1)]
    with pytest.raises(ValueError):
        Settings.of({"path": "/x", "onError": "skip"})


def test_parts_of_one_relation_in_one_query(spark, folder):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        read = spark.read.format("xlsx").option("sheet", "Data").load(folder)
        parts = read.where("file_name = 'a.xlsx'").unionByName(read.where("file_name <> 'a.xlsx'"))
        assert rows(parts.groupBy("file_name").count()) == [("a.xlsx", 4), ("b.xlsx", 4), ("x_pivoted.xlsx", 4)]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_stream_reads_each_file_once(spark, folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("stream"))

    def run():
        stream = spark.readStream.format("xlsx").options(sheet="Data", exclude="pivoted").load(folder).select("file_name", "row_no")
        stream.writeStream.format("parquet").option("checkpointLocation", out + "/ckpt").trigger(availableNow=True).start(out + "/data").awaitTermination()
        return rows(spark.read.parquet(out + "/data").groupBy("file_name").count())

    assert run() == [("a.xlsx", 4), ("b.xlsx", 4)]
    assert run() == [("a.xlsx", 4), ("b.xlsx", 4)]
    with open(folder + "/c.xlsx", "wb") as f:
        f.write(build_workbook([("Data", [["z"]])]))
    assert run() == [("a.xlsx", 4), ("b.xlsx", 4), ("c.xlsx", 1)]


def test_offsets(folder):
    reader = XlsxStreamReader(Settings.of({"path": folder}))
    end = reader.latestOffset()
    assert len(reader.partitions(reader.initialOffset(), end)) == 3 and reader.partitions(end, end) == []


def test_a_workbook_is_parsed_once(monkeypatch):
    parsed = []
    monkeypatch.setattr(xlsx, "iter_sheet", lambda *a, f=xlsx.iter_sheet: (parsed.append(1), f(*a))[1])
    content = build_workbook([("s", [["h"], *[[str(i), "x"] for i in range(50)]])])
    small = list(sheet_runs(content, header_row=0))
    assert len(parsed) == 1 and len(small) == 1
    monkeypatch.setattr(xlsx, "CHUNK_CELLS", 30)
    large = list(sheet_runs(content, header_row=0))
    assert len(parsed) == 3 and len(large) > 3
    assert [r for _, _, _, run in large for r in run] == small[0][3]
