"""Staged pipe-CSV output: partitions replaced alone, failed and interrupted jobs, one workbook after another."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skein.operators.convert import convert_path
from skein.sources.delimited import STAGED, _Folder, finish_output, read_pipe_csv, write_pipe_csv
from skein.sources.xlsx import write_xlsx_rows

SCHEMA = "v string, report string, country string"


def frame(spark, *data):
    return spark.createDataFrame(data, SCHEMA)


def there(spark, path):
    return rows(read_pipe_csv(spark, path, SCHEMA), "report", "country", "v")


def test_only_written_partitions_are_replaced(spark, tmp_path):
    out, by = str(tmp_path / "out"), ["report", "country"]
    write_pipe_csv(frame(spark, ("1", "r2", "FR"), ("2", "r2", "DE"), ("3", "r12", "FR")), out, by)
    write_pipe_csv(frame(spark, ("new", "r2", "FR"), ("4", "r2", "a b/c")), out, by, mode="partitions")
    want = [("r12", "FR", "3"), ("r2", "DE", "2"), ("r2", "FR", "new"), ("r2", "a b/c", "4")]
    assert there(spark, out) == want
    write_pipe_csv(frame(spark).limit(0), out, by, mode="partitions")
    assert there(spark, out) == want
    write_pipe_csv(frame(spark, ("5", "r2", "DE")), out, by)
    assert there(spark, out) == [("r2", "DE", "5")]
    assert not [n for n in os.listdir(out) if n.startswith(STAGED)]
    with pytest.raises(ValueError):
        write_pipe_csv(frame(spark), out, mode="partitions")


def test_a_failed_job_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    write_pipe_csv(frame(spark, ("1", "r", "c")), out, ["report", "country"])
    bad = frame(spark, ("2", "r", "c"), ("3", "s", "c")).withColumn("v", F.when(F.col("report") == "s", F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    for mode in ("overwrite", "partitions"):
        with pytest.raises(Exception, match="no"):
            write_pipe_csv(bad, out, ["report", "country"], mode=mode)
        assert there(spark, out) == [("r", "c", "1")]
    assert not [n for n in os.listdir(out) if n.startswith(STAGED)]


@pytest.mark.parametrize("mode,want", [("overwrite", [("r", "c", "2"), ("s", "c", "3")]), ("partitions", [("q", "c", "0"), ("r", "c", "2"), ("s", "c", "3")])])
@pytest.mark.parametrize("moves", [0, 1])
def test_a_lost_driver_is_made_good(spark, tmp_path, monkeypatch, mode, want, moves):
    out, by = str(tmp_path / "out"), ["report", "country"]
    write_pipe_csv(frame(spark, ("0", "q", "c"), ("1", "r", "c")), out, by)
    done, move = [], _Folder._move

    def stops(self, source, target):
        if not source.endswith(".new"):
            if len(done) == moves:
                raise KeyboardInterrupt
            done.append(target)
        move(self, source, target)

    monkeypatch.setattr(_Folder, "_move", stops)
    with pytest.raises(KeyboardInterrupt):
        write_pipe_csv(frame(spark, ("2", "r", "c"), ("3", "s", "c")), out, by, mode=mode)
    monkeypatch.undo()
    os.makedirs(f"{out}/{STAGED}partitions-unfinished/report=x")
    assert finish_output(spark, out) == 1
    assert there(spark, out) == want
    assert finish_output(spark, out) == 0 and not [n for n in os.listdir(out) if n.startswith(STAGED)]


def test_unpartitioned_output_is_replaced_whole(spark, tmp_path):
    out = str(tmp_path / "out")
    for v in ("1", "2"):
        write_pipe_csv(frame(spark, (v, "r", "c")), out)
    assert there(spark, out) == [("r", "c", "2")]
    write_pipe_csv(frame(spark, ("3", "r", "c")), out, mode="append")
    assert there(spark, out) == [("r", "c", "2"), ("r", "c", "3")]


def test_workbooks_converted_one_after_another_all_stay(spark, tmp_path):
    folder = tmp_path / "JP"
    sheet = [("a.xlsx", 0, ["shop", "2019/1-"]), ("a.xlsx", 1, ["x", "1"]), ("b.xlsx", 0, ["shop", "2019/2-"]), ("b.xlsx", 1, ["y", "2"])]
    write_xlsx_rows(spark.createDataFrame(sheet, "source string, row_no int, cells array<string>"), str(folder)).count()
    read = lambda: rows(read_pipe_csv(spark, f"{folder}/pivoted", "shop string, YearMonth string, Value string, file string"), "file", "shop", "YearMonth", "Value")
    a, b = ("a.xlsx", "x", "2019/01", "1"), ("b.xlsx", "y", "2019/02", "2")
    convert_path(spark, f"{folder}/a.xlsx")
    assert read() == [a]
    convert_path(spark, f"{folder}/b.xlsx")
    assert read() == [a, b]
    convert_path(spark, f"{folder}/")
    convert_path(spark, f"{folder}/a.xlsx")
    convert_path(spark, f"{folder}/")
    assert read() == [a, b]
