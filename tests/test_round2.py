"""Inputs that earlier lost data or failed: duplicate labels, one-sided periods,
NULL table keys, one named workbook, a second run over a converted folder."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skein.functions.labels import evaluate, file_year, month_label, named, week_label, week_sequence, week_start
from skein.operators.convert import convert_path
from skein.operators.filters import report_filter, truncate_after_first
from skein.operators.unpivot import pair_groups
from skein.sources.xlsx import write_xlsx_rows


def test_equal_labels_keep_every_column(spark):
    first, second = ["Un AAA - 01/2019", "Un BBB - 01/2019"], ["Lc AAA - 01/2019"]
    pairs = pair_groups(first, second, named(spark, first + second, week_label).__getitem__)
    assert pairs == [("2019_01", "Un AAA - 01/2019", "Lc AAA - 01/2019"), ("2019_01", "Un BBB - 01/2019", None)]


def test_label_rules_of_names(spark):
    assert evaluate(spark, ["2019/1-", "2019/11-", "name"], month_label) == ["2019/01", "2019/11", "name"]
    assert evaluate(spark, ["Un SEM - 09/2020", "Un SEM", "", "Lc x\ny - 1a/2"], week_label) == ["2020_09", None, None, "2_1a"]
    assert evaluate(spark, ["1.6-", "1.13-", "x"], lambda _, i: week_sequence(F.lit("2020"), F.lit("1.6-"), i)) == ["2020-01-06", "2020-01-13", "2020-01-20"]
    assert evaluate(spark, [], week_label) == []
    files = ["/in/JP2/a_b_c_d_20181231-x.xlsx", "a_b_c_d_2018", "a_b_c_20181231.xlsx", "/a_b_c_d_2018/x.xlsx", "a_b_c_d_week.xlsx"]
    assert evaluate(spark, files, file_year) == ["2018", "2018", None, None, None]
    assert spark.range(1).select(week_start(F.lit("2020"), F.lit("1.6-"))).first()[0] == dt.date(2020, 1, 6)
    assert spark.range(1).select(week_start(F.lit("2020"), F.lit("13.6-"))).first()[0] is None


def test_names_that_do_not_fit_are_named(spark):
    with pytest.raises(ValueError, match="Un SEM"):
        named(spark, ["Un SEM - 01/2019", "Un SEM"], week_label)


def test_one_sided_period(spark):
    df = spark.createDataFrame([(dt.date(2019, 1, 1), 2019, 1), (dt.date(2020, 6, 1), 2020, 23)], "d date, y int, w int")
    assert report_filter(df, "d", start=(2020, 1)).count() == 1
    assert report_filter(df, "d", end=(2019, 52)).count() == 1
    assert report_filter(df, year_col="y", week_col="w", start=(2019, 2)).count() == 1


def test_truncate_null_key(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "x"), (None, 3, "b"), ("t", 1, "x"), ("t", 2, "c")], "k string, i int, v string")
    got = truncate_after_first(df, ["k"], ["i"], F.col("v") == "x", on_missing="none")
    assert rows(got, "k", "i") == [(None, 1), (None, 2), ("t", 1)]


def test_single_file_and_second_run(spark, tmp_path):
    folder = tmp_path / "JP"
    (folder / "old_JP").mkdir(parents=True)
    sheet = spark.createDataFrame([("f.xlsx", 0, ["p", "2019/1-", "2019/2-"]), ("f.xlsx", 1, ["a", "1", "2"])], "file_name string, row_no int, cells array<string>")
    from skein.operators.panel import spec_for

    write_xlsx_rows(sheet, str(folder), file_col="file_name", sheet=spec_for("JP").sheet or "Sheet1").collect()
    (folder / "old_JP" / "g.xlsx").write_bytes(b"not a workbook")
    one = rows(convert_path(spark, f"{folder}/f.xlsx", out_dir=str(tmp_path / "single")).drop("file"))
    runs = [rows(convert_path(spark, f"{folder}/").drop("file")) for _ in range(2)]
    assert len(one) == 2 and one == runs[0] == runs[1]
