"""Filters, header operators and ragged-row operators."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from skein.functions.labels import option_key, py_strip
from skein.operators.filters import drop_placeholder, iso_week_range, match_option, report_filter, truncate_after_first
from skein.operators.headers import drop_first_empty, occurrences, pick_occurrence
from skein.operators.rows import ragged_reason, split_rejects, unpivot_rows


def test_drop_placeholder_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "-"), (2, None), (3, "4")], "k int, v string")
    assert rows(drop_placeholder(df, "v")) == [(2, None), (3, "4")]


def test_truncate_after_first(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "stop"), ("a", 3, "x"), ("a", 4, "stop"), ("b", 1, "x")],
                               "t string, r int, v string")
    pred = F.col("v") == "stop"
    assert rows(truncate_after_first(df, ["t"], ["r"], pred)) == [("a", 1, "x"), ("a", 2, "stop"), ("b", 1, "x")]
    assert rows(truncate_after_first(df, ["t"], ["r"], pred, on_missing="none")) == [("a", 1, "x"), ("a", 2, "stop")]
    with pytest.raises(Exception):
        truncate_after_first(df, ["t"], ["r"], pred, on_missing="error").collect()


def test_occurrence_exact_and_drop_first_empty(spark):
    df = spark.createDataFrame([(["", "a", "b", "a", "", "a"],)], "h array<string>")
    occ = df.select(occurrences(drop_first_empty("h")).alias("o")).collect()[0]["o"]
    assert [(o["label"], o["col_no"], o["occurrence"]) for o in occ] == \
        [("a", 0, 1), ("b", 1, 1), ("a", 2, 2), ("", 3, 1), ("a", 4, 3)]
    third = df.select(pick_occurrence("h", 3).alias("p")).collect()[0]["p"]
    assert [(p["label"], p["col_no"]) for p in third] == [("a", 5)]


def test_option_matching_strips_unicode_blanks(spark):
    df = spark.createDataFrame([("Mexico",), ("mexico ",), ("Peru",)], "c string")
    got = df.filter(option_key("c") == option_key(F.lit("\t MEXICO  "))).count()
    assert got == 2
    assert df.select(py_strip(F.lit("  x\t"))).collect()[0][0] == "x"
    assert match_option(["Total of all age groups", "0-4"], " total of all AGE groups ") == "Total of all age groups"
    assert match_option(["a"], "b") is None


def test_iso_week_range_and_report_filter(spark):
    lo, hi = iso_week_range((2018, 1), (2018, 53))
    assert str(lo) == "2018-01-01" and str(hi) == "2018-12-31"
    df = spark.createDataFrame([(2018, 1, "Mexico"), (2019, 5, "Mexico"), (2023, 1, "Mexico"), (2019, 5, "Peru")],
                               "y int, w int, country string")
    out = report_filter(df, year_col="y", week_col="w", start=(2018, 1), end=(2022, 53), options={"country": "mexico"})
    assert rows(out) == [(2018, 1, "Mexico"), (2019, 5, "Mexico")]


def test_unpivot_rows_different_headers(spark):
    data = [("f1", 0, ["id", "a", "b"]), ("f1", 1, ["x", "1", "2"]),
            ("f2", 0, ["b", "id", "c"]), ("f2", 1, ["3", "y", "4"]), ("f2", 2, ["5", "z"])]
    df = spark.createDataFrame(data, "source string, row_no int, cells array<string>")
    out = unpivot_rows(df, ["source"], ["id"])
    assert rows(out, "source", "id", "label", "value") == [
        ("f1", "x", "a", "1"), ("f1", "x", "b", "2"), ("f2", "y", "b", "3"), ("f2", "y", "c", "4"),
        ("f2", "z", "b", "5"), ("f2", "z", "c", None)]


def test_ragged_rejects(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), (["a", "b", "c"],)], "cells array<string>")
    good, bad = split_rejects(df, ragged_reason(F.array(F.lit("h1"), F.lit("h2")), F.col("cells")))
    assert good.count() == 1
    assert sorted(r["reject_reason"] for r in bad.collect()) == ["long_row", "short_row"]


def test_skip_rows_header_positions_and_record_keys(spark):
    from skein.operators.filters import skip_rows
    from skein.operators.headers import header_positions
    from skein.operators.rows import record_keys, zip_record

    rows = spark.createDataFrame([("f", 0, ["t"]), ("f", 1, ["a", "Un 1", "Lc 1"]), ("f", 2, ["x", "1", "2"])],
                                 "source string, row_no int, cells array<string>")
    assert [r["row_no"] for r in skip_rows(rows, 1).collect()] == [1, 2]
    hp = rows.filter("row_no = 1").select(header_positions("cells", lambda h: h.contains("Un ")).alias("p"))
    assert [(p["label"], p["col_no"]) for p in hp.collect()[0]["p"]] == [("Un 1", 1)]
    recs = spark.createDataFrame([(["k1", "k2"], ["1", "2"]), (["k3"], ["3"])], "h array<string>, c array<string>")
    assert record_keys(recs.select(zip_record("h", "c").alias("r")), "r") == ["k1", "k2", "k3"]
