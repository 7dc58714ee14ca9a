"""Golden tests of the four layouts (FIXTURES.md sections 1-4)."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from skein.operators.panel import CN, JP, JP2, MX, spec_for, unpivot_panel

NBSP = "\u00a0"


def mx_frame(spark, lc_order=("Lc SEM - 01/2019", "Lc SEM - 02/2019"), drop_lc=None):
    data = {"product": ["A", "B"], "Un SEM - 01/2019": [10.0, 3.0], "Un SEM - 02/2019": [None, 4.0],
            "Lc SEM - 01/2019": [100.5, None], "Lc SEM - 02/2019": [7.0, 44.0]}
    cols = ["product", "Un SEM - 01/2019", "Un SEM - 02/2019", *[c for c in lc_order if c != drop_lc]]
    schema = ", ".join(f"`{c}` {'string' if c == 'product' else 'double'}" for c in cols)
    return spark.createDataFrame([tuple(data[c][i] for c in cols) for i in range(2)], schema)


def test_mx_paired(spark):
    out = unpivot_panel(mx_frame(spark), MX)
    assert out.columns == ["product", "WeekOfYear", "Unit", "Value"]
    assert rows(out) == [("A", "2019_01", 10.0, 100.5), ("A", "2019_02", None, 7.0),
                         ("B", "2019_01", 3.0, None), ("B", "2019_02", 4.0, 44.0)]


def test_mx_label_pairing_survives_reordered_and_missing_groups(spark):
    out = unpivot_panel(mx_frame(spark, lc_order=("Lc SEM - 02/2019", "Lc SEM - 01/2019")), MX)
    assert rows(out) == rows(unpivot_panel(mx_frame(spark), MX))
    miss = unpivot_panel(mx_frame(spark, drop_lc="Lc SEM - 02/2019"), MX)
    assert rows(miss, "product", "WeekOfYear", "Value") == [("A", "2019_01", 100.5), ("A", "2019_02", None),
                                                           ("B", "2019_01", None), ("B", "2019_02", None)]


def test_mx_position_mode_is_the_parity_mode(spark):
    pos = MX.replace(pair_by="position")
    swapped = unpivot_panel(mx_frame(spark, lc_order=("Lc SEM - 02/2019", "Lc SEM - 01/2019")), pos)
    assert ("A", "2019_01", 10.0, 7.0) in rows(swapped)  # mispaired, as a positional concat does
    short = unpivot_panel(mx_frame(spark, drop_lc="Lc SEM - 02/2019"), pos)
    assert {r[1] for r in rows(short)} == {"2019_01"}  # shorter group cuts the tail


def test_mx_header_with_both_tokens_goes_to_units(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0)], "p string, `Un Lc 01/2019x` double, `Lc SEM - 01/2019` double")
    g = unpivot_panel(df, MX)
    assert "Unit" in g.columns and g.count() >= 1


def test_jp_month_labels(spark):
    df = spark.createDataFrame([("A", "m1", 1.0, 2.0), ("B", "m2", None, 4.0)],
                               "product string, maker string, `2019/1-` double, `2019/10-` double")
    out = unpivot_panel(df, JP)
    assert out.columns == ["product", "maker", "YearMonth", "Value"]
    assert rows(out) == [("A", "m1", "2019/01", 1.0), ("A", "m1", "2019/10", 2.0),
                         ("B", "m2", "2019/01", None), ("B", "m2", "2019/10", 4.0)]


def test_jp_no_month_column_is_a_spec_error(spark):
    with pytest.raises(ValueError):
        unpivot_panel(spark.createDataFrame([("A",)], "product string"), JP)


def jp2_frame(spark):
    return spark.createDataFrame([("s1", "5", "-", None), ("s2", "6", "7", "8")],
                                 "shop string, `12.31-` string, `1.7-` string, `1.14-` string")


JP2_EXPECTED = [("s1", "2018-12-31", "5"), ("s1", "2019-01-14", None), ("s2", "2018-12-31", "6"),
                ("s2", "2019-01-07", "7"), ("s2", "2019-01-14", "8")]


def test_jp2_week_sequence_and_placeholder(spark):
    out = unpivot_panel(jp2_frame(spark), JP2, source="/x/JP2/a_b_c_d_20181231-x.xlsx")
    assert out.columns == ["shop", "Date", "Value"]
    assert rows(out) == sorted(JP2_EXPECTED, key=lambda t: tuple((x is not None, x) for x in t))


def test_jp2_year_from_a_source_column(spark):
    df = jp2_frame(spark).withColumn("src", F.lit("a_b_c_d_20181231-x.xlsx"))
    out = unpivot_panel(df, JP2, source=F.col("src")).drop("src")
    assert rows(out) == rows(unpivot_panel(jp2_frame(spark), JP2, source="a_b_c_d_20181231-x.xlsx"))


def test_jp2_id_column_after_dates_keeps_its_name(spark):
    df = spark.createDataFrame([("5", "s1", "6")], "`12.31-` string, shop string, `1.7-` string")
    out = unpivot_panel(df, JP2, source="a_b_c_d_20181231-x.xlsx")
    assert rows(out) == [("s1", "2018-12-31", "5"), ("s1", "2019-01-07", "6")]


def cn_rows(spark, first_cell="2021\uff0eDec", extra_repeat=False):
    hdr = ["No", "Period", "Total", "Tourist", "Business", "Others", "Short Excursion"] + \
          ["Total", "Tourist", "Business", "Others", "Short Excursion"] * 2
    if extra_repeat:
        hdr = hdr + ["Tourist"]
    body = [["1", first_cell] + ["0"] * 10 + ["10", "1", "2", "3", "4"],
            ["2", "(any text)"] + ["0"] * 10 + ["26", "5", "6", "7", "8"],
            ["3", "Summary"] + ["0"] * 10 + ["99", "9", "9", "9", "9"]]
    data = [("f.xlsx", 0, ["title"]), ("f.xlsx", 1, []), ("f.xlsx", 2, ["x"]), ("f.xlsx", 3, ["ignored"]),
            ("f.xlsx", 4, hdr)] + [("f.xlsx", 5 + i, b) for i, b in enumerate(body)]
    return spark.createDataFrame(data, "source string, row_no int, cells array<string>")


def test_cn_third_block_month_sequence_and_cutoff(spark):
    out = unpivot_panel(cn_rows(spark), CN).drop("source")
    assert out.columns == ["Country", "Date", "Visit_Purpose", "Visitors"]
    got = [tuple(r) for r in out.collect()]  # sorted by Date, Visit_Purpose
    assert got == [("China", "202112", "Business", "2"), ("China", "202112", "Others", "3"),
                   ("China", "202112", "Short Excursion", "4"), ("China", "202112", "Tourist", "1"),
                   ("China", "202201", "Business", "6"), ("China", "202201", "Others", "7"),
                   ("China", "202201", "Short Excursion", "8"), ("China", "202201", "Tourist", "5")]


def test_cn_full_width_noise_in_first_date(spark):
    out = unpivot_panel(cn_rows(spark, first_cell="2021 \u3000\uff0eDec"), CN)
    assert {r["Date"] for r in out.collect()} == {"202112", "202201"}


def test_cn_missing_cutoff(spark):
    rows_ = cn_rows(spark, first_cell="2019Jan")
    with pytest.raises(Exception):
        unpivot_panel(rows_, CN).collect()
    assert unpivot_panel(rows_, CN.replace(on_missing="all")).count() == 12
    assert unpivot_panel(rows_, CN.replace(on_missing="none")).count() == 0


def test_cn_exact_occurrence(spark):
    # a 4th 'Tourist' header is not part of the third block
    out = unpivot_panel(cn_rows(spark, extra_repeat=True), CN.replace(value_type="bigint"))
    assert {r["Visitors"] for r in out.filter(F.col("Visit_Purpose") == "Tourist").collect()} == {1, 5}


def test_unknown_country():
    with pytest.raises(ValueError):
        spec_for("FR")


# ---- ragged-row mode equals the wide mode -----------------------------------------------------

from skein.operators.panel import unpivot_panel_rows  # noqa: E402


def to_rows(df, source):
    hdr = [(source, 0, list(df.columns))]
    body = [(source, i + 1, [None if v is None else str(v) for v in r]) for i, r in enumerate(df.collect())]
    return df.sparkSession.createDataFrame(hdr + body, "source string, row_no int, cells array<string>")


def _strs(rs):
    return sorted(tuple(None if v is None else str(v) for v in r) for r in rs)


def test_rows_mode_equals_wide_mode(spark):
    cases = [(mx_frame(spark), MX, ["product"], None),
             (mx_frame(spark, lc_order=("Lc SEM - 02/2019", "Lc SEM - 01/2019")), MX, ["product"], None),
             (mx_frame(spark, drop_lc="Lc SEM - 02/2019"), MX.replace(pair_by="position"), ["product"], None),
             (mx_frame(spark, drop_lc="Lc SEM - 02/2019"), MX, ["product"], None),
             (spark.createDataFrame([("A", "m1", 1.0, 2.0), ("B", "m2", None, 4.0)],
                                    "product string, maker string, `2019/1-` double, `2019/10-` double"),
              JP, ["product", "maker"], None),
             (jp2_frame(spark), JP2, ["shop"], "a_b_c_d_20181231-x.xlsx")]
    for df, spec, ids, src in cases:
        wide = unpivot_panel(df, spec, source=src)
        long = unpivot_panel_rows(to_rows(df, src or "f.xlsx"), spec, id_labels=ids).drop("source", "row_no")
        assert _strs(wide.collect()) == _strs(long.collect()), spec.name


def test_rows_mode_two_files_two_headers(spark):
    a = to_rows(spark.createDataFrame([("A", 1.0)], "p string, `2019/1-` double"), "a.xlsx")
    b = to_rows(spark.createDataFrame([(2.0, "B", 3.0)], "`2020/12-` double, p string, `2021/1-` double"), "b.xlsx")
    out = unpivot_panel_rows(a.unionByName(b), JP, id_labels=["p"], value_types={"Value": "double"})
    assert rows(out, "source", "p", "YearMonth", "Value") == [
        ("a.xlsx", "A", "2019/01", 1.0), ("b.xlsx", "B", "2020/12", 2.0), ("b.xlsx", "B", "2021/01", 3.0)]
    free = unpivot_panel_rows(a.unionByName(b), JP)
    assert {tuple(x) for r in free.collect() for x in r["ids"]} == {("p", "A"), ("p", "B")}
