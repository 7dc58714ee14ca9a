"""Streams with rejects, tables split over batches, header folds and pivots without labels."""

import tempfile

import pytest
from pyspark.sql import functions as F

from skein.functions.labels import month_sequence, parse_year_month
from skein.operators import pivot_back_discovered
from skein.operators.headers import flatten_two_level, occurrences
from skein.operators.rows import ragged_reason
from skein.streaming import start_sequence_stream, start_split_stream, stream_files


def _run(spark, root, parts, ddl, start):
    for part in parts:
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(f"{root}/in")
        start(stream_files(spark, f"{root}/in", spark.createDataFrame([], ddl).schema)).awaitTermination()


def test_rejects_of_a_stream_and_a_batch_run_again(spark):
    root = tempfile.mkdtemp(prefix="skein-split-")
    parts = [[(1, ["a", "b"]), (2, ["a"])], [(3, ["a", "b", "c"]), (4, None)], [(5, ["x", "y"])]]
    reason = ragged_reason(F.array(F.lit("h1"), F.lit("h2")), F.col("cells"))
    _run(spark, root, parts, "id long, cells array<string>",
         lambda s: start_split_stream(s, reason, f"{root}/good", f"{root}/bad", f"{root}/ckpt"))

    def read(name):
        return sorted((r.id, r.asDict().get("reject_reason")) for r in spark.read.parquet(f"{root}/{name}").collect())

    good, bad = read("good"), read("bad")
    assert bad == [(2, "short_row"), (3, "long_row")] and good == [(1, None), (4, None), (5, None)]
    # all batches once more from a new checkpoint: the same rows in the same sinks, none twice
    s = stream_files(spark, f"{root}/in", spark.createDataFrame([], "id long, cells array<string>").schema, max_files_per_trigger=1)
    start_split_stream(s, reason, f"{root}/good", f"{root}/bad", f"{root}/ckpt2").awaitTermination()
    assert (read("good"), read("bad")) == (good, bad)


def test_a_table_split_over_batches_equals_the_whole_one(spark):
    root = tempfile.mkdtemp(prefix="skein-sequence-")
    a = [("a", i, c) for i, c in enumerate(["2001．Dec", "x", "x", "END", "gone", "gone"], 5)]
    b = [("b", 0, "2020．Jan"), ("b", 1, None), (None, 0, "1999．May"), (None, 1, "END"), (None, 2, "gone")]
    parts = [a[1::-1] + b[:1], a[2:4][::-1] + b[2:4], a[4:] + b[1:2] + b[4:]]

    def finish(df):
        label = month_sequence(parse_year_month("first_value"), F.col("row_no") - F.col("first_pos.row_no"))
        return df.select("source", "row_no", label.alias("label"))

    _run(spark, root, parts, "source string, row_no int, cell string",
         lambda s: start_sequence_stream(s, ["source"], ["row_no"], f"{root}/out", f"{root}/state", f"{root}/ckpt",
                                         stop=F.col("cell") == "END", first=F.col("cell"), finish=finish))
    got = sorted(((r.source or "", r.row_no, r.label) for r in spark.read.parquet(f"{root}/out").collect()))
    assert got == [("", 0, "199905"), ("", 1, "199906"), ("a", 5, "200112"), ("a", 6, "200201"), ("a", 7, "200202"),
                   ("a", 8, "200203"), ("b", 0, "202001"), ("b", 1, "202002")]


@pytest.mark.parametrize("labels", [[], None, ["x"], [None, "a", None, "b", "a", "", None], [f"c{i % 37}" for i in range(5000)]])
def test_occurrences(spark, labels):
    df = spark.createDataFrame([(labels,)], "h array<string>")
    got = df.select(occurrences("h").alias("o")).first().o
    if labels is None:
        assert got is None
        return
    assert [tuple(x) for x in got] == [(x, i, labels[: i + 1].count(x)) for i, x in enumerate(labels)]


@pytest.mark.parametrize("lower", [[], ["a", None], ["Cases", "a", "Geospread"], ["a", "b", "Cases", "c", None, "Geospread", "Cases", "d"], ["a", *["Cases", "x"] * 2500]])
def test_flatten_two_level(spark, lower):
    upper = ["u0", "u1", None, *[f"u{i}" for i in range(3, 2000)]] if len(lower) > 100 else ["u0", "u1", "u2"]
    got = spark.createDataFrame([(upper, lower)], "u array<string>, l array<string>").select(flatten_two_level("u", "l").alias("f")).first().f
    want, k = [], 0
    for x in lower:
        k += x in ("Cases", "Geospread")
        up = upper[k] if k < len(upper) else None
        want.append(None if up is None or x is None else f"{up} {x}")
    assert got == want


def test_pivot_without_labels(spark):
    rows = [(1, "b", 2), (1, "a.x", 1), (2, "a.x", None), (None, "c", 7), (3, None, 9), (1, "b", 5)]
    got = pivot_back_discovered(spark.createDataFrame(rows, "id long, label string, v long"), ["id"], "label", "v")
    assert got.columns == ["id", "a.x", "b", "c"]
    assert {tuple(r) for r in got.collect()} == {(1, 1, 2, None), (2, None, None, None), (None, None, None, 7), (3, None, None, None)}
    empty = pivot_back_discovered(spark.createDataFrame([], "id long, label string, v long"), ["id"], "label", "v")
    assert empty.columns == ["id"] and empty.count() == 0
    with pytest.raises(ValueError, match="id columns"):
        pivot_back_discovered(spark.createDataFrame([(1, "id", 2)], "id long, label string, v long"), ["id"], "label", "v")


@pytest.mark.parametrize("aggregated", [64, 1])
def test_pivot_without_labels_moves_rows_once(spark, aggregated):
    rows = [(i % 50 or None, f"m{i % 3}" if i % 7 else None, (i * 37) % 101 if i % 5 else None) for i in range(900)]
    long = spark.createDataFrame(rows, "id long, label string, v long").repartition(4, "v")
    got = pivot_back_discovered(long, ["id"], "label", "v", aggregated)
    want = {}
    for i, label, v in rows:
        cells = want.setdefault(i, {})
        if label and v is not None:
            cells[label] = min(v, cells.get(label, v))
    assert got.columns == ["id", "m0", "m1", "m2"]
    assert {r.id: (r.m0, r.m1, r.m2) for r in got.collect()} == {i: tuple(c.get(k) for k in ("m0", "m1", "m2")) for i, c in want.items()}
    assert got.count() == len(want)
    if aggregated == 64:  # one exchange by id, after a partial aggregate
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert "Scan parquet" not in plan and plan.count("HashAggregate") == 2
