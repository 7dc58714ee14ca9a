"""Properties: round trips, row counts, partition invariance, stream = batch."""

from pyspark.sql import functions as F

from conftest import rows
from skein.operators import pivot_back, unpivot_paired, unpivot_wide

SF = "/root/testdata/sf0.001"
IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
VALS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def test_pivot_of_unpivot_is_identity(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(*IDS, *VALS)
    keyed = li.withColumn("rid", F.monotonically_increasing_id())
    back = pivot_back(unpivot_wide(keyed, IDS + ["rid"], VALS, "m", "v"), IDS + ["rid"], "m", "v", VALS)
    assert li.exceptAll(back.select(*IDS, *VALS)).count() == 0
    assert back.count() == li.count()


def test_rows_out_equal_rows_in_times_values_with_nulls(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, None)], "k int, a double, b double")
    out = unpivot_wide(df, ["k"], ["a", "b"], "l", "v")
    assert out.count() == 4 and out.filter(F.col("v").isNull()).count() == 3


def test_result_independent_of_partitioning(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(*IDS, *VALS)
    a = unpivot_wide(li.repartition(1), IDS, VALS, "m", "v")
    b = unpivot_wide(li.repartition(16), IDS, VALS, "m", "v")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_paired_is_one_generate_without_exchange(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 4.0)], "k int, u1 double, u2 double, v1 double, v2 double")
    out = unpivot_paired(df, ["k"], [("w1", {"Unit": "u1", "Value": "v1"}), ("w2", {"Unit": "u2", "Value": "v2"})],
                         "week")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" in plan
    assert rows(out) == [(1, "w1", 1.0, 3.0), (1, "w2", 2.0, 4.0)]


def test_filter_on_id_reaches_the_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(*IDS, *VALS)
    out = unpivot_wide(li, IDS, VALS, "m", "v").filter(F.col("l_orderkey") < 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_orderkey), LessThan(l_orderkey,10)]" in plan


def test_concat_by_rank_inner_and_outer(spark):
    from skein.operators import concat_by_rank

    left = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "d")], "k int, o int, lv string")
    right = spark.createDataFrame([(1, 5, "x"), (1, 9, "y"), (3, 1, "z")], "k int, o int, rv string")
    inner = concat_by_rank(left, right, ["k"], ["o"], ["lv"], ["rv"])
    assert rows(inner) == [(1, 1, "a", "x"), (1, 2, "b", "y")]
    outer = concat_by_rank(left, right, ["k"], ["o"], ["lv"], ["rv"], how="outer")
    assert len(outer.collect()) == 5


def test_rank_within_hot_key_matches_window(spark):
    from pyspark.sql import Window

    from skein.operators import rank_within

    # key 0 holds most rows: it must be split over partitions and still be numbered 1..n; NULL is a key too
    df = spark.range(20000).select((F.when(F.col("id") % 10 < 7, 0).when(F.col("id") % 10 == 7, None)
                                    .otherwise(F.col("id") % 13)).alias("k"),
                                   (F.col("id") * 7919 % 20011).alias("o"))
    got = rank_within(df, ["k"], ["o"], partitions=16)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("int"))
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == 20000
    ranged = spark.read.parquet(*got.inputFiles())
    assert ranged.filter("k = 0").select("_pid").distinct().count() > 5  # the hot key is cut into many buckets
    assert rank_within(df.limit(0), ["k"], ["o"]).count() == 0

    def plan(n):
        return len(rank_within(df, ["k"], ["o"], partitions=n)._jdf.queryExecution().optimizedPlan().toString())

    assert abs(plan(4) - plan(200)) < 50  # the plan does not grow with the buckets


def test_label_pruning_reaches_the_scan(spark, tmp_path):
    from skein.operators.panel import JP, unpivot_panel

    df = spark.createDataFrame([("A", 1.0, 2.0, 3.0)], "p string, `2019/1-` double, `2019/2-` double, `2019/3-` double")
    path = str(tmp_path / "panel")
    df.write.parquet(path)
    wide = spark.read.parquet(path)
    out = unpivot_panel(wide, JP, labels=["2019/02"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p:string,2019/2-:double>" in plan
    assert [tuple(r) for r in out.collect()] == [("A", "2019/02", 2.0)]


def test_mixed_type_panels_melt_after_a_declared_cast(spark):
    df = spark.createDataFrame([(1, 5, "-", 2.5)], "k int, a int, b string, c double")
    out = unpivot_wide(df, ["k"], ["a", "b", "c"], "l", "v", value_type="string")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "5"), (1, "b", "-"), (1, "c", "2.5")]
    widened = unpivot_wide(df.select("k", "a", "c"), ["k"], ["a", "c"], "l", "v")
    assert dict(widened.dtypes)["v"] == "double"


def test_labels_and_names_with_quotes(spark):
    df = spark.createDataFrame([(1, 2, 3)], "k int, `a'b\\` int, `c``d` int".replace("\\\\", "\\"))
    names = df.columns[1:]
    out = unpivot_wide(df, ["k"], names, "l'", "v", labels={n: f"<{n}'\\>" for n in names})
    assert sorted(tuple(r) for r in out.collect()) == sorted((1, f"<{n}'\\>", x) for n, x in zip(names, (2, 3)))
