"""Randomised checks of the array operators against plain Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skein.operators.headers import drop_first_empty, flatten_two_level, occurrences
from skein.operators.rows import compact_cells, record_get, zip_record

LABELS = st.lists(st.sampled_from(["a", "b", "", "Cases", "Geospread", "x.1"]), min_size=0, max_size=8)
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def model_occurrences(h):
    seen, out = {}, []
    for i, x in enumerate(h):
        seen[x] = seen.get(x, 0) + 1
        out.append((x, i, seen[x]))
    return out


def model_flatten(upper, lower, markers=("Cases", "Geospread")):
    out, n = [], 0
    for x in lower:
        if x in markers:
            n += 1
        out.append(f"{upper[n]} {x}" if n < len(upper) else None)
    return out


@SETTINGS
@given(h=LABELS)
def test_occurrences_and_drop_first_empty(spark, h):
    df = spark.createDataFrame([(h,)], "h array<string>")
    got = df.select(occurrences("h").alias("o"), drop_first_empty("h").alias("d")).collect()[0]
    assert [(o["label"], o["col_no"], o["occurrence"]) for o in got["o"]] == model_occurrences(h)
    want = list(h)
    if "" in want:
        want.remove("")
    assert got["d"] == want


@SETTINGS
@given(upper=st.lists(st.sampled_from(["P", "Q", "R"]), min_size=1, max_size=4), lower=LABELS)
def test_flatten_two_level(spark, upper, lower):
    df = spark.createDataFrame([(upper, lower)], "u array<string>, l array<string>")
    assert df.select(flatten_two_level("u", "l")).collect()[0][0] == model_flatten(upper, lower)


@SETTINGS
@given(h=LABELS, c=st.lists(st.sampled_from(["1", "", "z"]), max_size=8))
def test_zip_record_and_compact(spark, h, c):
    df = spark.createDataFrame([(h, c)], "h array<string>, c array<string>")
    keys = sorted(set(h))
    row = df.select(*[record_get(zip_record("h", "c"), k).alias(f"k{i}") for i, k in enumerate(keys)],
                    compact_cells("c").alias("cc")).collect()[0]
    rec = dict(zip(h, c))  # shorter side wins, last key wins
    assert [row[f"k{i}"] for i in range(len(keys))] == [rec.get(k) for k in keys]
    assert row["cc"] == [x for x in c if x != ""]


def test_report_filter_range_reaches_the_scan(spark):
    from skein.plans.queries import report_filter

    plan = report_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters: [IsNotNull(o_orderdate)"):]
    assert pushed.startswith("PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1996-03-04T00:00), "
                             "LessThan(o_orderdate,")
