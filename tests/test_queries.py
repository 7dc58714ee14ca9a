"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as ent
from skein.plans.tables import TABLES

SF = os.environ.get("SKEIN_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return repr(v)


def _bag(tbl):
    cols = sorted(tbl.column_names)
    data = {c: tbl.column(c).to_pylist() for c in cols}
    return cols, Counter(tuple(_norm(data[c][i]) for c in cols) for i in range(tbl.num_rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ent.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = ent.queries()[name](spark, SF).toArrow()
    sql = ent.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    exp = duck.sql(sql).arrow()
    exp = exp.read_all() if hasattr(exp, "read_all") else exp
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in exp.schema}
    assert _bag(got) == _bag(exp)


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() >= 0 and df.columns
