"""Source divergence against its SQL and against a plain count, with nulls, empty groups, ties and clashing columns."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from skein.llm.divergence import SOURCE_DIVERGENCE_SQL, gallop, price, source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, block int, value string, a string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["Ärger", "ärger", "the", "The", "OF", "x1y", "中文", "don't", "z z", *[f"w{c}" for c in "abcdefghij"]]
    out = []
    for i in range(420):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["s0", "s0", "s0", "S1", "ü", None, "", "t"]) if lang != "de" else "only"
        text = None if i % 17 == 0 else " ".join(rng.choices(words, k=rng.randint(0, 30))) + rng.choice(["", "\n", "\t7", "."])
        out.append((i, text, lang, source, "t", 1, 2, "v", "a"))
    out += [out[5], out[5], (None, "The the THE", "en", "s0", None, None, None, None, None), (900, "  12 !", "en", "blank", None, None, None, None, None),
            (901, None, "xx", "b", None, None, None, None, None), (902, "rare words only", "xx", "a", None, None, None, None, None),
            (903, "the " * 20000, "en", "long", None, None, None, None, None)]
    return out


def sql(rows, query=SOURCE_DIVERGENCE_SQL):
    con = duckdb.connect()
    documents = pa.table({n: pa.array([r[i] for r in rows], pa.int64() if n == "doc_id" else pa.string()) for i, n in enumerate(["doc_id", "text", "lang", "source"])})
    con.register("documents", documents)
    return sorted(con.execute(query).fetchall())


@pytest.mark.parametrize("block_terms,bundle", [(1 << 13, 8), (3, 2), (1, 1)])
def test_source_divergence_equals_sql(spark, rows, block_terms, bundle):
    got = sorted(map(tuple, source_divergence(spark, spark.createDataFrame(rows, SCHEMA), block_terms=block_terms, bundle=bundle).collect()))
    assert got == sql(rows)
    assert {r[2] for r in got} == {"pair", "term"}
    assert [r for r in got if r[0] == "xx"] == [("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)]  # no kept term
    assert not [r for r in got if r[0] == "de" and r[2] == "pair"]  # a language's only source
    assert any(r[1] == "blank" and r[2] == "pair" for r in got) and not any(r[1] == "blank" and r[2] == "term" for r in got)


def test_source_divergence_of_nothing(spark):
    assert source_divergence(spark, spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, None, None, None, "t", 1, 1, "v", "a")], SCHEMA)
    assert source_divergence(spark, one).count() == 0


def test_source_divergence_top(spark, rows):
    got = source_divergence(spark, spark.createDataFrame(rows, SCHEMA), min_docs=2, top=3).where("part = 'term'").groupBy("lang", "source").count().collect()
    assert max(r["count"] for r in got) == 3


def test_price_is_exact():
    counts = np.array([0, 1, 7, 10**12, 4 * 10**14], np.int64)
    total = 10**15 + 7
    assert price(counts, total, 5).tolist() == [1 + 10**9 * (c + 5) // total for c in counts.tolist()]


def test_gallop():
    rng = np.random.default_rng(2)
    for small, large in [(0, 9), (3, 0), (1, 1), (50, 4000), (700, 900), (900, 700)]:
        a, b = (np.unique(rng.integers(0, 5000, n)) for n in (small, large))
        at_a, at_b = gallop(a, b)
        both, want_a, want_b = np.intersect1d(a, b, return_indices=True)
        assert at_a.tolist() == want_a.tolist() and at_b.tolist() == want_b.tolist() and a[at_a].tolist() == both.tolist()
