"""Source divergence audit (operator 11): how far each source's words are from the other sources' of its language.

Terms are counted once for every (language, source) group. The terms a
language keeps are dealt into blocks and numbered inside them, so a group is
one sorted (term id, count) array a block, whatever the vocabulary's size. A
pair task co-groups the arrays of two bundles of groups; every unordered pair
in it is priced by a galloping intersection: terms that both have, terms of
one side against the other's price of an absent term, and the terms that
neither has by their number alone. The distance is the same both ways, so
each pair's sum over the blocks is written for both of its groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import prepare, saved
from .words import LOWER, doc_index, text_slices, texts_of

SCALE = 1_000_000_000
BLOCK_TERMS = 1 << 13  # terms of a language in one array
BUNDLE = 8  # groups that travel to a pair task together
SALTS = 64
CHUNK = 64  # ids located by one gallop

#: bytes of a term: letters of ASCII, and everything beyond ASCII
IN_TERM = np.zeros(256, bool)
IN_TERM[ord("A") : ord("Z") + 1] = True
IN_TERM[ord("a") : ord("z") + 1] = True
IN_TERM[0x80:] = True

COUNTED = "lang string, source string, term string, n long, docs long"


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(terms in lower case, index of the first term of each text)."""
    inside = IN_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # a term ends with its text
    begins = inside & np.concatenate([[True], ~inside[:-1] | edge[1:-1]])[: len(data)]
    starts = np.flatnonzero(begins)
    own = np.cumsum(inside)
    bounds = np.append(own[starts] - 1, own[-1] if len(own) else 0).astype(np.int64)
    compact = LOWER[data[inside]]
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(compact))
    return terms, np.searchsorted(starts, offsets)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) in a slice of texts."""
    for batch in text_slices(batches, max_bytes=1 << 22, max_rows=1 << 14):
        texts = texts_of(batch.column("text"))
        terms, firsts = _terms(texts.data, texts.offsets)
        if not len(terms):
            continue
        coded = terms.dictionary_encode()
        code, known = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
        lang, source = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
        sources = len(source.dictionary)
        group = lang.indices.to_numpy().astype(np.int64) * sources + source.indices.to_numpy()
        of_doc, n = np.unique(doc_index(firsts) * known + code, return_counts=True)
        key = group[of_doc // known] * known + of_doc % known
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        own = ranked[fresh] // known
        yield pa.RecordBatch.from_arrays([
            lang.dictionary.take(pa.array(own // sources)), source.dictionary.take(pa.array(own % sources)),
            coded.dictionary.take(pa.array(ranked[fresh] % known)).cast(pa.string()),
            pa.array(np.add.reduceat(n[order], fresh)), pa.array(np.diff(np.append(fresh, len(ranked))))],
            ["lang", "source", "term", "n", "docs"])


def price(counts: np.ndarray, total: int, add: int) -> np.ndarray:
    """``1 + floor(10**9 * (counts + add) / total)`` for whole numbers up to ``total``, by long division in three steps of 1000."""
    left = counts.astype(np.int64) + add
    out = np.zeros_like(left)
    for _ in range(3):
        left *= 1000
        out = out * 1000 + left // total
        left %= total
    return out + 1


def gallop(small: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in small, places in large) of the ids that both sorted arrays hold.

    Walks the smaller array in chunks; doubling steps from the last place find
    where a chunk's ids end in the larger array, and only that stretch is searched.
    """
    mine, theirs, low = [], [], 0
    for at in range(0, len(small), CHUNK):
        ids = small[at : at + CHUNK]
        step, high = CHUNK, low
        while high < len(large) and large[high] <= ids[-1]:
            high += step
            step *= 2
        stretch = large[low : min(high + 1, len(large))]
        if not len(stretch):
            break
        place = np.searchsorted(stretch, ids)
        found = np.flatnonzero((place < len(stretch)) & (stretch[np.minimum(place, len(stretch) - 1)] == ids))
        mine.append(found + at)
        theirs.append(place[found] + low)
        low += int(place[-1])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *mine]), np.concatenate([empty, *theirs])


def _distance(a: tuple, b: tuple, terms: int) -> int:
    """Sum of price differences over a block's terms. A side is (ids, prices, price of an absent term)."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    (a_ids, a_price, a_none), (b_ids, b_price, b_none) = a, b
    at_a, at_b = gallop(a_ids, b_ids)
    only_a, only_b = np.abs(a_price - b_none), np.abs(b_price - a_none)
    both = np.abs(a_price[at_a] - b_price[at_b])
    neither = terms - len(a_ids) - len(b_ids) + len(at_a)
    return int(only_a.sum() - only_a[at_a].sum() + only_b.sum() - only_b[at_b].sum() + both.sum()) + neither * abs(a_none - b_none)


def _pairs(left: pa.Table, right: pa.Table, add: int) -> pa.Table:
    """Distances of the unordered pairs of groups of two bundles (the right one is empty for pairs inside a bundle)."""
    def sides(table: pa.Table) -> list[tuple]:
        out = []
        for row in range(table.num_rows):
            of = lambda name: table.column(name)[row]  # noqa: E731, B023
            total = of("total").as_py()
            ids, counts = (of(c).values.to_numpy() if of(c).is_valid else np.zeros(0, np.int64) for c in ("ids", "counts"))
            prices = price(counts, total, add) if total else counts
            out.append((of("source").as_py(), (ids, prices, int(price(np.zeros(1), total, add)[0]) if total else 0), of("block_terms").as_py()))
        return sorted(out, key=lambda x: x[0].encode())

    own, other = sides(left), sides(right)
    pairs = list(product(own, other)) if other else list(combinations(own, 2))
    lang = (left if left.num_rows else right).column("lang")[0].as_py()
    ends = [sorted((x[0], y[0]), key=str.encode) for x, y in pairs]
    values = [_distance(x[1], y[1], x[2]) for x, y in pairs]
    return pa.table([pa.array([lang] * len(pairs), pa.string()), pa.array([e[0] for e in ends], pa.string()),
                     pa.array([e[1] for e in ends], pa.string()), pa.array(values, pa.int64())], ["lang", "a", "b", "value"])


def source_divergence(spark: SparkSession, docs: DataFrame, min_docs: int = 30, add: int = 5, top: int = 50,
                      block_terms: int = BLOCK_TERMS, bundle: int = BUNDLE) -> DataFrame:
    """Distances between the sources of each language, and each source's most over-used terms.

    ``docs`` needs text, lang and source. Terms are stretches of ASCII letters
    (lower-cased) and characters beyond ASCII; a language keeps those in at
    least ``min_docs`` of its documents. A group's price of a kept term is
    ``1 + floor(10**9 * (count + add) / (N + add * V))``, all in whole numbers.
    Returns lang, source, part, item, value, rank: part ``pair`` has a row for
    every other source of the language (the prices' absolute differences summed
    over its kept terms), part ``term`` the ``top`` kept terms that the source
    has and prices above its language. Ranks go by value descending, then item
    in byte order.

    The vocabulary is cut into blocks of about ``block_terms``, so no array and
    no task grows with it; ``bundle`` groups share a pair task, so an array is
    sent once for each ``bundle`` other sources. Rows out grow with the square
    of a language's sources, as asked.

    Defined cases: null text, lang and source count as ''; groups whose texts
    are empty have pairs and no terms; without kept terms all pairs are 0; a
    language's only source has no pairs; repeated rows count each; a text may
    be of any length; an empty table gives no rows; extra columns are ignored.
    """
    prepare(spark)
    clean = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    rows = docs.select(clean("lang"), clean("source"), clean("text"))
    counted = saved(spark, rows.where("text != ''").mapInArrow(_counted, COUNTED)
                    .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    kept = saved(spark, counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                 .where(F.col("docs") >= min_docs).drop("docs"), "divergence-kept")
    langs = (kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
             .withColumn("blocks", F.ceil(F.col("v") / block_terms).cast("int")))
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS)).alias("salt")  # a language's terms meet its row in many tasks
    salted = langs.select("lang", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    numbered = (kept.select("*", salt).join(salted, ["lang", "salt"]).withColumn("block", F.pmod(F.xxhash64("term", F.lit(1)), F.col("blocks").cast("long")).cast("int"))
                .withColumn("id", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term"))))
    sparse = saved(spark, counted.select("lang", "source", "term", "n").join(numbered.select("lang", "term", "lang_n", "block", "id"), ["lang", "term"]), "divergence-sparse")

    sizes = sparse.groupBy("lang", "source").agg(F.sum("n").alias("n_kept"))
    groups = (rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
              .withColumns({"v": F.coalesce("v", F.lit(0)), "blocks": F.greatest(F.coalesce("blocks", F.lit(0)), F.lit(1))})
              .withColumns({"total": F.coalesce("n_kept", F.lit(0)) + F.lit(add) * F.col("v"), "lang_total": F.col("lang_total") + F.lit(add) * F.col("v"),
                            "bundle": F.floor((F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) / bundle).cast("int")}))
    groups = saved(spark, groups.select("lang", "source", "total", "lang_total", "blocks", "bundle"), "divergence-groups")
    found = _pair_part(sparse, groups, numbered, add).unionByName(_term_part(sparse, groups, add, top))
    return found.select("lang", "source", "part", "item", "value", "rank")


def _pair_part(sparse: DataFrame, groups: DataFrame, numbered: DataFrame, add: int) -> DataFrame:
    arrays = (sparse.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("of"))
              .select("lang", "source", "block", F.col("of.id").alias("ids"), F.col("of.n").alias("counts")))
    in_block = numbered.groupBy("lang", "block").agg(F.count("*").alias("block_terms"))
    bundles = groups.groupBy("lang").agg(F.max("bundle").alias("last"))
    every = (groups.join(bundles, "lang").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
             .join(in_block, ["lang", "block"], "left").join(arrays, ["lang", "source", "block"], "left")
             .withColumn("block_terms", F.coalesce("block_terms", F.lit(0)))
             .withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("last")))))
    sides = every.select("lang", "block", F.least("bundle", "partner").alias("low"), F.greatest("bundle", "partner").alias("high"),
                         "bundle", "source", "total", "block_terms", "ids", "counts")
    key = ["lang", "block", "low", "high"]
    left, right = sides.where("bundle = low").drop("bundle"), sides.where("bundle = high and low < high").drop("bundle")
    right = right.toDF(*right.columns)  # columns of its own: both sides come from one table
    priced = (left.groupBy(*key).cogroup(right.groupBy(*key))
              .applyInArrow(lambda a, b: _pairs(a, b, add), "lang string, a string, b string, value long")
              .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    ways = priced.select("lang", "value", both.alias("way")).select("lang", "way.source", "way.item", "value", F.lit("pair").alias("part"))
    return ways.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def _term_part(sparse: DataFrame, groups: DataFrame, add: int, top: int) -> DataFrame:
    def priced(count: str, total: str):
        return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({count} + {add} as decimal(20, 0))) div cast({total} as decimal(20, 0))")

    rows = (sparse.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
            .withColumn("value", priced("n", "total") - priced("lang_n", "lang_total")).where("value > 0"))
    first = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return (rows.withColumn("rank", first).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


#: DuckDB SQL of the query with its production parameters.
SOURCE_DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::BIGINT AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT g.lang, coalesce(any_value(s.v), 0) AS v, coalesce(any_value(s.n), 0) AS n FROM g LEFT JOIN (SELECT lang, count(*) AS v, sum(lang_n) AS n FROM k GROUP BY ALL) s ON s.lang = g.lang GROUP BY g.lang),
c AS (SELECT t.lang, source, term, count(*) AS n FROM t SEMI JOIN k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
z AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (z.n + 5 * v.v) AS p,
             1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (v.n + 5 * v.v) AS q
      FROM g JOIN k ON k.lang = g.lang JOIN z ON z.lang = g.lang AND z.source = g.source JOIN v ON v.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pair AS (SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(s.value, 0)::BIGINT AS value
         FROM g JOIN g o ON o.lang = g.lang AND o.source <> g.source LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = o.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
QUALIFY part = 'pair' OR rank <= 50
"""
