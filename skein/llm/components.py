"""Connected components of links, as joins and aggregates (alternating stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import checkpointed

EDGES = 1 << 18  # of one file of a round


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b; any direction).

    ``component`` is the smallest node reachable. Each round hangs every
    node's larger neighbours on its smallest one (large star), then its
    smaller ones (small star); both are a min aggregate and a join, so no
    group is gathered in a task. A round costs two shuffles of the links;
    the number of rounds is logarithmic in the longest path. A round is
    written in one file for every ``EDGES`` links, and few links are worked on
    in one task without a shuffle: no round has more links than the one
    before. Self links and null ends are ignored; an empty input gives an
    empty result.
    """
    a, b = F.col("a"), F.col("b")
    edges = (links.where(a.isNotNull() & b.isNotNull() & (a != b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges = checkpointed(spark, edges)
    state = _state(edges)
    files = max(1, -(-state[0] // EDGES))
    edges = edges.coalesce(files)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(files)
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.unionByName(low.select("u", F.col("m").alias("v"))).coalesce(files).distinct()
        edges = checkpointed(spark, hung.coalesce(files))
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)
