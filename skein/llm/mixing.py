"""Mixing sources to target weights by pivotal dependent rounding (operator 3).

Only DataFrame functions: sizes, targets, rounding and the reduction tree are
all Catalyst expressions.

A source's target over its size is the expected number of copies of each of
its documents; the whole part is certain, the fraction is rounded by the
pivotal method: two fractional units exchange word mass at random until one
of them is 0 or 1, which keeps both the source's expected words and every
unit's own expectation. Units meet in random groups; the one unit of a group
that stays fractional goes on to the next level, where such residuals meet
again, until a source has one left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import saved

WORD = r"[^\x20\x09-\x0D]+"
GROUP = 128  # units that meet in one fold


def words_in(column: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(units: DataFrame, share: float, most: float, weights: tuple[int, ...]) -> DataFrame:
    """(source, source_size, target) from units (source, size, rows).

    Sources in code point order, null last, take ``weights`` in turn. The mix
    has ``share`` times all words. A target is at most ``most`` times its
    source's size; what that cuts off is shared again by weight. With sources
    ordered by cap over weight, the capped ones come first, so the level that
    the others reach per unit of weight is the maximum over the order of
    (mix - caps before) / (weights from here on). Both windows run over one
    row a source and stream.
    """
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn.cast("int") + 1)
    ranked = sources.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    up_to = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levelled = (ranked.withColumn("caps_before", F.sum("cap").over(up_to) - F.col("cap"))
                .withColumn("weights_before", F.sum("weight").over(up_to) - F.col("weight"))
                .withColumn("mix", share * F.sum("source_size").over(whole))
                .withColumn("weights_all", F.sum("weight").over(whole))
                .withColumn("level", (F.col("mix") - F.col("caps_before")) / (F.col("weights_all") - F.col("weights_before")))
                .withColumn("level", F.max("level").over(whole)))
    return levelled.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _chance(*columns) -> Column:
    """A repeatable uniform number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / float(1 << 53)


UNIT = "struct<doc_id:bigint,size:bigint,mass:double,part:double>"


def _meet(level: int, seed: int):
    """Fold step: the carried fractional unit meets the next one."""

    def step(state: Column, unit: Column) -> Column:
        have = state["carry"]
        p, a, q, b = have["part"], have["mass"], unit["part"], unit["mass"]
        raise_carry = F.least((1 - p) * a, q * b)  # mass that may move to the carried unit
        lower_carry = F.least(p * a, (1 - q) * b)
        to_carry = _chance(have["doc_id"], have["size"], unit["doc_id"], unit["size"], F.lit(level), F.lit(seed)) * (raise_carry + lower_carry) < lower_carry
        moved = F.when(to_carry, raise_carry).otherwise(-lower_carry)
        carry_done = F.when(to_carry, (1 - p) * a <= q * b).otherwise(p * a <= (1 - q) * b)
        carry_up, unit_up = F.when(to_carry, 1).otherwise(0), F.when(to_carry, 0).otherwise(1)
        left = F.when(carry_done, _unit(unit, F.least(F.lit(1.0), F.greatest(F.lit(0.0), q - moved / b)))).otherwise(
            _unit(have, F.least(F.lit(1.0), F.greatest(F.lit(0.0), p + moved / a))))
        done = F.when(carry_done, _settled(have, carry_up)).otherwise(_settled(unit, unit_up))
        first = have["part"] < 0
        return F.struct(F.when(first, unit).otherwise(left).cast(UNIT).alias("carry"),
                        F.when(first, state["done"]).otherwise(F.concat(state["done"], F.array(done))).alias("done"))

    return step


def _unit(unit: Column, part: Column) -> Column:
    return F.struct(unit["doc_id"].alias("doc_id"), unit["size"].alias("size"), unit["mass"].alias("mass"), part.cast("double").alias("part"))


def _settled(unit: Column, up: Column) -> Column:
    return F.struct(unit["doc_id"].alias("doc_id"), unit["size"].alias("size"), up.cast("int").alias("up"))


def _rounded(spark: SparkSession, fractional: DataFrame, seed: int) -> DataFrame:
    """(source, doc_id, size, up) from fractional units (source, doc_id, size, mass, part)."""
    none = F.struct(F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("size"), F.lit(0.0).alias("mass"), F.lit(-1.0).alias("part")).cast(UNIT)
    nothing = F.array().cast("array<struct<doc_id:bigint,size:bigint,up:int>>")
    settled, level, left = [], 0, fractional
    while True:
        counts = left.groupBy("source").agg(F.ceil(F.count("*") / GROUP).cast("long").alias("groups"))
        most = counts.agg(F.max("groups")).first()[0] or 1  # one number
        counts = counts.withColumnRenamed("source", "of")
        spot = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed), F.lit(level)), F.col("groups"))
        folded = (left.join(counts, F.col("source").eqNullSafe(F.col("of"))).withColumn("spot", spot).groupBy("source", "spot")
                  .agg(F.sort_array(F.collect_list(F.struct("mass", "doc_id", "size", "part")), asc=False).alias("units"))
                  .withColumn("units", F.transform("units", lambda u: _unit(u, u["part"]).cast(UNIT)))
                  .select("source", F.aggregate("units", F.struct(none.alias("carry"), nothing.alias("done")), _meet(level, seed)).alias("end")))
        folded = saved(spark, folded, f"rounding{level}")
        settled.append(folded.select("source", F.explode("end.done").alias("u")).select("source", "u.doc_id", "u.size", "u.up"))
        left = folded.select("source", "end.carry.*")
        level += 1
        if most <= 1:
            break
    last = left.select("source", "doc_id", "size", (F.col("part") >= 0.5).cast("int").alias("up"))
    for more in settled:
        last = last.unionByName(more)
    return last


def mix_sources(spark: SparkSession, docs: DataFrame, share: float = 1.5, most: float = 2.0,
                weights: tuple[int, ...] = (3, 1, 2), seed: int = 17) -> DataFrame:
    """Copies of every document so that each source's words come near its target.

    ``docs`` needs doc_id, text and source. Returns doc_id, source, size
    (words), source_size, target (both of the source), copies, taken (copies *
    size), one row for each input row. The last residual of a source is
    rounded to the nearer side; the words it is off by are then exchanged with
    the one settled unit whose words come nearest to them, if that helps.

    The draws are hashes of ids, sizes and ``seed``, so reruns agree however
    the rows are partitioned. Defined cases: null, empty and wordless texts
    have size 0 and are copied as often as the target surely allows (its whole
    part), taking 0 words; a null source is a source, last in order; rows that
    repeat id, source and size are one unit and get the same number of copies;
    an empty table gives an empty result, and a source without words the
    target 0.
    """
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), words_in("text").alias("size"))
    units = saved(spark, sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows")), "sizes")
    goal = saved(spark, targets(units, share, most, weights), "targets").withColumnRenamed("source", "of")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    parts = (units.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
             .withColumn("sure", F.floor(expected)).withColumn("part", expected - F.floor(expected)))
    fractional = parts.where("size > 0 and part > 0").select(
        "source", F.col("doc_id").cast("long").alias("doc_id"), "size", (F.col("size") * F.col("rows")).cast("double").alias("mass"), "part")
    ups = _rounded(spark, fractional, seed).select(F.col("source").alias("u_source"), F.col("doc_id").alias("u_id"), F.col("size").alias("u_size"), "up")
    same = F.col("source").eqNullSafe(F.col("u_source")) & F.col("doc_id").eqNullSafe(F.col("u_id")) & (F.col("size") == F.col("u_size"))
    chosen = saved(spark, parts.join(ups, same, "left").drop("u_source", "u_id", "u_size").withColumn("up", F.coalesce("up", F.lit(0))), "copies")

    mass = F.col("size") * F.col("rows")
    off = chosen.groupBy("source").agg((F.sum(mass * (F.col("sure") + F.col("up"))) - F.max("target")).alias("off")).withColumnRenamed("source", "o_source")
    helps = F.abs(F.abs("off") - mass) < F.abs("off")
    movable = (F.col("part") > 0) & (F.col("size") > 0) & (F.col("up") == (F.col("off") > 0).cast("int")) & helps
    best = (chosen.join(off, F.col("source").eqNullSafe(F.col("o_source"))).where(movable)
            .groupBy("source").agg(F.min(F.struct(F.abs(F.abs("off") - mass).alias("d"), F.col("doc_id").alias("b_id"), F.col("size").alias("b_size"))).alias("b"))
            .select(F.col("source").alias("b_source"), "b.b_id", "b.b_size"))
    swapped = F.col("b_size").isNotNull() & F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("size") == F.col("b_size"))
    copies = F.col("sure") + F.when(swapped, 1 - F.col("up")).otherwise(F.col("up"))
    return (chosen.join(best, F.col("source").eqNullSafe(F.col("b_source")), "left")
            .withColumn("copies", copies.cast("long")).withColumn("each", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))
