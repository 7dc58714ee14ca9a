"""Wide-to-long reshaping (melt), its paired form and its inverse.

All operators are narrow (one Expand or Generate over the input rows): no
shuffle, no per-row Python. ``pivot_back`` aggregates, ``rank_within`` moves its rows twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import scratch_path


def qcol(name: str) -> Column:
    """Column by its exact name; header labels often hold dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def qname(name: str) -> str:
    """A column's exact name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    """A string literal as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _inline_arrays(fields: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """``inline`` of arrays given as SQL text, one an output column, zipped by position.

    A panel of hundreds of columns is one expression to parse instead of
    thousands of calls, its labels are one literal, and the generated code is a
    short loop over the zipped arrays: code for a struct a column would outgrow
    what the JVM compiles.
    """
    arrays = ", ".join("array(" + ", ".join(items) + ")" for _, items in fields)
    return F.expr(f"inline(arrays_zip({arrays}))").alias(*[name for name, _ in fields])


def _as_col(c) -> Column:
    return c if isinstance(c, Column) else qcol(c)


def _as_label(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def unpivot_wide(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                 label_col: str = "label", value_col: str = "value",
                 labels: Mapping[str, object] | None = None,
                 value_type: str | None = None) -> DataFrame:
    """UNP1 / UNP3: melt ``values`` into (label, value); nulls are kept.

    ``labels`` maps a value column to its output label (a string or a Column
    expression, e.g. a date computed from the file name). Without it the column
    name is the label. ``value_type`` casts every value first, which is how
    mixed-type panels are made meltable.
    """
    values = list(values)
    if not values:
        raise ValueError("unpivot_wide: no value columns")
    clash = {label_col, value_col} & set(ids)
    if clash:
        raise ValueError(f"unpivot_wide: output names {sorted(clash)} equal id columns")
    if labels is None and value_type is None:
        return df.unpivot([qcol(i) for i in ids], [qcol(v) for v in values], label_col, value_col)
    labels = labels or {}
    if all(isinstance(labels.get(v, v), str) for v in values):
        cast = (lambda e: e) if value_type is None else (lambda e: f"CAST({e} AS {value_type})")
        return df.select(*[qcol(i) for i in ids], _inline_arrays(
            [(label_col, [_text(labels.get(v, v)) for v in values]), (value_col, [cast(qname(v)) for v in values])]))
    entries = []
    for v in values:
        val = qcol(v) if value_type is None else qcol(v).cast(value_type)
        entries.append(F.struct(_as_label(labels.get(v, v)).alias(label_col), val.alias(value_col)))
    return df.select(*[qcol(i) for i in ids], F.inline(F.array(*entries)))


def unpivot_paired(df: DataFrame, ids: Sequence[str],
                   groups: Sequence[tuple[object, Mapping[str, object]]],
                   label_col: str = "label",
                   value_types: Mapping[str, str] | None = None) -> DataFrame:
    """UNP2: melt several parallel column groups in one pass.

    ``groups`` is a list of ``(label, {output_name: column_or_None})``; a
    missing member (``None``) gives a null, so unequal groups never shift.
    One Generate over the groups' columns packed into one array an output.
    """
    if not groups:
        raise ValueError("unpivot_paired: no groups")
    names = list(groups[0][1].keys())
    value_types = value_types or {}
    types = {n: value_types.get(n) for n in names}
    schema = df.schema
    for n in names:
        if types[n] is None:
            for _, members in groups:
                if members.get(n) is not None:
                    types[n] = schema[members[n]].dataType.simpleString() if isinstance(members[n], str) else None
                    break
    if all(isinstance(x, str) or x is None for label, members in groups for x in (label, *members.values())):
        def sql(m, t):
            e = "NULL" if m is None else qname(m)
            return e if t is None else f"CAST({e} AS {t})"

        return df.select(*[qcol(i) for i in ids], _inline_arrays(
            [(label_col, ["NULL" if label is None else _text(label) for label, _ in groups]),
             *[(n, [sql(members.get(n), types[n]) for _, members in groups]) for n in names]]))
    entries = []
    for label, members in groups:
        fields = [_as_label(label).alias(label_col)]
        for n in names:
            m = members.get(n)
            c = F.lit(None) if m is None else _as_col(m)
            if types[n] is not None:
                c = c.cast(types[n])
            fields.append(c.alias(n))
        entries.append(F.struct(*fields))
    return df.select(*[qcol(i) for i in ids], F.inline(F.array(*entries)))


def pair_groups(first: Sequence[str], second: Sequence[str], key_first, key_second=None,
                by: str = "label") -> list[tuple[str, str | None, str | None]]:
    """Pair two header groups for ``unpivot_paired`` (driver side, on names).

    ``by="label"`` pairs members whose derived key is equal: the n-th member of
    a key with the n-th of the other group (a missing partner gives None). ``by="position"`` pairs the n-th with the n-th and stops at
    the shorter group, the way a positional inner concat does.
    Returns ``(key, first_member, second_member)``.
    """
    key_second = key_second or key_first
    if by == "position":
        return [(key_first(a), a, b) for a, b in zip(first, second)]
    if by != "label":
        raise ValueError("pair_groups: by must be 'label' or 'position'")
    members: dict[str, tuple[list, list]] = {}
    for side, (group, key) in enumerate(((first, key_first), (second, key_second))):
        for name in group:
            members.setdefault(key(name), ([], []))[side].append(name)
    return [(k, a, b) for k, sides in members.items() for a, b in zip_longest(*sides)]


def pivot_back(long_df: DataFrame, ids: Sequence[str], label_col: str, value_col: str,
               labels: Sequence[str]) -> DataFrame:
    """UNP5: long to wide for a fixed label list.

    Written as one conditional aggregation, so there is a single shuffle on the
    ids with a map-side partial aggregate (Spark's ``pivot`` would aggregate
    twice). Duplicate (ids, label) rows keep the first value met.
    """
    aggs = [F.first(F.when(F.col(label_col) == F.lit(lbl), F.col(value_col)), ignorenulls=True).alias(lbl)
            for lbl in labels]
    return long_df.groupBy(*[qcol(i) for i in ids]).agg(*aggs)


def pivot_back_discovered(long_df: DataFrame, ids: Sequence[str], label_col: str, value_col: str, aggregated: int = 64) -> DataFrame:
    """UNP5 without a label list: one column a label met, in label order.

    The labels are read first (the label column alone, one row a label and
    task is shuffled). Up to ``aggregated`` of them, the rest is ``pivot_back``'s
    conditional aggregation, so one row an id and task moves, once. A wider
    table moves the long rows once, by id, makes a map of each id's values,
    written to the shared folder, and reads every column from it: its rows would be
    mostly empty before the shuffle. NULL ids are ids like any other. A
    NULL label gives its id a row but no column; of duplicate (ids, label) rows
    the smallest value stays; a label named like an id column is an error.
    """
    keys, label, value = [qcol(i) for i in ids], qcol(label_col), qcol(value_col)
    found = [r["k"] for r in long_df.select(label.alias("k")).where("k is not null").distinct().orderBy("k").collect()]
    labels = [str(k) for k in found]
    if clash := sorted(set(labels) & set(ids)):
        raise ValueError(f"labels named like id columns: {clash}")
    if not labels:
        return long_df.select(*keys).distinct()
    if len(labels) <= aggregated:
        return long_df.groupBy(*keys).agg(*[F.min(F.when(label == F.lit(k), value)).alias(x) for k, x in zip(found, labels)])
    cells = long_df.repartition(*keys).groupBy(*keys, label.alias("_label")).agg(F.min(value).alias("_value"))
    entries = F.collect_list(F.when(F.col("_label").isNotNull(), F.struct("_label", "_value")))
    path = f"{scratch_path(long_df.sparkSession, 'pivot')}/cells"
    cells.groupBy(*keys).agg(F.map_from_entries(entries).alias("_cells")).write.parquet(path)
    wide = long_df.sparkSession.read.parquet(path)
    return wide.select(*keys, *[F.try_element_at("_cells", F.lit(k)).alias(x) for k, x in zip(found, labels)])


def concat_by_position(left: DataFrame, right: DataFrame, on: Sequence[str], pos_col: str = "row_no",
                       how: str = "inner") -> DataFrame:
    """JON1: side-by-side concat of two ordered tables of one source.

    Position is data (a ``row_no`` emitted by the reader or made by a bounded
    window), so the concat is an equi-join on ``(on..., pos)``; ``inner`` drops
    the tail of the longer side like a positional inner concat.
    """
    return left.join(right, list(on) + [pos_col], how)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], pos_col: str = "pos",
                partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its key group, by ``order``
    (make ``order`` unique within a key for a deterministic result). NULL keys
    form a group of their own.

    Skew-safe: one range exchange on ``(keys, order)`` cuts a key holding a
    third of all rows into many buckets. The ranged rows are written to the
    shared folder with their bucket number, so a retried task and every branch
    below see the same buckets. Rows are numbered per (bucket, key) and shifted
    by the rows of the same key in earlier buckets; only a bucket's first and
    last key can be shared with another bucket, so at most two counts a bucket
    are made and the shifts (fewer than ``partitions`` rows) are broadcast.
    The plan does not grow with the number of buckets.
    """
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "rank")
    (df.repartitionByRange(n, *keys, *order).withColumn("_pid", F.spark_partition_id())
     .write.mode("overwrite").parquet(path))
    ranged = spark.read.parquet(path)
    key = F.struct(*[F.col(k) for k in keys])
    local = ranged.withColumn("_lr", F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order)))
    tagged = ranged.select("_pid", key.alias("_k"))
    edges = tagged.groupBy("_pid").agg(F.min("_k").alias("_lo"), F.max("_k").alias("_hi"))
    ends = (tagged.join(F.broadcast(edges), "_pid")
            .filter(F.col("_k").eqNullSafe(F.col("_lo")) | F.col("_k").eqNullSafe(F.col("_hi")))
            .groupBy("_pid", "_k").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy("_k").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (ends.select(F.col("_pid").alias("_spid"), "_k", F.sum("_n").over(before).alias("_off"))
              .filter(F.col("_off") > 0))
    same = F.col("_pid") == F.col("_spid")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_k")[k])
    return (local.join(F.broadcast(shifts), same, "left")
            .withColumn(pos_col, (F.col("_lr") + F.coalesce(F.col("_off"), F.lit(0))).cast("int"))
            .select(*df.columns, pos_col))


def concat_by_rank(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str],
                   left_cols: Sequence[str], right_cols: Sequence[str], pos_col: str = "pos",
                   how: str = "inner") -> DataFrame:
    """JON1 when positions must first be computed: the n-th row of ``left``
    beside the n-th row of ``right`` within each key, rows ranked by ``order``.

    Both sides are tagged and unioned, ranked per (key, side) with the
    skew-safe ``rank_within``, then paired by an aggregate on (key, position):
    every (key, position) group holds at most two rows, so a hot key is spread
    over all tasks. ``inner`` drops the tail of the longer side, ``outer``
    keeps it with NULLs.
    """
    keys, order = list(keys), list(order)
    lv = F.struct(*[F.col(c) for c in left_cols])
    rv = F.struct(*[F.col(c) for c in right_cols])
    l_type = left.select(lv.alias("v")).schema["v"].dataType.simpleString()
    r_type = right.select(rv.alias("v")).schema["v"].dataType.simpleString()
    lt = left.select(*keys, *order, F.lit(0).alias("_side"), lv.alias("_l"), F.lit(None).cast(r_type).alias("_r"))
    rt = right.select(*keys, *order, F.lit(1).alias("_side"), F.lit(None).cast(l_type).alias("_l"), rv.alias("_r"))
    ranked = rank_within(lt.unionByName(rt), [*keys, "_side"], order, pos_col)
    paired = ranked.groupBy(*keys, pos_col).agg(F.first("_l", ignorenulls=True).alias("_l"),
                                                F.first("_r", ignorenulls=True).alias("_r"))
    if how == "inner":
        paired = paired.filter(F.col("_l").isNotNull() & F.col("_r").isNotNull())
    elif how != "outer":
        raise ValueError("how must be inner or outer")
    return paired.select(*keys, pos_col, *[F.col("_l")[c].alias(c) for c in left_cols],
                         *[F.col("_r")[c].alias(c) for c in right_cols])
