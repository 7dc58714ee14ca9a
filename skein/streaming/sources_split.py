"""Streams whose tables (files, users) are split over micro-batches, and streams with rejects.

Everything runs in ``foreachBatch`` and is written to ``<folder>/batch_id=<n>``,
so a batch that is run again after a failure replaces its own output. What a
table's later rows need of its earlier ones (the cut-off, the first row) is a
small table, one row a key: batch n reads the one that batch n - 1 left and
writes its own. It comes from a ``groupBy`` with a map-side partial aggregate,
so the rows of one hot table are never brought into one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skein.operators.rows import split_rejects
from skein.operators.unpivot import qcol
from skein.streaming.unpivot_stream import start_batch_stream


def start_split_stream(stream: DataFrame, reason: Column, good_dir: str, rejects_dir: str, checkpoint_dir: str,
                       reason_col: str = "reject_reason", available_now: bool = True) -> StreamingQuery:
    """FLT11 on a stream: rows whose ``reason`` is NULL go to ``good_dir``, the others with their reason to ``rejects_dir``.

    A batch is read and judged once and kept on the executors until both sinks have it.
    """

    def per_batch(batch: DataFrame, n: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, rejects = split_rejects(kept, reason, reason_col)
            for rows, folder in ((good, good_dir), (rejects, rejects_dir)):
                rows.write.mode("overwrite").parquet(f"{folder}/batch_id={n}")
        finally:
            kept.unpersist()

    return start_batch_stream(stream, per_batch, checkpoint_dir, available_now)


def start_sequence_stream(stream: DataFrame, keys: Sequence[str], order: Sequence[str], out_dir: str, state_dir: str, checkpoint_dir: str,
                          stop: Column | None = None, first: Column | None = None,
                          finish: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True) -> StreamingQuery:
    """FLT2 and WIN3 on a stream: a table's rows may arrive over several batches, in any order inside a batch.

    Rows after the first one (by ``order``) where ``stop`` holds are left out;
    a table without such a row keeps all. With ``first`` every row gets
    ``first_pos`` (the ``order`` columns of its table's first row) and
    ``first_value`` (``first`` there). ``finish`` makes the output of those rows.

    Later batches must hold later rows of a table: a row is judged by what its
    batch and those before hold. A NULL key is a table of its own.
    """
    pos = F.struct(*[qcol(o).alias(o) for o in order])
    key = F.struct(*[qcol(k).alias(k) for k in keys])

    def per_batch(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            when = stop if stop is not None else F.lit(False)
            value = first if first is not None else F.lit(None).cast("string")
            seen = kept.select(key.alias("key"), F.when(when, pos).alias("cut"), F.struct(pos.alias("first_pos"), value.alias("first_value")).alias("opened"))
            if n:
                seen = seen.unionByName(spark.read.schema(seen.schema).parquet(f"{state_dir}/batch_id={n - 1}"))
            state = seen.groupBy("key").agg(F.min("cut").alias("cut"), F.min_by("opened", F.col("opened.first_pos")).alias("opened"))
            state.write.mode("overwrite").parquet(f"{state_dir}/batch_id={n}")
            known = spark.read.schema(state.schema).parquet(f"{state_dir}/batch_id={n}")
            rows = kept.withColumn("_key", key).join(known, F.col("_key").eqNullSafe(F.col("key")))
            rows = rows.where(F.col("cut").isNull() | (pos <= F.col("cut")))
            extra = ["opened.first_pos", "opened.first_value"] if first is not None else []
            rows = rows.select(*[qcol(c) for c in batch.columns], *extra)
            (finish(rows) if finish else rows).write.mode("overwrite").parquet(f"{out_dir}/batch_id={n}")
        finally:
            kept.unpersist()

    return start_batch_stream(stream, per_batch, checkpoint_dir, available_now)
