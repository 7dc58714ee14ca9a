"""STR1: the unpivot over files as they arrive (each file once).

A file-source stream replaces "skip what was already converted": the
checkpoint remembers processed files. ``availableNow`` processes everything
present, in bounded micro-batches, then stops; the same code runs as a
continuous job with a processing-time trigger. Stateless, so no watermark.
Whole-file operators (truncation, repeated headers, date sequences) run per
micro-batch through ``foreach_batch``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from skein.operators.unpivot import unpivot_wide


def stream_files(spark: SparkSession, directory: str, schema: StructType, fmt: str = "parquet",
                 glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(directory)


def start_unpivot_stream(stream: DataFrame, ids: Sequence[str], values: Sequence[str], label_col: str,
                         value_col: str, sink_dir: str, checkpoint_dir: str, available_now: bool = True,
                         fmt: str = "parquet") -> StreamingQuery:
    long = unpivot_wide(stream.select(*ids, *values), ids, values, label_col, value_col)
    w = long.writeStream.format(fmt).option("checkpointLocation", checkpoint_dir).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(sink_dir)


def start_batch_stream(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint_dir: str,
                       available_now: bool = True) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` per micro-batch (whole-file operators, several sinks)."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_workbooks(spark: SparkSession, folder: str, sheet: str | None = None, header_row: int = 0,
                     exclude: str | None = "pivoted", max_files_per_trigger: int | None = None,
                     on_error: str = "fail", nested: bool = False) -> DataFrame:
    """Workbooks arriving in ``folder`` as a stream of ragged rows with their
    file's header context (see ``read_xlsx``): ``binaryFile`` file stream +
    the same Arrow parse. Each file is parsed once, in one task, so every
    layout but the sorted region block runs on it without state or joins."""
    from pyspark.sql import functions as F

    from skein.sources.xlsx import read_xlsx_files

    schema = "path string, modificationTime timestamp, length long, content binary"
    r = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.xlsx")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = r.load(folder).withColumn("file_name", F.element_at(F.split(F.col("path"), "/"), -1))
    if exclude:
        files = files.filter(~F.col("file_name").contains(exclude))
    return read_xlsx_files(files, sheet, header_row=header_row, on_error=on_error, nested=nested)


def start_sink(long: DataFrame, sink_dir: str, checkpoint_dir: str, available_now: bool = True,
               fmt: str = "parquet") -> StreamingQuery:
    w = long.writeStream.format(fmt).option("checkpointLocation", checkpoint_dir).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(sink_dir)
