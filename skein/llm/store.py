"""Where the operators cut lineage: tables in the shared folder, and checkpoints.

A lost executor then costs the tasks of the current stage, not the whole
chain. Both live under ``spark.checkpoint.dir`` as the session names it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir, ship_package


def saved(spark: SparkSession, df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (for tables that several steps read)."""
    path = scratch_path(spark, f"llm-{name}") + "/table"
    df.write.parquet(path, **options)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Eager checkpoint (for small tables that an iteration reads again)."""
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def prepare(spark: SparkSession) -> None:
    """The Python workers import this package's Arrow functions."""
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_held_out(column: str, modulus: int, remainder: int):
    """crc32 of the id as text, modulo ``modulus``, equals ``remainder`` (null ids: false)."""
    hashed = F.crc32(F.col(column).cast("string").cast("binary")) % modulus
    return F.coalesce(hashed == remainder, F.lit(False))
