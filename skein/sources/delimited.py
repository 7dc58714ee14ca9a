"""Pipe-separated text output and input (SNK1-3).

Options give plain output: header line, ``|`` separator, empty field for
both NULL and '', quotes doubled inside quoted fields, no trimming. Reading
back uses the same options and an explicit schema (no inference).

Output is staged: the job writes to a hidden folder inside the output folder
and only a whole, successful job is published, partition by partition. A
failed job changes nothing; a driver lost while publishing leaves the rest
staged, and ``finish_output`` publishes it. Listing and renaming go through
Hadoop's file system, so any store that Spark writes to will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

PIPE_OPTIONS = {
    "sep": "|",
    "header": "true",
    "emptyValue": "",
    "nullValue": "",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}
STAGED = ".staged-"  # Spark's readers skip names that start with a dot
LIST = "_PARTITIONS"  # written when a job is whole: what it made


def write_pipe_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                   sort_within: Sequence[str] = ()) -> None:
    """Write ``df`` as pipe CSV; ``partition_by`` puts each key (country,
    report, source file) in its own folder instead of a name per file.

    ``mode="overwrite"`` replaces everything in ``path``;
    ``mode="partitions"`` only the partitions that ``df`` has rows of, so the
    output of other files, countries or reports stays. ``mode="append"`` adds.
    """
    if mode not in ("overwrite", "partitions", "append"):
        raise ValueError("write_pipe_csv: mode must be 'overwrite', 'partitions' or 'append'")
    if mode == "partitions" and not partition_by:
        raise ValueError("write_pipe_csv: mode 'partitions' needs partition_by")
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    if mode == "append":
        _writer(out, partition_by).mode("append").csv(path)
        return
    folder = _Folder(df.sparkSession, path)
    staged = f"{STAGED}{mode}-{uuid.uuid4().hex}"
    try:
        _writer(out, partition_by).csv(f"{path}/{staged}")
        folder.commit(staged, len(partition_by))
    except BaseException:
        folder.remove(staged)
        raise
    folder.publish(staged)


def finish_output(spark: SparkSession, path: str) -> int:
    """Publish what a lost driver left staged under ``path``, remove what its jobs did not finish; how many were published.

    Not while another session writes to ``path``.
    """
    folder, published = _Folder(spark, path), 0
    for name in sorted(n for n in folder.names() if n.startswith(STAGED)):
        if LIST in folder.names(name):
            folder.publish(name)
            published += 1
        else:
            folder.remove(name)
    return published


def read_pipe_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.options(**PIPE_OPTIONS).schema(schema).csv(path)


def _writer(df: DataFrame, partition_by: Sequence[str]):
    w = df.write.options(**PIPE_OPTIONS)
    return w.partitionBy(*partition_by) if partition_by else w


class _Folder:
    """The output folder on its Hadoop file system; names are relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.top = self.hadoop.Path(path)
        self.fs = self.top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.hadoop.Path(self.top, name) if name else self.top

    def names(self, name: str = "") -> list[str]:
        at = self.path(name)
        return [x.getPath().getName() for x in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def commit(self, staged: str, depth: int) -> None:
        """List a finished job's partitions (or files); from here on the job counts as done."""
        names = [""]
        for _ in range(max(1, depth)):
            names = [f"{k}/{n}".lstrip("/") for k in names for n in self.names(f"{staged}/{k}" if k else staged) if n[0] not in "._"]
        out = self.fs.create(self.path(f"{staged}/{LIST}.new"))
        out.write(bytearray("\n".join(names).encode()))
        out.close()
        self._move(f"{staged}/{LIST}.new", f"{staged}/{LIST}")

    def publish(self, staged: str) -> None:
        """Move a committed job's partitions into place. Every step can be repeated: what is
        no longer staged has been moved, so a second run goes on where the first stopped."""
        jvm_io = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        stream = self.fs.open(self.path(f"{staged}/{LIST}"))
        names = [n for n in jvm_io.toString(stream, "UTF-8").split("\n") if n]
        stream.close()
        for name in names:
            if self.fs.exists(self.path(f"{staged}/{name}")):
                self._move(f"{staged}/{name}", name)
        if staged.startswith(f"{STAGED}overwrite-"):
            self._prune("", set(names), {n[:i] for n in names for i, c in enumerate(n) if c == "/"})
        self.remove(staged)

    def _prune(self, at: str, keep: set[str], above: set[str]) -> None:
        for n in self.names(at):
            name = f"{at}/{n}".lstrip("/")
            if name in above:
                self._prune(name, keep, above)
            elif name not in keep and not n.startswith(STAGED):
                self.remove(name)

    def _move(self, source: str, target: str) -> None:
        self.remove(target)
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"could not move {source} to {target} in {self.top}")
