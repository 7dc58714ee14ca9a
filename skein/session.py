"""Session settings and shared scratch locations.

Everything here is plain session configuration. The library never relies on
these settings for correctness: queries must give the same rows under a
default session (the correctness driver builds its own).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale:
# * AQE re-plans joins from runtime sizes (broadcast only when the measured side
#   is under the threshold) and splits skewed join partitions.
# * Wide panels carry more than 100 columns; raising codegen.maxFields keeps
#   whole-stage codegen and the vectorised parquet scan on for them.
# * Page-sized HTML rows: small Arrow batches keep Python worker memory flat.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.maxFields": "200",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "skein", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests) a
    private folder is created and registered as the checkpoint dir. On a
    cluster an unset folder is an error: executors could not see a private one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="skein-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub folder of the shared folder for one write."""
    base = shared_dir(spark)
    path = f"{base}/skein/{name}/{uuid.uuid4().hex}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make the ``skein`` package importable in the Python workers (executors
    import it to run the Arrow functions of the workbook and HTML readers).

    Zips the package once per application and registers it with
    ``addPyFile``, which copies it to every executor; a no-op afterwards.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        _zip_and_add(spark, sc)
        _SHIPPED.add(app)


def _zip_and_add(spark: SparkSession, sc) -> None:
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    base = shared_dir(spark)
    local = base.replace("file:", "", 1) if base.startswith("file:") or "://" not in base else None
    folder = scratch_path(spark, "pyfiles").replace("file:", "", 1) if local else tempfile.mkdtemp(prefix="skein-")
    target = os.path.join(folder, "skein.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
