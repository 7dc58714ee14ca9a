"""The driver may import the entry module from any working directory; the
Python workers must still import the package (it is shipped with addPyFile)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(REPO, "__spark_entry__.py")!r})
ent = importlib.util.module_from_spec(spec); spec.loader.exec_module(ent)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
print("ENTRY", ent.entry(spark).count())
print("HTML", ent.queries()["page_list_items"](spark, "/root/testdata/sf0.001").count())
print("XLSX", ent.queries()["xlsx_roundtrip"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_entry_and_python_readers_from_another_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    cwd = tempfile.mkdtemp(prefix="skein-cwd-")
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    lines = {ln.split()[0]: int(ln.split()[1]) for ln in out.stdout.splitlines()
             if ln.split() and ln.split()[0] in ("ENTRY", "HTML", "XLSX")}
    assert set(lines) == {"ENTRY", "HTML", "XLSX"}, out.stderr[-2000:]
    assert lines["HTML"] > 0 and lines["XLSX"] == 200
