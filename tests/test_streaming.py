"""Streams: each arriving file is converted exactly once; stream = batch."""

import os
import tempfile

from skein.operators.panel import JP, unpivot_panel_rows
from skein.sources.xlsx import build_workbook, read_xlsx
from skein.streaming import start_sink, stream_workbooks


def _write(folder, name, rows):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(build_workbook([("S", rows)]))


def test_arriving_workbooks_are_converted_once(spark):
    root = tempfile.mkdtemp(prefix="skein-stream-")
    src, out, ckpt = f"{root}/JP", f"{root}/out", f"{root}/ckpt"
    os.makedirs(src)
    _write(src, "a.xlsx", [["p", "2019/1-", "2019/2-"], ["A", 1.0, 2.0]])
    _write(src, "b.xlsx", [["p", "2020/1-"], ["B", 3.0]])

    def run():
        rows = stream_workbooks(spark, src, header_row=0)
        long = unpivot_panel_rows(rows, JP, id_labels=["p"]).drop("row_no")
        start_sink(long, out, ckpt).awaitTermination()
        return sorted((r["p"], r["YearMonth"]) for r in spark.read.parquet(out).collect())

    assert run() == [("A", "2019/01"), ("A", "2019/02"), ("B", "2020/01")]
    assert run() == [("A", "2019/01"), ("A", "2019/02"), ("B", "2020/01")]  # nothing twice
    _write(src, "c.xlsx", [["p", "2021/12-"], ["C", 4.0]])
    got = run()
    assert got == [("A", "2019/01"), ("A", "2019/02"), ("B", "2020/01"), ("C", "2021/12")]
    batch = read_xlsx(spark, src, header_row=0)
    want = sorted((r["p"], r["YearMonth"]) for r in unpivot_panel_rows(batch, JP, id_labels=["p"]).collect())
    assert got == want  # stream = batch
