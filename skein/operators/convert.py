"""Convert a provider folder: every workbook directly in it, the layout
chosen by the folder name (the country code), one Spark job for all files,
pipe-CSV output partitioned by source file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators.panel import PanelSpec, id_entries, panel_reject_reason, spec_for, unpivot_panel_rows
from skein.session import shared_dir
from skein.sources.delimited import write_pipe_csv
from skein.sources.xlsx import read_xlsx

# Fixed value: files whose name holds this text are outputs of an earlier run.
CONVERTED_MARK = "pivoted"


def convert_folder(spark: SparkSession, folder: str, out_dir: str | None = None, spec: PanelSpec | None = None,
                   id_labels: Sequence[str] | None = None, value_types: dict | None = None,
                   exclude: str | None = CONVERTED_MARK, rejects_dir: str | None = None) -> DataFrame:
    """Long table of every workbook in ``folder`` (not recursive; names holding
    ``exclude`` skipped). Columns: ``file``, ids, label, value(s). With
    ``out_dir`` the result is also written as pipe CSV, one folder per file;
    what ``out_dir`` holds of other files stays.

    With ``rejects_dir`` a file that cannot be read or does not fit the layout
    (see ``panel_reject_reason``) is listed there as ``file|reason`` and left
    out, while the other files go on; without it such a file fails the job."""
    spec = spec or spec_for(folder.rstrip("/").split("/")[-1])
    header_row = spec.header_row if spec.kind == "region_block" else 0
    if id_labels is None and spec.kind != "region_block":
        id_labels = discover_id_labels(spark, folder, spec, exclude)
    on_error = "reject" if rejects_dir is not None else "fail"
    rows = read_xlsx(spark, folder, sheet=spec.sheet, exclude=exclude, header_row=header_row, on_error=on_error,
                     nested=True)
    if rejects_dir is not None:
        tagged = rows.withColumn("_reason", F.coalesce(F.col("error"), panel_reject_reason(spec, ["source"])))
        # Parsed once: written to the shared checkpoint folder, then read by both the reject list and the output.
        shared_dir(spark)
        tagged = tagged.checkpoint(eager=True)
        rejects = (tagged.filter(F.col("_reason").isNotNull()).select("file_name", "_reason").distinct()
                   .select(F.col("file_name").alias("file"), F.col("_reason").alias("reason")))
        write_pipe_csv(rejects, rejects_dir)
        rows = tagged.filter(F.col("_reason").isNull()).drop("_reason", "error")
    long = unpivot_panel_rows(rows, spec, keys=["source"], id_labels=id_labels, header_row=header_row,
                              value_types=value_types)
    long = long.withColumn("file", F.element_at(F.split(F.col("source"), "/"), -1)).drop("source", "row_no")
    if out_dir is not None:
        write_pipe_csv(long, out_dir, partition_by=["file"], mode="partitions", sort_within=_file_order(spec))
    return long


def discover_id_labels(spark: SparkSession, folder: str, spec: PanelSpec, exclude: str | None = CONVERTED_MARK
                       ) -> list[str]:
    """The id columns of a folder: header cells that are not value columns,
    over all files, unlabelled and repeated ones under names of their own
    (``id_entries``), columns beyond the header's last label included. One pass
    over the files; the result is the vocabulary of id labels (a handful), in
    label order."""
    heads = read_xlsx(spark, folder, sheet=spec.sheet, exclude=exclude, header_row=0, headers_only=True)
    labels = heads.select(F.explode(id_entries(spec, F.col("cells"))["label"]).alias("h")).distinct().orderBy("h")
    return [r["h"] for r in labels.collect()]


def _file_order(spec: PanelSpec) -> list[str]:
    """Row order inside each output file: by date then label for sorted layouts
    (SRT1). Sorting within partitions on the file prefix means the writer adds
    no sort of its own, so the order reaches the file."""
    return ["file", spec.date_col, spec.label_col] if spec.sort else []


def convert_path(spark: SparkSession, path: str, out_dir: str | None = None, spec: PanelSpec | None = None,
                 id_labels: Sequence[str] | None = None, value_types: dict | None = None,
                 rejects_dir: str | None = None) -> DataFrame:
    """One workbook or a whole folder (a path ending in ``/``). The layout comes
    from the folder name (the country code) unless ``spec`` is given. A single
    named file is read even if its name holds the converted mark. Output
    defaults to ``<folder>/pivoted`` (a sub folder, so never read back as input);
    what was converted from other files before stays there.
    ``rejects_dir`` (folders only) lists files that do not fit instead of failing."""
    folder = path.rstrip("/") if path.endswith("/") else path.rsplit("/", 1)[0]
    spec = spec or spec_for(folder.split("/")[-1])
    out_dir = out_dir if out_dir is not None else f"{folder}/pivoted"
    if path.endswith("/"):
        return convert_folder(spark, folder, out_dir, spec, id_labels, value_types, rejects_dir=rejects_dir)
    header_row = spec.header_row if spec.kind == "region_block" else 0
    if id_labels is None and spec.kind != "region_block":
        id_labels = discover_id_labels(spark, path, spec, exclude=None)
    rows = read_xlsx(spark, path, sheet=spec.sheet, header_row=header_row, nested=True)
    long = unpivot_panel_rows(rows, spec, keys=["source"], id_labels=id_labels, header_row=header_row,
                              value_types=value_types)
    long = long.withColumn("file", F.element_at(F.split(F.col("source"), "/"), -1)).drop("source", "row_no")
    write_pipe_csv(long, out_dir, partition_by=["file"], mode="partitions", sort_within=_file_order(spec))
    return long
