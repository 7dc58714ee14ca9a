"""Panel layouts as data: a ``PanelSpec`` says how a provider's table is read
and melted; ``unpivot_panel`` runs it. A new provider needs a spec, not code.

Kinds:
* ``paired``        two parallel column groups (units and values) per week label
* ``month_labels``  one group, label rewritten from the header
* ``week_sequence`` one group, labels = first header date + 7 days by position
* ``region_block``  ragged rows with a repeated header block; the n-th block is
                    melted, its dates run +1 month per row from the first cell

The first three take a wide DataFrame (one schema, header rules run on the
driver over ``df.columns``); ``region_block`` takes the ragged-row relation
(``keys..., row_no, cells``) because its header repeats names.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import labels as L
from skein.operators.filters import drop_placeholder
from skein.operators.headers import contains_rule, group_columns
from skein.operators.rows import attach_header, split_header, table_context
from skein.operators.unpivot import pair_groups, unpivot_paired, unpivot_wide


@dataclass(frozen=True)
class PanelSpec:
    name: str
    kind: str
    label_col: str
    value_col: str = "Value"
    # paired
    first_token: str = ""
    second_token: str = ""
    first_col: str = "Unit"
    pair_by: str = "label"
    # month_labels / week_sequence
    date_token: str = ""
    placeholder: str | None = None
    # region_block
    sheet: str | None = None
    header_row: int = 0
    date_pos: int = 1
    occurrence: int = 1
    value_names: tuple[str, ...] = ()
    cutoff: str | None = None
    on_missing: str = "error"
    country: str = ""
    country_col: str = "Country"
    date_col: str = "Date"
    value_type: str | None = None
    sort: bool = False

    def replace(self, **kw) -> PanelSpec:
        return dataclasses.replace(self, **kw)


# The four provider layouts and their parameters.
MX = PanelSpec("MX", "paired", label_col="WeekOfYear", value_col="Value",
               first_token="Un ", second_token="Lc ", first_col="Unit")
JP = PanelSpec("JP", "month_labels", label_col="YearMonth", value_col="Value", date_token="/")
JP2 = PanelSpec("JP2", "week_sequence", label_col="Date", value_col="Value", date_token=".", placeholder="-")
CN = PanelSpec("CN", "region_block", label_col="Visit_Purpose", value_col="Visitors", sheet="Asia",
               header_row=4, date_pos=1, occurrence=3,
               value_names=("Tourist", "Business", "Others", "Short Excursion"),
               cutoff="202201", on_missing="error", country="China", country_col="Country",
               date_col="Date", sort=True)

SPECS = {"MX": MX, "JP": JP, "JP2": JP2, "CN": CN}


def spec_for(country: str) -> PanelSpec:
    try:
        return SPECS[country]
    except KeyError:
        raise ValueError(f"no panel spec for {country!r}; known: {sorted(SPECS)}") from None


def unpivot_panel(data: DataFrame, spec: PanelSpec, source: str | Column | None = None,
                  keys: Sequence[str] = ("source",), labels: Sequence[str] | None = None) -> DataFrame:
    """Run a layout. ``source`` (file name, or a column holding it) feeds rules
    that read the name (the start year of ``week_sequence``).

    ``labels`` keeps only those output labels (weeks, months). A filter on the
    generated label would stay above the Expand and still read every value
    column; here the label rule runs on the column names first, so only the
    kept columns reach the plan and the scan (``ReadSchema`` shrinks)."""
    keep = set(labels) if labels is not None else None
    if spec.kind == "paired":
        return _paired(data, spec, keep)
    if spec.kind == "month_labels":
        return _month_labels(data, spec, keep)
    if spec.kind == "week_sequence":
        return _week_sequence(data, spec, source, keep)
    if spec.kind == "region_block":
        return _region_block(data, spec, list(keys))
    raise ValueError(f"unknown panel kind {spec.kind}")


def _check_names(ids, *names):
    clash = set(ids) & set(names)
    if clash:
        raise ValueError(f"output names {sorted(clash)} equal id columns")


def _paired(df: DataFrame, spec: PanelSpec, keep: set | None = None) -> DataFrame:
    g = group_columns(df.columns, [("first", contains_rule(spec.first_token)),
                                   ("second", contains_rule(spec.second_token))])
    if not g["first"] and not g["second"]:
        raise ValueError(f"{spec.name}: no value columns")
    ids = g["other"]
    _check_names(ids, spec.label_col, spec.first_col, spec.value_col)
    names = L.named(df.sparkSession, [*g["first"], *g["second"]], L.week_label)
    pairs = pair_groups(g["first"], g["second"], names.__getitem__, by=spec.pair_by)
    groups = [(label, {spec.first_col: a, spec.value_col: b}) for label, a, b in pairs
              if keep is None or label in keep]
    if not groups:
        raise ValueError(f"{spec.name}: no value columns left for the requested labels")
    return unpivot_paired(df, ids, groups, spec.label_col)


def _month_labels(df: DataFrame, spec: PanelSpec, keep: set | None = None) -> DataFrame:
    g = group_columns(df.columns, [("dates", contains_rule(spec.date_token))])
    if not g["dates"]:
        raise ValueError(f"{spec.name}: no date columns")
    ids = g["other"]
    _check_names(ids, spec.label_col, spec.value_col)
    labels = {c: label for c, label in L.named(df.sparkSession, g["dates"], L.month_label).items() if keep is None or label in keep}
    if not labels:
        raise ValueError(f"{spec.name}: no value columns left for the requested labels")
    return unpivot_wide(df, ids, list(labels), spec.label_col, spec.value_col, labels=labels)


def _week_sequence(df: DataFrame, spec: PanelSpec, source, keep: set | None = None) -> DataFrame:
    g = group_columns(df.columns, [("dates", contains_rule(spec.date_token))])
    dates = g["dates"]
    if not dates:
        raise ValueError(f"{spec.name}: no date columns")
    if source is None:
        raise ValueError(f"{spec.name}: the start year comes from the file name; pass source=")
    ids = g["other"]
    _check_names(ids, spec.label_col, spec.value_col)
    # Labels by position among the date columns (later headers are not read);
    # id columns may sit anywhere, so positions never shift onto them.
    if isinstance(source, str):
        year = L.file_year(F.lit(source))
        seq = L.named(df.sparkSession, dates, lambda _, i: L.week_sequence(year, F.lit(dates[0]), i))
        labels = {c: d for c, d in seq.items() if keep is None or d in keep}
    else:
        if keep is not None:
            raise ValueError(f"{spec.name}: labels= needs the file name as a string (labels depend on it)")
        year = L.file_year(source)
        labels = {c: L.week_sequence(year, F.lit(dates[0]), i) for i, c in enumerate(dates)}
    if not labels:
        raise ValueError(f"{spec.name}: no value columns left for the requested labels")
    long = unpivot_wide(df, ids, list(labels), spec.label_col, spec.value_col, labels=labels)
    if spec.placeholder is not None:
        long = drop_placeholder(long, spec.value_col, spec.placeholder)
    return long


def _region_block(rows: DataFrame, spec: PanelSpec, keys: list[str]) -> DataFrame:
    # Per-table context (header, first / last body row): attached by the reader
    # when it parsed the file, else one partial aggregate + join (skew-safe).
    j = table_context(rows, keys, spec.header_row)
    j = j.select("*", F.col("first_row_no").alias("_r0"), F.col("last_row_no").alias("_r1"),
                 L.parse_year_month(F.get(F.col("first_cells"), spec.date_pos)).alias("_m0"))
    if spec.cutoff is not None:
        cut = F.to_date(F.lit(spec.cutoff), "yyyyMM")
        j = j.withColumn("_kcut", F.months_between(cut, F.col("_m0")).cast("int"))
    k = F.col("row_no") - F.col("_r0")
    if spec.cutoff is not None:
        present = (F.col("_kcut") >= 0) & (F.col("_kcut") <= F.col("_r1") - F.col("_r0"))
        missing = {"all": F.lit(True), "none": F.lit(False),
                   "error": F.raise_error(F.concat(F.lit(f"{spec.name}: cut-off {spec.cutoff} not found in "),
                                                   F.concat_ws("/", *[F.col(x).cast("string") for x in keys])))
                   .cast("boolean")}[spec.on_missing]
        j = j.filter(F.when(present, k <= F.col("_kcut")).otherwise(missing))
    # Column of the n-th occurrence of each value name: O(width) per row, NULL when absent.
    pairs = F.transform("hdr", lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def position(name):
        return F.try_element_at(F.filter(pairs, lambda p: p["h"] == F.lit(name)), F.lit(spec.occurrence))["i"]

    entries = []
    for n in spec.value_names:
        v = F.get(F.col("cells"), position(n))
        if spec.value_type:
            v = v.try_cast(spec.value_type)
        entries.append(F.struct(F.lit(n).alias(spec.label_col), v.alias(spec.value_col)))
    out = j.select(*keys, F.lit(spec.country).alias(spec.country_col),
                   L.month_sequence(F.col("_m0"), k).alias(spec.date_col),
                   F.inline(F.array(*entries)))
    if spec.sort:
        # Range-partitioned global sort: a table holding most rows still spreads over tasks.
        out = out.orderBy(*keys, spec.date_col, spec.label_col)
    return out


# ---- the same layouts over ragged rows: many files with different headers in one job -------

def unpivot_panel_rows(rows: DataFrame, spec: PanelSpec, keys: Sequence[str] = ("source",),
                       id_labels: Sequence[str] | None = None, header_row: int = 0,
                       value_types: dict | None = None) -> DataFrame:
    """Run a ``paired`` / ``month_labels`` / ``week_sequence`` layout over the
    ragged-row relation (``keys..., row_no, cells``), each table with its own
    header. Header rules are array expressions, evaluated once per header (per
    run of rows when the reader nests them, ``read_xlsx(nested=True)``; else on
    the header rows, joined to their body rows on ``keys``); a body row only
    looks its cells up by number, in one Generate.

    Id columns without a label are named ``Unnamed: <column>`` and the n-th
    repeat of an id label ``<label>.<n>``, so no column is lost.

    Output: ``keys..., row_no, <id_labels>..., label, value(s)``. Without
    ``id_labels`` the non-value cells come as ``ids ARRAY<STRUCT<label, value>>``.
    """
    if spec.kind == "region_block":
        return _region_block(flat_rows(rows), spec, list(keys))
    keys = list(keys)
    value_types = value_types or {}
    outs = [(spec.value_col, "a")]
    if spec.kind == "paired":
        outs = [(spec.first_col, "a"), (spec.value_col, "b")]
    if id_labels is not None:
        _check_names(id_labels, spec.label_col, *[o for o, _ in outs])

    if "body" in rows.columns:
        heads = _header_columns(rows.select(*keys, "hdr", "body"), spec, keys, id_labels, ["body"])
        j = heads.select(*[c for c in heads.columns if c != "body"], F.inline("body"))
    elif "hdr" in rows.columns:
        body = rows.filter(F.col("row_no") > header_row).select(*keys, "hdr", "row_no", "cells")
        j = _header_columns(body, spec, keys, id_labels, ["row_no", "cells"])
    else:
        header, body = split_header(rows, keys, header_row)
        j = attach_header(body, _header_columns(header, spec, keys, id_labels), keys)

    def val(e, field, name):
        v = F.get(F.col("cells"), e[field])
        return (v.try_cast(value_types[name]) if name in value_types else v).alias(name)

    if id_labels is not None:
        id_cols = [F.get(F.col("cells"), F.get("_ids", k)).alias(x) for k, x in enumerate(id_labels)]
    else:
        id_cols = [F.transform("_ids", lambda p: F.struct(p["label"], F.get(F.col("cells"), p["i"]).alias("value")))
                   .alias("ids")]
    melted = F.transform("_ent", lambda e: F.struct(e["label"].alias(spec.label_col),
                                                    *[val(e, f, n) for n, f in outs]))
    out = j.select(*keys, "row_no", *id_cols, F.inline(melted))
    if spec.placeholder is not None:
        out = drop_placeholder(out, spec.value_col, spec.placeholder)
    return out


def flat_rows(rows: DataFrame) -> DataFrame:
    """One row per body row of a relation whose rows the reader nested."""
    return rows.select(*[c for c in rows.columns if c != "body"], F.inline("body")) if "body" in rows.columns else rows


def id_entries(spec: PanelSpec, hdr: Column) -> Column:
    """ARRAY<STRUCT<label, i>> of the id columns of a header: every cell that is
    not a value label, unlabelled and repeated ones under names of their own."""
    cells = F.transform(hdr, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    others = F.filter(cells, lambda p: ~is_value_label(spec, p["h"]))

    def label(p):
        repeat = F.size(F.filter(others, lambda q: (q["h"] == p["h"]) & (q["i"] < p["i"])))
        return (F.when(F.coalesce(p["h"], F.lit("")) == "", F.concat(F.lit("Unnamed: "), p["i"].cast("string")))
                .when(repeat > 0, F.concat(p["h"], F.lit("."), repeat.cast("string"))).otherwise(p["h"]))

    return F.transform(others, lambda p: F.struct(label(p).alias("label"), p["i"].alias("i")))


def _header_columns(heads: DataFrame, spec: PanelSpec, keys: list[str], id_labels: Sequence[str] | None,
                    keep: Sequence[str] = ()) -> DataFrame:
    """``keys..., keep..., _ent, _ids`` from the header ``hdr``: ``_ent`` lists the
    output labels with the number of their value column(s), ``_ids`` the id
    columns (their numbers in the order of ``id_labels``, or label and number)."""
    cells = F.transform("hdr", lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def has(tok):
        return lambda p: F.coalesce(p["h"].contains(tok), F.lit(False))

    ids = id_entries(spec, F.col("hdr"))
    base = heads.select(*keys, *keep, "hdr", ids.alias("_all_ids"))
    if spec.kind == "paired":
        second = lambda p: ~has(spec.first_token)(p) & has(spec.second_token)(p)
        groups = [F.transform(F.filter(cells, pred), lambda p: F.struct(L.week_label(p["h"]).alias("label"),
                                                                        F.lit(side).alias("side"), p["i"].alias("i")))
                  for side, pred in enumerate((has(spec.first_token), second))]
        if spec.pair_by == "position":
            base = base.withColumns({"_f": groups[0], "_s": groups[1]})
            entries = F.transform(F.slice("_f", F.lit(1), F.least(F.size("_f"), F.size("_s"))),
                                  lambda f, k: F.struct(f["label"].alias("label"), f["i"].alias("a"),
                                                        F.get("_s", k)["i"].alias("b")))
        else:
            # Sorted by label, so the columns of a label are one run; the n-th first column goes
            # beside the n-th second column of its run. Each step is its own column: a lambda
            # would compute an inlined array again for every element.
            base = base.withColumn("_s", F.array_sort(F.concat(*groups)))
            starts = F.filter(F.transform("_s", lambda x, k: F.when(
                (k == 0) | ~F.get("_s", k - 1)["label"].eqNullSafe(x["label"]), k)), lambda k: k.isNotNull())
            base = base.withColumn("_g", starts)

            def run(start, k):
                part = F.slice("_s", start + 1, F.coalesce(F.get("_g", k + 1), F.size("_s")) - start)
                sides = [F.transform(F.filter(part, lambda x: x["side"] == side), lambda x: x["i"])  # noqa: B023
                         for side in (0, 1)]
                return F.transform(F.arrays_zip(sides[0].alias("a"), sides[1].alias("b")), lambda z: F.struct(
                    F.get("_s", start)["label"].alias("label"), z["a"].alias("a"), z["b"].alias("b")))

            entries = F.flatten(F.transform("_g", run))
    elif spec.kind in ("month_labels", "week_sequence"):
        base = base.withColumn("_d", F.filter(cells, has(spec.date_token)))
        if spec.kind == "month_labels":
            entries = F.transform("_d", lambda d: F.struct(L.month_label(d["h"]).alias("label"), d["i"].alias("a")))
        else:
            if len(keys) != 1:
                raise ValueError(f"{spec.name}: the file name key must be the single table key")
            year, first = L.file_year(F.col(keys[0])), F.get("_d", 0)["h"]
            entries = F.transform("_d", lambda d, k: F.struct(L.week_sequence(year, first, k).alias("label"),
                                                              d["i"].alias("a")))
    else:
        raise ValueError(f"unknown panel kind {spec.kind}")
    id_cols = F.col("_all_ids")
    if id_labels is not None:
        id_cols = F.array(*[F.get(F.filter("_all_ids", lambda p: p["label"] == x), 0)["i"] for x in id_labels]) \
            if id_labels else F.array().cast("array<int>")
    return base.select(*keys, *keep, entries.alias("_ent"), id_cols.alias("_ids"))


def panel_reject_reason(spec: PanelSpec, keys: Sequence[str] = ("source",)) -> Column:
    """Why a file cannot go through ``spec`` (NULL when it can), from the file
    context the reader attaches to each row (``hdr``, ``first_cells``,
    ``first_row_no``, ``last_row_no``): row-local, no join. Reasons:
    ``no_value_columns``, ``no_start_date`` (week sequence), ``bad_first_date``
    and ``cutoff_missing`` (region block)."""
    hdr = F.col("hdr")

    def has(tok):
        return lambda h: F.coalesce(h.contains(tok), F.lit(False))

    if spec.kind == "paired":
        ok = F.exists(hdr, lambda h: has(spec.first_token)(h) | has(spec.second_token)(h))
    elif spec.kind in ("month_labels", "week_sequence"):
        ok = F.exists(hdr, has(spec.date_token))
    else:
        names = F.array(*[F.lit(n) for n in spec.value_names])
        occ = F.transform(hdr, lambda h, i: F.size(F.filter(F.slice(hdr, F.lit(1), i + 1), lambda x: x == h)))
        ok = F.exists(F.arrays_zip(hdr.alias("h"), occ.alias("o")),
                      lambda z: F.array_contains(names, z["h"]) & (z["o"] == spec.occurrence))
    reason = F.when(~ok, F.lit("no_value_columns"))
    if spec.kind == "week_sequence":
        first = F.get(F.filter(hdr, has(spec.date_token)), 0)
        reason = reason.when(L.week_start(L.file_year(F.col(keys[0])), first).isNull(), F.lit("no_start_date"))
    if spec.kind == "region_block":
        m0 = L.parse_year_month(F.get(F.col("first_cells"), spec.date_pos))
        reason = reason.when(m0.isNull(), F.lit("bad_first_date"))
        if spec.cutoff is not None:
            kcut = F.months_between(F.to_date(F.lit(spec.cutoff), "yyyyMM"), m0)
            present = (kcut >= 0) & (kcut <= F.col("last_row_no") - F.col("first_row_no"))
            reason = reason.when(~present, F.lit("cutoff_missing"))
    return reason


def is_value_label(spec: PanelSpec, h: Column) -> Column:
    """Whether a header cell is a value column of ``spec`` (the others are ids)."""
    def has(tok):
        return F.coalesce(h.contains(tok), F.lit(False))

    if spec.kind == "paired":
        return has(spec.first_token) | has(spec.second_token)
    if spec.kind in ("month_labels", "week_sequence"):
        return has(spec.date_token)
    return F.array_contains(F.array(*[F.lit(n) for n in spec.value_names]), h)
