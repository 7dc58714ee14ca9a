"""Row filters: placeholders, truncation at a first match, skipped rows,
report parameters.

Per-table scalars (first match, first row) come from a ``groupBy`` with a
map-side partial aggregate joined back on the table keys, never from a window
partitioned by the table: a table holding a third of all rows then stays
spread over many tasks (AQE splits the skewed join partition).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.labels import option_key


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


# ---- FLT1 ------------------------------------------------------------------------------------

def drop_placeholder(df: DataFrame, col: str, placeholder: str = "-") -> DataFrame:
    """Drop rows whose value is the placeholder; NULL values stay (``!=`` would drop them)."""
    return df.filter(~_c(col).eqNullSafe(F.lit(placeholder)))


# ---- FLT2 ------------------------------------------------------------------------------------

def truncate_after_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], predicate: Column,
                         on_missing: str = "all") -> DataFrame:
    """Per table (``keys``), keep rows up to and including the first row (by
    ``order``) where ``predicate`` holds.

    ``on_missing``: table without a match keeps all rows (``all``), none
    (``none``) or fails the job (``error``, the reference behaviour).
    """
    if on_missing not in ("all", "none", "error"):
        raise ValueError("on_missing must be all, none or error")
    pos = F.struct(*[_c(o) for o in order])
    cut = (df.filter(predicate).groupBy(*keys).agg(F.min(pos).alias("_cut")))
    how = "inner" if on_missing == "none" else "left"
    cut = cut.select(*[_c(k).alias(f"_cut_{k}") for k in keys], "_cut")
    same = F.lit(True)
    for k in keys:  # a NULL key is a table of its own
        same = same & df[k].eqNullSafe(cut[f"_cut_{k}"])
    joined = df.join(cut, same, how).drop(*[f"_cut_{k}" for k in keys])
    cond = pos <= F.col("_cut")
    if on_missing == "all":
        cond = F.col("_cut").isNull() | cond
    elif on_missing == "error":
        cond = F.when(F.col("_cut").isNull(), F.raise_error(F.lit("truncate_after_first: no matching row"))
                      .cast("boolean")).otherwise(cond)
    return joined.filter(cond).drop("_cut")


# ---- FLT3 / FLT4 -----------------------------------------------------------------------------

def skip_rows(rows: DataFrame, n: int, row_col: str = "row_no") -> DataFrame:
    """Discard the first ``n`` rows of every table (positions are data)."""
    return rows.filter(F.col(row_col) >= n)


# ---- FLT9 / FLT10 ----------------------------------------------------------------------------

def iso_week_monday(year: int, week: int) -> _dt.date:
    return _dt.date.fromisocalendar(year, week, 1)


def iso_week_range(start: tuple[int, int], end: tuple[int, int]) -> tuple[_dt.date, _dt.date]:
    """Half-open date range ``[monday(start), monday(end) + 7)`` of an ISO
    (year, week) range; week 53 of a 52-week year is clamped to the last week."""
    def clamp(y, w):
        last = _dt.date(y, 12, 28).isocalendar()[1]
        return y, max(1, min(w, last))

    lo = iso_week_monday(*clamp(*start))
    hi = iso_week_monday(*clamp(*end)) + _dt.timedelta(days=7)
    return lo, hi


def report_filter(df: DataFrame, date_col: str | None = None, start: tuple[int, int] | None = None,
                  end: tuple[int, int] | None = None, options: Mapping[str, str] | None = None,
                  year_col: str | None = None, week_col: str | None = None) -> DataFrame:
    """Report parameters as a filter.

    Period: ISO (year, week) from ``start`` to ``end`` inclusive; either may be
    missing, which leaves that side open. With a date
    column the bounds become a plain date range, which reaches the parquet scan
    as pushed filters; with (year, week) columns it compares ``year*100+week``.
    Options: column equals value ignoring case and outer white space.
    """
    out = df
    if (start is not None or end is not None) and date_col is None and (year_col is None or week_col is None):
        raise ValueError("report_filter: give date_col or year_col and week_col")
    for week, is_start in ((start, True), (end, False)):
        if week is None:
            continue
        if date_col is not None:
            first, beyond = iso_week_range(week, week)
            c, kind = _c(date_col), df.schema[date_col].dataType.simpleString()
            out = out.filter(c >= F.lit(first).cast(kind) if is_start else c < F.lit(beyond).cast(kind))
        else:
            number = _c(year_col) * 100 + _c(week_col)
            bound = week[0] * 100 + week[1]
            out = out.filter(number >= bound if is_start else number <= bound)
    for col, value in (options or {}).items():
        out = out.filter(option_key(_c(col)) == option_key(F.lit(value)))
    return out


def match_option(options: Sequence[str], wanted: str) -> str | None:
    """FLT10 on a list of offered options: first match ignoring case and outer
    white space; None (silent) when nothing matches."""
    key = wanted.strip().lower()
    for o in options:
        if o.strip().lower() == key:
            return o
    return None
