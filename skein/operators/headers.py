"""Header operators: grouping columns by label rules, repeated headers,
two-level headers, row classification.

Header arrays are small (one per table); all functions are higher-order
array expressions evaluated row-locally, never a window over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


# ---- PRJ1-3: split names into groups, first matching rule wins ------------------------------

def group_columns(columns: Sequence[str], rules: Sequence[tuple[str, Callable[[str], bool]]],
                  rest: str = "other") -> dict[str, list[str]]:
    """Driver-side grouping of one schema's column names (order kept)."""
    out: dict[str, list[str]] = {name: [] for name, _ in rules}
    out[rest] = []
    for c in columns:
        for name, pred in rules:
            if pred(c):
                out[name].append(c)
                break
        else:
            out[rest].append(c)
    return out


def contains_rule(token: str) -> Callable[[str], bool]:
    """Substring test (not a prefix test), as the layouts use it."""
    return lambda name: token in str(name)


def header_positions(hdr, pred: Callable[[Column], Column]) -> Column:
    """ARRAY<STRUCT<label, col_no>> of header cells matching ``pred`` (array form of PRJ1-3)."""
    pairs = F.transform(_c(hdr), lambda h, i: F.struct(h.alias("label"), i.alias("col_no")))
    return F.filter(pairs, lambda p: pred(p["label"]))


# ---- PRJ4 / PRJ11 ----------------------------------------------------------------------------

def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once a row; named in a lambda it would be worked out for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(arr: Column, starts: Column, make: Callable[[Column, Column], Column]) -> Column:
    """``arr`` cut at the sorted positions ``starts``, each block made an array by ``make(block, number)``, and joined again."""
    return F.flatten(F.transform(starts, lambda p, k: make(F.slice(arr, p + 1, F.coalesce(F.get(starts, k + 1), F.size(arr)) - p), k)))


def _positions(arr: Column, pred: Callable[[Column, Column], Column]) -> Column:
    """Sorted positions (0-based) of the elements for which ``pred(element, position)`` holds."""
    return F.filter(F.transform(arr, lambda x, i: F.when(pred(x, i), i)), lambda p: p.isNotNull())


def occurrences(hdr) -> Column:
    """ARRAY<STRUCT<label, col_no, occurrence>>: occurrence is 1 for the first
    cell with a label, 2 for its first repeat, ... (exact label equality).

    The cells are sorted by label and numbered inside each label's block, so a
    header of n cells takes n log n steps."""
    by_label = F.array_sort(F.transform(_c(hdr), lambda x, i: F.struct(x.alias("label"), i.alias("col_no"))))

    def numbered(s: Column) -> Column:
        new = _positions(s, lambda x, i: (i == 0) | ~x["label"].eqNullSafe(F.get(s, i - 1)["label"]))
        return _once(new, lambda p: _blocks(s, p, lambda block, _: F.transform(
            block, lambda x, j: F.struct(x["col_no"].alias("col_no"), x["label"].alias("label"), (j + 1).alias("occurrence")))))

    return F.transform(F.array_sort(_once(by_label, numbered)),
                       lambda x: F.struct(x["label"].alias("label"), x["col_no"].alias("col_no"), x["occurrence"].alias("occurrence")))


def pick_occurrence(hdr, n: int) -> Column:
    """Cells that are the ``n``-th occurrence of their label (n=3: the third block)."""
    return F.filter(occurrences(hdr), lambda o: o["occurrence"] == F.lit(n))


def drop_first_empty(arr, empty: str = "") -> Column:
    """Remove only the first cell equal to ``empty`` (``array_remove`` would drop all)."""
    a = _c(arr)
    p = F.array_position(a, F.lit(empty))
    return F.filter(a, lambda x, i: (i + 1) != p)


# ---- PRJ15 / WIN1 ----------------------------------------------------------------------------

# Lower-header cells that open the next upper-header block.
TWO_LEVEL_MARKERS = ("Cases", "Geospread")


def flatten_two_level(upper, lower, markers: Sequence[str] = TWO_LEVEL_MARKERS, sep: str = " ") -> Column:
    """Flatten a two-level header: ``upper[k] + sep + lower[i]`` where ``k`` is the
    number of markers met in ``lower[0..i]`` (a running count). Columns before
    the first marker take ``upper[0]``; more markers than upper cells give NULL.

    Each marker opens a block of ``lower`` with one upper cell, so every cell is
    looked at once."""
    mk = F.array(*[F.lit(m) for m in markers])
    both = F.named_struct(F.lit("up"), _c(upper), F.lit("lo"), _c(lower))

    def flat(h: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), _positions(h["lo"], lambda x, _: F.array_contains(mk, x)))
        return _once(starts, lambda p: _blocks(h["lo"], p, lambda block, k: F.transform(
            block, lambda x: F.concat(F.get(h["up"], k), F.lit(sep), x))))

    return _once(both, flat)


# ---- FLT7 ------------------------------------------------------------------------------------

def classify_row(n_div, n_span, min_div: int = 1) -> Column:
    """'header' when more than one div and no span; 'body' when more than one div
    and a span; NULL (dropped) otherwise."""
    d, s = _c(n_div), _c(n_span)
    return (F.when((d > min_div) & (s == 0), F.lit("header"))
            .when((d > min_div) & (s > 0), F.lit("body")))
