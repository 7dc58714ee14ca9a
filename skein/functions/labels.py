"""Column functions for header labels, dates read from labels and text cells.

All are built from Spark SQL functions (JVM side, codegen). A rule exists once,
as a Column function over header cells; names of a schema are labelled by
``evaluate``, which runs the same function on a one-row local relation.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: characters removed from a "year + month name" cell before parsing it.
MONTH_CELL_NOISE = (" ", "\u3000", "\uff0e")
NBSP = "\u00a0"


def _c(x) -> Column:
    """PySpark convention: a str names a column; other Python values are literals."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


@dataclass(frozen=True)
class LabelRule:
    """How a label is made from a header cell or a file name.

    ``clean`` characters are removed first. A text that ``pattern`` matches
    becomes its ``parts`` (numbers are groups of the pattern, the rest stands
    for itself); any other text becomes NULL, or stays as it is with
    ``keep_others``.
    """

    pattern: str
    parts: tuple[int | str, ...]
    clean: str = ""
    keep_others: bool = False

    def __call__(self, text) -> Column:
        x = F.translate(_c(text), self.clean, "") if self.clean else _c(text)
        made = F.concat(*[F.regexp_extract(x, self.pattern, p) if isinstance(p, int) else F.lit(p) for p in self.parts])
        return F.when(x.rlike(self.pattern), made).otherwise(x if self.keep_others else F.lit(None).cast("string"))


# Fixed values that must equal the layouts' rules for right results.
#: "Un SEM - WW/YYYY" -> "YYYY_WW": the week is characters 9 and 10, the year starts at 12 (0-based)
week_label = LabelRule(r"(?s)^.{9}(.{2}).(.+)$", (2, "_", 1))
#: "YYYY/M-" -> "YYYY/0M"; "YYYY/MM-" -> "YYYY/MM"
month_label = LabelRule(r"(?s)^(.{5})(.)$", (1, "0", 2), clean="-", keep_others=True)
#: first four digits of the fifth ``_`` token of a file name
file_year = LabelRule(r"(?s)^(?:.*/)?(?:[^_/]*_){4}([0-9]{4})[^/]*$", (1,))
#: "M.d-" -> "M-d"
month_day = LabelRule(r"^([0-9]{1,2})\.([0-9]{1,2})$", (1, "-", 2), clean="-")


def evaluate(spark: SparkSession, names: Sequence[str], rule: Callable[..., Column]) -> list[str | None]:
    """Labels of a schema's column names by ``rule`` (name, or name and position, to Column).

    The relation is local, so the optimizer works the labels out and no job runs.
    """
    if not names:
        return []
    texts = F.array(*[F.lit(str(n)) for n in names])
    return list(spark.sql("VALUES (0)").select(F.transform(texts, rule).alias("labels")).first()["labels"])


def named(spark: SparkSession, names: Sequence[str], rule: Callable[..., Column]) -> dict[str, str]:
    """``evaluate`` by name; a name without a label is an error that says which."""
    labels = dict(zip(names, evaluate(spark, names, rule), strict=True))
    if bad := [n for n, label in labels.items() if label is None]:
        raise ValueError(f"column names that do not fit their layout: {bad}")
    return labels


# ---- week sequence: "M.d-" header + year from the file name, +7 days by position ----------

def week_start(year, first_header) -> Column:
    return F.try_to_date(F.concat(_c(year), F.lit("-"), month_day(first_header)), "y-M-d")


def week_sequence(year, first_header, ordinal) -> Column:
    """Label of the ``ordinal``-th (0-based) date column: first date + 7 * ordinal days."""
    return F.date_format(F.date_add(week_start(year, first_header), _c(ordinal) * 7), "yyyy-MM-dd")


# ---- month sequence: first cell "2021．Dec" + 1 month per row --------------------------------

def clean_month_cell(text) -> Column:
    x = _c(text)
    for ch in MONTH_CELL_NOISE:
        x = F.replace(x, F.lit(ch), F.lit(""))
    return x


def parse_year_month(text) -> Column:
    """``%Y%b`` after removing blanks, U+3000 and U+FF0E; NULL when it does not parse."""
    return F.try_to_date(clean_month_cell(text), "yyyyMMM")


def month_sequence(first_month, offset) -> Column:
    return F.date_format(F.add_months(first_month, _c(offset)), "yyyyMM")


# ---- text cells ------------------------------------------------------------------------------

def py_strip(x) -> Column:
    """Python ``str.strip()``: Unicode white space (tabs, NBSP, U+3000 ...) at both ends."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def option_key(x) -> Column:
    """Key for matching a report option: lower case, outer blanks removed."""
    return F.lower(py_strip(x))


def blank_nbsp(x, as_null: bool = False) -> Column:
    """A cell that is exactly NBSP becomes '' (or NULL); anything else is kept."""
    c = _c(x)
    return F.when(c == F.lit(NBSP), F.lit(None).cast("string") if as_null else F.lit("")).otherwise(c)


def kv_entries(text, line_sep: str = "\n", kv_sep: str = ": ") -> Column:
    """``Key: value`` lines of a text column to ARRAY<STRUCT<key, value>>; blank lines skipped.

    The value is everything after the first separator. A line without the
    separator gives a NULL value (the reference raises there).
    """
    src = F.col(text) if isinstance(text, str) else text
    lines = F.filter(F.split(src, _regex_quote(line_sep)), lambda ln: ln != F.lit(""))

    def entry(ln):
        pos = F.locate(kv_sep, ln)
        return F.struct(
            F.when(pos > 0, F.substring(ln, F.lit(1), pos - 1)).otherwise(ln).alias("key"),
            F.when(pos > 0, F.substr(ln, pos + len(kv_sep))).alias("value"),
        )

    return F.transform(lines, entry)


def entry_value(entries, key: str) -> Column:
    """Value of ``key`` in an entries array; the last occurrence wins (dict semantics)."""
    arr = F.col(entries) if isinstance(entries, str) else entries
    hits = F.filter(arr, lambda e: e["key"] == F.lit(key))
    return F.try_element_at(hits, F.lit(-1))["value"]


def _regex_quote(s: str) -> str:
    return re.escape(s)
