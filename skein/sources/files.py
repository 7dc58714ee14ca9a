"""Columns read from file paths (SRC5, SRC6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.labels import file_year


def parent_dir(path_col: str = "source") -> Column:
    """Name of the folder holding the file: the country of a provider file."""
    return F.element_at(F.split(F.col(path_col), "/"), -2)


def start_year(path_col: str = "source") -> Column:
    """First 4 characters of the 5th ``_`` token of the file name (NULL if absent)."""
    return file_year(F.col(path_col))
