from skein.functions.labels import (
    blank_nbsp,
    entry_value,
    file_year,
    kv_entries,
    month_label,
    month_sequence,
    option_key,
    parse_year_month,
    py_strip,
    week_label,
    week_sequence,
)

__all__ = ["blank_nbsp", "entry_value", "file_year", "kv_entries", "month_label", "month_sequence", "option_key",
           "parse_year_month", "py_strip", "week_label", "week_sequence"]
