"""skein: wide human-made tables to long relations, as Spark jobs.

Main entry points (all lazy DataFrame operations):

* layouts: ``PanelSpec``, ``MX``/``JP``/``JP2``/``CN``, ``unpivot_panel`` (one schema),
  ``unpivot_panel_rows`` (many files, different headers), ``convert_folder`` / ``convert_path``
* melt and friends: ``unpivot_wide``, ``unpivot_paired``, ``pivot_back``, ``concat_by_position``,
  ``concat_by_rank``, ``rank_within``
* sources and sinks: ``read_xlsx``, ``write_xlsx``, ``parse_tables``, ``parse_elements``,
  ``parse_inputs``, ``write_pipe_csv``, ``read_pipe_csv``
"""

from skein.operators.convert import convert_folder, convert_path
from skein.operators.panel import CN, JP, JP2, MX, PanelSpec, spec_for, unpivot_panel, unpivot_panel_rows
from skein.operators.unpivot import (
    concat_by_position,
    concat_by_rank,
    pivot_back,
    rank_within,
    unpivot_paired,
    unpivot_wide,
)
from skein.sources import (
    parse_elements,
    parse_inputs,
    parse_tables,
    read_pipe_csv,
    read_xlsx,
    write_pipe_csv,
    write_xlsx,
)

__version__ = "0.1.0"

__all__ = [
    "CN", "JP", "JP2", "MX", "PanelSpec", "concat_by_position", "concat_by_rank", "convert_folder", "convert_path",
    "parse_elements", "parse_inputs", "parse_tables", "pivot_back", "rank_within", "read_pipe_csv", "read_xlsx",
    "spec_for", "unpivot_paired", "unpivot_panel", "unpivot_panel_rows", "unpivot_wide", "write_pipe_csv",
    "write_xlsx",
]
