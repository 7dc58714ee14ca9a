from skein.sources.delimited import read_pipe_csv, write_pipe_csv
from skein.sources.files import parent_dir, start_year
from skein.sources.html import parse_elements, parse_inputs, parse_tables
from skein.sources.xlsx import list_files, read_xlsx, write_xlsx

__all__ = ["list_files", "parent_dir", "parse_elements", "parse_inputs", "parse_tables", "read_pipe_csv",
           "read_xlsx", "start_year", "write_pipe_csv", "write_xlsx"]
