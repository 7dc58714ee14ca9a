"""Command line: convert a provider workbook or folder.

    python -m skein convert PATH/<COUNTRY>/file.xlsx [--out DIR]
    python -m skein convert PATH/<COUNTRY>/ [--out DIR]
"""

from __future__ import annotations

import argparse

from skein.operators.convert import convert_path
from skein.session import get_spark


def main(argv=None):
    ap = argparse.ArgumentParser(prog="skein")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("convert", help="workbook(s) of one provider folder to pipe CSV")
    c.add_argument("path", help="a workbook, or a folder ending in / (its name is the country code)")
    c.add_argument("--out", default=None, help="output folder (default: <folder>/pivoted)")
    c.add_argument("--rejects", default=None, help="folder for the list of files that do not fit (folders only)")
    c.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = get_spark(args.master)
    try:
        convert_path(spark, args.path, args.out, rejects_dir=args.rejects)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
