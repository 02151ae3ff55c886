"""Command line: ``python -m gleaner tables|query ...`` over a warehouse.

  python -m gleaner tables --root WAREHOUSE [--remote ROOT] [--flat ns=DIR]
  python -m gleaner query  --root WAREHOUSE "SELECT ..." | --file q.sql [--limit N]
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="gleaner")
    ap.add_argument("command", choices=["tables", "query"])
    ap.add_argument("sql", nargs="?")
    ap.add_argument("--root")
    ap.add_argument("--remote")
    ap.add_argument("--flat", action="append", default=[], help="namespace=folder of <table>.parquet files")
    ap.add_argument("--file")
    ap.add_argument("--limit", type=int, default=None, help="row cap for reads (default 500)")
    ap.add_argument("--master", default=None)
    args = ap.parse_intermixed_args(argv)

    from gleaner.catalog import Warehouse
    from gleaner.session import get_session

    spark = get_session(args.master)
    flat = dict(f.split("=", 1) for f in args.flat)
    wh = Warehouse(spark, root=args.root, remote_root=args.remote, flat=flat)
    if args.command == "tables":
        wh.list_tables().select("full_name", "row_count", "layer", "location").show(1000, truncate=False)
        return 0
    sql = open(args.file).read() if args.file else args.sql
    if not sql:
        ap.error("query needs SQL text or --file")
    res = wh.query(sql, cap=args.limit)
    if isinstance(res, dict):
        print(res)
    else:
        res.show(args.limit or 500, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
