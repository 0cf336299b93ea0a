"""Command line: run the load job.

    python -m cadenza load --csv 'path/to/*.csv' --out <folder> [--export-format csv]
    python -m cadenza load --tables /root/testdata/sf0.01 --out <folder>

``--csv`` reads the source file layout (header, index column first);
``--tables`` derives the raw table from the driver's parquet tables.  The six
tables are written under ``--out`` (parquet), the six answers under
``--out/answers``; the load audit is printed.  ``--publish`` commits tables and
answers as one version under a folder instead.
"""

from __future__ import annotations

import argparse

from cadenza.session import get_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="cadenza")
    sub = ap.add_subparsers(dest="cmd", required=True)
    load = sub.add_parser("load", help="clean, vote genres, build and write the star schema and answers")
    src = load.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="raw CSV file(s) in the source layout")
    src.add_argument("--tables", help="folder with lineitem/part/supplier parquet tables")
    out = load.add_mutually_exclusive_group(required=True)
    out.add_argument("--out", help="output folder (shared storage on a cluster)")
    out.add_argument("--publish", help="folder of versions: all tables and answers are committed together")
    load.add_argument("--export-format", default="csv", choices=["csv", "parquet", "json"])
    load.add_argument("--single-line", action="store_true",
                      help="no quoted CSV field contains a line break: lines need not be put together")
    args = ap.parse_args(argv)

    spark = get_session()
    if args.csv:
        from cadenza.sources.csv import read_tracks_csv
        raw = read_tracks_csv(spark, args.csv, multi_line=not args.single_line)
    else:
        from cadenza.sources.fixture import raw_tracks
        raw = raw_tracks(spark, args.tables)
    from cadenza.plans.load import publish_load, run_load
    job, folder = (publish_load, args.publish) if args.publish else (run_load, args.out)
    for row in job(spark, raw, folder, args.export_format).collect():
        print(f"{row.table_name}: {row.row_count} rows written")


if __name__ == "__main__":
    main()
