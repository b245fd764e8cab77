"""Command-line driver: ``spark-submit -m tapline.cli`` or ``python -m tapline``.

Maps the familiar export options onto :func:`tapline.export`. This is the driver program of a
Spark application; the rows are read, transformed and written by the cluster.

    python -m tapline --tables /data/tpch --sql "SELECT * FROM orders" --format csv --output out/orders
    python -m tapline --url jdbc:postgresql://db/app --user app --password-env DB_PASS \\
        --sql-file report.sql --format parquet --output s3a://bucket/report --transform mask:email
"""

from __future__ import annotations

import argparse
import os
import sys

from .errors import FormatError, OutputError, SchemaError, SourceError, TaplineError, TransformError

# Process exit codes, equal to the reference's.
EXIT_OK = 0
EXIT_INVALID_ARGUMENTS = 1
EXIT_SQL_INPUT = 2
EXIT_DATABASE = 3
EXIT_OUTPUT_WRITE = 4
EXIT_SCHEMA = 5
EXIT_UNSUPPORTED_FORMAT = 6
EXIT_TRANSFORM = 7
EXIT_UNEXPECTED = 99


def build_parser() -> argparse.ArgumentParser:
    """The command-line options."""
    p = argparse.ArgumentParser(prog="tapline", description="Export a query result to a file, as a Spark job.")
    src = p.add_argument_group("source")
    src.add_argument("--sql", help="query text (exactly one of --sql and --sql-file)")
    src.add_argument("--sql-file", help="file holding the query text")
    src.add_argument("--tables", help="folder of <name>.parquet files to register as views")
    src.add_argument("--table", action="append", default=[], metavar="NAME=PATH",
                     help="register one Parquet file or folder as a view (repeatable)")
    src.add_argument("--url", help="JDBC URL (the query then runs in that database)")
    src.add_argument("--user")
    src.add_argument("--password")
    src.add_argument("--password-env", help="environment variable holding the password")
    src.add_argument("--fetch-size", type=int, default=1000)
    src.add_argument("--partition-column", help="JDBC: read in parallel ranges of this numeric/date column")
    src.add_argument("--num-partitions", type=int, help="JDBC: number of parallel range reads")
    src.add_argument("--equi-depth", action="store_true",
                     help="JDBC: partitions of like size from the column's own distribution, for keys of any type")
    src.add_argument("--spread-by", help="JDBC: numeric expression that splits a hot key's rows")
    src.add_argument("--max-rows", type=int)
    out = p.add_argument_group("output")
    out.add_argument("--format", help="json, ndjson, csv, tsv or parquet")
    out.add_argument("--output")
    out.add_argument("--metadata", help="path of the manifest sidecar")
    out.add_argument("--overwrite", action="store_true")
    out.add_argument("--pretty", action="store_true")
    out.add_argument("--include-header", action=argparse.BooleanOptionalAction, default=True)
    out.add_argument("--null-value", default="")
    out.add_argument("--escape-formulas", action="store_true")
    out.add_argument("--bom", action="store_true")
    out.add_argument("--parquet-compression", default="SNAPPY")
    out.add_argument("--single-file", action="store_true", help="one file in the order of the rows")
    out.add_argument("--keep-versions", type=int, metavar="N",
                     help="publish a new version below --output and keep the newest N")
    out.add_argument("--checked-parts", action="store_true", help="list rows, bytes and CRC-32 of each part in the manifest")
    out.add_argument("--direct-write", action="store_true",
                     help="write straight to --output (object stores) instead of staging and renaming")
    tr = p.add_argument_group("transforms")
    tr.add_argument("--transform", action="append", default=[], help="inline step, e.g. rename:a=b")
    tr.add_argument("--transforms-file")
    tr.add_argument("--on-transform-error", choices=["fail", "skipRow", "keepOriginal"])
    run = p.add_argument_group("run")
    run.add_argument("--dry-run", action="store_true", help="validate without reading or writing")
    run.add_argument("--describe", action="store_true", help="print the output columns instead")
    run.add_argument("--master", help="Spark master (default: from spark-submit)")
    run.add_argument("--verbose", action="store_true", help="print extra progress information")
    return p


def main(argv: list[str] | None = None) -> int:
    """Run one export (or describe) and return the process exit code."""
    parser = build_parser()
    try:
        args = parser.parse_args(argv)
    except SystemExit as exc:
        return EXIT_INVALID_ARGUMENTS if exc.code else EXIT_OK
    if not args.describe and (not args.format or not args.output):
        print("--format and --output are required unless --describe is given.", file=sys.stderr)
        return EXIT_INVALID_ARGUMENTS
    if (args.sql is None) == (args.sql_file is None):
        print("ERROR: give exactly one of --sql and --sql-file.", file=sys.stderr)
        return EXIT_SQL_INPUT
    password = args.password
    if args.password_env:
        password = os.environ.get(args.password_env)
        if password is None:
            print(f"Environment variable {args.password_env} is not set.", file=sys.stderr)
            return EXIT_INVALID_ARGUMENTS

    from . import describe, export
    from .plans.config import load_config, load_config_file
    from .session import build_session
    from .sources import register_paths, register_tables

    try:
        if args.transforms_file:
            config = load_config_file(args.transforms_file, args.transform, args.on_transform_error)
        else:
            config = load_config(None, args.transform, args.on_transform_error)
        spark = build_session(args.master)
        if args.tables:
            register_tables(spark, args.tables)
        if args.table:
            pairs = [t.split("=", 1) for t in args.table]
            if any(len(p) != 2 or not p[0].strip() for p in pairs):
                print("--table expects NAME=PATH.", file=sys.stderr)
                return EXIT_INVALID_ARGUMENTS
            register_paths(spark, {k.strip(): v for k, v in pairs})
        jdbc = None
        if args.url:
            jdbc = {"url": args.url, "user": args.user, "password": password, "fetch_size": args.fetch_size}
            if args.partition_column:
                jdbc.update(partition_column=args.partition_column, num_partitions=args.num_partitions or 8,
                            equi_depth=args.equi_depth, spread_by=args.spread_by)
        if args.describe:
            # Fixed layout, as the reference prints it (the type column holds Spark types here).
            print("Columns:")
            for col in describe(spark, sql=args.sql, sql_file=args.sql_file, jdbc=jdbc,
                                transforms=config).collect():
                print(f"  {col['index']}. {col['label']:<20} type {col['type']:<15} "
                      f"nullable={str(col['nullable']).lower():<5} output={col['output_name']}")
            return EXIT_OK
        result = export(spark, sql=args.sql, sql_file=args.sql_file, jdbc=jdbc, transforms=config,
                        fmt=args.format, output=args.output, max_rows=args.max_rows, overwrite=args.overwrite,
                        header=args.include_header, null_value=args.null_value,
                        escape_formulas=args.escape_formulas, bom=args.bom, pretty=args.pretty,
                        compression=args.parquet_compression, metadata_path=args.metadata,
                        single_file=args.single_file, dry_run=args.dry_run, staged=not args.direct_write,
                        versions=args.keep_versions, checked_parts=args.checked_parts)
        # Fixed messages, as the reference prints them.
        if result.dry_run:
            print("Dry run complete. All options are valid.")
            return EXIT_OK
        if args.verbose:
            print(f"Exported {result.row_count} rows in {result.duration_ms} ms")
        print(f"Export complete: {result.row_count} rows -> {result.output}")
        if result.metrics:
            print(result.summary())
        return EXIT_OK
    except TransformError as exc:
        print(f"ERROR: {exc}", file=sys.stderr)
        return EXIT_TRANSFORM
    except SchemaError as exc:
        print(f"ERROR: {exc}", file=sys.stderr)
        return EXIT_SCHEMA
    except SourceError as exc:
        print(f"ERROR: {exc}", file=sys.stderr)
        return EXIT_DATABASE if args.url else EXIT_SQL_INPUT
    except FormatError as exc:
        print(f"ERROR: {exc}", file=sys.stderr)
        return EXIT_UNSUPPORTED_FORMAT
    except OutputError as exc:
        print(f"ERROR: {exc}", file=sys.stderr)
        return EXIT_OUTPUT_WRITE
    except TaplineError as exc:
        print(f"ERROR: {exc}", file=sys.stderr)
        return EXIT_INVALID_ARGUMENTS
    except Exception as exc:  # noqa: BLE001 - the last resort keeps row values out of the message
        print(f"UNEXPECTED ERROR: {type(exc).__name__}", file=sys.stderr)
        return EXIT_UNEXPECTED


if __name__ == "__main__":
    sys.exit(main())
