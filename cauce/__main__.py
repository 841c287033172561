"""Command line: ``spark-submit`` or ``python -m cauce <stage> --out <folder> ...``."""

import argparse
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cauce.operators.enrichment import BROADCAST_BYTES, ROWS_PER_TASK
from cauce.plans import run_all, run_clean, run_enrich, run_ingest
from cauce.schemas import RAW, SAMPLE_ROWS
from cauce.sources import (
    count_records,
    read_clean,
    read_dimensions,
    read_landing,
    read_page_files,
    read_pages,
)
from cauce.sources.paged import PAGE_LIMIT

DIMENSIONS = ("population", "category", "region", "gdp", "employment")


def parse(arguments=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cauce", description=__doc__)
    stages = parser.add_subparsers(dest="stage", required=True)
    for stage in ("ingest", "clean", "enrich", "all"):
        command = stages.add_parser(stage)
        command.add_argument("--out", required=True, help="folder of tables, samples and reports")
        command.add_argument(
            "--versioned", action="store_true", help="keep the old table until the new one is complete"
        )
        if stage in ("ingest", "all"):
            source = command.add_mutually_exclusive_group(required=True)
            source.add_argument("--url", help="endpoint of paged JSON records")
            source.add_argument("--path", help="folder of page files")
            command.add_argument("--order", default="fecha_hecho,:id", help="order of the pages; ends in a unique column")
            command.add_argument("--key", help="a unique field; pages are then asked for by it and not by position")
            command.add_argument("--limit", type=int, default=PAGE_LIMIT, help="records per request")
            command.add_argument(
                "--sample-fields", nargs="*", default=[], help="further fields of the raw sample"
            )
        if stage in ("clean", "all"):
            command.add_argument("--zoned", action="store_true", help="honour offsets in times")
            command.add_argument(
                "--blank-as-null", action="store_true", help="impute blank texts like absent ones"
            )
        if stage in ("enrich", "all"):
            for name in DIMENSIONS:
                command.add_argument(f"--{name}", required=True, help=f"path of the {name} file")
            command.add_argument(
                "--split", action="store_true", help="read JSON and XML files in parts"
            )
            command.add_argument(
                "--spans", action="store_true", help="HTML cells may span rows or columns"
            )
            command.add_argument(
                "--broadcast-bytes", type=int, default=BROADCAST_BYTES, help="most bytes of a dimension to broadcast"
            )
            command.add_argument(
                "--rows-per-task", type=int, default=ROWS_PER_TASK, help="facts of a key that one task joins"
            )
            command.add_argument(
                "--key-bytes", type=int, default=0, help="most bytes of keys to broadcast, so that unmatched facts stay"
            )
            command.add_argument(
                "--unique-keys", action="store_true", help="fail on repeated dimension keys"
            )
    return parser.parse_args(arguments)


def _pages(spark, args, schema, first=None):
    if args.path:
        return read_page_files(spark, args.path, schema, first)
    options = {"url": args.url, "order": args.order, "limit": str(args.limit)}
    if args.key:
        options["key"] = args.key
    if first is not None:
        options["first"] = str(first)
    return read_pages(spark, schema, **options)


def _records(spark, args):
    extra = [StructField(name, StringType()) for name in args.sample_fields]
    first = _pages(spark, args, StructType([*RAW.fields, *extra]), SAMPLE_ROWS)
    return _pages(spark, args, RAW), first


def _counted(args):
    """The server's own count, asked for before its pages are read."""
    return count_records(url=args.url, order=args.order) if args.url else None


def main(arguments=None) -> None:
    args = parse(arguments)
    spark = SparkSession.builder.appName(f"cauce-{args.stage}").getOrCreate()
    run_time = F.lit(datetime.now().replace(microsecond=0).isoformat()).cast("timestamp_ntz")
    dims = None
    if args.stage in ("enrich", "all"):
        paths = {name: getattr(args, name) for name in DIMENSIONS}
        dims = read_dimensions(spark, **paths, split=args.split, spans=args.spans)
        bounds = {
            "broadcast_bytes": args.broadcast_bytes,
            "rows_per_task": args.rows_per_task,
            "versioned": args.versioned,
            "key_bytes": args.key_bytes,
        }
    if args.stage == "ingest":
        raw, first = _records(spark, args)
        run_ingest(raw, args.out, run_time, args.url or args.path, first, counted=_counted(args), versioned=args.versioned)
    elif args.stage == "clean":
        path = f"{args.out}/landing"
        landing = read_landing(spark, path)
        run_clean(
            landing, args.out, run_time, path, args.zoned, args.blank_as_null, versioned=args.versioned
        )
    elif args.stage == "enrich":
        clean = read_clean(spark, f"{args.out}/clean")
        run_enrich(clean, dims, args.out, run_time, unique_keys=args.unique_keys, **bounds)
    else:
        raw, first = _records(spark, args)
        options = (args.zoned, args.blank_as_null, args.unique_keys)
        label, counted = args.url or args.path, _counted(args)
        run_all(raw, dims, args.out, run_time, label, first, *options, counted=counted, **bounds)


if __name__ == "__main__":
    main()
