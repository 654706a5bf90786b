"""The jobs as commands: ``python -m sales_engine.jobs <job> --help``.

Land, stream, compact, clean, snapshot, build, report. Paths are URIs any
Hadoop file system understands. Store keys and database passwords are read from
the environment (``OBJECT_STORE_KEY``, ``OBJECT_STORE_SECRET``, ``JDBC_PASSWORD``).
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession

from sales_engine import schemas
from sales_engine.operators.conform import to_sales, to_stores, union_channels
from sales_engine.plans import reports
from sales_engine.plans.clean_jobs import clean_sales, clean_stores
from sales_engine.plans.pipeline import build_tables, read_sales, read_stores
from sales_engine.session import build_session, checkpointed, delete, object_store_conf, scratch_dir, sized_for
from sales_engine.sources.batches import compact_new
from sales_engine.sources.files import compact, land_csv, read_delimited, read_json, stored_bytes, write_delimited
from sales_engine.sources.jdbc import connection, load_jdbc, read_jdbc, snapshot_table, write_jdbc, write_snapshot
from sales_engine.streaming.sales_stream import (
    decode, land_range, read_range, read_stream, run_until, start_landing, topic_options, topic_range_options,
)

CHANNELS = {"csv": schemas.CSV_SPEC, "stream": schemas.STREAM_SPEC, "db": schemas.DB_SPEC}

SALES_ONLY = {"top_product_sales": reports.top_product_sales}
WITH_STORES = {
    f.__name__: f
    for f in (
        reports.top_store, reports.revenue_by_location, reports.top_location, reports.revenue_by_continent,
        reports.sales_by_day, reports.sales_by_week, reports.sales_by_month, reports.sales_by_season,
        reports.revenue_by_demographic, reports.product_preference, reports.top_product_per_demographic,
    )
}


def raw_channel(spark: SparkSession, channel: str, path: str) -> DataFrame:
    """Dirty rows of a channel: JSON lines for the stream, otherwise delimited files whose header names the columns."""
    return read_json(spark, path, schemas.STREAM_SALES) if channel == "stream" else read_delimited(spark, path)


def cleaned_channel(spark: SparkSession, channel: str, path: str) -> DataFrame:
    """Cleaned delimited files of a channel, conformed."""
    return to_sales(read_delimited(spark, path), schemas.sales_mapping(CHANNELS[channel]))


def run_report(name: str, sales: DataFrame, stores: DataFrame | None, date: str | None = None) -> DataFrame:
    if name == "units_on_date":
        return reports.units_on_date(sales, date)
    if name in SALES_ONLY:
        return SALES_ONLY[name](sales)
    return WITH_STORES[name](sales, stores)


def _jdbc(args: argparse.Namespace) -> dict[str, str]:
    return connection(args.url, args.driver, args.user, os.environ.get("JDBC_PASSWORD"))


def _land_csv(spark: SparkSession, args: argparse.Namespace) -> None:
    land_csv(spark, args.src, args.dst)


def _land_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    options = topic_options(args.servers, args.topic, args.starting, args.max_offsets, args.min_partitions)
    messages = read_stream(spark, "kafka", options)
    run_until(start_landing(decode(messages), args.dst, args.checkpoint, args.interval))


def _land_range(spark: SparkSession, args: argparse.Namespace) -> None:
    start, end = ({int(p): n for p, n in json.loads(text).items()} for text in (args.start, args.end))
    options = topic_range_options(args.servers, start, end, args.topic, args.min_partitions)
    land_range(read_range(spark, "kafka", options), args.dst, args.name)


def _compact_new(spark: SparkSession, args: argparse.Namespace) -> None:
    compact_new(spark, args.src, args.dst, schemas.STREAM_SALES, args.file_mb << 20)


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    compact(
        spark, args.src, args.dst, schemas.STREAM_SALES, args.file_mb << 20, args.files, drop=("run", "batch_id")
    )


def _clean(spark: SparkSession, args: argparse.Namespace) -> None:
    staging = scratch_dir(spark, "staging")
    try:
        with sized_for(spark, stored_bytes(spark, args.src)):
            raw = raw_channel(spark, args.channel, args.src)
            cleaned = clean_sales(raw, CHANNELS[args.channel], args.quartiles, staging=staging)
            if args.url:
                # the few connections of the load must not narrow the cleaning itself
                if args.once:
                    load_jdbc(checkpointed(cleaned), _jdbc(args), args.table, replace=args.mode == "overwrite")
                else:
                    write_jdbc(checkpointed(cleaned), _jdbc(args), args.table, args.mode)
            else:
                write_delimited(cleaned, args.dst)
    finally:
        delete(spark, staging)


def _clean_stores(spark: SparkSession, args: argparse.Namespace) -> None:
    write_delimited(clean_stores(read_delimited(spark, args.src)), args.dst)


def _snapshot(spark: SparkSession, args: argparse.Namespace) -> None:
    snapshot_table(spark, _jdbc(args), args.table, args.dst, args.partition_column, args.partitions)


def _snapshot_stores(spark: SparkSession, args: argparse.Namespace) -> None:
    stores = read_jdbc(
        spark, _jdbc(args), args.table, args.partition_column, args.partitions, by_quantiles=args.by_quantiles
    ).withColumnRenamed("store_id", "store_code")
    if args.versions:
        write_snapshot(stores, args.dst, args.versions)
    else:
        write_delimited(stores, args.dst)


def _build(spark: SparkSession, args: argparse.Namespace) -> None:
    size = sum(stored_bytes(spark, path) for path in (args.csv, args.stream, args.db) if path)
    channels = [
        (raw_channel(spark, name, path), CHANNELS[name])
        for name, path in (("csv", args.csv), ("stream", args.stream), ("db", args.db))
        if path
    ]
    stores = read_delimited(spark, args.stores)
    with sized_for(spark, size):
        build_tables(args.dst, channels, stores, args.quartiles)


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    size = sum(stored_bytes(spark, p) for p in (args.tables, args.csv, args.stream, args.db) if p)
    with sized_for(spark, size):
        _show_report(spark, args)


def _show_report(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.tables:
        sales, stores = read_sales(spark, args.tables), read_stores(spark, args.tables)
    else:
        paths = (("csv", args.csv), ("stream", args.stream), ("db", args.db))
        sales = union_channels(*[cleaned_channel(spark, name, path) for name, path in paths if path])
        stores = to_stores(read_delimited(spark, args.stores)) if args.stores else None
    result = run_report(args.name, sales, stores, args.date)
    if args.dst:
        write_delimited(result, args.dst)
    else:
        result.show(args.rows, truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sales_engine.jobs")
    top.add_argument("--master")
    top.add_argument("--endpoint", help="S3-compatible endpoint")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def database(sub: argparse.ArgumentParser, required: bool) -> None:
        sub.add_argument("--url", required=required)
        sub.add_argument("--table", required=required)
        sub.add_argument("--driver")
        sub.add_argument("--user")

    job("land-csv", _land_csv, "src", "dst")
    stream = job("land-stream", _land_stream, "servers", "dst", "checkpoint")
    stream.add_argument("--topic", default="sales_stream")
    stream.add_argument("--starting", default="latest")
    stream.add_argument("--interval", default="5 seconds")
    stream.add_argument("--max-offsets", type=int)
    stream.add_argument("--min-partitions", type=int)
    repair = job("land-range", _land_range, "servers", "dst", "name", "start", "end")
    repair.add_argument("--topic", default="sales_stream")
    repair.add_argument("--min-partitions", type=int)
    added = job("compact-new", _compact_new, "src", "dst")
    added.add_argument("--file-mb", type=int, default=256)
    small = job("compact", _compact, "src", "dst")
    small.add_argument("--file-mb", type=int, default=256)
    small.add_argument("--files", type=int)
    clean = job("clean", _clean, "src")
    clean.add_argument("channel", choices=sorted(CHANNELS))
    clean.add_argument("--dst")
    clean.add_argument("--mode", default="errorifexists")
    clean.add_argument("--quartiles", default="exact", choices=["exact", "approx"])
    clean.add_argument("--once", action="store_true", help="stage the rows and move each once into an existing table")
    database(clean, required=False)
    job("clean-stores", _clean_stores, "src", "dst")
    for name, run in (("snapshot", _snapshot), ("snapshot-stores", _snapshot_stores)):
        export = job(name, run, "dst")
        database(export, required=True)
        export.add_argument("--partition-column")
        export.add_argument("--partitions", type=int, default=16)
        if name == "snapshot-stores":
            export.add_argument("--by-quantiles", action="store_true")
            export.add_argument("--versions", type=int, default=0, help="keep so many snapshots and point readers to the last")
    build = job("build", _build, "stores", "dst")
    build.add_argument("--quartiles", default="exact", choices=["exact", "approx"])
    report = job("report", _report)
    report.add_argument("name", choices=sorted(["units_on_date", *SALES_ONLY, *WITH_STORES]))
    report.add_argument("--tables", help="folder written by the build job")
    report.add_argument("--stores")
    report.add_argument("--date")
    report.add_argument("--dst")
    report.add_argument("--rows", type=int, default=20)
    for sub in (build, report):
        for channel in CHANNELS:
            sub.add_argument(f"--{channel}")
    return top


def parsed(argv: list[str] | None = None) -> argparse.Namespace:
    """The arguments; ones that would leave a job without a date, an input or a target end it before it starts."""
    top = parser()
    args = top.parse_args(argv)
    if args.job == "report" and args.name == "units_on_date" and not args.date:
        top.error("units_on_date needs --date")
    if args.job == "report" and args.name in WITH_STORES and not (args.tables or args.stores):
        top.error(f"{args.name} needs --tables, or channels and --stores")
    if args.job in ("build", "report") and not (getattr(args, "tables", None) or args.csv or args.stream or args.db):
        top.error(f"{args.job} needs at least one input")
    if args.job == "clean" and not (args.dst or (args.url and args.table)):
        top.error("clean needs --dst, or --url and --table")
    return args


def main(argv: list[str] | None = None) -> None:
    args = parsed(argv)
    conf = {}
    if args.endpoint:
        keys = os.environ.get("OBJECT_STORE_KEY"), os.environ.get("OBJECT_STORE_SECRET")
        conf = object_store_conf(args.endpoint, *keys)
    spark = build_session(f"sales_engine {args.job}", args.master, conf)
    args.run(spark, args)


if __name__ == "__main__":
    main()
