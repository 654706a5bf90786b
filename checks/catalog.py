"""Every operator and report as a query over the given tables."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from checks.sql import LOAD_TS
from sales_engine.functions.dates import epoch_ms_to_ts
from sales_engine.functions.geo import continent, parse_lat_lon
from sales_engine.functions.numbers import to_number
from sales_engine.operators.cleaning import cast_types, dedupe, flag_processed, impute, require
from sales_engine.operators.conform import enrich, to_sales
from sales_engine.operators.joins import join_dimension
from sales_engine.operators.profile import mode_by_candidates, mode_of, profile
from sales_engine.operators.quartiles import drop_outliers_iqr, quartiles, quartiles_of_each
from sales_engine.plans import reports
from sales_engine.plans.clean_jobs import clean_sales, clean_stores, cut_outliers, prepare_sales
from sales_engine.plans.pipeline import build_tables, read_sales, read_stores
from sales_engine.schemas import CSV_SALES, CSV_SPEC, DB_SPEC, STREAM_SALES, STREAM_SPEC, CleanSpec, sales_mapping
from sales_engine.session import scratch_dir
from sales_engine.sources.files import compact, land_csv, read_delimited, read_json, write_delimited, write_json
from sales_engine.sources.batches import compact_new, read_compacted
from sales_engine.sources.storage import Storage
from sales_engine.streaming.sales_stream import (
    Landing, ProgressLog, decode, land_range, missing_offsets, read_landed, read_stream, run_until, start_landing,
)

Query = Callable[[SparkSession, str], DataFrame]


# -- shared inputs ---------------------------------------------------------

_built: dict[tuple, str] = {}


def _listing(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, size and time of every input file the report tables are built from."""
    tables = [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders", "events", "customer", "nation", "supplier")]
    return tuple(entry for table in tables for entry in Storage(spark, table).files())


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cleaned sales and stores of a data set, written once per application and state of its files for all reports."""
    key = (spark.sparkContext.applicationId, _listing(spark, sf_dir))
    if key not in _built:
        dst = scratch_dir(spark, "tables")
        channels = [
            (views.sales_csv(spark, sf_dir), CSV_SPEC),
            (views.sales_stream(spark, sf_dir), STREAM_SPEC),
        ]
        stores = views.stores(spark, sf_dir).withColumnRenamed("store_ID", "store_code")
        build_tables(dst, channels, stores, method="exact", load_ts=LOAD_TS)
        _built[key] = dst
    return read_sales(spark, _built[key]), read_stores(spark, _built[key])


def _on_sales(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_tables(spark, sf_dir)[0])


def _on_tables(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(*_tables(spark, sf_dir))


def _on_csv(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(views.sales_csv(spark, sf_dir))


def _on_stream(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(views.sales_stream(spark, sf_dir))


# -- sources and sinks -----------------------------------------------------


def land_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, dst = scratch_dir(spark, "csv-in"), scratch_dir(spark, "csv-landed")
    write_delimited(views.sales_csv(spark, sf_dir), src)
    land_csv(spark, src, dst)
    return read_delimited(spark, dst, CSV_SALES)


def compact_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, dst = scratch_dir(spark, "json-small"), scratch_dir(spark, "json-compacted")
    write_json(views.sales_stream(spark, sf_dir).repartition(16), src)
    compact(spark, src, dst, STREAM_SALES)
    return read_json(spark, dst, STREAM_SALES)


def _land(spark: SparkSession, sf_dir: str) -> str:
    """Send the messages through a file stream in several micro-batches; returns the landing folder."""
    topic, landed = scratch_dir(spark, "topic"), scratch_dir(spark, "landed")
    views.messages(spark, sf_dir).repartition(3).write.text(topic)
    stream = decode(read_stream(spark, "text", {"maxFilesPerTrigger": "1"}, topic))
    run_until(start_landing(stream, landed, scratch_dir(spark, "offsets"), available_now=True))
    return landed


def stream_land_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landed(spark, _land(spark, sf_dir))


def stream_land_compact_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    compacted = scratch_dir(spark, "compacted")
    compact(spark, _land(spark, sf_dir), compacted, STREAM_SALES, drop=("run", "batch_id"))
    return _clean(read_json(spark, compacted, STREAM_SALES), STREAM_SPEC)


def _messages_in(topic: Storage) -> list[str]:
    """The files of a topic that a file stream reads."""
    return [path for path, _, _ in topic.files() if not path.rsplit("/", 1)[-1].startswith(("_", "."))]


def stream_stop_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing on a clock: full batches, one without rows, a stop in the midst that lets its batch end, and the rest.

    Raises where the stop broke a batch off, the empty batch wrote something, or nothing was left for the second run.
    """
    topic, landed, offsets = (scratch_dir(spark, name) for name in ("topic", "landed", "offsets"))
    # row numbers of a file scan are the same in every pass, so no share has to be sorted, and each task writes what it reads
    messages = views.messages(spark, sf_dir).withColumn("at", F.monotonically_increasing_id())
    share, files = F.pmod(F.xxhash64("at"), F.lit(6)), messages.rdd.getNumPartitions()
    storage = Storage(spark, topic)

    def fill(batch: str, there: int) -> None:
        """Files without rows, up to the number that every batch takes."""
        for n in range(len(_messages_in(storage)), there):
            storage.put_new(f"{batch}-{n}.txt", "")

    for n in range(6):
        messages.where(share == n).select("value").write.mode("append").text(topic)
        fill(f"share-{n}", (n + 1 + (n > 1)) * files)
        if n == 1:
            fill("empty", 3 * files)
    stream = decode(read_stream(spark, "text", {"maxFilesPerTrigger": str(files)}, topic))
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        landing = Landing(stream, landed, offsets, "200 milliseconds")
        while (landing.committed() or 0) < 3 and landing.query.isActive:
            time.sleep(0.05)
        last = landing.stop()
        if last is None or landing.failure():
            raise RuntimeError(f"the landing ended by itself after batch {last}: {landing.failure()}")
        written = Storage(spark, landed).folders("run=*/batch_id=*")
        begun = max(int(folder.rsplit("=", 1)[1]) for folder in written)
        if begun > last:
            raise RuntimeError(f"batch {begun} was begun, batch {last} committed")
        until = time.monotonic() + 120
        while last not in log.rows_of_batches(landing.query.id) and time.monotonic() < until:
            time.sleep(0.05)
        rows = [n for batch, n in log.rows_of_batches(landing.query.id).items() if batch <= last]
        if 0 not in rows or len(written) != sum(n > 0 for n in rows):
            raise RuntimeError(f"batches of {rows} rows were committed, {len(written)} written")
        if last > 5:
            raise RuntimeError("no batch was left after the stop")
    finally:
        spark.streams.removeListener(log)
    run_until(start_landing(stream, landed, offsets, available_now=True))
    return read_landed(spark, landed)


def compact_new_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that land between two compactions; the second takes only these, a third none."""
    landed, compacted = _land(spark, sf_dir), scratch_dir(spark, "compacted")
    rows = read_landed(spark, landed)
    first = compact_new(spark, landed, compacted, STREAM_SALES)
    write_json(rows, f"{landed}/run=later/batch_id=0")
    second = compact_new(spark, landed, compacted, STREAM_SALES)
    if second != {"later": [0]} or compact_new(spark, landed, compacted, STREAM_SALES) or not first:
        raise RuntimeError(f"taken first {first}, then {second}")
    return read_compacted(spark, compacted, STREAM_SALES)


def repair_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which a landing lacks two stretches: what is missing is found, read again and landed once."""
    events = F.monotonically_increasing_id()
    positioned = views.messages(spark, sf_dir).withColumn("offset", events).withColumn("partition", F.lit(0))
    stored, landed = scratch_dir(spark, "topic"), scratch_dir(spark, "landed")
    positioned.withColumn("partition", F.shiftright("offset", 33).cast("int")).withColumn(
        "offset", F.col("offset").bitwiseAND((1 << 33) - 1)
    ).write.parquet(stored)
    topic = spark.read.parquet(stored)
    ends = {r["partition"]: r.end for r in topic.groupBy("partition").agg((F.max("offset") + 1).alias("end")).collect()}
    there = topic.where("offset % 1000 < 700 OR offset % 1000 > 710")
    land_range(there, landed, "first")
    for _ in range(2):
        gaps = F.broadcast(missing_offsets(there, dict.fromkeys(ends, 0), ends).withColumnRenamed("partition", "of"))
        again = topic.join(gaps, (topic["partition"] == gaps["of"]) & topic["offset"].between(gaps["first"], gaps["last"]))
        land_range(again.select("value"), landed, "repair")
    return read_landed(spark, landed)


def decode_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole messages, and the same messages cut off before their last character."""
    whole = views.messages(spark, sf_dir)
    cut = whole.select(F.expr("substring(value, 1, length(value) - 1)").alias("value"))
    return decode(whole.unionAll(cut).select(F.col("value").cast("binary").alias("value")))


# -- cleaning --------------------------------------------------------------


def _kept(df: DataFrame) -> DataFrame:
    return require(flag_processed(df, CSV_SPEC), [CSV_SPEC.store, CSV_SPEC.product], CSV_SPEC.sentinels)


def _quartiles(df: DataFrame) -> DataFrame:
    return quartiles_of_each(df, {m: to_number(F.col(getattr(CSV_SPEC, m))) for m in ("quantity", "revenue")})


def _approx_within_error(df: DataFrame) -> DataFrame:
    """Whether each sketch quartile's rank is within the sketch's error, 1 in 10,000 of the rows."""
    rows = []
    for name, column in {"quantity": CSV_SPEC.quantity, "revenue": CSV_SPEC.revenue}.items():
        values = df.select(to_number(F.col(column)).alias("x"))
        both = values.crossJoin(F.broadcast(quartiles(values, F.col("x"), "approx")))
        counts = both.agg(
            F.count("x").alias("n"),
            *[F.count_if(F.col("x") < F.col(q)).alias(f"{q}_below") for q in ("q1", "q3")],
            *[F.count_if(F.col("x") <= F.col(q)).alias(f"{q}_upto") for q in ("q1", "q3")],
        )
        off = F.col("n") / 10_000 + 1
        near = [F.lit(p * 1.0) * F.col("n") for p in (0.25, 0.75)]
        rows.append(
            counts.select(
                F.lit(name).alias("measure"),
                *[(at.between(F.col(f"{q}_below") - off, F.col(f"{q}_upto") + off)).alias(f"{q}_within") for q, at in zip(("q1", "q3"), near, strict=True)],
            )
        )
    return rows[0].unionAll(rows[1])


def _clock_load_time(df: DataFrame) -> DataFrame:
    """How a cleaned channel's load time comes out when the clock gives it: never missing, one value a run, in UTC order."""
    return clean_sales(df, CSV_SPEC, "approx").agg(
        F.count_if(F.col(CSV_SPEC.load_ts).isNull()).alias("missing"),
        F.count_distinct(CSV_SPEC.load_ts).alias("different"),
    )


def _cut_quantity(df: DataFrame) -> DataFrame:
    unique = prepare_sales(df, CSV_SPEC)
    return drop_outliers_iqr(unique, to_number(F.col(CSV_SPEC.quantity)), method="exact")


def _clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Cleaned as the jobs do it: the de-duplicated rows are staged."""
    return clean_sales(df, spec, "exact", LOAD_TS, scratch_dir(df.sparkSession, "staging"))


# -- geography -------------------------------------------------------------


def parse_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    latitude, longitude = parse_lat_lon(F.col("demographics"))
    return views.stores(spark, sf_dir).select(
        "store_ID", latitude.alias("latitude"), longitude.alias("longitude")
    )


def assign_continent(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = continent(*parse_lat_lon(F.col("demographics")))
    return views.stores(spark, sf_dir).select("store_ID", place.alias("continent"))


QUERIES: dict[str, Query] = {
    "land_csv_roundtrip": land_csv_roundtrip,
    "compact_json": compact_json,
    "compact_new_batches": compact_new_batches,
    "decode_json_events": decode_json_events,
    "stream_stop_restart": stream_stop_restart,
    "repair_gap": repair_gap,
    "stream_land_sales": stream_land_sales,
    "stream_land_compact_clean": stream_land_compact_clean,
    "mode_date": _on_csv(lambda df: mode_of(df, CSV_SPEC.date, CSV_SPEC.sentinels)),
    "mode_timestamp": _on_stream(lambda df: mode_by_candidates(df, STREAM_SPEC.date, STREAM_SPEC.sentinels)),
    "mode_store": _on_stream(
        lambda df: mode_by_candidates(df.select(F.col("store_id").cast("string")), "store_id", STREAM_SPEC.sentinels)
    ),
    "profile_means": _on_csv(lambda df: profile(df, CSV_SPEC).select("mean_quantity", "mean_revenue")),
    "profile_stream": _on_stream(lambda df: profile(df, STREAM_SPEC)),
    "flag_processed": _on_csv(lambda df: flag_processed(df, CSV_SPEC)),
    "require_keys": _on_csv(_kept),
    "impute": _on_csv(lambda df: impute(_kept(df), profile(df, CSV_SPEC), CSV_SPEC)),
    "dedupe_rows": _on_csv(dedupe),
    "quartiles": _on_csv(_quartiles),
    "quartiles_approx": _on_csv(_approx_within_error),
    "clock_load_time": _on_csv(_clock_load_time),
    "iqr_quantity": _on_csv(_cut_quantity),
    "iqr_revenue": _on_csv(lambda df: cut_outliers(prepare_sales(df, CSV_SPEC), CSV_SPEC, method="exact")),
    "cast_types": _on_csv(lambda df: cast_types(df, CSV_SPEC)),
    "epoch_ms_to_ts": _on_stream(
        lambda df: df.select(
            F.col("timestamp").alias("epoch_ms"), epoch_ms_to_ts(F.col("timestamp")).alias("event_time")
        )
    ),
    "clean_sales_csv": _on_csv(lambda df: _clean(df, CSV_SPEC)),
    "clean_sales_csv_lazy": _on_csv(lambda df: clean_sales(df, CSV_SPEC, "exact", LOAD_TS)),
    "clean_sales_csv_staged": _on_csv(lambda df: _clean(df, CSV_SPEC)),
    "clean_sales_stream": _on_stream(lambda df: _clean(df, STREAM_SPEC)),
    "clean_sales_db": lambda spark, sf_dir: _clean(views.sales_db(spark, sf_dir), DB_SPEC),
    "clean_stores": lambda spark, sf_dir: clean_stores(views.stores_export(spark, sf_dir), load_ts=LOAD_TS),
    "parse_lat_lon": parse_coordinates,
    "assign_continent": assign_continent,
    "conform_sales": _on_csv(
        lambda df: to_sales(_clean(df, CSV_SPEC), sales_mapping(CSV_SPEC))
    ),
    "union_channels": _on_sales(lambda sales: sales),
    "enrich_sales": _on_tables(enrich),
    "enrich_sales_salted": _on_tables(
        lambda sales, stores: join_dimension(sales, stores, "store_ID", limit=-1)
    ),
    "top_store": _on_tables(reports.top_store),
    "units_on_date": _on_sales(lambda sales: reports.units_on_date(sales, "1998-08-23")),
    "top_product_sales": _on_sales(reports.top_product_sales),
    "revenue_by_location": _on_tables(reports.revenue_by_location),
    "top_location": _on_tables(reports.top_location),
    "revenue_by_continent": _on_tables(reports.revenue_by_continent),
    "sales_by_day": _on_tables(reports.sales_by_day),
    "sales_by_week": _on_tables(reports.sales_by_week),
    "sales_by_month": _on_tables(reports.sales_by_month),
    "sales_by_season": _on_tables(reports.sales_by_season),
    "sales_by_day_preaggregated": _on_tables(
        lambda sales, stores: reports.sales_by_day(sales, stores, limit=-1)
    ),
    "revenue_by_demographic": _on_tables(reports.revenue_by_demographic),
    "product_preference": _on_tables(reports.product_preference),
    "top_product_per_demographic": _on_tables(reports.top_product_per_demographic),
    "top_product_per_demographic_preaggregated": _on_tables(
        lambda sales, stores: reports.top_product_per_demographic(sales, stores, limit=-1)
    ),
}


def pinned(query: Query) -> Query:
    """The query with the session time zone set to UTC, which timestamps are compared in."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir.rstrip("/"))

    return run
