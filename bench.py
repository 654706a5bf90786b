"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` choose the
data and the cores. Each query runs to the last row into a sink that discards
it. Inputs of the reports (the cleaned tables) are built once, timed as
``build_tables``.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import catalog, views
from sales_engine.functions.numbers import to_number
from sales_engine.operators.cleaning import cast_types, dedupe, flag_processed, impute, require
from sales_engine.operators.profile import mode_of
from sales_engine.operators.quartiles import quartiles
from sales_engine.plans.clean_jobs import clean_sales
from sales_engine.schemas import CSV_SPEC, STREAM_SPEC, CleanSpec
from sales_engine.session import build_session, scratch_dir

REPORTS = [
    "top_store", "units_on_date", "top_product_sales", "revenue_by_location", "top_location",
    "revenue_by_continent", "sales_by_day", "sales_by_week", "sales_by_month", "sales_by_season",
    "revenue_by_demographic", "product_preference", "top_product_per_demographic", "enrich_sales",
]
STEPS = [
    "mode_date", "profile_means", "dedupe_rows", "quartiles", "quartiles_approx", "clean_stores",
    "land_csv_roundtrip", "compact_json", "stream_land_sales",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def scalar_by_scalar(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """The cleaning job with every scalar fetched to the driver by its own action: the shape to beat."""
    mode = mode_of(df, spec.date, spec.sentinels).first()[0]
    quantity = df.agg(F.avg(to_number(F.col(spec.quantity)))).first()[0]
    revenue = df.agg(F.avg(to_number(F.col(spec.revenue)))).first()[0]
    values = df.sparkSession.createDataFrame(
        [(mode, int(quantity), revenue)], "mode_date string, mean_quantity int, mean_revenue double"
    )
    kept = require(flag_processed(df, spec), [spec.store, spec.product], spec.sentinels)
    rows = dedupe(impute(kept, values, spec))
    for column in (spec.quantity, spec.revenue):
        value = to_number(F.col(column))
        q1, q3 = quartiles(rows, value, "approx").first()
        rows = rows.where(value.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    return cast_types(rows, spec)


def processor() -> str:
    with open("/proc/cpuinfo") as lines:
        return next((line.split(":", 1)[1].strip() for line in lines if line.startswith("model name")), "unknown")


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark: SparkSession = build_session(
        "bench", f"local[{cpus}]", {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    csv, stream = views.sales_csv(spark, sf_dir), views.sales_stream(spark, sf_dir)

    def staged(df: DataFrame, spec: CleanSpec, method: str = "exact") -> DataFrame:
        return clean_sales(df, spec, method, staging=scratch_dir(spark, "bench"))

    warm_up = timed(lambda: drain(staged(csv, CSV_SPEC)))  # start-up and compilation are not the queries'
    times = {
        "clean_sales_csv": timed(lambda: drain(staged(csv, CSV_SPEC))),
        "clean_sales_stream": timed(lambda: drain(staged(stream, STREAM_SPEC))),
        "build_tables": timed(lambda: catalog.QUERIES["union_channels"](spark, sf_dir)),
    }
    for name in STEPS + REPORTS:
        times[name] = timed(lambda: drain(catalog.QUERIES[name](spark, sf_dir)))
    others = {
        "first_run": warm_up,
        "clean_sales_csv_approx": timed(lambda: drain(staged(csv, CSV_SPEC, "approx"))),
        "clean_sales_csv_lazy": timed(lambda: drain(clean_sales(csv, CSV_SPEC))),
        "clean_sales_csv_lazy_approx": timed(lambda: drain(clean_sales(csv, CSV_SPEC, "approx"))),
        "scalar_by_scalar": timed(lambda: drain(scalar_by_scalar(csv, CSV_SPEC))),
    }
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "machine": {"cpus": int(cpus), "cores": os.cpu_count(), "processor": processor()},
                "yardstick_ratio": round(times["clean_sales_csv"] / others["scalar_by_scalar"], 3),
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "other_ways_to_clean_csv": others,
            }
        )
    )


if __name__ == "__main__":
    main()
