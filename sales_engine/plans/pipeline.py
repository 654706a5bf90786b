"""From dirty channels to the two tables the reports read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sales_engine.operators.conform import to_sales, to_stores, union_channels
from sales_engine.plans.clean_jobs import clean_sales, clean_stores
from sales_engine.schemas import CONFORMED_SALES, CONFORMED_STORES, CleanSpec, sales_mapping
from sales_engine.session import delete, scratch_dir


def build_tables(
    dst: str,
    channels: list[tuple[DataFrame, CleanSpec]],
    stores: DataFrame,
    method: str = "exact",
    load_ts: str | None = None,
) -> None:
    """Clean and conform every channel and the stores; write ``dst/sales`` and ``dst/stores`` as Parquet.

    The de-duplicated rows of each channel are staged in the shared folder, and deleted at the end.
    """
    spark = stores.sparkSession
    staging = scratch_dir(spark, "staging")
    try:
        conformed = [
            to_sales(clean_sales(df, spec, method, load_ts, f"{staging}/{n}"), sales_mapping(spec))
            for n, (df, spec) in enumerate(channels)
        ]
        union_channels(*conformed).write.mode("overwrite").parquet(f"{dst}/sales")
        to_stores(clean_stores(stores, load_ts=load_ts)).write.mode("overwrite").parquet(f"{dst}/stores")
    finally:
        delete(spark, staging)


def read_sales(spark: SparkSession, dst: str) -> DataFrame:
    return spark.read.schema(CONFORMED_SALES).parquet(f"{dst}/sales")


def read_stores(spark: SparkSession, dst: str) -> DataFrame:
    return spark.read.schema(CONFORMED_STORES).parquet(f"{dst}/stores")
