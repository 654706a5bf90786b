"""The three dirty sales channels and the store table, derived from the given tables.

``lineitem`` plays the delimited sales file: every row, with the defects of a
dirty export planted by the residues of ``k``, and the orders divisible by 50
sent a second time as exact duplicates. All ``events`` play the message stream; ``supplier`` and ``nation`` play the stores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sales_engine.schemas import DB_SALES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``store_ID, store_name, location, demographics``."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    key, where = F.col("s_suppkey"), F.col("n_nationkey")
    latitude = ((where * 7) % 131 - 50).cast("string")
    longitude = ((where * 29) % 341 - 170).cast("string")
    place = F.concat(F.lit("("), latitude, F.lit(".5, "), longitude, F.lit(".25)"))
    return supplier.join(nation, F.col("s_nationkey") == where).select(
        key.cast("string").alias("store_ID"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("location"),
        F.when(key % 17 == 0, "abcde").when(key % 19 == 0, None).otherwise(place).alias("demographics"),
    )


def stores_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store table as exported: keys with sentinels, every store twice."""
    once = stores(spark, sf_dir)
    key = F.col("store_ID").cast("int")
    dirty = once.withColumn(
        "store_ID",
        F.when(key % 13 == 0, "").when(key % 13 == 1, None).when(key % 13 == 2, "STORE_ERROR")
        .when(key % 13 == 3, F.concat("store_ID", F.lit("_err"))).otherwise(F.col("store_ID")),
    ).withColumnRenamed("store_ID", "store_code")
    return dirty.unionAll(dirty)


def _dirty(k: Column, value: Column, modulus: int, sentinel: str, outlier: Column | None = None) -> Column:
    residue = k % modulus
    out = (
        F.when(residue == 0, F.lit(""))
        .when(residue == 1, F.lit(None))
        .when(residue == 2, F.concat(value, F.lit("_err")))
        .when(residue == 3, F.lit(sentinel))
    )
    return (out if outlier is None else out.when(residue == 4, outlier)).otherwise(value)


def sales_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Date, StoreID, ProductID, QuantitySold, Revenue``, all text."""
    line = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") * 31 + F.col("l_partkey") * 7 + F.col("l_linenumber")
    date = F.to_date("l_shipdate").cast("string")
    quantity = F.col("l_quantity").cast("int").cast("string")
    revenue = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    columns = [
        _dirty(k, date, 13, "DATE_ERROR").alias("Date"),
        _dirty(k, F.col("l_suppkey").cast("string"), 17, "STORE_ERROR").alias("StoreID"),
        _dirty(k, F.col("l_partkey").cast("string"), 19, "PRODUCT_ERROR").alias("ProductID"),
        _dirty(k, quantity, 23, "QUANTITY_ERROR", F.lit("999")).alias("QuantitySold"),
        _dirty(k, revenue, 29, "REVENUE_ERROR", F.concat(F.lit("9"), revenue)).alias("Revenue"),
    ]
    sent_twice = line.where(F.col("l_orderkey") % 50 == 0)
    return line.select(*columns).unionAll(sent_twice.select(*columns))


def sales_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows under the relational column names."""
    return sales_csv(spark, sf_dir).toDF(*DB_SALES.names)


def sales_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded message payloads: ``timestamp, store_id, product_id, quantity_sold, revenue``."""
    event = F.col("event_id")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return (
        table(spark, sf_dir, "events")
        .select(
            F.when(event % 23 != 0, millis).alias("timestamp"),
            F.when(event % 11 != 0, (F.col("user_id") % 100).cast("int")).alias("store_id"),
            F.when(event % 13 == 0, F.lit(""))
            .when(event % 13 == 1, F.lit(None))
            .otherwise((event % 2000).cast("string"))
            .alias("product_id"),
            F.when(event % 17 != 0, F.get_json_object("props", "$.k").cast("int")).alias("quantity_sold"),
            F.when(event % 19 != 0, F.col("value")).alias("revenue"),
        )
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON payload per event in ``value``, as a topic delivers it."""
    return sales_stream(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))


