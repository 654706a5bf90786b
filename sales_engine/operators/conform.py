"""Bring the cleaned channels to one shape, put them together, add the store."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sales_engine.functions.dates import to_ts
from sales_engine.functions.numbers import to_int, to_number
from sales_engine.operators.joins import join_dimension
from sales_engine.schemas import CONFORMED_SALES, CONFORMED_STORES, STORE_MAPPING

_PARSERS = {
    T.TimestampType(): to_ts,
    T.IntegerType(): to_int,
    T.DoubleType(): to_number,
    T.BooleanType(): lambda c: c.try_cast("boolean"),
    T.StringType(): lambda c: c.cast("string"),
}


def _conform(df: DataFrame, mapping: dict[str, str], schema: T.StructType) -> DataFrame:
    have = {f.name.lower(): f for f in df.schema}
    source = {target: name for name, target in mapping.items()}
    missing = [source.get(f.name, f.name) for f in schema if source.get(f.name, f.name).lower() not in have]
    if missing:
        raise ValueError(f"source columns not found: {missing}; available: {df.columns}")

    def typed(field: T.StructField) -> Column:
        name = source.get(field.name, field.name)
        column = F.col(f"`{name}`")
        if have[name.lower()].dataType != field.dataType:
            column = _PARSERS[field.dataType](column)
        return column.alias(field.name)

    return df.select(*[typed(f) for f in schema])


def to_sales(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename, type and order the columns of one cleaned channel; a missing source column is an error."""
    return _conform(df, mapping, CONFORMED_SALES)


def to_stores(df: DataFrame, mapping: dict[str, str] = STORE_MAPPING) -> DataFrame:
    """Store dimension under the names the reports use."""
    return _conform(df, mapping, CONFORMED_STORES)


def union_channels(*channels: DataFrame) -> DataFrame:
    """All rows of all channels, duplicates kept."""
    return reduce(DataFrame.unionByName, channels)


def enrich(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Every sale with its store's attributes; sales without a known store drop out."""
    return join_dimension(sales, stores, "store_ID")
