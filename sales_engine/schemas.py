"""Table layouts, cleaning specs and fixed vocabularies shared by the jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def text_schema(*names: str) -> T.StructType:
    """All-string layout, the way header-named delimited files are read."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CSV_SALES = text_schema("Date", "StoreID", "ProductID", "QuantitySold", "Revenue")
DB_SALES = text_schema("event_date", "store_code", "product_code", "sold_units", "total_sales")
STORES_EXPORT = text_schema("store_code", "store_name", "location", "demographics")

STREAM_SALES = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity_sold", T.IntegerType()),
        T.StructField("revenue", T.DoubleType()),
    ]
)

# Markers that count as "no value" in each channel.
CSV_SENTINELS = ("", "STORE_ERROR", "PRODUCT_ERROR", "QUANTITY_ERROR", "REVENUE_ERROR", "DATE_ERROR")
STREAM_SENTINELS = (
    "", "None", "STORE_ERROR", "PRODUCT_ERROR", "QUANTITY_ERROR", "REVENUE_ERROR", "TIMESTAMP_ERROR",
)
STORE_SENTINELS = ("", "STORE_ERROR", "LOCATION_ERROR", "DEMOGRAPHICS_ERROR")


@dataclass(frozen=True)
class CleanSpec:
    """Which column plays which role in one dirty sales channel."""

    date: str
    store: str
    product: str
    quantity: str
    revenue: str
    sentinels: tuple[str, ...]
    load_ts: str
    epoch_ms: bool = False
    processed: str = "Processed"


@dataclass(frozen=True)
class StoreSpec:
    """Roles of the columns in the stores export; only the key has to be valid by default."""

    store: str = "store_code"
    texts: tuple[str, ...] = ("store_name", "location", "demographics")
    sentinels: tuple[str, ...] = STORE_SENTINELS
    load_ts: str = "Insert_Date"


CSV_SPEC = CleanSpec(
    "Date", "StoreID", "ProductID", "QuantitySold", "Revenue", CSV_SENTINELS, "Insert_Date"
)
STREAM_SPEC = CleanSpec(
    "timestamp", "store_id", "product_id", "quantity_sold", "revenue",
    STREAM_SENTINELS, "Insertion_Date", epoch_ms=True,
)
DB_SPEC = CleanSpec(
    "event_date", "store_code", "product_code", "sold_units", "total_sales", CSV_SENTINELS, "Insert_Date"
)
STORE_SPEC = StoreSpec()

# The shape every channel is brought to before it is reported on.
CONFORMED_SALES = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("store_ID", T.StringType()),
        T.StructField("product_ID", T.StringType()),
        T.StructField("quantity_Sold", T.IntegerType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("Tratado", T.BooleanType()),
        T.StructField("fecha_Insercion", T.TimestampType()),
    ]
)
CONFORMED_STORES = text_schema("store_ID", "store_name", "location", "demographics")


def sales_mapping(spec: CleanSpec) -> dict[str, str]:
    """Cleaned channel column -> conformed column."""
    return {
        spec.date: "date",
        spec.store: "store_ID",
        spec.product: "product_ID",
        spec.quantity: "quantity_Sold",
        spec.revenue: "revenue",
        spec.processed: "Tratado",
        spec.load_ts: "fecha_Insercion",
    }


STORE_MAPPING = {
    "store_code": "store_ID",
    "store_name": "store_name",
    "location": "location",
    "demographics": "demographics",
}
