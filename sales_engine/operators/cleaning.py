"""Row-level cleaning steps; each takes and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sales_engine.functions.dates import epoch_ms_to_ts, to_ts
from sales_engine.functions.numbers import to_int, to_number
from sales_engine.functions.validity import is_invalid
from sales_engine.schemas import CleanSpec


def flag_processed(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Mark rows whose revenue, quantity or date is missing. Run it before imputing."""
    missing = [is_invalid(F.col(c), spec.sentinels) for c in (spec.revenue, spec.quantity, spec.date)]
    return df.withColumn(spec.processed, missing[0] | missing[1] | missing[2])


def require(df: DataFrame, columns: Sequence[str], sentinels: Sequence[str]) -> DataFrame:
    """Drop rows where any of the columns is missing."""
    for column in columns:
        df = df.where(~is_invalid(F.col(column), sentinels))
    return df


def impute(df: DataFrame, values: DataFrame, spec: CleanSpec) -> DataFrame:
    """Replace missing date, quantity and revenue by the profile's mode and means.

    ``values`` is the one-row profile, broadcast. A replacement takes the type
    of its column, so text channels stay text until the final typing.
    """
    fills = {spec.date: "mode_date", spec.quantity: "mean_quantity", spec.revenue: "mean_revenue"}
    filled = {
        column: F.when(
            is_invalid(F.col(column), spec.sentinels), F.col(value).try_cast(df.select(column).schema[0].dataType)
        ).otherwise(F.col(column))
        for column, value in fills.items()
    }
    return df.crossJoin(F.broadcast(values)).withColumns(filled).drop(*values.columns)


def dedupe(df: DataFrame) -> DataFrame:
    """Keep one of each group of equal rows.

    Every task first drops its own copies, so a row repeated on a third of the
    table reaches the shuffle once per task.
    """
    return df.dropDuplicates()


def cast_types(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Final typing: timestamp, int, string, int, double; what does not parse becomes NULL."""
    date = F.col(spec.date)
    return df.withColumns(
        {
            spec.date: epoch_ms_to_ts(date) if spec.epoch_ms else to_ts(date),
            spec.store: to_int(F.col(spec.store)),
            spec.product: F.col(spec.product).cast("string"),
            spec.quantity: to_int(F.col(spec.quantity)),
            spec.revenue: to_number(F.col(spec.revenue)),
        }
    )


def with_load_ts(df: DataFrame, name: str, ts: str | None = None) -> DataFrame:
    """Add the load time: the start of the query, or a fixed ``yyyy-MM-dd HH:mm:ss``."""
    return df.withColumn(name, F.lit(ts).cast("timestamp") if ts else F.current_timestamp())
