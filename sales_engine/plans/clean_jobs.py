"""The cleaning pipelines: sales of any channel, and the store table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sales_engine.functions.numbers import to_int, to_number
from sales_engine.operators.cleaning import cast_types, dedupe, flag_processed, impute, require, with_load_ts
from sales_engine.operators.profile import profile
from sales_engine.operators.quartiles import drop_outliers_iqr
from sales_engine.schemas import STORE_SPEC, CleanSpec, StoreSpec


def prepare_sales(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Flag, drop rows without store or product, impute, remove duplicates."""
    kept = require(flag_processed(df, spec), [spec.store, spec.product], spec.sentinels)
    return dedupe(impute(kept, profile(df, spec), spec))


def cut_outliers(
    df: DataFrame, spec: CleanSpec, k: float = 1.5, method: str = "exact", eager: bool = False
) -> DataFrame:
    """IQR cut on quantity, then on revenue with the quartiles of what the first cut left."""
    for column in (spec.quantity, spec.revenue):
        number = F.col(column) if dict(df.dtypes).get(column) == "double" else to_number(F.col(column))
        df = drop_outliers_iqr(df, number, k, method, eager)
    return df


def clean_sales(
    df: DataFrame,
    spec: CleanSpec,
    method: str = "exact",
    load_ts: str | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Dirty channel in, typed and deduplicated sales without outliers out.

    Two scans of the source: one for the profile, one that ends in the shuffle
    of the de-duplication. Without ``staging`` the result is lazy, and the
    quartile passes and the final rows all read that same shuffle. With it, the
    de-duplicated rows are written there as Parquet and the outlier bounds
    computed from it right away: the lineage ends there, each quartile pass
    reads one or two columns of numbers, and the bounds reach the scan.
    """
    # equality of rows is decided on the text as it came; from here on only the numbers matter
    numbers = {c: to_number(F.col(c)) for c in (spec.quantity, spec.revenue)}
    unique = prepare_sales(df, spec).withColumns(numbers)
    if staging:
        unique.write.mode("overwrite").parquet(staging)
        unique = df.sparkSession.read.schema(unique.schema).parquet(staging)
    typed = cast_types(cut_outliers(unique, spec, method=method, eager=bool(staging)), spec)
    return with_load_ts(typed, spec.load_ts, load_ts)


def clean_stores(
    df: DataFrame,
    spec: StoreSpec = STORE_SPEC,
    load_ts: str | None = None,
    extra_required: tuple[str, ...] = (),
) -> DataFrame:
    """Stores with a valid key, each row once, typed. Other columns are only checked if asked for."""
    unique = dedupe(require(df, [spec.store, *extra_required], spec.sentinels))
    typed = unique.withColumns(
        {spec.store: to_int(F.col(spec.store)), **{c: F.col(c).cast("string") for c in spec.texts}}
    )
    return with_load_ts(typed, spec.load_ts, load_ts)
