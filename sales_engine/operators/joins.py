"""Joins of the sales fact with a dimension of unknown size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as text plus a fixed cost per value; one number comes back from the cluster."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(16))
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def join_dimension(fact: DataFrame, dim: DataFrame, on: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join on ``on``; the fact is not shuffled while the dimension's measured size allows it.

    Beyond the limit both sides are shuffled by the key and merged. A key may own a third of the fact, or be one
    row's copies throughout: adaptive execution splits such a partition by the tasks that wrote it, into as many
    parts as its bytes ask for, and reads the key's few dimension rows once a part. Filters on either side reach
    its scan in both forms.
    """
    return fact.join(F.broadcast(dim) if fits_broadcast(dim, limit) else dim.hint("shuffle_merge"), on)
