"""Winners, overall and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_with_ties(df: DataFrame, measure: str) -> DataFrame:
    """All rows that share the largest value of ``measure``; the maximum travels as a one-row broadcast."""
    best = df.agg(F.max(measure).alias("_best"))
    return df.join(F.broadcast(best), F.col(measure) == F.col("_best")).drop("_best")


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group in the given order.

    The filter on the row number lets every task keep its own best ``n`` rows per
    group before the shuffle, so a hot group does not travel whole.
    """
    number = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", number).where(F.col("_n") <= n).drop("_n")
