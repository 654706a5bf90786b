"""Sketches that are merged in levels, so that no task merges one of every other task."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A task merges the sketches of at most 2^6 others at each level; two levels and the last task suit 262,144 tasks.
FAN_BITS, LEVELS = 6, 2


def merged_in_levels(rows: DataFrame, make: list[Column], merge: list[Column], levels: int = LEVELS) -> DataFrame:
    """One row: ``make`` aggregates the rows of 64 tasks at a time, ``merge`` 64 such results at a time, and so on.

    Both name their results alike. Always one row, also of no rows.
    """
    group = F.shiftright(F.spark_partition_id(), FAN_BITS)
    state = rows.withColumn("_group", group).groupBy("_group").agg(*make)
    for _ in range(levels - 1):
        state = state.groupBy(F.shiftright("_group", FAN_BITS).alias("_group")).agg(*merge)
    return state.agg(*merge)


def kll_size(accuracy: int) -> int:
    """The sketch parameter whose rank error is 1/accuracy of the rows 99 times in 100; 65535 is the largest there is.

    The error of one quantile is about 2.296 / k^0.9021, published with the sketch's reference implementation.
    """
    return min(65535, max(200, ceil((2.296 * accuracy) ** (1 / 0.9021))))


def quantile_sketch(values: DataFrame, column: str, accuracy: int, levels: int = LEVELS) -> DataFrame:
    """One row ``(sketch, n)`` of the non-NULL doubles of a column."""
    k = F.lit(kll_size(accuracy))
    n = F.sum("n").alias("n")
    make = [F.kll_sketch_agg_double(column, k).alias("sketch"), F.count(column).alias("n")]
    return merged_in_levels(values, make, [F.kll_merge_agg_double("sketch", k).alias("sketch"), n], levels)


def quantiles_of(sketch: DataFrame, shares: dict[str, float]) -> DataFrame:
    """One row with the value at each share of the rows; NULLs where the sketch has no value."""
    one = {
        name: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share))).alias(name)
        for name, share in shares.items()
    }
    return sketch.select(*one.values())


def heavy_items(rows: DataFrame, column: str, items: int = 3072, levels: int = LEVELS) -> DataFrame:
    """One row ``(found, least, n)``: an array of values, among them every one that occurs more than ``least`` times.

    A frequent-items sketch of m slots misses a count by at most 3.5 n / m and names what surely occurs more often
    than that, so what occurs more than twice that is named. NULLs don't count.
    """
    slots = 2 ** ceil(log2(items / 0.75))
    make = [F.expr(f"approx_top_k_accumulate(`{column}`, {items})").alias("state"), F.count(column).alias("n")]
    merge = [F.expr(f"approx_top_k_combine(state, {items})").alias("state"), F.sum("n").alias("n")]
    merged = merged_in_levels(rows.where(F.col(column).isNotNull()), make, merge, levels)
    found = F.expr(f"transform(approx_top_k_estimate(state, {items}), i -> i.item)")
    return merged.select(
        F.when(F.col("n") > 0, found).alias("found"), (7.0 * F.col("n") / slots).alias("least"), F.coalesce("n", F.lit(0)).alias("n")
    )
