"""One-row summary of a dirty channel: the values that replace missing ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sales_engine.functions.numbers import below_large, exact_sum, large_sum, to_number
from sales_engine.functions.validity import is_invalid
from sales_engine.operators.sketches import heavy_items
from sales_engine.schemas import CleanSpec


def mode_of(df: DataFrame, column: str, sentinels: tuple[str, ...]) -> DataFrame:
    """Most frequent valid value and its count; the smallest value wins a tie.

    Counting happens before the shuffle, so a value on a third of the rows costs
    one row per task, and the final top-1 keeps one row per task as well.
    """
    return (
        df.where(~is_invalid(F.col(column), sentinels))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(1)
    )


def mode_by_candidates(df: DataFrame, column: str, sentinels: tuple[str, ...], items: int = 3072) -> DataFrame:
    """``mode_of`` for a key that is nearly unique but for few values: exact, without shuffling every key.

    Sketches in each task name the candidates, a second scan counts these alone, and if the commonest occurs more
    often than a value without a name could, it is the mode. Otherwise all keys are counted as ``mode_of`` does; as the
    answer reaches that branch as a broadcast without rows where it isn't needed, adaptive execution drops its scan.
    """
    valid = df.where(~is_invalid(F.col(column), sentinels)).select(column)
    count, top = F.count(F.lit(1)).alias("n"), [F.desc("n"), F.asc(column)]
    named = heavy_items(valid, column, items).select(F.explode("found").alias("candidate"), "least")
    # candidates are a bounded list; of each, a task sends one row
    counted = valid.join(F.broadcast(named), F.col(column) == F.col("candidate")).groupBy(column).agg(count, F.max("least").alias("least"))
    sure = counted.orderBy(*top).limit(1).where("n > least").select(column, "n")
    unsure = df.sparkSession.range(1).select(F.lit(True).alias("unsure")).join(F.broadcast(sure), F.lit(True), "left_anti")
    all_keys = valid.join(F.broadcast(unsure), F.lit(True)).groupBy(column).agg(count).orderBy(*top).limit(1)
    return sure.unionAll(all_keys)


def profile(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """``mode_date``, ``mean_quantity`` (truncated) and ``mean_revenue`` of all raw rows, in one scan.

    Counts and sums are kept per date value first; the mode and both means are
    then read off those partial rows. Always exactly one row, NULLs for an
    empty or all-invalid input. A number far out of range moves the means, as it
    should, and stops nothing; a mean quantity beyond a bigint is NULL.
    """
    quantity, revenue = to_number(F.col(spec.quantity)), to_number(F.col(spec.revenue))
    per_date = (
        df.select(F.col(spec.date).alias("date"), quantity.alias("q"), revenue.alias("r"))
        .groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("q").alias("q_n"),
            exact_sum(below_large(F.col("q")), 12).alias("q_sum"),
            large_sum(F.col("q")).alias("q_large"),
            F.count("r").alias("r_n"),
            exact_sum(below_large(F.col("r")), 12).alias("r_sum"),
            large_sum(F.col("r")).alias("r_large"),
        )
    )

    def mean(name: str):
        exact = F.coalesce(F.try_sum(f"{name}_sum").cast("double"), F.lit(0.0))
        return F.try_divide(exact + F.sum(f"{name}_large"), F.sum(f"{name}_n").cast("double"))

    commonest = F.min(F.when(~is_invalid(F.col("date"), spec.sentinels), F.struct(-F.col("n"), F.col("date"))))
    return per_date.agg(
        commonest.getField("date").alias("mode_date"),
        mean("q").try_cast("bigint").alias("mean_quantity"),
        mean("r").alias("mean_revenue"),
    )
