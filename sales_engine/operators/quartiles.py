"""Quartiles and the outlier cut built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sales_engine.operators.sketches import quantile_sketch, quantiles_of

BANDS_PER_E_FOLD = 4096
SLICES = 1 << 20


def quartiles(df: DataFrame, value: Column, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """One row ``(q1, q3)`` of the non-NULL values.

    Both methods return a value that occurs in the data, and the same one while
    there are few rows. ``exact`` gives the value at rank ceil(p*n) in three
    passes; no task's state grows with the number of rows or of tasks.
    ``approx`` is one pass: a KLL sketch for the rows of 64 tasks at a time, merged in levels
    of 64, of at most 1.6 MB each. Its rank error is 1/accuracy of the rows (1.04 at the default,
    which takes the largest sketch) 99 times in 100, and its choices are random: a second run may
    give a neighbouring value.
    """
    if method == "approx":
        sketch = quantile_sketch(df.select(value.cast("double").alias("x")), "x", accuracy)
        return quantiles_of(sketch, {"q1": 0.25, "q3": 0.75})
    if method == "exact":
        return _exact_quartiles(df.select(F.lit(0).alias("measure"), value.alias("x")), 1).select("q1_0", "q3_0").toDF("q1", "q3")
    raise ValueError(f"unknown quartile method: {method}")


def quartiles_of_each(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Exact quartiles ``(measure, q1, q3)`` of several columns in one set of passes; NULLs where there are no values."""
    each = F.array(*[F.struct(F.lit(i).alias("measure"), c.alias("x")) for i, c in enumerate(measures.values())])
    found = _exact_quartiles(df.select(F.inline(each)), len(measures))
    rows = [
        F.struct(F.lit(name).alias("measure"), F.col(f"q1_{i}").alias("q1"), F.col(f"q3_{i}").alias("q3"))
        for i, name in enumerate(measures)
    ]
    return found.select(F.inline(F.array(*rows)))


def _band(x: Column) -> Column:
    """Non-decreasing step function of a double with steps about 0.025 % wide, however small or large it is."""
    size = F.floor(F.ln(F.abs(x)) * BANDS_PER_E_FOLD) + 4_000_000
    return F.when(x == 0, F.lit(0)).otherwise(F.signum(x) * size).cast("int")


def _slice(x: Column) -> Column:
    """Which of the equal parts between ``lo`` and ``hi`` of its band a value lies in."""
    share = (x - F.col("lo")) / (F.col("hi") - F.col("lo"))
    return F.when(F.col("hi") > F.col("lo"), F.floor(share * (SLICES - 1))).otherwise(F.lit(0)).cast("int")


def _at_rank(counts: DataFrame) -> DataFrame:
    """The rows that hold ``rank``, given the running count ``upto``; ``rank`` becomes the rank inside the row."""
    return (
        counts.where("upto - n < rank and rank <= upto")
        .withColumn("rank", F.expr("rank - (upto - n)"))
        .drop("upto", "n")
    )


def _running(order: str) -> Column:
    return F.sum("n").over(W.partitionBy("measure", "quarter").orderBy(order))


def _exact_quartiles(values: DataFrame, measures: int) -> DataFrame:
    """One row ``q1_0, q3_0, q1_1, ...`` of the values ``x`` of each ``measure`` (0 and up).

    Narrow down to a band of values, to a slice of that band, to one value.

    Every pass counts before it shuffles, so a value on a third of the rows is
    one row per task. What one task adds up is a list of bands (12 million for all
    doubles there are), then of a million slices, then of the different values in one
    slice, whose width is a four-billionth of the value, however small: one price in
    cents up to 40 million, and never more than 2^21 doubles.

    NULLs are left to ``count(x)`` and null-safe joins: a NULL filter, written or
    inferred, would move below a preceding shuffle and keep the passes from
    sharing it.
    """
    x, n = F.col("x"), F.count("x").alias("n")
    bands = values.groupBy("measure", _band(x).alias("band")).agg(n, F.min("x").alias("lo"), F.max("x").alias("hi"))
    ranked = (
        bands.withColumn("upto", F.sum("n").over(W.partitionBy("measure").orderBy("band")))
        .withColumn("total", F.sum("n").over(W.partitionBy("measure")))
        .select("*", F.explode(F.array(F.lit(1), F.lit(3))).alias("quarter"))
        .withColumn("rank", F.ceil(F.col("quarter") * F.col("total") / 4))
        .drop("total")
    )
    band = F.broadcast(_at_rank(ranked).withColumnRenamed("measure", "of"))  # two rows a measure
    in_band = (F.col("measure") == F.col("of")) & _band(x).eqNullSafe(F.col("band"))
    slices = (
        values.join(band, in_band)
        .groupBy("measure", "quarter", "rank", "band", "lo", "hi", _slice(x).alias("slice"))
        .agg(n)
    )
    found = _at_rank(slices.withColumn("upto", _running("slice"))).withColumnRenamed("measure", "of")
    slice_ = F.broadcast(found)  # two rows a measure
    in_slice = in_band & _slice(x).eqNullSafe(F.col("slice"))
    inside = values.join(slice_, in_slice).groupBy("measure", "quarter", "rank", "x").agg(n)
    of = [(i, q) for i in range(measures) for q in (1, 3)]
    here = F.col("measure") * 4 + F.col("quarter")
    return _at_rank(inside.withColumn("upto", _running("x"))).agg(
        *[F.max(F.when(here == i * 4 + q, x)).alias(f"q{q}_{i}") for i, q in of]
    )


def iqr_bounds(df: DataFrame, value: Column, k: float = 1.5, method: str = "exact") -> DataFrame:
    """One row ``(low, high)``: the quartiles widened by ``k`` interquartile ranges."""
    spread = k * (F.col("q3") - F.col("q1"))
    return quartiles(df, value, method).select(
        (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high")
    )


def drop_outliers_iqr(
    df: DataFrame, value: Column, k: float = 1.5, method: str = "exact", eager: bool = False
) -> DataFrame:
    """Keep rows whose value lies within the IQR bounds; NULL values go too.

    Lazily, the bounds are a one-row broadcast, and the value is computed once
    per row, ahead of the comparison. ``coalesce`` keeps the optimizer from
    pushing a NULL check on the value below a preceding shuffle in this branch
    only: without it the quartile passes and the cut would each shuffle anew
    instead of reading the same shuffle files.

    ``eager`` computes the two bounds now and filters by them as constants. Use
    it where ``df`` is a stored table: the filter reaches the scan, and later
    plans no longer contain the passes.
    """
    valued = df.withColumn("_value", value)
    bounds = iqr_bounds(valued, F.col("_value"), k, method)
    if eager:
        low, high = bounds.first()
        return df.where(value.between(F.lit(low), F.lit(high)))
    within = F.coalesce(F.col("_value").between(F.col("low"), F.col("high")), F.lit(False))
    return valued.crossJoin(F.broadcast(bounds)).where(within).drop("_value", "low", "high")
