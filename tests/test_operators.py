import random
from math import ceil

import pytest
from pyspark.sql import functions as F

from sales_engine.operators.cleaning import dedupe, flag_processed, impute, require, with_load_ts
from sales_engine.operators.conform import to_sales, to_stores, union_channels
from sales_engine.operators.joins import fits_broadcast, join_dimension, measured_bytes
from sales_engine.operators.profile import mode_by_candidates, mode_of, profile
from sales_engine.operators.quartiles import drop_outliers_iqr, quartiles, quartiles_of_each
from sales_engine.operators.rank import top_n_per_group, top_with_ties
from sales_engine.operators.sketches import kll_size, quantile_sketch, quantiles_of
from sales_engine.schemas import CSV_SALES, CSV_SENTINELS, CSV_SPEC, STORE_MAPPING, STREAM_SALES, STREAM_SPEC, sales_mapping
from tests.conftest import plan_of


def csv(spark, *rows):
    return spark.createDataFrame(rows, CSV_SALES)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def at_rank(values, p):
    values = sorted(v for v in values if v is not None)
    return values[ceil(p * len(values)) - 1] if values else None


SAMPLES = {
    "cents": lambda r: r.randint(500, 50_000) / 100,
    "small": lambda r: r.randint(1, 5),
    "signed": lambda r: r.uniform(-1, 1) * 10 ** r.randint(-6, 9),
    "hot": lambda r: 7.0 if r.random() < 0.4 else r.uniform(0, 1000),
    "holes": lambda r: None if r.random() < 0.3 else r.uniform(-5, 5),
    "tiny": lambda r: r.random() * 1e-9,
}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 997])
@pytest.mark.parametrize("kind", SAMPLES)
def test_exact_quartiles_against_a_sorted_list(spark, kind, n):
    rnd = random.Random(f"{kind}{n}")
    sample = [None if v is None else float(v) for v in (SAMPLES[kind](rnd) for _ in range(n))]
    df = spark.createDataFrame([(v,) for v in sample], "x double").repartition(3)
    assert tuple(quartiles(df, F.col("x"), "exact").first()) == (at_rank(sample, 0.25), at_rank(sample, 0.75))


@pytest.mark.parametrize("method", ["approx", "exact"])
def test_quartiles_of_nothing(spark, method):
    for rows in ([], [(None,)]):
        df = spark.createDataFrame(rows, "x double")
        assert tuple(quartiles(df, F.col("x"), method).first()) == (None, None)


def test_approx_quartiles_stay_within_the_rank_error(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_extendedprice")
    n = df.count()
    for p, value in zip((0.25, 0.75), quartiles(df, F.col("l_extendedprice"), "approx").first()):
        below, upto = df.where(F.col("l_extendedprice") < value).count(), df.where(F.col("l_extendedprice") <= value).count()
        assert below - n / 10000 - 1 <= p * n <= upto + n / 10000 + 1


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        quartiles(spark.range(1), F.col("id"), "guess")


def test_outliers_and_nulls_go(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 21)] + [(1000.0,), (None,)], "x double")
    kept = drop_outliers_iqr(df, F.col("x"), method="exact")
    assert [r.x for r in kept.orderBy("x").collect()] == [float(v) for v in range(1, 21)]
    assert kept.columns == ["x"]


def test_mode_takes_the_smallest_of_a_tie_and_ignores_sentinels(spark):
    dates = ["b", "a", "a", "b", "DATE_ERROR", "DATE_ERROR", "DATE_ERROR", "", "", "", None, None, None]
    df = csv(spark, *[(d, "1", "p", "1", "1") for d in dates])
    assert tuple(mode_of(df, "Date", CSV_SENTINELS).first()) == ("a", 2)
    assert profile(df, CSV_SPEC).first().mode_date == "a"


def test_profile_uses_all_rows_and_skips_malformed(spark, ansi):
    df = csv(spark, ("d", None, "p", "3", "10.5"), ("d", "1", None, "4", "x_err"), ("d", "1", "p", "9_err", "1"))
    assert tuple(profile(df, CSV_SPEC).first()) == ("d", 3, 5.75)


@pytest.mark.parametrize("rows", [[], [(None, "1", "p", "", "REVENUE_ERROR")]])
def test_profile_of_nothing_valid_is_one_row_of_nulls(spark, rows):
    assert [tuple(r) for r in profile(csv(spark, *rows), CSV_SPEC).collect()] == [(None, None, None)]


def test_flag_and_impute(spark, ansi):
    df = csv(
        spark,
        ("2024-01-01", "1", "p", "4", "8.0"),
        ("", "1", "p", "QUANTITY_ERROR", None),
        ("2024-01-01_err", "1", "p", "4_err", "2.0"),
    )
    out = impute(flag_processed(df, CSV_SPEC), profile(df, CSV_SPEC), CSV_SPEC)
    assert rows_of(out) == [
        ("2024-01-01", "1", "p", "4", "5.0", True),
        ("2024-01-01", "1", "p", "4", "8.0", False),
        ("2024-01-01_err", "1", "p", "4_err", "2.0", False),
    ]


def test_impute_typed_columns_keep_their_types(spark, ansi):
    df = spark.createDataFrame([("5", 1, "p", None, None), ("None", 1, "p", 3, 2.5)], STREAM_SALES)
    out = impute(df, profile(df, STREAM_SPEC), STREAM_SPEC)
    assert out.schema == df.schema
    assert rows_of(out) == [("5", 1, "p", 3, 2.5), ("5", 1, "p", 3, 2.5)]


def test_require(spark):
    df = csv(spark, ("d", "", "p", "1", "1"), ("d", "1", "PRODUCT_ERROR", "1", "1"), ("d", "1_err", "p", "1", "1"))
    assert rows_of(require(df, ["StoreID", "ProductID"], CSV_SENTINELS)) == [("d", "1_err", "p", "1", "1")]


def test_dedupe_compares_all_columns_nulls_included(spark):
    df = csv(spark, ("d", None, "p", "1", "1"), ("d", None, "p", "1", "1"), ("d", None, "p", "1", "1.0"))
    assert dedupe(df).count() == 2


def test_load_ts(spark):
    df = with_load_ts(spark.range(3), "at", "2025-01-01 00:00:00")
    assert {str(r["at"]) for r in df.collect()} == {"2025-01-01 00:00:00"}
    assert with_load_ts(spark.range(1), "at").first()["at"] is not None


def test_top_with_ties(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 5), ("d", None)], "k string, v int")
    assert rows_of(top_with_ties(df, "v")) == [("b", 5), ("c", 5)]


def test_top_n_per_group(spark):
    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 2), ("g", "c", 1), (None, "z", 1)], "g string, p string, v int")
    assert rows_of(top_n_per_group(df, ["g"], [F.desc("v"), F.asc("p")])) == [("g", "a", 2), (None, "z", 1)]
    assert top_n_per_group(df, ["g"], [F.desc("v"), F.asc("p")], 2).count() == 3


def test_shuffled_join_equals_broadcast_join(spark):
    fact = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 50).cast("string"))
        .alias("k"),
        F.col("id").alias("v"),
    )
    dim = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("1", "z"), (None, "n"), ("99", "u")], "k string, a string")
    small = join_dimension(fact, dim, "k")
    shuffled = join_dimension(fact, dim, "k", limit=-1)
    assert rows_of(small) == rows_of(shuffled)
    assert shuffled.columns == ["k", "v", "a"]


def test_copies_of_one_row_are_spread_over_tasks(spark):
    fact = spark.range(0, 4000, 1, 40).select(F.when(F.col("id") >= 0, "hot").alias("k"), F.lit(1).alias("v"))
    dim = spark.createDataFrame([("hot", "x")], "k string, a string")
    joined = join_dimension(fact, dim, "k", limit=-1)
    assert joined.count() == 4000
    small = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    }
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        per_task = join_dimension(fact, dim, "k", limit=-1).groupBy(F.spark_partition_id()).count()
        assert per_task.agg(F.max("count")).first()[0] < 2000
    finally:
        for key in small:
            spark.conf.unset(key)


def test_measured_bytes(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 84, "0").alias("t"))
    assert measured_bytes(df) == 1000 * (84 + 16 + 16)
    assert measured_bytes(df.limit(0)) == 0
    assert fits_broadcast(df, 200_000) and not fits_broadcast(df, 100_000)


def test_conform_names_types_and_missing_columns(spark, ansi):
    text = spark.createDataFrame(
        [("2024-01-01T00:00:00.000Z", "7", "p", "3", "2.5", "true", "2025-01-01T00:00:00.000Z")],
        "Date string, StoreID string, ProductID string, QuantitySold string, Revenue string, Processed string, Insert_Date string",
    )
    out = to_sales(text, sales_mapping(CSV_SPEC))
    row = out.first()
    assert (str(row.date), row.store_ID, row.quantity_Sold, row.revenue, row.Tratado) == (
        "2024-01-01 00:00:00", "7", 3, 2.5, True,
    )
    with pytest.raises(ValueError, match="StoreID"):
        to_sales(text.drop("StoreID"), sales_mapping(CSV_SPEC))
    with pytest.raises(ValueError, match="location"):
        to_stores(spark.createDataFrame([(1, "n")], "store_code int, store_name string"), STORE_MAPPING)


def test_union_keeps_duplicates(spark):
    df = spark.range(3)
    assert union_channels(df, df, df).count() == 9


def test_out_of_range_numbers_do_not_stop_the_profile(spark, ansi):
    from sales_engine.operators.profile import profile

    rows = [("2024-01-01", "1", "p", "2", "10.5")] * 50 + [("2024-01-02", "1", "p", "1e12", "1e19"), ("x", "1", "p", "1e300", "5")]
    df = spark.createDataFrame(rows, "Date string, StoreID string, ProductID string, QuantitySold string, Revenue string")
    row = profile(df, CSV_SPEC).first()
    assert row.mode_date == "2024-01-01" and row.mean_quantity is None
    assert abs(row.mean_revenue / (1e19 / 52) - 1) < 1e-12
    assert profile(df.where("QuantitySold <> '1e300'"), CSV_SPEC).first().mean_quantity == (100 + 10**12) // 51


def test_exact_quartiles_of_tiny_values_next_to_larger_ones(spark):
    rows = [(k * 1e-28 if k % 2 else k * 1e-12,) for k in range(1, 4000)] + [(1e-4,), (-3.0,), (0.0,)]
    values = sorted(v for v, in rows)
    df = spark.createDataFrame(rows, "x double")
    expected = tuple(values[-(-p * len(values) // 4) - 1] for p in (1, 3))
    assert tuple(quartiles(df, F.col("x"), "exact").first()) == expected


def test_quartiles_of_several_columns_at_once(spark):
    r = random.Random(5)
    rows = [(r.uniform(0, 9), r.choice([None, 1.0, 2.0]), None) for _ in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = {row.measure: (row.q1, row.q3) for row in quartiles_of_each(df, {c: F.col(c) for c in "abc"}).collect()}
    assert found == {c: tuple(at_rank(v, p) for p in (0.25, 0.75)) for c, v in zip("abc", zip(*rows, strict=True), strict=True)}
    assert quartiles_of_each(df.limit(0), {"a": F.col("a")}).collect() == [("a", None, None)]


def test_last_pass_of_exact_quartiles_sees_few_values(spark):
    """400,000 different values far below the largest one: the slices the quartiles lie in hold a handful of them."""
    from sales_engine.operators.quartiles import _band, _slice

    df = spark.range(400_000).select((F.col("id") * 2.5e-14 + 1e-28).alias("x")).unionAll(spark.sql("select 1e-4d"))
    values = df.withColumn("band", _band(F.col("x")))
    ends = values.groupBy("band").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    per_slice = values.join(ends, "band").groupBy("band", _slice(F.col("x"))).count()
    assert per_slice.agg(F.max("count")).first()[0] <= 4
    assert tuple(quartiles(df, F.col("x")).first()) == (100_000 * 2.5e-14 + 1e-28, 300_000 * 2.5e-14 + 1e-28)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_sketches_are_merged_in_levels(spark, levels):
    """Each level is a shuffle by a wider group of tasks; the last one merges what the top level left."""
    values = spark.range(0, 5000, 1, 200).select(F.col("id").cast("double").alias("x"))
    sketch = quantile_sketch(values, "x", 10000, levels)
    plan = sketch._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == levels + 1 and "percentile" not in plan
    groups = values.select(F.shiftright(F.spark_partition_id(), 6)).distinct().count()
    assert groups == 4  # of 200 tasks: no group holds more than 64
    assert tuple(quantiles_of(sketch, {"q1": 0.25, "q3": 0.75}).first()) == (1249.0, 3749.0)


def test_coarser_sketches_are_smaller_and_stay_within_their_error(spark):
    assert [kll_size(a) for a in (1, 100, 10000)] == [200, 415, 65535]
    n = 300_000
    values = spark.range(0, n, 1, 20).select(((F.col("id") * 7919) % n).cast("double").alias("x"))
    sketch = quantile_sketch(values, "x", 500)
    assert sketch.select(F.octet_length("sketch")).first()[0] < 100_000
    for p, x in zip((0.1, 0.5, 0.9), quantiles_of(sketch, {"a": 0.1, "b": 0.5, "c": 0.9}).first()):
        assert abs(x - p * n) < 3 * n / 500


SKEWED = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 97 = 0 THEN '' ELSE cast(id AS string) END AS x"


def test_mode_by_candidates_shuffles_few_rows_of_a_skewed_key(spark, tmp_path):
    """A third of the rows share a key, the others are unique: only candidates are counted, and the full count is dropped."""
    spark.range(0, 200_000, 1, 8).selectExpr(SKEWED).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = mode_by_candidates(df, "x", ("",))
    plan = plan_of(found)
    assert plan.count("FileScan") == 2 and "LeftAnti" not in plan
    assert found.collect() == mode_of(df, "x", ("",)).collect() == [("hot", 66667)]


@pytest.mark.parametrize("rows", [[], [None, None, ""], ["b", "a", "a", "b", "c"], [str(i) for i in range(9000)], [str(i % 4000) for i in range(9000)]])
def test_mode_by_candidates_is_the_mode(spark, rows):
    df = spark.createDataFrame([(r,) for r in rows], "x string").repartition(3)
    for items in (16, 3072):
        assert mode_by_candidates(df, "x", ("",), items).collect() == mode_of(df, "x", ("",)).collect()
