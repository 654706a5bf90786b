"""The whole cleaning pipeline against a plain-Python one on random dirty rows."""

import datetime as dt
import random
from collections import Counter
from math import ceil

import pytest
from pyspark.sql import functions as F

from sales_engine.plans.clean_jobs import clean_sales, clean_stores
from sales_engine.schemas import (
    CSV_SALES, CSV_SENTINELS, CSV_SPEC, DB_SALES, DB_SPEC, STORES_EXPORT, STREAM_SALES, STREAM_SPEC,
)

LOAD_TS = "2025-01-01 00:00:00"


def dirty_rows(seed, n=400):
    rnd = random.Random(seed)

    def spoil(value, sentinel):
        kind = rnd.random()
        if kind < 0.04:
            return None
        if kind < 0.08:
            return sentinel
        if kind < 0.12:
            return f"{value}_err"
        return str(value)

    rows = [
        (
            spoil(dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 20)), "DATE_ERROR"),
            spoil(rnd.randint(1, 9), "STORE_ERROR"),
            spoil(f"p{rnd.randint(1, 5)}", "PRODUCT_ERROR"),
            spoil(900 if rnd.random() < 0.03 else rnd.randint(1, 9), "QUANTITY_ERROR"),
            spoil(9999.5 if rnd.random() < 0.03 else rnd.randint(4, 40) / 4, "REVENUE_ERROR"),
        )
        for _ in range(n)
    ]
    return rows + rnd.sample(rows, n // 5)


def number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def expected(rows):
    bad = lambda v: v is None or v in CSV_SENTINELS
    counts = Counter(r[0] for r in rows if not bad(r[0]))
    mode = min(counts, key=lambda d: (-counts[d], d))
    known = [[v for v in (number(r[i]) for r in rows) if v is not None] for i in (3, 4)]
    quantity, revenue = (sum(k) / len(k) for k in known)
    fills = {0: mode, 3: str(int(quantity)), 4: repr(revenue)}
    unique = {
        tuple(fills[i] if i in fills and bad(v) else v for i, v in enumerate(r))
        + (any(bad(r[i]) for i in (0, 3, 4)),)
        for r in rows
        if not bad(r[1]) and not bad(r[2])
    }
    for i in (3, 4):
        ordered = sorted(v for v in (number(r[i]) for r in unique) if v is not None)
        q1, q3 = (ordered[ceil(p * len(ordered)) - 1] for p in (0.25, 0.75))
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        unique = {r for r in unique if number(r[i]) is not None and low <= number(r[i]) <= high}

    def day(text):
        return dt.datetime.fromisoformat(text) if len(text) == 10 else None

    return sorted(
        (
            (day(d), int(s) if s.isdigit() else None, p, int(number(q)), number(r), flag)
            for d, s, p, q, r, flag in unique
        ),
        key=repr,
    )


def result(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_python(spark, seed):
    rows = dirty_rows(seed)
    raw = spark.createDataFrame(rows, CSV_SALES).repartition(5)
    assert result(clean_sales(raw, CSV_SPEC, "exact", LOAD_TS)) == expected(rows)


def test_small_inputs_give_the_same_with_the_sketch(spark):
    rows = dirty_rows(7)
    raw = spark.createDataFrame(rows, CSV_SALES)
    assert result(clean_sales(raw, CSV_SPEC, "approx", LOAD_TS)) == expected(rows)


def test_staged_ansi_and_channel_names_do_not_matter(spark, ansi, tmp_path):
    rows = dirty_rows(11)
    want = expected(rows)
    staged = clean_sales(spark.createDataFrame(rows, CSV_SALES), CSV_SPEC, "exact", LOAD_TS, str(tmp_path / "s"))
    assert result(staged) == want
    assert result(clean_sales(spark.createDataFrame(rows, DB_SALES), DB_SPEC, "exact", LOAD_TS)) == want


@pytest.mark.parametrize("method", ["approx", "exact"])
@pytest.mark.parametrize("staged", [False, True], ids=["lazy", "staged"])
def test_empty_and_all_invalid_inputs_give_no_rows(spark, ansi, method, staged, tmp_path):
    for n, rows in enumerate(([], [(None, "1", "p", "", "x_err")] * 3, [("2024-01-01", "", None, "1", "1")])):
        staging = str(tmp_path / str(n)) if staged else None
        out = clean_sales(spark.createDataFrame(rows, CSV_SALES), CSV_SPEC, method, staging=staging)
        assert out.count() == 0
        assert out.columns == [*CSV_SALES.names, "Processed", "Insert_Date"]


def test_output_types(spark, ansi):
    raw = spark.createDataFrame([("1704068081845", 3, "p", 2, 5.0), (None, 3, "q", None, None)], STREAM_SALES)
    out = clean_sales(raw, STREAM_SPEC)
    assert dict(out.dtypes) == {
        "timestamp": "timestamp", "store_id": "int", "product_id": "string", "quantity_sold": "int",
        "revenue": "double", "Processed": "boolean", "Insertion_Date": "timestamp",
    }
    at = dt.datetime(2024, 1, 1, 0, 14, 41, 845000)
    assert result(out) == [(at, 3, "p", 2, 5.0, False), (at, 3, "q", 2, 5.0, True)]


def test_stores_check_only_the_key_unless_asked(spark, ansi):
    rows = [
        ("1", "n", "NULL", ""), ("1", "n", "NULL", ""), ("", "n", "l", "d"), ("2", "ERROR", None, "d"),
        ("3x", "n", "l", "d"),
    ]
    df = spark.createDataFrame(rows, STORES_EXPORT)
    assert sorted((r[:4] for r in map(tuple, clean_stores(df).collect())), key=repr) == [
        (1, "n", "NULL", ""), (2, "ERROR", None, "d"), (None, "n", "l", "d"),
    ]
    strict = clean_stores(df, extra_required=("location", "demographics"))
    assert [r.store_code for r in strict.collect()] == [None]


def test_a_row_on_a_third_of_the_table_comes_out_once(spark):
    one = zip(CSV_SALES.names, ("2024-01-01", "1", "p", "3", "5"))
    hot = spark.range(30_000).select(*[F.lit(v).alias(c) for c, v in one])
    cold = spark.range(60_000).select(
        F.lit("2024-01-02").alias("Date"), F.lit("2").alias("StoreID"), F.col("id").cast("string").alias("ProductID"),
        F.lit("3").alias("QuantitySold"), F.lit("5").alias("Revenue"),
    )
    out = clean_sales(hot.unionAll(cold), CSV_SPEC, "exact")
    assert out.count() == 60_001


def test_columns_may_come_in_any_order_and_case(spark):
    rows = dirty_rows(3)
    raw = spark.createDataFrame(rows, CSV_SALES)
    mixed = raw.select("Revenue", "QuantitySold", "ProductID", "StoreID", "Date").toDF(
        "REVENUE", "quantitysold", "ProductID", "storeid", "date"
    )
    out = clean_sales(mixed, CSV_SPEC, "exact", LOAD_TS).select(*CSV_SALES.names, "Processed")
    assert result(out) == expected(rows)
