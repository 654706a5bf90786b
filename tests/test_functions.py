import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sales_engine.functions.dates import epoch_ms_to_ts, season, to_ts
from sales_engine.functions.geo import continent, parse_lat_lon
from sales_engine.functions.numbers import exact_sum, to_int, to_number
from sales_engine.functions.validity import is_invalid


def values(spark, schema, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {schema}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_to_number(spark, ansi):
    texts = ["12.5", " 7 ", "-3", "60_err", "", None, "NaN", "Infinity", "1e3"]
    assert values(spark, "string", texts, to_number) == [12.5, 7.0, -3.0, None, None, None, None, None, 1000.0]


def test_to_int_truncates(spark, ansi):
    texts = ["60", "60.5", "-1.9", "9999999999", "4_err", None]
    assert values(spark, "string", texts, to_int) == [60, 60, -1, None, None, None]


def test_is_invalid_is_never_null(spark, ansi):
    assert values(spark, "string", ["", None, "X", "5"], lambda c: is_invalid(c, ["", "X"])) == [
        True, True, True, False,
    ]
    assert values(spark, "bigint", [None, 5], lambda c: is_invalid(c, ["", "X"])) == [True, False]


@pytest.mark.parametrize("seed", range(3))
def test_exact_sum_is_exact_in_any_order(spark, seed):
    rnd = random.Random(seed)
    cents = [rnd.randint(-10_000_000, 10_000_000) for _ in range(2000)]
    rows = [(c / 100,) for c in cents]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "x double").repartition(7)
    assert df.agg(exact_sum(F.col("x"))).first()[0] == Decimal(sum(cents)) / 100


def test_exact_sum_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(exact_sum(F.col("x"))).first()[0] is None


def test_epoch_ms(spark, ansi):
    texts = ["1704068081845", "0", "x", None, "1704068081845_err"]
    assert values(spark, "string", texts, epoch_ms_to_ts) == [
        dt.datetime(2024, 1, 1, 0, 14, 41, 845000), dt.datetime(1970, 1, 1), None, None, None,
    ]


def test_to_ts(spark, ansi):
    assert values(spark, "string", ["2024-05-26", "2024-05-26_err", "DATE_ERROR", None], to_ts) == [
        dt.datetime(2024, 5, 26), None, None, None,
    ]


def test_seasons(spark):
    dates = [dt.date(2024, m, 1) for m in range(1, 13)] + [None]
    winter, spring, summer, autumn = "Invierno", "Primavera", "Verano", "Otoño"
    assert values(spark, "date", dates, season) == [
        winter, winter, spring, spring, spring, summer, summer, summer, autumn, autumn, autumn, winter, winter,
    ]


def test_iso_week_of_late_december(spark):
    assert values(spark, "date", [dt.date(2024, 12, 30)], F.weekofyear) == [1]


def test_parse_lat_lon(spark, ansi):
    texts = ["(10.5, -20.25)", "abcde", None, "(,)", "(1.5", "(x, 3)", "(37.5,25)"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    lat, lon = parse_lat_lon(F.col("t"))
    assert [tuple(r) for r in df.orderBy("i").select(lat, lon).collect()] == [
        (10.5, -20.25), (None, None), (None, None), (None, None), (1.5, None), (None, 3.0), (37.5, 25.0),
    ]


@pytest.mark.parametrize(
    "lat, lon, name",
    [
        (7.0, -50.0, "North America"),  # on an edge
        (10.0, -60.0, "North America"),  # also in the South America box, which comes later
        (6.9, -60.0, "South America"),
        (36.0, 20.0, "Europe"),  # also Africa
        (37.5, 56.0, "Europe"),
        (34.9, 20.0, "Africa"),
        (37.5, 70.0, "Asia"),
        (5.0, 120.0, "Asia"),  # also Oceania
        (-5.0, 120.0, "Oceania"),
        (-80.0, 0.0, "Unknown"),
        (None, 10.0, "Unknown"),
        (10.0, None, "Unknown"),
    ],
)
def test_continent(spark, lat, lon, name):
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    assert df.select(continent(F.col("lat"), F.col("lon"))).first()[0] == name


def test_exact_sum_of_small_and_huge_values(spark, ansi):
    df = spark.createDataFrame([(1e-7,)] * 10 + [(1e19,), (1e19,), (-0.5,)], "x double")
    assert df.agg(exact_sum(F.col("x"), 12)).first()[0] == Decimal("19999999999999999999.500001")
    assert df.where("x < 1").agg(exact_sum(F.col("x"), 12)).first()[0] == Decimal("-0.499999")
    beyond = spark.createDataFrame([(1e300,), (1.0,)], "x double")
    assert beyond.agg(exact_sum(F.col("x"))).first()[0] is None


@pytest.mark.parametrize("scale", [6, 12])
def test_exact_sum_of_whole_hundredths_and_others(spark, ansi, scale):
    rnd = random.Random(scale)
    texts = ["0.01", "0.29", "-1.15", "9000000", "9000000.01", "-8999999.99", "0.005", "1e-7", "123456789012.34", "-0.0", "0.0000005"]
    texts += [f"{rnd.randint(-(10**10), 10**10) / 100:.2f}" for _ in range(500)] + [f"{rnd.uniform(-5, 5):.5f}" for _ in range(500)]
    df = spark.createDataFrame([(float(t),) for t in texts], "x double").repartition(5)
    unit = Decimal(1).scaleb(-scale)
    wanted = sum(Decimal(repr(float(t))).quantize(unit, "ROUND_HALF_UP") for t in texts)
    assert df.agg(exact_sum(F.col("x"), scale)).first()[0] == wanted
    cents = df.where("x = 0.01 OR x = 0.29")
    assert cents.agg(exact_sum(F.col("x"), scale)).first()[0] == Decimal("0.3")


def test_to_int_takes_plain_decimals_only(spark, ansi):
    assert values(spark, "string", ["12d", "1e3", " 7 ", "+5.", ".5", "0x1"], to_int) == [None, None, 7, 5, 0, None]
    assert values(spark, "double", [1e7, 2.5], to_int) == [10_000_000, 2]
