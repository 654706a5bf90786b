"""The thirteen business reports.

``sales`` and ``stores`` have the conformed layouts. Reports by store attributes
add the fact up per store before they join, so the join sees one row per store.
Reports by calendar period or product join first when the store side is small
enough to broadcast, and pre-aggregate per store otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sales_engine.functions.dates import season
from sales_engine.functions.geo import continent, parse_lat_lon
from sales_engine.functions.numbers import exact_sum
from sales_engine.operators.joins import BROADCAST_BYTES, fits_broadcast, join_dimension
from sales_engine.operators.rank import top_n_per_group, top_with_ties
from sales_engine.session import checkpointed


def _store_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("store_ID").agg(exact_sum(F.col("revenue")).alias("total_revenue"))


def _revenue_by(sales: DataFrame, stores: DataFrame, attribute: str) -> DataFrame:
    """Exact revenue per store attribute; a hot store is one row by the time it is joined."""
    return (
        _store_revenue(sales)
        .join(stores.select("store_ID", attribute), "store_ID")
        .groupBy(attribute)
        .agg(F.sum("total_revenue").alias("total_revenue"))
    )


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def top_store(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Store(s) with the largest revenue, ties kept, with their attributes."""
    totals = _revenue_by(sales, stores.select("store_ID", F.col("store_ID").alias("id")), "id")
    best = top_with_ties(totals.withColumnRenamed("id", "store_ID"), "total_revenue")
    return _as_double(best.join(stores, "store_ID"), "total_revenue").select(
        "store_ID", "total_revenue", "store_name", "location", "demographics"
    )


def units_on_date(sales: DataFrame, date: str) -> DataFrame:
    """Units sold at midnight of ``yyyy-MM-dd``; sales with a time of day do not match."""
    instant = F.to_timestamp(F.lit(date), "yyyy-MM-dd")
    return sales.where(F.col("date") == instant).groupBy("date").agg(F.sum("quantity_Sold").alias("total_sold"))


def top_product_sales(sales: DataFrame) -> DataFrame:
    """Every sale of the best-selling product(s).

    The winners are computed once and checkpointed; their number decides how the
    fact is joined, since nothing but the data bounds the number of ties.
    """
    totals = sales.groupBy("product_ID").agg(F.sum("quantity_Sold").alias("total_sold"))
    winners = checkpointed(top_with_ties(totals, "total_sold"))
    rest = [c for c in sales.columns if c != "product_ID"]
    found = join_dimension(sales, winners, "product_ID")
    return found.select("product_ID", "total_sold", *rest)


def revenue_by_location(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per location, largest first."""
    totals = _revenue_by(sales, stores, "location")
    return _as_double(totals.orderBy(F.desc("total_revenue"), "location"), "total_revenue")


def top_location(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Location(s) with the largest revenue and all their stores."""
    best = top_with_ties(_revenue_by(sales, stores, "location"), "total_revenue")
    return _as_double(best.join(stores, "location"), "total_revenue").select(
        "location", "total_revenue", "store_ID", "store_name", "demographics"
    )


def revenue_by_continent(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per continent of the store's coordinates, continents in descending order."""
    located = stores.select(
        "store_ID", continent(*parse_lat_lon(F.col("demographics"))).alias("continent")
    )
    totals = _revenue_by(sales, located, "continent")
    return _as_double(totals.orderBy(F.desc("continent")), "total_revenue")


def revenue_by_demographic(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per demographic group, largest first."""
    totals = _revenue_by(sales, stores, "demographics")
    return _as_double(totals.orderBy(F.desc("total_revenue"), "demographics"), "total_revenue")


def _by_period(
    sales: DataFrame, stores: DataFrame, name: str, period: Column, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Revenue and units of the sales of known stores per calendar period."""
    facts = sales.select("store_ID", period.alias(name), "revenue", "quantity_Sold")
    known = stores.select("store_ID")
    sums = (exact_sum(F.col("revenue")).alias("total_revenue"), F.sum("quantity_Sold").alias("total_quantity_sold"))
    if fits_broadcast(known, limit):
        totals = facts.join(F.broadcast(known), "store_ID").groupBy(name).agg(*sums)
    else:
        # a hot store is down to one row per period here, so its key needs no salt
        per_store = facts.groupBy("store_ID", name).agg(*sums)
        totals = (
            per_store.join(known.hint("shuffle_merge"), "store_ID")
            .groupBy(name)
            .agg(*[F.sum(c).alias(c) for c in ("total_revenue", "total_quantity_sold")])
        )
    return _as_double(totals, "total_revenue")


def sales_by_day(sales: DataFrame, stores: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    return _by_period(sales, stores, "date_only", F.to_date("date"), limit)


def sales_by_week(sales: DataFrame, stores: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """By ISO week number; the same week of different years is one group."""
    return _by_period(sales, stores, "week_of_year", F.weekofyear("date"), limit)


def sales_by_month(sales: DataFrame, stores: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """By month number; the same month of different years is one group."""
    return _by_period(sales, stores, "month", F.month("date"), limit)


def sales_by_season(sales: DataFrame, stores: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """By season; sales without a date count as winter."""
    return _by_period(sales, stores, "season", season(F.col("date")), limit)


def _demographic_products(
    sales: DataFrame, stores: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    groups = stores.select("store_ID", "demographics")
    facts = sales.select("store_ID", "product_ID", "revenue")
    revenue = exact_sum(F.col("revenue"))
    if fits_broadcast(groups, limit):
        joined = facts.join(F.broadcast(groups), "store_ID")
    else:
        # down to one row per store and product; what skew is left, adaptive execution splits
        facts = facts.groupBy("store_ID", "product_ID").agg(revenue.alias("revenue"))
        joined = facts.join(groups.hint("shuffle_merge"), "store_ID")
        revenue = F.sum("revenue")
    return joined.groupBy("demographics", "product_ID").agg(revenue.alias("total_revenue"))


def product_preference(sales: DataFrame, stores: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Revenue per product within each demographic group, best first."""
    totals = _demographic_products(sales, stores, limit)
    return _as_double(totals.orderBy("demographics", F.desc("total_revenue"), "product_ID"), "total_revenue")


def top_product_per_demographic(
    sales: DataFrame, stores: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """The product with the largest revenue in each demographic group; the smaller name wins a tie."""
    totals = _demographic_products(sales, stores, limit)
    # doubles are compared faster than decimals, which decide where these are equal
    order = [F.col("total_revenue").cast("double").desc(), F.desc("total_revenue"), F.asc("product_ID")]
    return _as_double(top_n_per_group(totals, ["demographics"], order), "total_revenue")
