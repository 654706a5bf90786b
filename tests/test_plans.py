"""What the physical plans must and must not do."""

import re
from pathlib import Path

import pytest

from checks import catalog, views
from sales_engine.operators.joins import join_dimension
from sales_engine.plans import reports
from sales_engine.plans.clean_jobs import clean_sales
from sales_engine.schemas import STREAM_SPEC
from tests.conftest import plan_of


def count(pattern, plan):
    return len(re.findall(pattern, plan))


@pytest.mark.parametrize("method", ["approx", "exact"])
def test_cleaning_scans_its_source_twice(spark, sf_dir, method):
    """One scan for the profile, one for the de-duplication every later step shares."""
    plan = plan_of(clean_sales(views.sales_stream(spark, sf_dir), STREAM_SPEC, method))
    assert count("FileScan", plan) == 2
    assert "CartesianProduct" not in plan


def test_staged_bounds_reach_the_scan(spark, sf_dir, tmp_path):
    plan = plan_of(clean_sales(views.sales_stream(spark, sf_dir), STREAM_SPEC, staging=str(tmp_path / "s")))
    assert "Exchange" not in plan and "Join" not in plan
    assert re.search(r"PushedFilters: \[.*quantity_sold", plan)


def test_date_filter_reaches_the_scan(spark, sf_dir):
    sales, _ = catalog._tables(spark, sf_dir)
    df = reports.units_on_date(sales, "1998-08-23")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", plan)
    assert {c.split("#")[0] for c in scan.group(1).split(",")} == {"date", "quantity_Sold"}
    assert re.search(r"DataFilters: \[[^\]]*1998-08-23", plan)


@pytest.mark.parametrize("report", [reports.sales_by_day, reports.product_preference, reports.top_product_per_demographic])
def test_fact_is_joined_where_it_lies(spark, sf_dir, report):
    """With a small store table the first shuffle of the fact comes after partial sums."""
    plan = plan_of(report(*catalog._tables(spark, sf_dir)))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("report", [reports.sales_by_day, reports.top_product_per_demographic])
def test_big_store_table_is_not_broadcast(spark, sf_dir, report):
    plan = plan_of(report(*catalog._tables(spark, sf_dir), limit=-1))
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_store_reports_sum_before_they_join(spark, sf_dir):
    plan = plan_of(reports.revenue_by_location(*catalog._tables(spark, sf_dir)))
    join, partial = plan.index("Join"), plan.rindex("HashAggregate(keys=[store_ID")
    assert join < partial  # the plan is printed from the result down


def test_top_per_group_is_cut_before_the_shuffle(spark, sf_dir):
    plan = plan_of(reports.top_product_per_demographic(*catalog._tables(spark, sf_dir)))
    assert count(r"WindowGroupLimit .*Partial", plan) == 1


def test_top_per_group_compares_doubles_first(spark, sf_dir):
    """Decimals of 38 digits are slow to compare and decide only where the doubles are equal."""
    plan = plan_of(reports.top_product_per_demographic(*catalog._tables(spark, sf_dir)))
    assert re.search(r"Sort \[demographics#\S+ ASC NULLS FIRST, cast\(total_revenue#\S+ as double\) DESC|Sort \[demographics#\S+ ASC NULLS FIRST, _w\S+ DESC", plan)


def test_top_per_group_keeps_the_exact_winner(spark):
    """Totals that only differ beyond a double's digits, a tie, a group without a key and one without revenue."""
    sales = spark.createDataFrame(
        [(1, "a", 9e14), (1, "a", 0.25), (1, "b", 9e14), (1, "b", 0.250001), (2, "d", 5.0), (2, "c", 5.0), (3, "e", 1.0), (4, "f", None)],
        "store_ID int, product_ID string, revenue double",
    )
    stores = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "z")], "store_ID int, demographics string")
    for limit in (64 << 20, -1):
        got = reports.top_product_per_demographic(sales, stores, limit).collect()
        assert {(r.demographics, r.product_ID) for r in got} == {("x", "b"), ("y", "c"), (None, "e"), ("z", "f")}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES)))
def test_no_python_in_the_plan(spark, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|MapInPandas|FlatMapGroups|BatchEval", plan)


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_filters_reach_the_fact_scan_on_both_branches(spark, sf_dir, limit):
    joined = join_dimension(*catalog._tables(spark, sf_dir), "store_ID", limit)
    plan = plan_of(joined.where("revenue > 10"))
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(store_ID\)[^\]]*GreaterThan\(revenue,10.0\)|PushedFilters: \[[^\]]*GreaterThan\(revenue,10.0\)[^\]]*IsNotNull\(store_ID\)", plan)


def test_build_leaves_only_its_tables(spark, sf_dir):
    catalog._tables(spark, sf_dir)
    assert {p.name for p in Path(list(catalog._built.values())[-1]).iterdir()} == {"sales", "stores"}
