"""Every registered query against its SQL twin, run by another engine on the same files."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from checks import catalog, sql, views
from checks.compare import difference
from sales_engine.session import shared_dir
from sales_engine.streaming.sales_stream import decode

ORACLE = {name: query for name, query in driver.oracle_sql().items() if name in catalog.QUERIES}
QUERIES = driver.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(sql.QUERIES) == set(catalog.QUERIES)


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"location", "total_revenue"}


def test_every_share_of_the_topic_is_written_by_the_tasks_that_read_it(spark, tmp_path):
    """No task takes a whole share; rows that are equal and one that lacks most fields arrive as often as they were sent."""
    events = spark.range(4000).selectExpr(
        "id AS event_id", "id % 50 AS user_id", "timestamp'2024-01-01 00:00:00' AS ts", "cast(id % 7 AS double) AS value",
        "concat('{\"k\": ', id % 9, '}') AS props",
    )
    events.unionAll(events.where("event_id < 100")).repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    before = set(Path(shared_dir(spark)).glob("topic-*"))
    got = catalog.stream_stop_restart(spark, str(tmp_path))
    sent = decode(views.messages(spark, str(tmp_path)))
    assert got.count() == 4100 and got.exceptAll(sent).isEmpty() and sent.exceptAll(got).isEmpty()
    (topic,) = set(Path(shared_dir(spark)).glob("topic-*")) - before
    tasks = views.messages(spark, str(tmp_path)).rdd.getNumPartitions()
    assert tasks > 1 and len([f for f in topic.glob("part-*") if f.stat().st_size]) == 6 * tasks
