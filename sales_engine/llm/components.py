"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sales_engine.llm.tables import written


def smallest_members(links: DataFrame) -> DataFrame:
    """``node, root``: every node of the links ``a, b`` (longs, not null) with the smallest node it can reach.

    Each round a node takes the smallest label around it, then the label of its label, so paths shorten by half
    or more. A round is three equality joins or sums over written tables: a centre of many links is summed in
    parts, and a root that many nodes name is a key that Spark can split. The driver sees one number a round.
    """
    both = links.where("a <> b").select("a", "b")
    both = written(both.unionAll(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    state = written(both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")), "labels")
    while True:
        heard = both.join(state, both.a == state.node).groupBy("b").agg(F.min("root").alias("heard"))
        hooked = written(
            state.join(heard, state.node == heard.b).select("node", F.col("root").alias("old"), F.least("root", "heard").alias("root")),
            "labels",
        )
        target = hooked.select(F.col("node").alias("root"), F.col("root").alias("next"))
        state = written(hooked.join(target, "root").select("node", "old", F.col("next").alias("root")), "labels")
        if state.where("root <> old").isEmpty():
            return state.select("node", "root")
        state = state.select("node", "root")
