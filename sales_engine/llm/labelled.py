"""Labelled texts for training: which rows may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sales_engine.llm.arrow import quoted

FOLDS = 5


def is_held_out(key: Column) -> Column:
    """True for the fifth of all rows that nothing is learned from: CRC-32 of the key as text (null: empty)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``text, label`` of at most ``rows`` labelled rows that aren't held out, in one partition, in a fixed order.

    The sample is that of the least hashes of the key. ``rows`` bounds what is broadcast and what one task reads;
    it is a parameter of the classifiers. Labels that are null don't count; of several for a key the largest does.
    """
    known = labels.where(quoted(label).isNotNull() & quoted(key).isNotNull()).groupBy(quoted(key).alias("key"))
    known = known.agg(F.max(quoted(label)).cast("int").alias("label"))
    order = [F.xxhash64("key"), F.col("key")]
    sample = known.where(~is_held_out(F.col("key"))).orderBy(*order).limit(rows)
    texts = docs.select(quoted(key).alias("key"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(sample), "key").withColumn("order", F.xxhash64("key", "text"))
    return joined.repartition(1).sortWithinPartitions("order", "key").select("text", "label")
