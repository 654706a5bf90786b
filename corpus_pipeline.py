"""The corpus pipeline: operators of ``sales_engine.llm`` one after the other, each on what the last one kept.

A stage takes and returns the columns of ``documents``; the last returns the pieces of the packed documents.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sales_engine.llm import toxicity
from sales_engine.llm.exact import with_copies
from sales_engine.llm.packing import pack
from sales_engine.llm.repeats import remove_repeats
from sales_engine.llm.simhash import near_components
from sales_engine.llm.tables import delete, noting
from sales_engine.llm.vocabularies import byte_bpe
from sales_engine.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_used: dict[tuple, list[str]] = {}
_run: ContextVar[str] = ContextVar("run", default="")


def stage(function: Stage) -> Stage:
    """The stage, which first deletes the tables that the stage before it made for itself: its result is written.

    The stage before it is the one called last in the same ``run``; outside of any, in the same thread on the same path,
    so stages that are called by hand have to be written one by one before the next is called.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        here = (spark.sparkContext.applicationId, sf_dir, _run.get() or threading.get_ident())
        delete(spark, _used.pop(here, []))
        with noting() as paths:
            kept = function(spark, docs, sf_dir)
        _used[here] = paths
        return kept

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted to be toxic; the lexicon is learned from the labelled ones among them."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id."""
    return with_copies(docs).where("kept").select(docs.columns)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked the one with the smallest doc_id."""
    return near_components(docs, shingle=3, bits=2).where("component_keeper").select(docs.columns)


#: Shorter strings than the operator's own 400 bytes, since a passage of 51 words may have fewer: a run that such strings
#: cover goes if it has more than 50 words.
REPEAT_BYTES, REPEAT_WORDS = 200, 51


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of over 50 words in strings that occur twice; ``n_chars`` follows the text."""
    cut = remove_repeats(docs, length=REPEAT_BYTES, least_words=REPEAT_WORDS)
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("bigint")
    return cut.withColumn("n_chars", n_chars).select(docs.columns)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of up to 2048 tokens."""
    return pack(docs, byte_bpe())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: No SQL expresses these stages; ``tests/llm/test_pipeline.py`` holds each against a plain version of it on planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again; only the last one's table stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), ""
    token = _run.set(uuid.uuid4().hex)
    try:
        for name, stage in STAGES:
            path = scratch_dir(spark, name.replace(" ", "-"))
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            delete(spark, [before] if before else [])
            before = path
        delete(spark, _used.pop((spark.sparkContext.applicationId, sf_dir, _run.get()), []))
    finally:
        _run.reset(token)
    return docs
