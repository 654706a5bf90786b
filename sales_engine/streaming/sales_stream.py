"""The sales message stream: source, decoding, repeatable landing, orderly stop and the repair of gaps."""

from __future__ import annotations

import json
import threading
import time
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sales_engine.schemas import STREAM_SALES
from sales_engine.sources.files import read_json
from sales_engine.sources.storage import Storage


def topic_options(
    servers: str,
    topic: str = "sales_stream",
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka source; the last two bound a batch and split a hot topic partition over tasks."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_stream(
    spark: SparkSession,
    source: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Streaming source with a ``value`` column: a topic, or files of one message per line (``text``)."""
    reader = spark.readStream.format(source).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def decode(df: DataFrame, schema: T.StructType = STREAM_SALES) -> DataFrame:
    """JSON in ``value`` -> columns. A bad field is NULL, an unreadable message a row of NULLs."""
    return df.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def land_batch(batch: DataFrame, batch_id: int, dst: str, run: str = "0") -> None:
    """Write one micro-batch as JSON lines under its own run and batch number; nothing for an empty one.

    A batch that is replayed after a failure replaces what its first attempt
    left. Errors are raised, so offsets are only committed for landed rows.
    """
    batch = batch.persist()  # the source is read once for the check and the write
    try:
        if not batch.isEmpty():
            batch.write.mode("overwrite").json(f"{dst.rstrip('/')}/run={run}/batch_id={batch_id}")
    finally:
        batch.unpersist()


def _run_id(batch: DataFrame) -> str:
    """The id of the running query, which its checkpoint keeps."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise RuntimeError("the query id is unknown: landing could overwrite another run's batches")
    return run


def _landing_writer(stream: DataFrame, checkpoint: str, land, interval: str, available_now: bool):
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(land)
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def start_landing(
    stream: DataFrame, dst: str, checkpoint: str, interval: str = "5 seconds", available_now: bool = False
) -> StreamingQuery:
    """Start landing a decoded stream.

    Batch numbers start again with a new checkpoint. The query id is kept in the
    checkpoint, so it names the run: a restart goes on in the same folder, a new
    checkpoint cannot overwrite what an earlier one landed.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, batch_id, dst, _run_id(batch))

    return _landing_writer(stream, checkpoint, land, interval, available_now).start()


def run_until(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for the query, at most ``timeout`` seconds, and stop it; True if it had ended by itself."""
    try:
        return bool(query.awaitTermination(timeout)) if timeout else bool(query.awaitTermination() or True)
    finally:
        query.stop()


class ProgressLog(StreamingQueryListener):
    """What the queries of a session report: batches with their rows and times, idle triggers, and the end.

    Keeps the last ``most`` entries of each kind. Add it with ``spark.streams.addListener``.
    """

    def __init__(self, most: int = 1000):
        self.started: deque = deque(maxlen=most)
        self.batches: deque = deque(maxlen=most)
        self.idle: deque = deque(maxlen=most)
        self.ended: deque = deque(maxlen=most)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.started.append(str(event.id))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        done = event.progress
        self.batches.append((str(done.id), done.batchId, done.numInputRows, dict(done.durationMs)))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self.idle.append(str(event.id))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.append((str(event.id), event.exception))

    def rows_of_batches(self, query_id: str) -> dict[int, int]:
        """Input rows of each reported batch of one query; a batch without rows is there with 0."""
        return {batch: rows for of, batch, rows, _ in self.batches if of == query_id}


class Landing:
    """A running landing that can be stopped between two batches.

    ``StreamingQuery.stop`` interrupts the batch in flight, which then runs again after a restart. ``stop`` here lets it
    end: the batch is written and committed in the checkpoint, and no further one is written. A batch that the query begins
    meanwhile is refused, so its offsets aren't committed and the next run lands it.
    """

    REFUSED = "this batch is left to the next run of the landing"

    def __init__(self, stream: DataFrame, dst: str, checkpoint: str, interval: str = "5 seconds", available_now: bool = False):
        self._lock, self._closing, self._begun = threading.Lock(), False, None
        self._commits = Storage(stream.sparkSession, f"{checkpoint.rstrip('/')}/commits")

        def land(batch: DataFrame, batch_id: int) -> None:
            with self._lock:
                if self._closing:
                    raise RuntimeError(self.REFUSED)
                self._begun = batch_id
            land_batch(batch, batch_id, dst, _run_id(batch))

        self.query = _landing_writer(stream, checkpoint, land, interval, available_now).start()

    def committed(self) -> int | None:
        """The last batch whose end is noted in the checkpoint."""
        numbers = [int(path.rsplit("/", 1)[-1]) for path, _, _ in self._commits.files() if path.rsplit("/", 1)[-1].isdigit()]
        return max(numbers, default=None)

    def stop(self, timeout: float = 600, poll: float = 0.05) -> int | None:
        """Stop after the batch in flight; returns the last committed batch, None before the first.

        A batch that takes longer than ``timeout`` seconds is interrupted after all, and landed again by the next run.
        """
        with self._lock:
            self._closing, begun = True, self._begun
        until = time.monotonic() + timeout
        while begun is not None and self.query.isActive and not self._commits.exists(str(begun)):
            if time.monotonic() > until:
                break
            time.sleep(poll)
        self.query.stop()
        return self.committed()

    def failure(self) -> str | None:
        """What ended the query, unless it is running, was stopped or had refused a batch."""
        ended = self.query.exception()
        return None if ended is None or self.REFUSED in str(ended) else str(ended)


def topic_range_options(
    servers: str, start: dict[int, int], end: dict[int, int], topic: str = "sales_stream", min_partitions: int | None = None
) -> dict[str, str]:
    """Options of a batch read of a topic from the offsets ``start`` to before ``end``, a number for each partition.

    It fails where the topic no longer holds a part of the range, instead of passing over it.
    """
    if start.keys() != end.keys():
        raise ValueError("start and end need the same partitions")
    if any(not 0 <= start[p] <= end[p] for p in start):
        raise ValueError("a range can't end before it starts")
    options = {
        "kafka.bootstrap.servers": servers,
        # only these partitions, so that new ones don't add to a repair
        "assign": json.dumps({topic: sorted(start)}),
        "startingOffsets": json.dumps({topic: {str(p): n for p, n in sorted(start.items())}}),
        "endingOffsets": json.dumps({topic: {str(p): n for p, n in sorted(end.items())}}),
        "failOnDataLoss": "true",
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_range(
    spark: SparkSession, source: str = "kafka", options: dict[str, str] | None = None, path: str | None = None
) -> DataFrame:
    """The same messages as ``read_stream`` gives, as a table: a topic's range of offsets, or files (``text``)."""
    reader = spark.read.format(source).options(**(options or {}))
    return reader.load(path) if path else reader.load()


def land_range(messages: DataFrame, dst: str, name: str, schema: T.StructType = STREAM_SALES) -> None:
    """Land messages that were read again, decoded as the stream does it, as the batch 0 of a run called ``name``.

    Landing the same repair twice replaces it.
    """
    land_batch(decode(messages, schema), 0, dst, name)


#: Offsets are looked at in blocks of so many, each by one task.
_BLOCK_BITS = 16


def missing_offsets(
    positions: DataFrame, start: dict[int, int], end: dict[int, int], partition: str = "partition", offset: str = "offset"
) -> DataFrame:
    """``partition, first, last``: runs of offsets from ``start`` to before ``end`` that no row has; repeated rows don't matter.

    Blocks of 65,536 offsets are counted first; only blocks that lack some are looked at row by row. Blocks without any row
    come from the list of the blocks that there are, never from a list of all offsets.
    """
    spark = positions.sparkSession
    wanted = spark.createDataFrame(
        [(p, start[p], end[p]) for p in sorted(start) if start[p] < end[p]], "part int, low bigint, high bigint"
    )
    rows = positions.select(F.col(partition).alias("part"), F.col(offset).alias("at"))
    rows = rows.join(F.broadcast(wanted), "part").where("at >= low AND at < high").select("part", "low", "high", "at")
    block = F.shiftright("at", _BLOCK_BITS).alias("block")
    blocks = rows.groupBy("part", "low", "high", block).agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.count_distinct("at").alias("n")
    )
    within = W.partitionBy("part", "block").orderBy("at")
    torn = blocks.where("n < last - first + 1").select("part", "block")
    inner = (
        rows.withColumn("block", block)
        .join(torn, ["part", "block"])
        .withColumn("before", F.lag("at").over(within))
        .where("at > before + 1")
        .select("part", (F.col("before") + 1).alias("first"), (F.col("at") - 1).alias("last"))
    )
    in_order = W.partitionBy("part").orderBy("block")
    between = blocks.select(
        "part", F.coalesce(F.lag("last").over(in_order) + 1, "low").alias("from"), (F.col("first") - 1).alias("to")
    ).where("to >= from")
    tail = wanted.join(blocks.groupBy("part").agg(F.max("last").alias("last")), "part", "left").select(
        "part", F.coalesce(F.col("last") + 1, "low").alias("from"), (F.col("high") - 1).alias("to")
    ).where("to >= from")
    found = inner.unionAll(between).unionAll(tail)
    return found.select(F.col("part").alias("partition"), "first", "last")


def read_landed(spark: SparkSession, path: str, schema: T.StructType = STREAM_SALES) -> DataFrame:
    """All landed batches as one table, without the run and batch numbers."""
    return read_json(spark, path, schema).drop("run", "batch_id")
