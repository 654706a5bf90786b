"""Compaction that adds up: only landed batches that no earlier run has taken, by one commit a run.

A landing folder holds ``run=<id>/batch_id=<n>`` folders. The compacted folder holds a data folder a run of this job,
and a log whose last state lists the data folders and, for each landing run, which batches are in them.
"""

from __future__ import annotations

import uuid
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sales_engine.sources.files import write_json
from sales_engine.sources.storage import CommitLog, Storage

Spans = list[list[int]]


def spans(numbers: list[int]) -> Spans:
    """Ascending runs ``[first, last]`` of consecutive numbers."""
    out: Spans = []
    for n in sorted(set(numbers)):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


def joined(one: Spans, two: Spans) -> Spans:
    """The numbers of both, as runs; as many steps as there are runs."""
    out: Spans = []
    for first, last in sorted([*one, *two]):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def holds(within: Spans, number: int) -> bool:
    return any(first <= number <= last for first, last in within)


def new_batches(spark: SparkSession, src: str, taken: dict[str, Spans]) -> dict[str, list[int]]:
    """Batches of each run that aren't among the taken ones and were written to the end.

    Folders are listed, files aren't; a batch that is still being written has no success mark yet.
    """
    storage, found = Storage(spark, src), {}
    for folder in storage.folders("run=*/batch_id=*"):
        run, batch = (part.split("=", 1)[1] for part in folder.split("/"))
        if batch.isdigit() and not holds(taken.get(run, []), int(batch)) and storage.exists(f"{folder}/_SUCCESS"):
            found.setdefault(run, []).append(int(batch))
    return {run: sorted(numbers) for run, numbers in found.items()}


def compact_new(
    spark: SparkSession, src: str, dst: str, schema: T.StructType, target_file_bytes: int = 256 * 1024 * 1024
) -> dict[str, list[int]]:
    """Add the batches landed since the last run to ``dst`` as few large files; returns which these were.

    The files are written first and become visible by the commit that also notes their batches. A run that breaks off in
    between leaves a folder that no reader looks at, and the next run takes the same batches again, so nothing is lost or
    doubled; the folder goes once a later commit stands. A batch that is replayed after it was taken has the same rows and stays out.
    """
    log = CommitLog(spark, dst)
    number, state = log.last()
    taken, folders = state.get("batches", {}), state.get("folders", [])
    log.tidy("data-*", folders)
    fresh = new_batches(spark, src, taken)
    if not fresh:
        return {}
    paths = [f"{src.rstrip('/')}/run={run}/batch_id={n}" for run, numbers in sorted(fresh.items()) for n in numbers]
    size = sum(length for path in paths for _, length, _ in Storage(spark, path).files())
    folder = f"data-{number + 1:012d}-{uuid.uuid4().hex[:8]}"
    rows = spark.read.schema(schema).json(paths).coalesce(max(1, ceil(size / target_file_bytes)))
    write_json(rows, f"{log.storage.root}/{folder}", "errorifexists")
    batches = {run: joined(taken.get(run, []), spans(fresh.get(run, []))) for run in {*taken, *fresh}}
    log.commit(number, {"folders": [*folders, folder], "batches": batches})
    return fresh


def read_compacted(spark: SparkSession, dst: str, schema: T.StructType) -> DataFrame:
    """The rows of the last commit; none before the first."""
    log = CommitLog(spark, dst)
    folders = log.last()[1].get("folders", [])
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([f"{log.storage.root}/{folder}" for folder in folders])


def rewrite_compacted(
    spark: SparkSession, dst: str, schema: T.StructType, target_file_bytes: int = 256 * 1024 * 1024
) -> int:
    """Merge the data folders of many runs into one, by one commit; readers that began before still find the old ones.

    The folders that were merged go with the next run of either job. Returns how many there were.
    """
    log = CommitLog(spark, dst)
    number, state = log.last()
    folders = state.get("folders", [])
    if len(folders) < 2:
        return len(folders)
    size = sum(length for folder in folders for _, length, _ in log.storage.files(folder))
    merged = f"data-{number + 1:012d}-{uuid.uuid4().hex[:8]}"
    rows = read_compacted(spark, dst, schema).coalesce(max(1, ceil(size / target_file_bytes)))
    write_json(rows, f"{log.storage.root}/{merged}", "errorifexists")
    log.commit(number, {**state, "folders": [merged]})
    return len(folders)
