"""Tables of the subpackage's operators in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from sales_engine import session
from sales_engine.session import scratch_dir

_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: made once, without lineage, for any executor to read again."""
    path = scratch_dir(df.sparkSession, label)
    if (paths := _noted.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def noting() -> Iterator[list[str]]:
    """Collects the paths of the tables that are written within, so that they can be deleted after use."""
    token = _noted.set([])
    try:
        yield _noted.get()
    finally:
        _noted.reset(token)


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing will read again."""
    for path in paths:
        session.delete(spark, path)
