"""Session settings, the shared scratch folder and reliable checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, SparkSession


def object_store_conf(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    max_connections: int = 100,
) -> dict[str, str]:
    """Hadoop settings for an S3-compatible store; keys come from the caller, never from code."""
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.maximum": str(max_connections),
        "spark.hadoop.fs.s3a.fast.upload.buffer": "bytebuffer",
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings the jobs rely on; anything in ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``, or the checkpoint folder set on the context.

    Where neither is set, a run in one process gets a temporary folder; on a cluster, a local
    one included, that would be a machine-local path, so it is refused.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if not re.match(r"local($|\[)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="sales-engine-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing will read again, on whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Scan and shuffle partition counts for an input of this size; the former settings return at the end.

    Adaptive execution merges shuffle partitions that turn out small but never
    splits a plain one, so the starting number has to suit the largest shuffle,
    the de-duplication, which moves about as much as the input holds. Neither count
    has a ceiling: a partition stays at 256 MB, and scan splits grow so that there are at
    most 100,000 of them, which keeps the number of shuffle blocks down.
    """
    mb = 1024 * 1024
    scan = max(input_bytes // 100_000, 128 * mb)
    shuffles = max(ceil(input_bytes / (256 * mb)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffles),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute once, keep the rows in reliable storage, drop the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
