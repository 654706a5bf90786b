"""Files in and out: delimited text, JSON lines, landing and compaction."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """Delimited files with a header (directory, file or glob).

    Without a schema the first file's header names the columns and all of them are
    text; with one, no header has to be read up front. A file whose header has
    other columns or another order fails the read. Empty fields are NULL either way.
    """
    # columns are matched by position, so a file with another header than the first one's, or the schema, must not pass
    reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
    return (reader if schema is None else reader.schema(schema)).csv(path)


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",", **options: str) -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).options(**options).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines. Give the schema: inference reads everything twice and loses columns that are NULL throughout."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def land_csv(spark: SparkSession, src: str, dst: str, schema: T.StructType | None = None) -> None:
    """Copy raw delimited files into the landing zone unchanged, replacing what is there."""
    write_delimited(read_delimited(spark, src, schema), dst)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under a directory, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def compact(
    spark: SparkSession,
    src: str,
    dst: str,
    schema: T.StructType | None = None,
    target_file_bytes: int = 256 * 1024 * 1024,
    files: int | None = None,
    drop: tuple[str, ...] = (),
) -> int:
    """Rewrite many small JSON files as few large ones in another directory; returns the file count asked for.

    Scan partitions are merged without a shuffle, each task writing about
    ``target_file_bytes``; ``files=1`` gives a single file.
    """
    inside, outside = src.rstrip("/") + "/", dst.rstrip("/") + "/"
    if inside.startswith(outside) or outside.startswith(inside):
        raise ValueError("compaction needs a target outside its source")
    count = files or max(1, ceil(stored_bytes(spark, src) / target_file_bytes))
    write_json(read_json(spark, src, schema).drop(*drop).coalesce(count), dst)
    return count
