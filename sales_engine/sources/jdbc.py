"""Relational tables in and out, and the table snapshot."""

from __future__ import annotations

import datetime as dt
import decimal
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sales_engine.sources.files import read_delimited, write_delimited
from sales_engine.sources.storage import CommitLog

#: Column that tells the rows of a load apart while they are staged.
LOAD_ROW = "load_row"


def connection(
    url: str, driver: str | None = None, user: str | None = None, password: str | None = None
) -> dict[str, str]:
    given = {"url": url, "driver": driver, "user": user, "password": password}
    return {k: v for k, v in given.items() if v is not None}


# -- extract ---------------------------------------------------------------


def bounds_query(table: str, column: str) -> str:
    return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"


def partition_options(column: str, low: int, high: int, partitions: int) -> dict[str, str]:
    """Split a table read into ``partitions`` ranges of an integer column; rows outside still belong to the ends."""
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(max(high, low + 1)),
        "numPartitions": str(partitions),
    }


def starts_query(table: str, column: str, partitions: int) -> str:
    """The least key of each of so many parts with equally many rows, which the database works out."""
    return (
        f"SELECT part, MIN({column}) AS lo FROM "
        f"(SELECT {column}, NTILE({partitions}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL) q "
        f"GROUP BY part ORDER BY part"
    )


def literal(value: object) -> str:
    """A key as SQL."""
    if isinstance(value, bool) or not isinstance(value, (int, float, decimal.Decimal, str, dt.date)):
        raise TypeError(f"no key: {value!r}")
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def range_predicates(column: str, starts: list) -> list[str]:
    """Conditions that every row, with a key or without, meets exactly one of.

    ``starts`` are the least keys of the parts. A key that fills several parts starts only one; the first part
    also takes what is smaller than its start, which may have come since, and the rows without a key.
    """
    inner = [literal(s) for s in sorted(set(starts))[1:]]
    if not inner:
        return ["1 = 1"]
    first = f"({column} < {inner[0]} OR {column} IS NULL)"
    middle = [f"({column} >= {low} AND {column} < {high})" for low, high in zip(inner, inner[1:], strict=False)]
    return [first, *middle, f"({column} >= {inner[-1]})"]


def read_jdbc(
    spark: SparkSession,
    conn: dict[str, str],
    table: str,
    partition_column: str | None = None,
    partitions: int = 16,
    fetchsize: int = 10000,
    by_quantiles: bool = False,
) -> DataFrame:
    """Read a table; with ``partition_column`` in parallel ranges.

    The ranges are of equal width between the smallest and the largest value of an integer column, whose NULLs are read
    with the first range. With ``by_quantiles`` they hold equally many rows each, whatever the column's type and however
    its values cluster; a value that fills several parts is one of them. Either way the database works out the ends.
    """
    reader = spark.read.format("jdbc").options(**conn).option("fetchsize", fetchsize)
    if partition_column and by_quantiles:
        parts = spark.read.format("jdbc").options(**conn).option("query", starts_query(table, partition_column, partitions))
        predicates = range_predicates(partition_column, [r.lo for r in parts.load().collect()])
        properties = {k: v for k, v in conn.items() if k != "url"} | {"fetchsize": str(fetchsize)}
        return spark.read.jdbc(conn["url"], table, predicates=predicates, properties=properties)
    if partition_column:
        ends = spark.read.format("jdbc").options(**conn).option("query", bounds_query(table, partition_column))
        low, high = ends.load().first()
        if low is not None:
            reader = reader.options(**partition_options(partition_column, int(low), int(high), partitions))
    return reader.option("dbtable", table).load()


# -- load ------------------------------------------------------------------


def write_jdbc(
    df: DataFrame,
    conn: dict[str, str],
    table: str,
    mode: str = "errorifexists",
    batchsize: int = 10000,
    connections: int = 32,
) -> None:
    """Write to a table over a bounded number of connections; by default an existing table is an error.

    Each task commits its own transaction. A task lost after its commit is run
    again and doubles its rows; ``load_jdbc`` is the load that doesn't.
    """
    options = load_options(conn, table, batchsize, connections)
    df.write.format("jdbc").mode(mode).options(**options).save()


def load_options(conn: dict[str, str], table: str, batchsize: int = 10000, connections: int = 32) -> dict[str, str]:
    return {**conn, "dbtable": table, "batchsize": str(batchsize), "numPartitions": str(connections)}


def staging_name(table: str, load: str | None = None) -> str:
    """A table beside the target, in its schema, that no other load uses; at most 24 letters longer than its name."""
    return f"{table}_load_{(load or uuid.uuid4().hex)[:16]}"


def _identifiers(columns: list[str]) -> list[str]:
    for name in columns:
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
            raise ValueError(f"not a plain column name: {name!r}")
    return columns


def swap_statements(table: str, staging: str, columns: list[str], replace: bool) -> list[str]:
    """What moves the staged rows into the table, each once, in one transaction.

    A task that ran twice has staged its rows twice, under the same numbers.
    """
    names = ", ".join(_identifiers(columns))
    once = f"SELECT {names}, ROW_NUMBER() OVER (PARTITION BY {LOAD_ROW} ORDER BY {LOAD_ROW}) AS load_copy FROM {staging}"
    moved = f"INSERT INTO {table} ({names}) SELECT {names} FROM ({once}) staged WHERE load_copy = 1"
    return [*([f"DELETE FROM {table}"] if replace else []), moved]


def staged_rows_query(staging: str) -> str:
    return f"SELECT COUNT(DISTINCT {LOAD_ROW}) AS n FROM {staging}"


def _transaction(spark: SparkSession, conn: dict[str, str], statements: list[str]) -> None:
    """Run the statements on one connection of the driver; all of them take effect or none."""
    properties = spark._jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in conn:
            properties.setProperty(key, conn[key])
    if "driver" in conn:
        spark._jvm.java.lang.Class.forName(conn["driver"])
    database = spark._jvm.java.sql.DriverManager.getConnection(conn["url"], properties)
    try:
        run_statements(database, statements)
    finally:
        database.close()


def run_statements(database, statements: list[str]) -> None:
    """The statements as one transaction of a JDBC connection."""
    database.setAutoCommit(False)
    try:
        for text in statements:
            statement = database.createStatement()
            try:
                statement.executeUpdate(text)
            finally:
                statement.close()
        database.commit()
    except Exception:
        database.rollback()
        raise


def load_jdbc(
    df: DataFrame,
    conn: dict[str, str],
    table: str,
    replace: bool = False,
    batchsize: int = 10000,
    connections: int = 32,
    transaction=_transaction,
    stage=None,
    staged_rows=None,
) -> int:
    """Load a stored table's rows into an existing table exactly once; returns their number.

    Rows get a number each and go to a table of their own, over many connections. Once all have arrived, one
    transaction moves them into the target, each number once: a task that was repeated after its commit doubles nothing, a
    load that breaks off leaves the target as it was. ``replace`` empties the target in the same transaction. The staging
    table is dropped in either case. ``df`` has to give the same rows in the same partitions when it is read again (files,
    a checkpoint), or a repeated task would number other rows. The last three arguments stand in for the database in tests.
    """
    spark, staging = df.sparkSession, staging_name(table)
    columns = _identifiers(df.columns)
    numbered = df.withColumn(LOAD_ROW, F.monotonically_increasing_id())
    options = load_options(conn, staging, batchsize, connections)
    stage = stage or (lambda rows: rows.write.format("jdbc").mode("errorifexists").options(**options).save())
    staged_rows = staged_rows or (
        lambda: spark.read.format("jdbc").options(**conn).option("query", staged_rows_query(staging)).load().first()[0]
    )
    expected = df.count()
    try:
        stage(numbered)
        if (found := staged_rows()) != expected:
            raise RuntimeError(f"{found} of {expected} rows arrived in {staging}")
        transaction(spark, conn, swap_statements(table, staging, columns, replace))
    finally:
        transaction(spark, conn, [f"DROP TABLE {staging}"])
    return expected


# -- snapshot --------------------------------------------------------------


def snapshot_table(
    spark: SparkSession,
    conn: dict[str, str],
    table: str,
    dst: str,
    partition_column: str | None = None,
    partitions: int = 16,
) -> None:
    """Export a whole table as delimited files under ``dst``."""
    write_delimited(read_jdbc(spark, conn, table, partition_column, partitions), dst)


def write_snapshot(df: DataFrame, root: str, keep: int = 2) -> str:
    """Write a table to a folder of its own and then point readers to it; returns the folder.

    A write that breaks off leaves the former snapshot in place. Folders of the last ``keep`` snapshots stay, so a reader
    that began before can end; older ones and those of broken writes go.
    """
    log = CommitLog(df.sparkSession, root)
    number, state = log.last()
    folder = f"snapshot-{number + 1:012d}-{uuid.uuid4().hex[:8]}"
    write_delimited(df, f"{log.storage.root}/{folder}", "errorifexists")
    current = [*state.get("kept", []), folder][-max(1, keep) :]
    log.commit(number, {"folder": folder, "kept": current})
    log.tidy("snapshot-*", current)
    return f"{log.storage.root}/{folder}"


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the last snapshot that was written to the end."""
    return read_delimited(spark, CommitLog(spark, root).folder())
