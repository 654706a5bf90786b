"""Per-batch work on chosen columns, with all other columns passed through."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

Arrays = list[pa.Array]


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def per_worker(key: str, build: Callable[[], object]):
    """A value built once in each Python worker and reused by its later tasks."""
    kept = sys.__dict__.setdefault("_text_operators", {})
    if key not in kept:
        kept[key] = build()
    return kept[key]


def byte_texts(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text, null counted as empty."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def arrow_type(field: StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def spare(df: DataFrame, name: str) -> str:
    """A name like this one that no column has."""
    return name + "_" * max([0, *map(len, df.columns)])


def beside(key: str, ddl: str) -> str:
    """Columns of a result that has a row's key too: one named like the key, in any case, gets an underscore."""
    fields = [f.strip().split(" ", 1) for f in ddl.split(", ")]
    return ", ".join(f"{name}_ {kind}" if name.lower() == key.lower() else f"{name} {kind}" for name, kind in fields)


def text_of(df: DataFrame, name: str) -> Column | str:
    """The column as text: its name if it is one."""
    return name if dict(df.dtypes)[name] == "string" else quoted(name).cast("string")


def append(df: DataFrame, inputs: Sequence[Column | str], ddl: str, make: Callable[[], Callable[[Arrays], Arrays]]) -> DataFrame:
    """All rows and columns of ``df`` with the columns of ``ddl`` after them.

    ``make`` is called once a task; what it returns gets the input columns of a batch and gives the new
    ones. An input given by name travels once, as the column that is passed through. A column of ``df`` that bears
    the name of a new one (in any case) is replaced by it.
    """
    new = StructType.fromDDL(ddl)
    names = {f.name.lower() for f in new}
    kept = [f for f in df.schema if f.name.lower() not in names]
    at = {f.name: i for i, f in enumerate(kept)}
    more = [quoted(c) if isinstance(c, str) else c for c in inputs if not (isinstance(c, str) and c in at)]
    source = df.select(
        *[quoted(f.name).alias(f"kept{i}") for i, f in enumerate(kept)], *[c.alias(f"in{i}") for i, c in enumerate(more)]
    )
    extra = iter(range(len(kept), len(kept) + len(more)))
    places = [at[c] if isinstance(c, str) and c in at else next(extra) for c in inputs]
    many, types, out_names = len(kept), [arrow_type(f) for f in new], [f.name for f in kept] + [f.name for f in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            made = [
                a if isinstance(a, pa.Array) else pa.array(a, t)
                for a, t in zip(work([batch.columns[i] for i in places]), types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:many], *made], names=out_names)

    return source.mapInArrow(run, StructType([*kept, *new.fields]))


def streamed(
    df: DataFrame, inputs: Sequence[Column], ddl: str, work: Callable[[Iterator[Arrays]], Iterator[Arrays]]
) -> DataFrame:
    """Rows that ``work`` makes of a task's batches of the input columns: lists of columns, any number of rows each."""
    schema = StructType.fromDDL(ddl)
    types, names = [arrow_type(f) for f in schema], [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in work(batch.columns for batch in batches):
            yield pa.RecordBatch.from_arrays(
                [a if isinstance(a, pa.Array) else pa.array(a, t) for a, t in zip(made, types, strict=True)], names=names
            )

    return df.select(*[c.alias(f"in{i}") for i, c in enumerate(inputs)]).mapInArrow(run, schema)


def flat(
    df: DataFrame, inputs: Sequence[Column], ddl: str, make: Callable[[], Callable[[Arrays], Iterator[Arrays]]]
) -> DataFrame:
    """Rows made from each batch on its own; ``make`` is called once a task."""

    def work(batches: Iterator[Arrays]) -> Iterator[Arrays]:
        made = make()
        for columns in batches:
            yield from made(columns)

    return streamed(df, inputs, ddl, work)


def type_of(df: DataFrame, column: Column) -> str:
    """The column's type as DDL."""
    return df.select(column).schema[0].dataType.simpleString()
