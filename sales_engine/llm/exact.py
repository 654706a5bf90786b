"""Exact duplicates by two passes of a Bloom filter: only rows that may have a copy are shuffled."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, append, byte_texts, flat, quoted, spare, text_of
from sales_engine.llm.tables import written

#: The filter never has more bits (32 MB), which bounds what is broadcast. Beyond that it lets more rows through
#: than have copies; these are shuffled for nothing, and the result stays the same.
MOST_BITS = 2**28
BITS_A_ROW = 16
PROBES = 2


def _digests(texts: pa.Array) -> list[str]:
    return [hashlib.sha256(t.lower()).hexdigest() for t in byte_texts(texts)]


def _slots(digests: list[str], bits: int) -> np.ndarray:
    """A row's places in the filter, from two parts of its digest; a power of two keeps them even."""
    parts = np.frombuffer(bytes.fromhex("".join(digests)), "<u8").reshape(-1, 4)[:, :PROBES]
    return (parts & np.uint64(bits - 1)).astype(np.int64)


def _slot_rows(bits: int):
    def make():
        def work(columns: Arrays) -> Iterator[Arrays]:
            slots, times = np.unique(_slots(_digests(columns[0]), bits), return_counts=True)
            yield [pa.array(slots), pa.array(times)]

        return work

    return make


def repeat_filter(docs: DataFrame, text: str) -> tuple[int, bytes]:
    """First pass: the slots that were hit twice, as a bit map of a bounded size.

    A row can only have a copy if both its slots are among them. The slots' counts are summed in each task
    before they are shuffled; the driver gets one 64-bit word of the map at a time, of those that aren't zero.
    """
    rows = max(1, docs.count())
    bits = min(MOST_BITS, 1 << max(10, (rows * BITS_A_ROW - 1).bit_length()))
    hits = flat(docs, [quoted(text).cast("string")], "slot bigint, times bigint", _slot_rows(bits))
    again = hits.groupBy("slot").agg(F.sum("times").alias("times")).where("times > 1")
    word, bit = F.shiftright("slot", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").bitwiseAND(63).cast("int"))
    words = again.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    filled = np.zeros(max(1, bits // 64), np.int64)
    filled[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bits, filled.tobytes()


def _marks(bits: int, shared):
    def make():
        filled = np.frombuffer(shared.value, np.uint8)

        def work(columns: Arrays) -> Arrays:
            digests = _digests(columns[0])
            slots = _slots(digests, bits)
            maybe = (filled[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).all(axis=1)
            return [digests, pa.array(maybe)]

        return work

    return make


def with_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", carry_text: bool = True) -> DataFrame:
    """All rows and columns of ``docs`` with ``keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal texts the row
    with the largest ``key`` is ``kept``; of several such rows any one, and of rows without a key any one if none
    has one. Rows that the filter clears keep themselves and are not shuffled.
    An empty table gives an empty result; columns named like a result's are replaced. ``carry_text=False`` leaves
    the text out of the result and of the tables in between.
    """
    added = ("keep_id", "group_size", "kept", "text_sha256")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    maybe, number, keeper = (spare(docs, n) for n in ("maybe", "row_number", "keeper"))
    bits, filled = repeat_filter(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(filled)
    marked = append(docs, [text_of(docs, text)], f"text_sha256 string, {maybe} boolean", _marks(bits, shared))
    if not carry_text:
        docs, marked = docs.drop(text), marked.drop(text)
    marked = written(marked.withColumn(number, F.monotonically_increasing_id()), "marked")
    candidates = marked.where(F.col(maybe))
    groups = candidates.groupBy("text_sha256").agg(
        F.max(quoted(key)).alias("keep_id"),
        F.count("*").alias("group_size"),
        F.max_by(number, F.struct(quoted(key).isNotNull(), quoted(key))).alias(keeper),
    )
    columns = [*[quoted(c) for c in docs.columns], "keep_id", "group_size", "kept", "text_sha256"]
    alone = marked.where(~F.col(maybe)).select(
        "*", quoted(key).alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept")
    )
    grouped = candidates.join(written(groups, "groups"), "text_sha256").withColumn("kept", F.col(number) == F.col(keeper))
    return alone.select(*columns).unionAll(grouped.select(*columns))
