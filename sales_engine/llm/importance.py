"""Importance resampling towards a target: hashed word n-gram weights, then a threshold that is bisected.

1. Both sides' features are counted per bucket, in each task first; 10,000 sums give the buckets' gains.
2. A document's weight is the sum of the gains of its features; noise from its key makes it a score.
3. Scores are written once. Jobs that only count narrow the threshold down: to a score, then among the documents
   with that score to a key, then among rows with that key to a row. Nothing is sorted for it.
4. The rows drawn are partitioned by range; a row's rank is its place in its partition after all before it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, append, byte_texts, quoted, spare, streamed, text_of
from sales_engine.llm.tables import written
from sales_engine.llm.words import ALPHANUMERIC, Words, blocks

RUN = 3
BUCKETS = 10_000
#: Thresholds counted by one job: four halvings at once.
AT_ONCE = 15
RANKED_ROWS_A_TASK = 1_000_000
_LONGEST = 255


def _zero_byte_tables() -> np.ndarray:
    """``[n, k, b]``: what n zero bytes make of the checksum whose k-th byte is b."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (step & np.uint32(1)))
    out = np.empty((_LONGEST + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(_LONGEST):
        out[n + 1] = step[out[n] & np.uint32(255)] ^ (out[n] >> np.uint32(8))
    return out


class FeatureHash:
    """CRC-32 of every run of up to three words, from the checksums of the words alone.

    The checksum of two strings put together is that of the first, advanced by as many zero bytes as the second
    has, XOR that of the second.
    """

    def __init__(self) -> None:
        self.tables = _zero_byte_tables()

    def advanced(self, sums: np.ndarray, many: np.ndarray) -> np.ndarray:
        sums, left = sums.copy(), many.copy()
        todo = np.arange(len(sums))
        while len(todo):
            n, now = np.minimum(left[todo], _LONGEST), sums[todo]
            made = np.zeros(len(todo), np.uint32)
            for k in range(4):
                made ^= self.tables[n, k, (now >> np.uint32(8 * k)) & np.uint32(255)]
            sums[todo] = made
            left[todo] -= n
            todo = todo[left[todo] > 0]
        return sums

    def runs(self, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of 1, 2, 3 words: places of their last words, and their checksums; each run once over all blocks."""
        alone = np.array([zlib.crc32(w) for w in words.words], np.uint32)[words.codes]
        after = np.array([zlib.crc32(b" " + w) for w in words.words], np.uint32)[words.codes]
        many = np.array([len(w) + 1 for w in words.words], np.int64)[words.codes]
        sums = alone
        for n in range(1, RUN + 1):
            if n > 1:
                sums = self.advanced(sums[:-1], many[n - 1 :]) ^ after[n - 1 :]
            last = np.arange(n - 1, len(words.codes))
            whole = words.fresh[last] & (words.piece[last] == words.piece[last - n + 1])
            yield last[whole], sums[whole]


def _bucket_rows(buckets: int):
    def work(batches: Iterator[Arrays]) -> Iterator[Arrays]:
        features, counts = FeatureHash(), np.zeros(buckets, np.int64)
        for (texts,) in batches:
            for words in blocks(byte_texts(texts), ALPHANUMERIC, RUN - 1):
                for _, sums in features.runs(words):
                    counts += np.bincount(sums % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(counts)
        yield [pa.array(at), pa.array(counts[at])]

    return work


def bucket_counts(docs: DataFrame, text: str, buckets: int = BUCKETS) -> list[int]:
    """Features of all texts in each bucket; a task sends one row a bucket."""
    rows = streamed(docs, [quoted(text).cast("string")], "bucket bigint, n bigint", _bucket_rows(buckets))
    out = [0] * buckets
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(target: list[int], source: list[int]) -> list[int]:
    """Thousandths by which a bucket's smoothed share of the target exceeds that of the source, as logarithms."""
    more, all_target, all_source = len(source), sum(target), sum(source)
    return [
        math.floor(1000 * math.log(((t + 1) * (all_source + more)) / ((s + 1) * (all_target + more))))
        for t, s in zip(target, source, strict=True)
    ]


def _weights(gains: list[int]):
    def make():
        features, gain = FeatureHash(), np.array(gains, np.float64)

        def work(columns: Arrays) -> Arrays:
            texts = byte_texts(columns[0])
            n = len(texts)
            words_of, features_of, weights = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.float64)
            for words in blocks(texts, ALPHANUMERIC, RUN - 1):
                words_of += np.bincount(words.text[words.fresh], minlength=n)
                for last, sums in features.runs(words):
                    of = words.text[last]
                    features_of += np.bincount(of, minlength=n)
                    weights += np.bincount(of, weights=gain[sums % np.uint32(len(gain))], minlength=n)
            return [pa.array(words_of), pa.array(features_of), pa.array(weights.astype(np.int64))]

        return work

    return make


def gumbel(key: Column, seed: int) -> Column:
    """Thousandths of noise drawn by the key alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(share))).cast("bigint")


def cutoff(rows: DataFrame, column: Column, need: int) -> tuple[int, int, int]:
    """The ``need``-th smallest value, and how many rows lie below it and up to it, by jobs that only count.

    Every job counts the rows up to each of ``AT_ONCE`` thresholds, which cuts the range to a sixteenth.
    """
    values = rows.select(column.alias("x"))
    low, high, below, upto = *values.agg(F.min("x"), F.max("x")).first(), 0, values.count()
    while low < high:
        step = (high - low) // (AT_ONCE + 1)
        at = sorted({low + i * step for i in range(1, AT_ONCE + 1)} if step else {*range(low, high)})
        counts = values.agg(*[F.count_if(F.col("x") <= F.lit(t)) for t in at]).first()
        for t, n in zip(at, counts, strict=True):
            if n >= need:
                high, upto = t, n
                break
            low, below = t + 1, n
    return low, below, upto


def _drawn(rows: DataFrame, orders: list[Column], need: int) -> Column:
    """The rows that come first by all the orders, ``need`` of them."""
    if need <= 0:
        return F.lit(False)
    inside, taken = F.lit(True), F.lit(False)
    for order in orders:
        value, below, upto = cutoff(rows.where(inside), order, need)
        if upto == need:
            return taken | (inside & (order <= F.lit(value)))
        taken, inside, need = taken | (inside & (order < F.lit(value))), inside & (order == F.lit(value)), need - below
    raise AssertionError("the last order has to tell all rows apart")


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
    carry_text: bool = True,
) -> DataFrame:
    """All rows of ``docs`` with ``n_features, weight, score, rank``; ``rank`` is null for rows that aren't drawn.

    Of the N rows with at least ``least_words`` words, ``floor(percent * N / 100)`` are drawn: the highest scores,
    ties to the smaller ``key`` (an integer; null comes last), rows that tie in both in any order, the same in every
    later read. A null or empty text has no feature: weight 0, and its score is the noise of its key. An empty
    ``docs`` gives an empty result, an empty target the gains of a target without features. Columns of ``docs``
    named like an added one are replaced, the key and the text too. ``carry_text=False`` leaves the text out.
    """
    if dict(docs.dtypes)[key] not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("the key has to be an integer")
    added = ("n_features", "weight", "score", "rank")
    renamed = {c: spare(docs, c) for c in (key, text) if c.lower() in added}  # they are needed until the end
    docs, key, text = docs.withColumnsRenamed(renamed), renamed.get(key, key), renamed.get(text, text)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    gains = bucket_gains(bucket_counts(target, target_text), bucket_counts(docs, text))
    many, row, at, part = (spare(docs, name) for name in ("n_words", "row_number", "place", "part"))
    made = append(docs, [text_of(docs, text)], f"{many} bigint, n_features bigint, weight bigint", _weights(gains))
    if not carry_text:
        docs, made = docs.drop(text), made.drop(text)
    noise = gumbel(quoted(key), seed)
    scored = written(
        made.withColumn("score", F.col("weight") + noise).withColumn(row, F.monotonically_increasing_id()), "scored"
    )
    long_enough = F.col(many) >= least_words
    need = percent * scored.where(long_enough).count() // 100
    # nulls last: among equal scores first the rows with a key, then the keys, then the rows themselves
    orders = [-F.col("score"), quoted(key).isNull().cast("int"), F.coalesce(quoted(key).cast("bigint"), F.lit(0)), F.col(row)]
    drawn = long_enough & _drawn(scored.where(long_enough), orders, need)
    columns = [*[quoted(c) for c in docs.columns if c not in renamed.values()], "n_features", "weight", "score"]
    tasks = max(1, ceil(need / RANKED_ROWS_A_TASK), min(need, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    in_order = scored.where(drawn).repartitionByRange(tasks, *orders).sortWithinPartitions(*orders)
    placed = written(in_order.withColumn(at, F.monotonically_increasing_id()), "placed")
    part_of, place = F.shiftright(at, 33), F.col(at).bitwiseAND((1 << 33) - 1)
    sizes = {r[0]: r[1] for r in placed.groupBy(part_of).count().collect()}  # a row a task
    before, starts = 0, []
    for p in sorted(sizes):
        starts.append((p, before))
        before += sizes[p]
    offsets = docs.sparkSession.createDataFrame(starts, f"{part} bigint, before bigint")
    ranked = placed.withColumn(part, part_of).join(F.broadcast(offsets), part).withColumn("rank", F.col("before") + place + 1)
    rest = scored.where(~F.coalesce(drawn, F.lit(False))).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.select(*columns, "rank").unionAll(rest.select(*columns, "rank"))
