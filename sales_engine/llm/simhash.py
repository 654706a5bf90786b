"""SimHash near-duplicates: fingerprints of word shingles, linked by deletion-variant signatures.

Two fingerprints that differ in at most ``bits`` bits are cut into ``bits // 2 + 1`` segments, fewer than the
pigeonhole needs for an equal one: some segment then differs in at most one bit. So every segment is indexed
once for each of its bits with that bit left out, and an equality join on (bit, rest of the segment) brings
each pair together. Candidates are verified by their bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, append, byte_texts, flat, quoted, spare, text_of
from sales_engine.llm.components import smallest_members
from sales_engine.llm.tables import written

WORD_SIZE = 64
#: Fingerprints in one bucket up to which a task compares them with each other; larger buckets go by whole words.
BUCKET = 128


def fingerprint(text: bytes, shingle: int) -> int:
    """Bit ``i`` is set if it is set in over half of the shingles' hashes; no words give 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hash_of = xxhash.xxh64_intdigest
    counts = np.zeros(WORD_SIZE, np.int64)
    for at in range(0, len(starts), 65_536):
        part = zip(starts[at : at + 65_536].tolist(), ends[at : at + 65_536].tolist(), strict=True)
        hashes = np.array([hash_of(joined[a:b], 42) for a, b in part], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the SimHash of every whole text as a signed 64-bit integer.

    Words are runs without ASCII white space after lower-casing A-Z; repeated shingles count each time; fewer
    words than a shingle make one shingle; a null text or one without words has fingerprint 0.
    """

    def make():
        return lambda columns: [[fingerprint(t, shingle) for t in byte_texts(columns[0])]]

    return append(docs, [text_of(docs, text)], f"`{name}` bigint", make)


def _segments(bits: int) -> list[int]:
    """Masks of the segments."""
    many = bits // 2 + 1
    cuts = [WORD_SIZE * i // many for i in range(many + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _variants(words: DataFrame, bits: int) -> DataFrame:
    """``word, left_out, rest``: each word once for each bit, as the segment of that bit without it."""
    kept = [_signed(next(s for s in _segments(bits) if s >> p & 1) & ~(1 << p)) for p in range(WORD_SIZE)]
    masks = F.array(*[F.lit(k).cast("bigint") for k in kept])
    return words.select("word", F.posexplode(masks).alias("left_out", "mask")).select(
        "word", F.col("left_out").cast("tinyint").alias("left_out"), F.col("word").bitwiseAND(F.col("mask")).alias("rest")
    )


def _forest(bits: int):
    """Links that connect the words of a bucket as far as their distances allow: one less than words at most."""

    def make():
        def work(columns: Arrays) -> Iterator[Arrays]:
            left, right = [], []
            for bucket in columns[0].to_pylist():
                words = np.array(bucket, np.int64)
                apart = (words[:, None] ^ words[None, :]).view(np.uint64)
                near = np.bitwise_count(apart) <= bits
                labels = np.arange(len(words))
                while True:
                    heard = np.where(near, labels[None, :], len(words)).min(axis=1)
                    if (heard == labels).all():
                        break
                    labels = heard
                for label in np.unique(labels):
                    tree, rest = [np.flatnonzero(labels == label)[0]], set(np.flatnonzero(labels == label)[1:].tolist())
                    for node in tree:  # breadth first, over real links only
                        new = [x for x in rest if near[node, x]]
                        rest -= set(new)
                        tree += new
                        left += [int(words[node])] * len(new)
                        right += words[new].tolist()
            yield [left, right]

        return work

    return make


def near_links(words: DataFrame, bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links between distinct 64-bit ``word`` values that connect all that differ in at most ``bits`` bits.

    Every link is a real one (verified distance), and words joined by any chain of real links are joined by
    these. Within a bucket (words that agree in a segment but for one bit) a spanning forest of the links stands
    for all of them. A bucket of more than ``bucket`` words is not compared by one task: its words are indexed
    by every word one flip away from them instead, whose buckets hold 65 at most. That covers two bits, so
    ``bits`` is 2 at most.
    """
    if not 0 <= bits <= 2:
        raise ValueError("bits must be 0, 1 or 2")
    variants = _variants(words, bits)
    keys = ["left_out", "rest"]
    buckets = written(variants.groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    # A merge join at any size: Spark can split its frequent keys, and nothing that grows is broadcast.
    members = written(variants.join(buckets.hint("merge"), keys), "members")
    few = members.where(F.col("size") <= bucket).groupBy(*keys).agg(F.collect_list("word").alias("bucket"))
    links = flat(few, [F.col("bucket")], "a bigint, b bigint", _forest(bits))
    # Words up to two flips apart have a word in common that is at most one flip away from both.
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(_signed(1 << p)).cast("bigint") for p in range(WORD_SIZE)])
    many = members.where(F.col("size") > bucket).select("word").distinct()
    around = many.select("word", F.explode(flips).alias("flip")).select("word", F.col("word").bitwiseXOR(F.col("flip")).alias("centre"))
    close = around.groupBy("centre").agg(F.collect_list("word").alias("bucket")).where(F.size("bucket") > 1)
    return links.unionAll(flat(close, [F.col("bucket")], "a bigint, b bigint", _forest(bits))).distinct()


def near_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2, carry_text: bool = True
) -> DataFrame:
    """All rows and columns of ``docs`` with ``fingerprint`` (long), ``component_id`` and ``component_keeper``.

    ``component_id`` is the smallest ``key`` of all rows that chains of links of at most ``bits`` differing bits
    reach, the row itself included (null where none of them has a key). ``component_keeper`` is true for one
    row of each component: one with that key, any one of several equal ones. Rows with a null ``key`` take part
    like others. An empty table gives an empty result. ``carry_text=False`` leaves the text out of the result and
    of the tables in between.
    """
    added = ("fingerprint", "component_id", "component_keeper")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    number, word, keeper = (spare(docs, n) for n in ("row_number", "word", "keeper"))
    rows = with_fingerprint(docs, text, shingle).withColumn(number, F.monotonically_increasing_id())
    if not carry_text:
        docs, rows = docs.drop(text), rows.drop(text)
    rows = written(rows, "fingerprints")
    order = F.struct(quoted(key).isNull(), quoted(key))
    words = rows.groupBy(F.col("fingerprint").alias("word")).agg(
        F.min(quoted(key)).alias("least"), F.min_by(F.col(number), order).alias("keeper"), F.min(order).alias("first")
    )
    words = written(words, "words")
    roots = smallest_members(near_links(words.select("word"), bits))
    rooted = written(
        words.join(roots, words.word == roots.node, "left").select(F.coalesce("root", "word").alias("root"), "word", "least", "keeper", "first"), "roots"
    )
    best = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min_by("keeper", "first").alias("keeper"))
    of_word = written(rooted.select("root", "word").join(written(best, "components"), "root").select("word", "component_id", "keeper"), "word-components")
    of_word = of_word.select(F.col("word").alias(word), "component_id", F.col("keeper").alias(keeper))
    found = rows.join(of_word, F.col("fingerprint") == F.col(word))
    return found.select(
        *[quoted(c) for c in docs.columns], "fingerprint", "component_id", (F.col(number) == F.col(keeper)).alias("component_keeper")
    )


def fingerprint_hex(word: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(word), 16, "0"))
