"""Phrase collocations per language from counts that weighted automata hold.

1. *Words* are counted. A phrase that occurs often enough has only words that do, so a bit map of the frequent words
   (of a fixed size: where it is full it lets more through, and the counts decide) thins out what follows.
2. *Shards.* A task turns the n-grams of a block of text into automata, one for each prefix range. Ranges are those of
   the hash of the first word; a word with more than a range's share is cut further by its second word, and a
   pair of words by its third.
3. *Union.* The automata of a range meet in one task, which sums their weights: first words and pairs, then, where
   all pairs of a phrase are frequent, phrases of three and four words.
4. *Composition.* The parts of the candidates, each once, go to their range, where the automaton of the parts asked
   for is composed with that of the counts.

Scores, the nested candidates and the ranks are joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, quoted, streamed
from sales_engine.llm.automata import CountAutomaton, Grams, mixed, together
from sales_engine.llm.tables import written
from sales_engine.llm.words import Words, blocks, byte_table

LONGEST = 4
HELD_BYTES = 8 * 1024 * 1024
#: Words of text a prefix range stands for: so many at least, and so many that there are at most 100,000 ranges.
RANGE_WORDS, MOST_RANGES = 2_000_000, 100_000
#: A bit map never has more bits (32 MB). Beyond that it lets more through, and results stay the same.
MOST_BITS = 2**28
BITS_A_ROW = 16
#: N-grams that wait to be summed in a task, besides as many as are already summed.
MERGED_ROWS = 500_000
_TABLE = byte_table(b"\t", b".,;:!?\n\x0b\x0c\r")


def _seed(language: str) -> int:
    return xxhash.xxh64_intdigest(language.encode(), 42)


def _word_hashes(language: str, words: list[bytes]) -> np.ndarray:
    """As Spark's ``xxhash64(lang, word)``."""
    seed = _seed(language)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def _follow(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a prefix with one word more."""
    return mixed(prefix * np.uint64(0x9E3779B97F4A7C15) + word)


class Ranges:
    """Which prefix range an n-gram belongs to."""

    def __init__(self, many: dict[str, int], heavy: np.ndarray):
        self.many = many
        self.heavy = np.sort(heavy.astype(np.uint64))

    def of(self, language: str, hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The range of the shortest prefix that isn't heavy, or of the whole n-gram."""
        prefix = hashes[rows[:, 0]]
        for depth in range(1, min(LONGEST - 1, rows.shape[1])):
            at = np.flatnonzero(rows[:, depth] >= 0)
            if len(self.heavy) and len(at):
                near = np.minimum(np.searchsorted(self.heavy, prefix[at]), len(self.heavy) - 1)
                at = at[self.heavy[near] == prefix[at]]
                prefix[at] = _follow(prefix[at], hashes[rows[at, depth]])
            else:
                break
        return (mixed(prefix) % np.uint64(self.many.get(language, 1))).astype(np.int64)


class Bits:
    """A set of hashes that may hold more than was put in."""

    def __init__(self, data: bytes):
        self.map = np.frombuffer(data, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64(8 * len(self.map) - 1)
        out = np.ones(len(hashes), bool)
        for shift in (0, 32):
            slot = (hashes >> np.uint64(shift)) & mask
            out &= (self.map[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out


def bit_map(hashes: DataFrame, hash_name: str = "hash") -> bytes:
    """The map of a column of 64-bit hashes; the driver gets its words that aren't zero, 4 million at most."""
    bits = min(MOST_BITS, 1 << max(10, (max(1, hashes.count()) * BITS_A_ROW - 1).bit_length()))
    slots = [F.shiftrightunsigned(hash_name, s).bitwiseAND(bits - 1) for s in (0, 32)]
    each = hashes.select(F.explode(F.array(*slots)).alias("slot"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").bitwiseAND(63).cast("int"))
    words = each.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(bits // 64, "<i8")
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.tobytes()


def _by_language(batches: Iterator[Arrays], context: int) -> Iterator[tuple[str, Words]]:
    """Blocks of the texts of one language each; what waits is bounded."""

    def flushed() -> Iterator[tuple[str, Words]]:
        for language, texts in held.items():
            for words in blocks(texts, _TABLE, context, HELD_BYTES):
                yield language, words

    held: dict[str, list[bytes]] = {}
    size = 0
    for languages, texts in batches:
        for language, text in zip(languages.to_pylist(), texts.cast(pa.binary()).to_pylist(), strict=True):
            if text:
                held.setdefault(language, []).append(text)
                size += len(text)
                if size >= HELD_BYTES:
                    yield from flushed()
                    held, size = {}, 0
    yield from flushed()


def _word_rows(batches: Iterator[Arrays]) -> Iterator[Arrays]:
    for language, words in _by_language(batches, 0):
        counts = np.bincount(words.codes, minlength=len(words.words))
        yield [[language] * len(counts), pa.array(words.words).cast(pa.string()), pa.array(counts)]


def _kept_codes(language: str, words: Words, frequent: Bits) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Frequent words in the order of bytes, their hashes, and the number of each word of the text (-1: rare)."""
    hashes = _word_hashes(language, words.words)
    kept = np.flatnonzero(frequent.has(hashes))
    order = np.array(sorted(kept.tolist(), key=words.words.__getitem__), np.int64)
    number = np.full(len(words.words), -1, np.int64)
    number[order] = np.arange(len(order))
    return [words.words[i] for i in order], hashes[order], number[words.codes]


def _pairs(words: Words, codes: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the second words of pairs of frequent words within a piece, and the pairs as numbers."""
    last = np.flatnonzero((words.piece[1:] == words.piece[:-1]) & (codes[1:] >= 0) & (codes[:-1] >= 0)) + 1
    return last, codes[last - 1] * many + codes[last]


def _short_grams(words: Words, codes: np.ndarray, kept: list[bytes]) -> Grams:
    """Frequent words and pairs of them, with their counts in the block."""
    many = len(kept)
    singles = np.bincount(codes[(codes >= 0) & words.fresh], minlength=many)
    last, pair = _pairs(words, codes, many)
    pair, times = np.unique(pair[words.fresh[last]], return_counts=True)
    one = np.flatnonzero(singles)
    rows = np.concatenate([np.column_stack([one, np.full(len(one), -1)]), np.column_stack([pair // many, pair % many])])
    return Grams(kept, rows, np.concatenate([singles[one], times]))


def _long_grams(words: Words, codes: np.ndarray, kept: list[bytes], hashes: np.ndarray, frequent: Bits) -> Grams:
    """Phrases of three and four words all of whose pairs are frequent, with their counts in the block."""
    many = len(kept)
    last, pair = _pairs(words, codes, many)
    different, which = np.unique(pair, return_inverse=True)
    good = frequent.has(_follow(hashes[different // many], hashes[different % many])) if len(different) else np.zeros(0, bool)
    pair_at = np.full(len(codes) + 1, -1, np.int64)
    pair_at[last[good[which]]] = which[good[which]]
    pair_at = pair_at[:-1]
    rows, counts = [np.zeros((0, LONGEST), np.int64)], [np.zeros(0, np.int64)]
    third = np.flatnonzero((pair_at[1:] >= 0) & (pair_at[:-1] >= 0)) + 1
    three, times = np.unique(pair_at[(own := third[words.fresh[third]]) - 1] * many + codes[own], return_counts=True)
    if len(three):
        head = different[three // many]
        rows.append(np.column_stack([head // many, head % many, three % many, np.full(len(three), -1)]))
        counts.append(times)
    fourth = third[np.isin(third - 1, third, assume_unique=True)]
    own = fourth[words.fresh[fourth]]
    four, times = np.unique(pair_at[own - 2] * max(1, len(different)) + pair_at[own], return_counts=True)
    if len(four):
        head, tail = different[four // len(different)], different[four % len(different)]
        rows.append(np.column_stack([head // many, head % many, tail // many, tail % many]))
        counts.append(times)
    return Grams(kept, np.concatenate(rows), np.concatenate(counts))


def _shards(ranges: Ranges, frequent_words, frequent_pairs=None):
    """Automata of a task's blocks: words and pairs, or phrases of three and four words."""

    def work(batches: Iterator[Arrays]) -> Iterator[Arrays]:
        words_in = Bits(frequent_words.value)
        pairs_in = None if frequent_pairs is None else Bits(frequent_pairs.value)
        for language, words in _by_language(batches, LONGEST - 1):
            kept, hashes, codes = _kept_codes(language, words, words_in)
            if not kept:
                continue
            grams = _short_grams(words, codes, kept) if pairs_in is None else _long_grams(words, codes, kept, hashes, pairs_in)
            if not len(grams.rows):
                continue
            of = ranges.of(language, hashes, grams.rows)
            order = np.argsort(of, kind="stable")
            found, begins = np.unique(of[order], return_index=True)
            for which, at in zip(found.tolist(), np.split(order, begins[1:]), strict=True):
                automaton = CountAutomaton.of(grams.restricted(at))
                yield [[language], pa.array([which]), pa.array([automaton.to_bytes()], pa.binary())]

    return work


def _groups(batches: Iterator[Arrays]) -> Iterator[tuple[tuple[str, int], Iterator[tuple]]]:
    """Consecutive rows with one language and range, as they are sorted."""
    from itertools import groupby

    rows = chain.from_iterable(zip(*(c.to_pylist() for c in columns), strict=True) for columns in batches)
    yield from groupby(rows, key=lambda row: row[:2])


def _unions(batches: Iterator[Arrays]) -> Iterator[Arrays]:
    for (language, which), rows in _groups(batches):
        waiting, held, summed = [], 0, 0
        for _, _, data in rows:
            waiting.append(CountAutomaton.from_bytes(data).grams())
            held += len(waiting[-1].rows)
            if held > MERGED_ROWS + 2 * summed and len(waiting) > 1:
                waiting = [CountAutomaton.of(together(waiting)).grams()]
                held = summed = len(waiting[0].rows)
        automaton = CountAutomaton.of(together(waiting))
        yield [[language], pa.array([which]), pa.array([automaton.to_bytes()], pa.binary())]


def _phrases(grams: Grams, at: np.ndarray) -> list[str]:
    words = [w.decode("utf-8", "replace") for w in grams.words]
    return [" ".join([words[i] for i in row if i >= 0]) for row in grams.rows[at].tolist()]


def _frequent_rows(least: int):
    """Phrases of two words and more with enough occurrences, and the hash of their words."""

    def work(batches: Iterator[Arrays]) -> Iterator[Arrays]:
        for languages, _, data in batches:
            for language, one in zip(languages.to_pylist(), data.to_pylist(), strict=True):
                grams = CountAutomaton.from_bytes(one).grams()
                if grams.rows.shape[1] < 2:
                    continue
                at = np.flatnonzero((grams.counts >= least) & (grams.rows[:, 1] >= 0))
                hashes, rows = _word_hashes(language, grams.words), grams.rows[at]
                prefix = _follow(hashes[rows[:, 0]], hashes[rows[:, 1]])
                yield [
                    [language] * len(at), pa.array(_phrases(grams, at), pa.string()), pa.array((rows >= 0).sum(axis=1).astype(np.int32)),
                    pa.array(grams.counts[at]), pa.array(prefix.view(np.int64)),
                ]

    return work


def _asked_rows(ranges: Ranges):
    """The range of each phrase that is asked for."""

    def work(batches: Iterator[Arrays]) -> Iterator[Arrays]:
        for languages, phrases in batches:
            phrases_of: dict[str, list[str]] = {}
            for language, phrase in zip(languages.to_pylist(), phrases.to_pylist(), strict=True):
                phrases_of.setdefault(language, []).append(phrase)
            for language, asked in phrases_of.items():
                grams = _as_grams(asked)
                which = ranges.of(language, _word_hashes(language, grams.words), grams.rows)
                yield [[language] * len(asked), pa.array(which), pa.array(asked)]

    return work


def _as_grams(phrases: list[str]) -> Grams:
    split = [p.encode().split(b" ") for p in phrases]
    words = sorted(set(chain.from_iterable(split)))
    number = {w: i for i, w in enumerate(words)}
    rows = np.full((len(split), max(map(len, split), default=1)), -1, np.int64)
    for i, row in enumerate(split):
        rows[i, : len(row)] = [number[w] for w in row]
    return Grams(words, rows, np.ones(len(split), np.int64))


ASKED_AT_ONCE = 100_000


def _answers(batches: Iterator[Arrays]) -> Iterator[Arrays]:
    """Counts of the phrases asked for in each range: the automaton of a batch of them composed with the counts."""
    for (language, _), rows in _groups(batches):
        counts, asked = None, []

        def answered(asked: list[str], counts: CountAutomaton, language: str) -> Arrays:
            found = counts.composed(CountAutomaton.of(_as_grams(asked)))
            at = np.arange(len(found.rows))
            return [[language] * len(at), pa.array(_phrases(found, at), pa.string()), pa.array(found.counts)]

        for _, _, data, phrase in rows:
            if data is not None:
                counts = CountAutomaton.from_bytes(data)
                continue
            asked.append(phrase)
            if len(asked) >= ASKED_AT_ONCE:
                yield answered(asked, counts, language)
                asked = []
        if asked and counts is not None:
            yield answered(asked, counts, language)


def _ranged(rows: DataFrame, *order: str) -> DataFrame:
    many = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(many, "lang", "range").sortWithinPartitions("lang", "range", *order)


def _counted(docs: DataFrame, ranges: Ranges, frequent_words, frequent_pairs, label: str) -> DataFrame:
    """``lang, range, automaton``: the counts of all texts, one automaton a range."""
    columns = "lang string, range bigint, automaton binary"
    shards = streamed(docs, [F.col("lang"), F.col("text")], columns, _shards(ranges, frequent_words, frequent_pairs))
    names = [F.col(c) for c in ("lang", "range", "automaton")]
    return written(streamed(_ranged(shards), names, columns, _unions), label)


def _looked_up(parts: DataFrame, counts: DataFrame, ranges: Ranges) -> DataFrame:
    """``lang, phrase, f`` of the phrases asked for."""
    asked = streamed(parts, [F.col("lang"), F.col("phrase")], "lang string, range bigint, phrase string", _asked_rows(ranges))
    both = counts.select("lang", "range", "automaton", F.lit(None).cast("string").alias("phrase")).unionAll(
        asked.select("lang", "range", F.lit(None).cast("binary").alias("automaton"), "phrase")
    )
    in_order = _ranged(both.withColumn("late", F.col("automaton").isNull()), "late", "phrase")
    names = [F.col(c) for c in ("lang", "range", "automaton", "phrase")]
    return streamed(in_order, names, "lang string, phrase string, f bigint", _answers)


def collocations(
    docs: DataFrame, text: str = "text", language: str = "lang", least: int = 30, most: int = 2000, inside_percent: int = 80
) -> DataFrame:
    """The ``most`` best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Words are separated by blanks and tabs, pieces by ``.,;:!?`` and line ends; A-Z are lower-cased. A candidate is a
    phrase of two to four words with ``a >= least`` occurrences within pieces. Of its cuts into two parts with l and
    r occurrences the one with the lowest score ``floor(2000000 * a / (l + r))`` counts (ties: the shorter first part).
    A candidate inside a longer one with at least ``inside_percent`` % as many occurrences goes. Order: score and a
    descending, then the phrase's bytes. A null text has no words, a null language is ``und``. Repeated rows count
    each; other columns don't matter. An empty table, or one where nothing is frequent, gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(quoted(language).cast("string"), F.lit("und")).alias("lang"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text")
    )
    partial = streamed(texts, [F.col("lang"), F.col("text")], "lang string, word string, f bigint", _word_rows)
    words = written(partial.groupBy("lang", "word").agg(F.sum("f").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    all_words = words.agg(F.sum("f")).first()[0] or 0
    range_words = max(RANGE_WORDS, ceil(all_words / MOST_RANGES))
    # at most all_words / range_words languages, words and pairs reach the driver here
    many = {r.lang: ceil(r.n / range_words) for r in totals.where(F.col("n") > range_words).collect()}
    hashed = words.where(F.col("f") >= least).withColumn("hash", F.xxhash64("lang", "word"))
    heavy = [r.hash for r in hashed.where(F.col("f") > range_words).select("hash").collect()]
    short_ranges = Ranges(many, np.array(heavy, np.int64).view(np.uint64))
    frequent_words = spark.sparkContext.broadcast(bit_map(hashed))
    short = _counted(texts, short_ranges, frequent_words, None, "pairs")

    columns = "lang string, phrase string, size int, a bigint, hash bigint"
    names = [F.col(c) for c in ("lang", "range", "automaton")]
    pairs = written(streamed(short, names, columns, _frequent_rows(least)), "frequent")
    heavy += [r.hash for r in pairs.where(F.col("a") > range_words).select("hash").collect()]
    long_ranges = Ranges(many, np.array(heavy, np.int64).view(np.uint64))
    long = _counted(texts, long_ranges, frequent_words, spark.sparkContext.broadcast(bit_map(pairs)), "phrases")
    longer = streamed(long, names, columns, _frequent_rows(least))
    candidates = written(pairs.unionAll(longer).drop("hash"), "candidates")

    split = F.split("phrase", " ")
    cuts = candidates.withColumn("words", split).select(
        "lang", "phrase", "a", F.explode(F.expr("transform(sequence(1, size - 1), k -> struct(k, array_join(slice(words, 1, k), ' ') AS head, array_join(slice(words, k + 1, size - k), ' ') AS tail))")).alias("cut")
    ).select("lang", "phrase", "a", "cut.*")
    cuts = written(cuts, "cuts")
    parts = cuts.select("lang", F.explode(F.array("head", "tail")).alias("phrase")).distinct().withColumn("long", F.size(split) > 2)
    parts = written(parts, "parts")
    found = written(
        _looked_up(parts.where("not long"), short, short_ranges).unionAll(_looked_up(parts.where("long"), long, long_ranges)), "found"
    )
    scored = (
        cuts.join(found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
        .join(found.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
        .withColumn("score", F.expr("(cast(2000000 as decimal(10,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + r)"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    )
    inner = candidates.where("size > 2").withColumn("words", split).select(
        "lang", "a", F.explode(F.expr(
            "flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), i -> array_join(slice(words, i, n), ' '))))"
        )).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("within"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        f"within is null or cast(100 as decimal(10,0)) * cast(within as decimal(19,0)) < cast({inside_percent} as decimal(10,0)) * cast(a as decimal(19,0))"
    )
    order = W.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    top = kept.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= most)
    return top.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score")
    )
