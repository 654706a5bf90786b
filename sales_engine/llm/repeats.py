"""Removal of bytes in long repeated strings, by prefix-free parsing.

Rolling-hash triggers cut every text into phrases (``phrases.py``); the phrases are the dictionary, a text's
sequence of them is its parse. A string of ``length`` bytes is the end of one phrase followed by the parse from
the next trigger on, so two strings are equal exactly if both parts are. The corpus order of prefix-free
parsing sorts by these two parts. Only equality matters for removal, so the order here is that of their hashes
(equal strings are neighbours in it as in the order of bytes, and 8 bytes move instead of 400) and Spark's
aggregates do the sorting:

1. *Parse.* Phrases are grouped by the context after their trigger. A context that occurs once ends the matter
   for its strings, and most phrases go here. If all phrases of a group are equal too, all their strings repeat.
2. *Dictionary.* In the other groups the distinct phrases are counted. One that occurs twice repeats wholly.
3. *Both.* The rest differ in the bytes before or after. Their strings are put in cells of eight neighbours,
   grouped by the bytes a cell shares, and where the cells of a group differ, by the single string.

Every level groups by a hash with a partial sum in each task, and takes the answer back by an equality join that
adaptive execution can split, so a passage that a third of all texts share is no task's burden. No level
lists pairs. Work on a text is one Arrow batch at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, append, byte_texts, flat, quoted
from sales_engine.llm.phrases import REACH, context_bytes, phrases, range_hash
from sales_engine.llm.runs import MARK_WORDS, once, word_runs
from sales_engine.llm.tables import written

CELL = 8
#: Place of a phrase in its text: the trigger, and how far before it its first and last start lie.
_SPAN = REACH.bit_length() - 1


def _phrase_rows(length: int):
    def make():
        hashes = range_hash()

        def work(columns: Arrays) -> Iterator[Arrays]:
            for p in phrases(byte_texts(columns[1]), length, hashes):
                place = (p.trigger << 2 * _SPAN) | ((p.trigger - p.first) << _SPAN) | (p.trigger - p.last)
                yield [
                    columns[0].take(pa.array(p.text)), pa.array(place), pa.array(p.context.view(np.int64)), pa.array(p.whole.view(np.int64)),
                ]

        return work

    return make


def _unpacked(place: int) -> tuple[int, int, int]:
    """Trigger and the distances to it of the first and the last start."""
    return place >> 2 * _SPAN, (place >> _SPAN) & (REACH - 1), place & (REACH - 1)


def _mixed_rows(length: int):
    """Phrases in groups that hold several: context, phrase, where, and the bytes in which the group differs."""
    shared = context_bytes(length)

    def make():
        def work(columns: Arrays) -> Iterator[Arrays]:
            keys, texts, lists = columns
            for i, (text, places) in enumerate(zip(byte_texts(texts), lists.to_pylist(), strict=True)):
                rows = []
                for place in places:
                    trigger, far, near = _unpacked(place)
                    before = text[trigger - far : trigger]
                    after = text[trigger + shared : trigger - near + length]
                    context = xxhash.xxh3_64_intdigest(text[trigger : trigger + shared])
                    whole = xxhash.xxh3_64_intdigest(b"%d %d " % (far, near) + before + after)
                    rows.append((context - 2**63, whole - 2**63, place, before, after))
                if rows:
                    yield [keys.take(pa.array(np.full(len(rows), i))), *map(list, zip(*rows, strict=True))]

        return work

    return make


def _cell_rows(length: int):
    """Cells of the starts of distinct phrases, with the up to seven bytes on either side in which they differ."""
    side = length - context_bytes(length)

    def make():
        def work(columns: Arrays) -> Iterator[Arrays]:
            rows = []
            for at, (context, place, before, after) in enumerate(zip(*(c.to_pylist() for c in columns[1:]), strict=True)):
                _, far, near = _unpacked(place)
                for cell in range(near // CELL, far // CELL + 1):
                    low, high = cell * CELL, cell * CELL + CELL - 1
                    left = before[len(before) - low :] if low else b""
                    key = xxhash.xxh3_128_digest(b"%d %d " % (context, cell) + left + after[: side - high])
                    more = before[max(0, len(before) - high) : len(before) - low][::-1]
                    rows.append(
                        (at, key, cell, max(near, low) - low, min(far, high) - low, int.from_bytes(more, "little"),
                         int.from_bytes(after[side - high : side - low], "little"))
                    )
                if len(rows) > 20_000:
                    yield [columns[0].take(pa.array([r[0] for r in rows])), *map(list, list(zip(*rows, strict=True))[1:])]
                    rows = []
            if rows:
                yield [columns[0].take(pa.array([r[0] for r in rows])), *map(list, list(zip(*rows, strict=True))[1:])]

        return work

    return make


def _mark_rows(words: int):
    """Each mark of a text once."""

    def make():
        def work(columns: Arrays) -> Iterator[Arrays]:
            for text, mark, _ in word_runs(byte_texts(columns[1]), words):
                text, mark = once(text, mark)
                yield [columns[0].take(pa.array(text)), pa.array(mark)]

        return work

    return make


def _run_rows(words: int):
    """Each run of a text once, of those whose mark another row has."""

    def make():
        def work(columns: Arrays) -> Iterator[Arrays]:
            keys, texts, lists = columns
            for i, (text, marks) in enumerate(zip(byte_texts(texts), lists, strict=True)):
                for _, mark, run in word_runs([text], words):
                    run = np.unique(run[np.isin(mark, marks.values.to_numpy(zero_copy_only=False))])
                    yield [keys.take(pa.array(np.full(len(run), i))), pa.array(run)]

        return work

    return make


def _without(length: int, least_words: int):
    """Text without the bytes that repeated strings cover, and its figures. A place is a first and last start."""

    def make():
        def work(columns: Arrays) -> Arrays:
            kept, removed, spans, digests = [], [], [], []
            for text, sure, found in zip(byte_texts(columns[0]), columns[1].to_pylist(), columns[2].to_pylist(), strict=True):
                covered = []
                for place in sure or ():
                    trigger, far, near = _unpacked(place)
                    covered.append((trigger - far, trigger - near + length))
                covered += [(f["first"], f["last"] + length) for f in found or ()]
                runs = []
                for first, last in sorted(covered):
                    if not runs or first > runs[-1][1]:
                        runs.append([first, last])
                    elif last > runs[-1][1]:
                        runs[-1][1] = last
                if least_words:
                    runs = [(first, last) for first, last in runs if len(text[first:last].split()) >= least_words]
                gone = sum(last - first for first, last in runs)
                edges = [0, *chain.from_iterable(runs), len(text)]
                rest = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
                kept.append(rest.decode("utf-8", "ignore"))
                removed.append(gone)
                spans.append(len(runs))
                digests.append(hashlib.sha256(rest).hexdigest())
            return [kept, removed, spans, digests]

        return work

    return make


def _repeated(rows: DataFrame, by: list[str], alike: Column) -> DataFrame:
    """Keys ``by`` that several rows have, with ``uniform``: whether these rows agree in ``alike``.

    A written table, so that a join to it shuffles both sides anew: only then can Spark split a frequent key.
    """
    groups = rows.groupBy(*by).agg(F.count("*").alias("times"), F.min(alike).alias("low"), F.max(alike).alias("high"))
    return written(groups.where("times > 1").select(*by, (F.col("low") == F.col("high")).alias("uniform")), "groups")


def _found_in_classes(staged: DataFrame, length: int) -> DataFrame:
    """``key, first, last``: repeated starts of the phrases whose groups hold several phrases (levels 2 and 3)."""
    here = ["k1", "k2", "place"]
    rows = flat(
        staged.where("size(unsure) > 0"),
        [F.struct("k1", "k2"), F.col("text"), F.col("unsure")],
        "key struct<k1:bigint,k2:bigint>, context bigint, whole bigint, place bigint, before binary, after binary",
        _mixed_rows(length),
    ).select("key.k1", "key.k2", "context", "whole", "place", "before", "after")
    classes = rows.groupBy("context", "whole").agg(
        F.count("*").alias("times"), *[F.min(c).alias(c) for c in (*here, "before", "after")]
    )
    classes = written(classes, "classes")
    again = classes.where("times > 1").select("context", "whole")
    trigger = F.shiftright("place", 2 * _SPAN)
    first = trigger - F.shiftright("place", _SPAN).bitwiseAND(REACH - 1)
    last = trigger - F.col("place").bitwiseAND(REACH - 1)
    settled = rows.select("context", "whole", *here).join(again, ["context", "whole"]).select("k1", "k2", first.alias("first"), last.alias("last"))

    cells = flat(
        classes,
        [F.struct((F.col("times") == 1).alias("open"), "k1", "k2", trigger.alias("trigger")), *map(F.col, ("context", "place", "before", "after"))],
        "at struct<open:boolean,k1:bigint,k2:bigint,trigger:bigint>, shared binary, cell int, low int, high int, before bigint, after bigint",
        _cell_rows(length),
    )
    common = _repeated(cells, ["shared"], F.xxhash64("before", "after", "low", "high"))
    cells = written(cells.join(common, "shared"), "cells")
    start = F.col("at.trigger") - F.col("cell") * CELL
    whole = cells.where("uniform and at.open").select(
        "at.k1", "at.k2", (start - F.col("high")).alias("first"), (start - F.col("low")).alias("last")
    )
    steps = cells.where("not uniform").select(
        "at", "cell", "shared", "before", "after", F.explode(F.sequence("low", "high")).alias("step")
    )

    def low_bytes(column: str, many: Column) -> Column:
        return F.col(column).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), 8 * many) - 1).alias(column)

    singles = steps.select(
        "at", "cell", "shared", "step", low_bytes("before", F.col("step")), low_bytes("after", CELL - 1 - F.col("step"))
    )
    string = ["shared", "step", "before", "after"]
    twice = _repeated(singles, string, F.lit(1)).drop("uniform")
    one = (F.col("at.trigger") - F.col("cell") * CELL - F.col("step")).alias("first")
    single = singles.where("at.open").join(twice, string).select("at.k1", "at.k2", one, one.alias("last"))
    return settled.unionAll(whole).unionAll(single)


def _shared_marks(keyed: DataFrame, words: int) -> DataFrame:
    """``k1, k2, marks``: the marks of a text that another row has too."""
    rows = flat(
        keyed,
        [F.col("key"), F.col("text")],
        "key struct<k1:bigint,k2:bigint>, mark bigint",
        _mark_rows(words),
    )
    rows = written(rows.select("key.k1", "key.k2", "mark"), "marks")
    twice = _repeated(rows, ["mark"], F.lit(1)).drop("uniform")
    return rows.join(twice, "mark").groupBy("k1", "k2").agg(F.collect_set("mark").alias("marks"))


def _shared_runs(staged: DataFrame, words: int) -> DataFrame:
    """``k1, k2, n_shared_runs``: how many different runs of a text another row has too."""
    rows = flat(
        staged.where("marks is not null"),
        [F.struct("k1", "k2"), F.col("text"), F.col("marks")],
        "key struct<k1:bigint,k2:bigint>, run bigint",
        _run_rows(words),
    )
    rows = written(rows.select("key.k1", "key.k2", "run"), "runs")
    twice = _repeated(rows, ["run"], F.lit(1)).drop("uniform")
    return rows.join(twice, "run").groupBy("k1", "k2").agg(F.count_distinct("run").alias("n_shared_runs"))


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = 400,
    keep_text: bool = True,
    least_words: int = 0,
    run_words: int = 0,
) -> DataFrame:
    """``docs`` without any byte that a string of ``length`` bytes covers which also starts elsewhere.

    Strings are those of the input (not of what is left), never cross texts, and may overlap; every occurrence
    goes, the first too. Columns added: ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_sha256`` (of the remaining bytes), ``n_anchors`` (phrases whose context, ``length - 127`` bytes, occurs elsewhere: a text
    with some but without removed bytes shares shorter passages). ``text`` becomes the rest; bytes of a character that was cut
    apart are dropped from it (not from the digest). With ``keep_text=False`` the text may be null in the result,
    which saves room. A null text counts as empty and becomes empty. Rows may share a ``key`` or have none; equal
    rows repeat each other. An empty table gives an empty result. Columns of ``docs`` named like an added one are
    replaced. With ``least_words`` a maximal run of fewer words (parted by blanks; the ends of cut ones count) stays.
    With ``run_words``, 21 or more, there is also ``n_shared_runs``: the different runs of so many words, however few bytes they
    have, that another row has too. It removes nothing.
    """
    if run_words and run_words <= MARK_WORDS:
        raise ValueError(f"run_words must be more than {MARK_WORDS}")
    if length < REACH + 2 * CELL:
        raise ValueError(f"length must be at least {REACH + 2 * CELL}")
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "n_anchors", *(["n_shared_runs"] if run_words else [])]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    others = [c for c in docs.columns if c != text]
    whole = F.coalesce(quoted(text).cast("string"), F.lit(""))
    # Rows of one key pair have one text, so what is found for one holds for all.
    keyed = docs.select(
        F.struct(F.xxhash64(quoted(key), whole).alias("k1"), F.xxhash64(F.lit(1), whole, quoted(key)).alias("k2")).alias("key"),
        whole.alias("text"),
        F.struct(F.lit(True).alias("is"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(others)]).alias("row"),
    )
    rows = flat(
        keyed.where(F.octet_length("text") >= length),
        [F.col("key"), F.col("text")],
        "key struct<k1:bigint,k2:bigint>, place bigint, context bigint, whole bigint",
        _phrase_rows(length),
    )
    groups = _repeated(rows, ["context"], F.col("whole"))
    places = (
        rows.select("key.k1", "key.k2", "place", "context")
        .join(groups, "context")
        .groupBy("k1", "k2")
        .agg(
            F.collect_set(F.when(F.col("uniform"), F.col("place"))).alias("sure"),
            F.collect_set(F.when(~F.col("uniform"), F.col("place"))).alias("unsure"),
        )
    )
    if run_words:
        places = places.join(_shared_marks(keyed, run_words), ["k1", "k2"], "full_outer")
    else:
        places = places.withColumn("marks", F.lit(None).cast("array<bigint>"))
    marked = keyed.select("key.k1", "key.k2", "row", "text").join(places, ["k1", "k2"], "left")
    clean = F.col("sure").isNull() & F.col("marks").isNull()
    staged = written(
        marked.select(
            F.when(~clean, F.col("k1")).alias("k1"),
            F.when(~clean, F.col("k2")).alias("k2"),
            "row",
            (F.col("text") if keep_text else F.when(~clean, F.col("text"))).alias("text"),
            "sure",
            "unsure",
            "marks",
            F.octet_length("text").cast("bigint").alias("n_bytes"),
            F.when(F.col("sure").isNull(), 0).otherwise(F.size("sure") + F.size("unsure")).cast("bigint").alias("n_anchors"),
            F.when(clean, F.sha2("text", 256)).alias("kept_sha256"),
        ),
        "marked",
    )
    dirty = staged.where("k1 is not null")
    found = (
        _found_in_classes(dirty, length).groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("found"))
    )
    zero = F.lit(0).cast("bigint")
    if run_words:
        found = found.join(_shared_runs(staged, run_words), ["k1", "k2"], "full_outer")
    else:
        found = found.withColumn("n_shared_runs", zero)
    cut = append(
        dirty.join(found, ["k1", "k2"], "left").select(
            "row", "n_bytes", "n_anchors", F.coalesce("n_shared_runs", zero).alias("n_shared_runs"), "text", "sure", "found"
        ),
        ["text", "sure", "found"],
        "text string, n_removed bigint, n_spans bigint, kept_sha256 string",
        _without(length, least_words),
    )
    untouched = staged.where("k1 is null").select(
        "row", "n_bytes", "n_anchors", zero.alias("n_shared_runs"), "text", zero.alias("n_removed"), zero.alias("n_spans"), "kept_sha256"
    )
    result = cut.select(*untouched.columns).unionAll(untouched)
    return result.select(
        *[F.col("text").alias(c) if c == text else F.col(f"row.c{others.index(c)}").alias(c) for c in docs.columns],
        *added,
    )
