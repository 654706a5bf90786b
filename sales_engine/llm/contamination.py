"""Benchmark decontamination: a broadcast hash set of normalised word windows, in built-in functions only.

A window is ``WINDOW`` words of a benchmark item, or all words of a shorter one. A text is scanned once. With the
shortest window of s words, every window that occurs covers one of the blocks of b = (s + 1) / 2 words that lie b
words apart, so only one place in b is looked up. A scanned element is such a block with the words around it, enough
for every window over it: a hit of the block is verified there and then against the windows themselves, and only a row
a text and the verified hits are shuffled.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sales_engine.llm.arrow import quoted, spare
from sales_engine.llm.tables import written

WINDOW = 10
#: Windows and blocks are broadcast up to so many bytes of text; larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024
#: What lies between words, once A-Z are lower-cased; and the same before that.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
BETWEEN_AS_WRITTEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def normalised(text: Column) -> Column:
    """The words in lower case (A-Z only), each followed by one space."""
    whole = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(
        F.translate(whole, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.substring(F.regexp_replace(F.concat(F.lit(" "), lowered, F.lit(" ")), BETWEEN + "+", " "), 2, 2**31 - 1)


def _count(words: Column) -> Column:
    return F.char_length(words) - F.char_length(F.replace(words, F.lit(" "), F.lit("")))


class Windows:
    """The benchmark's windows as tables: ``window -> item_set``, ``item_set -> items``; and their block length."""

    def __init__(self, items: DataFrame, key: str, text: str, window: int, broadcast_bytes: int):
        whole = items.select(quoted(key).cast("string").alias("item"), normalised(quoted(text).cast("string")).alias("words"))
        # equal items are one from here on
        listed = whole.where("words <> ''").groupBy("words").agg(F.collect_set("item").alias("items"))
        words = listed.select("items", F.split(F.rtrim("words"), " ").alias("words"))
        places = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
        each = words.select("items", "words", F.explode(places).alias("at")).select(
            F.array_join(F.slice("words", F.col("at"), F.lit(window)), " ").alias("window"), "items"
        )
        sets = each.groupBy("window").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
        by_window = written(sets, "windows")
        self.sets = written(by_window.select("items").distinct().withColumn("item_set", F.monotonically_increasing_id()), "sets")
        length = _count(F.concat("window", F.lit(" ")))
        sizes = by_window.agg(F.collect_set(length), F.sum(F.octet_length("window") + 40)).first()
        self.sizes = sorted(sizes[0]) or [window]
        self.block = (self.sizes[0] + 1) // 2
        self.small = (sizes[1] or 0) <= broadcast_bytes
        self.by_window = by_window.join(self._held(self.sets), "items").select("window", "item_set")
        starts = F.sequence(F.lit(1), F.lit(self.block))
        self.blocks = (
            by_window.select(F.split("window", " ").alias("words"), F.explode(starts).alias("at"))
            .select(F.array_join(F.slice("words", F.col("at"), F.lit(self.block)), " ").alias("block"))
            .distinct()
        )

    def _held(self, table: DataFrame) -> DataFrame:
        return F.broadcast(table) if self.small else table

    def hits(self, keyed: DataFrame) -> DataFrame:
        """``k1, k2, n_words, start, end, item_set``: a row a text without the last three, and one for each window found."""
        b, most = self.block, self.block - 1 + self.sizes[-1]
        around = rf"(?=((?:[^ ]++ ){{{2 * b - 1},{most}}}+))(?:[^ ]++ ){{{b}}}"
        elements = F.regexp_extract_all("words", F.lit(around), 1)
        scanned = keyed.select(
            "k1", "k2", _count(F.col("words")).alias("n_words"), F.posexplode(F.concat(F.array(F.lit("")), elements)).alias("at", "element")
        )
        block = F.substring_index(F.substring_index("element", " ", 2 * b - 1), " ", -b)
        found = scanned.withColumn("block", block).join(
            self._held(self.blocks.withColumn("found", F.lit(True))), "block", "left"
        ).where("at = 0 or found")
        words = found.withColumn("words", F.split(F.rtrim("element"), " "))
        windows = [
            F.when(
                F.size("words") >= s + n,
                F.struct(((F.col("at") - 1) * b + s).alias("start"), F.lit(n).alias("size"), F.array_join(F.slice("words", s + 1, n), " ").alias("window")),
            )
            for s in range(b)
            for n in self.sizes
        ]
        tried = words.select(
            "k1", "k2", "n_words", F.explode(F.when(F.col("at") > 0, F.array_compact(F.array(*windows))).otherwise(F.array(F.lit(None)))).alias("try")
        ).select("k1", "k2", "n_words", "try.*")
        return (
            tried.join(self._held(self.by_window), "window", "left")
            .where("start is null or item_set is not null")
            .select("k1", "k2", "n_words", "start", (F.col("start") + F.col("size")).alias("end"), "item_set")
        )


def _keys(key: str, text: str) -> list[Column]:
    """Two hashes of key and text; rows that agree in both have one result."""
    whole = F.coalesce(quoted(text).cast("string"), F.lit(""))
    return [F.xxhash64(quoted(key), whole).alias("k1"), F.xxhash64(F.lit(1), whole, quoted(key)).alias("k2")]


def _judged(docs: DataFrame, windows: Windows, key: str, text: str) -> DataFrame:
    """``k1, k2, n_words, n_hit, firsts, lasts, last, sets`` of the different rows; what comes of the hits in order."""
    keyed = docs.select(*_keys(key, text), normalised(quoted(text).cast("string")).alias("words"))
    text_rows = W.partitionBy("k1", "k2").orderBy(F.asc_nulls_first("start"))
    before = F.max("end").over(text_rows.rowsBetween(W.unboundedPreceding, -1))
    marked = windows.hits(keyed).withColumn("before", F.coalesce(before, F.lit(0)))
    new = F.greatest(F.col("end") - F.greatest("start", "before"), F.lit(0))
    opens = F.col("start").isNotNull() & ((F.col("start") > F.col("before")) | (F.col("before") == 0))
    return marked.groupBy("k1", "k2").agg(
        F.max("n_words").cast("bigint").alias("n_words"),
        F.coalesce(F.sum(new), F.lit(0)).cast("bigint").alias("n_hit"),
        # a span ends where the next one opens, or with the last hit
        F.array_sort(F.collect_set(F.when(opens, F.col("start")))).alias("firsts"),
        F.array_sort(F.collect_set(F.when(opens & (F.col("before") > 0), F.col("before")))).alias("lasts"),
        F.max("end").alias("last"),
        F.collect_set("item_set").alias("sets"),
    )


def mark_contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    carry_text: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    with_spans: bool = False,
) -> DataFrame:
    """All rows of ``docs`` with ``n_words, n_hit, n_items, items_sha256, contaminated``.

    A word is hit if it lies inside any occurrence of a window. ``items_sha256`` is of the ids of the items whose
    windows occur, sorted as strings and joined by commas; an item without an id hits words but is neither
    counted nor listed. Items with equal words are looked up once. Null and empty texts have no words, on either
    side. Rows may share a key and may be repeated; an empty table of documents gives an empty result, one of items
    marks nothing. Columns named like an added one are replaced. ``with_spans`` adds ``spans``, the first word and
    the word after the last of each maximal run of hit words.
    """
    added = (*ADDED, "spans") if with_spans else ADDED
    rows = docs.drop(*[c for c in docs.columns if c.lower() in added])
    found = Windows(items, item_key, item_text, window, broadcast_bytes)
    judged = written(_judged(docs, found, key, text), "judged")
    listed = (
        judged.where("n_hit > 0")
        .select("k1", "k2", F.explode("sets").alias("item_set"))
        .join(found._held(found.sets), "item_set")
        .groupBy("k1", "k2")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("ids"))
    )
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    kept = rows if carry_text else rows.drop(text)
    row = F.struct(F.lit(True).alias("is"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(kept.columns)])
    result = docs.select(*_keys(key, text), row.alias("row")).join(judged, ["k1", "k2"]).join(listed, ["k1", "k2"], "left")
    lasts = F.when(F.col("n_hit") > 0, F.concat("lasts", F.array("last"))).otherwise(F.array().cast("array<int>"))
    spans = F.arrays_zip(F.col("firsts").alias("first"), lasts.alias("last")).alias("spans")
    return result.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept.columns)],
        "n_words",
        "n_hit",
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        *([spans] if with_spans else []),
    )


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", remove: str = "spans", **named: object) -> DataFrame:
    """``docs`` without what the benchmark holds: hit words with what stands before them, or whole documents.

    ``remove`` is ``spans`` or ``documents``. Columns stay those of ``docs``; a text that loses nothing stays as it is,
    null too. Other arguments are those of ``mark_contaminated``, whose cases hold here as well.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"unknown removal: {remove}")
    held = spare(docs, "held")
    packed = docs.select(F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias(held), *[quoted(c) for c in {named.get("key", "doc_id"), text}])
    marked = mark_contaminated(packed, items, text=text, with_spans=True, **named)
    if remove == "documents":
        return marked.where("not contaminated").select(*[F.col(f"{held}.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    pieces = F.regexp_extract_all(quoted(text), F.lit(rf"{BETWEEN_AS_WRITTEN}*+[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"), 0)
    tail = F.expr(f"substring(`{text}`, char_length(array_join(pieces, '')) + 1)")
    gaps = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["last"])).alias("first"),
        F.concat(F.transform("spans", lambda s: s["first"]), F.array(F.size("pieces"))).alias("last"),
    )
    left = F.transform(gaps, lambda g: F.array_join(F.slice("pieces", g["first"] + 1, g["last"] - g["first"]), ""))
    cut = marked.withColumn("pieces", F.when(F.col("contaminated"), pieces)).withColumn(
        "cut", F.when(F.col("contaminated"), F.concat(F.array_join(left, ""), tail)).otherwise(quoted(text))
    )
    return cut.select(*[F.col("cut").alias(c) if c == text else F.col(f"{held}.c{i}").alias(c) for i, c in enumerate(docs.columns)])
