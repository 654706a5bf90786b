"""Allow and block rules on hosts and paths, matched to URLs by a sort-merge range join.

Written backwards (``org.example.www.``) a host and all its subdomains share a prefix, so a rule's host is an
interval of the sorted keys, and intervals either nest or lie apart. URLs are dealt to shards, ranges of (key,
hash of the id), so a host with a third of all rows spans many; a rule goes to each shard its interval meets.
A task sweeps its sorted rows once and keeps a stack of the intervals that are open: those of the hosts above the
current one, each with its paths. No task holds more than this stack and a batch.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, append, beside, flat, quoted, streamed, type_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS_A_SHARD = 500_000
MOST_SHARDS = 10_000
SAMPLE_A_SHARD = 10


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or where ``://`` is missing."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def backwards(host: Column) -> Column:
    """Labels in reverse order, each with a dot behind it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class _Open:
    """An open interval of hosts with its rules by path."""

    def __init__(self, prefix: str):
        self.prefix, self.paths, self.lengths = prefix, {}, []

    def add(self, path: str, action: str) -> None:
        if self.paths.get(path) != "block":  # of two rules on the same host and path, block wins
            self.paths[path] = action
        self.lengths = sorted(set(map(len, self.paths)), reverse=True)

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in self.lengths if n <= len(path) and path[:n] in self.paths), None)


def _host(prefix: str) -> str:
    return ".".join(reversed(prefix[:-1].split(".")))


def _sweep(default: str):
    def work(batches: Iterator[Arrays]) -> Iterator[Arrays]:
        stack: list[_Open] = []
        here = None
        for columns in batches:
            out = []
            lists = [c.to_pylist() for c in columns[:-1]]
            for i, (shard, is_url, prefix, path, host, action) in enumerate(zip(*lists, strict=True)):
                if shard != here:
                    stack, here = [], shard
                while stack and not prefix.startswith(stack[-1].prefix):
                    stack.pop()
                if not is_url:
                    if not stack or stack[-1].prefix != prefix:
                        stack.append(_Open(prefix))
                    stack[-1].add(path, action)
                    continue
                best = (-1, -1, None, default)
                for level in stack:
                    found = level.longest(path)
                    if found is not None:
                        size = len(level.prefix) - 1
                        best = max(best, (size + len(found), size, _host(level.prefix) + found, level.paths[found]), key=lambda b: b[:2])
                out.append((i, host, path, *best[2:]))
            if out:
                at, *rest = map(list, zip(*out, strict=True))
                yield [columns[-1].take(pa.array(at)), *rest]

    return work


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow", shards: int | None = None
) -> DataFrame:
    """``key, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``action`` (allow or block), ``host`` and ``path``. A rule fits its host and all subdomains if
    the URL's path starts with the rule's; of those that fit the longest (host and path together, then the host)
    wins, and block where two are the same. Where none fits, ``rule`` is null and the verdict is ``default``. A null
    URL has an empty host and path. Rules without a host or an action are left out, a rule without a path
    fits every path. Rows may share a key or have none. A result's column that is named like ``key`` gets an underscore. An
    empty table gives an empty result.
    """
    spark = pages.sparkSession
    host, path = host_and_path(quoted(url))
    urls = pages.select(quoted(key).alias("id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("prefix", backwards(F.col("host")))
    urls = urls.withColumn("place", F.concat("prefix", F.lit("/"), F.hex(F.xxhash64("id", "path"))))
    if shards is None:
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pages.count() // ROWS_A_SHARD))
    shards = min(shards, MOST_SHARDS)
    # Bounds of even shards from a bounded sample; they decide where a row is judged, never how.
    sample = urls.select("place").orderBy(F.xxhash64("place")).limit(SAMPLE_A_SHARD * shards)
    places = sorted(r.place for r in sample.collect())
    bounds = spark.sparkContext.broadcast(sorted({places[len(places) * i // shards] for i in range(1, shards) if places}))

    def shard_of():
        return lambda columns: [[bisect_right(bounds.value, p) for p in columns[0].to_pylist()]]

    def shards_of():
        def work(columns: Arrays) -> Iterator[Arrays]:
            for action, prefix, rule_path in zip(*(c.to_pylist() for c in columns), strict=True):
                first = bisect_right(bounds.value, prefix)
                last = bisect_left(bounds.value, prefix[:-1] + "/", first)  # "/" comes after "." and ends the interval
                many = last - first + 1
                yield [list(range(first, last + 1)), [prefix] + [""] * (many - 1), [prefix] * many, [rule_path] * many, [action] * many]

        return work

    usable = rules.where("host is not null and action is not null")
    prefix = backwards(F.translate("host", UPPER, LOWER))
    opened = flat(
        usable,
        [F.col("action"), prefix, F.coalesce("path", F.lit(""))],
        "shard int, place string, prefix string, path string, action string",
        shards_of,
    )
    kind = type_of(urls, F.col("id"))
    none = F.lit(None)
    rows = append(urls, ["place"], "shard int", shard_of).select(
        "shard", F.lit(True).alias("is_url"), "prefix", "path", "host", none.cast("string").alias("action"), "id", "place"
    )
    rows = rows.unionAll(
        opened.select(
            "shard", F.lit(False).alias("is_url"), "prefix", "path", none.cast("string").alias("host"), "action",
            none.cast(kind).alias("id"), "place",
        )
    )
    ordered = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place", "is_url", "prefix", "path")
    return streamed(
        ordered,
        [F.col(c) for c in ("shard", "is_url", "prefix", "path", "host", "action", "id")],
        f"`{key}` {kind}, " + beside(key, "host string, path string, rule string, verdict string"),
        _sweep(default),
    )
