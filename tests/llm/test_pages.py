"""WARC archives and URL rules."""

import base64
import hashlib
import random
import uuid
from bisect import bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sales_engine.llm.url_rules import judge_urls
from sales_engine.llm.warc import _ranges, digest, read_warc, write_warc
from sales_engine.session import scratch_dir

PAGES = [(1, "http://a/", "x" * 900), (2, "http://b/", "x" * 900), (3, None, None), (4, "u", ""), (None, "v", "x" * 900), (5, "a\nb", "é"), (5, "a\nb", "é"), (None, None, "own")]


def expected(rows, least):
    last = {}
    for key, _, html in rows:
        if key is not None:
            last[html or ""] = max(key, last.get(html or "", key))
    seen, out = set(), []
    for key, _, html in rows:
        body = (html or "").encode()
        own = len(body) < least or last.get(html or "", key) == key
        first = (key, body) not in seen or key is None
        seen.add((key, body))
        is_response = own and first
        target = None if is_response else last[html or ""]
        sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((key, len(body), sha1, "response" if is_response else "revisit", target, (html or "") if is_response else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("least", [0, 1])
def test_archives_hold_every_page(spark, least):
    dst = scratch_dir(spark, "warc-test")
    manifest = write_warc(spark.createDataFrame(PAGES, "page_id long, url string, html string"), dst, revisit_bytes=least, roll_bytes=300)
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES) and manifest.count() > 2
    got = read_warc(spark, dst).collect()
    assert sorted(str((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload)) for r in got) == expected(PAGES, least)


def test_archives_are_the_same_again(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    sums = []
    for many in (2, 5):
        rows = write_warc(pages.repartition(many), scratch_dir(spark, "warc-test"), shard_bytes=50_000, roll_bytes=9_000).collect()
        sums.append(sorted((r.file, r.sha256) for r in rows))
    assert sums[0] == sums[1] and len(sums[0]) > 5


def test_heavy_clusters_far_apart_are_split(spark):
    keys = [cluster * 10**9 + i for cluster in range(8) for i in range(50)]
    sizes = spark.createDataFrame([(k, 100) for k in keys], "key long, bytes long").repartition(7)
    bounds = _ranges(sizes, 1000)
    shards = Counter(bisect_right(bounds, k) for k in keys)
    assert bounds == sorted(set(bounds)) and max(shards.values()) * 100 <= 1000
    assert bounds == _ranges(sizes.repartition(3, F.col("key") % 5), 1000)


def test_a_key_with_many_rows_is_cut_by_payload(spark):
    """A third of the rows share a key: they go to several shards, and every record still refers to the right one."""
    draw = random.Random(12)
    rows = [(7 if i % 3 == 0 else i, f"http://a/{i}", "x" * draw.randrange(3000) + str(i % 40)) for i in range(400)]
    rows += [(7, None, "long " * 50_000), (7, "http://a", ""), (7, "http://a", ""), (None, "http://b", None), (None, None, "long " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    dst = scratch_dir(spark, "warc-test")
    manifest = write_warc(pages, dst, shard_bytes=20_000, roll_bytes=5_000)
    assert manifest.select("shard").distinct().count() > 20
    back = read_warc(spark, dst).collect()
    want = Counter((k, len((t or "").encode()), digest((t or "").encode())) for k, _, t in rows)
    assert Counter((r.key, r.payload_bytes, r.payload_digest) for r in back) == want
    largest = {}
    for k, _, t in rows:
        d = digest((t or "").encode())
        largest[d] = max(largest.get(d, (False, 0)), (k is not None, k or 0))
    responses = Counter(r.payload_digest for r in back if r.record_type == "response")
    assert responses == Counter(largest.keys())
    assert all(r.key == largest[r.payload_digest][1] for r in back if r.record_type == "response" and largest[r.payload_digest][0])


def test_an_empty_table_writes_an_empty_manifest(spark):
    dst = scratch_dir(spark, "warc-test")
    assert write_warc(spark.createDataFrame([], "page_id long, url string, html string"), dst).count() == 0
    assert read_warc(spark, dst).count() == 0


def verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    ends = [rest.index(c) for c in "/?#" if c in rest]
    host, rest = (rest[: min(ends)], rest[min(ends) :]) if ends else (rest, "")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        ((len(h) + len(p), len(h), action == "block"), h + p, action)
        for action, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


@pytest.mark.parametrize("shards", [None, 1, 30])
def test_rules_against_all_of_them(spark, shards):
    draw = random.Random(6)
    labels = ["a", "b", "a-b", "ab", "x!", "org", "é"]
    hosts = [".".join(draw.choice(labels) for _ in range(draw.randint(1, 4))) for _ in range(50)]
    paths = ["", "/", "/a", "/a/", "/a/b", "/b", "/ab?q", "/é#x"]
    urls = [draw.choice(["http://", "://", "x"]) + draw.choice([*hosts, "A.ORG", "a..b", ".org"]) + draw.choice(paths) for _ in range(1000)]
    urls += [None, "", "http://", "a://b://c/d"] + ["http://a.org/hot"] * 500
    rules = [(draw.choice(["allow", "block"]), draw.choice([*hosts, "org"]), draw.choice(paths[:6])) for _ in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1)).repartition(4)
    table = spark.createDataFrame([*rules, (None, "a", "/"), ("block", None, "/")], "action string, host string, path string")
    got = judge_urls(pages, table, shards=shards).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(i, *verdict(u, rules)) for i, u in enumerate(urls)]
    clash = judge_urls(pages.drop("host").withColumnRenamed("page_id", "Host"), table, key="Host")
    assert clash.columns == ["Host", "host_", "path", "rule", "verdict"]
    assert sorted(map(tuple, clash.collect())) == sorted(map(tuple, got))
    assert judge_urls(pages.limit(0), table).count() == 0
    assert judge_urls(pages, table.limit(0)).where("verdict = 'allow' and rule is null").count() == len(urls)
