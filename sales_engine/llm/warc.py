"""WARC archives written by sorted shards, with regenerated headers and digests, and read back.

Records are sorted by key and dealt to shards, ranges of keys of about equal bytes, from an exact histogram, so
the same rows give the same files on any cluster. A task writes its shards as a stream: one gzip member a
record, a new file as soon as the compressed size is reached. Files get temporary names; the rows that
describe them are a Spark result, so those of a lost or repeated task attempt never count. Only then are files
renamed and the manifest written. Readers go by the manifest alone.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, append, byte_texts, flat, quoted, streamed
from sales_engine.llm.tables import written

SHARD_BYTES = 64 * 1024 * 1024
#: Beyond so many shards they hold more bytes each; a task writes its shard as a stream of files, whatever its size.
MOST_SHARDS = 20_000
ROLL_BYTES = 16 * 1024 * 1024
DATE = "2000-01-01T00:00:00Z"
BLOCKS = 10_000
OVERHEAD = 600
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, part int, temporary string, file string, records bigint, bytes bigint, sha256 string"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- records ----------------------------------------------------------------------------------------------------


def _one_line(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    headers = [*headers, ("WARC-Block-Digest", "sha1:" + digest(block)), ("Content-Length", len(block))]
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers if v is not None], "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _identity(key: int | None, payload_digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{key}/{payload_digest}/{copy}')}>"


def page_record(key, url, payload: bytes, payload_digest: str, refers_to, is_revisit: bool, copy: int, date: str) -> bytes:
    """A response with its payload, or a revisit of the response ``refers_to`` without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", _identity(key, payload_digest, copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _one_line(url)),
        ("WARC-Payload-Digest", "sha1:" + payload_digest),
        ("WARC-Refers-To", _identity(refers_to, payload_digest) if is_revisit else None),
        ("WARC-Profile", PROFILE if is_revisit else None),
        ("X-Page-Key", key),
        ("X-Refers-To-Page-Key", refers_to if is_revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _record(headers, http if is_revisit else http + payload)


def _member(record: bytes) -> bytes:
    gzip = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gzip.compress(record) + gzip.flush()


def _file_system(uri: str):
    """A file system that executors reach without Spark, and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


# -- writing ----------------------------------------------------------------------------------------------------


class _Shard:
    """The files of one shard, written one after the other."""

    def __init__(self, dst: str, shard: int, roll_bytes: int, date: str):
        self.fs, self.root = _file_system(dst)
        self.shard, self.roll_bytes, self.date = shard, roll_bytes, date
        self.part, self.out, self.done = 0, None, []

    def write(self, record: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.root}/{self.temporary}")
            self.size, self.records, self.sum = 0, 0, hashlib.sha256()
            info = f"software: sales_engine\r\nformat: WARC File Format 1.1\r\nisPartOf: {self.name}\r\n".encode()
            self._append(_record(
                [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _identity(None, self.name)), ("WARC-Date", self.date),
                 ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info))
        self._append(record)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _append(self, record: bytes) -> None:
        member = _member(record)
        self.out.write(member)
        self.sum.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.part, self.temporary, self.name, self.records, self.size, self.sum.hexdigest()))
            self.part, self.out = self.part + 1, None


def _writer(dst: str, roll_bytes: int, date: str):
    """Rows sorted by shard, key, digest and kind: what a page's record refers to (0) comes before the page (1)."""

    def work(batches: Iterator[Arrays]) -> Iterator[Arrays]:
        shard, role, last, copy = None, None, None, 0
        for columns in batches:
            rows = zip(*[c.to_pylist() for c in columns[:6]], byte_texts(columns[6]), strict=True)
            for at, key, page_digest, kind, refers_to, url, payload in rows:
                if shard is None or shard.shard != at:
                    if shard is not None:
                        shard.close()
                        yield from _manifest_rows(shard)
                    shard = _Shard(dst, at, roll_bytes, date)
                here = (at, key, page_digest)
                if kind == 0:
                    role = (here, refers_to)
                    continue
                copy = copy + 1 if here == last else 0
                last = here
                own = role is None or role[0] != here
                target = key if own else role[1]
                # Of equal rows the first is the response, the others revisit it.
                shard.write(page_record(key, url, payload, page_digest, target, not own or copy > 0, copy, date))
            if shard is not None:
                yield from _manifest_rows(shard)
        if shard is not None:
            shard.close()
            yield from _manifest_rows(shard)

    return work


def _manifest_rows(shard: _Shard) -> Iterator[Arrays]:
    done, shard.done = shard.done, []
    if done:
        yield list(map(list, zip(*done, strict=True)))


def _finer(sizes: DataFrame, ranges: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
    """Bytes of the keys in the ranges (ascending, apart), by steps of ``width`` from each range's start."""
    shared = sizes.sparkSession.sparkContext.broadcast(np.array(ranges, object))

    def step_of():
        starts, ends = shared.value.T

        def work(columns: Arrays) -> Arrays:
            found = []
            for key in columns[0].to_pylist():
                at = bisect_right(starts, key) - 1
                inside = at >= 0 and key < ends[at]
                found.append(starts[at] + (key - starts[at]) // width * width if inside else None)
            return [found]

        return work

    steps = append(sizes, ["key"], "start bigint", step_of).where("start is not null")
    return [(r.start, r.bytes) for r in steps.groupBy("start").agg(F.sum("bytes").alias("bytes")).collect()]


def _ranges(sizes: DataFrame, shard_bytes: int) -> list[int]:
    """First keys of the shards after the first one: exact sums of bytes over ranges of keys, refined where heavy.

    The driver gets ``BLOCKS`` sums at most a round; a round makes the heavy ranges finer, down to one key.
    """
    low, high = sizes.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return []
    sums: list[tuple[int, int]] = []
    heavy = [(low, high + 1)]
    while heavy:
        width = max(1, -(-sum(b - a for a, b in heavy) // BLOCKS))
        rows, starts = _finer(sizes, heavy, width), [a for a, _ in heavy]
        # In order, as the next round's lookup needs them, and within the range they came from.
        heavy = sorted(
            (start, min(start + width, heavy[bisect_right(starts, start) - 1][1]))
            for start, size in rows
            if size > shard_bytes and width > 1
        )
        taken = {a for a, _ in heavy}
        sums += [(start, size) for start, size in rows if start not in taken]
    bounds, filled = [], 0
    for start, size in sorted(sums):
        if filled and filled + size > shard_bytes:
            bounds.append(start)
            filled = 0
        filled += size
    return bounds


class _Shards:
    """Shard of a row: by the range its key is in; a range that one key overfills is cut further by the digest.

    Rows equal in key and payload stay together, since all but the first refer to it; so do null-keyed rows with one payload.
    """

    def __init__(self, bounds: list[int], heavy: dict[int, int]):
        self.bounds = bounds
        self.many = [heavy.get(r, 1) for r in range(len(bounds) + 1)]
        self.first = [0, *np.cumsum(self.many).tolist()]

    def of(self, key: int | None, page_digest: str) -> int | None:
        if key is None:
            return None
        at = bisect_right(self.bounds, key)
        return self.first[at] + (zlib.crc32(page_digest.encode()) % self.many[at] if self.many[at] > 1 else 0)


def _shards(sizes: DataFrame, shard_bytes: int) -> _Shards:
    """Ranges of keys, and into how many shards the ranges of single heavy keys are cut."""
    bounds = _ranges(sizes, shard_bytes)
    shared = sizes.sparkSession.sparkContext.broadcast(bounds)

    def range_of():
        return lambda columns: [[bisect_right(shared.value, k) for k in columns[0].to_pylist()]]

    ranges = append(sizes, ["key"], "range int", range_of).groupBy("range").agg(
        F.sum("bytes").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    over = ranges.where((F.col("low") == F.col("high")) & (F.col("bytes") > shard_bytes)).collect()
    return _Shards(bounds, {r.range: -(-r.bytes // shard_bytes) for r in over})


def write_warc(
    pages: DataFrame,
    dst: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_bytes: int = 0,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write a record per row under ``dst``; returns the manifest, which is also ``dst/manifest``.

    Of rows with equal payloads of at least ``revisit_bytes`` bytes the one with the largest integer ``key`` is a
    response, the others revisit it. A null payload counts as empty, a null url is left out, rows without a key
    are spread over shards of their own. Of rows equal in key and payload one counts as the first. An empty
    table writes an empty manifest. Only the three columns are read.
    """
    whole = F.coalesce(quoted(payload).cast("string"), F.lit(""))
    rows = pages.select(quoted(key).cast("bigint").alias("key"), quoted(url).cast("string").alias("url"), whole.alias("payload"))

    def make():
        return lambda columns: [[digest(t) for t in byte_texts(columns[0])]]

    rows = append(rows, ["payload"], "digest string", make).select(
        "key", "url", "payload", "digest", F.octet_length("payload").cast("bigint").alias("bytes")
    )
    light = written(rows.select("key", "digest", "bytes"), "warc-digests")
    groups = light.where(F.col("bytes") >= revisit_bytes).groupBy("digest").agg(F.max("key").alias("refers_to"), F.count("*").alias("times"))
    groups = written(groups.where("times > 1").select("digest", "refers_to"), "warc-groups")
    roles = light.join(groups, "digest").where("not key <=> refers_to").select("key", "digest", "refers_to").distinct()

    keyed = light.select("key", (F.col("bytes") + OVERHEAD).alias("bytes"))
    total = keyed.agg(F.sum("bytes")).first()[0] or 0
    shard_bytes = max(shard_bytes, -(-total // MOST_SHARDS))
    ranged = _shards(keyed.where("key is not null"), shard_bytes)
    loose = keyed.where("key is null").agg(F.sum("bytes")).first()[0] or 0
    loose_shards = max(1, -(-loose // shard_bytes))
    shared = pages.sparkSession.sparkContext.broadcast(ranged)

    def shard_of():
        def work(columns: Arrays) -> Arrays:
            return [list(map(shared.value.of, *(c.to_pylist() for c in columns)))]

        return work

    def placed(df: DataFrame) -> DataFrame:
        spread = ranged.first[-1] + F.pmod(F.xxhash64("digest"), F.lit(loose_shards))
        return append(df, ["key", "digest"], "range int", shard_of).withColumn("shard", F.coalesce("range", spread.cast("int")))

    columns = ["shard", "key", "digest", "kind", "refers_to", "url", "payload"]
    none = F.lit(None).cast("string")
    told = placed(roles).select("shard", "key", "digest", F.lit(0).alias("kind"), "refers_to", none.alias("url"), none.alias("payload"))
    said = placed(rows).select(
        "shard", "key", "digest", F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("refers_to"), "url", "payload"
    )
    shards = ranged.first[-1] + loose_shards
    ordered = told.unionAll(said).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "key", "digest", "kind", "url")
    files = streamed(ordered, [F.col(c) for c in columns], MANIFEST, _writer(dst, roll_bytes, date))
    return _commit(written(files, "warc-files"), dst)


def _commit(files: DataFrame, dst: str) -> DataFrame:
    """Give the files their names, then write the manifest; may be repeated after a failure."""

    def rename():
        fs, root = _file_system(dst)

        def work(columns: Arrays) -> Arrays:
            from pyarrow.fs import FileType

            for temporary, name in zip(columns[0].to_pylist(), columns[1].to_pylist(), strict=True):
                if fs.get_file_info(f"{root}/{temporary}").type != FileType.NotFound:
                    fs.move(f"{root}/{temporary}", f"{root}/{name}")
            return [columns[1]]

        return work

    named = append(files, ["temporary", "file"], "renamed string", rename).drop("renamed", "temporary")
    named.write.parquet(f"{dst}/manifest")
    return files.sparkSession.read.schema(named.schema).parquet(f"{dst}/manifest")


# -- reading ----------------------------------------------------------------------------------------------------


def _members(stream) -> Iterator[bytes]:
    """Uncompressed gzip members of a file, one at a time."""
    rest, chunk = b"", 1 << 20
    while rest or (rest := stream.read(chunk)):
        gzip, parts = zlib.decompressobj(31), []
        while not gzip.eof:
            parts.append(gzip.decompress(rest))
            rest = gzip.unused_data
            if not gzip.eof and not (rest := stream.read(chunk)):
                raise ValueError("an archive ends within a record")
        yield b"".join(parts)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record; its block digest is checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if headers["warc-block-digest"] != "sha1:" + digest(block):
        raise ValueError(f"digest of {headers['warc-record-id']} is wrong")
    return headers, block


READ = "key bigint, url string, payload string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_warc(spark: SparkSession, src: str, payload: bool = True) -> DataFrame:
    """Page records of all files of the manifest, one record at a time in each task; digests are checked.

    ``payload`` is null for a revisit and if ``payload=False``. ``payload_bytes`` and ``payload_digest`` are
    always those of the full payload, computed anew for a response.
    """

    def make():
        fs, root = _file_system(src)

        def work(columns: Arrays) -> Iterator[Arrays]:
            for name in columns[0].to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for headers, block in map(parse, _members(stream)):
                        kind = headers["warc-type"]
                        if kind not in ("response", "revisit"):
                            continue
                        http, _, body = block.partition(b"\r\n\r\n")
                        told = headers["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and digest(body) != told:
                            raise ValueError(f"payload digest of {headers['warc-record-id']} is wrong")
                        length = len(body) if kind == "response" else int(http.rpartition(b"Content-Length: ")[2])
                        own, target = headers.get("x-page-key"), headers.get("x-refers-to-page-key")
                        rows.append(
                            (None if own in (None, "None") else int(own), headers.get("warc-target-uri"),
                             body.decode() if payload and kind == "response" else None, length, told, kind,
                             None if target in (None, "None") else int(target))
                        )
                        size += len(body) if payload else 0
                        if len(rows) >= 5000 or size > 1 << 24:
                            yield list(map(list, zip(*rows, strict=True)))
                            rows, size = [], 0
                if rows:
                    yield list(map(list, zip(*rows, strict=True)))

        return work

    manifest = spark.read.parquet(f"{src}/manifest").select("file")
    files = manifest.count()
    return flat(manifest.repartition(max(1, files)), [F.col("file")], READ, make)


