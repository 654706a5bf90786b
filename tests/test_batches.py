"""What appears whole or not at all: commits, incremental compaction, snapshots, staged loads; and the stream's stop and repair."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sales_engine import jobs
from sales_engine.schemas import STREAM_SALES
from sales_engine.sources import batches, jdbc
from sales_engine.sources.files import write_json
from sales_engine.sources.storage import CommitLog, Storage
from sales_engine.streaming import sales_stream as stream


def sales(spark, *ids):
    return spark.createDataFrame([(str(i), i, "p", 1, 2.0) for i in ids], STREAM_SALES)


def ids(df):
    return sorted(r.store_id for r in df.collect())


# -- commits ---------------------------------------------------------------


def test_commits_follow_one_another_and_one_of_two_writers_wins(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.last() == (0, {})
    with pytest.raises(FileNotFoundError):
        log.folder()
    assert log.commit(0, {"folder": "a"}) == 1 and log.commit(1, {"folder": "é"}) == 2
    with pytest.raises(RuntimeError):
        log.commit(1, {"folder": "late"})
    assert log.last() == (2, {"folder": "é"}) and log.folder().endswith("/log/é")
    assert not [p for p, _, _ in log.storage.files() if p.endswith(".tmp")]
    for n in range(2, 6):
        log.commit(n, {"folder": "x"})
    log.tidy("x-*", [], commits=2)
    assert log.last() == (6, {"folder": "x"}) and len(log.storage.files("_commits")) == 2


def test_storage_lists_files_and_folders(spark, tmp_path):
    store = Storage(spark, str(tmp_path))
    assert store.files("nothing") == [] and store.put_new("a=1/b=2/x.txt", "é") and not store.put_new("a=1/b=2/x.txt", "y")
    assert store.read("a=1/b=2/x.txt") == "é" and store.folders("a=*/b=*") == ["a=1/b=2"]
    assert [size for _, size, _ in store.files()] == [2]
    store.delete("a=1")
    assert not store.exists("a=1") and store.exists()


# -- compaction ------------------------------------------------------------


def test_spans():
    rng = random.Random(1)
    for _ in range(50):
        one, two = ([rng.randrange(30) for _ in range(rng.randrange(20))] for _ in range(2))
        both = batches.joined(batches.spans(one), batches.spans(two))
        assert both == batches.spans(one + two)
        assert {n for n in range(30) if batches.holds(both, n)} == {*one, *two}


def land(spark, root, run, batch, *numbers):
    write_json(sales(spark, *numbers), f"{root}/run={run}/batch_id={batch}")


def test_a_second_run_takes_only_new_batches(spark, tmp_path):
    src, dst = str(tmp_path / "landed"), str(tmp_path / "compacted")
    assert batches.compact_new(spark, src, dst, STREAM_SALES) == {}
    assert batches.read_compacted(spark, dst, STREAM_SALES).collect() == []
    land(spark, src, "a", 0, 1, 2)
    land(spark, src, "a", 1, 3)
    assert batches.compact_new(spark, src, dst, STREAM_SALES) == {"a": [0, 1]}
    land(spark, src, "a", 3, 4)  # batch 2 was empty
    land(spark, src, "b", 0, 5)
    land(spark, src, "a", 1, 3)  # replayed after it was taken
    half = f"{src}/run=a/batch_id=4"
    write_json(sales(spark, 99), half)
    Storage(spark, half).delete("_SUCCESS")  # still being written
    assert batches.compact_new(spark, src, dst, STREAM_SALES) == {"a": [3], "b": [0]}
    assert batches.compact_new(spark, src, dst, STREAM_SALES) == {}
    assert ids(batches.read_compacted(spark, dst, STREAM_SALES)) == [1, 2, 3, 4, 5]
    assert CommitLog(spark, dst).last()[1]["batches"] == {"a": [[0, 1], [3, 3]], "b": [[0, 0]]}
    assert batches.rewrite_compacted(spark, dst, STREAM_SALES) == 2
    assert batches.rewrite_compacted(spark, dst, STREAM_SALES) == 1
    assert ids(batches.read_compacted(spark, dst, STREAM_SALES)) == [1, 2, 3, 4, 5]
    assert batches.compact_new(spark, src, dst, STREAM_SALES) == {}
    assert len(Storage(spark, dst).folders("data-*")) == 1


@pytest.mark.parametrize("when", ["before the commit", "while writing"])
def test_a_crash_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, when):
    src, dst = str(tmp_path / "landed"), str(tmp_path / "compacted")
    land(spark, src, "a", 0, 1)
    batches.compact_new(spark, src, dst, STREAM_SALES)
    land(spark, src, "a", 1, 2)
    real = batches.write_json

    def broken(df, path, mode):
        real(df, path, mode)
        Storage(spark, path).delete("_SUCCESS")
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if when == "while writing":
            patch.setattr(batches, "write_json", broken)
        else:
            patch.setattr(CommitLog, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            batches.compact_new(spark, src, dst, STREAM_SALES)
    assert ids(batches.read_compacted(spark, dst, STREAM_SALES)) == [1]
    assert len(Storage(spark, dst).folders("data-*")) == 2
    assert batches.compact_new(spark, src, dst, STREAM_SALES) == {"a": [1]}
    assert ids(batches.read_compacted(spark, dst, STREAM_SALES)) == [1, 2]
    batches.compact_new(spark, src, dst, STREAM_SALES)
    assert len(Storage(spark, dst).folders("data-*")) == 2  # the left-over is gone


# -- snapshots and loads ---------------------------------------------------


def test_a_failed_snapshot_leaves_the_former_one(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "stores")
    first = spark.createDataFrame([("1", "a")], "store_id string, name string")
    jdbc.write_snapshot(first, root)
    real = jdbc.write_delimited

    def broken(df, path, mode):
        real(df, path, mode)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jdbc, "write_delimited", broken)
        with pytest.raises(OSError):
            jdbc.write_snapshot(first.limit(0), root)
    assert jdbc.read_snapshot(spark, root).collect() == [("1", "a")]
    for name in "bcd":
        jdbc.write_snapshot(first.withColumn("name", F.lit(name)), root, keep=2)
    assert jdbc.read_snapshot(spark, root).collect() == [("1", "d")]
    kept = CommitLog(spark, root).last()[1]["kept"]
    assert Storage(spark, root).folders("snapshot-*") == kept and len(kept) == 2


@pytest.mark.parametrize(
    "keys",
    [[1] * 700 + [2, 3, 3, 9] * 20 + list(range(100, 160)), ["", "a'b", "a", "ü"] * 9 + ["z"], [None, None], [], [5], list(range(1000))],
    ids=["skewed", "text", "nulls", "none", "one", "even"],
)
def test_predicates_cover_every_row_once(spark, keys):
    keys = [*keys, None, None]
    kind = "string" if any(isinstance(k, str) for k in keys) else "int"
    df = spark.createDataFrame([(k,) for k in keys], f"k {kind}")
    df.createOrReplaceTempView("keyed")
    starts = [r.lo for r in spark.sql(jdbc.starts_query("keyed", "k", 8)).collect()]
    predicates = jdbc.range_predicates("k", starts)
    found = [df.where(p) for p in predicates]
    assert Counter(r.k for part in found for r in part.collect()) == Counter(keys)
    later = spark.createDataFrame([(k,) for k in ([-5, 10**6] if kind == "int" else ["\x01", "zzz"])], f"k {kind}")
    assert sum(later.where(p).count() for p in predicates) == 2  # keys that came after the ends were worked out
    if len(set(keys)) > 100:
        assert max(part.where("k <> 1").count() for part in found) <= len(keys) / 8 + 1


def test_literals_of_keys():
    import datetime as dt

    assert jdbc.literal("o'x") == "'o''x'" and jdbc.literal(3) == "3" and jdbc.literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'"
    assert jdbc.literal(dt.datetime(2024, 1, 2, 3, 4, 5)) == "TIMESTAMP '2024-01-02 03:04:05'"
    for bad in (True, None, b"x"):
        with pytest.raises(TypeError):
            jdbc.literal(bad)


class Recorder:
    """Stands in for a JDBC connection."""

    def __init__(self, fails_at=None):
        self.calls, self.fails_at = [], fails_at

    def createStatement(self):  # noqa: N802
        return self

    def executeUpdate(self, text):  # noqa: N802
        self.calls.append(text)
        if self.fails_at is not None and self.fails_at in text:
            raise OSError("refused")

    def __getattr__(self, name):
        return lambda *args: self.calls.append(name)


def test_statements_run_as_one_transaction():
    good, bad = Recorder(), Recorder("second")
    jdbc.run_statements(good, ["first", "second"])
    assert good.calls == ["setAutoCommit", "first", "close", "second", "close", "commit"]
    with pytest.raises(OSError):
        jdbc.run_statements(bad, ["first", "second"])
    assert bad.calls[-1] == "rollback" and "commit" not in bad.calls


@pytest.mark.parametrize("replace", [False, True])
def test_a_repeated_task_doubles_no_row(spark, duck, tmp_path, replace):
    """The statements of the load, run by another SQL engine, over a staging table in which a task's rows are there twice."""
    con = duck.cursor()
    con.execute("CREATE TEMP TABLE target(a INT, b VARCHAR)")
    con.execute("INSERT INTO target VALUES (0, 'old')")
    df = spark.createDataFrame([(i, None if i % 7 == 0 else str(i % 3)) for i in range(50)], "a int, b string")
    df.write.parquet(str(tmp_path / "rows"))
    log = []

    def stage(rows):
        staged = rows.toPandas()
        twice = staged[staged[jdbc.LOAD_ROW] % 5 == 0]
        log.append(f"target_load_{len(staged)}")
        con.execute("CREATE TEMP TABLE staged AS SELECT * FROM staged UNION ALL SELECT * FROM twice")

    def transaction(_spark, _conn, statements):
        for text in statements:
            name = next(w for w in text.replace(")", " ").split() if w.startswith("target_load_"))if "target_load_" in text else None
            con.execute(text.replace(name, "staged") if name else text)

    def staged_rows():
        return con.execute(jdbc.staged_rows_query("staged")).fetchone()[0]

    n = jdbc.load_jdbc(spark.read.parquet(str(tmp_path / "rows")), {"url": "jdbc:x"}, "target", replace, transaction=transaction, stage=stage, staged_rows=staged_rows)
    want = sorted(((r.a, r.b) for r in df.collect()), key=repr) + ([] if replace else [(0, "old")])
    assert n == 50 and sorted(con.execute("SELECT * FROM target").fetchall(), key=repr) == sorted(want, key=repr)
    with pytest.raises(Exception, match="staged"):
        con.execute("SELECT * FROM staged")
    con.execute("DROP TABLE target")


def test_a_load_that_lacks_rows_moves_none(spark):
    ran = []
    df = spark.createDataFrame([(1,), (2,)], "a int")
    with pytest.raises(RuntimeError, match="1 of 2"):
        jdbc.load_jdbc(df, {"url": "u"}, "t", transaction=lambda *a: ran.extend(a[2]), stage=lambda rows: None, staged_rows=lambda: 1)
    assert len(ran) == 1 and ran[0].startswith("DROP TABLE t_load_")
    with pytest.raises(ValueError):
        jdbc.load_jdbc(df.withColumnRenamed("a", "a;b"), {"url": "u"}, "t")
    assert jdbc.load_options({"url": "u"}, "t", 5, 6) == {"url": "u", "dbtable": "t", "batchsize": "5", "numPartitions": "6"}


# -- the stream ------------------------------------------------------------


def test_options_of_a_range():
    got = stream.topic_range_options("h:1", {1: 5, 0: 0}, {0: 7, 1: 5}, "t", 8)
    assert got["assign"] == '{"t": [0, 1]}' and got["startingOffsets"] == '{"t": {"0": 0, "1": 5}}'
    assert got["endingOffsets"] == '{"t": {"0": 7, "1": 5}}' and got["failOnDataLoss"] == "true" and got["minPartitions"] == "8"
    for start, end in (({0: 1}, {1: 2}), ({0: 3}, {0: 2}), ({0: -1}, {0: 2})):
        with pytest.raises(ValueError):
            stream.topic_range_options("h:1", start, end)


def test_a_range_is_decoded_and_landed_as_the_stream_does_it(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    lines = '{"timestamp":"1","store_id":2,"revenue":"x"}\n{"store_id":\n{"product_id":"p"}\n'
    (tmp_path / "topic" / "a.txt").write_text(lines)
    topic, one, two = (str(tmp_path / n) for n in ("topic", "one", "two"))
    messages = stream.decode(stream.read_stream(spark, "text", path=topic))
    stream.run_until(stream.start_landing(messages, one, str(tmp_path / "c"), available_now=True))
    for _ in range(2):
        stream.land_range(stream.read_range(spark, "text", path=topic), two, "repair-1")
    assert sorted(map(repr, stream.read_landed(spark, one).collect())) == sorted(map(repr, stream.read_landed(spark, two).collect()))
    assert stream.read_landed(spark, two).count() == 3


@pytest.mark.parametrize("seed", range(4))
def test_missing_offsets(spark, monkeypatch, seed):
    monkeypatch.setattr(stream, "_BLOCK_BITS", 3)
    rng = random.Random(seed)
    start, end = {0: 3, 1: 0, 2: 5, 3: 9}, {0: 90, 1: 41, 2: 5, 3: 70}
    there = [(p, n) for p in (0, 1, 2) for n in range(0, 95) if rng.random() < (0.9, 0.4, 0.97)[p] and not 30 < n < 50]
    df = spark.createDataFrame(there + there[:9], "partition int, offset long")
    got = [n for r in stream.missing_offsets(df, start, end).collect() for n in ((r["partition"], o) for o in range(r["first"], r["last"] + 1))]
    assert sorted(got) == sorted((p, o) for p in start for o in range(start[p], end[p]) if (p, o) not in set(there))


def test_landing_stops_between_batches(spark, tmp_path, monkeypatch):
    topic = tmp_path / "topic"
    topic.mkdir()
    for i in range(6):
        (topic / f"{i}.txt").write_text("" if i == 1 else f'{{"store_id":{i}}}\n')
        time.sleep(0.02)
    real = stream.land_batch

    def slow(batch, batch_id, dst, run):
        time.sleep(0.7)
        real(batch, batch_id, dst, run)

    monkeypatch.setattr(stream, "land_batch", slow)
    dst, checkpoint = str(tmp_path / "landed"), str(tmp_path / "c")
    messages = stream.decode(stream.read_stream(spark, "text", {"maxFilesPerTrigger": "1"}, str(topic)))
    log = stream.ProgressLog()
    spark.streams.addListener(log)
    try:
        landing = stream.Landing(messages, dst, checkpoint, "50 milliseconds")
        while (landing.committed() or 0) < 1:
            time.sleep(0.02)
        time.sleep(0.3)  # a batch is in flight
        last = landing.stop()
        assert last == 2 and landing.failure() is None and not landing.query.isActive
        folders = Storage(spark, dst).folders("run=*/batch_id=*")
        assert [f.rsplit("=", 1)[1] for f in folders] == ["0", "2"]  # the batch without rows wrote nothing
        until = time.monotonic() + 20
        while len(log.rows_of_batches(landing.query.id)) < 3 and time.monotonic() < until:
            time.sleep(0.05)
        assert list(log.rows_of_batches(landing.query.id).values())[:3] == [1, 0, 1]
    finally:
        spark.streams.removeListener(log)
    stream.run_until(stream.start_landing(messages, dst, checkpoint, available_now=True))
    assert ids(stream.read_landed(spark, dst)) == [0, 2, 3, 4, 5]
    assert stream.Landing(messages, dst, checkpoint, available_now=True).stop() >= 5


def test_a_landing_that_fails_says_so(spark, tmp_path, monkeypatch):
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "a.txt").write_text("{}\n")
    monkeypatch.setattr(stream, "land_batch", lambda *_: 1 / 0)
    messages = stream.decode(stream.read_stream(spark, "text", path=str(tmp_path / "topic")))
    landing = stream.Landing(messages, str(tmp_path / "d"), str(tmp_path / "c"), "50 milliseconds")
    while landing.query.isActive:
        time.sleep(0.05)
    assert landing.stop() is None and "division" in landing.failure()


def test_commands_of_the_new_jobs(spark, tmp_path):
    src, dst = str(tmp_path / "landed"), str(tmp_path / "compacted")
    land(spark, src, "a", 0, 1)
    args = jobs.parsed(["compact-new", "--src", src, "--dst", dst])
    args.run(spark, args)
    assert ids(batches.read_compacted(spark, dst, STREAM_SALES)) == [1]
    args = jobs.parsed(["land-range", "--servers", "h", "--dst", "d", "--name", "r", "--start", '{"0": 1}', "--end", '{"0": 2}'])
    assert args.run is jobs._land_range and args.topic == "sales_stream"
    args = jobs.parsed(["snapshot-stores", "--url", "u", "--table", "t", "--dst", "d", "--by-quantiles", "--versions", "3"])
    assert args.by_quantiles and args.versions == 3
