import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import views
from sales_engine.plans import reports
from sales_engine import jobs
from sales_engine.schemas import CSV_SALES, STREAM_SALES
from sales_engine.session import checkpointed, object_store_conf, scratch_dir, shared_dir, sized_for
from sales_engine.sources import jdbc
from sales_engine.sources.files import (
    compact, land_csv, read_delimited, read_json, stored_bytes, write_delimited, write_json,
)
from sales_engine.streaming.sales_stream import (
    decode, land_batch, read_landed, read_stream, run_until, start_landing, topic_options,
)


def parts(folder):
    return [f for f in Path(folder).rglob("part-*")]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_delimited_empty_is_null_and_header_must_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Date,StoreID,ProductID,QuantitySold,Revenue\nd,"",p,,1_err\n')
    for schema in (CSV_SALES, None):
        assert rows_of(read_delimited(spark, str(tmp_path / "*.csv"), schema)) == [("d", None, "p", None, "1_err")]
    (tmp_path / "a.csv").write_text("Date,Shop,ProductID,QuantitySold,Revenue\nd,1,p,2,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path / "*.csv"), CSV_SALES).collect()


def test_landing_replaces_what_was_there(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    df = spark.createDataFrame([("d", "1", "p", "2", "3_err"), (None, None, None, None, "x")], CSV_SALES)
    write_delimited(df, src)
    for _ in range(2):
        land_csv(spark, src, dst, CSV_SALES)
    assert rows_of(read_delimited(spark, dst)) == rows_of(df)


def test_json_schema_keeps_a_column_that_is_null_throughout(spark, tmp_path):
    df = spark.createDataFrame([("1", 2, None, 3, 4.0)], STREAM_SALES)
    write_json(df, str(tmp_path / "j"))
    assert rows_of(read_json(spark, str(tmp_path / "j"), STREAM_SALES)) == rows_of(df)
    assert "product_id" not in read_json(spark, str(tmp_path / "j")).columns


def test_compaction(spark, sf_dir, tmp_path):
    src = str(tmp_path / "small")
    df = views.sales_stream(spark, sf_dir)
    write_json(df.repartition(12), src)
    assert len(parts(src)) == 12
    one = str(tmp_path / "one")
    assert compact(spark, src, one, STREAM_SALES, files=1) == 1
    assert len(parts(one)) == 1
    some, size = str(tmp_path / "some"), stored_bytes(spark, src)
    asked = compact(spark, src, some, STREAM_SALES, target_file_bytes=size // 3 + 1)
    assert asked == 3 and len(parts(some)) <= 3
    want = rows_of(df)
    assert rows_of(read_json(spark, one, STREAM_SALES)) == want == rows_of(read_json(spark, some, STREAM_SALES))
    for bad in (src, src + "/below", str(tmp_path)):
        with pytest.raises(ValueError):
            compact(spark, src, bad, STREAM_SALES)


def test_decode(spark, ansi):
    lines = [
        "garbage", '{"store_id":2.5}', "", None, '{"timestamp":17,"store_id":3,"product_id":"p","quantity_sold":1',
        '{"timestamp":17,"store_id":3,"product_id":"","quantity_sold":null,"revenue":"not a number"}',
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    got = decode(df.select(F.col("value").cast("binary").alias("value"))).collect()
    assert [tuple(r) for r in got[:5]] == [(None,) * 5] * 5
    assert tuple(got[5]) == ("17", 3, "", None, None)


@pytest.fixture
def topic(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()

    def send(name, *lines):
        (folder / name).write_text("".join(f"{line}\n" for line in lines))

    def start(dst, checkpoint):
        stream = decode(read_stream(spark, "text", {"maxFilesPerTrigger": "1"}, str(folder)))
        assert run_until(start_landing(stream, str(tmp_path / dst), str(tmp_path / checkpoint), available_now=True), 120)
        return read_landed(spark, str(tmp_path / dst))

    return send, start


def message(store):
    return f'{{"timestamp":"1","store_id":{store},"product_id":"p","quantity_sold":1,"revenue":2.0}}'


def stores_of(df):
    return sorted(r.store_id for r in df.collect())


def test_stream_restarts_where_it_stopped(topic, tmp_path):
    send, start = topic
    send("1.txt", message(1), message(2))
    send("2.txt", message(3))
    assert stores_of(start("landed", "offsets")) == [1, 2, 3]
    send("3.txt", message(4))
    assert stores_of(start("landed", "offsets")) == [1, 2, 3, 4]
    runs = list((tmp_path / "landed").iterdir())
    assert len(runs) == 1 and len(list(runs[0].glob("batch_id=*"))) == 3


def test_a_new_checkpoint_does_not_overwrite(topic, tmp_path):
    send, start = topic
    send("1.txt", message(1))
    assert stores_of(start("landed", "first")) == [1]
    assert stores_of(start("landed", "second")) == [1, 1]


def test_replayed_batch_replaces_itself_and_empty_one_leaves_nothing(spark, tmp_path):
    dst = str(tmp_path / "landed")
    batch = spark.createDataFrame([("1", 2, "p", 3, 4.0)], STREAM_SALES)
    land_batch(batch.unionAll(batch), 0, dst)
    land_batch(batch, 0, dst)
    land_batch(batch.limit(0), 1, dst)
    assert rows_of(read_landed(spark, dst)) == rows_of(batch)
    assert os.listdir(f"{dst}/run=0") == ["batch_id=0"]


def test_a_failing_write_stops_the_stream(spark, topic, tmp_path):
    send, start = topic
    send("1.txt", message(1))
    (tmp_path / "landed").write_text("a file where the folder should be")
    with pytest.raises(Exception):
        start("landed", "offsets")
    (tmp_path / "landed").unlink()
    assert stores_of(start("landed", "offsets")) == [1]  # nothing was lost


def test_topic_options():
    assert topic_options("h:1") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "sales_stream", "startingOffsets": "latest",
    }
    more = topic_options("h:1", "t", "earliest", 10, 4)
    assert (more["maxOffsetsPerTrigger"], more["minPartitions"]) == ("10", "4")


def test_jdbc_options():
    assert jdbc.connection("jdbc:x", user="u") == {"url": "jdbc:x", "user": "u"}
    assert jdbc.partition_options("id", 5, 5, 4)["upperBound"] == "6"
    assert jdbc.bounds_query("Stores", "store_id") == "SELECT MIN(store_id) AS lo, MAX(store_id) AS hi FROM Stores"


def test_object_store_conf_has_no_keys_of_its_own():
    assert not any("key" in k for k in object_store_conf("http://store"))
    conf = object_store_conf("http://store", "a", "b")
    assert conf["spark.hadoop.fs.s3a.access.key"] == "a"


def test_scratch_is_under_the_named_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) == named and scratch_dir(spark, "x").startswith(named + "/x-")
    assert checkpointed(spark.range(5)).count() == 5


class Unnamed:
    """A session whose context has no checkpoint folder yet."""

    def __init__(self, master):
        self.master, self.folder = master, None
        self.sparkContext = self

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(Unnamed("spark://host:7077"))
    with pytest.raises(RuntimeError):
        shared_dir(Unnamed("local-cluster[2,1,1024]"))
    local = Unnamed("local[2]")
    assert shared_dir(local) == local.folder == shared_dir(local)


def test_partition_counts_follow_the_input(spark):
    keys = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    want = {0: (128 << 20, 4), 10 << 30: (128 << 20, 40), 100 << 40: ((100 << 40) // 100_000, 409_600)}
    before = [spark.conf.get(k, None) for k in keys]
    for size, counts in want.items():
        with sized_for(spark, size):
            assert tuple(int(spark.conf.get(k)) for k in keys) == counts
        assert [spark.conf.get(k, None) for k in keys] == before


@pytest.mark.parametrize(
    "argv",
    [
        ["report", "units_on_date", "--tables", "t"], ["report", "top_store", "--csv", "c"], ["build", "--stores", "s", "--dst", "d"],
        ["clean", "csv", "--src", "s"], ["clean", "csv", "--src", "s", "--url", "jdbc:x"],
    ],
)
def test_incomplete_commands_end_before_they_start(argv):
    with pytest.raises(SystemExit):
        jobs.parsed(argv)


def test_jobs_end_to_end(spark, sf_dir, tmp_path):
    """Raw files -> clean -> report through the commands, and the same through the build job."""
    names = "csv json stores landed clean_csv clean_stream clean_stores tables out1 out2"
    path = {n: str(tmp_path / n) for n in names.split()}
    write_delimited(views.sales_csv(spark, sf_dir), path["csv"])
    write_json(views.sales_stream(spark, sf_dir), path["json"])
    write_delimited(views.stores_export(spark, sf_dir), path["stores"])

    def run(*argv):
        args = jobs.parsed(argv)
        args.run(spark, args)

    run("land-csv", "--src", path["csv"], "--dst", path["landed"])
    run("clean", "csv", "--src", path["landed"], "--dst", path["clean_csv"])
    run("clean", "stream", "--src", path["json"], "--dst", path["clean_stream"])
    run("clean-stores", "--src", path["stores"], "--dst", path["clean_stores"])
    run("build", "--csv", path["csv"], "--stream", path["json"], "--stores", path["stores"], "--dst", path["tables"])
    for name in sorted([*jobs.WITH_STORES, *jobs.SALES_ONLY]):
        run("report", name, "--csv", path["clean_csv"], "--stream", path["clean_stream"],
            "--stores", path["clean_stores"], "--dst", f"{path['out1']}/{name}")
        run("report", name, "--tables", path["tables"], "--dst", f"{path['out2']}/{name}")
        ours, theirs = (read_delimited(spark, f"{path[o]}/{name}") for o in ("out1", "out2"))
        drop = ["fecha_Insercion"]
        assert rows_of(ours.drop(*drop)) == rows_of(theirs.drop(*drop)) != []
    run("report", "units_on_date", "--tables", path["tables"], "--date", "1998-08-23")


def test_units_on_date_matches_midnight_only(spark):
    sales = spark.sql(
        "select timestamp'1974-10-18 00:00:00' date, 3 quantity_Sold union all "
        "select timestamp'1974-10-18 05:00:00', 4 union all select timestamp'1974-10-18 00:00:00', 5"
    )
    assert [r.total_sold for r in reports.units_on_date(sales, "1974-10-18").collect()] == [8]


def test_files_with_another_column_order_fail(spark, tmp_path):
    for name, header in (("a", "Date,StoreID\n2024-01-01,7\n"), ("b", "StoreID,Date\n7,2024-01-01\n")):
        (tmp_path / f"{name}.csv").write_text(header)
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path)).collect()
