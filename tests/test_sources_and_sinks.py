import datetime as dt

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from samples import write_blocks
from tidemark.checkpoints import shared_folder
from tidemark.operators import word_count
from tidemark.schemas import KAFKA_ENVELOPE
from tidemark.sources import (
    as_instants,
    as_wall_clock,
    kafka_options,
    pack_envelope,
    read_kafka,
    read_lines,
    read_socket,
    read_table,
    read_table_stream,
)
from tidemark.streaming import (
    await_any,
    await_query,
    latest_per_key,
    run_to_table,
    to_console,
    to_memory,
    to_parquet_lake,
    word_count_per_batch,
    write_lake,
)

SF = "/root/testdata/sf0.001"


def test_kafka_options():
    assert kafka_options("h:9092", "taxirides", "latest") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "taxirides", "startingOffsets": "latest",
    }
    assert kafka_options("h:9092", "t", max_offsets_per_trigger=5, min_partitions=7)["minPartitions"] == "7"
    with pytest.raises(ValueError):
        kafka_options("h:9092", "t", "yesterday")


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        read_kafka(spark, "localhost:9092", "t")


def test_socket_lines_have_the_schema_of_file_lines(spark, tmp_path):
    write_blocks(tmp_path / "in", [["a"]])
    assert read_socket(spark).schema == read_lines(spark, str(tmp_path / "in")).schema


def test_envelope(spark):
    df = spark.sql("SELECT 7L AS id, 'text' AS v, timestamp'2020-01-01' AS t")
    got = pack_envelope(df, "topic", F.col("v"), F.col("t"), F.col("id"), F.col("id") % 4, F.col("id"), keep=["v"])
    assert [(f.name, f.dataType) for f in got.drop("v").schema] == [(f.name, f.dataType) for f in KAFKA_ENVELOPE]
    assert tuple(got.first()) == (b"7", b"text", "topic", 3, 7, dt.datetime(2020, 1, 1), 0, "text")


def test_table_streams_of_a_file_and_of_a_folder(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    for folder in (SF, str(tmp_path)):
        stream = read_table_stream(spark, folder, "events", max_files_per_trigger=2)
        assert stream.isStreaming and stream.schema == read_table(spark, folder, "events").schema
        assert run_to_table(stream).exceptAll(as_instants(events)).isEmpty()
        assert run_to_table(stream).count() == events.count()


def test_wall_clock_and_instants(spark):
    df = spark.sql("SELECT timestamp_ntz'2020-01-01 10:00:00' AS t, 1 AS n")
    there = as_instants(df)
    assert there.dtypes == [("t", "timestamp"), ("n", "int")]
    assert as_wall_clock(there).schema == df.schema and as_wall_clock(there).first() == df.first()


@pytest.fixture
def lines(spark, tmp_path):
    return read_lines(spark, write_blocks(tmp_path / "in", [["a b", "a"], ["b b"]]), max_files_per_trigger=1)


def test_update_complete_and_per_batch_word_counts(lines):
    counts = word_count(lines)
    updates = run_to_table(counts, "update")
    assert {tuple(r) for r in updates.collect()} == {("a", 2, 0), ("b", 1, 0), ("b", 3, 1)}
    assert {tuple(r) for r in latest_per_key(updates, ["value"]).collect()} == {("a", 2), ("b", 3)}
    assert {tuple(r) for r in run_to_table(counts, "complete").collect()} == {("a", 2), ("b", 3)}
    assert {tuple(r) for r in word_count_per_batch(lines).collect()} == {("a", 2, 0), ("b", 1, 0), ("b", 2, 1)}


def test_empty_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    counts = word_count(read_lines(spark, str(tmp_path / "in")))
    for mode in ("update", "complete"):
        assert run_to_table(counts, mode).count() == 0
    assert run_to_table(read_lines(spark, str(tmp_path / "in"))).count() == 0


def test_memory(spark, lines, tmp_path):
    query = to_memory(word_count(lines), "words_in_memory", "complete", str(tmp_path / "cp"), available_now=True)
    await_query(query, 120)
    assert {tuple(r) for r in spark.table("words_in_memory").collect()} == {("a", 2), ("b", 3)}


def test_console_and_triggers(spark, lines, tmp_path):
    query = to_console(word_count(lines), "words_on_console", "update", every="5 seconds")
    try:
        assert query.name == "words_on_console" and query.isActive
        query.processAllAvailable()
        assert sum(p["numInputRows"] for p in query.recentProgress) == 3
    finally:
        query.stop()
    await_query(to_console(lines, available_now=True), 120)


def test_waiting(spark, lines, tmp_path):
    query = to_console(lines, every="1 hour")
    with pytest.raises(TimeoutError):
        await_query(query, 1)
    assert not query.isActive
    spark.streams.resetTerminated()
    query = to_console(lines, available_now=True)
    await_any(spark, 120)
    assert not query.isActive
    broken = lines.select(F.raise_error(F.lit("broken")).cast("string").alias("value"))
    with pytest.raises(StreamingQueryException, match="broken"):
        await_query(to_console(broken, available_now=True), 120)


def test_lake(spark, tmp_path):
    orders = read_table_stream(spark, SF, "orders").withColumnRenamed("o_orderdate", "startTime")
    orders = orders.where("startTime < '1995-02-01'")
    path, checkpoint = f"{tmp_path}/lake", f"{tmp_path}/cp"
    for _ in range(2):  # the second run has nothing to add
        await_query(to_parquet_lake(orders, path, checkpoint, name="orders", available_now=True), 120)
    table = read_table(spark, SF, "orders").withColumnRenamed("o_orderdate", "startTime").where("startTime < '1995-02-01'")
    lake = spark.read.parquet(path)
    assert lake.drop("year", "month", "day").exceptAll(table).isEmpty() and lake.count() == table.count()
    day = lake.where("year = 1995 AND month = 1 AND day = 3")
    assert day.count() == table.where("to_date(startTime) = '1995-01-03'").count()
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan

    write_lake(table, f"{tmp_path}/written", by=("year", "month"))
    written = spark.read.parquet(f"{tmp_path}/written")
    assert written.select(*lake.columns).exceptAll(lake).isEmpty() and written.count() == lake.count()


class Session:
    """As much of a session as says where the shared folder is."""

    def __init__(self, master, named=None):
        self.conf, self.sparkContext = self, self
        self.master, self.named, self.folder = master, named, None

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_is_the_one_the_session_names():
    assert shared_folder(Session("yarn", "hdfs://shared/")) == "hdfs://shared"
    with pytest.raises(ValueError):
        shared_folder(Session("yarn"))
    local = Session("local[4]")
    assert shared_folder(local) == shared_folder(local) == local.folder
