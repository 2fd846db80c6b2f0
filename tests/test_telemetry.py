"""The traffic sample, as a table and replayed block by block."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from samples import TRAFFIC_BLOCKS, traffic_blocks, traffic_line, write_blocks
from tidemark.functions import parse_java_date
from tidemark.operators import avg_by, count_by, decode_json, dedup, first_by, windowed_avg, windowed_count
from tidemark.schemas import TRAFFIC
from tidemark.sources import read_lines
from tidemark.streaming import latest_per_key, run_to_table


def decoded(lines):
    return decode_json(lines, TRAFFIC).withColumn("eventTime", parse_java_date("time"))


@pytest.fixture
def readings(spark):
    lines = [line for block in traffic_blocks() for line in block]
    lines += ["", "a line between blocks", "another one"]
    return decoded(spark.createDataFrame([(line,) for line in lines], "value string"))


def local(row_time):
    """Clock time in India of an instant collected in UTC."""
    return (row_time + dt.timedelta(hours=5, minutes=30)).strftime("%H:%M:%S")


START = dt.datetime(2022, 11, 8)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def rows(df, digits=4):
    return {tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()}


def test_lines_that_are_no_readings_are_one_reading_without_id(readings):
    assert readings.where("vehicleId IS NULL").count() == 3
    assert dedup(readings, ["vehicleId"], "eventTime").where("vehicleId IS NULL").count() == 1


def test_counts_and_averages(readings):
    first = dedup(readings, ["vehicleId"], "eventTime")
    assert rows(count_by(first, ["vehicleType"])) == {
        ("Tram", 4), ("Van", 3), ("Coach", 3), ("Scooter", 2), ("Tanker", 2), (None, 1),
    }
    assert rows(avg_by(first, ["routeId"], "speed")) == {
        ("N1", 31.8333), ("N2", 46.75), ("E5", 65.5), (None, None),
    }
    keys = ["routeId", "vehicleType"]
    expected = {
        ("N1", "Tram", 3, 31.0), ("N1", "Scooter", 2, 20.0), ("N1", "Van", 1, 58.0),
        ("N2", "Tram", 1, 30.0), ("N2", "Tanker", 2, 43.0), ("N2", "Coach", 1, 71.0),
        ("E5", "Van", 2, 58.0), ("E5", "Coach", 2, 73.0), (None, None, 1, None),
    }
    both = count_by(first, keys).join(avg_by(first, keys, "speed").select(
        F.col("routeId").alias("r"), F.col("vehicleType").alias("t"), "speed"
    ), F.col("routeId").eqNullSafe(F.col("r")) & F.col("vehicleType").eqNullSafe(F.col("t")))
    assert rows(both.select("routeId", "vehicleType", "count", "speed")) == expected


def test_windows(readings):
    by_type = windowed_count(readings, "eventTime", "30 seconds", ["vehicleType"], ordered=True).collect()
    assert [r.window_start for r in by_type] == sorted(r.window_start for r in by_type)
    assert {(local(r.window_start), r.vehicleType, r["count"]) for r in by_type} == {
        ("08:10:00", "Tram", 2), ("08:10:00", "Van", 1), ("08:10:00", "Scooter", 1),
        ("08:10:30", "Van", 2), ("08:10:30", "Coach", 1), ("08:10:30", "Tanker", 1),
        ("08:11:00", "Tram", 1),
        ("08:12:00", "Tram", 1), ("08:12:00", "Coach", 1), ("08:12:00", "Scooter", 1),
        ("08:12:30", "Coach", 1), ("08:12:30", "Tanker", 1),
    }
    assert all(r.window_end - r.window_start == dt.timedelta(seconds=30) for r in by_type)
    by_route = windowed_count(readings, "eventTime", "1 minute", ["routeId"]).collect()
    assert {(local(r.window_start), r.routeId, r["count"]) for r in by_route} == {
        ("08:10:00", "N1", 4), ("08:10:00", "E5", 3), ("08:10:00", "N2", 1), ("08:11:00", "N2", 1),
        ("08:12:00", "N1", 2), ("08:12:00", "N2", 2), ("08:12:00", "E5", 1),
    }
    speeds = windowed_avg(readings, "eventTime", "30 seconds", ["routeId", "vehicleType"], "speed").collect()
    assert ("08:10:00", "N1", "Tram", 29.0) in {
        (local(r.window_start), r.routeId, r.vehicleType, r.speed) for r in speeds
    }


def test_sliding_windows(readings):
    got = windowed_avg(readings.where("vehicleType = 'Coach'"), "eventTime", "1 minute", [], "speed", slide="30 seconds")
    assert {(local(r.window_start), r.speed) for r in got.collect()} == {
        ("08:10:00", 77.0), ("08:10:30", 77.0), ("08:11:30", 71.0), ("08:12:00", (71 + 69) / 2), ("08:12:30", 69.0),
    }


def test_a_reading_that_is_no_number_does_not_count(spark):
    df = spark.createDataFrame([("a", "10"), ("a", "fast"), ("b", "?")], "k string, speed string")
    assert rows(avg_by(df, ["k"], "speed")) == {("a", 10.0), ("b", None)}


def test_dedup_keeps_the_earliest(spark):
    df = spark.sql("""
        SELECT * FROM VALUES (1, timestamp'2020-01-01 00:00:02', 5, 'x'), (1, timestamp'2020-01-01 00:00:01', 9, 'y'),
          (1, timestamp'2020-01-01 00:00:01', 7, 'z'), (NULL, NULL, 1, 'p'), (NULL, timestamp'2020-01-01', 2, 'q')
        AS t(k, ts, id, v)""")
    got = dedup(df, ["k"], "ts", ["id"])
    assert got.columns == df.columns
    assert {(r.k, r.id, r.v) for r in got.collect()} == {(1, 7, "z"), (None, 2, "q")}
    assert dedup(df, ["k"]).count() == 2
    assert dedup(df.select("k", "ts"), ["k", "ts"], "ts").count() == 4


def test_dedup_of_a_frequent_key_is_done_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").cast("timestamp").alias("ts"), "id")
    plan = dedup(df, ["k"], "ts", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange hashpartitioning(k")
    assert "Window" not in plan


# --- Replays --------------------------------------------------------------------------------------


def replay(spark, tmp_path, blocks):
    return decoded(read_lines(spark, write_blocks(tmp_path / "in", blocks), max_files_per_trigger=1))


def emitted(updates):
    """Rows by the batch they came in, without batches that wrote nothing."""
    out = {}
    for r in updates.collect():
        out.setdefault(r.batch_id, set()).add((local(r.window_start), r.routeId, r["count"]))
    return [out[k] for k in sorted(out)]


def route_minutes(stream):
    return windowed_count(dedup(stream, ["vehicleId"]), "eventTime", "1 minute", ["routeId"], delay="1 minute")


FIRST_BATCHES = [
    {("08:10:00", "N1", 3), ("08:10:00", "E5", 3), ("08:10:00", "N2", 1)},
    {("08:12:00", "N1", 2), ("08:12:00", "N2", 2), ("08:12:00", "E5", 1)},
]


def test_late_rows_one_batch_of_grace(spark, tmp_path):
    """With chained stateful operators Spark drops late rows by the watermark of the batch before."""
    updates = run_to_table(route_minutes(replay(spark, tmp_path, traffic_blocks())), "update")
    assert emitted(updates) == [*FIRST_BATCHES, {("08:11:00", "N2", 1), ("08:10:00", "N1", 4)}]
    last = latest_per_key(updates, ["window_start", "window_end", "routeId"])
    assert {r["count"] for r in last.where("routeId = 'N1'").collect()} == {4, 2}


def test_late_rows_dropped_behind_one_more_batch(spark, tmp_path):
    blocks = traffic_blocks([*TRAFFIC_BLOCKS[:2], [("Coach", "E5", "08:12:41", 50, 9)], TRAFFIC_BLOCKS[2]])
    updates = run_to_table(route_minutes(replay(spark, tmp_path, blocks)), "update")
    assert emitted(updates) == [*FIRST_BATCHES, {("08:12:00", "E5", 2)}, {("08:11:00", "N2", 1)}]


def test_late_rows_dropped_by_the_watermark_of_their_batch(spark, tmp_path, conf):
    conf("spark.sql.streaming.statefulOperator.allowMultiple", "false")
    stream = route_minutes(replay(spark, tmp_path, traffic_blocks()))
    query = (
        stream.writeStream.outputMode("update").format("memory").queryName("late_rows")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    got = {(local(r.window_start), r.routeId, r["count"]) for r in spark.table("late_rows").collect()}
    assert ("08:11:00", "N2", 1) in got and ("08:10:00", "N1", 4) not in got


def test_complete_mode_equals_the_table(spark, tmp_path, readings):
    stream = replay(spark, tmp_path, traffic_blocks())
    counts = windowed_count(
        dedup(stream, ["vehicleId"]), "eventTime", "30 seconds", ["vehicleType"], delay="5 seconds", ordered=True
    )
    want = windowed_count(readings, "eventTime", "30 seconds", ["vehicleType"])
    assert rows(run_to_table(counts, "complete")) == rows(want)


def test_dedup_of_frequent_keys(spark, tmp_path):
    blocks = traffic_blocks()
    blocks[0] = blocks[0] * 5 + ["no reading", "no reading either"]
    stream = replay(spark, tmp_path, blocks)
    plain = run_to_table(dedup(stream, ["vehicleId"]))
    reduced = run_to_table(dedup(stream, ["vehicleId"], frequent_keys=True))
    assert reduced.schema == plain.schema and rows(reduced) == rows(plain)
    assert reduced.count() == plain.count() == 15
    assert run_to_table(dedup(stream, ["vehicleId"], "eventTime", delay="1 minute", frequent_keys=True)).count() >= 12


def test_dedup_with_bounded_memory(spark, tmp_path):
    again = traffic_line("v0-0", ("Tram", "N1", "08:10:05", 31, 50))
    stream = replay(spark, tmp_path, [traffic_blocks()[0], [again]])
    out = run_to_table(dedup(stream, ["vehicleId"], "eventTime", delay="1 minute"))
    assert out.count() == 7
    with pytest.raises(ValueError):
        dedup(stream, ["vehicleId"], delay="1 minute")


def test_first_reading_of_each_vehicle_whatever_the_order_of_files(spark, tmp_path):
    rows = [(v, START + dt.timedelta(minutes=(v * 7 + k * 13) % 50), 10 * k + v, f"{k}") for v in range(6) for k in range(9)]
    rows += [(0, START, 1000 + k, "tie") for k in range(40)] + [(None, None, 5, "no key"), (3, None, 1, "no time")]
    schema = "vehicle int, ts timestamp, id int, what string"
    for part in (rows[2::3], rows[::3], rows[1::3]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    updates = run_to_table(first_by(stream, ["vehicle"], "ts", ["id"]), "update")
    assert updates.select("batch_id").distinct().count() == 3
    want = dedup(spark.createDataFrame(rows, schema), ["vehicle"], "ts", ["id"])
    assert rows_of(latest_per_key(updates, ["vehicle"]).select(*want.columns)) == rows_of(want)


def test_append_mode_holds_back_open_windows(spark, tmp_path):
    stream = replay(spark, tmp_path, traffic_blocks()[:2])
    counts = windowed_count(stream, "eventTime", "30 seconds", ["vehicleType"], delay="5 seconds")
    got = {local(r.window_start) for r in run_to_table(counts).collect()}
    assert got == {"08:10:00", "08:10:30", "08:12:00"}


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    blocks = traffic_blocks()
    folder = str(tmp_path / "run")
    stream = replay(spark, tmp_path, blocks[:1])
    counts = count_by(dedup(stream, ["vehicleId"]), ["vehicleType"])
    before = rows(run_to_table(counts, "complete", folder))
    write_blocks(tmp_path / "in", blocks)
    after = rows(run_to_table(counts, "complete", folder))
    assert before == {("Tram", 2), ("Van", 2), ("Scooter", 1), ("Coach", 1), ("Tanker", 1)}
    assert after == {("Tram", 4), ("Van", 3), ("Scooter", 2), ("Coach", 3), ("Tanker", 2)}
    assert rows(run_to_table(counts, "complete", folder)) == after
