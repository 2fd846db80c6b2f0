"""Tables replayed in order, panes, open groups, and late rows kept apart."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import pane_sums, sliding_avg, windowed_avg, windowed_count, windows_of_panes
from tidemark.sources import replay, replay_by_number, replay_by_time
from tidemark.streaming import open_groups, run_to_table, scratch_folder, split_late

START = dt.datetime(2021, 5, 3)
SCHEMA = "id long, ts timestamp, kind string, value double"


def rows(n=300, seed=1):
    """A third of the rows are of one instant."""
    draw = random.Random(seed)
    out = [(i, START + dt.timedelta(minutes=0 if i % 3 == 0 else draw.randint(-500, 3000)), draw.choice("ab"), draw.choice([1.0, 2.0, 7.0, None])) for i in range(n)]
    return out + [(n, None, "a", 1.0)]


def same(a, b):
    assert sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(b.columns)).collect()))


def batches(stream):
    """(batch, times in it) of a stream."""
    out = run_to_table(stream.groupBy("id", "ts").count(), "update")
    found = {}
    for r in out.collect():
        found.setdefault(r.batch_id, []).append(r.ts)
    return [found[b] for b in sorted(found)]


def test_slices_come_in_order_of_time(spark):
    table = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    found = batches(replay_by_time(table, "ts", rows_per_slice=60))
    assert len(found) >= 4 and sum(map(len, found)) == 301
    times = [[t for t in b if t is not None] for b in found]
    assert all(max(a) < min(b) for a, b in zip(times, times[1:])) and None in found[0]


def test_a_large_table_has_longer_slices(spark, monkeypatch):
    """However many rows there are, slices are not more; each is read by several tasks."""
    monkeypatch.setattr(replay, "ROWS_PER_FILE", 20)
    table = spark.createDataFrame([(i, START + dt.timedelta(minutes=i * 37 % 400), "a", 1.0) for i in range(400)], SCHEMA)
    stream = replay_by_time(table, "ts", rows_per_slice=10)
    found = batches(stream)
    assert 2 <= len(found) <= replay.MOST_SLICES and sum(map(len, found)) == 400
    assert all(max(a) < min(b) for a, b in zip(found, found[1:]))
    query = stream.writeStream.format("noop").option("checkpointLocation", scratch_folder(spark, "noop")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert max(p.numInputRows for p in query.recentProgress) >= 3 * 20


def test_tables_replayed_together_have_as_many_slices(spark):
    many = spark.createDataFrame([(i, START + dt.timedelta(minutes=i), "a", 1.0) for i in range(200)], SCHEMA)
    few = spark.createDataFrame([(i, START + dt.timedelta(minutes=10 * i), "a", 1.0) for i in range(20)], SCHEMA)
    found = [batches(s) for s in replay.replay_together((many, "ts"), (few, "ts"), rows_per_slice=50)]
    assert [len(f) for f in found] == [4, 4]


def test_nothing_to_replay(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert batches(replay_by_time(table, "ts", at_least=3)) == []


def test_slices_by_number(spark):
    table = spark.createDataFrame(rows(), SCHEMA)
    stream = replay_by_number(table, F.col("id") % 3, 3)
    out = run_to_table(stream.groupBy("id").count(), "update")
    assert {(r.id, r.batch_id) for r in out.collect()} == {(i, i % 3) for i in range(301)}


def test_a_watermark_without_delay_loses_nothing(spark):
    table = spark.createDataFrame(rows(), SCHEMA)
    counts = windowed_count(replay_by_time(table, "ts", at_least=4), "ts", "1 hour", ["kind"], delay="0 seconds")
    run = scratch_folder(spark, "run")
    closed = run_to_table(counts.withColumnRenamed("window_start", "start").select("start", "kind", "count"), folder=run)
    whole = windowed_count(table, "ts", "1 hour", ["kind"]).select(F.col("window_start").alias("start"), "kind", "count")
    assert 0 < closed.count() < whole.count() and closed.exceptAll(whole).count() == 0


# --- Panes ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("size,slide", [("1 hour", "20 minutes"), ("30 minutes", "30 minutes"), ("1 day", "1 hour")])
def test_windows_of_panes_are_those_of_rows(spark, size, slide):
    table = spark.createDataFrame(rows(), SCHEMA)
    same(sliding_avg(table, "ts", size, slide, ["kind"], "value"), windowed_avg(table, "ts", size, ["kind"], "value", slide=slide))


def test_rows_are_not_copied_to_windows(spark):
    table = spark.createDataFrame(rows(), SCHEMA)
    plan = sliding_avg(table, "ts", "1 hour", "20 minutes", ["kind"], "value")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("partial_sum")  # what is below comes later in the text
    with pytest.raises(ValueError):
        sliding_avg(table, "ts", "1 hour", "25 minutes", ["kind"], "value")


def test_panes_of_a_stream_closed_and_open(spark):
    table = spark.createDataFrame(rows(), SCHEMA)
    run = scratch_folder(spark, "run")
    stream = replay_by_time(table, "ts", at_least=3)
    closed = run_to_table(pane_sums(stream, "ts", "20 minutes", ["kind"], "value", delay="0 seconds"), folder=run)
    left = open_groups(closed, run)
    assert closed.count() > 0 and left.count() > 0
    panes = closed.unionByName(left)
    same(windows_of_panes(panes, "1 hour", "20 minutes", ["kind"], "value"), windowed_avg(table, "ts", "1 hour", ["kind"], "value", slide="20 minutes"))


def test_windows_follow_panes_on_one_stream(spark):
    """In append mode both steps run on the stream, and windows come out when the watermark has passed them."""
    table = spark.createDataFrame(rows(), SCHEMA)
    closed = run_to_table(sliding_avg(replay_by_time(table, "ts", at_least=3), "ts", "1 hour", "20 minutes", ["kind"], "value", delay="0 seconds"))
    whole = windowed_avg(table, "ts", "1 hour", ["kind"], "value", slide="20 minutes")
    last = table.agg(F.max("ts")).first()[0]
    same(closed, whole.where(F.col("window_end") <= F.lit(last)))


# --- Late rows ------------------------------------------------------------------------------------


def by_hand(parts, delay):
    latest, out = None, []
    for b, part in enumerate(parts):
        bound = None if latest is None else latest - delay
        bound = None if bound is None else bound - dt.timedelta(microseconds=bound.microsecond % 1000)
        out += [(r[0], b, bound is not None and r[1] is not None and r[1] < bound) for r in part]
        latest = max([t for t in [latest, *(r[1] for r in part)] if t is not None], default=None)
    return sorted(out)


def test_late_rows_are_kept_apart(spark, tmp_path):
    draw = random.Random(3)
    whole = [(i, t and t + dt.timedelta(microseconds=draw.randint(0, 10**6)), k, v) for i, t, k, v in rows(200)]
    parts = [whole[:50], whole[50:51], whole[51:120], whole[120:]]
    path, run = str(tmp_path / "in"), str(tmp_path / "run")
    for some in (parts[:2], parts[2:]):  # a second run goes on with the watermark of the first
        for part in some:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
        kept, late, seen = split_late(stream, "ts", "10 hours", run)
    assert kept.columns == [*SCHEMA.replace(",", "").split()[::2], "batch_id"]
    got = [(r.id, r.batch_id, False) for r in kept.collect()] + [(r.id, r.batch_id, True) for r in late.collect()]
    want = by_hand(parts, dt.timedelta(hours=10))
    assert sorted(got) == want and any(w[2] for w in want)
    for r in seen.collect():
        assert (r.kept, r.late) == tuple(sum(w[1] == r.batch_id and w[2] == x for w in want) for x in (False, True))
    assert seen.count() == 4 and seen.where("watermark IS NULL").count() == 1


def test_spark_drops_the_rows_called_late(spark, tmp_path, conf):
    """The stream itself counts the kept rows, with windows so short that each row has one."""
    conf("spark.sql.streaming.statefulOperator.allowMultiple", "false")
    draw = random.Random(6)
    whole = [(i, START + dt.timedelta(minutes=draw.randint(0, 3000)), "a", 1.0) for i in range(150)]
    path = str(tmp_path / "in")
    for i in range(3):
        spark.createDataFrame(whole[50 * i : 50 * i + 50], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    kept, late, _ = split_late(stream, "ts", "5 hours")
    counted = run_to_table(windowed_count(stream, "ts", "1 microsecond", ["id"], delay="5 hours"), "update")
    assert late.count() > 0 and sorted(r.id for r in counted.collect()) == sorted(r.id for r in kept.collect())


def test_no_rows_no_late_rows(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "in"))
    kept, late, seen = split_late(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), "ts", "1 hour")
    assert kept.count() == late.count() == 0 and seen.where("late > 0").count() == 0
