import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import interval_join, join_rides_with_fares, windowed_avg
from tidemark.operators.spread import spread, with_level
from tidemark.plans import taxi
from tidemark.sources import read_table, read_table_stream
from tidemark.streaming import run_to_table

START = dt.datetime(2020, 1, 1)


def sides(spark, seed=1, n=400):
    """Two event lists in which one key holds a third of the rows; many times coincide."""
    rng = random.Random(seed)

    def events(count):
        return [
            (1 if rng.random() < 1 / 3 else rng.randint(2, 20), START + dt.timedelta(minutes=rng.randint(0, 600)), i)
            for i in range(count)
        ]

    left, right = events(n), events(n)
    left.append((None, START, n))
    right += [(None, START, n), (1, None, n + 1)]
    return left, right


def brute_force(left, right, bound=None, inclusive=True):
    return sorted(
        (a[2], b[2])
        for a in left
        for b in right
        if a[0] is not None and a[0] == b[0] and b[1] is not None
        and (b[1] >= a[1] if inclusive else b[1] > a[1])
        and (bound is None or b[1] <= a[1] + bound)
    )


def frames(spark, left, right):
    return (
        spark.createDataFrame(left, "lk int, lt timestamp, l int"),
        spark.createDataFrame(right, "rk int, rt timestamp, r int"),
    )


def pairs(df):
    return sorted((r.l, r.r) for r in df.collect())


def join(left, right, **how):
    return interval_join(left, right, "lk", "rk", "lt", "rt", **how)


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("buckets", [True, False])
def test_bounded(spark, inclusive, buckets):
    left, right = sides(spark)
    got = join(*frames(spark, left, right), upper="7 minutes", lower_inclusive=inclusive, time_buckets=buckets)
    want = brute_force(left, right, dt.timedelta(minutes=7), inclusive)
    assert pairs(got) == want and want
    assert got.columns == ["lk", "lt", "l", "rk", "rt", "r"]


@pytest.mark.parametrize("salt", [1, 5])
def test_open_ended(spark, salt):
    left, right = sides(spark, 2, 150)
    assert pairs(join(*frames(spark, left, right), salt=salt)) == brute_force(left, right)


def test_bounds_on_the_edge(spark):
    left = [(1, START, 0)]
    right = [(1, START + dt.timedelta(minutes=m), m) for m in (-1, 0, 1, 5, 6)]
    frame = frames(spark, left, right)
    assert pairs(join(*frame, upper="5 minutes")) == [(0, 0), (0, 1), (0, 5)]
    assert pairs(join(*frame, upper="5 minutes", lower_inclusive=False)) == [(0, 1), (0, 5)]


def test_times_before_1970(spark):
    left = [(1, dt.datetime(1960, 1, 1, 0, m), m) for m in range(0, 60, 7)]
    right = [(1, dt.datetime(1960, 1, 1, 0, m), m) for m in range(0, 60, 3)]
    got = join(*frames(spark, left, right), upper="4 minutes")
    assert pairs(got) == brute_force(left, right, dt.timedelta(minutes=4))


def test_bucketing_spreads_one_key_over_the_shuffle(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left, right = frames(spark, *sides(spark))
    plan = join(left, right, upper="7 minutes")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(lk" in plan and "__left_bucket" in plan.split("hashpartitioning(lk")[1][:40]
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_frequent_keys_of_an_open_ended_join_are_split(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "40")
    rng = random.Random(8)
    left, right = (
        [(1 if i % 3 == 0 else rng.randint(2, 500), START + dt.timedelta(minutes=rng.randint(0, 90)), i) for i in range(n)]
        for n in (3000, 300)
    )
    left_df, right_df = frames(spark, left, right)
    joined = join(left_df.repartition(8), right_df.repartition(8))
    got = joined.agg(F.count("*"), F.sum("l"), F.sum("r"))
    want = brute_force(left, right)
    assert tuple(got.collect()[0]) == (len(want), sum(p[0] for p in want), sum(p[1] for p in want))
    assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()


def stream_of(spark, folder, rows, schema, name):
    """A stream of the rows in three files, in order of time."""
    path = f"{folder}/{name}"
    rows = sorted((r for r in rows if r[1] is not None), key=lambda r: r[1])
    third = len(rows) // 3 + 1
    for i in range(3):
        spark.createDataFrame(rows[i * third : (i + 1) * third], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize(
    "how", [dict(upper="7 minutes", left_delay="10 minutes", right_delay="10 minutes"), dict(), dict(salt=3), dict(rows_per_task=8)]
)
def test_stream_equals_table(spark, tmp_path, how):
    left, right = sides(spark, 3, 150)
    joined = join(
        stream_of(spark, tmp_path, left, "lk int, lt timestamp, l int", "left"),
        stream_of(spark, tmp_path, right, "rk int, rt timestamp, r int", "right"),
        **how,
    )
    bound = dt.timedelta(minutes=7) if "upper" in how else None
    assert pairs(run_to_table(joined)) == brute_force(left, right, bound)


def test_a_key_that_becomes_frequent_is_spread(spark, tmp_path):
    """One key has a third of all rows, and the join's tasks hold far fewer of them; other keys stay whole."""
    left, right = sides(spark, 5, 600)
    left, right, _, _ = spread(
        stream_of(spark, tmp_path, left, "lk int, lt timestamp, l int", "left"),
        stream_of(spark, tmp_path, right, "rk int, rt timestamp, r int", "right"),
        "lk", "rk", rows_per_task=64, parts=4,
    )
    rows = run_to_table(left).collect()
    cells = Counter((r.lk, r["__left_at"], r["__left_cell"]) for r in rows)
    frequent = len({r.l for r in rows if r.lk == 1})
    levels = {r["__left_level"] for r in rows if r.lk == 1}
    assert frequent > 150 and {0, 1, 2} <= levels
    assert max(n for (key, at, _), n in cells.items() if key == 1 and at >= 2) < frequent / 2
    assert max(r["__left_level"] for r in rows if r.lk != 1) == 0
    of_row = Counter((r.l, r["__left_at"]) for r in rows)
    assert set(of_row.values()) == {1}


def test_a_sketch_keeps_frequent_keys_and_its_size(spark, tmp_path):
    """More keys than the sketch has room for: the frequent one still rises, and the state stays small."""
    rng = random.Random(9)
    rows = [(1 if i % 3 == 0 else rng.randint(2, 10_000), START + dt.timedelta(seconds=i), i) for i in range(1500)]
    stream = stream_of(spark, tmp_path, rows, "lk int, lt timestamp, l int", "rows")
    got = run_to_table(with_level(stream, "lk", "level", 50, parts=2, keys=5)).collect()
    assert sorted((r.lk, r.lt, r.l) for r in got) == sorted(rows)
    assert max(r.level for r in got if r.lk == 1) >= 2 and max(r.level for r in got if r.lk != 1) == 0


def test_spreading_by_rows_is_for_open_joins(spark):
    left, right = frames(spark, *sides(spark, 6, 50))
    assert pairs(join(left, right, rows_per_task=1)) == pairs(join(left, right))
    with pytest.raises(ValueError, match="without a bound"):
        join(left, right, upper="7 minutes", rows_per_task=1)


def state_rows(df, folder):
    query = (
        df.writeStream.format("noop").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    return sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"])


def test_bounded_join_forgets_and_open_ended_does_not(spark, tmp_path):
    left, right = sides(spark, 4, 150)
    streams = (
        stream_of(spark, tmp_path, left, "lk int, lt timestamp, l int", "left"),
        stream_of(spark, tmp_path, right, "rk int, rt timestamp, r int", "right"),
    )
    kept = state_rows(join(*streams), tmp_path / "open")
    bounded = join(*streams, upper="7 minutes", left_delay="10 minutes", right_delay="10 minutes")
    assert kept >= 300 and state_rows(bounded, tmp_path / "bounded") < 60


def test_rides_with_fares(spark):
    hour = dt.timedelta(hours=1)
    fares = spark.createDataFrame(
        [(1, START, 10.0, 1.0), (2, START, 20.0, 2.0), (3, START, 30.0, 3.0)],
        "rideId long, startTime timestamp, totalFare double, tip double",
    )
    ends = [(1, START), (1, START + hour), (2, START + 2 * hour), (3, START + 3 * hour)]
    rides = spark.createDataFrame(
        [(i, t, 5, 6, 0.1, 0.2, 0.3, 0.4, "x") for i, t in ends],
        "rideId long, endTime timestamp, driverId long, taxiId long, startLon float, startLat float,"
        "endLon float, endLat float, other string",
    )
    got = join_rides_with_fares(rides, fares)
    assert got.columns == [
        "startTime", "totalFare", "tip", "rideId", "endTime", "driverId", "taxiId",
        "startLon", "startLat", "endLon", "endLat",
    ]
    assert {(r.rideId, r.endTime - r.startTime) for r in got.collect()} == {(1, hour), (2, 2 * hour)}


def test_tips_of_a_stream_are_those_of_the_table(spark):
    """Join, areas and sliding windows in one stream: what has been emitted is right."""
    folder = "/root/testdata/sf0.001"

    def tips(read):
        return taxi.average_tips(taxi.enriched_rides(read(spark, folder, "lineitem"), read(spark, folder, "orders")))

    want = {tuple(r) for r in tips(read_table).collect()}
    got = [tuple(r) for r in run_to_table(tips(read_table_stream)).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) > 0.9 * len(want)
    latest = max(r[0] for r in got)
    assert {r for r in want if r[0] < latest} <= set(got)
