import datetime as dt
import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from samples import USER_EVENTS, user_line, write_blocks
from tidemark.operators import decode_user_events, gap_sessions, sessionize, summarize_sessions
from tidemark.sources import read_lines
from tidemark.streaming import session_state
from tidemark.streaming import (
    event_time_sessions,
    open_gap_sessions,
    open_sessions,
    processing_time_sessions,
    run_to_table,
)
from tidemark.streaming.queries import _settings, state_settings, state_store
from tidemark.streaming.state import state_variable

START = dt.datetime(2020, 1, 1)
GAP = 30


def random_events(seed, n=600):
    """One user, and one without a number, each hold about a third of the rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        p = rng.random()
        user = 1 if p < 1 / 3 else None if p < 2 / 3 else rng.randint(2, 9)
        out.append((user, START + dt.timedelta(seconds=rng.randint(0, 4000)), i, rng.random() < 0.1))
    return out


def brute_force(events, as_of=None, gap=GAP):
    """Session number of each event, and the sessions."""
    numbers, sessions = {}, []
    for user in {e[0] for e in events}:
        mine = sorted((e for e in events if e[0] == user), key=lambda e: (e[1], e[2]))
        groups, prev = [], None
        for e in mine:
            if prev is None or (e[1] - prev[1]).total_seconds() > gap or prev[3]:
                groups.append([])
            groups[-1].append(e)
            prev = e
        for no, group in enumerate(groups, 1):
            numbers.update({e[2]: no for e in group})
            end = group[-1][1]
            still = (as_of or max(e[1] for e in events)) - end >= dt.timedelta(seconds=gap)
            closed = "flag" if group[-1][3] else "timeout" if still else "open"
            sessions.append((user, group[0][1], end, len(group), closed))
    return numbers, sessions


SCHEMA = "user int, ts timestamp, id int, last boolean"


def key(session):
    return (-1 if session[0] is None else session[0], *session[1:])


def number(df, **how):
    return sessionize(df, "user", "ts", f"{GAP} seconds", "last", ["id"], **how)


@pytest.mark.parametrize("max_rows", [10**9, 100, 7])
def test_table(spark, max_rows):
    events = random_events(1)
    numbered = number(spark.createDataFrame(events, SCHEMA), max_rows_per_task=max_rows)
    numbers, sessions = brute_force(events)
    assert numbered.columns == ["user", "ts", "id", "last", "session_no"]
    assert {r.id: r.session_no for r in numbered.collect()} == numbers
    got = summarize_sessions(numbered, "user", "ts", f"{GAP} seconds", "last").collect()
    assert sorted(map(key, got)) == sorted(map(key, sessions))
    assert {s[4] for s in sessions} == {"flag", "timeout", "open"}


def test_slices_of_one_long_session(spark):
    """No gap and no flag anywhere: the session runs through all slices."""
    events = [(1, START + dt.timedelta(seconds=i), i, False) for i in range(500)]
    numbered = number(spark.createDataFrame(events, SCHEMA), max_rows_per_task=20)
    assert numbered.select("session_no").distinct().count() == 1 and numbered.count() == 500


def test_frequent_users_are_cut_and_others_are_not(spark):
    df = spark.createDataFrame(random_events(2), SCHEMA)
    plan = number(df, max_rows_per_task=100)._jdf.queryExecution().analyzed().toString()
    assert "__slice" in plan
    plan = number(df)._jdf.queryExecution().analyzed().toString()
    assert "__slice" not in plan


def test_rows_without_time_are_left_out(spark):
    df = spark.createDataFrame([(1, START, 1, False), (1, None, 2, False)], SCHEMA)
    assert [r.id for r in number(df).collect()] == [1]


def test_as_of(spark):
    df = number(spark.createDataFrame([(1, START, 1, False)], SCHEMA))
    later = F.lit(START + dt.timedelta(seconds=GAP))
    assert summarize_sessions(df, "user", "ts", f"{GAP} seconds", "last").first().closed_by == "open"
    assert summarize_sessions(df, "user", "ts", f"{GAP} seconds", "last", later).first().closed_by == "timeout"


@pytest.mark.parametrize("max_rows", [10**9, 50])
def test_gap_alone(spark, max_rows):
    events = [(u, t, i, False) for u, t, i, _ in random_events(3)]
    events += [(1, START, 1000 + i, False) for i in range(200)]  # copies
    df = spark.createDataFrame(events, SCHEMA)
    got = gap_sessions(df, "user", "ts", f"{GAP} seconds", max_rows_per_task=max_rows).collect()
    assert sorted(map(key, got)) == sorted(key(s[:4]) for s in brute_force(events)[1])


def test_gap_alone_on_a_stream(spark, tmp_path):
    events = [(u, t, i, False) for u, t, i, _ in random_events(3, 200) if u is not None]
    stream = event_stream(spark, tmp_path / "in", [events])
    got = run_to_table(gap_sessions(stream, "user", "ts", f"{GAP} seconds", delay="0 seconds")).collect()
    # a session window is closed when the watermark is at its end
    want = [key(s[:4]) for s in brute_force(events)[1] if s[4] == "timeout"]
    assert sorted(map(key, got)) == sorted(want)


def test_gap_sessions_closed_and_open(spark, tmp_path):
    """One user has a third of the rows, many at one time; a second run goes on with the sessions that were open."""
    events = sorted([(1 if i % 3 == 0 else u or 2, t, i, False) for u, t, i, _ in random_events(11, 300)], key=lambda e: e[1])
    run = str(tmp_path / "run")
    for some in ([events[:100], events[100:150]], [events[150:]]):
        stream = event_stream(spark, tmp_path / "in", some)
        closed = run_to_table(gap_sessions(stream, "user", "ts", f"{GAP} seconds", delay="0 seconds"), folder=run)
        left = open_gap_sessions(closed, run)
        seen = events[:150] if len(some) == 2 else events
        assert sorted(map(key, closed.unionByName(left).collect())) == sorted(key(s[:4]) for s in brute_force(seen)[1])
        assert left.count() > 0


def test_sessions_of_a_task_meet_before_the_shuffle(spark, tmp_path):
    stream = event_stream(spark, tmp_path / "in", [random_events(12, 50)])
    sessions = gap_sessions(stream, "user", "ts", f"{GAP} seconds", delay="0 seconds")
    with _settings(spark, state_settings(spark)):
        query = sessions.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.processAllAvailable()
        plan = query._jsq.explainInternal(False)
        query.stop()
    assert "MergingSessions" in plan[plan.rindex("Exchange hashpartitioning") :]  # what is below the exchange comes later in the text


# --- By event time --------------------------------------------------------------------------------


def event_stream(spark, folder, cuts):
    path = str(folder)
    for cut in cuts:
        spark.createDataFrame(cut, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def closed_sessions(events):
    """Those a stream has closed when its watermark has reached the last event."""
    return sorted(key(s) for s in brute_force(events)[1] if s[4] != "open")


@pytest.mark.parametrize("pieces", [1, 3])
def test_stream_does_not_depend_on_batches(spark, tmp_path, pieces):
    events = sorted(random_events(4, 300), key=lambda e: (e[1], e[2]))
    borders = [events[len(events) * i // pieces][1] for i in range(1, pieces)]
    cuts = [[] for _ in range(pieces)]
    for e in events:
        cuts[sum(e[1] > b for b in borders)].append(e)
    rng = random.Random(1)
    for cut in cuts:
        rng.shuffle(cut)
    stream = event_stream(spark, tmp_path / "in", cuts)
    out = run_to_table(event_time_sessions(stream, "user", "ts", f"{GAP} seconds", "last", "id"))
    assert sorted(map(key, out.collect())) == closed_sessions(events)


def test_out_of_order_rows_within_the_delay(spark, tmp_path):
    """Rows of neighbouring batches are mixed; the delay gives them time."""
    events = sorted(random_events(5, 200), key=lambda e: (e[1], e[2]))
    end = events[-1][1] + dt.timedelta(seconds=1000)
    events.append((99, end, 1000, False))
    rng = random.Random(2)
    mixed = sorted(events, key=lambda e: e[1] + dt.timedelta(seconds=rng.uniform(0, 200)))
    third = len(mixed) // 3
    stream = event_stream(spark, tmp_path / "in", [mixed[:third], mixed[third : 2 * third], mixed[2 * third :]])
    out = run_to_table(event_time_sessions(stream, "user", "ts", f"{GAP} seconds", "last", "id", "400 seconds"))
    want = [s for s in brute_force(events[:-1], as_of=end)[1]]
    assert sorted(map(key, out.collect())) == sorted(map(key, want))


def test_events_before_1970_are_in_their_sessions(spark, tmp_path):
    old = dt.datetime(1965, 3, 1)
    events = [(1, old + dt.timedelta(seconds=i), i, False) for i in (0, 10, 20, 200)] + [(2, START, 900, False), (3, START + dt.timedelta(seconds=60), 901, False)]
    stream = event_stream(spark, tmp_path / "in", [events])
    out = run_to_table(event_time_sessions(stream, "user", "ts", f"{GAP} seconds", "last", "id"))
    assert sorted(map(key, out.collect())) == closed_sessions(events)


def user_stream(spark, folder, blocks):
    lines = [[line if isinstance(line, str) else user_line(line) for line in block] for block in blocks]
    return decode_user_events(read_lines(spark, write_blocks(folder, lines), max_files_per_trigger=1))


def test_sample_by_event_time(spark, tmp_path):
    for i, blocks in enumerate([[USER_EVENTS], [USER_EVENTS[:8], USER_EVENTS[8:]]]):
        events = user_stream(spark, tmp_path / str(i), blocks)
        out = run_to_table(event_time_sessions(events, "userId", "eventTime", "30 seconds", "isLast", "userId"))
        # the last one, at 09:16:31, is closed by its flag when the watermark gets there
        assert sorted((r.userId, r.n_events, r.closed_by) for r in out.collect()) == sorted(
            [(u, 2, "timeout") for u in range(21, 25)] + [(u, 1, "flag") for u in range(21, 25)]
        )


def test_sample_with_late_last_events(spark, tmp_path):
    events = user_stream(
        spark, tmp_path / "in", [USER_EVENTS[:8], [(29, "09:17:25", False)], [(29, "09:17:26", False)], USER_EVENTS[8:]]
    )
    out = run_to_table(event_time_sessions(events, "userId", "eventTime", "30 seconds", "isLast", "userId"))
    assert sorted((r.userId, r.n_events, r.closed_by) for r in out.collect()) == [(u, 2, "timeout") for u in range(21, 25)]


def test_restart_in_the_middle_of_sessions(spark, tmp_path):
    events = sorted(random_events(6, 200), key=lambda e: (e[1], e[2]))
    half = events[100][1]
    first, second = [e for e in events if e[1] <= half], [e for e in events if e[1] > half]
    run = str(tmp_path / "run")
    for cut in (first, second):
        stream = event_stream(spark, tmp_path / "in", [cut])
        out = run_to_table(event_time_sessions(stream, "user", "ts", f"{GAP} seconds", "last", "id"), folder=run)
    assert sorted(map(key, out.collect())) == closed_sessions(events)


# --- What a stream leaves open, and frequent keys ---------------------------------------------------


def in_order(events, pieces):
    events = sorted(events, key=lambda e: (e[1], e[2]))
    borders = [events[len(events) * i // pieces][1] for i in range(1, pieces)]
    cuts = [[] for _ in range(pieces)]
    for e in events:
        cuts[sum(e[1] > b for b in borders)].append(e)
    return cuts


def closed_and_open(spark, tmp_path, cuts, **how):
    run = str(tmp_path / "run")
    stream = event_stream(spark, tmp_path / "in", cuts)
    closed = run_to_table(event_time_sessions(stream, "user", "ts", f"{GAP} seconds", "last", "id", **how), folder=run, state_partitions=2)
    return closed, open_sessions(closed, run, "user", f"{GAP} seconds")


@pytest.mark.parametrize("slices,pieces", [(None, 2), ("20 seconds", 1), ("100 seconds", 3), ("1 hour", 1)])
def test_closed_and_open_are_all_sessions(spark, tmp_path, slices, pieces):
    """Slices shorter and longer than the gap; the last event is nobody's end of a session, one waits below a millisecond."""
    events = random_events(7, 300) + [(1, START + dt.timedelta(seconds=4001, microseconds=7), 1000, False), (5, START + dt.timedelta(seconds=4001, microseconds=9), 1001, True)]
    closed, left = closed_and_open(spark, tmp_path, in_order(events, pieces), slices=slices)
    assert sorted(map(key, closed.unionByName(left).collect())) == sorted(map(key, brute_force(events)[1]))
    assert {s.closed_by for s in closed.collect()} <= {"flag", "timeout"} and {s.closed_by for s in left.collect()} & {"open", "flag"}


def test_one_session_through_all_slices(spark, tmp_path):
    events = [(1, START + dt.timedelta(seconds=7 * i), i, False) for i in range(200)] + [(2, START + dt.timedelta(seconds=3000), 500, False)]
    closed, left = closed_and_open(spark, tmp_path, in_order(events, 2), slices="50 seconds")
    assert [key(s) for s in closed.collect()] == [key(s) for s in brute_force(events)[1] if s[0] == 1]
    assert [(s.user, s.closed_by) for s in left.collect()] == [(2, "open")]


def test_keys_of_a_group_share_its_state(spark, tmp_path, monkeypatch):
    """Of 300 events of many users nearly all wait: the state has few entries for them."""
    monkeypatch.setattr(session_state, "GROUPS", 3)
    draw = random.Random(11)
    events = [(draw.randint(1, 90), START + dt.timedelta(seconds=draw.randint(0, 4000)), i, i % 7 == 0) for i in range(300)]
    cuts = in_order(events, 2)
    closed, left = closed_and_open(spark, tmp_path, cuts)
    with state_store(spark):
        waiting = state_variable(spark, str(tmp_path / "run"), "waiting").count()
        under_way = state_variable(spark, str(tmp_path / "run"), "progress").count()
    assert waiting <= 12 and under_way <= 3
    assert sorted(map(key, closed.unionByName(left).collect())) == sorted(map(key, brute_force(events)[1]))


def test_rows_of_a_group_are_brought_together():
    batch = [pa.table({"k": k, "g": g, "t": t}).to_batches()[0] for k, g, t in ((["a", None, "a"], [1, 1, 2], [5, 6, 7]), (["a", None], [1, 1], [9, 3]))]
    whole = pa.Table.from_batches(list(session_state._in_lists(["k", "g"], ["t"], "t", 100)(batch))).to_pylist()
    assert sorted(((r["by_k"], r["by_g"], sorted(r["t"]), r["latest"]) for r in whole), key=repr) == sorted(
        [("a", 1, [5, 9], 9), ("a", 2, [7], 7), (None, 1, [3, 6], 6)], key=repr
    )
    assert len(pa.Table.from_batches(list(session_state._in_lists(["k", "g"], ["t"], "t", 3)(batch)))) == 5


def test_a_frequent_key_is_spread_over_tasks(spark, tmp_path):
    """A third of all rows are one user's: nothing is closed yet, and they wait in several partitions of the state."""
    draw = random.Random(8)
    events = [(1 if i % 3 == 0 else draw.randint(2, 40), START + dt.timedelta(seconds=draw.randint(0, 4000)), i, False) for i in range(600)]
    run = str(tmp_path / "run")
    stream = event_stream(spark, tmp_path / "in", [events[:300], events[300:]])
    sessions = event_time_sessions(stream, "user", "ts", f"{GAP} seconds", "last", "id", "2 hours", slices="200 seconds")
    closed = run_to_table(sessions, folder=run, state_partitions=4)
    with state_store(spark):
        waiting = state_variable(spark, run, "sliced").where("key.key = 1").groupBy("partition_id").count().collect()
    assert sum(r["count"] for r in waiting) == 200 and len(waiting) == 4 and max(r["count"] for r in waiting) < 120
    left = open_sessions(closed, run, "user", f"{GAP} seconds")
    assert closed.count() == 0 and sorted(map(key, left.collect())) == sorted(map(key, brute_force(events)[1]))


@pytest.mark.parametrize("slices", [None, "60 seconds"])
def test_open_sessions_go_on_in_the_next_run(spark, tmp_path, slices):
    events = random_events(9, 150)
    first, second = in_order(events, 2)
    for some, seen in ((first, first), (second, events)):
        closed, left = closed_and_open(spark, tmp_path, [some], slices=slices)
        assert sorted(map(key, closed.unionByName(left).collect())) == sorted(map(key, brute_force(seen)[1]))


def test_sessions_of_a_stream_without_rows(spark, tmp_path):
    closed, left = closed_and_open(spark, tmp_path, [[]])
    assert closed.count() == 0 and left.count() == 0


def test_the_registered_stream_depends_on_its_stream(spark, monkeypatch):
    from tidemark.plans import sessions as plans

    whole = plans.replay_by_time
    monkeypatch.setattr(plans, "replay_by_time", lambda df, ts, **how: whole(df.where("false"), ts, **how))
    assert plans.sessions_stream(spark, "/root/testdata/sf0.001").count() == 0


# --- By the clock ---------------------------------------------------------------------------------


def by_the_clock(spark, tmp_path, blocks, **how):
    """Each block is a batch of its own run."""
    run, out = str(tmp_path / "run"), None
    for i in range(len(blocks)):
        events = user_stream(spark, tmp_path / "in", blocks[: i + 1])
        out = run_to_table(processing_time_sessions(events, **how), "update", run, one_batch=True)
    return out


def test_sample_in_one_batch(spark, tmp_path):
    got = by_the_clock(spark, tmp_path, [USER_EVENTS]).collect()
    assert sorted((r.userId, len(r.userEvents), r.closed_by) for r in got) == [(u, 3, "flag") for u in range(21, 25)]
    assert got[0].userEvents[-1].isLast and got[0].userEvents[0].time.startswith("2021-06-30T09:1")


def test_sample_in_two_batches(spark, tmp_path):
    got = by_the_clock(spark, tmp_path, [USER_EVENTS[:8], USER_EVENTS[8:]]).collect()
    assert sorted((r.userId, len(r.userEvents), r.closed_by, r.batch_id) for r in got) == [
        (u, 3, "flag", 1) for u in range(21, 25)
    ]


def test_sample_with_inactivity(spark, tmp_path):
    run = str(tmp_path / "run")
    events = user_stream(spark, tmp_path / "in", [USER_EVENTS[:8]])
    run_to_table(processing_time_sessions(events, "1 second"), "update", run, one_batch=True)
    time.sleep(1.5)
    for block in ([(29, "09:16:19", False)], USER_EVENTS[8:]):
        blocks = [USER_EVENTS[:8], [(29, "09:16:19", False)], USER_EVENTS[8:]][: 2 if block[0][0] == 29 else 3]
        events = user_stream(spark, tmp_path / "in", blocks)
        out = run_to_table(processing_time_sessions(events, "1 second"), "update", run, one_batch=True)
    got = sorted((r.userId, len(r.userEvents), r.closed_by) for r in out.where("userId < 29").collect())
    assert got == sorted([(u, 2, "timeout") for u in range(21, 25)] + [(u, 1, "flag") for u in range(21, 25)])


def test_one_row_per_event(spark, tmp_path):
    out = by_the_clock(spark, tmp_path, [USER_EVENTS[:8], USER_EVENTS[8:]], row_per_event=True)
    assert out.columns == ["userId", "time", "page", "isLast", "closed_by", "batch_id"]
    assert sorted((r.userId, r.time[11:19], r.isLast) for r in out.collect()) == sorted(USER_EVENTS)
