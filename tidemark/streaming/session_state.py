"""Sessions of a stream, kept per key in Spark's state store."""

import sys
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta, timezone
from functools import reduce
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.checkpoints import checkpointed
from tidemark.functions.intervals import interval_micros
from tidemark.operators.sessions import sessionize
from tidemark.schemas import USER_EVENT
from tidemark.streaming.queries import state_store
from tidemark.streaming.state import operators, state_variable

# The processors travel to the Python workers whole, so these need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _forget_timers(handle: StatefulProcessorHandle) -> None:
    for at in list(handle.listTimers()):
        handle.deleteTimer(at)


def _chunks(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while chunk := list(islice(rows, size)):
        yield chunk


class BatchSessions(StatefulProcessor):
    """A key's events are kept until one of them is the last, or until none came for a while.

    What a session is depends on how the stream is cut into micro-batches: events that come in one
    batch with the last one belong to the session even when they come behind it.
    """

    def __init__(self, timeout_ms: int, row_per_event: bool):
        self._timeout_ms = timeout_ms
        self._row_per_event = row_per_event

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._events = handle.getListState("events", USER_EVENT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ended = False
        for some in _chunks(rows, 1000):
            self._events.appendList([(r.userId, r.time, r.page, r.isLast) for r in some])
            ended = ended or any(r.isLast for r in some)
        _forget_timers(self._handle)
        if ended:
            yield from self._close(key, "flag")
        else:
            now = timerValues.getCurrentProcessingTimeInMs()
            self._handle.registerTimer(now + self._timeout_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._close(key, "timeout")

    def _close(self, key, closed_by: str) -> Iterator[Row]:
        events = (dict(zip(USER_EVENT.fieldNames(), e)) for e in self._events.get())
        if self._row_per_event:
            for event in events:
                yield Row(**event, closed_by=closed_by)
        else:
            listed = [Row(**event) for event in events]
            yield Row(userId=key[0], userEvents=listed, closed_by=closed_by)
        self._events.clear()


def processing_time_sessions(
    events: DataFrame, timeout: str = "30 seconds", row_per_event: bool = False
) -> DataFrame:
    """Sessions of decoded user events with all their events, closed by ``isLast`` or by inactivity.

    Inactivity is measured on the clock. Run it in update mode. A session is one row with the list of
    its events; where sessions can grow long, ``row_per_event`` writes each event in a row of its own,
    so that no session has to fit in memory.
    """
    if row_per_event:
        schema = T.StructType(list(USER_EVENT.fields)).add("closed_by", "string")
    else:
        schema = (
            T.StructType()
            .add("userId", "integer")
            .add("userEvents", T.ArrayType(USER_EVENT))
            .add("closed_by", "string")
        )
    return (
        events.select(*USER_EVENT.fieldNames())
        .groupBy("userId")
        .transformWithState(
            statefulProcessor=BatchSessions(interval_micros(timeout) // 1000, row_per_event),
            outputStructType=schema,
            outputMode="Update",
            timeMode="ProcessingTime",
        )
    )


_WAITING = T.StructType().add("ts", "long").add("tie", "long").add("last", "boolean")
#: Keys are dealt to so many groups, each with a state of its own.
GROUPS = 4096
#: Rows that a task holds before it brings those of a group together.
HELD = 250_000


class EventTimeSessions(StatefulProcessor):
    """The events of a group of keys wait until the watermark has passed them and are then taken in order of time.

    So the result does not depend on how the stream is cut into micro-batches. An open session is kept
    as its span and its number of events. All times are microseconds.

    Every call to the state is a message to the JVM, so the keys of a group share them, and new events are only put down; the rest is done
    when the group's one timer fires, which is set to the first moment at which anything can happen.
    """

    def __init__(self, gap: int, key: T.DataType):
        self._gap = gap
        self._events = _lists(T.StructType([T.StructField("key", key), *_WAITING]))
        spans = T.StructType([T.StructField("key", key)]).add("start", "long").add("end", "long").add("n", "long")
        self._spans = T.StructType([T.StructField("timer", T.LongType()), *_lists(spans)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", self._events)
        # the time of the timer, and the open sessions
        self._progress = handle.getValueState("progress", self._spans)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        first = None
        for r in rows:
            # Spark lets in what was brought together with a row that is in time, and may let in what the watermark passed one batch ago.
            for some in _chunks((w for w in zip(r.key, r.micros, r.tie, r.last) if w[1] > watermark), 1000):
                self._waiting.appendValue(_together(some))
                earliest = min(w[1] for w in some)
                first = earliest if first is None else min(first, earliest)
        if first is not None:
            progress = self._progress.get()
            if progress is None:
                self._set_timer({}, None, first)
            elif first < progress[0]:
                self._set_timer(_by_key(progress), progress[0], first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [w for some in self._waiting.get() for w in zip(*some)]
        due = sorted((w for w in waiting if w[1] <= watermark), key=_in_time)
        left = [w for w in waiting if w[1] > watermark]
        sessions = _by_key(self._progress.get())

        for name, ts, _, last in due:
            session = sessions.pop(name, None)
            if session is not None and ts - session[1] > self._gap:
                yield self._closed(name, session, "timeout")
                session = None
            session = (ts, ts, 1) if session is None else (session[0], ts, session[2] + 1)
            if last:
                yield self._closed(name, session, "flag")
            else:
                sessions[name] = session
        for name, session in list(sessions.items()):
            if session[1] + self._gap <= watermark:
                yield self._closed(name, session, "timeout")
                del sessions[name]

        if due and left:
            self._waiting.put([_together(some) for some in _chunks(left, 1000)])
        elif due:
            self._waiting.clear()
        times = [w[1] for w in left] + [end + self._gap for _, end, _ in sessions.values()]
        if times:
            self._set_timer(sessions, None, min(times))
        else:
            self._progress.clear()

    def _closed(self, name, session: tuple[int, int, int], closed_by: str) -> Row:
        start, end, n = session
        return Row(key=name, session_start=start, session_end=end, n_events=n, closed_by=closed_by)

    def _set_timer(self, sessions: dict, before: int | None, at: int) -> None:
        if before is not None:
            self._handle.deleteTimer(_millis(before))
        self._handle.registerTimer(_millis(at))
        spans = _together([(name, *session) for name, session in sessions.items()]) if sessions else ([], [], [], [])
        self._progress.update((at, *spans))


def _lists(schema: Iterable[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in schema])


def _together(rows: list[tuple]) -> tuple[list, ...]:
    return tuple(map(list, zip(*rows)))


def _by_key(progress: tuple) -> dict:
    return {name: session for name, *session in zip(*progress[1:])}


def _in_time(waiting: tuple) -> tuple:
    _, ts, tie, last = waiting
    return ts, tie is not None, tie or 0, last  # nulls come first, as in Spark


def _in_lists(by: list[str], rest: list[str], latest: str, most: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's rows of the same ``by`` as one row with lists of the ``rest``, and the highest value of the last of them. Of a group with rows
    beyond what a task may hold there is more than one."""

    def together(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        codes = [table[c].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy() for c in by]
        order = np.lexsort(codes)
        table = table.take(pa.array(order)).combine_chunks()
        new = np.any([np.diff(c[order]) != 0 for c in codes], axis=0)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        ends = pa.array(np.concatenate([starts, [table.num_rows]]), pa.int32())
        groups = [table[c].combine_chunks().take(pa.array(starts)) for c in by]
        lists = [pa.ListArray.from_arrays(ends, table[c].combine_chunks()) for c in rest]
        highest = pa.array(np.maximum.reduceat(table[latest].to_numpy(), starts))
        return pa.RecordBatch.from_arrays([*groups, *lists, highest], [*(f"by_{c}" for c in by), *rest, "latest"])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= most:
                yield together(held)
                held, rows = [], 0
        if held:
            yield together(held)

    return pack


def _millis(micros: int) -> int:
    return -(-micros // 1000)


# A watermark is 0 until there is one, and Spark drops what is not after it. Times are counted from so many microseconds
# before 1970, some 3,000 years, so that earlier events are not late from the start.
_ORIGIN = 10**17


def _event_times(events: DataFrame, key: str, ts: str, last_flag: str, tiebreak: str) -> DataFrame:
    micros = F.unix_micros(ts) + F.lit(_ORIGIN)
    narrow = events.select(
        F.col(key).alias("key"),
        micros.alias("micros"),
        F.col(tiebreak).cast("long").alias("tie"),
        F.coalesce(F.col(last_flag), F.lit(False)).alias("last"),
    )
    return narrow.where(F.col("micros").isNotNull())


def _grouped(rows: DataFrame, by: list[str], delay: str) -> DataFrame:
    """A row for the rows of each group in a task, with their columns as lists, of the time of the latest of them: the watermark is that of the rows."""
    rest = [c for c in rows.columns if c not in by or c == "key"]
    fields = [*(T.StructField(f"by_{c}", rows.schema[c].dataType) for c in by), *_lists(rows.schema[c] for c in rest), T.StructField("latest", T.LongType())]
    groups = rows.mapInArrow(_in_lists(by, rest, "micros", HELD), T.StructType(fields))
    return groups.withColumn("event_time", F.timestamp_micros("latest")).drop("latest").withWatermark("event_time", delay)


def _named(sessions: DataFrame, key: str) -> DataFrame:
    return sessions.select(
        F.col("key").alias(key),
        *(F.timestamp_micros(F.col(c) - F.lit(_ORIGIN)).alias(c) for c in ("session_start", "session_end")),
        "n_events",
        "closed_by",
    )


_SESSION = (
    T.StructType()
    .add("session_start", "long")
    .add("session_end", "long")
    .add("n_events", "long")
    .add("closed_by", "string")
)


def event_time_sessions(
    events: DataFrame,
    key: str,
    ts: str,
    gap: str,
    last_flag: str,
    tiebreak: str,
    delay: str = "0 seconds",
    slices: str | None = None,
) -> DataFrame:
    """Sessions of a stream by event time: the closed ones of ``sessionize`` and ``summarize_sessions``.

    Rows more than ``delay`` behind the latest event are left out. ``tiebreak`` is a whole number. ``open_sessions`` reads from the
    checkpoint what the stream has not closed.

    Without ``slices`` keys are dealt to ``GROUPS`` groups, and the waiting events of a group are in one task. With it, each key is cut into slices of time of that length, which are
    grouped on their own, so that a frequent key is spread over tasks: a slice is cut into sessions when the watermark passes its end, and
    a second step puts the first and last ones of neighbouring slices together. What it holds for a key is one row.
    Sessions are the same, but are written up to a slice's length later.
    """
    key_field = T.StructField("key", events.schema[key].dataType)
    rows = _event_times(events, key, ts, last_flag, tiebreak)
    out = T.StructType([key_field, *_SESSION.fields])
    if slices is None:
        grouped = _grouped(rows.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(GROUPS))), ["group"], delay)
        sessions = grouped.groupBy("by_group").transformWithState(
            statefulProcessor=EventTimeSessions(interval_micros(gap), key_field.dataType),
            outputStructType=out,
            outputMode="Append",
            timeMode="EventTime",
        )
        return _named(sessions, key)
    length = interval_micros(slices)
    # Rows of a key and slice are in one task before they are brought together.
    sliced = rows.withColumn("slice", F.floor(F.col("micros") / F.lit(length)).cast("long")).repartition("key", "slice")
    grouped = _grouped(sliced, ["key", "slice"], delay).drop("key").withColumnsRenamed({"by_key": "key", "by_slice": "slice"})
    runs = grouped.groupBy("key", "slice").transformWithState(
        statefulProcessor=SliceRuns(interval_micros(gap), length),
        outputStructType=T.StructType([key_field, *_RUNS.fields]),
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="at",
    )
    # Sessions that are whole pass through the second step, those of many keys together.
    runs = runs.withColumn("owner", F.when(F.col("lane") < 0, F.col("key")))
    sessions = runs.groupBy("owner", "lane").transformWithState(
        statefulProcessor=Stitch(interval_micros(gap), length), outputStructType=out, outputMode="Append", timeMode="EventTime"
    )
    return _named(sessions, key)


# Runs of events in a slice, in order.
_RUNS = (
    T.StructType()
    .add("lane", "long")  # -1 where the slices around may have a part in the sessions, else any group
    .add("start", T.ArrayType(T.LongType()))
    .add("end", T.ArrayType(T.LongType()))
    .add("n", T.ArrayType(T.LongType()))
    .add("flagged", T.ArrayType(T.BooleanType()))
    .add("at", "timestamp")
)
_UTC = datetime(1970, 1, 1, tzinfo=timezone.utc)


class SliceRuns(StatefulProcessor):
    """The events of a key in one slice of time wait until the watermark has passed its end, and are then cut into sessions.

    Those between the first and the last one are whole. All times are microseconds.
    """

    def __init__(self, gap: int, length: int):
        self._gap, self._length = gap, length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("sliced", _WAITING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        # Spark lets in what was brought together with a row that is in time, and may let in what the watermark passed one batch ago.
        found = False
        new = (w for r in rows for w in zip(r.micros, r.tie, r.last) if w[0] > watermark)
        for some in _chunks(new, 1000):
            self._waiting.appendList(some)
            found = True
        if found:
            self._handle.registerTimer(_millis((key[1] + 1) * self._length))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # The rows written count as being of the moment at which they are.
        at = _UTC + timedelta(milliseconds=max(timerValues.getCurrentWatermarkInMs(), _millis((key[1] + 1) * self._length)) + 1)
        runs: list[list] = []
        for ts, _, last in sorted(tuple(w) for w in self._waiting.get()):
            if not runs or runs[-1][3] or ts - runs[-1][1] > self._gap:
                runs.append([ts, ts, 0, False])
            run = runs[-1]
            run[1], run[2], run[3] = ts, run[2] + 1, last
        self._waiting.clear()
        # The first one may go on with the slice before, the last one in the slice behind, if no flag ends it.
        whole = runs[1:] if runs[-1][3] else runs[1:-1]
        borders = runs[:1] if runs[-1][3] else [runs[0], *runs[1:][-1:]]
        for lane, some in ((crc32(repr((key[0], key[1])).encode()) % GROUPS, whole), (-1, borders)):
            if some:
                start, end, n, flagged = _together(some)
                yield Row(key=key[0], lane=lane, start=start, end=end, n=n, flagged=flagged, at=at)


_OPEN = T.StructType().add("start", "long").add("end", "long").add("n", "long").add("timer", "long")


class Stitch(StatefulProcessor):
    """Puts the runs at the borders of a key's slices together, which come in order of time but for those of one batch.

    A session that no later slice went on with is over when the slice in which it could have gone on is.
    """

    def __init__(self, gap: int, length: int):
        self._gap, self._length = gap, length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("stitched", _OPEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[1] >= 0:
            for r in rows:
                for start, end, n, flagged in zip(r.start, r.end, r.n, r.flagged):
                    yield self._closed((r.key,), (start, end, n), "flag" if flagged else "timeout")
            return
        held = self._open.get()
        session, timer = (None, None) if held is None else (tuple(held)[:3], held[3])
        slices = sorted(rows, key=lambda r: r.start[0])
        for start, end, n, flagged in (run for r in slices for run in zip(r.start, r.end, r.n, r.flagged)):
            if session is not None and start - session[1] > self._gap:
                yield self._closed(key, session, "timeout")
                session = None
            session = (start, end, n) if session is None else (session[0], end, session[2] + n)
            if flagged:
                yield self._closed(key, session, "flag")
                session = None
        if timer is not None:
            self._handle.deleteTimer(_millis(timer))
        if session is None:
            self._open.clear()
        else:
            over = ((session[1] + self._gap) // self._length + 1) * self._length
            self._handle.registerTimer(_millis(over))
            self._open.update((*session, over))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._open.get()
        if held is not None:
            yield self._closed(key, tuple(held)[:3], "timeout")
            self._open.clear()

    def _closed(self, key, session: tuple[int, int, int], closed_by: str) -> Row:
        start, end, n = session
        return Row(key=key[0], session_start=start, session_end=end, n_events=n, closed_by=closed_by)


def _rows_of(lists: str, *columns: str) -> Column:
    return F.inline(F.arrays_zip(*(F.col(f"{lists}.{c}").alias(c) for c in columns)))


def open_sessions(closed: DataFrame, run: str, key: str, gap: str) -> DataFrame:
    """The sessions that a stream of ``event_time_sessions``, run by ``run_to_table`` in the folder ``run``, has not closed.

    They are put together from its state alone: sessions that are under way, and events that wait for the watermark. One that has been still for as
    long as ``gap`` at the last event the stream has seen is a timeout, one that ends with a flag is closed by it, others are open. ``closed`` is what the stream wrote.
    """
    spark = closed.sparkSession
    parts, among = [], operators(spark, run)
    for variable in ("progress", "stitched"):
        under_way = state_variable(spark, run, variable, among)
        if under_way is not None:
            if variable == "progress":
                session = under_way.select(_rows_of("value", "key", "start", "end", "n"))
            else:
                session = under_way.where("value.start IS NOT NULL").select(F.col("key.owner").alias("key"), "value.*")
            parts.append(session.select("key", "start", "end", "n", F.lit(None).cast("long").alias("tie"), F.lit(False).alias("last")))
    for variable in ("waiting", "sliced"):
        waiting = state_variable(spark, run, variable, among)
        if waiting is not None:
            if variable == "waiting":
                event = waiting.select(_rows_of("list_element", "key", *_WAITING.names))
            else:
                event = waiting.select("key.key", "list_element.*")
            parts.append(event.select("key", F.col("ts").alias("start"), F.col("ts").alias("end"), F.lit(1).cast("long").alias("n"), "tie", "last"))
    rows = reduce(DataFrame.unionByName, parts)
    times = {c: F.timestamp_micros(F.col(c) - F.lit(_ORIGIN)) for c in ("start", "end")}
    with state_store(spark):
        rows = checkpointed(rows.withColumns(times))  # the next run of the stream changes its state
    numbered = sessionize(rows, "key", "end", gap, "last", ["tie"])
    last = rows.agg(F.max("end").alias("at")).unionByName(closed.agg(F.max("session_end").alias("at"))).agg(F.max("at")).scalar()
    still = F.unix_micros(last) - F.unix_micros("session_end") >= interval_micros(gap)
    sessions = numbered.groupBy("key", "session_no").agg(
        F.min("start").alias("session_start"),
        F.max("end").alias("session_end"),
        F.sum("n").alias("n_events"),
        F.bool_or("last").alias("flagged"),
    )
    closed_by = F.when(F.col("flagged"), "flag").when(still, "timeout").otherwise("open")
    return sessions.select(F.col("key").alias(key), "session_start", "session_end", "n_events", closed_by.alias("closed_by"))
