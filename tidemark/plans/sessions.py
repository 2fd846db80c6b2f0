"""User sessions: a ``purchase`` row of ``events`` is the last event of its user's session."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import (
    decode_user_events,
    delimited,
    gap_sessions as sessions_by_gap,
    sessionize,
    summarize_sessions,
)
from tidemark.sources import as_wall_clock, read_table, read_table_stream, replay_by_time
from tidemark.streaming import (
    await_query,
    event_time_sessions,
    open_gap_sessions,
    open_sessions,
    processing_time_sessions,
    read_compacted_lake,
    run_to_table,
    scratch_folder,
    to_compacted_lake,
)

GAP = "30 minutes"
# Micro-batches that a replayed table is cut into at least, so that state and watermark are at work on small tables too.
SLICES = 2


def _clicks(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", "user_id", (F.col("event_type") == "purchase").alias("is_last"))


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    clicks = _clicks(read_table(spark, folder, "events"))
    numbered = sessionize(clicks, "user_id", "ts", GAP, "is_last", ["event_id"])
    last_event = clicks.agg(F.max("ts")).scalar()
    return as_wall_clock(summarize_sessions(numbered, "user_id", "ts", GAP, "is_last", last_event))


def session_rows(spark: SparkSession, folder: str) -> DataFrame:
    clicks = _clicks(read_table(spark, folder, "events"))
    return as_wall_clock(sessionize(clicks, "user_id", "ts", GAP, "is_last", ["event_id"]))


def sessions_stream(spark: SparkSession, folder: str, slices: str | None = None) -> DataFrame:
    """The sessions that a stream closes, and those that its end leaves open, which are read from its state. With ``slices`` a
    user's events are cut along time, so that a frequent user is spread over tasks."""
    run = scratch_folder(spark, "sessions")
    clicks = replay_by_time(_clicks(read_table(spark, folder, "events")), "ts", at_least=SLICES)
    sessions = event_time_sessions(clicks, "user_id", "ts", GAP, "is_last", "event_id", slices=slices)
    closed = run_to_table(sessions, folder=run)
    return as_wall_clock(closed.unionByName(open_sessions(closed, run, "user_id", GAP)))


def sessions_sliced_stream(spark: SparkSession, folder: str) -> DataFrame:
    return sessions_stream(spark, folder, "10 days")


def gap_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(sessions_by_gap(read_table(spark, folder, "events"), "user_id", "ts", GAP))


def gap_sessions_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions by Spark's session windows; tasks put those of a frequent user together before the shuffle."""
    run = scratch_folder(spark, "sessions")
    events = replay_by_time(read_table(spark, folder, "events").select("user_id", "ts"), "ts", at_least=SLICES)
    closed = run_to_table(sessions_by_gap(events, "user_id", "ts", GAP, delay="0 seconds"), folder=run)
    return as_wall_clock(closed.unionByName(open_gap_sessions(closed, run)))


def events_lake(spark: SparkSession, folder: str) -> DataFrame:
    """Events streamed into a lake by day, whose closed days are brought together; eleven days are read back."""
    base = scratch_folder(spark, "lake")
    events = read_table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    query = to_compacted_lake(replay_by_time(events, "ts", at_least=SLICES + 1), f"{base}/lake", f"{base}/checkpoint", "ts", available_now=True)
    await_query(query)
    return as_wall_clock(read_compacted_lake(spark, events.schema, f"{base}/lake", "2024-01-10", "2024-01-20"))


def _lines(events: DataFrame) -> DataFrame:
    """Events as the lines a web site logs."""
    return events.select(
        delimited(
            "user_id",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"),
            F.concat(F.lit("/"), F.coalesce("event_type", F.lit(""))),
            F.coalesce(F.col("event_type") == "purchase", F.lit(False)),
            sep=" ",
        ).alias("value")
    )


def user_events_decode(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(decode_user_events(_lines(read_table(spark, folder, "events"))))


def session_events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events of the sessions that processing the whole table as one batch closes."""
    events = decode_user_events(_lines(read_table_stream(spark, folder, "events")))
    closed = processing_time_sessions(events, row_per_event=True)
    return run_to_table(closed, "update", one_batch=True).drop("batch_id")
