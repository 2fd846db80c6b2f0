"""Vehicle telemetry: every row of ``events`` is one reading of a vehicle on a route."""

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import parse_java_date
from tidemark.operators import avg_by, count_by, decode_json, dedup, windowed_avg, windowed_count
from tidemark.schemas import TRAFFIC
from tidemark.sources import (
    FILES_PER_BATCH,
    as_wall_clock,
    pack_envelope,
    read_table,
    read_table_stream,
    replay_by_number,
    replay_by_time,
)
from tidemark.sources.replay import ROWS_PER_SLICE
from tidemark.streaming import CHANGE, first_changes, latest_per_key, run_to_table, settled, split_late

# Micro-batches that a replayed table is cut into at least, so that state and watermark are at work on small tables too.
SLICES = 2

_ROUTE = "get_json_object(props, '$.k')"

# Each field of a reading: the column it is in, and how to get at it.
_READING = {
    "readingId": ("event_id", "event_id"),
    "vehicleId": ("user_id", "user_id"),
    "vehicleType": ("event_type", "event_type"),
    "routeId": ("props", _ROUTE),
    "eventTime": ("ts", "ts"),
    # In hundredths: sums of whole numbers are exact in any order, sums of other doubles are not.
    "speed": ("value", "round(value * 100)"),
}


def _readings(events: DataFrame, *fields: str) -> DataFrame:
    return events.selectExpr(*(f"{_READING[f][1]} AS {f}" for f in fields))


def _first_readings(spark: SparkSession, folder: str, *fields: str) -> DataFrame:
    """The first reading of each vehicle. Only the columns the query needs go through the de-duplication, and only the rows
    that are left of them are parsed."""
    fields = ("vehicleId", "eventTime", "readingId", *fields)
    events = read_table(spark, folder, "events").select(*(_READING[f][0] for f in fields))
    return _readings(dedup(events, ["user_id"], "ts", ["event_id"]), *fields)


def _first_reading_changes(spark: SparkSession, folder: str, *fields: str, delay: str | None = None) -> DataFrame:
    """The same as a stream of changes. Files may come in any order; with a watermark the table is replayed in order of time."""
    fields = ("vehicleId", "eventTime", "readingId", *fields)
    columns = [_READING[f][0] for f in fields]
    if delay is None:
        events = read_table_stream(spark, folder, "events", FILES_PER_BATCH).select(*columns)
    else:
        events = replay_by_time(read_table(spark, folder, "events").select(*columns), "ts", at_least=SLICES)
    changes = first_changes(events, ["user_id"], "ts", ["event_id"], delay)
    return changes.selectExpr(*(f"{_READING[f][1]} AS {f}" for f in fields), CHANGE)


#: What each program counts or averages over the first reading of each vehicle: its fields, and the aggregate.
_KEYED = {
    "type_count": (("vehicleType",), count_by, ()),
    "route_type_count": (("routeId", "vehicleType"), count_by, ()),
    "route_avg_speed": (("routeId",), avg_by, ("speed",)),
    "route_type_avg_speed": (("routeId", "vehicleType"), avg_by, ("speed",)),
}
_WINDOWED = {
    "route_type_window_avg_speed": (("routeId", "vehicleType"), windowed_avg, ("speed",), "30 minutes"),
    "type_window_count": (("vehicleType",), windowed_count, (), "30 minutes"),
    "route_type_window_count": (("routeId", "vehicleType"), windowed_count, (), "30 minutes"),
    "route_window_count": (("routeId",), windowed_count, (), "1 hour"),
}


def _keyed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    keys, aggregate, values = _KEYED[name]
    return aggregate(_first_readings(spark, folder, *keys, *values), list(keys), *values)


def _keyed_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    keys, aggregate, values = _KEYED[name]
    changes = _first_reading_changes(spark, folder, *keys, *values)
    return settled(run_to_table(aggregate(changes, list(keys), *values, change=CHANGE), "update"), keys)


def _windows(spark: SparkSession, folder: str, name: str, delay: str | None = None, ordered: bool = False) -> DataFrame:
    keys, aggregate, values, size = _WINDOWED[name]
    readings = _first_readings(spark, folder, *keys, *values)
    return as_wall_clock(aggregate(readings, "eventTime", size, list(keys), *values, delay=delay, ordered=ordered))


def _windows_stream(spark: SparkSession, folder: str, name: str, delay: str | None = None, mode: str = "update") -> DataFrame:
    """Windows over changes. In update mode the last version of each window counts; in complete mode the result is written whole, sorted."""
    keys, aggregate, values, size = _WINDOWED[name]
    changes = _first_reading_changes(spark, folder, *keys, *values, delay=delay)
    windows = aggregate(changes, "eventTime", size, list(keys), *values, ordered=mode == "complete", change=CHANGE)
    out = run_to_table(windows, mode)
    if mode == "complete":
        return as_wall_clock(out.where("rows > 0").drop("rows"))
    return as_wall_clock(settled(out, ["window_start", "window_end", *keys]))


type_count = partial(_keyed, name="type_count")
route_type_count = partial(_keyed, name="route_type_count")
route_avg_speed = partial(_keyed, name="route_avg_speed")
route_type_avg_speed = partial(_keyed, name="route_type_avg_speed")
route_type_window_avg_speed = partial(_windows, name="route_type_window_avg_speed")
type_window_count = partial(_windows, name="type_window_count", ordered=True)
type_window_count_watermark = partial(_windows, name="type_window_count", delay="5 seconds", ordered=True)
route_type_window_count = partial(_windows, name="route_type_window_count", ordered=True)
route_window_count = partial(_windows, name="route_window_count", ordered=True)
route_window_count_watermark = partial(_windows, name="route_window_count", delay="1 minute")

#: The same programs on a stream from end to end: first readings as changes, then the aggregate; results are those of the table.
STREAMS = {f"{name}_stream": partial(_keyed_stream, name=name) for name in _KEYED}
STREAMS |= {f"{name}_stream": partial(_windows_stream, name=name) for name in _WINDOWED}

#: With a watermark set before the de-duplication and handed on to the windows, in the output modes of the programs.
FIRST_WATERMARK_STREAMS = {
    "type_window_count_first_watermark_stream": partial(_windows_stream, name="type_window_count", delay="5 seconds", mode="complete"),
    "route_window_count_first_watermark_stream": partial(_windows_stream, name="route_window_count", delay="1 minute"),
}


# These two count all readings, without the de-duplication.


def type_window_count_watermark_stream(spark: SparkSession, folder: str) -> DataFrame:
    readings = replay_by_time(_readings(read_table(spark, folder, "events"), "eventTime", "vehicleType"), "eventTime", at_least=SLICES)
    counts = windowed_count(
        readings, "eventTime", "30 minutes", ["vehicleType"], delay="5 seconds", ordered=True
    )
    return as_wall_clock(run_to_table(counts, "complete"))


def route_window_count_watermark_stream(spark: SparkSession, folder: str) -> DataFrame:
    readings = replay_by_time(_readings(read_table(spark, folder, "events"), "eventTime", "routeId"), "eventTime", at_least=SLICES)
    counts = windowed_count(readings, "eventTime", "1 hour", ["routeId"], delay="1 minute")
    updates = run_to_table(counts, "update")
    return as_wall_clock(latest_per_key(updates, ["window_start", "window_end", "routeId"]))


LATE = "10 days"


def late_readings_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Readings dealt over three batches or more, each of which goes through all times: those a watermark would drop as late, and the others."""
    events = read_table(spark, folder, "events").select("event_id", "ts", "user_id")
    batches = max(3, -(-events.count() // ROWS_PER_SLICE))
    stream = replay_by_number(events, F.pmod("event_id", F.lit(batches)), batches)
    kept, late, _ = split_late(stream, "ts", LATE)
    both = kept.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return as_wall_clock(both.select("event_id", "ts", "user_id", "late", "batch_id"))


def all_readings_type_window_count(spark: SparkSession, folder: str) -> DataFrame:
    readings = _readings(read_table(spark, folder, "events"), "eventTime", "vehicleType")
    return as_wall_clock(windowed_count(readings, "eventTime", "30 minutes", ["vehicleType"]))


def vehicle_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(_first_readings(spark, folder, "vehicleType", "speed"))


# --- Messages -------------------------------------------------------------------------------------


def _traffic_message() -> Column:
    """A reading as the JSON text a vehicle sends, with its time on the clock of India."""
    local = F.col("ts") + F.expr("INTERVAL '05:30' HOUR TO MINUTE")
    time = F.concat(
        F.date_format(local, "EEE MMM dd HH:mm:ss"), F.lit(" IST "), F.date_format(local, "yyyy")
    )
    return F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("vehicleId"),
            F.col("event_type").alias("vehicleType"),
            F.expr(_ROUTE).alias("routeId"),
            F.concat(F.lit("-97."), F.col("user_id")).alias("latitude"),
            F.concat(F.lit("35."), F.col("event_id")).alias("longitude"),
            time.alias("time"),
            F.col("value").alias("speed"),
            (F.col("event_id") % 50).alias("fuelLevel"),
        )
    )


def _traffic_topic(events: DataFrame) -> DataFrame:
    return pack_envelope(
        events,
        topic="traffic",
        value=_traffic_message(),
        timestamp=F.col("ts"),
        partition=F.col("user_id") % 4,
        offset=F.col("event_id"),
        key=F.col("user_id"),
    )


def _decoded(topic: DataFrame) -> DataFrame:
    readings = decode_json(topic, TRAFFIC, keep=("partition", "offset"))
    return readings.withColumn("eventTime", parse_java_date("time"))


def traffic_decode(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(_decoded(_traffic_topic(read_table(spark, folder, "events"))))


def traffic_decode_stream(spark: SparkSession, folder: str) -> DataFrame:
    stream = _decoded(_traffic_topic(read_table_stream(spark, folder, "events", FILES_PER_BATCH)))
    return as_wall_clock(run_to_table(stream))


def decoded_type_window_count(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way from message to window."""
    readings = _decoded(_traffic_topic(read_table(spark, folder, "events")))
    first = dedup(
        readings.select("vehicleId", "vehicleType", "eventTime", "offset"), ["vehicleId"], "eventTime", ["offset"]
    )
    return as_wall_clock(windowed_count(first, "eventTime", "30 minutes", ["vehicleType"], ordered=True))


def envelope_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    """Records go through undecoded; the bytes are shown as hexadecimal digits."""
    envelope = pack_envelope(
        read_table_stream(spark, folder, "events", FILES_PER_BATCH),
        topic="events",
        value=F.col("props"),
        timestamp=F.col("ts"),
        partition=F.col("user_id") % 4,
        offset=F.col("event_id"),
        key=F.col("user_id"),
    )
    out = run_to_table(envelope)
    return as_wall_clock(out.withColumns({"key": F.hex("key"), "value": F.hex("value")}))
