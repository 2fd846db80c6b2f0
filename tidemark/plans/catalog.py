"""All queries by name, and for each the SQL that must give the same rows from the same tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import ads, sessions, taxi, telemetry, words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count": words.word_count,
    "word_count_stream": words.word_count_stream,
    "word_count_update": words.word_count_update,
    "line_word_count_stream": words.line_word_count_stream,
    "word_count_per_batch": words.word_count_per_batch,
    "traffic_decode": telemetry.traffic_decode,
    "traffic_decode_stream": telemetry.traffic_decode_stream,
    "envelope_passthrough": telemetry.envelope_passthrough,
    "vehicle_dedup": telemetry.vehicle_dedup,
    "type_count": telemetry.type_count,
    **telemetry.STREAMS,
    **telemetry.FIRST_WATERMARK_STREAMS,
    "route_type_count": telemetry.route_type_count,
    "route_avg_speed": telemetry.route_avg_speed,
    "route_type_avg_speed": telemetry.route_type_avg_speed,
    "route_type_window_avg_speed": telemetry.route_type_window_avg_speed,
    "type_window_count": telemetry.type_window_count,
    "type_window_count_watermark": telemetry.type_window_count_watermark,
    "type_window_count_watermark_stream": telemetry.type_window_count_watermark_stream,
    "late_readings_stream": telemetry.late_readings_stream,
    "all_readings_type_window_count": telemetry.all_readings_type_window_count,
    "decoded_type_window_count": telemetry.decoded_type_window_count,
    "route_type_window_count": telemetry.route_type_window_count,
    "route_window_count": telemetry.route_window_count,
    "route_window_count_watermark": telemetry.route_window_count_watermark,
    "route_window_count_watermark_stream": telemetry.route_window_count_watermark_stream,
    "ad_click_join": ads.ad_click_join,
    "ad_click_join_stream": ads.ad_click_join_stream,
    "ad_click_interval_join": ads.ad_click_interval_join,
    "ad_click_interval_join_stream": ads.ad_click_interval_join_stream,
    "ad_click_from_messages": ads.ad_click_from_messages,
    "ad_click_from_messages_stream": ads.ad_click_from_messages_stream,
    "rides_in_bbox": taxi.rides_in_bbox,
    "rides_finished": taxi.rides_finished,
    "ride_fare_join": taxi.ride_fare_join,
    "ride_fare_join_stream": taxi.ride_fare_join_stream,
    "ride_districts": taxi.ride_districts,
    "ride_districts_stream": taxi.ride_districts_stream,
    "tips_sliding": taxi.tips_sliding,
    "tips_sliding_stream": taxi.tips_sliding_stream,
    "neighbourhoods": taxi.neighbourhoods,
    "neighbourhoods_from_file": taxi.neighbourhoods_from_file,
    "neighbourhoods_shuffled": taxi.neighbourhoods_shuffled,
    "neighbourhoods_stream": taxi.neighbourhoods_stream,
    "delimited_decode": taxi.delimited_decode,
    "delimited_decode_stream": taxi.delimited_decode_stream,
    "lake_roundtrip": taxi.lake_roundtrip,
    "sessions": sessions.sessions,
    "session_rows": sessions.session_rows,
    "sessions_stream": sessions.sessions_stream,
    "sessions_sliced_stream": sessions.sessions_sliced_stream,
    "gap_sessions": sessions.gap_sessions,
    "gap_sessions_stream": sessions.gap_sessions_stream,
    "events_lake": sessions.events_lake,
    "user_events_decode": sessions.user_events_decode,
    "session_events_stream": sessions.session_events_stream,
}

_WORDS = """
SELECT value, count(*) AS count
FROM (
  SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS value FROM documents
  WHERE NOT (length(text) > 0 AND length(rtrim(text, ' ')) = 0)
) GROUP BY value
"""

_READINGS = """
WITH readings AS (
  SELECT event_id, ts, user_id, event_type AS "vehicleType", value,
         json_extract_string(props, '$.k') AS "routeId" FROM events
), first AS (
  SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
)
"""


def _by_key(keys: str, result: str, rows: str = "first") -> str:
    return f"{_READINGS} SELECT {keys}, {result} FROM {rows} GROUP BY {keys}"


def _by_window(size: str, keys: str, result: str, rows: str = "first") -> str:
    start = f"time_bucket(INTERVAL '{size}', ts)"
    return f"""{_READINGS}
    SELECT {start} AS window_start, {start} + INTERVAL '{size}' AS window_end, {keys}, {result}
    FROM {rows} GROUP BY {start}, {keys}"""


_COUNT = "count(*) AS count"
_SPEED = "avg(round(value * 100)) AS speed"

_LATE = """
WITH batches AS (
  SELECT event_id, ts, user_id, event_id % 3 AS batch FROM events
), ends AS (
  SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '10 days' AS bound
  FROM batches GROUP BY batch
)
SELECT event_id, ts, user_id, coalesce(ts < date_trunc('millisecond', bound), false) AS late, batch::BIGINT AS batch_id
FROM batches JOIN ends USING (batch)
"""

_TRAFFIC = """
SELECT user_id::VARCHAR AS "vehicleId", event_type AS "vehicleType",
       json_extract_string(props, '$.k') AS "routeId",
       '-97.' || user_id AS latitude, '35.' || event_id AS longitude,
       strftime(ts + INTERVAL '5 hours 30 minutes', '%a %b %d %H:%M:%S IST %Y') AS time,
       value::VARCHAR AS speed, (event_id % 50)::VARCHAR AS "fuelLevel",
       (user_id % 4)::INTEGER AS partition, event_id AS "offset", date_trunc('second', ts) AS "eventTime"
FROM events
"""

_ENVELOPE = """
SELECT hex(user_id::VARCHAR) AS key, hex(props) AS value, 'events' AS topic,
       (user_id % 4)::INTEGER AS partition, event_id AS "offset", ts AS timestamp, 0 AS "timestampType"
FROM events
"""


def _ad_join(bound: str) -> str:
    return f"""
    SELECT i.user_id AS "impressionAdId", i.ts AS "impressionTime", i.event_id AS "impressionId",
           i.value AS bid, c.user_id AS "clickAdId", c.ts AS "clickTime", c.event_id AS "clickId"
    FROM events i JOIN events c
      ON i.event_type = 'view' AND c.event_type = 'click' AND c.user_id = i.user_id
     AND c.ts >= i.ts {bound}
    """


_AD_INTERVAL = _ad_join("AND c.ts <= i.ts + INTERVAL '6 hours'")

_RIDE = """
SELECT l_orderkey AS "rideId", l_linenumber AS leg,
       CASE WHEN l_linestatus = 'F' THEN 'END' ELSE 'START' END AS "isStart", l_shipdate AS "endTime",
       l_suppkey AS "driverId", l_partkey AS "taxiId", l_discount AS "startLon", l_tax AS "startLat",
       l_tax AS "endLon", l_discount AS "endLat"
FROM lineitem
"""

_IN_TOWN = """
l_discount BETWEEN 0.01::DOUBLE AND 0.08::DOUBLE AND l_tax BETWEEN 0.01::DOUBLE AND 0.07::DOUBLE
AND l_tax BETWEEN 0.01::DOUBLE AND 0.08::DOUBLE AND l_discount BETWEEN 0.01::DOUBLE AND 0.07::DOUBLE
"""


def _ride_fare(condition: str = "true") -> str:
    return f"""
    SELECT o_orderdate AS "startTime", o_totalprice AS "totalFare", round(o_totalprice * 100) AS tip,
           l_orderkey AS "rideId", l_shipdate AS "endTime", l_suppkey AS "driverId", l_partkey AS "taxiId",
           l_discount AS "startLon", l_tax AS "startLat", l_tax AS "endLon", l_discount AS "endLat"
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
     AND l_shipdate > o_orderdate AND l_shipdate <= o_orderdate + INTERVAL '90 days'
    WHERE {condition}
    """


def _edges(corners: dict[str, list[tuple[float, float]]]) -> str:
    rows = []
    for name, polygon in corners.items():
        for (x, y), (px, py) in zip(polygon, polygon[-1:] + polygon[:-1]):
            rows.append(f"('{name}', {x}::DOUBLE, {y}::DOUBLE, {px}::DOUBLE, {py}::DOUBLE)")
    return f"(VALUES {', '.join(rows)}) AS e(name, x, y, px, py)"


def _inside(points: str, corners: dict[str, list[tuple[float, float]]]) -> str:
    """Name of the last area that each of the distinct points ``x, y`` lies in, counting crossed edges."""
    return f"""
    SELECT x, y, max(name) AS name FROM (
      SELECT p.x, p.y, e.name FROM {points} p JOIN {_edges(corners)}
        ON (e.y > p.y) <> (e.py > p.y) AND p.x < e.x + (e.px - e.x) * (p.y - e.y) / (e.py - e.y)
      GROUP BY p.x, p.y, e.name HAVING count(*) % 2 = 1
    ) GROUP BY x, y
    """


_POINTS = "(SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)"

_NEIGHBOURHOODS = f"""
WITH points AS {_POINTS}, inside AS ({_inside("(SELECT DISTINCT x, y FROM points)", taxi.REGIONS)})
SELECT vec_id, x, y, coalesce(name, 'Other') AS region FROM points LEFT JOIN inside USING (x, y)
"""

_RIDE_DISTRICTS = f"""
WITH rides AS ({_ride_fare(f"l_linestatus = 'F' AND {_IN_TOWN}")}),
points AS (SELECT "endLon" AS x, "endLat" AS y FROM rides UNION SELECT "startLon", "startLat" FROM rides),
inside AS ({_inside("points", taxi.DISTRICTS)})
SELECT rides.*, coalesce(a.name, 'Other') AS "stopNbhd", coalesce(b.name, 'Other') AS "startNbhd"
FROM rides
LEFT JOIN inside a ON a.x = "endLon" AND a.y = "endLat"
LEFT JOIN inside b ON b.x = "startLon" AND b.y = "startLat"
"""

_TIPS = f"""
WITH enriched AS ({_RIDE_DISTRICTS}),
days AS (SELECT *, (epoch_us("endTime") // 86400000000)::BIGINT AS day FROM enriched),
placed AS (SELECT "stopNbhd", tip, day - day % 10 - 10 * i AS first_day FROM days, range(3) AS r(i))
SELECT TIMESTAMP '1970-01-01' + to_days(first_day::INTEGER) AS window_start,
       TIMESTAMP '1970-01-01' + to_days(first_day::INTEGER + 30) AS window_end,
       "stopNbhd", avg(tip) AS tip
FROM placed GROUP BY first_day, "stopNbhd"
"""


def _numbered(rows: str = "events") -> str:
    return f"""
    SELECT event_id, ts, user_id, is_last,
           (sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id))::BIGINT AS session_no
    FROM (
      SELECT *, CASE WHEN prev IS NULL OR ts - prev > INTERVAL '30 minutes' OR prev_last THEN 1 ELSE 0 END AS starts
      FROM (
        SELECT event_id, ts, user_id, event_type = 'purchase' AS is_last, lag(ts) OVER w AS prev,
               lag(event_type = 'purchase') OVER w AS prev_last
        FROM {rows} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
      )
    )
    """


_SESSIONS = f"""
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
       CASE WHEN bool_or(is_last) THEN 'flag'
            WHEN max(ts) + INTERVAL '30 minutes' <= (SELECT max(ts) FROM events) THEN 'timeout'
            ELSE 'open' END AS closed_by
FROM ({_numbered()}) GROUP BY user_id, session_no
"""

_GAP_SESSIONS = """
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events
FROM (
  SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no
  FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL '30 minutes'
                   THEN 0 ELSE 1 END AS starts
    FROM events
  )
) GROUP BY user_id, session_no
"""

_USER_EVENTS = """
SELECT user_id::INTEGER AS "userId", strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS time,
       '/' || event_type AS page, event_type = 'purchase' AS "isLast"
"""

ORACLES: dict[str, str] = {
    "word_count": _WORDS,
    "word_count_stream": _WORDS,
    "word_count_update": _WORDS,
    "line_word_count_stream": _WORDS.replace(
        "FROM documents", r"FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS text FROM documents)"
    ),
    "word_count_per_batch": f"SELECT value, count, 0::BIGINT AS batch_id FROM ({_WORDS})",
    "traffic_decode": _TRAFFIC,
    "traffic_decode_stream": _TRAFFIC,
    "envelope_passthrough": _ENVELOPE,
    "vehicle_dedup": f"""{_READINGS}
        SELECT user_id AS "vehicleId", ts AS "eventTime", event_id AS "readingId", "vehicleType",
               round(value * 100) AS speed
        FROM first""",
    "type_count": _by_key('"vehicleType"', _COUNT),
    "route_type_count": _by_key('"routeId", "vehicleType"', _COUNT),
    "route_avg_speed": _by_key('"routeId"', _SPEED),
    "route_type_avg_speed": _by_key('"routeId", "vehicleType"', _SPEED),
    "route_type_window_avg_speed": _by_window("30 minutes", '"routeId", "vehicleType"', _SPEED),
    "type_window_count": _by_window("30 minutes", '"vehicleType"', _COUNT),
    "type_window_count_watermark": _by_window("30 minutes", '"vehicleType"', _COUNT),
    "type_window_count_watermark_stream": _by_window("30 minutes", '"vehicleType"', _COUNT, "readings"),
    "late_readings_stream": _LATE,
    "all_readings_type_window_count": _by_window("30 minutes", '"vehicleType"', _COUNT, "readings"),
    # Messages carry whole seconds; the first reading of a second is the one with the lowest offset.
    "decoded_type_window_count": _by_window("30 minutes", '"vehicleType"', _COUNT).replace(
        "ORDER BY ts, event_id", "ORDER BY date_trunc('second', ts), event_id"
    ),
    "route_type_window_count": _by_window("30 minutes", '"routeId", "vehicleType"', _COUNT),
    "route_window_count": _by_window("1 hour", '"routeId"', _COUNT),
    "route_window_count_watermark": _by_window("1 hour", '"routeId"', _COUNT),
    "route_window_count_watermark_stream": _by_window("1 hour", '"routeId"', _COUNT, "readings"),
    "ad_click_join": _ad_join(""),
    "ad_click_join_stream": _ad_join(""),
    "ad_click_interval_join": _AD_INTERVAL,
    "ad_click_interval_join_stream": _AD_INTERVAL,
    "rides_in_bbox": f"{_RIDE} WHERE {_IN_TOWN}",
    "rides_finished": """
        SELECT l_orderkey, l_linenumber, l_linestatus AS "isStart", l_shipdate
        FROM lineitem WHERE l_linestatus = 'F'""",
    "ride_fare_join": _ride_fare(),
    "ride_fare_join_stream": _ride_fare(),
    "ride_districts": _RIDE_DISTRICTS,
    "ride_districts_stream": _RIDE_DISTRICTS,
    "tips_sliding": _TIPS,
    "neighbourhoods": _NEIGHBOURHOODS,
    "neighbourhoods_from_file": _NEIGHBOURHOODS,
    "neighbourhoods_shuffled": _NEIGHBOURHOODS,
    "neighbourhoods_stream": _NEIGHBOURHOODS,
    "delimited_decode": "SELECT * FROM orders",
    "delimited_decode_stream": "SELECT * FROM orders",
    "lake_roundtrip": """
        SELECT *, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day
        FROM orders WHERE year(o_orderdate) = 1997""",
    "sessions": _SESSIONS,
    "session_rows": _numbered(),
    "sessions_stream": _SESSIONS,
    "sessions_sliced_stream": _SESSIONS,
    "gap_sessions": _GAP_SESSIONS,
    "gap_sessions_stream": _GAP_SESSIONS,
    "events_lake": """
        SELECT event_id, ts, user_id, event_type, value FROM events
        WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21'""",
    "user_events_decode": f"""{_USER_EVENTS}, date_trunc('millisecond', ts) AS "eventTime" FROM events""",
    "session_events_stream": f"""{_USER_EVENTS}, 'flag' AS closed_by FROM events
        WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')""",
}
ORACLES |= {name: ORACLES[name.removesuffix("_stream")] for name in telemetry.STREAMS}
ORACLES |= {name: ORACLES[name.removesuffix("_first_watermark_stream")] for name in telemetry.FIRST_WATERMARK_STREAMS}
ORACLES |= {"ad_click_from_messages": _AD_INTERVAL, "ad_click_from_messages_stream": _AD_INTERVAL, "tips_sliding_stream": _TIPS}
