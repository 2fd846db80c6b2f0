from tidemark.operators.aggregates import avg_by, count_by, pane_sums, sliding_avg, windowed_avg, windowed_count, windows_of_panes
from tidemark.operators.areas import append_areas
from tidemark.operators.decode import (
    decode_delimited,
    decode_json,
    decode_user_events,
    delimited,
    malformed_user_events,
    with_date_parts,
)
from tidemark.operators.dedup import dedup, first_by
from tidemark.operators.filters import NEW_YORK, BoundingBox, finished, within_bbox
from tidemark.operators.joins import interval_join, join_rides_with_fares
from tidemark.operators.sessions import gap_sessions, sessionize, summarize_sessions
from tidemark.operators.words import tokenize, word_count

__all__ = [
    "NEW_YORK",
    "BoundingBox",
    "append_areas",
    "avg_by",
    "count_by",
    "decode_delimited",
    "decode_json",
    "decode_user_events",
    "dedup",
    "delimited",
    "finished",
    "first_by",
    "gap_sessions",
    "interval_join",
    "join_rides_with_fares",
    "malformed_user_events",
    "pane_sums",
    "sessionize",
    "sliding_avg",
    "summarize_sessions",
    "tokenize",
    "windowed_avg",
    "windowed_count",
    "windows_of_panes",
    "with_date_parts",
    "within_bbox",
    "word_count",
]
