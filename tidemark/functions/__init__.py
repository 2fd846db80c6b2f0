from tidemark.functions.dates import DEFAULT_ZONES, parse_java_date, unreadable_dates
from tidemark.functions.geo import point_in_polygon, polygon_edges
from tidemark.functions.intervals import interval_micros
from tidemark.functions.text import words

__all__ = [
    "DEFAULT_ZONES",
    "interval_micros",
    "parse_java_date",
    "point_in_polygon",
    "polygon_edges",
    "unreadable_dates",
    "words",
]
