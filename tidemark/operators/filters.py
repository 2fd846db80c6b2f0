"""Row filters. All are plain comparisons, so they reach the scan."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class BoundingBox(NamedTuple):
    west: float
    east: float
    south: float
    north: float


# The box around New York City, in degrees.
NEW_YORK = BoundingBox(west=-74.05, east=-73.7, south=40.5, north=41.0)


def within_bbox(
    df: DataFrame,
    points: Sequence[tuple[str, str]] = (("startLon", "startLat"), ("endLon", "endLat")),
    bbox: BoundingBox = NEW_YORK,
) -> DataFrame:
    """Rows of which every (lon, lat) point lies in the box, its edges included."""
    for lon, lat in points:
        df = df.where(
            F.col(lon).between(bbox.west, bbox.east) & F.col(lat).between(bbox.south, bbox.north)
        )
    return df


def finished(df: DataFrame, column: str = "isStart", value: str = "END") -> DataFrame:
    """Rows of rides that have ended."""
    return df.where(F.col(column) == value)
