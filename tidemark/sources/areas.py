"""Named polygons kept as one JSON object per line."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import AREA


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """``name`` and ``coord``, the list of (lon, lat) corners. Lines that are no polygon are left out; see
    ``malformed_areas``."""
    areas = spark.read.schema(AREA).json(path)
    return areas.where(F.col("name").isNotNull() & F.col("coord").isNotNull())


def malformed_areas(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the lines, blank ones apart, that ``read_areas`` leaves out."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    area = F.from_json("value", AREA)
    return lines.where(F.coalesce(area["name"].isNull() | area["coord"].isNull(), F.lit(True)))
