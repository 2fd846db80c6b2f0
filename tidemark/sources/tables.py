"""Parquet tables, read whole or as a stream of their files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A limit on the files of one micro-batch that keeps a batch of a large table within bounds.
FILES_PER_BATCH = 1000


def _recast(df: DataFrame, source: type, target: str) -> DataFrame:
    return df.select(
        *(
            F.col(f.name).cast(target).alias(f.name) if isinstance(f.dataType, source) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def as_instants(df: DataFrame) -> DataFrame:
    """Turn zone-less timestamps into instants, which is what watermarks need."""
    return _recast(df, T.TimestampNTZType, "timestamp")


def as_wall_clock(df: DataFrame) -> DataFrame:
    """Turn instants into zone-less timestamps in the session's zone."""
    return _recast(df, T.TimestampType, "timestamp_ntz")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return as_instants(spark.read.parquet(f"{folder}/{name}.parquet"))


def read_table_stream(
    spark: SparkSession, folder: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream a table stored either as one parquet file or as a folder of part files.

    Limit the files per trigger where watermarks allow it: parts of a table need not be in order of time.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # Written as a glob because the file source takes a plain path for a folder.
    return as_instants(reader.parquet(f"{folder}/{name}.parque[t]"))
