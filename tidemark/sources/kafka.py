"""Kafka topics as streams, and tables dressed as topic records."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    if starting not in ("earliest", "latest"):
        raise ValueError(f"starting must be 'earliest' or 'latest', not {starting!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    value_only: bool = False,
    **limits: int,
) -> DataFrame:
    """Stream a topic: the whole record envelope, or with ``value_only`` just its payload as text.

    Needs the Kafka connector on the class path.
    """
    options = kafka_options(servers, topic, starting, **limits)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value")) if value_only else stream


def pack_envelope(
    df: DataFrame,
    topic: str,
    value: Column,
    timestamp: Column,
    offset: Column,
    partition: Column | int = 0,
    key: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Give each row the shape of a topic record, so that topic queries run on tables and files."""
    partition = F.lit(partition) if isinstance(partition, int) else partition
    return df.select(
        (F.lit(None) if key is None else key.cast("string")).cast("binary").alias("key"),
        value.cast("string").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *keep,
    )
