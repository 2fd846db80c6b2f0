"""Lines of text as a stream with one ``value`` column."""

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the lines of the files in a folder; unlike a socket it can be replayed after a failure."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(folder)


def read_socket(spark: SparkSession, host: str = "localhost", port: int = 50050) -> DataFrame:
    """Stream the lines an outside process sends over a socket. For trying things out only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
