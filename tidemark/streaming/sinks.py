"""Sinks. Each starts its query and returns the handle."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.operators.decode import with_date_parts

DATE_PARTS = ("year", "month", "day")


def _writer(
    df: DataFrame, name: str | None, mode: str, checkpoint: str | None, every: str | None, available_now: bool
) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode)
    if name is not None:
        writer = writer.queryName(name)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer if every is None else writer.trigger(processingTime=every)


def to_console(
    df: DataFrame,
    name: str | None = None,
    mode: str = "append",
    checkpoint: str | None = None,
    every: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Print each batch. ``every`` sets the trigger interval, e.g. ``"5 seconds"``."""
    writer = _writer(df, name, mode, checkpoint, every, available_now)
    return writer.format("console").option("truncate", False).start()


def to_memory(
    df: DataFrame,
    name: str,
    mode: str = "append",
    checkpoint: str | None = None,
    every: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the result in the driver's memory as the table ``name``. For small results only."""
    return _writer(df, name, mode, checkpoint, every, available_now).format("memory").start()


def to_parquet_lake(
    df: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "startTime",
    by: Sequence[str] = DATE_PARTS,
    name: str | None = None,
    every: str | None = None,
    available_now: bool = False,
    spread: int = 4,
) -> StreamingQuery:
    """Append to parquet files in ``year=/month=/day=`` folders, exactly once across restarts.

    Where days are small, ``by`` can be just the year and month: every folder a task writes to costs a
    file. ``year``, ``month`` and ``day`` are columns in any case. The rows of a folder are brought together in up to
    ``spread`` tasks, so that a micro-batch adds no more than that many files to it; 0 leaves rows where they are.
    """
    parts = with_date_parts(df, ts)
    if spread:
        parts = parts.repartition(*by, F.pmod(F.xxhash64(*df.columns), F.lit(spread)))
    writer = _writer(parts, name, "append", checkpoint, every, available_now)
    return writer.format("parquet").option("path", path).partitionBy(*by).start()


def write_lake(df: DataFrame, path: str, ts: str = "startTime", by: Sequence[str] = DATE_PARTS) -> None:
    """Write a table the way ``to_parquet_lake`` lays out a stream.

    Rows of a folder are brought together, so that it gets few files; a folder too large for one task
    is split by adaptive execution.
    """
    parts = with_date_parts(df, ts)
    parts.hint("rebalance", *by).write.partitionBy(*by).parquet(path)
