"""Tables played back as streams, in order of time or as their rows arrived."""

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.checkpoints import new_folder

#: Rows of a slice, about: one micro-batch.
ROWS_PER_SLICE = 1_000_000
#: A table is cut into no more slices than this by time; those of a larger table are longer. A micro-batch looks at the state of all the
#: keys it has rows of, and an eviction at all of it, so with a slice for every so many rows a replay's time would grow with the square of them.
MOST_SLICES = 6
#: Rows of a file, about: what a task of a micro-batch reads.
ROWS_PER_FILE = 250_000
#: The file source leaves out files more than seven days older than the newest.
_STEP_MS, _SPAN_MS = 1000, 5 * 24 * 3600 * 1000


def replay_by_time(df: DataFrame, ts: str, rows_per_slice: int = ROWS_PER_SLICE, at_least: int = 1) -> DataFrame:
    """The table ``df`` as a stream that delivers its rows in slices of time, one slice a micro-batch.

    Every row of a batch is later than all rows of the batches before, so a watermark on ``ts`` needs no delay to lose
    nothing, and state lives no longer than it has to. Rows without a time come first. The table is range-partitioned by time
    once (``rows_per_slice`` rows a slice, but ``at_least`` so many slices and ``MOST_SLICES`` at most) and written to the shared folder, a slice in
    files of ``ROWS_PER_FILE`` rows; rows of one instant are in one file. The file source takes files in order of their modification times, which are set to
    the order of time; a store that does not keep them is refused.
    """
    return replay_together((df, ts), rows_per_slice=rows_per_slice, at_least=at_least)[0]


def replay_together(*tables: tuple[DataFrame, str], rows_per_slice: int = ROWS_PER_SLICE, at_least: int = 1) -> list[DataFrame]:
    """Tables, each with its column of time, as streams like those of ``replay_by_time`` that are cut into the same number of slices.

    So streams that are joined move on in time together, as far as their rows are spread over time alike, and the one with fewer rows does
    not have to wait in the state for the other.
    """
    rows = [df.count() for df, _ in tables]
    slices = max(at_least, min(MOST_SLICES, -(-max(rows) // rows_per_slice)), 1)
    return [_by_time(df, ts, slices, max(1, -(-n // (slices * ROWS_PER_FILE)))) for (df, ts), n in zip(tables, rows)]


def _by_time(df: DataFrame, ts: str, slices: int, files: int) -> DataFrame:
    return _as_stream(df.repartitionByRange(slices * files, ts).sortWithinPartitions(ts), files)


def replay_by_number(df: DataFrame, slice_no: Column, slices: int) -> DataFrame:
    """The table ``df`` as a stream that delivers in each micro-batch the rows of one slice, numbered from 0 up to ``slices``."""
    return _as_stream(df.repartitionById(slices, slice_no.cast("int")))


def _as_stream(sliced: DataFrame, files: int = 1) -> DataFrame:
    spark = sliced.sparkSession
    folder = new_folder(spark, "replay")
    sliced.write.parquet(folder)
    _put_in_order(spark, folder)
    return spark.readStream.schema(sliced.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _put_in_order(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    parts = sorted((f.getPath().getName(), f) for f in fs.listStatus(path) if f.getPath().getName().startswith("part-"))
    if len(parts) < 2:
        return
    first = min(f.getModificationTime() for _, f in parts) // 1000 * 1000 - _SPAN_MS
    step = max(1, min(_STEP_MS, _SPAN_MS // len(parts)))
    for i, (_, f) in enumerate(parts):
        fs.setTimes(f.getPath(), first + i * step, -1)
    times = [fs.getFileStatus(f.getPath()).getModificationTime() for _, f in parts]
    if any(a >= b for a, b in zip(times, times[1:])):
        raise ValueError(f"{folder}: the store does not keep the times of files, by which a replay is ordered")
