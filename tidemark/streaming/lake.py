"""A date-partitioned lake with a list of commits, whose small files are brought together.

Each micro-batch writes its rows to a folder of its own, by year, month and day, and then commits: a small file, numbered by the batch and
put in place by a rename, says which folders of days the lake consists of now. A batch that is run again replaces its commit, and so adds nothing.
Days that nothing has come for in a while are closed, and those made up of many parts are rewritten as one.
"""

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.checkpoints import remove_folder
from tidemark.functions.intervals import interval_micros
from tidemark.operators.decode import with_date_parts
from tidemark.streaming.result_table import _Folder
from tidemark.streaming.sinks import DATE_PARTS

#: Commits that stay: a reader that began with one of these finds its files.
KEPT_COMMITS = 3


def to_compacted_lake(
    df: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "startTime",
    close_after: str = "2 days",
    most_parts: int = 4,
    rows_per_file: int = 5_000_000,
    name: str | None = None,
    every: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to the lake at ``path``; ``read_compacted_lake`` reads it.

    A day is closed when the lake holds rows ``close_after`` later; a closed day of more than one part, and an open one of more than ``most_parts``,
    is rewritten as one, a file for each ``rows_per_file`` rows. Rows of a batch are brought together by day before they are
    written; a day with more than ``rows_per_file`` rows in a batch goes to as many tasks as it needs. Rows without a time are in a
    part of their own.
    """
    span = timedelta(microseconds=interval_micros(close_after))
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer if every is None else writer.trigger(processingTime=every)

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commits = _Folder(spark, f"{path}/commits")
        before = [c for c in commits.numbers() if c < batch_id]
        state = commits.read(before[-1]) if before else {"parts": [], "latest": None}
        days = _write(batch, f"{path}/data/{batch_id}", ts, rows_per_file)
        parts = state["parts"] + [{"of": str(batch_id), "day": day, "rows": rows} for day, rows in days]
        latest = max([d for d in (state["latest"], *(d for d, _ in days)) if d is not None], default=None)
        closed = "" if latest is None else (date.fromisoformat(latest) - span).isoformat()
        by_day: dict = {}
        for part in parts:
            by_day.setdefault(part["day"], []).append(part)
        torn = [d for d, some in by_day.items() if len(some) > (1 if d is not None and d <= closed else most_parts)]
        if torn:
            some = [p for d in torn for p in by_day[d]]
            rewritten = _write(_read_parts(spark, df.schema, path, some), f"{path}/data/{batch_id}-merged", ts, rows_per_file)
            parts = [p for d, p_of in by_day.items() if d not in torn for p in p_of]
            parts += [{"of": f"{batch_id}-merged", "day": day, "rows": rows} for day, rows in rewritten]
        commits.write(batch_id, {"parts": parts, "latest": latest})
        _forget(spark, commits, path)

    return writer.foreachBatch(save).start()


def _write(df: DataFrame, folder: str, ts: str, rows_per_file: int) -> list[tuple[str | None, int]]:
    """Write rows by day; which days, and how many rows of each. Days are counted first, from the column of times alone."""
    spark = df.sparkSession
    day = F.date_format(ts, "yyyy-MM-dd")
    days = [(r.day, r["count"]) for r in df.groupBy(day.alias("day")).count().collect()]
    if days:
        few = spark.createDataFrame([(d, -(-n // rows_per_file)) for d, n in days], "__of string, __files long")
        spread = with_date_parts(df, ts).join(few, day.eqNullSafe(F.col("__of")))
        spread = spread.withColumn("__file", F.pmod(F.xxhash64(*df.columns), F.col("__files")))
        tasks = min(sum(-(-n // rows_per_file) for _, n in days), int(spark.conf.get("spark.sql.shuffle.partitions")))
        spread = spread.repartition(tasks, "__of", "__file").drop("__of", "__file", "__files")
        spread.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(*DATE_PARTS).parquet(folder)
    return days


def _of_day(day: str | None) -> str:
    if day is None:
        return "/".join(f"{part}=__HIVE_DEFAULT_PARTITION__" for part in DATE_PARTS)
    return "/".join(f"{part}={int(value)}" for part, value in zip(DATE_PARTS, day.split("-")))


def _read_parts(spark: SparkSession, schema: StructType, path: str, parts: Sequence[dict]) -> DataFrame:
    folders = [f"{path}/data/{p['of']}/{_of_day(p['day'])}" for p in parts]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_compacted_lake(spark: SparkSession, schema: StructType, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The rows of the lake as of its newest commit, or those of the days between two (``yyyy-MM-dd``, both included): other days'
    folders are not read. With a bound, rows without a time are left out."""
    commits = _Folder(spark, f"{path}/commits")
    numbers = commits.numbers()
    parts = commits.read(numbers[-1])["parts"] if numbers else []
    if first_day is not None or last_day is not None:
        parts = [p for p in parts if p["day"] is not None and (first_day or "") <= p["day"] and (last_day is None or p["day"] <= last_day)]
    return _read_parts(spark, schema, path, parts)


def _forget(spark: SparkSession, commits: _Folder, path: str) -> None:
    """Remove commits that are too old to be read, and the folders of days that only these name."""
    numbers = commits.numbers()
    old, kept = numbers[:-KEPT_COMMITS], numbers[-KEPT_COMMITS:]
    named = {(p["of"], p["day"]) for c in kept for p in commits.read(c)["parts"]}
    for c in old:
        for p in commits.read(c)["parts"]:
            if (p["of"], p["day"]) not in named:
                remove_folder(spark, f"{path}/data/{p['of']}/{_of_day(p['day'])}")
        commits.remove(c)
