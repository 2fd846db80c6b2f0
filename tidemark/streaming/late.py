"""Late rows kept apart in place of being dropped."""

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checkpoints import new_folder
from tidemark.functions.intervals import interval_micros
from tidemark.streaming.queries import _read, await_query


def split_late(stream: DataFrame, ts: str, delay: str, folder: str | None = None, timeout: float | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Run a stream over all the data there is now, with its rows in time and its late rows in tables of their own.

    A row is late if it is before the watermark of its batch: the latest time in all batches before, less ``delay``, in whole
    milliseconds. That is Spark's rule for a stream with one stateful operator; where ``allowMultiple`` is set, as it is by default, Spark itself
    lets rows in for one batch longer. Rows without a time are never late. Both tables have the stream's columns and ``batch_id``. The third table has a row per batch: its watermark (null in the first one), rows kept,
    rows late, and the latest time so far.

    A batch's rows are written once and looked at once; watermark and counts are observed as they pass, and put down
    in the batch's own file, so a batch that is run again after a failure gives the same and replaces what it wrote. A second call with the same ``folder`` goes on.
    """
    spark = stream.sparkSession
    folder = folder or new_folder(spark, "late")
    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(_split(folder, ts, interval_micros(delay)))
        .start()
    )
    await_query(query, timeout)
    rows = T.StructType([*stream.schema.fields, T.StructField("__late", T.BooleanType()), T.StructField("batch_id", T.LongType())])
    out = _read(spark, rows, f"{folder}/rows")
    return out.where("NOT __late").drop("__late"), out.where("__late").drop("__late"), _batches(spark, folder)


_BATCH = "batch_id long, watermark timestamp, kept long, late long, latest timestamp"


def _batches(spark: SparkSession, folder: str) -> DataFrame:
    found = _read(spark, T.StructType().add("value", "string"), f"{folder}/batches")
    fields = T.StructType.fromDDL("batch_id long, watermark long, kept long, late long, latest long")
    rows = found.select(F.from_json("value", fields).alias("b")).select("b.*")
    return rows.withColumns({c: F.timestamp_micros(c) for c in ("watermark", "latest")})


def _split(folder: str, ts: str, delay: int) -> Callable[[DataFrame, int], None]:
    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _batches(spark, folder).where(F.col("batch_id") < batch_id).agg(F.unix_micros(F.max("latest"))).first()[0]
        watermark = None if before is None else (before - delay) // 1000 * 1000
        micros = F.unix_micros(ts)
        late = F.lit(False) if watermark is None else F.coalesce(micros < watermark, F.lit(False))
        seen = Observation()
        rows = batch.withColumn("__late", late).observe(
            seen, F.max(micros).alias("latest"), F.count_if("__late").alias("late"), F.count(F.lit(1)).alias("rows")
        )
        rows.write.mode("overwrite").partitionBy("__late").parquet(f"{folder}/rows/batch_id={batch_id}")
        got = seen.get
        latest = max((t for t in (before, got["latest"]) if t is not None), default=None)
        state = {"batch_id": batch_id, "watermark": watermark, "kept": got["rows"] - got["late"], "late": got["late"], "latest": latest}
        one = spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1)
        one.write.mode("overwrite").parquet(f"{folder}/batches/batch_id={batch_id}")

    return split
