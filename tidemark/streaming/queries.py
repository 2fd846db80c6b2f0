"""Running streaming queries and getting at their results."""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.checkpoints import new_folder
from tidemark.operators.words import word_count

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def scratch_folder(spark: SparkSession, name: str) -> str:
    return new_folder(spark, name)


def await_query(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for a query to end; raise what it failed with. With a timeout, stop it when that is over."""
    ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination() or True
    if not ended:
        query.stop()
        raise TimeoutError(f"query {query.name or query.id} did not end within {timeout} s")
    if query.exception() is not None:
        raise query.exception()


def await_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Wait until one of the running queries ends."""
    if timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout)


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def state_settings(spark: SparkSession, partitions: int | None = None) -> dict[str, str]:
    """Settings a query fixes in its checkpoint at its first start.

    State goes to RocksDB, which keeps it off the heap, in as many partitions as the session shuffles into, or as there
    are cores if nobody has set that.
    """
    set_for_data = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not spark._jsparkSession.sessionState().conf().contains("spark.sql.shuffle.partitions"):
        set_for_data = spark.sparkContext.defaultParallelism  # Spark's own default says nothing about the data
    return {
        "spark.sql.shuffle.partitions": str(partitions or set_for_data),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # Nobody reads how many rows there are, and to keep count every write looks its key up first.
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        # A task puts the sessions of a frequent key together before the shuffle, and sends one row for each.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Settings under which the state of a query started here can be read."""
    with _settings(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}):
        yield


def run_to_table(
    df: DataFrame,
    mode: str = "append",
    folder: str | None = None,
    state_partitions: int | None = None,
    timeout: float | None = None,
    one_batch: bool = False,
) -> DataFrame:
    """Run a stream over all the data there is now, and return what it wrote as a table.

    The result goes to parquet files in ``folder``, by default a new one in the shared folder, where a
    second call with the same folder takes up where the first one stopped. In append mode the table
    has the stream's columns. In complete mode it is the last state of the result. In update mode it
    has one more column, ``batch_id``, and every version of every row; see ``latest_per_key``.

    A query with timers on the clock would wait for them for ever; ``one_batch`` ends it after one batch.
    """
    spark = df.sparkSession
    folder = folder or new_folder(spark, "stream")
    out = f"{folder}/out"
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint")
    writer = writer.trigger(once=True) if one_batch else writer.trigger(availableNow=True)
    with _settings(spark, state_settings(spark, state_partitions)):
        if mode == "append":
            query = writer.format("parquet").option("path", out).start()
        elif mode == "update":
            query = writer.foreachBatch(_save_batch(out)).start()
        else:
            query = writer.foreachBatch(_save(out)).start()
    await_query(query, timeout)
    if mode == "update":
        return _batches(spark, df.schema, out)
    return _read(spark, df.schema, out)


def _read(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # there was no data and so no batch


def _save(out: str):
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    return save


def _save_batch(out: str):
    # A batch that is run again after a failure replaces what it wrote before.
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return save


def _batches(spark: SparkSession, schema: StructType, out: str) -> DataFrame:
    schema = StructType([*schema.fields, StructField("batch_id", LongType())])
    return _read(spark, schema, out)


def latest_per_key(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of each row of an update-mode result."""
    rest = [c for c in updates.columns if c not in keys and c != "batch_id"]
    latest = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("__last"))
    return latest.select(*keys, "__last.*")


def settled(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What an aggregate of changes comes to: the last version of each group, without the groups that are gone."""
    return latest_per_key(updates, keys).where("rows > 0").drop("rows")


def word_count_per_batch(lines: DataFrame, column: str = "value", folder: str | None = None) -> DataFrame:
    """Count words within each micro-batch, remembering nothing from one to the next."""
    spark = lines.sparkSession
    folder = folder or new_folder(spark, "stream")
    out = f"{folder}/out"
    save = _save_batch(out)
    query = (
        lines.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(lambda batch, batch_id: save(word_count(batch, column), batch_id))
        .start()
    )
    await_query(query)
    schema = StructType().add("value", "string").add("count", "long")
    return _batches(spark, schema, out)
