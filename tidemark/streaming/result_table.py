"""The whole result of a streaming aggregate, kept up to date without being written whole in every batch.

A batch adds the rows it changed (a delta). Which files make up the result is in a small version file, one a batch, which is
put in place by a rename when all else is written: a reader takes the newest version and so sees whole batches
only. Now and then deltas are merged by key into a new base, so that a version names few folders.
"""

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.checkpoints import remove_folder
from tidemark.streaming.queries import _settings, await_query, state_settings

#: Versions that stay readable: a reader that began with one of these finds its files.
KEPT_VERSIONS = 3


class _Folder:
    """The few operations on small files that a version needs, in whatever store the folder is."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._jvm, self.path = spark, spark._jvm, path
        at = self._path(path)
        self._fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def numbers(self) -> list[int]:
        """The names of files that are numbers, sorted."""
        at = self._path(self.path)
        if not self._fs.exists(at):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(at)]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, number: int) -> dict:
        source = self._fs.open(self._path(f"{self.path}/{number}"))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(source)))
        finally:
            source.close()

    def write(self, number: int, value: dict) -> None:
        """Put the file in place whole; one of the same number is replaced."""
        draft, final = self._path(f"{self.path}/_draft-{number}"), self._path(f"{self.path}/{number}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        if not self._fs.rename(draft, final):
            self._fs.delete(final, False)
            if not self._fs.rename(draft, final):
                raise OSError(f"{final.toString()} cannot be put in place")

    def remove(self, number: int) -> None:
        self._fs.delete(self._path(f"{self.path}/{number}"), False)


def run_to_result(
    df: DataFrame, keys: Sequence[str], folder: str, merge_every: int = 10, state_partitions: int | None = None, timeout: float | None = None
) -> DataFrame:
    """Run a streaming aggregate over all the data there is now; its whole result, one row per ``keys``, as a table.

    What a batch writes is what it changed, and every ``merge_every`` batches the result once. A second call with the same
    ``folder`` goes on; ``read_result`` reads it at any time, also while the stream runs. A batch that is run again after a failure
    replaces what it wrote.
    """
    spark = df.sparkSession
    versions = _Folder(spark, f"{folder}/versions")

    def save(batch: DataFrame, batch_id: int) -> None:
        # versions from this batch on are of a run that failed
        before = [v for v in versions.numbers() if v < batch_id]
        parts = versions.read(before[-1])["parts"] if before else []
        batch.write.mode("overwrite").parquet(f"{folder}/delta/{batch_id}")
        parts = [*parts, [batch_id, "delta"]]
        merge = len(parts) > merge_every
        if merge:
            _merged(batch.sparkSession, df.schema, folder, parts, keys).write.mode("overwrite").parquet(f"{folder}/base/{batch_id}")
            parts = [[batch_id, "base"]]
        versions.write(batch_id, {"parts": parts})
        if merge:
            remove_folder(batch.sparkSession, f"{folder}/delta/{batch_id}")  # no version names it
        _forget(batch.sparkSession, versions, folder)

    with _settings(spark, state_settings(spark, state_partitions)):
        query = (
            df.writeStream.outputMode("update")
            .trigger(availableNow=True)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .foreachBatch(save)
            .start()
        )
    await_query(query, timeout)
    return read_result(spark, df.schema, folder, keys)


def read_result(spark: SparkSession, schema: StructType, folder: str, keys: Sequence[str]) -> DataFrame:
    """The result as of the newest version of ``folder``."""
    versions = _Folder(spark, f"{folder}/versions")
    numbers = versions.numbers()
    if not numbers:
        return spark.createDataFrame([], schema)
    return _merged(spark, schema, folder, versions.read(numbers[-1])["parts"], keys)


def _merged(spark: SparkSession, schema: StructType, folder: str, parts: list[list], keys: Sequence[str]) -> DataFrame:
    """Of each key the row of the latest part it is in."""
    found = None
    for number, kind in parts:
        part = spark.read.schema(schema).parquet(f"{folder}/{kind}/{number}").withColumn("__version", F.lit(number).cast("long"))
        found = part if found is None else found.unionByName(part)
    if len(parts) == 1:
        return found.drop("__version")
    rest = [c for c in schema.fieldNames() if c not in keys]
    latest = found.groupBy(*keys).agg(F.max_by(F.struct(*rest), "__version").alias("__last"))
    return latest.select(*(F.col(c) if c in keys else F.col(f"__last.{c}") for c in schema.fieldNames()))


def _forget(spark: SparkSession, versions: _Folder, folder: str) -> None:
    """Remove versions that are too old to be read, and the parts that only these name."""
    numbers = versions.numbers()
    old, kept = numbers[:-KEPT_VERSIONS], numbers[-KEPT_VERSIONS:]
    named = {tuple(p) for v in kept for p in versions.read(v)["parts"]}
    for v in old:
        for part in versions.read(v)["parts"]:
            if tuple(part) not in named:
                remove_folder(spark, f"{folder}/{part[1]}/{part[0]}")
        versions.remove(v)
