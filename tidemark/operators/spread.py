"""Frequent keys of an endless join of streams, spread over tasks by how frequent they have become.

A key starts with one cell for its rows. The more rows it has had, the higher the level of its next rows: at level n a
left row goes to one of 2^n cells of that level, and a right row to all of them. Levels rise while rows of lower levels are already in the
join's state, so a row also goes to the cells of the levels below its own, and two rows count as met at the lower one of their
levels, and nowhere else. The result hence does not depend on the levels, which need not be exact, nor agree between tasks.
"""

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processor travels to the Python workers whole, so these need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Parts of a stream that count keys by themselves. A row's part follows from all of it, so a frequent key is in all parts.
PARTS = 64
#: Keys that a part counts at most: one with more than a 1 / (KEYS + 1) of the part's rows is among them.
KEYS = 255
#: A key is spread over 2^LEVELS tasks at most.
LEVELS = 6


class Levels(StatefulProcessor):
    """A part's state is a Misra-Gries sketch of its keys' hashes, whose size does not depend on the number of rows."""

    def __init__(self, rows_per_task: int, parts: int, keys: int, levels: int):
        self._rows_per_task, self._parts, self._keys, self._levels = rows_per_task, parts, keys, levels

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._sketch = handle.getValueState("sketch", "keys array<bigint>, counts array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self._sketch.get()
        counts = {} if known is None else dict(zip(known[0], known[1]))
        for row in rows:
            name = row["key"]
            if name in counts or len(counts) < self._keys:
                counts[name] = counts.get(name, 0) + 1
            else:
                counts = {k: n - 1 for k, n in counts.items() if n > 1}
            likely = counts.get(name, 0) * self._parts // self._rows_per_task
            yield Row(row=row["row"], level=min(likely.bit_length(), self._levels))
        self._sketch.update((list(counts), list(counts.values())))


def _hash(df: DataFrame) -> Column:
    return F.xxhash64(*df.columns)


def with_level(
    df: DataFrame, key: str, level: str, rows_per_task: int, parts: int = PARTS, keys: int = KEYS, levels: int = LEVELS
) -> DataFrame:
    """The stream ``df`` with the ``level`` of each row: 0 for keys of fewer than about ``rows_per_task`` rows so far, and one more for each doubling."""
    times = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    plain = F.struct(*(F.unix_micros(c).alias(c) if c in times else F.col(c) for c in df.columns))
    rows = df.select(F.pmod(_hash(df), F.lit(parts)).alias("part"), F.xxhash64(key).alias("key"), plain.alias("row"))
    out = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("level", T.IntegerType())])
    counted = rows.groupBy("part").transformWithState(
        statefulProcessor=Levels(rows_per_task, parts, keys, levels), outputStructType=out, outputMode="Append", timeMode="None"
    )
    fields = (F.timestamp_micros(f"row.{c}") if c in times else F.col(f"row.{c}") for c in df.columns)
    return counted.select(*(f.alias(c) for f, c in zip(fields, df.columns)), F.col("level").alias(level))


def spread(left: DataFrame, right: DataFrame, left_key: str, right_key: str, rows_per_task: int, parts: int = PARTS) -> tuple[DataFrame, DataFrame, Column, list[str]]:
    """Both sides of an inner join of streams in cells, the condition under which two rows meet, and the columns added.

    Rows without a key, which meet no other, are left out. Parts multiply what they count by their number, so fewer
    ``rows_per_task`` than parts spread every key.
    """
    left, right = left.where(F.col(left_key).isNotNull()), right.where(F.col(right_key).isNotNull())
    of_row = F.shiftrightunsigned(_hash(left), 32)  # other bits than those the row's part follows from
    left = with_level(left.withColumn("__left_hash", of_row), left_key, "__left_level", rows_per_task, parts)
    left = left.withColumn("__left_at", F.explode(F.sequence(F.lit(0), F.col("__left_level"))))
    cell = F.col("__left_hash").bitwiseAND(F.expr("shiftleft(1L, __left_at) - 1"))
    left = left.withColumn("__left_cell", cell).drop("__left_hash")
    right = with_level(right, right_key, "__right_level", rows_per_task, parts)
    right = right.withColumn("__right_at", F.explode(F.sequence(F.lit(0), F.col("__right_level"))))
    right = right.withColumn("__right_cell", F.explode(F.expr("sequence(0L, shiftleft(1L, __right_at) - 1)")))
    meet = (
        (F.col("__left_at") == F.col("__right_at"))
        & (F.col("__left_cell") == F.col("__right_cell"))
        & (F.col("__left_at") == F.least("__left_level", "__right_level"))
    )
    return left, right, meet, [f"__{side}_{name}" for side in ("left", "right") for name in ("level", "at", "cell")]
