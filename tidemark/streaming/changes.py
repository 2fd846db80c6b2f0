"""A stream of changes to a table of one row per key, and with it aggregates of that table that run on the stream.

``first_changes`` keeps the first row of each key by time. A row that comes to be first is written with the change +1, and the one it
takes the place of with -1, so that sums of changes (``count_by``, ``avg_by`` and the windowed ones with ``change``) are
those of the first rows, whatever order the rows arrive in.
"""

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import datetime, timedelta, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processor travels to the Python workers whole, so these need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHANGE = "change"
#: Rows that a task holds before it reduces them to one a key.
HELD = 50_000
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _first_in_task(keys: list[str], order: list[str], most: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of the rows of each key in a task the first one by ``order``, nulls first. Keys beyond what a task may hold are handed on
    as they are, in which case a key can come more than once."""

    def reduced(table: pa.Table) -> pa.Table:
        # ties go to whichever row came first: sort_indices is stable
        table = table.take(pc.sort_indices(table, [(c, "ascending") for c in order], null_placement="at_start"))
        numbered = table.select(keys).append_column("__row", pa.array(np.arange(table.num_rows)))
        first = numbered.group_by(keys, use_threads=False).aggregate([("__row", "min")])["__row_min"]
        return table.take(first)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            held.append(reduced(pa.Table.from_batches([batch])))
            rows += held[-1].num_rows
            if rows > most:
                whole = reduced(pa.concat_tables(held))
                held, rows = [whole], whole.num_rows
                if rows > most // 2:
                    yield from whole.to_batches()
                    held, rows = [], 0
        if held:
            yield from reduced(pa.concat_tables(held)).to_batches()

    return keep


class FirstChanges(StatefulProcessor):
    """The state of a key is its first row: what it is ordered by, then what else is in it."""

    def __init__(self, whole: T.StructType, keys: int, order: int, timed: bool):
        self._names, self._schema = whole.fieldNames(), T.StructType(whole.fields[keys:])
        self._keys, self._order, self._timed = keys, order, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._first = handle.getValueState("first", self._schema)

    def _rank(self, values: tuple) -> tuple:
        return tuple((v is not None, v) for v in values[: self._order])  # nulls come first, as in Spark

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self._first.get()
        known = None if known is None else tuple(known)
        best = known
        for row in rows:
            values = tuple(row)[self._keys : len(self._names)]  # a watermark's time is behind these
            if best is None or self._rank(values) < self._rank(best):
                best = values
        if best is not known:
            self._first.update(best)
            if known is not None:
                yield self._change(key, known, -1)
            yield self._change(key, best, 1)

    def _change(self, key: tuple, values: tuple, change: int) -> Row:
        # Columns of their own would go through pandas, where a whole number next to a null becomes a double.
        whole = Row(**dict(zip(self._names, (*key, *values))))
        if self._timed:
            return Row(row=whole, at=_EPOCH + timedelta(microseconds=values[1]), change=change)
        return Row(row=whole, change=change)



def first_changes(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = (), delay: str | None = None, held: int = HELD
) -> DataFrame:
    """The stream ``df`` as changes to its first row of each key by ``ts`` and ``tiebreak``: its columns and ``change``.

    Rows without a key count as one key; rows without a time come after all others. State is one row per key for ever, as
    for a de-duplication. A frequent key's rows are reduced to about one per task before the shuffle. Run it, or an aggregate
    of it, in update or complete mode.

    ``delay`` sets a watermark before the rows are looked at and hands it on, so that windows behind this step can
    be closed by it. Rows behind it, and rows without a time, are then left out, so neither change is ever late: the row taken back is
    later than the row that takes its place.
    """
    rest = [c for c in df.columns if c not in keys and c != ts and c not in tiebreak]
    names = [*keys, ts, *tiebreak, *rest]
    times = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    if not set(keys).isdisjoint([ts, *tiebreak]):
        raise ValueError("the columns that order rows cannot be keys")
    if ts not in times:
        raise ValueError(f"{ts} is no timestamp")
    plain = df.select(*(F.unix_micros(c).alias(c) if c in times else F.col(c) for c in names))
    # the state begins with what rows are ordered by: without a time last, then by time and tiebreak
    narrow = plain.select(*keys, F.col(ts).isNull().alias("__untimed"), *names[len(keys) :])
    reduced = narrow.mapInArrow(_first_in_task(list(keys), ["__untimed", ts, *tiebreak], held), narrow.schema)
    whole = T.StructType([T.StructField(f.name, f.dataType) for f in narrow.schema.fields])
    out = T.StructType([T.StructField("row", whole), T.StructField(CHANGE, T.IntegerType())])
    how = {"timeMode": "None"}
    if delay is not None:
        reduced = reduced.where(F.col(ts).isNotNull()).withColumn("__at", F.timestamp_micros(ts)).withWatermark("__at", delay)
        out = T.StructType([out.fields[0], T.StructField("at", T.TimestampType()), out.fields[1]])
        how = {"timeMode": "EventTime", "eventTimeColumnName": "at"}
    changes = reduced.groupBy(*keys).transformWithState(
        statefulProcessor=FirstChanges(whole, len(keys), 2 + len(tiebreak), delay is not None),
        outputStructType=out,
        outputMode="Update",
        **how,
    )
    fields = {c: F.timestamp_micros(f"row.{c}") if c in times else F.col(f"row.{c}") for c in df.columns}
    if delay is not None:
        fields[ts] = F.col("at")  # the column that carries the watermark
    return changes.select(*(column.alias(c) for c, column in fields.items()), CHANGE)
