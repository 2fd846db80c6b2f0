"""One row per key."""

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The helper below travels to the Python workers whole, so these need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    ts: str | None = None,
    tiebreak: Sequence[str] = (),
    delay: str | None = None,
    frequent_keys: bool = False,
) -> DataFrame:
    """Keep one row per key; rows without a key count as one key.

    A stream keeps the row that arrives first; for the one that is first by time see ``first_by``. It remembers every key, or with ``ts`` and ``delay``
    only those of the last ``delay``. A table keeps the row that is first by ``ts`` and ``tiebreak``,
    so the same table always gives the same rows.

    Spark sends all rows of a stream through the shuffle to the state of their key. Where some keys are
    very frequent, ``frequent_keys`` drops most of their repetitions before that, within each Arrow
    batch. It must come before the stream's watermark, which it does not hand on.
    """
    if df.isStreaming:
        if frequent_keys:
            df = df.mapInArrow(_first_in_batch(list(keys)), df.schema)
        if delay is None:
            return df.dropDuplicates(list(keys))
        if ts is None:
            raise ValueError("delay needs ts")
        return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
    if ts is None:
        return df.dropDuplicates(list(keys))
    return first_by(df, keys, ts, tiebreak)


def first_by(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The row of each key that is first by ``ts`` and ``tiebreak``, whatever order the rows arrive in.

    On a stream this is an aggregate for update mode: its state is one row per key, tasks send one row per key and
    batch, and a row that comes to be first replaces the one before (see ``latest_per_key``). The aggregate keeps
    structs, so Spark sorts each task's rows by key rather than hash them.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    # An aggregate rather than row_number(), so that a frequent key is one row per task. Rows without a time come last.
    order = F.struct(F.col(ts).isNull(), F.col(ts), *(F.col(c) for c in tiebreak))
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__first"))
    return first.select(*(F.col(c) if c in keys else F.col(f"__first.{c}") for c in df.columns))


def _first_in_batch(keys: list[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbered = pa.table({**{k: batch.column(k) for k in keys}, "__row": pa.array(np.arange(batch.num_rows))})
            first = numbered.group_by(keys).aggregate([("__row", "min")])["__row_min"]
            yield batch.take(first.combine_chunks().sort())

    return keep
