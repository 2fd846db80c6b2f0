"""Vectors as whole numbers, and sums that tasks hand over as rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors that numpy works on at once.
ROWS = 8192


def floored(column: pa.Array, dims: int, scale: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that are vectors of ``dims`` finite entries, and floor(scale * entry) of these as whole numbers.

    Vectors with an entry beyond ``most`` either way are left out: what is worked out of them has no 64 bits.
    """
    lengths = pa.compute.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(values.reshape(len(rows), dims) * float(scale))
        fits = (np.abs(whole) <= most).all(1)  # false for entries that are null or not finite
    return rows[fits], whole[fits].astype(np.int64)


def packed(x: np.ndarray) -> pa.Array:
    """A binary column with the entries of each row, 32 bits each."""
    x = np.ascontiguousarray(x, np.int32)
    at = np.arange(len(x) + 1, dtype=np.int64) * (x.shape[1] * 4)
    return pa.Array.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(at), pa.py_buffer(x)]).cast(pa.binary())


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    wide = column.cast(pa.large_binary())
    _, at, data = wide.buffers()
    first = np.frombuffer(at, np.int64)[wide.offset] if len(wide) else 0
    found = np.frombuffer(data, np.int32, len(wide) * dims, int(first)) if len(wide) else np.zeros(0, np.int32)
    return found.reshape(len(wide), dims).astype(np.int64)


def chunks(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of no more than ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def added_up(df: DataFrame, key: str, sums: str, exact: bool = True) -> dict:
    """The lists in ``sums`` added up entry by entry for each key, the tasks' lists by a shuffle. The driver gets as many numbers as
    there are keys times entries, whatever the number of rows."""
    kind = "decimal(38,0)" if exact else "double"
    entries = df.where(F.col(sums).isNotNull()).select(key, F.posexplode(sums).alias("at", "value"))
    found: dict = {}
    totals = entries.groupBy(key, "at").agg(F.sum(F.col("value").cast(kind)).alias("value")).collect()
    for row in sorted(totals, key=lambda row: row.at):
        found.setdefault(row[key], []).append(int(row.value) if exact else row.value)
    return found
