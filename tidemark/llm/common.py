"""Helpers that the operators on training data share: tables kept in the shared folder, and words as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checkpoints import new_folder

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str = "kept") -> DataFrame:
    """The rows of ``df``, computed once and written to the shared folder: later jobs read them there, and a lost
    executor costs only its own tasks."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows up to which a table of ids is sent to all executors: some 10 MB.
SMALL = 200_000
ROW = "__row"


def numbered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, written down with a number each in ``ROW``, by which a decision finds its row whatever ids repeat."""
    return kept(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``ROW`` is in ``dropped``, and without that column. Few dropped rows are sent to where the
    texts are; more meet them in a shuffle."""
    dropped = kept(dropped.select(ROW), "dropped")
    few = dropped.count() <= SMALL
    return docs.join(F.broadcast(dropped) if few else dropped, ROW, "left_anti").drop(ROW)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sets them for its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column, without a copy, and the offsets of its rows in them (nulls: no bytes)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column: row i holds the bytes of ``values[offsets[i]:offsets[i + 1]]``."""
    at = np.asarray(offsets, np.int64) * values.dtype.itemsize
    buffers = [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, buffers)


_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case; all other bytes as they are."""
    return _LOWER[data]


def spans(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes that are no gaps: start, end, and the number of the first run of each row.

    A run never crosses the end of a row. The third array has one entry more than there are rows.
    """
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~gaps[data]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    ends = inside[:-1] & ~inside[1:]
    rows = offsets[1:-1]
    rows = rows[rows < len(data)]
    begins[rows] = inside[rows]  # a row's first byte starts a run of its own
    last = rows[rows > 0]
    ends[last - 1] = inside[last - 1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit sways every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """1, q, q², ... modulo 2**64 for an odd q."""
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 1 << 16), _ODD, np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS[:n]


_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_INVERSES = np.ones(1, np.uint64)


def inverses(n: int) -> np.ndarray:
    global _INVERSES
    if len(_INVERSES) < n:
        grown = np.full(max(n, 1 << 16), _INVERSE, np.uint64)
        grown[0] = 1
        _INVERSES = np.multiply.accumulate(grown)
    return _INVERSES[:n]


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial with random coefficients, from which any run's hash follows."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data)), out=sums[1:])
    return sums


def hash_between(data: np.ndarray, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes."""
    found = (sums[end] - sums[start]) * inverses(len(data) + 1)[start]
    return mixed(found + (end - start).astype(np.uint64) * _ODD)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return hash_between(data, byte_sums(data), start, end)


def slices(batches, column: int, most: int = 1 << 21):
    """The same rows in batches whose texts in ``column`` sum up to ``most`` bytes (a longer text is alone in its batch),
    so that what is computed for each byte has a bound."""
    for batch in batches:
        ends = utf8_ends(batch.column(column))
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def utf8_ends(column: pa.Array) -> np.ndarray:
    """For each row, the bytes of all rows up to and with it."""
    lengths = pa.compute.binary_length(column).fill_null(0)
    return np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))


def gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of bytes one after the other, and their lengths."""
    lengths = end - start
    ends = np.cumsum(lengths)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - lengths), lengths)], lengths


def strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A text column of runs of bytes that stand one after the other."""
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
