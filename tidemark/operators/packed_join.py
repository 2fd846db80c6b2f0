"""A bounded join of streams whose rows are kept in Spark's state by groups of keys, many in one entry.

Spark's own join of streams reads and writes the state several times for each row, and again to forget it. Here the rows of a group come
from a task in one piece, meet in sorted arrays, and wait together.
"""

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processor travels to the Python workers whole, so these need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys are dealt to so many groups.
GROUPS = 256
#: Rows, and bytes, that are held together at most, but for a single row or piece that is larger.
HELD, HELD_BYTES = 250_000, 64 << 20

_PACKED = T.StructType().add("group", "integer").add("right", "boolean").add("rows", "binary")
_HASH, _MICROS, _GROUP = "__hash", "__micros", "__group"


def _full(rows: int, size: int, most: int) -> bool:
    return rows >= most or size >= HELD_BYTES


def _written(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _read(written: bytes) -> pa.Table:
    return pa.ipc.open_stream(written).read_all()


def _pack(right: bool, most: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's rows of the same group as one row. Of a group with rows beyond what a task may hold there is more than one."""

    def together(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        group = table[_GROUP].to_numpy()
        order = np.argsort(group, kind="stable")
        table, group = table.drop_columns([_GROUP]).take(pa.array(order)).combine_chunks(), group[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        ends = [*starts[1:], len(group)]
        for some in range(0, len(starts), 64):
            pieces = [_written(table.slice(a, b - a)) for a, b in zip(starts[some : some + 64], ends[some : some + 64])]
            groups = pa.array(group[starts[some : some + 64]], pa.int32())
            yield pa.RecordBatch.from_arrays([groups, pa.array([right] * len(pieces)), pa.array(pieces, pa.binary())], _PACKED.names)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if _full(sum(b.num_rows for b in held), sum(b.nbytes for b in held), most):
                yield from together(held)
                held = []
        if held:
            yield from together(held)

    return pack


class Meetings(StatefulProcessor):
    """The rows of a group wait in numbered entries, of one side each, for as long as later ones may meet them. All times are microseconds.

    A left row meets right ones of its hash that are not before it and at most ``upper`` after it. No more is held at a time than one
    piece of what is new and one entry of what waits, however many rows a key has.
    """

    def __init__(self, upper: int, inclusive: bool, most: int):
        self._upper, self._inclusive, self._most = upper, inclusive, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._entries = handle.getMapState("waiting", "number long", "right boolean, rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        until = None
        for new in self._pieces(rows, watermark):
            yield from self._meet(new, watermark)
            times = [self._until(side, bool(i)).max() for i, side in enumerate(new) if side is not None]
            until = max([*times, until] if until is not None else times)
        if until is not None:  # a group that gets no more rows forgets those it has
            self._handle.registerTimer(-(-int(until) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for _ in self._meet((None, None), timerValues.getCurrentWatermarkInMs() * 1000):
            pass
        return iter(())

    def _pieces(self, rows: Iterable[pd.DataFrame], watermark: int) -> Iterator[tuple[pa.Table | None, pa.Table | None]]:
        """The new left and right rows that are not late, some at a time."""
        held: tuple[list, list] = ([], [])
        for some in rows:
            for right, written in zip(some["right"], some["rows"]):
                piece = _read(written)
                piece = piece.filter(pa.array(piece[_MICROS].to_numpy() > watermark))
                if piece.num_rows:
                    held[right].append(piece)
                if _full(sum(p.num_rows for side in held for p in side), sum(p.nbytes for side in held for p in side), self._most):
                    yield self._whole(held[0]), self._whole(held[1])
                    held = ([], [])
        if held[0] or held[1]:
            yield self._whole(held[0]), self._whole(held[1])

    def _whole(self, pieces: list[pa.Table]) -> pa.Table | None:
        return pa.concat_tables(pieces).combine_chunks() if pieces else None

    def _until(self, rows: pa.Table, right: bool) -> np.ndarray:
        """When the watermark passes this, no row that is still to come meets a row. A right row waits for left ones that are not after it."""
        return rows[_MICROS].to_numpy() + (0 if right else self._upper)

    def _meet(self, new: tuple[pa.Table | None, pa.Table | None], watermark: int) -> Iterator[pd.DataFrame]:
        """New rows meet each other and those that wait, and then wait themselves."""
        yield from self._pairs(*new)
        to_come = list(new)
        numbers = sorted(n for (n,) in self._entries.keys())
        for number in numbers:
            right, written = self._entries.getValue((number,))
            stored = _read(bytes(written))
            rows = stored.filter(pa.array(self._until(stored, right) > watermark))
            changed = rows.num_rows < stored.num_rows
            if rows.num_rows:
                yield from self._pairs(*((new[0], rows) if right else (rows, new[1])))
            more = to_come[right]
            if more is not None and not _full(rows.num_rows + more.num_rows - 1, rows.nbytes + more.nbytes, self._most):
                rows, to_come[right], changed = pa.concat_tables([rows, more]), None, True
            if not rows.num_rows:
                self._entries.removeKey((number,))
            elif changed:
                self._entries.updateValue((number,), (right, _written(rows.combine_chunks())))
        following = numbers[-1] + 1 if numbers else 0
        for right, more in enumerate(to_come):
            if more is not None:
                self._entries.updateValue((following + right,), (bool(right), _written(more)))

    def _pairs(self, left: pa.Table | None, right: pa.Table | None) -> Iterator[pd.DataFrame]:
        if left is None or right is None:
            return
        hashes, times = right[_HASH].to_numpy(), right[_MICROS].to_numpy()
        known, instants = np.unique(hashes), np.sort(times)
        # Right rows in order of hash and time: of a hash's number and how many right times are earlier.
        width = len(instants) + 1
        at = np.searchsorted(known, hashes) * width + np.searchsorted(instants, times)
        order = np.argsort(at, kind="stable")
        at = at[order]
        left_hashes, start = left[_HASH].to_numpy(), left[_MICROS].to_numpy()
        number = np.minimum(np.searchsorted(known, left_hashes), len(known) - 1)
        mine = np.flatnonzero(known[number] == left_hashes)
        base, start = number[mine] * width, start[mine]
        first = np.searchsorted(at, base + np.searchsorted(instants, start, "left" if self._inclusive else "right"))
        behind = np.searchsorted(at, base + np.searchsorted(instants, start + self._upper, "right"))
        pairs = np.maximum(behind - first, 0)
        ends = np.cumsum(pairs)
        total = int(ends[-1]) if len(ends) else 0
        size = left.nbytes // left.num_rows + right.nbytes // right.num_rows + 1
        step = max(1, min(self._most, HELD_BYTES // size))
        for begin in range(0, total, step):
            pair = np.arange(begin, min(begin + step, total))
            row = np.searchsorted(ends, pair, "right")
            taken = order[first[row] + pair - (ends[row] - pairs[row])]
            yield self._joined(left.take(pa.array(mine[row])), right.take(pa.array(taken)))

    def _joined(self, left: pa.Table, right: pa.Table) -> pd.DataFrame:
        columns = {c: side[c] for side in (left, right) for c in side.column_names if c not in (_HASH, _MICROS)}
        # Plain columns stay Arrow's, in which numbers with nulls and far times are exact.
        nested = {c: column for c, column in columns.items() if pa.types.is_nested(column.type)}
        out = pa.table({c: column for c, column in columns.items() if c not in nested}).combine_chunks().to_pandas(types_mapper=pd.ArrowDtype)
        for c, column in nested.items():
            out[c] = pd.Series(column.to_pylist(maps_as_pydicts="strict"), dtype=object)
        return out[list(columns)] if nested else out


def packed_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    left_time: str,
    right_time: str,
    upper: int,
    inclusive: bool,
    groups: int = GROUPS,
    held: int = HELD,
) -> DataFrame:
    """Pairs of rows of two streams with watermarks that are equal in a hash of the columns ``on`` and whose times are within the bound.

    It may hold pairs of which only the hashes are equal; the caller leaves them out. The watermark goes on with ``right_time``, and rows that it has
    passed when their batch begins are left out. Rows without a time or without one of ``on`` meet nothing.
    """
    if repeated := set(left.columns) & set(right.columns):
        raise ValueError(f"both sides have columns {sorted(repeated)}")
    for a, b in on:
        if left.schema[a].dataType != right.schema[b].dataType:
            raise ValueError(f"{a} and {b} are not of one type")

    def packed(side: DataFrame, keys: list[str], ts: str, is_right: bool) -> DataFrame:
        rows = side.where(F.col(ts).isNotNull()).dropna("any", subset=keys)
        rows = rows.withColumns({_HASH: F.xxhash64(*keys), _MICROS: F.unix_micros(ts)})
        rows = rows.withColumn(_GROUP, F.pmod(F.col(_HASH), F.lit(groups)).cast("int"))
        return rows.mapInArrow(_pack(is_right, held), _PACKED)

    both = packed(left, [a for a, _ in on], left_time, False).union(packed(right, [b for _, b in on], right_time, True))
    fields = [T.StructField(f.name, f.dataType) for side in (left, right) for f in side.schema]
    return both.groupBy("group").transformWithStateInPandas(
        statefulProcessor=Meetings(upper, inclusive, held),
        outputStructType=T.StructType(fields),
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName=right_time,
    )
