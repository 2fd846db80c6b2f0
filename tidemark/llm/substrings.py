"""Removal of repeated passages: suffix sorting by a difference cover, on what can repeat at all.

A string of 50 bytes can only repeat where its anchor does: the 24 bytes in it with the smallest hash. Texts fall into
runs of strings with one anchor; a run is its first string's start and how many strings it has. So

1. texts are gathered into blocks, written with their runs once and bucketed by block, so that no later step shuffles them;
2. blocks ask which anchors occur more than once in the corpus (a few bits of each anchor go through a shuffle by hash);
3. runs with such anchors are sent to ranges of anchors, each different run of a block once, with its smallest document;
4. a range compares the runs of an anchor: if they are all alike, the smallest document has them; if they differ, their
   suffixes are sorted by a difference cover (``suffixes``), and neighbours that share 50 bytes are one string;
5. blocks get one bit for each string of their runs, remove what is covered and return documents.

Steps 1, 2, 3 and 5 are what Spark distributes; the difference cover sorts within a task, slice by slice. Anchors only rule out what
cannot repeat, but runs of one anchor whose whole 64-bit hashes are equal count as equal and are not compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checkpoints import new_folder
from tidemark.llm.common import byte_sums, gathered, hash_between, kept, mixed, partitions, slices, table, text_of, utf8
from tidemark.llm.suffixes import same_prefixes

LENGTH, ANCHOR = 50, 24
#: Anchors that a string has room for.
ROOM = LENGTH - ANCHOR + 1
BLOCK_BYTES = 4 << 20
#: Bytes of runs that are sorted at once, about; runs of one anchor are never parted.
SORT_BYTES = 1 << 19


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(values.tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def anchors(data: np.ndarray) -> np.ndarray:
    """The place of the anchor of each string of ``LENGTH`` bytes: of the smallest hash in it the first."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    places = len(data) - ANCHOR + 1
    bits = np.uint64(max(places, 2).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    at = np.arange(places)
    least = (hash_between(data, byte_sums(data), at, at + ANCHOR) & ~low) | at.astype(np.uint64)
    size = 1
    while size * 2 <= ROOM:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return (np.minimum(least[:n], least[ROOM - size : ROOM - size + n]) & low).astype(np.int64)


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one anchor, within rows: how many strings, where in the first string the anchor is, and how
    many runs each row has."""
    anchor = anchors(data)
    lengths = np.diff(offsets)
    strings = np.maximum(lengths - LENGTH + 1, 0)
    row = np.repeat(np.arange(len(lengths)), strings)
    start = np.arange(int(strings.sum())) + np.repeat(offsets[:-1] - (np.cumsum(strings) - strings), strings)
    anchor = anchor[start] if len(start) else start
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    return count.astype(np.uint8), (anchor[first] - start[first]).astype(np.uint8), np.bincount(row[first], minlength=len(lengths))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, held, size = TaskContext.get().partitionId() << 24, [], 0

    def block() -> pa.RecordBatch:
        ids = np.concatenate([h[0] for h in held])
        text, lengths, count, place, of_row = (np.concatenate([h[i] for h in held]) for i in range(1, 6))
        parts = {"text": text, "lengths": lengths.astype(np.int64), "count": count, "place": place, "runs": of_row.astype(np.int64), "ids": ids}
        return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), **{k: pa.array([_packed(v)], pa.binary()) for k, v in parts.items()}})

    for batch in slices(batches, 1, 1 << 20):
        data, offsets = utf8(batch.column(1))
        ids = batch.column(0).fill_null(np.iinfo(np.int64).max).to_numpy()
        held.append((ids, data, np.diff(offsets), *runs(data, offsets)))
        size += len(data)
        if size >= BLOCK_BYTES:
            yield block()
            number, held, size = number + 1, [], 0
    if held:
        yield block()


class Block:
    """A block's texts and runs, unpacked."""

    def __init__(self, row: dict) -> None:
        self.number = row["block"]
        self.text, self.ids = _unpacked(row["text"], np.uint8), _unpacked(row["ids"], np.int64)
        self.lengths, self.count, of_row = _unpacked(row["lengths"], np.int64), _unpacked(row["count"], np.uint8).astype(np.int64), _unpacked(row["runs"], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.row = np.repeat(np.arange(len(of_row)), of_row)
        before = np.cumsum(self.count) - self.count
        first = np.cumsum(of_row) - of_row
        base = before[first[self.row]] if len(self.row) else before
        self.start = self.offsets[self.row] + before - base
        self.end = self.start + self.count + LENGTH - 1
        self.sums = byte_sums(self.text)
        place = self.start + _unpacked(row["place"], np.uint8)
        self.anchor = hash_between(self.text, self.sums, place, place + ANCHOR)


def _bucket(hashed: np.ndarray, buckets: int) -> np.ndarray:
    return (hashed >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)


def _parts(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Buckets that are not empty, of sorted numbers, and where they are."""
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), slice(int(edges[b]), int(edges[b + 1]))


def _ask_anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Of each block's different anchors the 32 bits after those that name the bucket, and which occur more than once in it."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            different, times = np.unique(block.anchor, return_counts=True)
            prints = (different >> np.uint64(32 - buckets.bit_length() + 1)).astype(np.uint32)
            rows = [(b, prints[at].tobytes(), np.packbits(times[at] > 1).tobytes()) for b, at in _parts(_bucket(different, buckets), buckets)]
            yield pa.RecordBatch.from_pydict({"block": np.full(len(rows), block.number, np.int64), "bucket": pa.array([r[0] for r in rows], pa.int32()), "prints": pa.array([r[1] for r in rows], pa.binary()), "several": pa.array([r[2] for r in rows], pa.binary())})


def _repeated(asks: pa.Table) -> pa.Table:
    """For each block one bit for each of its anchors in the bucket: whether it occurs again anywhere."""
    prints = [np.frombuffer(x, np.uint32) for x in asks["prints"].to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)) for x, p in zip(asks["several"].to_pylist(), prints, strict=True)]
    everything = np.concatenate(prints)
    order = np.argsort(everything, kind="stable")
    ordered = everything[order]
    twice = np.zeros(len(ordered), bool)
    twice[1:] = ordered[1:] == ordered[:-1]
    twice[:-1] |= ordered[1:] == ordered[:-1]
    again = np.zeros(len(ordered), bool)
    again[order] = twice
    again |= np.concatenate(several).astype(bool)
    bits = [np.packbits(x).tobytes() for x in np.split(again, np.cumsum([len(p) for p in prints])[:-1])]
    return pa.table({"block": asks["block"], "bucket": asks["bucket"], "kind": pa.array(np.zeros(len(bits)), pa.int32()), "bits": pa.array(bits, pa.binary())})


def _again(block: Block, answers: dict[int, bytes], buckets: int) -> np.ndarray:
    """The runs whose anchor occurs again."""
    different, number = np.unique(block.anchor, return_inverse=True)
    again = np.zeros(len(different), bool)
    for b, at in _parts(_bucket(different, buckets), buckets):
        again[at] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=at.stop - at.start)
    return np.flatnonzero(again[number])


def _different(block: Block, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of these runs the different ones: sorted by anchor, the first of the smallest document, and which each run is."""
    anchor = block.anchor[some]
    whole = hash_between(block.text, block.sums, block.start[some], block.end[some])
    order = np.lexsort((block.start[some], block.ids[block.row[some]], whole, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (whole[order][1:] != whole[order][:-1])
    number = np.zeros(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    first = order[new]
    return some[first], number, anchor[first], whole[first]


def _send_runs(buckets: int):
    def send(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        for row in blocks.to_pylist():
            block = Block(row)
            known = dict(zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist(), strict=True))
            first, _, anchor, whole = _different(block, _again(block, known, buckets))
            for b, at in _parts(_bucket(anchor, buckets), buckets):
                text, sizes = gathered(block.text, block.start[first[at]], block.end[first[at]])
                ids = block.ids[block.row[first[at]]]
                rows.append((block.number, b, anchor[at].tobytes(), whole[at].tobytes(), _packed(ids), sizes.astype(np.uint8).tobytes(), _packed(text)))
        names = ["block", "at", "anchors", "wholes", "ids", "sizes", "text"]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return send


def _owners(asks: pa.Table) -> pa.Table:
    """For each run that a block sent, a bit for each of its strings: whether a smaller document has it."""
    rows = asks.to_pylist()
    anchor, whole = (np.concatenate([np.frombuffer(r[c], np.uint64) for r in rows]) for c in ("anchors", "wholes"))
    ids = np.concatenate([_unpacked(r["ids"], np.int64) for r in rows])
    sizes = np.concatenate([np.frombuffer(r["sizes"], np.uint8) for r in rows]).astype(np.int64)
    text = np.concatenate([_unpacked(r["text"], np.uint8) for r in rows])
    end = np.cumsum(sizes)
    order = np.lexsort((ids, whole, anchor))
    sorted_anchor, sorted_whole = anchor[order], whole[order]
    new_anchor, new_run = np.ones(len(order), bool), np.ones(len(order), bool)
    new_anchor[1:] = sorted_anchor[1:] != sorted_anchor[:-1]
    new_run[1:] = new_anchor[1:] | (sorted_whole[1:] != sorted_whole[:-1])
    run = np.cumsum(new_run) - 1  # different runs, the first of each with its smallest document
    first = order[new_run]
    group = (np.cumsum(new_anchor) - 1)[new_run]
    smallest, strings = ids[first], sizes[first] - LENGTH + 1
    at = np.concatenate([[0], np.cumsum(strings)])
    owner = np.repeat(smallest, strings)  # the smallest document of each string of each different run
    hard = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1)
    for part in _by_size(group[hard], sizes[first[hard]]):
        these = hard[part]
        bytes_, lengths = gathered(text, end[first[these]] - sizes[first[these]], end[first[these]])
        starts = np.concatenate([[0], np.cumsum(lengths)])
        _, number = same_prefixes(bytes_, starts, LENGTH)
        place = np.repeat(at[these] - (np.cumsum(strings[these]) - strings[these]), strings[these]) + np.arange(int(strings[these].sum()))
        least = np.full(int(number.max(initial=0)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, number, owner[place])
        owner[place] = least[number]
    mine = np.zeros(len(order), np.int64)
    mine[order] = run
    bits = np.zeros(len(order), np.uint32)
    for i in range(ROOM):
        has = np.flatnonzero(sizes - LENGTH + 1 > i)
        bits[has] |= ((owner[at[mine[has]] + i] < ids[has]).astype(np.uint32) << np.uint32(i)).astype(np.uint32)
    cuts = np.cumsum([len(r["sizes"]) for r in rows])[:-1]
    return pa.table({"block": asks["block"], "bucket": asks["at"], "kind": pa.array(np.ones(len(rows)), pa.int32()), "bits": pa.array([x.tobytes() for x in np.split(bits, cuts)], pa.binary())})


def _by_size(group: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
    """Parts of about ``SORT_BYTES`` that do not part a group."""
    if not len(group):
        return
    edges = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
    ends = np.concatenate([[0], np.cumsum(sizes)])[edges]
    i = 0
    while i < len(edges) - 1:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + SORT_BYTES, "right")) - 1)
        yield slice(int(edges[i]), int(edges[j]))
        i = j


def _remove(buckets: int, with_text: bool):
    def remove(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        tables = []
        for row in blocks.to_pylist():
            block = Block(row)
            found = answers.to_pylist()
            some = _again(block, {a["bucket"]: a["bits"] for a in found if a["kind"] == 0}, buckets)
            first, number, anchor, _ = _different(block, some)
            bits = np.zeros(len(first), np.uint32)
            covered_by = {a["bucket"]: a["bits"] for a in found if a["kind"] == 1}
            for b, at in _parts(_bucket(anchor, buckets), buckets):
                bits[at] = np.frombuffer(covered_by[b], np.uint32)
            # a run of a larger document than the block's first one with it is covered as a whole
            every = ((np.uint64(1) << block.count[some].astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
            larger = block.ids[block.row[some]] > block.ids[block.row[first]][number]
            mask = np.where(larger, every, bits[number])
            change = np.zeros(len(block.text) + 1, np.int32)
            for i in range(ROOM):
                on = block.start[some[(mask >> np.uint32(i)) & 1 == 1]] + i
                np.add.at(change, on, 1)
                np.add.at(change, on + LENGTH, -1)
            gone = np.cumsum(change[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = block.offsets[(block.offsets > 0) & (block.offsets < len(gone))]
            begins[inner] = gone[inner]
            sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[block.offsets])
            left = np.concatenate([[0], np.cumsum(~gone)])[block.offsets]
            rest = block.text[~gone].tobytes()
            pieces = [rest[i:j] for i, j in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)]
            none = block.ids == np.iinfo(np.int64).max
            tables.append(
                pa.table(
                    {"doc_id": pa.array(block.ids, mask=none), "n_bytes": block.lengths, "n_removed": sums(gone), "n_spans": sums(begins), "kept_sha256": [hashlib.sha256(p).hexdigest() for p in pieces]}
                    | ({"kept": pa.array(pieces, pa.binary())} if with_text else {})
                )
            )
        return pa.concat_tables(tables) if tables else _nothing(with_text)

    return remove


def _nothing(with_text: bool) -> pa.Table:
    fields = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()} | ({"kept": pa.binary()} if with_text else {})
    return pa.schema(list(fields.items())).empty_table()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept``, the bytes that remain, if
    asked for.

    Each byte goes that a string of 50 bytes covers which also starts in a document with a smaller id. A null text counts as
    empty, and texts below 50 bytes stay whole. A null id is larger than all others. Rows with one id do not cover each
    other, so of rows that repeat each is treated alike. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = 1 << (4 * partitions(spark) - 1).bit_length()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    packed = rows.mapInArrow(_blocks, "block long, text binary, lengths binary, count binary, place binary, runs binary, ids binary")
    name = "blocks_" + new_folder(spark, "x").rpartition("-")[2]
    # bucketed, so that what blocks are told comes to them and they stay where they are
    packed.write.bucketBy(partitions(spark), "block").option("path", new_folder(spark, "blocks")).saveAsTable(name)
    blocks = spark.table(name)
    asked = blocks.mapInArrow(partial(_ask_anchors, buckets=buckets), "block long, bucket int, prints binary, several binary")
    answer = "block long, bucket int, kind int, bits binary"
    repeated = kept(asked.groupBy("bucket").applyInArrow(_repeated, answer), "repeated")
    to_blocks = repeated.select(F.col("block").alias("of"), "bucket", "bits")
    sent = blocks.groupBy("block").cogroup(to_blocks.groupBy("of")).applyInArrow(_send_runs(buckets), "block long, at int, anchors binary, wholes binary, ids binary, sizes binary, text binary")
    covered = kept(sent.groupBy("at").applyInArrow(_owners, answer), "covered")
    both = repeated.unionByName(covered).select(F.col("block").alias("of"), "bucket", "kind", "bits")
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return blocks.groupBy("block").cogroup(both.groupBy("of")).applyInArrow(_remove(buckets, with_text), result)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
