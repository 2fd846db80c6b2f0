"""Near-duplicates by MinHash with odd sketches.

Texts with the same set of shingles are one class, and one text stands for it. Bands of MinHash samples put classes into
buckets. Within a bucket, odd sketches (the samples folded into a parity bitmap, compared by XOR and population count)
estimate similarities, and parity bitmaps of the whole sets rule out pairs for sure; what is left is confirmed on the full
sets of shingles. Only pairs whose classes are not yet in one component are of interest, so each bucket proposes a
spanning forest of its likeliest pairs, these are confirmed, components are joined, and buckets that are still in several
parts propose all their other pairs, until none is left. A large bucket is compared block by block, so no task holds it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, SMALL, kept, numbered, partitions, slices, table, text_of, without
from tidemark.llm.shingles import bands, digests, layout, odd_sketches, parities, samples, shingle_sets

#: Classes of a bucket that are compared at once.
BLOCK = 1024


def _describe(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of each text: the size and digests of its set, its band keys, its odd sketch and the parity bitmap of its set."""
    count, band, _ = layout(percent)
    for batch in slices(batches, 2, 1 << 20):
        sets, ends = shingle_sets(batch.column(2), size)
        n = np.diff(ends)
        full = n > 0
        ends_full = np.concatenate([[0], np.cumsum(n[full])])
        found = samples(sets, ends_full, count)
        first, second = digests(sets, ends)
        wide = lambda a: _rows(a, full)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), wide(bands(found, band).T), wide(odd_sketches(found)), wide(parities(sets, ends_full))],
            ["id", "row", "size", "digest", "digest2", "bands", "sketch", "parity"],
        )


def _rows(values: np.ndarray, full: np.ndarray) -> pa.Array:
    out = [None] * len(full)
    for i, v in zip(np.flatnonzero(full), np.ascontiguousarray(values), strict=True):
        out[i] = v.tobytes()
    return pa.array(out, pa.binary())


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
        each = len(keys) // max(batch.num_rows, 1)
        yield pa.RecordBatch.from_pydict({"band": pa.array(keys), "node": pa.array(np.repeat(batch.column(0).to_numpy(), each))})


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _propose(members: pa.Table, percent: int, forest: bool) -> pa.Table:
    """Pairs worth confirming, of many groups: each a bucket, or two blocks of a large one."""
    group = members["band"].to_numpy(), members["one"].to_numpy(), members["two"].to_numpy()
    order = np.lexsort((members["node"].to_numpy(), *group[::-1]))
    members = members.take(order)
    group = [g[order] for g in group]
    cut = np.flatnonzero((np.diff(group[0]) != 0) | (np.diff(group[1]) != 0) | (np.diff(group[2]) != 0)) + 1
    node, size, comp, block = (members[c].to_numpy() for c in ("node", "size", "comp", "block"))
    sketch, parity = _matrix(members["sketch"]), _matrix(members["parity"])
    out: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    for i, j in zip([0, *cut], [*cut, len(node)], strict=True):
        of, parts = slice(i, j), comp[i:j]
        if j - i < 2 or (parts == parts[0]).all():
            continue
        x, y = _close(sketch[of], parity[of], size[of], parts, block[of] if group[1][i] != group[2][i] else None, percent)
        if forest:
            tree = _forest(x, y, parts)
            x, y = x[tree], y[tree]
        out.append(np.sort(np.stack([node[i + x], node[i + y]], axis=1), axis=1))
    pairs = np.concatenate(out)
    return pa.Table.from_pydict({"a": pairs[:, 0], "b": pairs[:, 1]})


def _forest(x: np.ndarray, y: np.ndarray, parts: np.ndarray) -> list[int]:
    """The places of the first pairs that join components, read in pieces."""
    found: dict[int, int] = {}
    out = []

    def root(z: int) -> int:
        while found.setdefault(z, z) != z:
            found[z] = z = found[found[z]]
        return z

    for at in range(0, len(x), 1 << 14):
        some = slice(at, at + (1 << 14))
        for k, (a, b) in enumerate(zip(parts[x[some]].tolist(), parts[y[some]].tolist(), strict=True), at):
            p, q = root(a), root(b)
            if p != q:
                found[p] = q
                out.append(k)
    return out


def _proposer(percent: int, forest: bool) -> Callable[[pa.Table], pa.Table]:
    return lambda members: _propose(members, percent, forest)


def _close(sketch: np.ndarray, parity: np.ndarray, size: np.ndarray, comp: np.ndarray, block: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components that sketches do not rule out, likeliest first."""
    n, rows, found, (_, _, far) = len(size), max(1, 200_000 // len(size)), [], layout(percent)
    for i in range(0, n, rows):
        these = slice(i, min(i + rows, n))
        both = size[these, None] + size[None, :]
        # a link has at most this many shingles that are in one set only
        most = (100 - percent) * both // (100 + percent)
        ok = (np.abs(size[these, None] - size[None, :]) <= most) & (comp[these, None] != comp[None, :])
        ok &= np.arange(i, these.stop)[:, None] < np.arange(n)[None, :]
        if block is not None:
            ok &= block[these, None] != block[None, :]
        x, y = np.nonzero(ok)
        x += i
        sure = np.bitwise_count(parity[x] ^ parity[y]).sum(1) <= most[x - i, y]
        x, y = x[sure], y[sure]
        apart = np.bitwise_count(sketch[x] ^ sketch[y]).sum(1)
        near = apart <= far
        found.append(np.stack([apart[near], x[near], y[near]]).astype(np.int32))
    apart, x, y = np.concatenate(found, axis=1)
    order = np.argsort(apart, kind="stable")
    return x[order], y[order]


def _confirm(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Whether pairs of texts are linked, on their full sets of shingles."""
    for batch in slices(batches, 2, 1 << 20):
        one, at_one = shingle_sets(batch.column(2), size)
        two, at_two = shingle_sets(batch.column(3), size)
        linked = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            a, b = one[at_one[i] : at_one[i + 1]], two[at_two[i] : at_two[i + 1]]
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked[i] = both > 0 and 100 * both >= percent * (len(a) + len(b) - both)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked)], ["a", "b", "linked"])


def _texts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Of rows with one id, those whose text is that of the class."""
    for batch in slices(batches, 2, 1 << 20):
        first, _ = digests(*shingle_sets(batch.column(2), size))
        same = first.view(np.int64) == batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], ["node", "text"]).filter(pa.array(same))


def _if_small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL else df


def components(edges: DataFrame) -> DataFrame:
    """For each end of the edges (a, b) the smallest number it is connected with: node, comp.

    Labels take the smallest of their neighbours', then that label's own label, so that chains shorten by halves.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = kept(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = kept(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("u").alias("v"), F.col("label").alias("of_v")), "v").groupBy("u").agg(F.min("of_v").alias("m"))
        lower = kept(labels.join(near, "u").select("u", "label", F.least("label", "m").alias("low")), "labels")
        own = lower.select(F.col("u").alias("low"), F.col("low").alias("lowest"))
        moved = kept(lower.join(own, "low").select("u", F.col("lowest").alias("label"), (F.col("lowest") != F.col("label")).alias("moved")), "labels")
        labels = moved.select("u", "label")
        if moved.where("moved").isEmpty():
            return labels.select(F.col("u").alias("node"), F.col("label").alias("comp"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 85, row_col: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept, stays, row.

    Two texts are linked if their sets of shingles share ``percent`` of 100 of their union. A null text counts as empty; texts
    without words are linked with nothing, and each is its own component. ``kept`` is whether a row's id is that of its component, the
    smallest in it (no id last); of rows that repeat, ids included, that holds for all or none. ``stays`` is true for one row of
    each component, of the kept ones the first. ``row`` is ``row_col``, which then has to be unique, or else a number of the row. Other columns are not read. An empty table gives no rows.
    Samples, bands and the cut of sketches follow from ``percent`` (1 to 100): a link is missed by the bands, or dropped by
    its sketches, with a probability of 2.5e-8 each at most.
    """
    layout(percent)  # raises for a value out of range
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"), text_of(text_col).alias("text"))
    schema = f"id {kind}, row long, size long, digest long, digest2 long, bands binary, sketch binary, parity binary"
    described = kept(rows.mapInArrow(lambda b: _describe(b, size, percent), schema), "described")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    # a text without words is a class of its own
    key = ["digest", "digest2", F.when(F.col("size") == 0, F.col("row")).alias("alone")]
    classes = described.groupBy(*key).agg(first, F.count("*").alias("copies"))
    classes = kept(classes.select("digest", "digest2", "alone", F.col("first.row").alias("node"), F.col("first.id").alias("id"), F.col("first.none").alias("none")), "classes")
    nodes = kept(described.where("size > 0").join(classes.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "size", "bands", "sketch", "parity"), "nodes")
    comps = _linked(spark, docs, nodes, classes, id_col, text_col, size, percent)
    named = classes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    best = named.groupBy("comp").agg(F.min(F.struct("none", "id", "node")).alias("best"))
    of_class = named.join(best, "comp").select("digest", "digest2", F.coalesce("alone", F.lit(-1)).alias("alone"), F.col("best.id").alias("component_id"), F.col("best.node").alias("keep_row"))
    slim = described.select("id", "row", "size", "digest", "digest2", F.when(F.col("size") == 0, F.col("row")).otherwise(F.lit(-1)).alias("alone"))
    return slim.join(of_class, ["digest", "digest2", "alone"]).select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), (F.col("row") == F.col("keep_row")).alias("stays"), "row")


def _linked(spark: SparkSession, docs: DataFrame, nodes: DataFrame, classes: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """Components of classes that are linked with another one: node, comp."""
    exploded = nodes.select("node", "bands").mapInArrow(_explode, "band long, node long")
    buckets = exploded.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    members = kept(exploded.join(buckets, "band"), "members")
    inside = kept(members.select("node").distinct(), "inside")
    n_inside = inside.count()
    wanted = kept(classes.join(inside, "node").select("node", "digest", "id"), "wanted")
    looked_up = docs.select(F.col(f"`{id_col}`").alias("doc"), text_of(text_col).alias("text")).join(_if_small(wanted, n_inside), F.col("doc").eqNullSafe(F.col("id")))
    texts = kept(looked_up.select("node", "digest", "text").mapInArrow(lambda b: _texts(b, size), "node long, text string"), "texts")
    about = nodes.join(inside, "node").drop("bands")
    comps = failed = None
    links, turn = None, 0
    while True:
        state = about.withColumn("comp", F.col("node")) if comps is None else about.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        state = kept(state.select("node", "size", "comp", "sketch", "parity"), "state")
        parts = members.join(state.select("node", "comp"), "node")
        torn = parts.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("band")
        blocks = F.ceil(F.col("members") / BLOCK).cast("int")
        dealt = (
            members.join(torn, "band")
            .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("band", "node", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
            .join(state, "node")
            .withColumn("deal", F.pmod(F.xxhash64("band", "one", "two"), F.lit(4 * partitions(spark))))
        )
        proposed = dealt.groupBy("deal").applyInArrow(_proposer(percent, turn == 0), "a long, b long").distinct()
        proposed = kept(proposed if failed is None else proposed.join(failed, ["a", "b"], "left_anti"), "proposed")
        n = proposed.count()
        if not n:
            return comps if comps is not None else spark.createDataFrame([], "node long, comp long")
        with_one = texts.select(F.col("node").alias("a"), F.col("text").alias("one")).join(_if_small(proposed, n), "a")
        with_both = with_one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("two")), "b").select("a", "b", "one", "two")
        tested = kept(with_both.mapInArrow(lambda b: _confirm(b, size, percent), "a long, b long, linked boolean"), "tested")
        new_links, new_failed = tested.where("linked").select("a", "b"), tested.where("NOT linked").select("a", "b")
        links = new_links if links is None else links.unionByName(new_links)
        comps = kept(components(links), "components")
        failed = new_failed if failed is None else failed.unionByName(new_failed)
        turn += 1


def without_near_copies(docs: DataFrame, percent: int = 85, **columns: str) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: one of each component."""
    rows = numbered(docs)
    return without(rows, near_dedup(rows, percent=percent, row_col=ROW, **columns).where("NOT stays").select(F.col("row").alias(ROW)))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).drop("row", "stays")
