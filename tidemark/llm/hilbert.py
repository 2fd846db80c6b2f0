"""Nearest neighbours by largest inner product, found along shifted Hilbert curves.

Vectors are brought onto one sphere (one more coordinate takes up what a vector is shorter than the longest), so that the
largest inner product is the nearest point. Each of several orderings projects them to a few dimensions, shifts them and
sorts them along a Hilbert curve; Spark's range partitioning cuts an ordering into blocks of neighbouring keys. A query looks
into its own block and ``window`` blocks either side in every ordering; what all windows find is merged and reranked by
exact inner products. The window is the narrowest that finds ``recall`` of the true neighbours of a bounded sample
of queries, for which all rows are compared. Where a window takes in many queries, these are dealt out to several tasks.

Curves narrow the search as far as the vectors have clusters or few directions. On vectors spread evenly over 64 dimensions no window is
narrow: for a recall of 0.9 the six windows together hold 1.27 times the rows at 20,000 vectors and 1.07 times at 100,000 (24
orderings: 0.82 and 0.63), by simulation.

Of equal vectors only the ``k`` + 1 with the smallest ids can be in a result, so only these are laid along the curves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, partitions, table

#: Orderings, dimensions they project to, bits of each dimension.
ORDERINGS, DIMENSIONS, BITS = 6, 8, 6
#: Rows of a block, about.
BLOCK = 2048
#: Queries that look into a block in one task; beyond, they are dealt out, and each deal gets the block's rows.
LOOKING = 8192
#: Rows that shifts and scales are fitted on, and queries that the window is fitted on: documented bounds.
SAMPLE_ROWS, SAMPLE_QUERIES = 2000, 64


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places along the Hilbert curve of points with whole coordinates (rows) below 2**bits, by the transposed index of
    Skilling's public description."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:  # undo what lower bits are turned by
        low = bit - 1
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[n - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Curves:
    """The orderings: projections, and the ranges that their coordinates are cut in."""

    def __init__(self, sample: np.ndarray, longest: float, seed: int = 11) -> None:
        draw = np.random.default_rng(seed)
        self.longest = longest
        width = sample.shape[1] + 1
        whole = self.lift(sample)
        self.projections, self.low, self.scale = [], [], []
        for _ in range(ORDERINGS):
            basis, _ = np.linalg.qr(draw.standard_normal((width, min(DIMENSIONS, width))))
            points = whole @ basis
            low, high = np.quantile(points, [0.01, 0.99], axis=0) if len(points) else (np.zeros(basis.shape[1]), np.ones(basis.shape[1]))
            step = np.maximum(high - low, 1e-12) / (1 << BITS) * 1.25
            self.projections.append(basis)
            self.low.append(low - step * (1 << BITS) * 0.2 * draw.random(len(low)))  # the shift of this ordering
            self.scale.append(step)

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """Onto the sphere: inner products with a lifted query, whose last coordinate is 0, are as before."""
        rest = np.sqrt(np.maximum(self.longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        return np.concatenate([vectors, rest[:, None]], axis=1)

    def lift_queries(self, vectors: np.ndarray) -> np.ndarray:
        lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        return np.concatenate([vectors * (self.longest / lengths)[:, None], np.zeros((len(vectors), 1))], axis=1)

    def keys(self, points: np.ndarray) -> list[np.ndarray]:
        out = []
        for basis, low, scale in zip(self.projections, self.low, self.scale, strict=True):
            cells = np.floor((points @ basis - low) / scale).clip(0, (1 << BITS) - 1)
            out.append(hilbert_keys(cells))
        return out


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(1)
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        each = 8 * (len(flat) // max(batch.num_rows, 1))
        raw = flat.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raw[i * each : (i + 1) * each] for i in range(batch.num_rows)], pa.binary())], ["vec_id", "vector"])


def _orders(batches: Iterator[pa.RecordBatch], curves: Curves) -> Iterator[pa.RecordBatch]:
    """Each vector once in each ordering; ``role`` 0: to be found, 1: a query."""
    for batch in batches:
        vectors, role = _matrix(batch.column(1)), batch.column(2).to_numpy()
        points = np.where(role[:, None] == 1, curves.lift_queries(vectors), curves.lift(vectors)) if batch.num_rows else np.zeros((0, 1))
        for t, keys in enumerate(curves.keys(points) if batch.num_rows else []):
            columns = [pa.array(np.full(batch.num_rows, t, np.int32)), pa.array(keys), *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, ["ordering", "key", "vec_id", "vector", "role"])


def top(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and inner products of its ``k`` best rows, nearest first, ties to the smaller id."""
    for i in range(0, len(queries), 256):
        scores = queries[i : i + 256] @ vectors.T
        for j, row in enumerate(scores):
            q = i + j
            if len(row) > k + 1:
                least = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
                some = np.flatnonzero(row >= least - 1e-9 * max(abs(least), 1e-30))
            else:
                some = np.arange(len(row))
            some = some[ids[some] != query_ids[q]]
            exact = (vectors[some] * queries[q]).sum(1)  # the same sum wherever a row is found
            order = np.lexsort((ids[some], -exact))[:k]
            yield ids[some][order], exact[order]


def _found(query_ids: list, results: Iterator[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    results = list(results)
    return pa.table(
        {
            "query_id": pa.array(query_ids, pa.int64()),
            "ids": pa.array([r[0] for r in results], pa.list_(pa.int64())),
            "scores": pa.array([r[1] for r in results], pa.list_(pa.float64())),
        }
    )


def _match(k: int):
    def match(there: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(there) or not len(asked):
            return _found([], iter(()))
        # a small block holds parts of several orderings, and so a row more than once
        there = there.take(np.unique(there["vec_id"].to_numpy(), return_index=True)[1])
        asked = asked.take(np.unique(asked["query_id"].to_numpy(), return_index=True)[1])
        ids = asked["query_id"].to_numpy()
        return _found(ids.tolist(), top(ids, _matrix(asked["query"]), there["vec_id"].to_numpy(), _matrix(there["vector"]), k))

    return match


def _merge(k: int):
    def merge(found: pa.Table) -> pa.Table:
        lengths = pa.compute.list_value_length(found["ids"]).to_numpy()
        query = np.repeat(found["query_id"].to_numpy(), lengths)
        ids, scores = found["ids"].combine_chunks().flatten().to_numpy(), found["scores"].combine_chunks().flatten().to_numpy()
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
        query, ids, scores = query[new], ids[new], scores[new]
        rank = np.arange(len(query)) - np.searchsorted(query, query) + 1
        best = rank <= k
        return pa.table({"query_id": query[best], "rank": pa.array(rank[best], pa.int32()), "vec_id": ids[best], "score": scores[best]})

    return merge


_FOUND = "query_id long, ids array<long>, scores array<double>"
_RESULT = "query_id long, rank int, vec_id long, score double"


def _merged(found: DataFrame, k: int) -> DataFrame:
    deal = F.pmod(F.xxhash64("query_id"), F.lit(partitions(found.sparkSession)))
    return found.withColumn("deal", deal).groupBy("deal").applyInArrow(lambda t: _merge(k)(t.drop_columns("deal")), _RESULT)


def exact_search(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """All rows compared with a few queries, which are sent along: the measure that windows are fitted by."""
    few = queries.toArrow()
    ids, vectors = few["vec_id"].to_numpy(), _matrix(few["vector"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and len(ids):
                found = _found(ids.tolist(), top(ids, vectors, batch.column(0).to_numpy(), _matrix(batch.column(1)), k))
                yield from found.to_batches()

    return _merged(rows.select("vec_id", "vector").mapInArrow(compare, _FOUND), k)


def search(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = 0.95,
    block: int = BLOCK,
) -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``. Returns query_id, rank (from 1), vec_id, score: of each query
    the ``k`` rows found with the largest inner products, its own id apart, ties to the smaller id.

    Vectors that are null or zero, hold null or non-finite components, have no id, or have another length than most, take
    no part. Of rows with one id one is used. Other columns are not read. An empty table gives no rows.
    """
    vector = F.col(f"`{vector_col}`")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)
    )
    length = usable.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return vectors.sparkSession.createDataFrame([], _RESULT)
    same = usable.where(F.size("vector") == length["n"]).mapInArrow(_as_bytes, "vec_id long, vector binary")
    rows = kept(same.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    first = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    index = kept(rows.withColumn("copy", first).where(F.col("copy") <= k + 1).select("vec_id", "vector"), "index")
    queries = rows.where(F.col("vec_id") % every == 0)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = _matrix(batch.column(0))
                yield pa.RecordBatch.from_pydict({"longest": [float(np.sqrt((found**2).sum(1).max()))], "n": [batch.num_rows]})

    size = index.select("vector").mapInArrow(lengths, "longest double, n long").agg(F.max("longest").alias("longest"), F.sum("n").alias("n")).first()
    drawn = lambda n, of: F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(min(1.0, n / max(of, 1)) * (1 << 30))
    sample = index.where(drawn(SAMPLE_ROWS, size["n"])).orderBy("vec_id").toArrow()
    curves = Curves(_matrix(sample["vector"]) if len(sample) else np.zeros((0, length["n"])), size["longest"])
    both = index.withColumn("role", F.lit(0)).unionByName(queries.withColumn("role", F.lit(1)))
    orders = both.mapInArrow(lambda b: _orders(b, curves), "ordering int, key long, vec_id long, vector binary, role int")
    asked = queries.count()
    blocks = max(1, -(-ORDERINGS * (size["n"] + asked) // block))
    # equal keys are told apart by id, so a key that many rows have is cut as well
    placed = orders.repartitionByRange(blocks, "ordering", "key", "vec_id", "role").withColumn("block", F.spark_partition_id())
    placed = kept(placed, "placed")
    window = _window(placed, queries.where(drawn(SAMPLE_QUERIES, asked)), index, k, recall)
    most = placed.where("role = 1").groupBy("block").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    deals = max(1, -(-(2 * window + 1) * most // LOOKING))
    there = placed.where("role = 0").select("block", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"), "vec_id", "vector")
    near = F.explode(F.sequence(F.col("block") - window, F.col("block") + window))
    deal = F.pmod(F.xxhash64("vec_id"), F.lit(deals)).cast("int")
    looking = placed.where("role = 1").select(near.alias("at"), deal.alias("deal"), F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))
    found = there.groupBy("block", "deal").cogroup(looking.groupBy("at", "deal")).applyInArrow(_match(k), _FOUND)
    return _merged(found, k)


def _window(placed: DataFrame, sample: DataFrame, index: DataFrame, k: int, recall: float) -> int:
    """The narrowest window, in blocks either side, by which the sample's queries find their true neighbours."""
    true = kept(exact_search(sample, index, k).select("query_id", "vec_id"), "true")
    of_query = placed.where("role = 1").select(F.col("vec_id").alias("query_id"), "ordering", F.col("block").alias("from"))
    of_row = placed.where("role = 0").select("vec_id", "ordering", F.col("block").alias("to"))
    apart = true.join(of_query, "query_id").join(of_row, ["vec_id", "ordering"]).groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("from") - F.col("to"))).alias("apart"))
    counts = apart.groupBy("apart").count().orderBy("apart").collect()  # at most sample times k
    wanted, seen = recall * sum(r["count"] for r in counts), 0
    for row in counts:
        seen += row["count"]
        if seen >= wanted:
            return int(row["apart"])
    return 0


def op7_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
