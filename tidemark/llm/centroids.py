"""Exact k-means by Shallot search.

Every vector remembers its nearest and its second-nearest centroid, an upper bound of its distance to the first
and a lower bound of its distance to all others. Centroids that move widen the bounds by as much. Where they still part, nothing is computed; where they
do not, the search starts from the closer one of the two remembered centroids and looks at the others in order of their distance
from it, only as far as the search ball reaches: the distance to the start plus that to the second best so far, which shrinks
as better ones are found. Bounds are doubles with some slack; survivors are compared by squared distances in whole numbers, so that
results are exact, ties included.

A round is one pass of tasks over the vectors with what they remember, written to the shared folder; the tasks' sums for each centroid are rows
of the same table. The table of the round before is then removed, so there are never more than two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checkpoints import new_folder, remove_folder
from tidemark.llm.common import table
from tidemark.llm.vectors import added_up, chunks, floored, packed, unpacked

#: What bounds are widened by, relatively: more than what rounding of doubles can amount to.
SLACK = 1e-12


def _squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    apart = x - centroids
    return np.einsum("ij,ij->i", apart, apart)


def _neighbours(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid the others, nearest first, and their distances."""
    k = len(centroids)
    squared = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(2)
    order = np.array([[j for j in np.lexsort((np.arange(k), squared[i])) if j != i] for i in range(k)], np.int64).reshape(k, k - 1)
    return order, np.sqrt(np.take_along_axis(squared, order, 1).astype(np.float64))


def search(x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray) -> int:
    """Bring what the vectors ``x`` remember (changed in place) up to date; gives the number of distances computed."""
    k, computed = len(centroids), 0
    todo = np.flatnonzero(~(upper < lower))
    squared = _squared(x[todo], centroids[near[todo]])
    computed += len(todo)
    upper[todo] = np.sqrt(squared) * (1 + SLACK)
    if k == 1:
        return computed
    open_ = ~(upper[todo] < lower[todo])
    todo, best = todo[open_], squared[open_]
    start, other = near[todo], second[todo]
    next_ = _squared(x[todo], centroids[other])
    computed += len(todo)
    swap = (next_ < best) | ((next_ == best) & (other < start))
    start, other = np.where(swap, other, start), np.where(swap, start, other)
    best, next_ = np.where(swap, next_, best), np.where(swap, best, next_)
    order, gaps = _neighbours(centroids)
    reach = np.sqrt(best)
    first, known = start.copy(), other.copy()
    ball = np.arange(len(todo))  # those whose ball reaches the neighbour at hand
    for at in range(k - 1):
        inside = gaps[start[ball], at] <= (reach[ball] + np.sqrt(next_[ball])) * (1 + SLACK)
        ball = ball[inside]
        if not len(ball):
            break
        j = order[start[ball], at]
        new = j != known[ball]
        some, j = ball[new], j[new]
        found = _squared(x[todo[some]], centroids[j])
        computed += len(some)
        nearest = (found < best[some]) | ((found == best[some]) & (j < first[some]))
        closer = ~nearest & (found < next_[some])
        a, b = some[nearest], some[closer]
        next_[a], other[a] = best[a], first[a]
        best[a], first[a] = found[nearest], j[nearest]
        next_[b], other[b] = found[closer], j[closer]
    near[todo], second[todo] = first, other
    upper[todo] = np.sqrt(best) * (1 + SLACK)
    lower[todo] = np.sqrt(next_) * (1 - SLACK)
    return computed


def _moved(upper: np.ndarray, lower: np.ndarray, near: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds after centroids moved: the nearest one by its own way, all others by the longest way among them."""
    others = np.array([np.delete(moves, i).max(initial=0.0) for i in range(len(moves))])
    return (upper + moves[near]) * (1 + SLACK), lower - others[near] * (1 + SLACK) - np.abs(lower) * SLACK


def _vectors(batches: Iterator[pa.RecordBatch], dims: int, scale: int, most: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        rows, x = floored(batch.column(1), dims, scale, most)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), packed(x)], ["id", "vector"])


_FIELDS = ["id", "vector", "near", "second", "upper", "lower", "distance", "cluster", "sums", "computed"]


def _round(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, moves: np.ndarray | None, last: bool, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One assignment of all vectors, and at the end the task's sums of each cluster: its rows, then its components."""
    k, dims = centroids.shape
    sums = np.zeros((k, dims + 1), np.int64)
    work = 0
    for batch in chunks(batches):
        n, x = batch.num_rows, unpacked(batch.column(1), dims)
        if moves is None:  # nothing is remembered yet
            near, second = np.zeros(n, np.int64), np.full(n, min(1, k - 1))
            upper, lower = np.full(n, np.inf), np.full(n, np.inf if k == 1 else -np.inf)
        else:
            near, second, upper, lower = (batch.column(i).to_numpy(zero_copy_only=False).copy() for i in range(2, 6))
            near, second = near.astype(np.int64), second.astype(np.int64)
            upper, lower = _moved(upper, lower, near, moves)
        work += search(x, near, second, upper, lower, centroids)
        distance = pa.array(_squared(x, centroids[near])) if last else pa.nulls(n, pa.int64())
        np.add.at(sums[:, 0], near, 1)
        for c in np.unique(near):
            sums[c, 1:] += x[near == c].sum(0)
        state = [pa.array(near.astype(np.int32)), pa.array(second.astype(np.int32)), pa.array(upper), pa.array(lower), distance]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *state, pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64())], _FIELDS)
    filled = np.flatnonzero(sums[:, 0])
    if len(filled):
        nulls = [pa.nulls(len(filled), t) for t in (id_type, pa.binary(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())]
        own = [pa.array(filled.astype(np.int32)), pa.array(sums[filled].tolist(), pa.list_(pa.int64())), pa.array(np.full(len(filled), work))]
        yield pa.RecordBatch.from_arrays([*nulls, *own], _FIELDS)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    seed: str = "3",
    report: list[int] | None = None,
) -> DataFrame:
    """One row for each vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Vectors with exactly ``dims`` finite entries take part, as floor(scale * entry). The first centroids are the ``k`` vectors
    whose sha256 of ``seed:id`` is smallest (a null id counts as empty; of rows that share an id the vector of smaller bytes first); with fewer
    vectors there are as many centroids. Each round assigns, then moves every centroid that has vectors to the floor of
    their mean. Rows that repeat are vectors of their own. Entries so large that a squared distance has no 64 bits (beyond 2**27 of
    64 entries) take no part. Sums beyond 64 bits are given as null. No vectors give no rows. Other columns are not read.
    ``report`` collects the number of distances that each round computed.
    """
    spark = vectors.sparkSession
    most = isqrt((1 << 62) // dims) // 2
    id_field = T.StructField("id", vectors.schema[id_col].dataType)
    given = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    whole = given.mapInArrow(partial(_vectors, dims=dims, scale=scale, most=most), T.StructType([id_field, T.StructField("vector", T.BinaryType())]))
    state, path = _written(whole, "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = state.orderBy(order, "vector").limit(k).select("vector").collect()
    schema = T.StructType(
        [id_field, *[T.StructField(n, t) for n, t in zip(_FIELDS[1:], (T.BinaryType(), T.IntegerType(), T.IntegerType(), T.DoubleType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.ArrayType(T.LongType()), T.LongType()))]]
    )
    if not first:
        return _result(spark.createDataFrame([], schema), np.zeros((0, dims), np.int64))
    centroids = np.array([np.frombuffer(r.vector, np.int32) for r in first], np.int64)
    id_type = whole.limit(0).toArrow().schema.field("id").type
    moves = None
    for n in range(rounds + 1):
        step = partial(_round, centroids=centroids, moves=moves, last=n == rounds, id_type=id_type)
        rows = state.where("sums IS NULL").select(*_FIELDS[:6]) if n else state
        new, new_path = _written(rows.mapInArrow(step, schema), "assigned")
        remove_folder(spark, path)
        state, path = new, new_path
        if report is not None:
            tasks = state.where("sums IS NOT NULL").groupBy(F.input_file_name()).agg(F.max("computed").alias("n"))
            report.append(tasks.agg(F.sum("n")).first()[0])
        if n < rounds:
            sums = added_up(state, "cluster", "sums")
            moved = centroids.copy()
            for c, (count, *parts) in sums.items():
                moved[c] = [p // count for p in parts]
            moves = np.sqrt(((moved - centroids) ** 2).sum(1).astype(np.float64)) * (1 + SLACK)
            centroids = moved
    return _result(state, centroids)


def _result(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows, with the sums of distances and the digest of the centroid: one small row for each cluster, which is broadcast."""
    spark = state.sparkSession
    rows = state.where("sums IS NULL").select(F.col("id").alias("vec_id"), F.col("near").alias("cluster"), "distance")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()
    own = {r.cluster: int(r.own) for r in sums}
    whole = lambda n: n if n < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    found = [(i, whole(own.get(i, 0)), whole(sum(own.values())), digest(c)) for i, c in enumerate(centroids.tolist())]
    of_cluster = spark.createDataFrame(found, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = rows.join(F.broadcast(of_cluster), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle(dims: int = 64, k: int = 8, rounds: int = 10) -> str:
    """The same clustering in SQL, comparing all vectors with all centroids in every round."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: isfinite(e))) = {dims}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, x AS c FROM v QUALIFY k < {k}
)"""
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} AS MATERIALIZED (
  SELECT r, k, d FROM (
    SELECT r, k, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{n}
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1
)"""
        )
        if n < rounds:
            steps.append(
                f"""c{n + 1} AS MATERIALIZED (
  SELECT c{n}.k, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN (
    SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
      SELECT k, i, sum(e) AS s, count(*) AS n
      FROM (SELECT k, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM v JOIN a{n} USING (r)) GROUP BY k, i
    ) GROUP BY k
  ) m ON m.k = c{n}.k
)"""
            )
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN c{rounds} USING (k)
"""


ORACLE = _oracle()
