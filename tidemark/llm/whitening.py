"""Whitening of embeddings with a covariance weighted by multiplicity.

Identical vectors (as whole numbers) are grouped, so everything is worked out once for each different one, with its count
or one as its weight in the fit. Tasks multiply blocks of centred vectors (weighted GEMM) and hand their sums over; the driver sees
a matrix of dimensions squared. Each different vector is whitened once and joined back to its rows: the frequent ones, of which
there can only be ``FREQUENT``, by broadcast, all others by a shuffle of digests.

Centring is by the mean rounded to whole numbers, so that products and their sums are exact whatever the order of rows; what rounding
left is taken off exactly before anything becomes a double.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import kept, table
from tidemark.llm.vectors import added_up, chunks, floored, packed, unpacked

#: A vector in more than one in so many of all rows is frequent: there are no more of these than that.
FREQUENT = 1024
#: Entries that are whole numbers beyond this take no part: they have no 32 bits.
MOST = 2**31 - 1
_EXACT = 1 << 53


def _digested(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        rows, x = floored(batch.column(1), dims, scale, MOST)
        vector = packed(x)
        digest = pa.array([hashlib.sha256(v.as_buffer()).digest() for v in vector], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), vector, digest], ["id", "vector", "digest"])


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)


def _totals(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """The task's sum of weights, then of each dimension."""
    sums = [0] * (dims + 1)
    for batch in chunks(batches):
        x, w = unpacked(batch.column(0), dims), _weights(batch)
        sums[0] += int(w.sum())
        top = int(np.abs(x).max(initial=0)) * int(w.max(initial=0)) * len(x)
        parts = (x * w[:, None]).sum(0) if top < 1 << 62 else (x.astype(object) * w[:, None]).sum(0)
        sums[1:] = [a + int(b) for a, b in zip(sums[1:], parts)]
    if sums[0]:
        yield _sums_row(sums)


def _sums_row(sums: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([[str(s) for s in sums]], pa.list_(pa.string()))], ["part", "sums"])


_SUMS = "part int, sums array<string>"


def _products(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The sum of w times the outer product of each row with itself, exactly: in doubles where all sums stay whole there."""
    top = int(np.abs(x).max(initial=0)) ** 2 * int(w.max(initial=0))
    step = _EXACT // max(top, 1)
    out = np.zeros((x.shape[1], x.shape[1]), object)
    for at in range(0, len(x), max(step, 1)):
        part, weight = x[at : at + max(step, 1)], w[at : at + max(step, 1), None]
        if step:
            part, weight = part.astype(np.float64), weight.astype(np.float64)
            out += ((part * weight).T @ part).astype(np.int64).astype(object)
        else:
            out += (part.astype(object) * weight).T @ part.astype(object)
    return out


def _covariance(batches: Iterator[pa.RecordBatch], dims: int, centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The task's upper half of the sum of products of centred vectors, row by row."""
    out, some = np.zeros((dims, dims), object), False
    for batch in chunks(batches):
        out, some = out + _products(unpacked(batch.column(0), dims) - centre, _weights(batch)), some or batch.num_rows > 0
    if some:
        yield _sums_row(out[np.triu_indices(dims)].tolist())


def _square_sums(x: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """For each row the sum over dimensions of (n * x - rest) squared, null where that has no 64 bits."""
    top = n * int(np.abs(x).max(initial=0)) + max(map(abs, rest), default=0)
    if top * top * max(len(rest), 1) < 1 << 63:
        apart = n * x - np.array(rest, np.int64)
        return (apart * apart).sum(1).tolist()
    apart = n * x.astype(object) - np.array(rest, object)
    return [v if v < 1 << 63 else None for v in map(int, (apart * apart).sum(1))]


_WHITE = ["digest", "rows", "deviation", "whitened", "part", "sums"]


def _whitened(batches: Iterator[pa.RecordBatch], centre: np.ndarray, rest: list[int], n: int, axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each different vector along the scaled ``axes`` (columns); at the end the task's sums of them and of their products."""
    dims, k = axes.shape
    left = np.array([r / n for r in rest])
    sums = np.zeros(k + k * k)
    for batch in chunks(batches):
        x = unpacked(batch.column(0), dims) - centre
        z = (x - left) @ axes
        w = _weights(batch).astype(np.float64)[:, None]
        sums += np.concatenate([(z * w).sum(0), ((z * w).T @ z).ravel()])
        m = batch.num_rows
        own = [batch.column(2), batch.column(3), pa.array(_square_sums(x, n, rest), pa.int64()), pa.array(list(z), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays([*own, pa.nulls(m, pa.int32()), pa.nulls(m, pa.list_(pa.float64()))], _WHITE)
    nulls = [pa.nulls(1, t) for t in (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.float64()))]
    yield pa.RecordBatch.from_arrays([*nulls, pa.array([0], pa.int32()), pa.array([sums.tolist()], pa.list_(pa.float64()))], _WHITE)


def dimensions(vectors: DataFrame, vector_col: str) -> int:
    """The most frequent number of entries (of equally frequent ones the largest); 0 where there are no vectors."""
    sizes = vectors.select(F.size(F.col(f"`{vector_col}`")).alias("dims")).where("dims > 0")
    found = sizes.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    return found.dims if found else 0


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 4,
    scale: int = 256,
    by_count: bool = False,
) -> DataFrame:
    """One row for each vector: vec_id, n, deviation, whitened (one entry a component), explained (the same), identity_error.

    Vectors whose entries are all finite, and as many as most vectors have, take part, as x = floor(scale * entry). The fit counts each different x
    once, or, ``by_count``, as often as it occurs; n is the sum of these weights. ``deviation`` is the sum over dimensions of (n * x - S) squared, S being the weighted sum of x
    (null beyond 64 bits). ``identity_error`` is how far the covariance of the whitened fit list is from the identity at most. Components whose variance is
    0 up to rounding are left out; with none left the lists are empty. Each component's largest entry is positive. Rows that repeat, ids
    included, are rows of their own. Entries beyond 32 bits take no part. An empty table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    dims = dimensions(vectors, vector_col)
    id_field = T.StructField("vec_id", vectors.schema[id_col].dataType)
    columns = T.StructType([id_field, *T.StructType.fromDDL("n long, deviation long, whitened array<double>, explained array<double>, identity_error double")])
    if not dims:
        return spark.createDataFrame([], columns)
    given = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    schema = T.StructType([T.StructField("id", id_field.dataType), T.StructField("vector", T.BinaryType()), T.StructField("digest", T.BinaryType())])
    rows = kept(given.mapInArrow(partial(_digested, dims=dims, scale=scale), schema), "digested")
    weight = F.count("*") if by_count else F.lit(1).cast("long")
    groups = rows.groupBy("digest", "vector").agg(F.count("*").alias("rows"), weight.alias("weight"))
    groups = kept(groups.select("vector", "weight", "digest", "rows"), "different")

    totals = added_up(groups.select("vector", "weight").mapInArrow(partial(_totals, dims=dims), _SUMS), "part", "sums").get(0)
    if totals is None:
        return spark.createDataFrame([], columns)
    n, sums = totals[0], totals[1:]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]  # what is left of the sums when x is centred
    step = partial(_covariance, dims=dims, centre=np.array(centre, np.int64))
    upper = added_up(groups.select("vector", "weight").mapInArrow(step, _SUMS), "part", "sums")[0]
    covariance = np.zeros((dims, dims))
    for i, j, s in zip(*np.triu_indices(dims), upper):
        covariance[i, j] = covariance[j, i] = (n * s - rest[i] * rest[j]) / (n * n)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    values = values[: min(components, int((values > dims * np.finfo(float).eps * max(values[0], 0.0)).sum()))]
    axes = axes[:, : len(values)]
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(len(values))])

    step = partial(_whitened, centre=np.array(centre, np.int64), rest=rest, n=n, axes=axes / np.sqrt(values))
    white = kept(groups.mapInArrow(step, "digest binary, rows long, deviation long, whitened array<double>, part int, sums array<double>"), "whitened")
    k = len(values)
    error = None
    if k:
        found = np.array(added_up(white.select("part", "sums"), "part", "sums", exact=False)[0])
        mean = found[:k] / n
        error = float(np.abs(found[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())

    white = white.where("sums IS NULL").select("digest", "rows", "deviation", "whitened")
    frequent = F.col("rows") * FREQUENT > rows.count()
    heavy = F.broadcast(white.where(frequent))
    slim = rows.select(F.col("id").alias("vec_id"), "digest")
    joined = slim.join(heavy, "digest").unionByName(
        slim.join(heavy.select("digest"), "digest", "left_anti").join(white.where(~frequent), "digest")
    )
    explained = F.array(*[F.lit(float(v / np.trace(covariance))) for v in values]).cast("array<double>")
    return joined.select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).cast("double").alias("identity_error")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"))
    rows = found.select("*", F.posexplode("whitened").alias("at", "value"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("value").alias("whitened"),
        F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
    )
