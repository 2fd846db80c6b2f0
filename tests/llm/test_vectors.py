"""Clustering and whitening against the contracts written out."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from brute import SF
from pyspark.sql import functions as F

from tidemark.llm import centroids, whitening

CLASH = ("id", "vector", "digest", "sums", "part", "near", "second", "upper", "lower", "distance", "cluster", "rows", "weight", "n", "whitened", "at", "value")


def with_clashes(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH])


def clusters(rows, dims=64, k=8, rounds=10):
    """(vec_id, vector) to rows of the result, comparing everything in Python's whole numbers."""
    kept = [(i, [math.floor(1024 * e) for e in v]) for i, v in rows if v is not None and len(v) == dims and all(e is not None and math.isfinite(e) for e in v)]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (name(r[0]), np.array(r[1], np.int32).tobytes()))[:k]
    middle = [v for _, v in first]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for n in range(rounds + 1):
        found = [min((square(v, c), j) for j, c in enumerate(middle)) for _, v in kept]
        if n < rounds:
            for j in range(len(middle)):
                own = [v for (_, v), (_, c) in zip(kept, found) if c == j]
                if own:
                    middle[j] = [sum(e) // len(own) for e in zip(*own)]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    sums = [sum(d for d, c in found if c == j) for j in range(len(middle))]
    return sorted(((i, c, d, sums[c], sum(sums), names[c]) for (i, _), (d, c) in zip(kept, found)), key=repr)


def of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def odd_vectors(dims, n=150):
    draw = np.random.default_rng(4)
    rows = [(i, (draw.normal(size=dims) + 3 * (i % 5)).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [rows[9], rows[9], (None, rows[3][1]), (None, None)]
    rows += [(2000, None), (2001, []), (2002, rows[0][1][:-1]), (2003, rows[0][1] + [0.0]), (2004, [None] * dims), (2005, [math.nan] + rows[0][1][1:])]
    return rows + [(2006, rows[0][1][1:] + [math.inf]), (2007, [-0.0] * dims), (2008, [0.0] * dims), (2009, [1e30] * dims), (2010, [-1e-9] * dims)]


def test_clusters_of_the_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert of(centroids.op11_shallot(spark, SF)) == clusters([(r.vec_id, r.embedding) for r in rows])


@pytest.mark.parametrize("k,rounds", [(1, 2), (13, 5)])
def test_clusters_of_odd_vectors(spark, k, rounds):
    rows = odd_vectors(4)
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    assert of(centroids.cluster(df, dims=4, k=k, rounds=rounds)) == clusters([r for r in rows if r[0] != 2009], 4, k, rounds)


def test_ties_and_too_few_vectors(spark):
    grid = [(i, [float(i % 7), float(i // 7 % 7)]) for i in range(49)] + [(100 + i, [float(i % 3) * 3, 3.0]) for i in range(30)]
    df = spark.createDataFrame(grid, "vec_id long, embedding array<float>")
    assert of(centroids.cluster(df, dims=2, rounds=4)) == clusters(grid, 2, rounds=4)
    for n in (1, 2, 3):
        some = df.where(F.col("vec_id") < n)
        assert of(centroids.cluster(some, dims=2, rounds=2)) == clusters(grid[:n], 2, rounds=2)


def test_bounds_spare_distances(spark):
    draw = np.random.default_rng(1)
    rows = [(i, (draw.normal(size=8) * 0.1 + np.eye(8)[i % 8] * 5).tolist()) for i in range(2000)]
    work = []
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert of(centroids.cluster(df, dims=8, report=work)) == clusters(rows, 8)
    assert len(work) == 11 and sum(work) < 0.5 * 11 * 8 * len(rows) and work[-1] < len(rows)


def check_whitening(got, rows, by_count=False, components=4):
    """Everything exact in fractions but for the axes, which have to be unit eigenvectors."""
    sizes = [len(v) for _, v in rows if v]
    most = max(set(sizes), key=lambda n: (sizes.count(n), n))
    fits = lambda v: v is not None and len(v) == most and all(e is not None and math.isfinite(e) and abs(256 * e) < 2**31 for e in v)
    kept = [(i, tuple(math.floor(256 * e) for e in v)) for i, v in rows if fits(v)]
    fit = [x for _, x in kept] if by_count else sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    cov = [[Fraction(n * sum(x[i] * x[j] for x in fit) - sums[i] * sums[j], n * n) for j in range(most)] for i in range(most)]
    values, axes = np.linalg.eigh(np.array(cov, float))
    k = min(components, sum(values > 1e-9 * max(values[-1], 0)))
    got = sorted(got, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation or 0))
    square = lambda x: sum((n * a - s) ** 2 for a, s in zip(x, sums))
    deviation = lambda x: square(x) if square(x) < 2**63 else None
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, deviation(r[1]) or 0))
    assert [(r.vec_id, r.n, r.deviation) for r in got] == [(i, n, deviation(x)) for i, x in kept]
    white = np.array([r.whitened for r in got]).reshape(len(got), k)
    want = (np.array([x for _, x in kept]) - np.array([float(Fraction(s, n)) for s in sums])) @ axes[:, ::-1][:, :k] / np.sqrt(values[::-1][:k])
    assert np.allclose(white * np.sign((white * want).sum(0)), want, atol=1e-7)
    for r in got[:3]:
        assert np.allclose(r.explained, values[::-1][:k] / np.trace(np.array(cov, float)), rtol=1e-9) and r.identity_error < 1e-9


@pytest.mark.parametrize("by_count", [False, True])
def test_whitening_of_odd_vectors(spark, by_count):
    rows = odd_vectors(6)
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    check_whitening(whitening.whiten(df, by_count=by_count).collect(), rows, by_count)


def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = whitening.op12_whitening(spark, SF).collect()
    assert len(found) == 4 * len(rows) and {r.component for r in found} == {1, 2, 3, 4}
    check_whitening(whitening.whiten(spark.read.parquet(f"{SF}/embeddings.parquet")).collect(), rows)
    whole = {r.vec_id: r for r in whitening.whiten(spark.read.parquet(f"{SF}/embeddings.parquet")).collect()}
    for r in found[:50]:
        w = whole[r.vec_id]
        assert (r.n, r.deviation, r.explained) == (w.n, w.deviation, w.explained[r.component - 1]) and r.whitened == pytest.approx(w.whitened[r.component - 1], abs=1e-12)


def test_large_entries_stay_exact(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [4e6 + float(a), -8e6 + float(b), 1000 * float(c)]) for i, (a, b, c) in enumerate(draw.normal(size=(40, 3)))]
    rows += [(100 + i, [7e6 * s, 1.0, 2.0]) for i, s in enumerate((1, -1))]
    check_whitening(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), rows)
    x = np.array([[2**30, 1], [-(2**30), 5], [3, 2**26]], np.int64)
    w = np.array([3, 1, 2], np.int64)
    assert (whitening._products(x, w) == (x.astype(object) * w[:, None]).T @ x.astype(object)).all()


def test_components_without_variance(spark):
    rows = [(i, [float(i % 4), 2.0 * (i % 4), 1.0]) for i in range(12)] + [(50, [0.0, 0.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert all(len(r.whitened) == 1 and r.explained == pytest.approx([1.0]) for r in got) and len(got) == 13
    one = spark.createDataFrame([(1, [1.0, 2.0])] * 2, "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.identity_error) for r in whitening.whiten(one).collect()] == [(1, 1, 0, [], None)] * 2


def test_paths_agree(spark, monkeypatch):
    rows = odd_vectors(6)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(whitening, "FREQUENT", 3)
    check_whitening(whitening.whiten(df).collect(), rows)


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<float>")
    for some in (df, df.where("false")):
        assert centroids.cluster(some).count() == 0 and whitening.whiten(some).count() == 0
