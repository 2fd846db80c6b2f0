import numpy as np
import pytest
from brute import SF

from tidemark.llm import hilbert


def exact(rows, k, every):
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    most = max({len(v) for v in usable.values()}, key=lambda n: sum(len(v) == n for v in usable.values()))
    usable = {i: v for i, v in usable.items() if len(v) == most}
    ids = np.array(sorted(usable))
    whole = np.array([usable[i] for i in ids])
    out = {}
    for q in ids[ids % every == 0]:
        scores = (whole * usable[q]).sum(1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) / sum(map(len, want.values()))


def test_curve_takes_single_steps():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = hilbert.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1).max() == 1


def test_recall_on_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = exact([(r.vec_id, r.embedding) for r in df.collect()], 20, 20)
    assert recall(found(hilbert.search(df)), want) >= 0.9


def test_windows_of_clustered_vectors(spark):
    """Many blocks and few of them looked at."""
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((30, 8)) * 4
    rows = [(i, (centres[i % 30] + 0.1 * draw.standard_normal(8)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(found(hilbert.search(df, k=10, block=256)), exact(rows, 10, 20)) >= 0.9


def test_queries_are_dealt_out(spark, monkeypatch):
    """Blocks that many queries look into are compared in several tasks, with the same result."""
    draw = np.random.default_rng(4)
    rows = [(i, draw.standard_normal(6).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    once = found(hilbert.search(df, k=5, every=3, block=128))
    monkeypatch.setattr(hilbert, "LOOKING", 16)
    assert found(hilbert.search(df, k=5, every=3, block=128)) == once and len(once) == 200


def test_ties_copies_and_unusable_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(60)] + [(100, [0.0, 0.0]), (120, None), (140, [1.0, None]), (160, [float("nan"), 1.0]), (180, [float("inf"), 1.0]), (200, [1.0]), (None, [1.0, 1.0]), (61, [3.0, 1.0]), (20, [1.0, 2.0]), (62, [-1.0, 0.5])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, block string, key int")
    assert found(hilbert.search(df, k=5)) == exact(rows, 5, 20)
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert found(hilbert.search(few, k=5)) == {0: [(1, 5.0), (2, 5.0)]}


@pytest.mark.parametrize("keep", ["false", "vec_id IN (100, 120, 200)"])
def test_nothing_to_find(spark, keep):
    rows = [(100, [0.0, 0.0]), (120, None), (200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").where(keep)
    assert hilbert.search(df).count() == 0
