import duckdb
import pytest

from tidemark.llm import mixing


@pytest.fixture(scope="module")
def mixed(documents):
    return mixing.mix(documents).select("doc_id", "source", "_size", "_source_size", "_target", "_copies").collect()


def test_against_sql(documents, mixed):
    table = documents.where("doc_id IS NOT NULL").select("doc_id", "source", "text").toArrow()  # noqa: F841
    db = duckdb.connect()
    db.register("documents", documents.select("doc_id", "source", "text").toArrow())
    want = db.execute(mixing.ORACLE.replace("doc_id::VARCHAR", "coalesce(doc_id::VARCHAR, '')")).fetchall()
    got = [(r.doc_id, r._size, r._source_size, r._target, r._copies * r._size) for r in mixed]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_targets_by_resharing(mixed):
    sizes = {}
    for r in mixed:
        sizes[r.source] = sizes.get(r.source, 0) + r._size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    target |= share
    for r in mixed:
        assert r._target == pytest.approx(target[r.source]) and 0 <= r._copies <= 2
    for s in names:
        taken = sum(r._copies * r._size for r in mixed if r.source == s)
        assert abs(taken - target[s]) <= max(r._size for r in mixed if r.source == s)


def test_repeated_rows_of_the_mix(documents, mixed):
    rows = mixing.repeated(mixing.mix(documents))
    assert rows.columns == documents.columns and rows.count() == sum(r._copies for r in mixed)


def test_reruns_agree(documents, mixed):
    again = mixing.mix(documents.repartition(7)).select("doc_id", "source", "_size", "_copies").collect()
    assert sorted((repr(r.doc_id), r._size, r._copies) for r in again) == sorted((repr(r.doc_id), r._size, r._copies) for r in mixed)


def test_nothing(nothing):
    assert mixing.mix(nothing).count() == 0
