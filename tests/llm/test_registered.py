"""The registered queries on the smallest tables, against SQL where there is some, and the pipeline stage by stage."""

import os

import brute
import duckdb
import numpy as np
import pytest
from brute import SF

import corpus_pipeline
from tidemark.llm import ORACLES, QUERIES, exact_dedup, mixing, packing, toxicity


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, db, name):
    want = db.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(map(repr, want.fetchall()))


def test_there_is_a_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline(spark, documents):
    """Each stage on all its predecessor kept, against the contracts written out."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    rows = lambda df: sorted(map(repr, (tuple(r) for r in df.select(columns).collect())))
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted}
    out = docs
    for name, stage in corpus_pipeline.STAGES:
        before, out = out, stage(spark, out, SF)
        held = sorted(before.select("doc_id", "text").collect(), key=lambda r: r.doc_id)
        if name == "toxicity":
            want = before.where(~before.doc_id.isin(list(toxic)) if toxic else "true")
        elif name == "exact_dedup":
            _, groups = brute.exact([tuple(r) for r in held])
            stay = [held[min(g, key=lambda i: (-len(held[i].text), held[i].doc_id))].doc_id for g in groups.values()]
            want = before.where(before.doc_id.isin(stay))
        elif name == "near_dedup":
            _, component = brute.near([r.text for r in held], percent=80)
            want = before.where(before.doc_id.isin([held[i].doc_id for i in set(component)]))
        elif name == "mixing":
            db = duckdb.connect()
            db.register("documents", before.toArrow())
            copies = {d: t // s if s else 0 for d, s, t in db.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE})").fetchall()}
            whole = {r.doc_id: tuple(r) for r in before.select(columns).collect()}
            assert rows(out) == sorted(repr(whole[d]) for d, n in copies.items() for _ in range(n))
            want = None
        else:
            pieces = out.collect()
            ids = packing.tokenize([r.text for r in held], packing.default_tokenizer())
            assert sum(r.length for r in pieces) == sum(len(i) // 4 for i in ids)
            filled = np.bincount([r.sequence_id for r in pieces], weights=[r.length for r in pieces])
            assert filled.max() <= packing.CAPACITY and len(filled) <= filled.sum() // packing.CAPACITY + 2
            want = None
        if want is not None:
            assert out.columns == columns and rows(out) == rows(want)


def test_pipeline_on_odd_documents(spark, documents, nothing, tmp_path):
    for docs, empty in ((documents, False), (nothing, True)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == documents.columns
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0) == empty


def test_exact_dedup_keeps_one_of_repeated_rows(spark, documents):
    kept = exact_dedup.without_copies(documents).collect()
    assert sum(r.text == "one" for r in kept) == 1 and kept[0].asDict().keys() == set(documents.columns)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0 and corpus_pipeline.ORACLE_SQL is None and os.path.isdir(SF)
