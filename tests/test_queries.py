"""Every query against the SQL it has to agree with, run by DuckDB on the same files."""

import duckdb
import pytest

import __spark_entry__ as repo
from tidemark.plans import ORACLES as PLAN_ORACLES
from tidemark.plans import QUERIES as PLANS

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = {name: repo.queries()[name] for name in PLANS}, PLAN_ORACLES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in ("orders", "lineitem", "events", "documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(PLANS) == set(PLAN_ORACLES)


def test_entry(spark):
    df = repo.entry(spark)
    assert df.columns == ["window_start", "window_end", "vehicleType", "count"] and df.count() > 0


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    got = QUERIES[name](spark, SF)
    want = db.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert canonical(got.columns, map(tuple, got.collect())) == canonical(columns, want.fetchall())


def test_filters_of_rides_reach_the_scan(spark, conf):
    conf("spark.sql.maxMetadataStringLength", "2000")
    plan = QUERIES["ride_districts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_linestatus,F)" in plan


def test_shuffled_neighbourhoods_broadcast_nothing(spark):
    plan = QUERIES["neighbourhoods_shuffled"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
