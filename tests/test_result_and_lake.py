"""Results kept up to date by deltas, and the lake with commits and compaction."""

import datetime as dt
import os
import random

import pytest

from tidemark.operators import count_by
from tidemark.streaming import await_query, read_compacted_lake, read_result, run_to_result, to_compacted_lake
from tidemark.streaming.result_table import _Folder

SCHEMA = "id long, ts timestamp, kind string"
START = dt.datetime(2021, 5, 3)


def rows(n, seed=1, days=6):
    draw = random.Random(seed)
    return [(i, START + dt.timedelta(minutes=draw.randint(0, days * 1440 - 1)), draw.choice("abcde")) for i in range(n)]


def stream(spark, path, parts):
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def counted(some):
    return sorted((k, sum(r[2] == k for r in some)) for k in {r[2] for r in some})


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.startswith("part-"))


def test_result_of_many_batches(spark, tmp_path):
    """Deltas alone, then merged; a second run goes on."""
    whole, out = rows(120), str(tmp_path / "out")
    parts = [whole[i : i + 20] for i in range(0, 120, 20)]
    for some, seen in ((parts[:4], whole[:80]), (parts[4:], whole)):
        df = count_by(stream(spark, str(tmp_path / "in"), some), ["kind"])
        assert sorted(map(tuple, run_to_result(df, ["kind"], out, merge_every=2).collect())) == counted(seen)
    versions = _Folder(spark, f"{out}/versions")
    assert versions.numbers() == [3, 4, 5] and len(versions.read(5)["parts"]) <= 2
    assert len(os.listdir(f"{out}/base")) <= 2 and len(os.listdir(f"{out}/delta")) <= 3


def test_bytes_written_follow_the_change(spark, tmp_path):
    """The first batch brings 5,000 groups, the others one row each: their deltas are small."""
    parts = [[(i, START, f"group {i}") for i in range(5000)], [(1, START, "group 1")], [(2, START, "new")]]
    out = str(tmp_path / "out")
    got = run_to_result(count_by(stream(spark, str(tmp_path / "in"), parts), ["kind"]), ["kind"], out)
    assert {r.kind: r["count"] for r in got.where("kind IN ('group 1', 'new', 'group 7')").collect()} == {"group 1": 2, "new": 1, "group 7": 1}
    assert got.count() == 5001 and size(f"{out}/delta/1") < size(f"{out}/delta/0") / 5


def test_a_batch_half_written_is_not_seen(spark, tmp_path):
    out = str(tmp_path / "out")
    df = count_by(stream(spark, str(tmp_path / "in"), [rows(30)]), ["kind"])
    run_to_result(df, ["kind"], out)
    spark.createDataFrame([("a", 1000)], df.schema).write.parquet(f"{out}/delta/1")  # a delta without its version
    assert sorted(map(tuple, read_result(spark, df.schema, out, ["kind"]).collect())) == counted(rows(30))


def test_no_result_yet(spark, tmp_path):
    assert read_result(spark, spark.createDataFrame([], SCHEMA).schema, str(tmp_path / "none"), ["id"]).count() == 0


def run(spark, tmp_path, parts, **how):
    df = stream(spark, str(tmp_path / "in"), parts)
    await_query(to_compacted_lake(df, str(tmp_path / "lake"), str(tmp_path / "checkpoint"), "ts", available_now=True, **how))
    return df.schema


def lake(spark, schema, tmp_path, *days):
    return sorted(map(tuple, read_compacted_lake(spark, schema, str(tmp_path / "lake"), *days).collect()), key=repr)


def test_lake_of_many_batches(spark, tmp_path):
    whole = sorted(rows(200), key=lambda r: r[1]) + [(900, None, "a"), (901, START, "late")]
    parts = [whole[i : i + 34] for i in range(0, 202, 34)]
    schema = run(spark, tmp_path, parts)
    assert lake(spark, schema, tmp_path) == sorted(whole, key=repr)
    some = [r for r in whole if r[1] is not None and "2021-05-04" <= str(r[1])[:10] <= "2021-05-06"]
    assert lake(spark, schema, tmp_path, "2021-05-04", "2021-05-06") == sorted(some, key=repr)
    commits = _Folder(spark, str(tmp_path / "lake" / "commits"))
    parts = commits.read(commits.numbers()[-1])["parts"]
    closed = [p["day"] for p in parts if p["day"] is not None and p["day"] <= "2021-05-06"]
    assert len(closed) == len(set(closed)) and sum(p["rows"] for p in parts) == 202


def test_files_of_a_day_are_bounded_and_old_ones_go(spark, tmp_path):
    """Twelve batches for one open day."""
    parts = [[(10 * i + j, START + dt.timedelta(minutes=10 * i + j), "a") for j in range(5)] for i in range(12)]
    schema = run(spark, tmp_path, parts, most_parts=3)
    files = [os.path.join(d, f) for d, _, names in os.walk(tmp_path / "lake" / "data") for f in names if f.startswith("part-")]
    commits = _Folder(spark, str(tmp_path / "lake" / "commits"))
    assert len(lake(spark, schema, tmp_path)) == 60 and len(commits.read(11)["parts"]) <= 3 and len(files) <= 10


def test_a_batch_that_is_run_again_adds_nothing(spark, tmp_path):
    whole = rows(60)
    schema = run(spark, tmp_path, [whole[:30], whole[30:]])
    os.remove(tmp_path / "checkpoint" / "commits" / "1")  # as if the query had failed after the lake's commit
    crc = tmp_path / "checkpoint" / "commits" / ".1.crc"
    if crc.exists():
        os.remove(crc)
    run(spark, tmp_path, [])
    assert lake(spark, schema, tmp_path) == sorted(whole, key=repr)


def test_a_large_day_goes_to_several_files(spark, tmp_path):
    run(spark, tmp_path, [rows(100, days=1)], rows_per_file=20)
    files = [f for d, _, names in os.walk(tmp_path / "lake" / "data") for f in names if f.startswith("part-")]
    assert 5 <= len(files) <= 9


def test_an_empty_lake(spark, tmp_path):
    schema = run(spark, tmp_path, [[]])
    assert lake(spark, schema, tmp_path) == []
    with pytest.raises(ValueError):
        to_compacted_lake(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), "x", "y", close_after="soon")
