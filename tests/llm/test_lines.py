"""Line de-duplication against the contract written out."""

import hashlib
import random

import pytest
from brute import LOWER
from pyspark.sql import functions as F

from tidemark.llm import line_dedup
from tidemark.llm.common import table

SPACES = " \t\n\x0b\x0c\r"


def by_hand(rows, least_chars=20, least_docs=3):
    """(doc_id, text) to the lines of each row that stay; None is the smallest id."""
    holders = {}
    key = lambda line: line.strip(SPACES).translate(LOWER)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    last = {k: max(d, key=lambda x: (x is not None, x or 0)) for k, d in holders.items() if len(k) >= least_chars and len(d) >= least_docs}
    return [[last.get(key(line), doc) == doc for line in (text or "").split("\n")] for doc, text in rows]


def expected(rows, **options):
    out = []
    for (doc, text), stays in zip(rows, by_hand(rows, **options)):
        left = "\n".join(line for line, on in zip((text or "").split("\n"), stays) if on)
        out.append((doc, len(stays), stays.count(False), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(docs, **options):
    rows = line_dedup.line_dedup(docs, **options)
    text = line_dedup.kept_text(F.col("text"), F.col("keep_runs"))
    rows = rows.select("doc_id", "n_lines", "n_dropped", F.sha2(text.cast("binary"), 256))
    return sorted(map(tuple, rows.collect()), key=repr)


@pytest.fixture(scope="module")
def lines():
    draw = random.Random(5)
    common = [f"this line is number {i} of the common ones" for i in range(12)]
    odd = ["", "  ", "short", "ÀÉ" * 10, "àé" * 10, "ÀÉ" * 9 + "À", "x" * 19, "X" * 20, "x" * 20 + "\r", "\tx" + "x" * 19 + " \x0b", "nul\x00" * 6, "\x1c" + "y" * 20, " " + "y" * 20, "y" * 20]
    rows = []
    for i in range(60):
        picked = [draw.choice(common).upper() if draw.random() < 0.3 else draw.choice(common + odd + [f"a line of document {i} alone {j}" for j in range(3)]) for _ in range(draw.randint(0, 25))]
        rows.append((i, "\n".join(picked)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "\n".join(common) + "\n"), (None, common[0]), (None, "\n".join([common[1], "own", common[1]]))]
    rows += [(200, rows[3][1]), (200, rows[3][1]), (200, "another text of the same id\n" + common[2]), (-5, "\n".join(common * 200)), (300, "z" * 200_000 + "\n" + common[5])]
    return rows


def test_against_brute_force(spark, lines):
    docs = spark.createDataFrame(lines, "doc_id long, text string").repartition(5)
    clashing = docs.select("*", *[F.lit("x").alias(c) for c in ("id", "mark", "pos", "high", "low", "docs", "keep", "keep_runs", "dropped", "line", "key", "nth")])
    assert found(clashing) == expected(lines)
    assert found(docs, least_chars=5, least_docs=2) == expected(lines, least_chars=5, least_docs=2)


def test_runs_are_the_bitmap(spark, lines):
    docs = spark.createDataFrame(lines[:60], "doc_id long, text string")
    got = {r.doc_id: r.keep_runs for r in line_dedup.line_dedup(docs).collect()}
    for (doc, _), stays in zip(lines[:60], by_hand(lines[:60])):
        runs = got[doc] or []
        flags = [i % 2 == 0 for i, n in enumerate(runs) for _ in range(n)]
        assert flags + [True] * (len(stays) - len(flags)) == stays and all(n > 0 for n in runs[1:])


@pytest.mark.parametrize("few", [True, False])
def test_paths_agree(spark, lines, monkeypatch, few):
    """Frequent keys or none, bitmaps by broadcast or by a shuffle: the same rows."""
    monkeypatch.setattr(line_dedup, "FREQUENT", 10**9 if few else 1)
    monkeypatch.setattr(line_dedup, "SMALL", 10**6 if few else -1)
    assert found(spark.createDataFrame(lines, "doc_id long, text string")) == expected(lines)


def test_a_key_in_all_documents_is_cut_over_tasks(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one line that all documents hold").alias("text"))
    lines = line_dedup._lines(line_dedup._marked(docs, "doc_id", "text"), 20)
    ranged = lines.repartitionByRange(4, "high", "low", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranged) == 4 and max(r["count"] for r in ranged) < 1500
    plan = line_dedup.repeated_keys(lines, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and plan.count("hashpartitioning") == 1
    assert sorted(r.n_dropped for r in line_dedup.line_dedup(docs).collect()) == [0] + [1] * 2999


def test_main_path_is_native(spark):
    from brute import SF

    plan = line_dedup.op13_line_dedup(spark, SF)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan and "Pandas" not in plan


def test_nothing(nothing):
    assert line_dedup.line_dedup(nothing).count() == 0


def test_odd_documents(documents, rows):
    pairs = [(doc, text) for doc, text, _ in rows]
    assert found(documents) == expected(pairs)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, line_dedup.op13_line_dedup(spark, "/root/testdata/sf0.01").collect()), key=repr) == expected(rows)
