"""Exact de-duplication with a split of heavy hitters.

Each row is reduced to the digest of its text without white space. Misra-Gries summaries, one for each task, name the
digests that may be frequent; their rows are counted exactly, and the winners (at most ``counters`` + 1 rows, whatever
the size of the table) are broadcast, so that frequent copies are decided where they are read. All other digests
have few copies and go through an ordinary shuffle of slim rows; texts are never shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, SPACE, kept, numbered, table, text_of, without


def frequent(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries: of n rows, at most ``counters`` values, with every one of more than n / (counters + 1) rows among
    them, and counts that are too low by n / (counters + 1) at most."""
    held: Counter[str] = Counter()
    for batch in batches:
        held.update(Counter(batch.column(0).to_pylist()))
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = Counter({k: n - cut for k, n in held.items() if n > cut})
    yield pa.RecordBatch.from_pydict({"digest": pa.array(list(held), pa.string()), "low": pa.array(list(held.values()), pa.int64())})


def _order() -> Column:
    """First is the row that stays: most code points, then smallest id (no id last), then place in the table."""
    return F.struct(-F.col("code_points"), F.col("id").isNull(), "id", "row")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 1024, row_col: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, row.

    ``row`` is ``row_col``, which then has to be unique, or else a number of the row. A null text counts as empty, and empty texts (or of white space only) are copies of one another. Rows that repeat
    wholly, the id included, are copies too and exactly one of them is kept. A null id ranks after all others and is
    given back as null. Other columns of ``docs``, whatever their names, are not read. An empty table gives no rows.
    """
    text = text_of(text_col)
    slim = kept(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.sha2(F.regexp_replace(text, f"{SPACE}+", "").cast("binary"), 256).alias("digest"),
            F.length(text).cast("long").alias("code_points"),
            (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        ),
        "digests",
    )
    rows = slim.count()
    candidates = (
        slim.select("digest")
        .mapInArrow(partial(frequent, counters=counters), "digest string, low long")
        .groupBy("digest")
        .agg(F.sum("low").alias("low"))
        .where((F.col("low") > 1) & (F.col("low") >= rows / (counters + 1)))  # these sum to no more than all rows
        .select("digest")
    )
    candidates = kept(candidates, "frequent")
    winners = (
        slim.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.min(_order()).alias("first"))
        .select("digest", "group_size", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"))
    )
    winners = kept(winners, "winners")
    heavy = slim.join(F.broadcast(winners), "digest")
    copies = Window.partitionBy("digest")
    first = F.min(_order()).over(copies)
    light = (
        slim.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumns({"group_size": F.count("*").over(copies), "first": first})
        .withColumns({"keep_id": F.col("first.id"), "keep_row": F.col("first.row")})
    )
    columns = [
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "row",
    ]
    return heavy.select(*columns).unionByName(light.select(*columns))


def without_copies(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are."""
    rows = numbered(docs)
    return without(rows, exact_dedup(rows, row_col=ROW, **columns).where("NOT kept").select(F.col("row").alias(ROW)))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("row")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
