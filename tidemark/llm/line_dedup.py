"""De-duplication of lines in DataFrame operations alone.

A line's key is the line without white space at both ends, A to Z in lower case; two 64-bit hashes with different seeds
stand for it. Hashes are range-partitioned together with the document, so that a key in very many documents is cut over
as many tasks as it needs, and sorted within by hash, document and position: each document's first occurrence is streamed off
the sorted rows, and what is left of a key in a task is one row. Keys in enough documents meet the lines
again: the frequent ones, of which there can only be ``FREQUENT``, are broadcast, all others go through a shuffle.

The result is not text: a document's lines are described by a bitmap of those that stay, as run lengths. ``kept_text`` applies it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SMALL, kept, table, text_of

#: A key in more than one in so many of all (line, document) pairs is frequent: there are no more of these than that.
FREQUENT = 16384
#: Dropped lines up to which the bitmaps of at most ``SMALL`` documents are sent to where the texts are: some 16 MB.
SMALL_LINES = 2_000_000
_SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["high", "low"]


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _lower(key: Column) -> Column:
    """A to Z in lower case and nothing else: of texts with one byte a character that is what ``lower`` does."""
    return F.when(F.octet_length(key) == F.length(key), F.lower(key)).otherwise(F.translate(key, _UPPER, _LOWER))


def _lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """The lines that may be dropped: id and mark of the document, place in it, hashes of the key."""
    lines = docs.select("id", "mark", F.posexplode(_split(F.col("text"))).alias("pos", "line"))
    keys = lines.select("id", "mark", "pos", F.btrim("line", F.lit(_SPACES)).alias("key"))
    keys = keys.where(F.length("key") >= least_chars).select("id", "mark", "pos", _lower(F.col("key")).alias("key"))
    return keys.select("id", "mark", "pos", F.xxhash64("key").alias("high"), F.xxhash64(F.lit(13), "key").alias("low"))


def repeated_keys(lines: DataFrame, least_docs: int) -> DataFrame:
    """The keys in ``least_docs`` documents or more: their hashes, the documents that hold them, the largest id of these."""
    ranged = lines.select(*_HASH, "id", "pos").repartitionByRange(*_HASH, "id")
    # the ranges keep a key's rows of one document together, so the window needs no further exchange
    first = F.row_number().over(Window.partitionBy(*_HASH, "id").orderBy("pos"))
    streamed = ranged.withColumn("nth", first).where("nth = 1")
    return streamed.groupBy(*_HASH).agg(F.count("*").alias("docs"), F.max("id").alias("keep")).where(F.col("docs") >= least_docs)


def _runs(dropped: Column) -> Column:
    """Sorted places of dropped lines as lengths of runs, kept and dropped in turn. ``dropped`` is a column as it was
    written down, since the functions below look into it once for each place."""
    begins = F.filter(dropped, lambda x, i: (i == 0) | (F.get(dropped, i - 1) != x - 1))
    ends = F.filter(dropped, lambda x, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != x + 1))
    before = F.concat(F.array(F.lit(-1)), F.slice(ends, F.lit(1), F.size(ends) - 1))
    runs = F.arrays_zip(begins.alias("a"), ends.alias("b"), before.alias("c"))
    return F.flatten(F.transform(runs, lambda r: F.array(r["a"] - r["c"] - 1, r["b"] - r["a"] + 1)))


def kept_text(text: Column, runs: Column) -> Column:
    """The lines of ``text`` that the bitmap ``runs`` keeps; all of them where it is null."""
    flags = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    lines = F.filter(F.arrays_zip(_split(text).alias("line"), flags.alias("stays")), lambda x: F.coalesce(x["stays"], F.lit(True)))
    return F.when(runs.isNull(), text).otherwise(F.array_join(F.transform(lines, lambda x: x["line"]), "\n"))


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 20, least_docs: int = 3
) -> DataFrame:
    """The documents that lose lines: id, mark, dropped (sorted places of the lines, from 0), keep_runs.

    ``keep_runs`` is the bitmap of the lines that stay: the lengths of runs of kept and dropped lines in turn, first the kept ones
    (0 where the first line goes); lines behind the last run stay. ``mark`` is a hash of the text, by which rows that share an id are told apart.
    Keys of at least ``least_chars`` code points in ``least_docs`` documents or more lose all their lines except those of the
    largest id holding them. Rows with the same id count as one document, so do all rows without an id, which ranks
    below all others. A null text is one empty line. An empty table gives no rows.
    """
    lines = kept(_lines(_marked(docs, id_col, text_col), least_chars), "lines")
    keys = kept(repeated_keys(lines, least_docs), "keys")
    frequent = F.col("docs") * FREQUENT >= lines.count()
    heavy = F.broadcast(keys.where(frequent))
    lost = ~F.col("id").eqNullSafe(F.col("keep"))
    gone = lines.join(heavy, _HASH).where(lost).select("id", "mark", "pos")
    light = lines.join(heavy.select(*_HASH), _HASH, "left_anti").join(keys.where(~frequent), _HASH)
    gone = gone.unionByName(light.where(lost).select("id", "mark", "pos"))
    places = kept(gone.groupBy("id", "mark").agg(F.sort_array(F.collect_set("pos")).alias("dropped")), "dropped")
    return places.withColumn("keep_runs", _runs(F.col("dropped")))


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text, n_lines, n_dropped, keep_runs (null: all lines stay); see ``keep_bitmaps``.

    Other columns of ``docs``, whatever their names, are not read. Rows that repeat wholly get the same bitmap.
    """
    bitmaps = keep_bitmaps(docs, id_col, text_col, **options)
    rows, lines = bitmaps.agg(F.count("*"), F.coalesce(F.sum(F.size("dropped")), F.lit(0))).first()
    few = rows <= SMALL and lines <= SMALL_LINES
    right = bitmaps.select(F.col("id").alias("of"), F.col("mark").alias("of_mark"), F.size("dropped").alias("gone"), "keep_runs")
    right = F.broadcast(right) if few else right
    marked = _marked(docs, id_col, text_col)
    joined = marked.join(right, marked["id"].eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark")), "left")
    return joined.select(
        F.col("id").alias("doc_id"),
        "text",
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("gone", F.lit(0)).cast("long").alias("n_dropped"),
        "keep_runs",
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"))
    digest = F.sha2(kept_text(F.col("text"), F.col("keep_runs")).cast("binary"), 256)
    return found.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), g AS (
  SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (keep IS NOT NULL AND k.doc_id <> keep) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keep IS NULL OR k.doc_id = keep), '')) AS kept_sha256
FROM k LEFT JOIN g ON k.key = g.key GROUP BY r, k.doc_id
"""
