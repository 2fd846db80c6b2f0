"""Mixing of sources to target weights by systematic sampling, in DataFrame operations alone.

Within a source every row is expected ``rate`` = target / size times, so the prefix sum of what is expected is the
row's rank times the rate. One offset in [0, 1) for each source is added; a row is taken once for every integer that
its own step of the sum crosses. Rows are ranked by size, so that small and large ones are taken alike.

A source may hold a third of all rows. Ranks are therefore counted in blocks, a class of sizes in a source dealt over
as many blocks as it has multiples of ``BLOCK`` rows, and each block starts where those before it end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, kept, table, text_of

#: Rows of a block, about.
BLOCK = 500


def _hash48(text: Column) -> Column:
    """A number of 48 bits out of a text, the same in every engine."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long")


def _size_class() -> Column:
    """Number of digits and leading digit: sizes of a class are within a factor of two."""
    digits = F.col("_size").cast("string")
    return (F.length(digits) * 10 + F.substring(digits, 1, 1).cast("int")).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """One row for each source (_no_source, _source, _source_size) gets its ``_target``.

    Sources by code point, null last, take the weights in turn. Targets are weight times one level, cut at
    ``cap`` times the source's size. Sources whose cap is lowest for their weight reach it first, so ordered that
    way the level is what is left over the weight that is left, at the first source that stays below its cap.
    """
    named = Window.orderBy("_no_source", "_source")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = Window.orderBy(F.col("_cap") / F.col("_weight"), "_no_source", "_source")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    which = F.element_at(F.array(*map(F.lit, weights)), (F.col("_n") % len(weights) + 1).cast("int"))
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.col("_weights") - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    )
    return (
        sizes.withColumn("_n", F.row_number().over(named) - 1)
        .withColumns({"_weight": which, "_cap": F.lit(float(cap)) * F.col("_source_size")})
        .withColumns({"_total": F.lit(float(share)) * F.sum("_source_size").over(everything), "_weights": F.sum("_weight").over(everything)})
        .withColumn("_level", level)
        .withColumn("_open", F.when(F.col("_cap") > F.col("_weight") * F.col("_level"), F.col("_level")))
        .withColumn("_level", F.max("_open").over(everything))
        .withColumn("_target", F.least("_cap", F.coalesce(F.col("_weight") * F.col("_level"), F.col("_cap"))))
        .select("_no_source", "_source", "_source_size", "_target")
    )


def mix(
    docs: DataFrame,
    size: Column | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """The rows of ``docs`` with all their columns, and _size, _source_size, _target and _copies, how often the mix takes
    the row (0 to ``cap``, rounded up).

    Size is the number of words, or ``size``; a null text has none. A null source is a source of its own, the last.
    Rows of one size are ranked by id, rows of one id by their place in the block; rows that repeat are rows of
    their own. Columns of ``docs`` may have any names that do not start with an underscore. A source without words
    has the target 0 and its rows are taken by rate 1. An empty table gives no rows.
    """
    size = F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long") if size is None else size
    sized = docs.withColumns(
        {
            "_size": size,
            "_no_source": F.col(f"`{source_col}`").isNull(),
            "_source": F.coalesce(F.col(f"`{source_col}`"), F.lit("")),
            "_id": F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")),
        }
    ).withColumn("_class", _size_class())
    source = ["_no_source", "_source"]
    classes = kept(sized.groupBy(*source, "_class").agg(F.count("*").alias("_rows"), F.sum("_size").alias("_words")), "sizes")
    of_source = targets(classes.groupBy(*source).agg(F.sum("_words").alias("_source_size")), weights, share, cap)
    spread = classes.select(*source, "_class", F.ceil(F.col("_rows") / BLOCK).alias("_blocks"))
    # one row for each block, known before any row is ranked: which block a row falls in is a matter of its id
    dealt = sized.join(spread, [*source, "_class"]).withColumn("_block", _hash48(F.col("_id")) % F.col("_blocks"))
    block = [*source, "_class", "_block"]
    before = Window.partitionBy(*source).orderBy("_class", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sized.select(*source, "_class", "_id")
        .join(spread, [*source, "_class"])
        .withColumn("_block", _hash48(F.col("_id")) % F.col("_blocks"))
        .groupBy(*block)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .join(of_source, source)
        .withColumn("_rate", F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(1.0)))
        .withColumn("_offset", _hash48(F.concat(F.lit(f"{seed}/"), F.when(F.col("_no_source"), "null").otherwise(F.concat(F.lit("="), "_source")))) / F.lit(float(2**48)))
        .select(*block, "_start", "_source_size", "_target", "_rate", "_offset")
    )
    rank = F.row_number().over(Window.partitionBy(*block).orderBy("_size", "_id"))
    steps = F.col("_start") + F.col("_rank")
    crossed = F.floor(steps * F.col("_rate") + F.col("_offset")) - F.floor((steps - 1) * F.col("_rate") + F.col("_offset"))
    return (
        dealt.withColumn("_rank", rank)
        .join(starts, block)
        .withColumn("_copies", crossed.cast("long"))
        .select(*[F.col(f"`{c}`") for c in docs.columns], "_size", "_source_size", "_target", "_copies")
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken."""
    columns = [c for c in mixed.columns if c not in ("_size", "_source_size", "_target", "_copies")]
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))
    return mixed.where("_copies > 0").withColumn("_copy", copies).select(*[F.col(f"`{c}`") for c in columns])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.regexp_count(text_of("text"), F.lit(WORD)).cast("long").alias("n")
    slim = kept(table(spark, sf_dir, "documents").select("doc_id", "source", words), "sizes")
    return mix(slim, size=F.col("n")).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents
), k AS (
  SELECT *, (length(size::VARCHAR) * 10 + left(size::VARCHAR, 1)::INT) AS class FROM d
), b AS (
  SELECT *, (('0x' || left(md5(doc_id::VARCHAR), 12))::BIGINT
    % ceil(count(*) OVER (PARTITION BY source, class) / {BLOCK}.0)::BIGINT) AS block FROM k
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, block, size, doc_id::VARCHAR) AS i FROM b
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::BIGINT AS cap,
    ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM s
), m AS (
  SELECT *, max(CASE WHEN cap > weight * level THEN level END) OVER () AS last_level FROM l
), t AS (
  SELECT source, source_size, least(cap, coalesce(weight * last_level, cap)) AS target,
    ('0x' || left(md5('mix/' || CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END), 12))::BIGINT / 281474976710656.0::DOUBLE AS shift
  FROM m
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 1.0 END AS rate FROM t
)
SELECT doc_id, size, source_size, target,
  ((floor(i * rate + shift) - floor((i - 1) * rate + shift))::BIGINT * size) AS taken
FROM ranked JOIN r ON ranked.source IS NOT DISTINCT FROM r.source
"""
