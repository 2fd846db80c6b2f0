"""Sessions of a table: runs of a key's events, ended by a flag or by a gap."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.checkpoints import checkpointed
from tidemark.functions.intervals import interval_micros

# A key with more rows than this does not fit one task well.
MAX_ROWS_PER_TASK = 5_000_000


def _starts(ts: Column, flag: Column, prev_ts: Column, prev_flag: Column, gap: str) -> Column:
    apart = F.unix_micros(ts) - F.unix_micros(prev_ts) > interval_micros(gap)
    return prev_ts.isNull() | apart | F.coalesce(prev_flag, F.lit(False))


def _so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _number_plain(df: DataFrame, key: str, ts: str, tiebreak: Sequence[str], gap: str, last_flag: str) -> DataFrame:
    by_time = Window.partitionBy(key).orderBy(ts, *tiebreak)
    starts = _starts(
        F.col(ts), F.col(last_flag), F.lag(ts).over(by_time), F.lag(last_flag).over(by_time), gap
    )
    return (
        df.withColumn("__starts", starts.cast("long"))
        .withColumn("session_no", F.sum("__starts").over(_so_far(by_time)))
        .drop("__starts")
    )


def _number_sliced(
    df: DataFrame, key: str, ts: str, tiebreak: Sequence[str], gap: str, last_flag: str, slices: int
) -> DataFrame:
    """As ``_number_plain``, with each key cut along time into slices of about equal size.

    Sessions are numbered within each slice, and then each slice gets the number of sessions that
    start before it, worked out from one row per key and slice.
    """
    cut = df.repartitionByRange(slices, key, ts, *tiebreak).withColumn("__slice", F.spark_partition_id())
    # Both uses below must see the same cuts. A struct is never NULL, so plain joins match NULL keys.
    cut = checkpointed(cut).withColumn("__key", F.struct(key))
    in_slice = Window.partitionBy("__key", "__slice").orderBy(ts, *tiebreak)
    prev_ts = F.lag(ts).over(in_slice)
    starts = _starts(F.col(ts), F.col(last_flag), prev_ts, F.lag(last_flag).over(in_slice), gap)
    # Whether the first row of a slice starts a session shows only from the slice before.
    rows = cut.withColumn("__starts", F.when(prev_ts.isNull(), 0).otherwise(starts.cast("long")))
    rows = rows.withColumn("__local", F.sum("__starts").over(_so_far(in_slice)))

    ends = rows.groupBy("__key", "__slice").agg(
        F.min(ts).alias("__first_ts"),
        F.max(ts).alias("__last_ts"),
        F.max_by(last_flag, F.struct(ts, *tiebreak)).alias("__last_flag"),
        F.max("__local").alias("__inner"),
    )
    by_slice = Window.partitionBy("__key").orderBy("__slice")
    starts = _starts(
        F.col("__first_ts"), F.col("__last_flag"),
        F.lag("__last_ts").over(by_slice), F.lag("__last_flag").over(by_slice), gap,
    )
    base = (
        ends.withColumn("__starts", starts.cast("long"))
        .withColumn("__base", F.sum(F.col("__starts") + F.col("__inner")).over(_so_far(by_slice)) - F.col("__inner"))
        .select("__key", "__slice", "__base")
    )
    return rows.join(base, ["__key", "__slice"]).select(
        *df.columns, (F.col("__base") + F.col("__local")).alias("session_no")
    )


def _heavy_keys(df: DataFrame, key: str, max_rows: int) -> tuple[DataFrame, int]:
    """Keys with more than ``max_rows`` rows, of which there are few, and how many rows they have. A table of no more rows than
    that, which counting alone tells, has none."""
    if df.count() <= max_rows:
        return df.select(F.col(key).alias("__key")).where("false"), 0
    heavy = checkpointed(
        df.groupBy(F.col(key).alias("__key"))
        .agg(F.count("*").alias("__rows"))
        .where(F.col("__rows") > max_rows)
    )
    return heavy.select("__key"), heavy.agg(F.sum("__rows")).first()[0] or 0


def _number(
    df: DataFrame,
    key: str,
    ts: str,
    tiebreak: Sequence[str],
    gap: str,
    last_flag: str,
    heavy: tuple[DataFrame, int],
    max_rows: int,
) -> DataFrame:
    keys, total = heavy
    if total == 0:
        return _number_plain(df, key, ts, tiebreak, gap, last_flag)
    same = F.col(key).eqNullSafe(F.col("__key"))
    # There are at most (all rows) / max_rows heavy keys; Spark decides by their size how to join them.
    light, rest = df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi")
    slices = -(-total // max_rows) + 1
    return _number_plain(light, key, ts, tiebreak, gap, last_flag).unionByName(
        _number_sliced(rest, key, ts, tiebreak, gap, last_flag, slices)
    )


def sessionize(
    df: DataFrame,
    key: str,
    ts: str,
    gap: str,
    last_flag: str,
    tiebreak: Sequence[str],
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add ``session_no``, which counts each key's sessions from 1.

    Rows go in the order of ``ts`` and ``tiebreak``, which have to tell all rows of a key apart that a flag sets apart. A
    session ends behind a row whose ``last_flag`` is true, and before a row that comes more than ``gap``
    after the one before it. Rows without a time belong to no session and are left out.

    Keys with more than ``max_rows_per_task`` rows are looked for first, and are cut into slices.
    """
    df = df.where(F.col(ts).isNotNull())
    heavy = _heavy_keys(df, key, max_rows_per_task)
    return _number(df, key, ts, tiebreak, gap, last_flag, heavy, max_rows_per_task)


def summarize_sessions(
    sessions: DataFrame, key: str, ts: str, gap: str, last_flag: str, as_of: Column | None = None
) -> DataFrame:
    """One row per session of ``sessionize``: its span, its number of events and what closed it.

    ``closed_by`` is ``flag``, ``timeout``, or ``open`` for a session that by the time ``as_of`` (default:
    the last event of all) has not been still for as long as ``gap``.
    """
    if as_of is None:
        as_of = sessions.agg(F.max(ts)).scalar()
    still = F.unix_micros(as_of) - F.unix_micros("session_end") >= interval_micros(gap)
    return (
        sessions.groupBy(key, "session_no")
        .agg(
            F.min(ts).alias("session_start"),
            F.max(ts).alias("session_end"),
            F.count("*").alias("n_events"),
            F.bool_or(last_flag).alias("__flagged"),
        )
        .withColumn(
            "closed_by", F.when(F.col("__flagged"), "flag").when(still, "timeout").otherwise("open")
        )
        .drop("__flagged", "session_no")
    )


def gap_sessions(
    df: DataFrame,
    key: str,
    ts: str,
    gap: str,
    delay: str | None = None,
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Sessions ended by a gap alone, on tables and on streams.

    A stream goes through Spark's session windows. Those bring all rows of a key together, so a table
    goes through ``sessionize``, after events of one key at one time have been counted.
    """
    if delay is not None:
        df = df.withWatermark(ts, delay)
    if df.isStreaming:
        return (
            df.groupBy(F.session_window(ts, gap), key)
            .agg(F.max(ts).alias("session_end"), F.count("*").alias("n_events"))
            .select(key, F.col("session_window.start").alias("session_start"), "session_end", "n_events")
        )
    df = df.where(F.col(ts).isNotNull())
    heavy = _heavy_keys(df, key, max_rows_per_task)
    moments = df.groupBy(key, ts).agg(F.count("*").alias("__n"), F.lit(False).alias("__last"))
    numbered = _number(moments, key, ts, (), gap, "__last", heavy, max_rows_per_task)
    return (
        numbered.groupBy(key, "session_no")
        .agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.sum("__n").alias("n_events"))
        .drop("session_no")
    )
