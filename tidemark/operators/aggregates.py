"""Counts and averages by key and by time window.

All of them aggregate within each task before the shuffle, on tables and on streams.

With ``change``, a column of +1 and -1, they take a stream of changes (``streaming.first_changes``) for the rows that are left
when all changes are made. The result then has one more column, ``rows``, of how many of them are in the group; a
group of which none are left has 0 there, which in update mode tells that the group is gone (``streaming.settled``).
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.intervals import interval_micros


def _average(value: str, change: str | None = None) -> Column:
    # Readings come as text; one that is no number must not stop the query.
    number = F.col(value).try_cast("double")
    if change is None:
        return F.avg(number).alias(value)
    # Whole numbers add up and cancel exactly; other doubles leave what rounding makes of them.
    counted = F.sum(F.when(number.isNotNull(), F.col(change)))
    return F.try_divide(F.sum(number * F.col(change)), counted.cast("double")).alias(value)


def _count(change: str | None) -> Column:
    return (F.count("*") if change is None else F.sum(change)).alias("count")


def _left(change: str | None) -> list[Column]:
    return [] if change is None else [F.sum(change).alias("rows")]


def count_by(df: DataFrame, keys: Sequence[str], change: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(_count(change), *_left(change))


def avg_by(df: DataFrame, keys: Sequence[str], value: str, change: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(_average(value, change), *_left(change))


def _windowed(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    result: Column,
    name: str,
    slide: str | None,
    delay: str | None,
    ordered: bool,
    change: str | None,
) -> DataFrame:
    if delay is not None:
        df = df.withWatermark(ts, delay)
    out = (
        df.groupBy(F.window(ts, size, slide), *keys)
        .agg(result, *_left(change))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            name,
            *(["rows"] if change else []),
        )
    )
    return out.orderBy("window_start", *keys) if ordered else out


def windowed_count(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    slide: str | None = None,
    delay: str | None = None,
    ordered: bool = False,
    change: str | None = None,
) -> DataFrame:
    """Rows per time window and key; rows without a time belong to no window.

    ``delay`` sets a watermark. ``ordered`` sorts by window, which a stream allows in complete mode only.
    """
    return _windowed(df, ts, size, keys, _count(change), "count", slide, delay, ordered, change)


def windowed_avg(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    value: str,
    slide: str | None = None,
    delay: str | None = None,
    ordered: bool = False,
    change: str | None = None,
) -> DataFrame:
    """Average of ``value`` per time window and key; see ``windowed_count``."""
    return _windowed(df, ts, size, keys, _average(value, change), value, slide, delay, ordered, change)


def pane_sums(df: DataFrame, ts: str, slide: str, keys: Sequence[str], value: str, delay: str | None = None) -> DataFrame:
    """Sum and number of the values per key and pane, a window as long as the step of a sliding window: ``pane``, keys, ``total``
    and ``n``. Rows without a time are in none. On a stream this is an aggregate for any output mode."""
    if delay is not None:
        df = df.withWatermark(ts, delay)
    number = F.col(value).try_cast("double")
    return df.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(F.sum(number).alias("total"), F.count(number).alias("n"))


def windows_of_panes(panes: DataFrame, size: str, slide: str, keys: Sequence[str], value: str) -> DataFrame:
    """The averages per sliding window that ``windowed_avg`` gives, put together from ``pane_sums`` of the same ``slide``, of
    which ``size`` has to be a multiple.

    A row is in one pane and is never copied to the windows it is in; only panes are. On a stream (in append
    mode) windows follow when the watermark passes their ends; of panes that a stream has written in update mode take the last versions.
    """
    if interval_micros(size) % interval_micros(slide):
        raise ValueError(f"{size} is no multiple of {slide}")
    at = F.window_time("pane") if panes.isStreaming else F.col("pane.start")
    average = F.try_divide(F.sum("total"), F.sum("n").cast("double")).alias(value)
    windows = panes.withColumn("__at", at).groupBy(F.window("__at", size, slide), *keys).agg(average)
    return windows.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, value)


def sliding_avg(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], value: str, delay: str | None = None) -> DataFrame:
    """``windowed_avg`` of a sliding window by way of its panes."""
    return windows_of_panes(pane_sums(df, ts, slide, keys, value, delay), size, slide, keys, value)
