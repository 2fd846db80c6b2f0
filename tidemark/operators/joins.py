"""Joins of two event sequences on a key and on how far apart in time the events are."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.intervals import interval_micros
from tidemark.operators.packed_join import packed_join
from tidemark.operators.spread import spread

# A bucket is this many times as long as the join bound: longer buckets mean fewer copies of the left
# rows (1 + 1/BUCKET_BOUNDS on average), shorter ones fewer comparisons within a key.
BUCKET_BOUNDS = 4


def _bucket(ts: Column, width: int) -> Column:
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros, F.lit(width))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    *,
    upper: str | None = None,
    lower_inclusive: bool = True,
    left_delay: str | None = None,
    right_delay: str | None = None,
    time_buckets: bool = True,
    salt: int = 1,
    rows_per_task: int | None = None,
    packed: bool = False,
) -> DataFrame:
    """Pairs of equal key whose right event is not before the left one, and at most ``upper`` after it.

    With ``upper`` and both delays, a stream forgets rows that can find no more partners; otherwise it
    keeps them for ever.

    With ``upper`` the rows are also matched on a time bucket, so that the rows of one frequent key are
    spread over tasks and only rows near each other in time are compared. A right row is in one bucket
    and a left row in every bucket its interval touches, so each pair still meets exactly once.

    Without ``upper`` every later right row is a partner. On tables adaptive execution splits the
    partitions of frequent keys; a stream has no such help, and ``salt`` spreads the left rows of each key
    over that many tasks, each of which gets the key's right rows. ``rows_per_task`` spreads them by the number of rows that
    the key has had so far, and leaves other keys alone; it is for joins without ``upper``, and on tables does nothing.

    ``packed`` keeps the rows of streams by groups of keys (``packed_join``), which costs a fraction of a state entry for each. It is for joins with
    ``upper`` and both delays, needs state in RocksDB, and the result has a watermark on the right time only; on tables it does nothing.
    """
    if packed and None in (upper, left_delay, right_delay):
        raise ValueError("packed is for joins with a bound and with watermarks")
    if rows_per_task is not None and (upper is not None or left_delay is not None or right_delay is not None):
        raise ValueError("rows_per_task is for joins without a bound and without watermarks")
    if left_delay is not None:
        left = left.withWatermark(left_time, left_delay)
    if right_delay is not None:
        right = right.withWatermark(right_time, right_delay)

    on = F.col(left_key) == F.col(right_key)
    equal = [(left_key, right_key)]
    helpers = []
    start, event = F.col(left_time), F.col(right_time)
    in_time = event >= start if lower_inclusive else event > start
    if upper is not None:
        bound = F.expr(f"INTERVAL {upper}")
        in_time = in_time & (event <= start + bound)
        if time_buckets:
            width = interval_micros(upper) * BUCKET_BOUNDS
            touched = F.sequence(_bucket(start, width), _bucket(start + bound, width), F.lit(width))
            left = left.withColumn("__left_bucket", F.explode(touched))
            right = right.withColumn("__right_bucket", _bucket(event, width))
            on = on & (F.col("__left_bucket") == F.col("__right_bucket"))
            helpers += ["__left_bucket", "__right_bucket"]
            equal.append(("__left_bucket", "__right_bucket"))
    if salt > 1:
        left = left.withColumn("__left_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)))
        salts = F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))
        right = right.withColumn("__right_salt", F.explode(salts))
        on = on & (F.col("__left_salt") == F.col("__right_salt"))
        helpers += ["__left_salt", "__right_salt"]
        equal.append(("__left_salt", "__right_salt"))
    if rows_per_task is not None and left.isStreaming and right.isStreaming:
        left, right, meet, added = spread(left, right, left_key, right_key, rows_per_task)
        on = on & meet
        helpers += added
    if packed and left.isStreaming and right.isStreaming:
        met = packed_join(left, right, equal, left_time, right_time, interval_micros(upper), lower_inclusive)
        return met.where(on & in_time).drop(*helpers)
    return left.join(right, on & in_time, "inner").drop(*helpers)


def join_rides_with_fares(
    rides: DataFrame, fares: DataFrame, upper: str = "2 hours", delay: str = "30 minutes"
) -> DataFrame:
    """Finished rides with the fare paid for them: the ride ends after the fare's start, within ``upper``."""
    fares = fares.select(F.col("rideId").alias("__fare_ride"), "startTime", "totalFare", "tip")
    rides = rides.select(
        "rideId", "endTime", "driverId", "taxiId", "startLon", "startLat", "endLon", "endLat"
    )
    return interval_join(
        fares, rides, "__fare_ride", "rideId", "startTime", "endTime",
        upper=upper, lower_inclusive=False, left_delay=delay, right_delay=delay, packed=True,
    ).drop("__fare_ride")
