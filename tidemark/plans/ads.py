"""Ad impressions and the clicks that follow them: ``view`` and ``click`` rows of ``events``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import decode_json, interval_join
from tidemark.schemas import AD_CLICK, AD_IMPRESSION
from tidemark.sources import FILES_PER_BATCH, as_wall_clock, pack_envelope, read_table, read_table_stream, replay_by_time
from tidemark.streaming import run_to_table

CLICK_BOUND = "6 hours"
DELAY = "10 minutes"
# Micro-batches that a replayed table is cut into at least, so that state and watermark are at work on small tables too.
SLICES = 2
# Impressions or clicks of one ad beyond which a stream spreads its later impressions; each task then keeps the later clicks on the ad.
ROWS_PER_TASK = 100_000


def _impressions(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "view").select(
        F.col("user_id").alias("impressionAdId"),
        F.col("ts").alias("impressionTime"),
        F.col("event_id").alias("impressionId"),
        F.col("value").alias("bid"),
    )


def _clicks(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "click").select(
        F.col("user_id").alias("clickAdId"), F.col("ts").alias("clickTime"), F.col("event_id").alias("clickId")
    )


def _join(events: DataFrame, **how: str | int | bool) -> DataFrame:
    return interval_join(
        _impressions(events), _clicks(events),
        "impressionAdId", "clickAdId", "impressionTime", "clickTime", **how,
    )


def ad_click_join(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(_join(read_table(spark, folder, "events")))


def ad_click_interval_join(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(_join(read_table(spark, folder, "events"), upper=CLICK_BOUND))


def ad_click_join_stream(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table_stream(spark, folder, "events", FILES_PER_BATCH)
    return as_wall_clock(run_to_table(_join(events, rows_per_task=ROWS_PER_TASK)))


def ad_click_interval_join_stream(spark: SparkSession, folder: str) -> DataFrame:
    events = replay_by_time(read_table(spark, folder, "events"), "ts", at_least=SLICES)
    joined = _join(events, upper=CLICK_BOUND, left_delay=DELAY, right_delay=DELAY, packed=True)
    return as_wall_clock(run_to_table(joined))


# --- Messages -------------------------------------------------------------------------------------


def _topic(events: DataFrame, event_type: str, schema: StructType) -> DataFrame:
    """Rows of one type as JSON messages; their offset is the row's id."""
    known = {"adId": F.col("user_id").cast("string"), "timestamp": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "bid": F.col("value").cast("string")}
    fields = [known.get(name, F.lit(name)).alias(name) for name in schema.fieldNames()]
    rows = events.where(F.col("event_type") == event_type)
    return pack_envelope(rows, event_type, F.to_json(F.struct(*fields)), F.col("ts"), F.col("event_id"))


def _from_messages(events: DataFrame, **how: str | bool) -> DataFrame:
    """The join on messages of both kinds, decoded by their schemas."""
    seen = decode_json(_topic(events, "view", AD_IMPRESSION), AD_IMPRESSION, keep=("offset",)).select(
        F.col("adId").cast("long").alias("impressionAdId"),
        F.col("timestamp").cast("timestamp").alias("impressionTime"),
        F.col("offset").alias("impressionId"),
        F.col("bid").cast("double").alias("bid"),
    )
    clicked = decode_json(_topic(events, "click", AD_CLICK), AD_CLICK, keep=("offset",)).select(
        F.col("adId").cast("long").alias("clickAdId"), F.col("timestamp").cast("timestamp").alias("clickTime"), F.col("offset").alias("clickId")
    )
    return interval_join(
        seen, clicked, "impressionAdId", "clickAdId", "impressionTime", "clickTime", upper=CLICK_BOUND, **how
    )


def ad_click_from_messages(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(_from_messages(read_table(spark, folder, "events")))


def ad_click_from_messages_stream(spark: SparkSession, folder: str) -> DataFrame:
    events = replay_by_time(read_table(spark, folder, "events"), "ts", at_least=SLICES)
    joined = _from_messages(events, left_delay=DELAY, right_delay=DELAY, packed=True)
    return as_wall_clock(run_to_table(joined))
