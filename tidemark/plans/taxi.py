"""Taxi rides and fares: ``lineitem`` rows are rides, ``orders`` rows are the fares paid for them.

A ride's coordinates are its discount and tax; its end point has them swapped.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

from tidemark.operators import (
    BoundingBox,
    append_areas,
    decode_delimited,
    delimited,
    finished,
    join_rides_with_fares,
    pane_sums,
    sliding_avg,
    windows_of_panes,
    within_bbox,
)
from tidemark.schemas import AREA, TAXI_FARE, TAXI_RIDE
from tidemark.sources import FILES_PER_BATCH, as_wall_clock, read_areas, read_table, read_table_stream, replay_together
from tidemark.streaming import await_query, open_groups, run_to_table, scratch_folder, to_parquet_lake

TOWN = BoundingBox(west=0.01, east=0.08, south=0.01, north=0.07)
JOIN_BOUND = "90 days"
DELAY = "30 minutes"
# Micro-batches that a replayed table is cut into at least, so that state and watermark are at work on small tables too.
SLICES = 2
LINEITEM_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate", "l_suppkey", "l_partkey", "l_discount", "l_tax"
)

# Corners of the districts that ride coordinates fall into. Harbour has a notch, Old Town overlaps it.
DISTRICTS = {
    "Harbour": [(0.005, 0.005), (0.065, 0.005), (0.065, 0.065), (0.035, 0.035), (0.005, 0.065)],
    "Old Town": [(0.025, 0.015), (0.055, 0.015), (0.055, 0.045), (0.025, 0.045)],
    "Station": [(0.065, 0.035), (0.095, 0.065), (0.065, 0.085)],
}

# Corners of the regions that the first two numbers of an embedding fall into.
REGIONS = {
    "Arrow": [(0.0, 0.0), (0.4, 0.0), (0.4, 0.4), (0.2, 0.2), (0.0, 0.4)],
    "Block": [(-0.3, -0.3), (-0.05, -0.3), (-0.05, -0.05), (-0.3, -0.05)],
    "Diamond": [(0.0, -0.15), (0.15, 0.0), (0.0, 0.15), (-0.15, 0.0)],
    "Wedge": [(-0.4, 0.0), (-0.1, 0.1), (-0.4, 0.4)],
}


def _areas(spark: SparkSession, corners: dict[str, list[tuple[float, float]]]) -> DataFrame:
    rows = [(name, [list(corner) for corner in polygon]) for name, polygon in corners.items()]
    return spark.createDataFrame(rows, AREA)


def _rides(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("rideId"),
        F.col("l_linenumber").alias("leg"),
        F.when(F.col("l_linestatus") == "F", "END").otherwise("START").alias("isStart"),
        F.col("l_shipdate").alias("endTime"),
        F.col("l_suppkey").alias("driverId"),
        F.col("l_partkey").alias("taxiId"),
        F.col("l_discount").alias("startLon"),
        F.col("l_tax").alias("startLat"),
        F.col("l_tax").alias("endLon"),
        F.col("l_discount").alias("endLat"),
    )


def _fares(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("rideId"),
        F.col("o_orderdate").alias("startTime"),
        F.col("o_totalprice").alias("totalFare"),
        # In cents: sums of whole numbers are exact in any order.
        F.round(F.col("o_totalprice") * 100).alias("tip"),
    )


def rides_in_bbox(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(within_bbox(_rides(read_table(spark, folder, "lineitem")), bbox=TOWN))


def rides_finished(spark: SparkSession, folder: str) -> DataFrame:
    rides = read_table(spark, folder, "lineitem").withColumnRenamed("l_linestatus", "isStart")
    return as_wall_clock(finished(rides, value="F").select("l_orderkey", "l_linenumber", "isStart", "l_shipdate"))


def _ride_fare_join(rides: DataFrame, fares: DataFrame) -> DataFrame:
    return join_rides_with_fares(_rides(rides), _fares(fares), upper=JOIN_BOUND, delay=DELAY)


def ride_fare_join(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(
        _ride_fare_join(read_table(spark, folder, "lineitem"), read_table(spark, folder, "orders"))
    )


def _replayed(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Rides and fares as streams in order of the times they are joined on."""
    lineitem = read_table(spark, folder, "lineitem").select(*LINEITEM_COLUMNS)
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return replay_together((lineitem, "l_shipdate"), (orders, "o_orderdate"), at_least=SLICES)


def ride_fare_join_stream(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(run_to_table(_ride_fare_join(*_replayed(spark, folder))))


def enriched_rides(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """Finished rides in town with their fares and the districts they start and stop in."""
    # The state is derived; filtered by the column it comes from, the scan can skip.
    rides = finished(within_bbox(_rides(rides.where("l_linestatus = 'F'")), bbox=TOWN))
    return _enriched(rides, _fares(fares))


def _enriched(rides: DataFrame, fares: DataFrame) -> DataFrame:
    joined = join_rides_with_fares(rides, fares, upper=JOIN_BOUND, delay=DELAY)
    return append_areas(
        joined,
        _areas(joined.sparkSession, DISTRICTS),
        {"stopNbhd": ("endLon", "endLat"), "startNbhd": ("startLon", "startLat")},
    )


def ride_districts(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(
        enriched_rides(read_table(spark, folder, "lineitem"), read_table(spark, folder, "orders"))
    )


def ride_districts_stream(spark: SparkSession, folder: str) -> DataFrame:
    return as_wall_clock(run_to_table(enriched_rides(*_replayed(spark, folder))))


TIPS = {"size": "30 days", "slide": "10 days", "keys": ["stopNbhd"], "value": "tip"}


def average_tips(enriched: DataFrame) -> DataFrame:
    """Average tip by district, over 30 days every 10 days."""
    return sliding_avg(enriched, "endTime", **TIPS)


def tips_sliding(spark: SparkSession, folder: str) -> DataFrame:
    enriched = enriched_rides(read_table(spark, folder, "lineitem"), read_table(spark, folder, "orders"))
    return as_wall_clock(average_tips(enriched))


def _wide(schema: StructType) -> StructType:
    """The schema with doubles for floats, in which the tables' numbers are exact."""
    return StructType([StructField(f.name, DoubleType() if isinstance(f.dataType, FloatType) else f.dataType) for f in schema])


def _messages(rows: DataFrame, schema: StructType, **fields: Column | str) -> DataFrame:
    """Rows as delimited messages of a schema; fields that are not given are empty."""
    return rows.select(delimited(*(fields.get(name, F.lit(None)) for name in schema.fieldNames())).alias("value"))


def tips_sliding_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way on a stream: delimited rides and fares, decoded, filtered, joined, set in districts, summed by pane.

    The stream writes the panes its watermark has passed; those still open at its end are read from its state. Windows are
    put together from a row for each pane and district.
    """
    lineitem, orders = _replayed(spark, folder)
    rides = _rides(lineitem)
    sent = _messages(rides, TAXI_RIDE, **{c: c for c in rides.columns if c in TAXI_RIDE.fieldNames()})
    paid = _messages(orders, TAXI_FARE, rideId="o_orderkey", startTime="o_orderdate", tip=F.round(F.col("o_totalprice") * 100), totalFare="o_totalprice")
    rides, fares = decode_delimited(sent, _wide(TAXI_RIDE)), decode_delimited(paid, _wide(TAXI_FARE))
    enriched = _enriched(finished(within_bbox(rides, bbox=TOWN)), fares)
    run = scratch_folder(spark, "tips")
    closed = run_to_table(pane_sums(enriched, "endTime", TIPS["slide"], TIPS["keys"], TIPS["value"]), folder=run)
    return as_wall_clock(windows_of_panes(closed.unionByName(open_groups(closed, run)), **TIPS))


def _points(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(
        "vec_id",
        F.get("embedding", F.lit(0)).cast("double").alias("x"),
        F.get("embedding", F.lit(1)).cast("double").alias("y"),
    )


def _in_regions(points: DataFrame, **how: int) -> DataFrame:
    return append_areas(points, _areas(points.sparkSession, REGIONS), {"region": ("x", "y")}, **how)


def neighbourhoods(spark: SparkSession, folder: str) -> DataFrame:
    return _in_regions(_points(read_table(spark, folder, "embeddings")))


def neighbourhoods_from_file(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the regions read from a file of JSON lines, some of which are no polygon."""
    path = scratch_folder(spark, "regions")
    lines = _areas(spark, REGIONS).select(F.to_json(F.struct("name", "coord")).alias("value"))
    lines.unionByName(spark.createDataFrame([("",), ("no polygon",)], "value string")).write.text(path)
    return append_areas(_points(read_table(spark, folder, "embeddings")), read_areas(spark, path), {"region": ("x", "y")})


def neighbourhoods_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same as ``neighbourhoods`` with nothing broadcast, as when there are very many areas."""
    return _in_regions(_points(read_table(spark, folder, "embeddings")), max_broadcast_bytes=0)


def neighbourhoods_stream(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = read_table_stream(spark, folder, "embeddings", FILES_PER_BATCH)
    return run_to_table(_in_regions(_points(embeddings)))


# --- Messages and files ---------------------------------------------------------------------------

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _order_lines(orders: DataFrame) -> tuple[DataFrame, StructType]:
    return orders.select(delimited(*ORDER_COLUMNS).alias("value")), orders.schema


def delimited_decode(spark: SparkSession, folder: str) -> DataFrame:
    lines, schema = _order_lines(read_table(spark, folder, "orders"))
    return as_wall_clock(decode_delimited(lines, schema))


def delimited_decode_stream(spark: SparkSession, folder: str) -> DataFrame:
    lines, schema = _order_lines(read_table_stream(spark, folder, "orders", FILES_PER_BATCH))
    return as_wall_clock(run_to_table(decode_delimited(lines, schema)))


def lake_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders streamed into files by month; the folders of one year are read back."""
    base = scratch_folder(spark, "lake")
    orders = read_table_stream(spark, folder, "orders", FILES_PER_BATCH)
    query = to_parquet_lake(
        orders, f"{base}/data", f"{base}/checkpoint", "o_orderdate", ("year", "month"), available_now=True
    )
    await_query(query)
    lake = spark.read.parquet(f"{base}/data").where(F.col("year") == 1997)
    return as_wall_clock(lake.select(*ORDER_COLUMNS, "month", "day"))
