"""Declared record schemas.

Field names, types and positions are fixed values: producers of these messages rely on them.
"""

from pyspark.sql import types as T

TRAFFIC = (
    T.StructType()
    .add("vehicleId", "string")
    .add("vehicleType", "string")
    .add("routeId", "string")
    .add("latitude", "string")
    .add("longitude", "string")
    .add("time", "string")
    .add("speed", "string")
    .add("fuelLevel", "string")
)

AD_IMPRESSION = (
    T.StructType()
    .add("adId", "string")
    .add("timestamp", "string")
    .add("publisher", "string")
    .add("advertiser", "string")
    .add("website", "string")
    .add("geo", "string")
    .add("bid", "string")
    .add("cookie", "string")
)

AD_CLICK = T.StructType().add("adId", "string").add("timestamp", "string")

# Positional (delimited) records: the ride's end time comes before its start time.
TAXI_RIDE = (
    T.StructType()
    .add("rideId", "long")
    .add("isStart", "string")
    .add("endTime", "timestamp")
    .add("startTime", "timestamp")
    .add("startLon", "float")
    .add("startLat", "float")
    .add("endLon", "float")
    .add("endLat", "float")
    .add("passengerCnt", "short")
    .add("taxiId", "long")
    .add("driverId", "long")
)

TAXI_FARE = (
    T.StructType()
    .add("rideId", "long")
    .add("taxiId", "long")
    .add("driverId", "long")
    .add("startTime", "timestamp")
    .add("paymentType", "string")
    .add("tip", "float")
    .add("tolls", "float")
    .add("totalFare", "float")
)

USER_EVENT = (
    T.StructType()
    .add("userId", "integer")
    .add("time", "string")
    .add("page", "string")
    .add("isLast", "boolean")
)

AREA = T.StructType().add("name", "string").add("coord", T.ArrayType(T.ArrayType(T.DoubleType())))

KAFKA_ENVELOPE = (
    T.StructType()
    .add("key", "binary")
    .add("value", "binary")
    .add("topic", "string")
    .add("partition", "integer")
    .add("offset", "long")
    .add("timestamp", "timestamp")
    .add("timestampType", "integer")
)
