import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from samples import USER_EVENTS, user_line
from tidemark.operators import (
    NEW_YORK,
    BoundingBox,
    decode_delimited,
    decode_json,
    decode_user_events,
    delimited,
    finished,
    malformed_user_events,
    tokenize,
    with_date_parts,
    within_bbox,
    word_count,
)
from tidemark.schemas import AD_CLICK, AD_IMPRESSION, TAXI_FARE, TAXI_RIDE, TRAFFIC
from tidemark.sources import pack_envelope


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_json(spark):
    df = texts(spark, '{"adId":"7","timestamp":"t","extra":1}', '{"adId":73.0}', "no message", "", None)
    got = [tuple(r) for r in decode_json(df, AD_CLICK).collect()]
    assert got == [("7", "t"), ("73.0", None), (None, None), (None, None), (None, None)]
    assert decode_json(df, AD_IMPRESSION).columns == AD_IMPRESSION.fieldNames()


def test_json_from_an_envelope_with_its_position(spark):
    events = spark.createDataFrame([(3, '{"vehicleId":"a"}')], "id int, v string")
    topic = pack_envelope(events, "t", F.col("v"), F.current_timestamp(), F.col("id"), partition=2)
    got = decode_json(topic, TRAFFIC, keep=("partition", "offset")).first()
    assert (got.vehicleId, got.partition, got.offset) == ("a", 2, 3)


def test_delimited(spark):
    ride = "1,END,2013-01-01 00:10:00,2013-01-01 00:00:00,-73.9,40.7,-73.8,40.8,2,11,12"
    df = decode_delimited(texts(spark, ride, "2,START,oops,,x,,,,99999999", "", None), TAXI_RIDE)
    assert [f.dataType for f in df.schema] == [f.dataType for f in TAXI_RIDE]
    good, bad, empty, missing = df.collect()
    assert good.endTime == dt.datetime(2013, 1, 1, 0, 10) and good.startTime == dt.datetime(2013, 1, 1)
    assert (good.rideId, good.isStart, good.passengerCnt, good.driverId) == (1, "END", 2, 12)
    assert bad[:2] == (2, "START") and bad[2:] == (None,) * 9
    assert empty.rideId is None and missing.rideId is None


def test_delimited_keeps_other_columns_and_takes_the_separator_literally(spark):
    df = texts(spark, "1|2").withColumn("n", F.lit(5))
    fares = decode_delimited(df, TAXI_FARE, sep="|")
    assert fares.columns == ["n", *TAXI_FARE.fieldNames()]
    assert fares.first()[:3] == (5, 1, 2)


def test_nulls_keep_their_place_in_delimited_text(spark):
    row = (1, "END", dt.datetime(2013, 1, 1, 0, 10), 2.5)
    schema = "a long, b string, c timestamp, d double"
    for i in range(4):
        want = tuple(None if j == i else v for j, v in enumerate(row))
        df = spark.createDataFrame([want], schema)
        assert tuple(decode_delimited(df.select(delimited(*df.columns).alias("value")), df.schema).first()) == (want if i != 1 else (*want[:1], "", *want[2:]))


def test_user_events(spark):
    df = decode_user_events(texts(spark, *map(user_line, USER_EVENTS)))
    first = df.first()
    assert (first.userId, first.time, first.page, first.isLast) == (
        21, "2021-06-30T09:15:02.000+02:00", "/shop/21", False,
    )
    assert first.eventTime == dt.datetime(2021, 6, 30, 7, 15, 2)
    assert df.where("isLast").count() == 4


BAD_LINES = ["x 2021-06-30T09:15:02.000+02:00 /p true", "1 yesterday /p true", "1 2021-06-30T09:15:02.000+02:00 /p yes", ""]


def test_malformed_user_events_stop_the_query(spark):
    for line in BAD_LINES:
        with pytest.raises(PySparkException, match="malformed user event"):
            decode_user_events(texts(spark, line)).collect()
    with pytest.raises(PySparkException, match="malformed user event"):
        decode_user_events(texts(spark, BAD_LINES[0])).select("page").count()


def test_malformed_user_events_in_quarantine(spark):
    df = texts(spark, user_line(USER_EVENTS[0]), *BAD_LINES)
    assert decode_user_events(df, "quarantine").count() == 1
    assert [r.value for r in malformed_user_events(df).collect()] == BAD_LINES
    with pytest.raises(ValueError):
        decode_user_events(df, "ignore")


def test_bounding_box_includes_its_edges(spark):
    rows = [
        (NEW_YORK.west, NEW_YORK.south, NEW_YORK.east, NEW_YORK.north),
        (-73.9, 40.7, -73.6, 40.7),
        (-73.9, 40.4, -73.8, 40.7),
        (None, 40.7, -73.8, 40.7),
    ]
    df = spark.createDataFrame(rows, "startLon double, startLat double, endLon double, endLat double")
    assert within_bbox(df).count() == 1
    assert within_bbox(df, [("endLon", "endLat")], BoundingBox(-74, -73, 40, 41.5)).count() == 4


def test_finished(spark):
    df = spark.createDataFrame([("END",), ("START",), (None,)], "isStart string")
    assert finished(df).count() == 1


def test_words(spark):
    lines = texts(spark, "a b a", "b ", "", "   ", None)
    assert sorted(r.value for r in tokenize(lines).collect()) == ["", "a", "a", "b", "b"]
    assert {tuple(r) for r in word_count(lines).collect()} == {("", 1), ("a", 2), ("b", 2)}


def test_date_parts(spark):
    df = spark.sql("SELECT timestamp'2021-06-30 12:00:00' AS t")
    assert with_date_parts(df, "t").first()[1:] == (2021, 6, 30)


def test_filters_reach_the_scan(spark, conf):
    conf("spark.sql.maxMetadataStringLength", "1000")
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    box = within_bbox(lineitem, [("l_discount", "l_tax")], BoundingBox(0.01, 0.05, 0.01, 0.05))
    plan = box.select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_discount,0.01)" in plan and "LessThanOrEqual(l_tax,0.05)" in plan
    assert "l_extendedprice" not in plan
