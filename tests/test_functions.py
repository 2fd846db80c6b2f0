import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import interval_micros, parse_java_date, point_in_polygon, polygon_edges, unreadable_dates, words


def test_java_dates(spark):
    cases = [
        ("Tue Nov 8 09:41:13 IST 2022", "2022-11-08 04:11:13"),
        ("Tue Nov 8 09:41:13 UTC 2022", "2022-11-08 09:41:13"),
        ("Thu Nov 3 07:08:09 GMT 2022", "2022-11-03 07:08:09"),
        (" Tue Nov 8 09:41:13 IST 2022 ", "2022-11-08 04:11:13"),
        ("Tue Nov 8 09:41:13 XYZ 2022", None),
        ("Tue Nov 8 09:41:13 IST", None),
        ("Tue Nov 8 09:41:13 Z IST 2022", None),
        ("Tue Foo 8 09:41:13 IST 2022", None),
        ("not a date", None),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame([(t,) for t, _ in cases], "time string")
    got = [r[0] for r in df.select(parse_java_date("time").cast("string")).collect()]
    assert got == [want for _, want in cases]


def test_java_dates_with_offsets(spark):
    cases = [("+05:30", "04:11:13"), ("-0800", "17:41:13"), ("GMT+02:00", "07:41:13"), ("UTC-01:00", "10:41:13")]
    df = spark.createDataFrame([(f"Tue Nov 8 09:41:13 {z} 2022",) for z, _ in cases], "time string")
    got = [r[0][11:] for r in df.select(parse_java_date("time").cast("string")).collect()]
    assert got == [t for _, t in cases]


def test_unreadable_java_dates_are_not_lost(spark):
    texts = ["Tue Nov 8 09:41:13 IST 2022", "Tue Nov 8 09:41:13 XYZ 2022", "never", None]
    df = spark.createDataFrame([(t,) for t in texts], "time string")
    assert [r.time for r in unreadable_dates(df, "time").collect()] == texts[1:3]
    with pytest.raises(PySparkException, match="no readable time"):
        df.select(parse_java_date("time", on_unknown="fail")).collect()
    assert df.where("time IS NULL").select(parse_java_date("time", on_unknown="fail")).first()[0] is None


def test_java_date_zones_can_be_given(spark):
    df = spark.createDataFrame([("Tue Nov 8 09:41:13 IST 2022",)], "time string")
    got = df.select(parse_java_date("time", {"IST": "+02:00"}).cast("string")).first()[0]
    assert got == "2022-11-08 07:41:13"


def test_words(spark):
    cases = {
        "a b": ["a", "b"],
        "a  b": ["a", "", "b"],
        " a": ["", "a"],
        "a ": ["a"],
        "": [""],
        "  ": None,
        "a\tb\nc": ["a\tb\nc"],
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    assert [r[0] for r in df.select(words("text")).collect()] == list(cases.values())


def test_intervals():
    assert interval_micros("5 minutes") == 300_000_000
    assert interval_micros("1 hour 30 minutes") == 5_400_000_000
    assert interval_micros("90 days") == 90 * 86_400_000_000
    for bad in ("", "soon", "1 month", "5 minutes or so"):
        with pytest.raises(ValueError):
            interval_micros(bad)


def crossings_odd(x, y, polygon):
    odd = False
    for (xi, yi), (xj, yj) in zip(polygon, polygon[-1:] + polygon[:-1]):
        if (yi > y) != (yj > y) and x < xi + (xj - xi) * (y - yi) / (yj - yi):
            odd = not odd
    return odd


def test_point_in_polygon_by_hand(spark):
    notched = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [2.0, 2.0], [0.0, 4.0]]
    cases = [
        ((1.0, 1.0), True), ((2.0, 3.0), False), ((5.0, 1.0), False),
        ((0.5, 3.0), True), ((0.0, 0.0), True), ((4.0, 4.0), False),
    ]
    df = spark.createDataFrame([(x, y, notched) for (x, y), _ in cases], "x double, y double, p array<array<double>>")
    got = df.select(point_in_polygon(F.col("x"), F.col("y"), polygon_edges("p"))).collect()
    assert [r[0] for r in got] == [want for _, want in cases]


def test_point_in_polygon_on_random_polygons(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        n = rng.randint(3, 9)
        # corners on a coarse grid, so that level and upright edges and hits on corners occur
        polygon = [[float(rng.randint(0, 8)), float(rng.randint(0, 8))] for _ in range(n)]
        rows += [(rng.randint(-2, 20) / 2, rng.randint(-2, 20) / 2, polygon) for _ in range(5)]
    df = spark.createDataFrame(rows, "x double, y double, p array<array<double>>")
    got = [r[0] for r in df.select(point_in_polygon(F.col("x"), F.col("y"), polygon_edges("p"))).collect()]
    assert got == [crossings_odd(x, y, p) for x, y, p in rows]
    assert any(got) and not all(got)


def test_missing_coordinates_are_outside(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (math.nan, 1.0)], "x double, y double")
    square = F.lit([[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]])
    got = df.select(F.coalesce(point_in_polygon(F.col("x"), F.col("y"), polygon_edges(square)), F.lit(False)))
    assert [r[0] for r in got.collect()] == [False, False, False]
