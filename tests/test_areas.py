import json
import math
import random

import pytest
from pyspark.sql import functions as F

from test_functions import crossings_odd
from tidemark.operators import append_areas
from tidemark.operators.areas import _grid, _shapes
from tidemark.operators.large_areas import area_cells
from tidemark.schemas import AREA
from tidemark.sources import malformed_areas, read_areas, read_table, read_table_stream
from tidemark.streaming import run_to_table

POINT = {"area": ("x", "y")}


def random_areas(rng, n):
    areas = {}
    for i in range(n):
        x, y, size = rng.uniform(-5, 5), rng.uniform(-5, 5), rng.choice([0.3, 1.0, 4.0])
        corners = rng.randint(3, 7)
        areas[f"area {i:02}"] = [[x + rng.uniform(0, size), y + rng.uniform(0, size)] for _ in range(corners)]
    return areas


def expected(points, areas):
    out = {}
    for i, x, y in points:
        names = [n for n, p in areas.items() if x is not None and y is not None and crossings_odd(x, y, p)]
        out[i] = max(names, default="Other")
    return out


def frames(spark, points, areas):
    return spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(list(areas.items()), AREA)


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_areas(spark, seed, max_bytes):
    rng = random.Random(seed)
    areas = random_areas(rng, 40)
    points = [(i, rng.uniform(-6, 10), rng.uniform(-6, 10)) for i in range(1500)]
    points += [(2000 + i, *corner) for i, corner in enumerate(c for p in areas.values() for c in p)]
    # a third of the points coincide
    points += [(5000 + i, 0.5, 0.5) for i in range(700)] + [(9000, None, 1.0), (9001, 1.0, None)]
    got = append_areas(*frames(spark, points, areas), POINT, max_broadcast_bytes=max_bytes)
    assert got.columns == ["id", "x", "y", "area"]
    assert {r.id: r.area for r in got.collect()} == expected(points, areas)
    assert got.count() == len(points)


def star(rng, x, y, corners, size=1.0, back=0.0):
    """A polygon with many corners around a point, some on one height or one line; with ``back`` it crosses itself."""
    out = []
    for i in range(corners):
        angle = 2 * math.pi * i / corners + rng.uniform(-back, back)
        far = size * rng.choice([0.3, 0.7, 1.0, rng.uniform(0.2, 1.0)])
        out.append([round(x + far * math.cos(angle), 3), round(y + far * math.sin(angle), 3)])
    return out


@pytest.mark.parametrize("seed,back", [(4, 0.0), (5, 0.5)])
def test_areas_with_many_corners(spark, seed, back):
    """Among small areas, some of them under and over the large ones; corners, heights of corners and far points are among the points."""
    rng = random.Random(seed)
    areas = random_areas(rng, 10)
    areas |= {f"area {i:02}x": star(rng, rng.uniform(-3, 3), rng.uniform(-3, 3), n, rng.choice([1.0, 4.0]), back) for i, n in enumerate([65, 200, 700])}
    areas["area 05y"] = areas["area 01x"]  # the same corners under another name
    corners = [c for p in areas.values() for c in p]
    points = [(i, rng.uniform(-6, 8), rng.uniform(-6, 8)) for i in range(1500)]
    points += [(2000 + i, *rng.choice(corners)) for i in range(300)] + [(3000 + i, rng.uniform(-6, 8), rng.choice(corners)[1]) for i in range(300)]
    points += [(4000 + i, rng.choice(corners)[0], rng.uniform(-6, 8)) for i in range(200)] + [(5000, 1e9, 0.0), (5001, -1e9, 0.0), (5002, None, 1.0), (5003, 0.0, -1e9)]
    got = append_areas(*frames(spark, points, areas), POINT)
    assert got.columns == ["id", "x", "y", "area"]
    assert {r.id: r.area for r in got.collect()} == expected(points, areas) and got.count() == len(points)


def test_a_point_meets_few_edges_of_a_very_large_area(spark):
    rng = random.Random(6)
    turn = [2 * math.pi * i / 50_000 for i in range(50_000)]
    far = [0.7 + 0.2 * math.sin(5 * t) + 0.001 * rng.random() for t in turn]
    coast = [[r * math.cos(t), r * math.sin(t)] for r, t in zip(far, turn)]
    areas = spark.createDataFrame([("a", "coast", coast)], "area string, name string, coord array<array<double>>")
    cells, grids = area_cells(areas)
    sizes = cells.agg(F.avg(F.size("edges")).alias("edges"), F.max(F.size("levels")).alias("levels"), F.count("*").alias("n")).first()
    assert sizes.edges < 100 and sizes.n <= grids.first().n ** 2
    points = [(i, rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(200)]
    got = append_areas(*frames(spark, points, {"coast": coast}), POINT)
    assert {r.id: r.area for r in got.collect()} == expected(points, {"coast": coast})


def test_flat_areas_have_no_inside(spark):
    flat = {"line": [[float(i), 1.0] for i in range(80)], "post": [[2.0, float(i)] for i in range(80)], "dot": [[3.0, 3.0]] * 80}
    points = [(1, 2.0, 1.0), (2, 2.0, 1.5), (3, 3.0, 3.0), (4, 1.5, 1.0)]
    assert {r.id: r.area for r in append_areas(*frames(spark, points, flat), POINT).collect()} == expected(points, flat)


def test_two_points_per_row(spark):
    areas = {"west": [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]], "east": [[1.0, 0.0], [2.0, 0.0], [2.0, 1.0], [1.0, 1.0]]}
    rides = spark.createDataFrame([(0.5, 0.5, 1.5, 0.5), (1.5, 0.5, 3.0, 3.0)], "a float, b float, c float, d float")
    areas = spark.createDataFrame(list(areas.items()), AREA)
    got = append_areas(rides, areas, {"stop": ("c", "d"), "start": ("a", "b")}, default="-").collect()
    assert {(r.start, r.stop) for r in got} == {("west", "east"), ("east", "-")}


def test_no_areas(spark):
    points, areas = frames(spark, [(1, 0.0, 0.0)], {"none": []})
    for limit in (1 << 20, 0):
        assert append_areas(points, areas, POINT, max_broadcast_bytes=limit).first().area == "Other"


def test_areas_with_the_same_corners_are_one_area(spark):
    square = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]
    points, areas = frames(spark, [(1, 0.5, 0.5)], {f"copy {i}": square for i in range(50)})
    assert _shapes(areas).count() == 1
    assert append_areas(points, areas, POINT).first().area == "copy 9"


def test_one_huge_area_among_many_tiny_ones_does_not_fill_the_grid(spark):
    def square(x, y, size):
        return [[x, y], [x + size, y], [x + size, y + size], [x, y + size]]

    areas = {f"tiny {i}": square(i * 0.01, 0.0, 0.001) for i in range(500)}
    areas["huge"] = square(-1e6, -1e6, 2e6)
    points, frame = frames(spark, [(1, 0.0105, 0.0005), (2, 500.0, 500.0)], areas)
    width, height, size = _grid(_shapes(frame))
    assert size < 10_000_000
    assert {r.id: r.area for r in append_areas(points, frame, POINT).collect()} == {1: "tiny 1", 2: "huge"}


def test_the_lookup_is_a_hash_join_and_nothing_is_broadcast_beyond_the_limit(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(3)
    points, areas = frames(spark, [(1, 0.5, 0.5)], random_areas(rng, 5))

    def plan(limit):
        return append_areas(points, areas, POINT, max_broadcast_bytes=limit)._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(1 << 20) and "NestedLoop" not in plan(1 << 20)
    assert "Broadcast" not in plan(0)


def test_stream(spark):
    folder = "/root/testdata/sf0.001"
    areas = spark.createDataFrame([("right", [[0.0, -9.0], [9.0, -9.0], [9.0, 9.0], [0.0, 9.0]])], AREA)

    def where(embeddings, **how):
        points = embeddings.select("vec_id", F.get("embedding", F.lit(0)).alias("x"), F.get("embedding", F.lit(1)).alias("y"))
        return append_areas(points, areas, POINT, **how)

    want = where(read_table(spark, folder, "embeddings"))
    stream = read_table_stream(spark, folder, "embeddings")
    assert run_to_table(where(stream)).exceptAll(want).isEmpty()
    by_shuffle = run_to_table(where(stream, max_broadcast_bytes=0))
    assert by_shuffle.exceptAll(want).isEmpty() and by_shuffle.count() == want.count()


def test_areas_file(spark, tmp_path):
    path = tmp_path / "areas.jsonl"
    lines = [json.dumps({"name": "a", "coord": [[0, 0], [1, 0], [1, 1.5]]}), "nonsense", json.dumps({"name": "b"})]
    path.write_text("\n".join(lines) + "\n")
    assert [tuple(r) for r in read_areas(spark, str(path)).collect()] == [("a", [[0.0, 0.0], [1.0, 0.0], [1.0, 1.5]])]
    assert [r.value for r in malformed_areas(spark, str(path)).collect()] == lines[1:]
