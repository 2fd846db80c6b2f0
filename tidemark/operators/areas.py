"""Which named polygon a point lies in."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.checkpoints import checkpointed
from tidemark.functions.geo import point_in_polygon, polygon_edges
from tidemark.operators.large_areas import MANY_EDGES, area_cells, cell_of, inside_cell

# The lookup table is broadcast up to this size and joined by shuffle beyond it.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# An area is listed in every grid cell its box touches; cells are chosen so large that the list has at
# most this many entries per area.
CELLS_PER_AREA = 16

_EDGE_BYTES = 48
_ENTRY_BYTES = 256
_GROWTH = [4.0**k for k in range(16)]


def _shapes(areas: DataFrame) -> DataFrame:
    """Areas with their edges and box. Of areas with the same corners only the last name can win."""
    x = F.transform("coord", lambda c: F.get(c, F.lit(0)))
    y = F.transform("coord", lambda c: F.get(c, F.lit(1)))
    return (
        areas.where(F.size("coord") > 0)
        .groupBy("coord")
        .agg(F.max("name").alias("name"))
        .select(
            "name",
            polygon_edges("coord").alias("edges"),
            F.array_min(x).alias("x0"),
            # Rounding in the crossing test may let in a point just right of the box.
            (F.array_max(x) + (F.abs(F.array_max(x)) + 1) * F.lit(1e-12)).alias("x1"),
            F.array_min(y).alias("y0"), F.array_max(y).alias("y1"),
        )
    )


def _cell(value: Column, width: float) -> Column:
    return F.floor(value / F.lit(width))


def _grid(shapes: DataFrame) -> tuple[float, float, int]:
    """Cell width and height that suit the areas, and a bound on the bytes of the table of cells."""
    mean = shapes.agg(
        F.count("*").alias("n"),
        F.avg(F.col("x1") - F.col("x0")).alias("w"),
        F.avg(F.col("y1") - F.col("y0")).alias("h"),
    ).first()
    if not mean["n"]:
        return 1.0, 1.0, 0
    width, height = mean["w"] or 1.0, mean["h"] or 1.0
    w, h = F.col("growth") * width, F.col("growth") * height
    cells = (F.floor(F.col("x1") / w) - F.floor(F.col("x0") / w) + 1) * (
        F.floor(F.col("y1") / h) - F.floor(F.col("y0") / h) + 1
    )
    sizes = (
        shapes.select("*", F.explode(F.lit(_GROWTH)).alias("growth"))
        .groupBy("growth")
        .agg(
            F.sum(cells).alias("cells"),
            F.sum(cells * (F.size("edges") * _EDGE_BYTES + _ENTRY_BYTES)).alias("bytes"),
        )
        .orderBy("growth")
        .collect()  # one row per entry of _GROWTH
    )
    size = next((s for s in sizes if s["cells"] <= CELLS_PER_AREA * mean["n"]), sizes[-1])
    return width * size["growth"], height * size["growth"], size["bytes"]


def append_areas(
    df: DataFrame,
    areas: DataFrame,
    points: Mapping[str, tuple[str, str]],
    default: str | None = "Other",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add, for each ``name: (lon, lat)`` in ``points``, the name of the area the point lies in.

    A point in several areas gets the last of their names in alphabetical order, one in none gets
    ``default``. Points and areas meet through a grid: an area is listed in each cell its box touches,
    a point looks only at the areas of its cell. The size of that list is measured first. Up to
    ``max_broadcast_bytes`` it is broadcast; beyond, each distinct point is joined by shuffle. A stream
    is then joined with the list by shuffle as it is.

    On a table, areas with very many corners are cut into cells of their own (``large_areas``), so that a point is compared with the
    few edges near it.
    """
    if not df.isStreaming:
        large = areas.where((F.size("coord") > MANY_EDGES) & ~F.exists("coord", lambda c: F.exists(c, lambda v: v.isNull()) | (F.size(c) < 2)))
        if not large.isEmpty():
            rest = areas.join(large.select("coord").distinct(), "coord", "left_anti").select(*areas.columns)
            small = append_areas(df, rest, points, None, max_broadcast_bytes)
            return _append_large(small, large, points, default)
    shapes = _shapes(areas)
    width, height, size = _grid(shapes)
    listed = shapes.select(
        F.explode(F.sequence(_cell(F.col("x0"), width), _cell(F.col("x1"), width))).alias("__cx"),
        "y0", "y1", "name", "edges",
    ).select(
        "__cx",
        F.explode(F.sequence(_cell(F.col("y0"), height), _cell(F.col("y1"), height))).alias("__cy"),
        "name", "edges",
    )
    small = size <= max_broadcast_bytes
    if small or df.isStreaming:
        cells = listed.groupBy("__cx", "__cy").agg(F.collect_list(F.struct("name", "edges")).alias("__areas"))
        for name, (lon, lat) in points.items():
            df = _look_up(df, F.broadcast(cells) if small else cells.hint("merge"), name, lon, lat, width, height, default)
        return df
    for name, (lon, lat) in points.items():
        df = _join_points(df, listed, name, lon, lat, width, height, default)
    return df


def _look_up(
    df: DataFrame, cells: DataFrame, name: str, lon: str, lat: str, width: float, height: float, default: str | None
) -> DataFrame:
    columns = df.columns
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    keyed = df.withColumns({"__px": _cell(x, width), "__py": _cell(y, height)})
    near = keyed.join(cells, (F.col("__px") == F.col("__cx")) & (F.col("__py") == F.col("__cy")), "left")
    inside = F.filter("__areas", lambda a: point_in_polygon(x, y, a["edges"]))
    found = F.array_max(F.transform(inside, lambda a: a["name"]))
    return near.select(*columns, F.coalesce(found, F.lit(default)).alias(name))


def _join_points(
    df: DataFrame, listed: DataFrame, name: str, lon: str, lat: str, width: float, height: float, default: str | None
) -> DataFrame:
    columns = df.columns
    x, y = F.col("__x"), F.col("__y")
    lon, lat = F.col(lon).cast("double"), F.col(lat).cast("double")
    distinct = df.select(lon.alias("__x"), lat.alias("__y")).distinct()
    hits = (
        distinct.withColumns({"__px": _cell(x, width), "__py": _cell(y, height)})
        .join(listed.hint("merge"), (F.col("__px") == F.col("__cx")) & (F.col("__py") == F.col("__cy")))
        .where(point_in_polygon(x, y, F.col("edges")))
        .groupBy("__x", "__y")
        .agg(F.max("name").alias("__name"))
    )
    return df.join(hits.hint("merge"), (lon == x) & (lat == y), "left").select(
        *columns, F.coalesce("__name", F.lit(default)).alias(name)
    )


def _append_large(df: DataFrame, areas: DataFrame, points: Mapping[str, tuple[str, str]], default: str | None) -> DataFrame:
    """The names that are there already, or of large areas that come later in the alphabet."""
    shapes = areas.groupBy("coord").agg(F.max("name").alias("name")).withColumn("area", F.md5(F.to_json("coord")))
    cells, grids = (checkpointed(part) for part in area_cells(shapes))
    width, height, _ = _grid(grids.withColumn("edges", F.array()))
    listed = grids.withColumn("__cx", F.explode(F.sequence(_cell(F.col("x0"), width), _cell(F.col("x1"), width))))
    listed = listed.withColumn("__cy", F.explode(F.sequence(_cell(F.col("y0"), height), _cell(F.col("y1"), height))))
    for name, (lon, lat) in points.items():
        columns = df.columns
        x, y = F.col("__x"), F.col("__y")
        lon, lat = F.col(lon).cast("double"), F.col(lat).cast("double")
        distinct = df.select(lon.alias("__x"), lat.alias("__y")).distinct()
        near = distinct.withColumns({"__px": _cell(x, width), "__py": _cell(y, height)}).join(
            listed,
            (F.col("__px") == F.col("__cx")) & (F.col("__py") == F.col("__cy"))
            & x.between(F.col("x0"), F.col("x1")) & y.between(F.col("y0"), F.col("y1")),
        )
        cx, cy = cell_of(x, y)
        placed = near.select("__x", "__y", "name", "area", cx.alias("cx"), cy.alias("cy"))
        hits = placed.join(cells, ["area", "cx", "cy"]).where(inside_cell(x, y)).groupBy("__x", "__y").agg(F.max("name").alias("__large"))
        both = F.coalesce(F.array_max(F.array(F.col(name), F.col("__large"))), F.lit(default))
        df = df.join(hits, (lon == x) & (lat == y), "left").withColumn(name, both).select(*columns)
    return df
