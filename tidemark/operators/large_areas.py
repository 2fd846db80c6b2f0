"""Point in polygon for areas with very many corners.

An area's box is cut into a grid of its own, finer the more corners it has. What a ray to the right of a point meets depends, for all
points of a cell, on three things: the edges that reach into the cell's column and row (``edges``, tested as they are), the edges wholly
right of the cell, and those wholly left, which count for nothing. An edge wholly to the right is crossed when one of its ends is above the point and
the other is not, whatever ``x`` is; in the sum over a run of such edges every corner between two of them cancels out. So only corners
where such a run begins or ends are left: those above the cell's row are a parity, and those in its row are heights to compare with (``levels``).
The result is that of testing all edges, bit by bit.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import point_in_polygon

#: Areas with more edges than this are cut up; cells are so many that about this many corners fall into one row of them.
MANY_EDGES = 64
#: Rows and columns of an area's grid are no more than this.
MOST_CELLS = 512


def _margin(value: Column) -> Column:
    """More than what rounding in the crossing test can move a crossing by."""
    return (F.abs(value) + 1) * F.lit(1e-12)


def _index(value: Column, start: Column, width: Column) -> Column:
    return F.floor((value - start) / width).cast("long")


def area_cells(areas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells of areas (``area``, ``name``, ``coord``) in which a point may be inside: area, cx, cy, edges, parity, levels; and their
    grids: area, name, x0, x1, y0, y1, w, h, n. The cells hold an edge once for each cell it reaches into."""
    corner = lambda c, i: F.get(F.get("coord", c), F.lit(i))
    n = F.size("coord")
    boxed = areas.select(
        "area", "name", "coord", n.cast("long").alias("corners"),
        F.array_min(F.transform("coord", lambda c: F.get(c, F.lit(0)))).alias("left"),
        F.array_max(F.transform("coord", lambda c: F.get(c, F.lit(0)))).alias("right"),
        F.array_min(F.transform("coord", lambda c: F.get(c, F.lit(1)))).alias("y0"),
        F.array_max(F.transform("coord", lambda c: F.get(c, F.lit(1)))).alias("y1"),
    )
    side = F.least(F.greatest(F.ceil(F.sqrt(F.col("corners") / F.lit(2.0))), F.lit(1)), F.lit(MOST_CELLS)).cast("long")
    boxed = boxed.withColumns({"n": side, "x0": F.col("left") - _margin(F.col("left")), "x1": F.col("right") + _margin(F.col("right"))})
    # an area without height or width has no inside, but cells need a size
    boxed = boxed.withColumns({"w": F.greatest((F.col("x1") - F.col("x0")) / F.col("n"), F.lit(1e-300)), "h": F.greatest((F.col("y1") - F.col("y0")) / F.col("n"), F.lit(1e-300))})
    grids = boxed.select("area", "name", "x0", "x1", "y0", "y1", "w", "h", "n")

    before = F.when(F.col("i") == 0, n - 1).otherwise(F.col("i") - 1)
    edges = boxed.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("i")).select(
        "area", "i", "corners", "x0", "y0", "w", "h", "n",
        corner(F.col("i"), 0).alias("x"), corner(F.col("i"), 1).alias("y"), corner(before, 0).alias("px"), corner(before, 1).alias("py"),
    )
    low, high = F.least("x", "px"), F.greatest("x", "px")
    column = lambda v: F.least(F.greatest(_index(v, F.col("x0"), F.col("w")), F.lit(0)), F.col("n") - 1)
    row = lambda v: F.least(F.greatest(_index(v, F.col("y0"), F.col("h")), F.lit(0)), F.col("n") - 1)
    edges = edges.withColumns({"first": column(low - _margin(low)), "last": column(high + _margin(high))})
    reached = (
        edges.where("y <> py")
        .withColumn("cy", F.explode(F.sequence(row(F.least("y", "py")), row(F.greatest("y", "py")))))
        .withColumn("cx", F.explode(F.sequence("first", "last")))
        .select("area", "cx", "cy", F.struct("x", "y", "px", "py").alias("edge"))
    )
    # a corner is the end of edge i and the beginning of edge i + 1
    ends = edges.select("area", "i", "n", "y", row(F.col("y")).alias("cy"), F.col("first").alias("one"))
    begins = edges.select("area", F.when(F.col("i") == 0, F.col("corners") - 1).otherwise(F.col("i") - 1).cast("int").alias("i"), F.col("first").alias("two"))
    turns = (
        ends.join(begins, ["area", "i"])
        .where("one <> two")
        .withColumn("cx", F.explode(F.sequence(F.least("one", "two"), F.greatest("one", "two") - 1)))
    )
    at_height = turns.groupBy("area", "cx", "cy", "y").agg((F.count("*") % 2).alias("odd")).where("odd = 1").select("area", "cx", "cy", "y")
    # of a column's corners with odd count in a row, those above each row
    by_row = turns.groupBy("area", "cx", "cy").agg((F.count("*") % 2).alias("odd")).where("odd = 1 AND cy > 0")
    columns = by_row.groupBy("area", "cx").agg(F.collect_list("cy").alias("rows"))
    below = F.sequence(F.lit(0).cast("long"), F.array_max("rows") - 1)
    odd = F.filter(below, lambda cy: F.size(F.filter("rows", lambda r: r > cy)) % 2 == 1)
    above = columns.select("area", "cx", F.explode(odd).alias("cy"))
    nothing = F.lit(None)
    kind = "struct<x:double,y:double,px:double,py:double>"
    parts = (
        reached.select("area", "cx", "cy", "edge", nothing.cast("double").alias("y"), F.lit(0).alias("over"))
        .unionByName(at_height.select("area", "cx", "cy", nothing.cast(kind).alias("edge"), "y", F.lit(0).alias("over")))
        .unionByName(above.select("area", "cx", "cy", nothing.cast(kind).alias("edge"), nothing.cast("double").alias("y"), F.lit(1).alias("over")))
    )
    cells = parts.groupBy("area", "cx", "cy").agg(
        F.collect_list("edge").alias("edges"), (F.sum("over") % 2).alias("parity"), F.collect_list("y").alias("levels")
    )
    return cells.where((F.col("parity") == 1) | (F.size("edges") > 0) | (F.size("levels") > 0)), grids


def inside_cell(x: Column, y: Column, cell: str = "") -> Column:
    """Whether a point of the cell is inside its area."""
    edges, parity, levels = (F.col(f"{cell}{c}") for c in ("edges", "parity", "levels"))
    crossed = point_in_polygon(x, y, edges).cast("int") + parity + F.size(F.filter(levels, lambda level: level > y))
    return crossed % 2 == 1


def cell_of(x: Column, y: Column) -> tuple[Column, Column]:
    """Column and row of a point in the grid whose columns are at hand, for a point in its box."""
    last = F.col("n") - 1
    return F.least(_index(x, F.col("x0"), F.col("w")), last), F.least(_index(y, F.col("y0"), F.col("h")), last)
