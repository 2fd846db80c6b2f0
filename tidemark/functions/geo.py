"""Points and polygons as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def polygon_edges(coord: Column | str) -> Column:
    """Edges of a polygon given as an array of [x, y] corners, each corner joined to the one before it.

    Level edges are left out: a horizontal ray never crosses them.
    """
    coord = F.col(coord) if isinstance(coord, str) else coord
    n = F.size(coord)

    def edge(corner: Column, i: Column) -> Column:
        before = F.get(coord, F.when(i == 0, n - 1).otherwise(i - 1))
        return F.struct(
            F.get(corner, F.lit(0)).alias("x"),
            F.get(corner, F.lit(1)).alias("y"),
            F.get(before, F.lit(0)).alias("px"),
            F.get(before, F.lit(1)).alias("py"),
        )

    return F.filter(F.transform(coord, edge), lambda e: e["y"] != e["py"])


def point_in_polygon(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd rule: a point is inside when a ray to its right crosses an odd number of edges.

    A corner is inside or outside as the crossing test has it; a missing coordinate is outside.
    """

    def crosses(e: Column) -> Column:
        at = e["x"] + (e["px"] - e["x"]) * (y - e["y"]) / (e["py"] - e["y"])
        return ((e["y"] > y) != (e["py"] > y)) & (x < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1
