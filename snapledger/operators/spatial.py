"""Left join of points with the polygons that contain them.

Points and polygons meet on grid cells, so the join is an equi-join. The polygon side is
prepared by filling the grid rows between the edges, as a scan line would:

* an edge is a row of its own from the start. It is cut along the grid rows it touches and
  dealt to the cells that its part in each row touches, so however long an outline is, no
  task has to hold it once it has been read;
* a cell keeps the few edges that touch it. A ray from a point of the cell towards growing x
  may also cross edges further right, but only the number of them matters, odd or even. At
  the middle of the row it is a running sum over the cells of the row, from the right, of the
  edges that begin there. At other heights it differs by the corners in between at which an
  edge further right follows one that touches the cell; wherever both edges are further
  right, or both touch, nothing changes. What is left are a few heights, each of which becomes
  one upright edge far to the right;
* cells no edge touches lie wholly inside or wholly outside, by the same running sum. Inside
  cells need no further test, outside cells are left out.

The exact test therefore looks at a handful of edges, however long the outline is, and at
the corners as they were given. A point has one cell and a polygon covers a cell once, so no
pair shows up twice, and the grid size changes the speed but not the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions import geometry as G

# Cells are widened by this share of their size, so that a rounding difference
# between floor(x / cell) and cell * column can never lose an edge.
MARGIN = 1e-6

# First grid column for points without coordinates, beyond any real one.
NOWHERE = 2**61

# End points of the upright edges that stand for edges further right.
FAR = 1e300


def _cell(value: Column, cell: float) -> Column:
    return F.floor(value / F.lit(cell))


def _reach(x1: Column, y1: Column, x2: Column, y2: Column, low: Column, high: Column, cell: float):
    """First and last grid column that the part of an edge between two heights touches."""

    def x_at(x: Column, y: Column) -> Column:
        inner = F.greatest(low, F.least(high, y))
        slope = (x2 - x1) / F.nullif(y2 - y1, F.lit(0.0))
        return F.when(inner == y, x).otherwise(x1 + (inner - y1) * slope)

    a, b = x_at(x1, y1), x_at(x2, y2)
    return (
        F.floor(F.least(a, b) / F.lit(cell) - MARGIN),
        F.floor(F.greatest(a, b) / F.lit(cell) + MARGIN),
    )


def polygon_cells(polygons: DataFrame, geometry: str, keep: list[str], cell: float) -> DataFrame:
    """Per polygon and grid cell: ``_cx, _cy``, the kept columns, and ``_edges``, which is
    empty for a cell wholly inside. One shuffle deals the edges out, one gathers the cells of
    a grid row of a polygon."""
    spark = polygons.sparkSession
    # Numbered before they are taken apart, not after.
    whole = polygons.select(
        F.monotonically_increasing_id().alias("_polygon"), F.struct(F.lit(0).alias("_"), *keep).alias("_keep"), geometry
    )
    edges = whole.select("_polygon", "_keep", F.explode(G.linked_edges(F.col(geometry))).alias("e")).select(
        "_polygon", "_keep", "e.*"
    )
    # Boundary sets are small files with long outlines: use all cores from here.
    edges = edges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    bottom, top = F.least("y1", "y2"), F.greatest("y1", "y2")
    touched = F.sequence(F.floor(bottom / F.lit(cell) - MARGIN), F.floor(top / F.lit(cell) + MARGIN))
    middle = (F.col("_cy") + 0.5) * cell
    half = F.lit(cell / 2 * (1 + MARGIN))
    rows = edges.select("*", F.explode(touched).alias("_cy")).select(
        "*", middle.alias("_middle"), (middle - half).alias("_low"), (middle + half).alias("_high")
    )
    low, high = F.col("_low"), F.col("_high")
    rows = rows.where((bottom <= high) & (top >= low))

    def reach(i: int):
        ends = [F.col(f"{x}{j}") for j in (i, i + 1) for x in "xy"]
        return _reach(*ends, low, high, cell)

    first, last = reach(1)
    parts = rows.select(
        "_polygon",
        "_keep",
        "_cy",
        "_middle",
        F.struct("x1", "y1", "x2", "y2").alias("_edge"),
        ((F.col("y1") > F.col("_middle")) != (F.col("y2") > F.col("_middle"))).alias("_crosses"),
        # Where the edges before and after begin, if they meet this one in the row.
        F.when(F.col("y1").between(low, high), reach(0)[0]).alias("_before"),
        F.when(F.col("y2").between(low, high), reach(2)[0]).alias("_after"),
        first.alias("_first"),
        last.alias("_last"),
    )
    dealt = parts.select("*", F.explode(F.sequence("_first", "_last")).alias("_cx"))
    corners = F.array_compact(
        F.array(
            F.when(F.col("_before") > F.col("_cx"), F.col("_edge.y1")),
            F.when(F.col("_after") > F.col("_cx"), F.col("_edge.y2")),
        )
    )
    begins = F.col("_crosses") & (F.col("_first") == F.col("_cx"))
    cells = (
        dealt.repartition("_polygon", "_cy")
        .groupBy("_polygon", "_cy", "_cx")
        .agg(
            F.any_value("_keep").alias("_keep"),
            F.any_value("_middle").alias("_middle"),
            F.collect_list("_edge").alias("_near"),
            F.flatten(F.collect_list(corners)).alias("_corners"),
            F.count_if(begins).alias("_begins"),
        )
    )
    right = Window.partitionBy("_polygon", "_cy").orderBy(F.desc("_cx"))
    cells = cells.select(
        "*",
        F.coalesce(F.sum("_begins").over(right.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_crossed"),
        F.lag("_cx").over(right).alias("_next"),
    )
    above = F.size(F.filter("_corners", lambda y: y > F.col("_middle")))
    heights = F.when((F.col("_crossed") + above) % 2 == 1, F.array_append("_corners", F.lit(FAR))).otherwise(F.col("_corners"))
    upright = F.transform(
        heights,
        lambda y: F.struct(
            F.lit(FAR).alias("x1"), y.alias("y1"), F.lit(FAR).alias("x2"), F.lit(-FAR).alias("y2")
        ),
    )
    own = F.struct(F.col("_cx").alias("_cx"), F.concat("_near", upright).alias("_edges"))
    between = F.when(
        (F.col("_crossed") % 2 == 1) & (F.col("_next") > F.col("_cx") + 1),
        F.sequence(F.col("_cx") + 1, F.col("_next") - 1),
    )
    inside = F.transform(between, lambda x: F.struct(x.alias("_cx"), F.slice("_near", 1, 0).alias("_edges")))
    filled = cells.select("_keep", "_cy", F.inline(F.concat(F.array(own), F.coalesce(inside, F.array()))))
    return filled.select(*[F.col("_keep")[c].alias(c) for c in keep], "_cx", "_cy", "_edges")


def spatial_left_join(
    points: DataFrame,
    point: str,
    polygons: DataFrame,
    geometry: str,
    take: dict[str, str],
    cell: float,
) -> DataFrame:
    """All points, with the columns ``take`` ({new name: polygon column}) of every
    polygon they lie strictly inside, or NULLs.

    Nothing runs while the join is defined. Both sides are shuffled on the cell. The cells
    are estimated from the polygons' file, which is far smaller than what is filled from it,
    and a broadcast once planned is not taken back: every task would hold all cells.
    """
    named = polygons.select(
        *[F.col(c).alias(n) for n, c in take.items()], F.col(geometry).alias("_geometry")
    )
    cells = polygon_cells(named, "_geometry", list(take), cell).hint("merge")
    x, y = F.col(point)["lon"], F.col(point)["lat"]
    # Points without coordinates get columns no polygon reaches, many of them, so that
    # a shuffle does not send them all to one task.
    nowhere = F.lit(NOWHERE) + F.shiftrightunsigned(F.xxhash64(*points.columns), 3)
    located = points.withColumns(
        {"_px": F.coalesce(_cell(x, cell), nowhere), "_py": F.coalesce(_cell(y, cell), F.lit(0))}
    )
    condition = (
        (F.col("_px") == F.col("_cx"))
        & (F.col("_py") == F.col("_cy"))
        & ((F.size("_edges") == 0) | G.inside_edges(F.col("_edges"), x, y))
    )
    return located.join(cells, condition, "left").drop("_px", "_py", "_cx", "_cy", "_edges")
