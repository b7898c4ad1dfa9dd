"""Grids over boundaries, points to cells, points to polygons.

A boundary is a frame with polygon key columns and a closed ``ring`` per row
(see ``scan_geojson``). Cell indices make every spatial join an equi join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_engine.functions.geo import GridSpec, inside_cell, ring_edges
from incident_engine.operators.joins import join_keyed
from incident_engine.schemas import CELL_SIZE
from incident_engine.session import materialize

_COLUMN_BLOCK = 1024


def boundary_extent(boundary: DataFrame) -> DataFrame:
    """One row: least and greatest x and y over all ring points."""
    return boundary.selectExpr(
        "min(array_min(ring.x)) as xmin", "min(array_min(ring.y)) as ymin",
        "max(array_max(ring.x)) as xmax", "max(array_max(ring.y)) as ymax")


def grid_over(boundary: DataFrame, step: float = CELL_SIZE) -> GridSpec:
    """Grid over the boundary's extent; fetches four numbers."""
    extent = boundary_extent(boundary).first()
    if extent["xmin"] is None:
        raise ValueError("the boundary has no points")
    return GridSpec(extent["xmin"], extent["ymin"], extent["xmax"], extent["ymax"], step)


def _pieces(boundary: DataFrame, grid: GridSpec, keys: list[str]) -> DataFrame:
    """Edges cut at grid rows and columns: ``keys, iy, ix, edge, crosses``.

    A row per edge and closed cell that it meets, so in proportion to the edges. What lies beyond
    the grid at the left or right is put into the columns -1 and nx. ``crosses`` is 1 in the one
    column, its left side open and its right side closed, in which the edge passes the middle of
    the row.
    """
    bottom, top = grid.bottom(), grid.box()["ymax"]
    middle = grid.middle()
    low_y, high_y = "least(y1, y2)", "greatest(y1, y2)"
    rows = grid.rows_between(f"{grid.y_index(low_y)} - 1", f"{grid.y_index(high_y)} + 1")

    def x_at(y: str) -> str:
        return (f"case {y} when y1 then x1 when y2 then x2 "
                f"else x1 + ({y} - y1) * ((x2 - x1) / (y2 - y1)) end")

    enter, leave = x_at(f"greatest({low_y}, {bottom})"), x_at(f"least({high_y}, {top})")
    before, after = f"({grid.x_index('low')} - 1)", f"({grid.x_index('high')} + 1)"
    held = lambda ix: f"least(greatest({ix}, -1L), {grid.nx}L)"
    return (
        boundary.selectExpr(*keys, f"inline({ring_edges()})")
        .selectExpr("*", f"explode({rows}) as iy")
        .where(f"{low_y} <= {top} and {high_y} >= {bottom}")
        .selectExpr(
            "*",
            f"if(y1 = y2, least(x1, x2), least({enter}, {leave})) as low",
            f"if(y1 = y2, greatest(x1, x2), greatest({enter}, {leave})) as high",
            f"if((y1 > {middle}) != (y2 > {middle}), "
            f"(x2 - x1) * ({middle} - y1) / (y2 - y1) + x1, null) as crossing")
        # A piece that ends on a column's edge meets the column beyond it too.
        .selectExpr(
            "*", f"if({grid.left(before)} + {grid.width} >= low, {before}, {before} + 1) as first",
            f"if({grid.left(after)} <= high, {after}, {after} - 1) as last",
            f"{grid.x_index('crossing')} as at")
        .selectExpr(
            "*", f"if(crossing <= {grid.left('at')}, at - 1, "
                 f"if(crossing > {grid.right('at')}, at + 1, at)) as home")
        .selectExpr("*", f"explode(sequence({held('least(first, coalesce(home, first))')}, "
                         f"{held('greatest(last, coalesce(home, last))')})) as ix")
        .selectExpr(*keys, "iy", "ix", "named_struct('x1', x1, 'y1', y1, 'x2', x2, 'y2', y2) as edge",
                    f"if(home is not null and {held('home')} = ix, 1, 0) as crosses")
    )


def polygon_cover(boundary: DataFrame, grid: GridSpec, keys: list[str]) -> DataFrame:
    """Polygons cut into grid cells: ``keys, ix, iy, edges, odd``.

    A cell on the rim keeps the edges that meet it and no others, and one bit: is the middle of its
    right side inside the polygon (an odd number of edges lies beyond it)? That and its own edges
    tell any of its points. The cells between two rim cells of a row have no edge; they are inside
    as a whole if that bit of the left one is set, and carry no edges. Write it once and reuse it.
    """
    row = Window.partitionBy(*keys, "iy").orderBy("ix")
    beyond = row.rowsBetween(1, Window.unboundedFollowing)
    rim = _pieces(boundary, grid, keys).groupBy(*keys, "iy", "ix").agg(
        F.collect_list("edge").alias("edges"), F.sum("crosses").alias("n"))
    rim = rim.withColumns({
        "odd": F.coalesce(F.sum("n").over(beyond), F.lit(0)) % 2 == 1,
        "next": F.coalesce(F.lead("ix").over(row), F.lit(grid.nx))})
    whole = "if(odd and next > ix + 1, sequence(ix + 1, next - 1), array())"
    return rim.selectExpr(*keys, "iy", f"""inline(concat(
        array(named_struct('ix', ix, 'edges', edges, 'odd', odd)),
        transform({whole}, x -> named_struct('ix', x, 'edges', null, 'odd', true))))""") \
        .where(f"ix between 0 and {grid.nx - 1}").select(*keys, "ix", "iy", "edges", "odd")


def cells_on_boundary(boundary: DataFrame, grid: GridSpec, keys: list[str]) -> DataFrame:
    """Grid cells ``(ix, iy)`` that touch any polygon; ``keys`` name a polygon."""
    return polygon_cover(boundary, grid, keys).select("ix", "iy").distinct()


def number_cells(cells: DataFrame) -> DataFrame:
    """Contiguous ``grid_id`` from 0, by column then row.

    Cells are numbered within their column; a running total over the columns
    gives each its start. Columns add up in blocks, so the one ordered pass
    over everything sees one row per block of columns. ``cells`` is read three
    times: hand in a written table.
    """
    before = "rows between unbounded preceding and 1 preceding"
    totals = cells.groupBy("ix").count().withColumn(
        "block", F.expr(f"cast(floor(ix / {_COLUMN_BLOCK}) as bigint)"))
    blocks = totals.groupBy("block").agg(F.sum("count").alias("total")).selectExpr(
        "block", f"coalesce(sum(total) over (order by block {before}), 0) as earlier")
    starts = totals.join(blocks, "block").selectExpr(
        "ix", "earlier + coalesce(sum(count) over "
              f"(partition by block order by ix {before}), 0) as start")
    return (
        cells.selectExpr("*", "row_number() over (partition by ix order by iy) as nth")
        .join(starts, "ix")
        .selectExpr("start + nth - 1 as grid_id", *cells.columns)
    )


def grid_cells(boundary: DataFrame, grid: GridSpec, keys: list[str]) -> DataFrame:
    """The analysis grid: kept cells with their id and box. Write it once and reuse it."""
    cells = materialize(cells_on_boundary(boundary, grid, keys), "boundary-cells")
    corners = [f"{edge} as {name}" for name, edge in grid.box().items()]
    return number_cells(cells).selectExpr("*", *corners)


def known_position(x: str = "lon", y: str = "lat") -> Column:
    """Zero stands for an unknown coordinate. Nulls pass and meet no cell later."""
    return F.expr(f"{x} is distinct from 0D and {y} is distinct from 0D")


def with_cell_index(points: DataFrame, grid: GridSpec, x: str = "lon", y: str = "lat") -> DataFrame:
    """Add ``ix, iy``: null when a coordinate is null or zero, off the grid, or on a cell edge.
    Rows without them match no cell and take no part in the shuffle of a join."""
    ix, iy = grid.x_index(x), grid.y_index(y)
    box = grid.box(ix, iy)
    strictly = (f"{x} > {box['xmin']} and {x} < {box['xmax']} "
                f"and {y} > {box['ymin']} and {y} < {box['ymax']}")
    # the cells of the last column and row may reach beyond the extent
    on_grid = f"{ix} between 0 and {grid.nx - 1} and {iy} between 0 and {grid.ny - 1}"
    usable = known_position(x, y) & F.expr(f"{on_grid} and {strictly}")
    return points.withColumns({
        "ix": F.when(usable, F.expr(ix)), "iy": F.when(usable, F.expr(iy))})


def points_to_cells(points: DataFrame, cells: DataFrame, grid: GridSpec,
                    x: str = "lon", y: str = "lat", broadcast: bool | None = None) -> DataFrame:
    """Left join of points to the cell they are strictly within (``grid_id`` or null)."""
    located = with_cell_index(points, grid, x, y)
    return join_keyed(located, cells.select("ix", "iy", "grid_id"), ["ix", "iy"], "left",
                      broadcast=broadcast).drop("ix", "iy")


def points_in_polygons(points: DataFrame, cover: DataFrame, grid: GridSpec,
                       x: str = "lon", y: str = "lat", broadcast: bool | None = None) -> DataFrame:
    """Inner join of points with the polygons that hold them; adds the cover's keys.

    Points off the grid are in no polygon: the filter on plain coordinates
    reaches the scan, and they are not shuffled.
    """
    located = points.where(grid.holds(x, y)).withColumns({
        "ix": F.expr(grid.x_index(x)), "iy": F.expr(grid.y_index(y))})
    pairs = join_keyed(located, cover, ["ix", "iy"], "inner", broadcast=broadcast)
    inside = f"edges is null or {inside_cell(grid, 'edges', 'odd', x, y)}"
    return pairs.where(inside).drop("ix", "iy", "edges", "odd")
