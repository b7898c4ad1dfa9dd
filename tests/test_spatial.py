"""Grid and polygon operators against brute force, with points on edges."""

import random

import pytest
from pyspark.sql import functions as F

from incident_engine.functions.geo import GridSpec
from incident_engine.operators import spatial

KEYS = ["polygon_id"]
# Exact binary coordinates, so that edges are exactly where they seem to be.
BINARY = GridSpec(0.0, 0.0, 2.0, 2.0, 0.25)


def boundary(spark, *polygons):
    """Each polygon is a list of rings, each ring a list of points (closed here)."""
    rows = [
        (i, n, [{"x": float(x), "y": float(y)} for x, y in [*ring, ring[0]]])
        for i, rings in enumerate(polygons) for n, ring in enumerate(rings)
    ]
    return spark.createDataFrame(
        rows, "polygon_id long, ring_no int, ring array<struct<x: double, y: double>>")


def crossings(ring, x, y):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def inside_polygon(rings, x, y):
    return sum(crossings(ring, x, y) for ring in rings) % 2 == 1


def segment_meets_box(p, q, box):
    """Separating axis test of a segment and a closed box."""
    (x1, y1), (x2, y2) = p, q
    x_low, y_low, x_high, y_high = box
    if max(x1, x2) < x_low or min(x1, x2) > x_high or max(y1, y2) < y_low or min(y1, y2) > y_high:
        return False
    sides = [(x2 - x1) * (cy - y1) - (y2 - y1) * (cx - x1)
             for cx in (x_low, x_high) for cy in (y_low, y_high)]
    return not (all(s > 0 for s in sides) or all(s < 0 for s in sides))


def cells_by_hand(polygons, grid):
    kept = set()
    for ix in range(grid.nx):
        for iy in range(grid.ny):
            x, y = grid.xmin + ix * grid.step, grid.ymin + iy * grid.step
            box = (x, y, x + grid.step, y + grid.step)
            for rings in polygons:
                met = any(segment_meets_box(p, q, box) for ring in rings
                          for p, q in zip(ring, [*ring[1:], ring[0]]))
                if met or inside_polygon(rings, x + grid.step / 2, y + grid.step / 2):
                    kept.add((ix, iy))
    return kept


def star(rng, cx, cy, size, points):
    """A simple polygon: radii at rising angles."""
    import math
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(points))
    return [(cx + rng.uniform(0.2, 1) * size * math.cos(a), cy + rng.uniform(0.2, 1) * size * math.sin(a))
            for a in angles]


POLYGONS = {
    "square on grid lines": [[[(0.5, 0.5), (1.0, 0.5), (1.0, 1.0), (0.5, 1.0)]]],
    "triangle": [[[(0.1, 0.1), (1.9, 0.3), (0.7, 1.8)]]],
    "inside one cell": [[[(0.3, 0.3), (0.4, 0.3), (0.4, 0.4)]]],
    "with a hole": [[[(0.1, 0.1), (1.9, 0.1), (1.9, 1.9), (0.1, 1.9)],
                     [(0.6, 0.6), (1.4, 0.6), (1.4, 1.4), (0.6, 1.4)]]],
    "two apart": [[[(0.1, 0.1), (0.3, 0.1), (0.3, 0.3)]], [[(1.6, 1.6), (1.9, 1.6), (1.6, 1.9)]]],
    "slanted needle": [[[(0.05, 0.05), (1.95, 1.9), (1.95, 1.95)]]],
}


@pytest.mark.parametrize("name", POLYGONS)
def test_cells_on_boundary(spark, name):
    polygons = POLYGONS[name]
    cells = spatial.cells_on_boundary(boundary(spark, *polygons), BINARY, KEYS)
    got = [(r["ix"], r["iy"]) for r in cells.collect()]
    assert len(got) == len(set(got))
    assert set(got) == cells_by_hand(polygons, BINARY)


def test_touching_counts_as_meeting(spark):
    cells = spatial.cells_on_boundary(boundary(spark, *POLYGONS["square on grid lines"]), BINARY, KEYS)
    got = {(r["ix"], r["iy"]) for r in cells.collect()}
    assert got == {(ix, iy) for ix in range(1, 5) for iy in range(1, 5)}


@pytest.mark.parametrize("seed", range(3))
def test_random_polygons(spark, seed):
    rng = random.Random(seed)
    polygons = [[star(rng, rng.uniform(-1, 1), rng.uniform(-1, 1), 0.8, 12)] for _ in range(4)]
    frame = boundary(spark, *polygons)
    grid = spatial.grid_over(frame, 0.11)
    cells = spatial.cells_on_boundary(frame, grid, KEYS)
    assert {(r["ix"], r["iy"]) for r in cells.collect()} == cells_by_hand(polygons, grid)

    points = [(i, rng.uniform(-2, 2), rng.uniform(-2, 2)) for i in range(2000)]
    cover = spatial.polygon_cover(frame, grid, KEYS)
    found = spatial.points_in_polygons(
        spark.createDataFrame(points, "id long, lon double, lat double"), cover, grid)
    got = sorted((r["id"], r["polygon_id"]) for r in found.collect())
    assert got == sorted((i, n) for i, x, y in points for n, rings in enumerate(polygons)
                         if inside_polygon(rings, x, y))
    # Some cells lie within as a whole and carry no edges.
    assert cover.filter("edges is null").count() > 0


def test_point_in_hole_is_outside(spark):
    frame = boundary(spark, *POLYGONS["with a hole"])
    cover = spatial.polygon_cover(frame, BINARY, KEYS)
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 0.3, 1.0), (3, 1.7, 1.0), (4, 3.0, 1.0)],
                                   "id long, lon double, lat double")
    got = spatial.points_in_polygons(points, cover, BINARY)
    assert sorted(r["id"] for r in got.collect()) == [2, 3]


def test_extent_and_grid_size(spark):
    frame = boundary(spark, *POLYGONS["two apart"])
    row = spatial.boundary_extent(frame).first()
    assert tuple(row) == (0.1, 0.1, 1.9, 1.9)
    grid = GridSpec(0.0, 0.0, 1.0, 1.1, 0.25)
    assert (grid.nx, grid.ny) == (4, 5)
    with pytest.raises(ValueError, match="no points"):
        spatial.grid_over(frame.filter("polygon_id < 0"))


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_ids_are_contiguous_by_column_then_row(spark, monkeypatch, block):
    monkeypatch.setattr(spatial, "_COLUMN_BLOCK", block)
    rng = random.Random(block)
    cells = sorted({(rng.randrange(20), rng.randrange(30)) for _ in range(200)})
    frame = spark.createDataFrame(rng.sample(cells, len(cells)), "ix long, iy long")
    got = {(r["ix"], r["iy"]): r["grid_id"] for r in spatial.number_cells(frame).collect()}
    assert got == {cell: i for i, cell in enumerate(cells)}


def test_point_on_a_cell_edge_is_in_no_cell(spark):
    cells = spark.sql("select ix, iy, ix * 8 + iy as grid_id from "
                      "(select explode(sequence(0L, 7L)) as ix), (select explode(sequence(0L, 7L)) as iy)")
    where = {
        "inside": (0.3, 0.3), "left": (0.25, 0.3), "right": (0.5, 0.3), "bottom": (0.3, 0.25),
        "top": (0.3, 0.5), "corner": (0.5, 0.5), "outside": (5.0, 0.3), "below": (-0.1, 0.3),
        "null": (None, 0.3), "zero": (0.0, 0.3), "zero lat": (0.3, 0.0),
    }
    points = spark.createDataFrame([(k, *v) for k, v in where.items()], "k string, lon double, lat double")
    for broadcast in (True, False):
        got = spatial.points_to_cells(points, cells, BINARY, broadcast=broadcast).collect()
        assert len(got) == len(where)
        assert {r["k"]: r["grid_id"] for r in got if r["grid_id"] is not None} == {"inside": 9}


def test_known_position_passes_null(spark):
    points = spark.createDataFrame([(None, 1.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)], "lon double, lat double")
    kept = points.filter(spatial.known_position()).collect()
    assert [r["lon"] for r in kept] == [None, 1.0]


def test_every_inside_point_meets_one_cell(spark, small):
    from incident_engine.catalog import feeds
    frame = feeds.precinct_boundary(spark, small)
    grid = spatial.grid_over(frame)
    cells = spatial.grid_cells(frame, grid, feeds.PRECINCT)
    points = feeds.feed(spark, small, "inc")
    located = spatial.points_to_cells(points, cells, grid)
    assert located.count() == points.count()
    cover = spatial.polygon_cover(frame, grid, feeds.PRECINCT)
    inside = spatial.points_in_polygons(points.select("lon", "lat"), cover, grid)
    lost = spatial.points_to_cells(inside, cells, grid).filter(F.col("grid_id").isNull())
    assert inside.count() > 0 and lost.count() == 0


@pytest.mark.parametrize("name", POLYGONS)
@pytest.mark.parametrize("grid", [BINARY, GridSpec(0.5, 0.25, 1.25, 1.5, 0.25)], ids=["whole", "part"])
def test_points_on_a_lattice_equal_the_rule_over_all_edges(spark, name, grid):
    """Points on grid lines, on vertices' heights and on edges; also where the grid is but a part
    of the polygons, whose edges beyond it decide as well."""
    polygons = POLYGONS[name]
    lattice = [(i / 16, j / 16) for i in range(33) for j in range(33)]
    lattice += [(x, y) for rings in polygons for ring in rings for x, y in ring]
    points = [(n, x, y) for n, (x, y) in enumerate(lattice)
              if grid.xmin <= x < grid.xmax and grid.ymin <= y < grid.ymax]
    cover = spatial.polygon_cover(boundary(spark, *polygons), grid, KEYS)
    found = spatial.points_in_polygons(
        spark.createDataFrame(points, "id long, lon double, lat double"), cover, grid)
    assert sorted((r["id"], r["polygon_id"]) for r in found.collect()) == sorted(
        (i, n) for i, x, y in points for n, rings in enumerate(polygons)
        if inside_polygon(rings, x, y))


def test_edge_copies_grow_with_the_vertices_alone(spark):
    """A ring of 100,000 vertices: an edge is copied to the cells that it meets, and a cell has its
    own edges only, however many lie beside it in its row."""
    import math
    n = 100_000
    ring = [(5 + (4 + 0.4 * math.sin(300 * a)) * math.cos(a), 5 + (4 + 0.4 * math.sin(300 * a)) * math.sin(a))
            for a in (2 * math.pi * i / n for i in range(n))]
    frame = boundary(spark, [ring])
    grid = GridSpec(0.0, 0.0, 10.0, 10.0, 0.05)
    cover = spatial.polygon_cover(frame, grid, KEYS).cache()
    copies, most = cover.selectExpr("sum(size(edges))", "max(size(edges))").first()
    assert n <= copies < 1.3 * n and most < 200
    rng = random.Random(4)
    points = [(i, rng.uniform(0, 10), rng.uniform(0, 10)) for i in range(3000)]
    found = spatial.points_in_polygons(
        spark.createDataFrame(points, "id long, lon double, lat double"), cover, grid)
    def inside(x, y):
        a = math.atan2(y - 5, x - 5)
        return math.hypot(x - 5, y - 5) - (4 + 0.4 * math.sin(300 * a))
    sure = {i: inside(x, y) < 0 for i, x, y in points if abs(inside(x, y)) > 1e-3}
    got = {r["id"] for r in found.collect()}
    assert len(sure) > 2900 and {i for i in sure if i in got} == {i for i in sure if sure[i]}


def test_rows_off_the_grid_stay_out_of_the_join(spark):
    """Nine points in ten are off the grid, half of the others in one cell."""
    cells = spark.sql("select ix, iy, ix * 8 + iy as grid_id from "
                      "(select explode(sequence(0L, 7L)) as ix), (select explode(sequence(0L, 7L)) as iy)")
    points = spark.range(0, 20_000, 1, 8).selectExpr(
        "id", "case when id % 10 > 0 then 50 + id when id % 20 = 0 then 0.3 else (id % 199) / 100 + 0.001 end lon",
        "case when id % 20 = 0 then 0.3 else (id % 197) / 100 + 0.001 end lat")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = spatial.points_to_cells(points, cells, BINARY, broadcast=False)
        assert got.count() == 20_000 and got.filter("grid_id = 9").count() >= 1000
        located = spatial.with_cell_index(points, BINARY)
        assert located.filter("id % 10 > 0 and ix is not null").isEmpty()
        inside = got.filter("grid_id is not null")
        sizes = [r["count"] for r in inside.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.4 * sum(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_last_cells_reach_beyond_the_extent(spark):
    grid = GridSpec(0.0, 0.0, 0.6, 0.6, 0.25)
    cells = spark.sql("select ix, iy, ix * 3 + iy as grid_id from "
                      "(select explode(sequence(0L, 2L)) as ix), (select explode(sequence(0L, 2L)) as iy)")
    points = spark.createDataFrame([("in", 0.7, 0.7), ("edge", 0.75, 0.7), ("out", 0.8, 0.7),
                                    ("under", 0.7, -0.1)], "k string, lon double, lat double")
    got = {r["k"]: r["grid_id"] for r in spatial.points_to_cells(points, cells, grid).collect()}
    assert got == {"in": 8, "edge": None, "out": None, "under": None}
