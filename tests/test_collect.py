"""Work list, requests, and collection by polygon and month."""

import pytest
from pyspark.sql import functions as F

from incident_engine.functions.geo import GridSpec
from incident_engine.operators import spatial
from incident_engine.plans import collect

GRID = GridSpec(0.0, 0.0, 2.0, 1.0, 0.25)


@pytest.fixture(scope="module")
def cover(spark):
    squares = [(name, [{"x": x, "y": y} for x, y in
                       [(o, 0.0), (o + 0.6, 0.0), (o + 0.6, 0.6), (o, 0.6), (o, 0.0)]])
               for name, o in [("a", 0.05), ("b", 1.05)]]
    frame = spark.createDataFrame(squares, "neighbourhood string, ring array<struct<x: double, y: double>>")
    return spatial.polygon_cover(frame, GRID, ["neighbourhood"])


def test_worklist(spark):
    forces = spark.createDataFrame([("f",), ("g",), ("none",)], "force string")
    hoods = spark.createDataFrame([("f", "1"), ("f", "2"), ("g", "1")], "force string, neighbourhood string")
    rows = collect.worklist(forces, hoods, ["2024-01", "2024-02"]).collect()
    assert sorted(tuple(r) for r in rows) == sorted(
        (f, n, m) for f, n in [("f", "1"), ("f", "2"), ("g", "1")] for m in ["2024-01", "2024-02"])


def test_worklist_spreads_the_months_of_a_force(spark):
    """One force with many neighbourhoods: its rows must not meet in one task of the next step."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        forces = spark.createDataFrame([("f",)], "force string")
        hoods = spark.createDataFrame([("f", str(n)) for n in range(64)], "force string, neighbourhood string")
        months = [f"2024-0{m}" for m in range(1, 5)]
        chosen = collect.worklist(forces, hoods, months).select("force", "neighbourhood", "month").distinct()
        sizes = chosen.rdd.glom().map(len).collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 256
    assert max(sizes) < 256


def test_no_request_for_an_empty_polygon(spark):
    work = spark.createDataFrame([("f", "1", "m"), ("f", "2", "m")], "force string, neighbourhood string, month string")
    polygons = spark.createDataFrame([("f", "1", ""), ("f", "2", "1,2:1,2")],
                                     "force string, neighbourhood string, poly string")
    assert [r["neighbourhood"] for r in collect.requests(work, polygons).collect()] == ["2"]


def test_all_incidents_of_a_polygon_are_collected(spark, cover):
    """Also of one with many more than a request to the feed's service would return."""
    sizes = {("a", "m1"): 10_000, ("a", "m2"): 10_001, ("b", "m1"): 3}
    points = None
    for (name, month), n in sizes.items():
        x = 0.3 if name == "a" else 1.3
        part = spark.range(n).select(F.lit(x).alias("lon"), F.lit(0.3).alias("lat"), F.lit(month).alias("month"), "id")
        points = part if points is None else points.union(part)
    outside = spark.range(50).selectExpr("1.9D as lon", "0.9D as lat", "'m1' as month", "id")
    got = collect.collect_in_polygons(points.union(outside), cover, GRID)
    counts = {(r["neighbourhood"], r["month"]): r["count"]
              for r in got.groupBy("neighbourhood", "month").count().collect()}
    assert counts == sizes
    assert set(got.columns) == {"neighbourhood", "month", "lon", "lat", "id"}
    work = spark.createDataFrame([("a", "m2"), ("a", "m2"), ("b", "m9")], "neighbourhood string, month string")
    chosen = collect.collect_by_worklist(points, work, cover, GRID, ["neighbourhood"])
    assert chosen.count() == 10_001
