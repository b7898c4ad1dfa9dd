"""Compositions from files to files, and the shape of the physical plans."""

import datetime as dt
import json
import os
import random

import pytest
from conftest import SMALL
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from incident_engine.catalog import feeds
from incident_engine.catalog.queries import QUERIES
from incident_engine.functions.geo import GridSpec
from incident_engine.operators import spatial
from incident_engine.plans import collect, incidents
from incident_engine.plans.forecast import forecast_from_files
from incident_engine.plans.hotspot import hot_spots_from_files
from incident_engine.session import CHECKPOINT_KEY, materialize, workspace_dir
from incident_engine.sources.messages import MessageSource


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_and_no_row_udfs(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for node in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "Scan ExistingRDD"):
        assert node not in plan


@pytest.mark.parametrize("name", ["unified_incidents", "chi_sink_layout", "sea_format",
                                  "archive_merge", "pull_since_mark", "sink_keyed_json"])
def test_row_work_does_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SMALL))


def test_hot_spots_shuffle_once_by_cell(spark):
    plan = plan_of(QUERIES["hotspot_rank"](spark, SMALL))
    assert plan.count("Exchange hashpartitioning") == 1 and "TakeOrderedAndProject" in plan


def test_series_windows_share_one_shuffle(spark):
    plan = plan_of(QUERIES["forecast_mse"](spark, SMALL))
    assert plan.count("Exchange hashpartitioning") == 2  # the count, then the area


def test_only_the_columns_in_use_are_read(spark):
    plan = plan_of(QUERIES["area_month_counts"](spark, SMALL))
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_extent_filter_reaches_the_scan(spark, tmp_path):
    points = feeds.feed(spark, SMALL, "inc").select("lon", "lat")
    points.write.parquet(str(tmp_path / "points"))
    frame = feeds.precinct_boundary(spark, SMALL)
    grid = spatial.grid_over(frame)
    found = spatial.points_in_polygons(
        spark.read.parquet(str(tmp_path / "points")), spatial.polygon_cover(frame, grid, feeds.PRECINCT),
        grid, broadcast=True)
    assert f"GreaterThanOrEqual(lon,{grid.xmin})" in plan_of(found)


def test_hot_spots_from_files(spark, tmp_path):
    ring = [[0, 0], [0.06, 0], [0.06, 0.06], [0, 0.06], [0, 0]]
    boundary = tmp_path / "city.geojson"
    boundary.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    rng = random.Random(5)
    lines = ["ID,Date,Latitude,Longitude"]
    for month in range(16):
        for cell in range(10):
            day = dt.datetime(2020 + month // 12, month % 12 + 1, rng.randint(1, 28))
            text = day.isoformat() if cell % 2 else day.strftime("%m/%d/%Y %I:%M:%S %p")
            lines.append(f"x,{text},0.0031,{cell * 0.006 + 0.0031:.4f}")
    lines += ["bad,2020-01-01,0.0031,0.0031,too,long", "x,2020-01-01,0,0", "x,2020-01-01"]
    table = tmp_path / "incidents.csv"
    table.write_text("\n".join(lines))
    out, grid = str(tmp_path / "out"), str(tmp_path / "grid")
    for _ in range(2):
        ranked = hot_spots_from_files(spark, str(table), str(boundary), grid, out, count=4)
    assert [r["ix"] for r in ranked.orderBy("rk").collect()] == [0, 1, 2, 3]
    assert spark.read.parquet(grid).count() == 100
    part, = [f for f in os.listdir(out) if f.startswith("part")]
    document = json.loads(open(os.path.join(out, part)).read())
    assert [f["properties"]["grid_id"] for f in document["features"]] == [0, 10, 20, 30]


def test_hot_spots_rebuild_a_grid_of_another_step_or_boundary(spark, tmp_path):
    table, boundary, grid = tmp_path / "incidents.csv", tmp_path / "city.geojson", str(tmp_path / "grid")
    table.write_text("\n".join(["ID,Date,Latitude,Longitude"] + [
        f"x,2020-{month:02d}-01T00:00:00,0.0031,0.0031" for month in range(1, 13)]))
    for width, step, cells in ((0.06, 0.006, 100), (0.06, 0.012, 25), (0.03, 0.006, 25)):
        ring = [[0, 0], [width, 0], [width, width], [0, width], [0, 0]]
        boundary.write_text(json.dumps({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {},
             "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
        hot_spots_from_files(spark, str(table), str(boundary), grid, str(tmp_path / "out"), step=step)
        found = spark.read.parquet(grid)
        assert found.count() == cells
        assert found.agg({"ix": "max"}).first()[0] == round(width / step) - 1


def test_forecast_from_files(spark, tmp_path):
    lines = ["Date,Community Area"]
    for month in range(30):
        for n in range(5 + month % 12):
            lines.append(f"{month % 12 + 1:02d}/{n + 1:02d}/{2020 + month // 12} 13:00:00 PM,3.0")
    table = tmp_path / "incidents.csv"
    table.write_text("\n".join(lines))
    rate = tmp_path / "rate.csv"
    rate.write_text("year,month,AREA,unemployment_rate\n2020,1,3,4.0\n")
    for ridge in (True, False):
        model = forecast_from_files(spark, str(table), str(rate), ridge)
        rates = {r["unemployment_rate"] for r in model.features.collect()}
        assert rates == {4.0, 5.0}
        ahead = model.horizon(2022, 11, 4, rate=5.0).orderBy("ds").collect()
        assert [(r["year"], r["month"]) for r in ahead] == [(2022, 11), (2022, 12), (2023, 1), (2023, 2)]
        assert all(r["yhat"] >= 0 for r in ahead)
        assert model.mse().first()["mse"] < 60
    with pytest.raises(PySparkException, match="no unemployment_rate"):
        forecast_from_files(spark, str(table)).horizon(2022, 11, 1).collect()


def test_changes_are_sent_once(spark, tmp_path):
    table = spark.createDataFrame([("1", "2025-01-01"), (None, "2025-01-02")], "id string, updated_on string")
    sink = MessageSource("parquet", ("chi",), {"path": str(tmp_path / "out")})
    send = lambda t: collect.collect_changes(t, "updated_on", "id", str(tmp_path / "marks"), "chi", sink)
    assert (send(table), send(table)) == (2, 0)
    assert send(table.union(spark.sql("select '3', '2025-01-03'"))) == 1
    sent = spark.read.parquet(str(tmp_path / "out")).orderBy("key").collect()
    assert [(r["key"], json.loads(r["value"])["id"], r["topic"]) for r in sent] == [
        ("1", "1", "chi"), ("3", "3", "chi")]


def test_months_are_sent_to_their_topics(spark, tmp_path):
    grid = GridSpec(0.0, 0.0, 1.0, 1.0, 0.25)
    ring = [{"x": x, "y": y} for x, y in [(0.1, 0.1), (0.9, 0.1), (0.9, 0.9), (0.1, 0.9), (0.1, 0.1)]]
    frame = spark.createDataFrame([("p", ring)], "poly string, ring array<struct<x: double, y: double>>")
    cover = spatial.polygon_cover(frame, grid, ["poly"])
    points = spark.createDataFrame([(0.5, 0.5, "2024-01", 1), (0.5, 0.5, "2024-02", 2), (0.5, 0.5, "2024-03", 3),
                                    (0.95, 0.5, "2024-01", 4)], "lon double, lat double, month string, id int")
    sink = MessageSource("json", options={"path": str(tmp_path / "out")})
    collect.collect_months(points, cover, grid, ["poly"], ["2024-01", "2024-03"], sink)
    sent = spark.read.json(str(tmp_path / "out")).orderBy("topic").collect()
    assert [(r["topic"], json.loads(r["value"])["id"]) for r in sent] == [("2024-01", 1), ("2024-03", 3)]


def test_archive_is_rewritten(spark, tmp_path):
    archive = spark.createDataFrame([("1", "05/01/2025 01:02:03 PM", "05/14/2025 01:00:00 AM")],
                                    "ID string, Date string, `Updated On` string")
    messages = feeds.chi_messages(spark, SMALL)
    incidents.refresh_archive(archive, messages, "2025-05-14T01:00:00", str(tmp_path / "out"), files=1)
    df = spark.read.option("header", "true").option("escape", "\\").csv(str(tmp_path / "out"))
    assert df.count() == messages.count() + 1 and "location" in df.columns


class Session:
    """Just the parts of a session that the workspace is found by."""

    def __init__(self, master, setting=None):
        self.conf = {CHECKPOINT_KEY: setting} if setting else {}
        self.sparkContext = self
        self.master, self.applicationId, self.folder = master, "app-1", None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_workspace_is_the_folder_the_session_names():
    assert workspace_dir(Session("yarn", "hdfs://n/cp")) == "hdfs://n/cp/incident_engine/app-1"
    warehouse = Session("yarn")
    warehouse.conf["spark.sql.warehouse.dir"] = "hdfs://n/wh"
    assert workspace_dir(warehouse) == "hdfs://n/wh/incident_engine/app-1"


def test_materialized_tables_are_in_the_workspace(spark):
    df = materialize(spark.range(3), "t")
    assert df.count() == 3 and workspace_dir(spark) in df.inputFiles()[0]


def test_feeds_keep_points_off_polygon_edges(spark):
    """What the comparison of strict and closed rules rests on."""
    inc = feeds.feed(spark, SMALL, "inc").select("lon", "lat").distinct()
    micro = lambda c: F.pmod(F.round(F.col(c) * 1e6).cast("bigint"), F.lit(10))
    assert {tuple(r) for r in inc.select(micro("lon"), micro("lat")).distinct().collect()} == {(0, 0)}
    edges = feeds.feed(spark, SMALL, "precincts").select(
        *[micro(c) for c in ("xa", "xb", "xc", "ya", "yb", "yc")])
    assert {tuple(r) for r in edges.distinct().collect()} == {(5, 8, 8, 5, 8, 8)}


def test_a_rewritten_table_gets_a_grid_of_its_own(spark, tmp_path):
    """The shared grid follows the files of its tables, not their path alone."""
    from incident_engine.catalog import queries
    for table in ("supplier", "nation"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    before = QUERIES["grid_cells"](spark, str(tmp_path)).count()
    one = queries._grid(spark, str(tmp_path))[1].count()
    spark.read.parquet(f"{SMALL}/supplier.parquet").limit(2).write.mode("overwrite").parquet(
        str(tmp_path / "supplier.parquet"))
    two = queries._grid(spark, str(tmp_path))[1].count()
    assert one == before and 0 < two < one
