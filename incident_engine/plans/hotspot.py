"""Hot-spot forecast for the month after the latest incident."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine.functions import text, timestamps
from incident_engine.functions.geo import GridSpec
from incident_engine.operators import counts as op
from incident_engine.operators.spatial import grid_cells, grid_over
from incident_engine.schemas import CELL_SIZE, HIT_THRESHOLD, HOT_SPOTS
from incident_engine.session import load_or_build, materialize
from incident_engine.sinks.files import write_feature_collection
from incident_engine.sources.files import path_exists, scan_csv_skip_long, scan_geojson

CELL = ["grid_id", "ix", "iy"]


@dataclass(frozen=True)
class HotSpotModel:
    """Counts of one input on one grid, scanned once and shared by all outputs."""

    counts: DataFrame
    on_grid: DataFrame
    calendar: bool = False
    all_cells: DataFrame | None = None

    @classmethod
    def fit(cls, points: DataFrame, cells: DataFrame, grid: GridSpec, time: str = "occurred_at",
            x: str = "lon", y: str = "lat", calendar: bool = False, all_cells: bool = False
            ) -> HotSpotModel:
        """Scan the points. The counts, a small table, are written and reused."""
        counted = op.name_cells(op.cell_month_counts(points, grid, time, x, y), cells)
        counts = materialize(counted, "cell-month-counts")
        return cls(counts, op.counts_on_grid(counts), calendar, cells if all_cells else None)

    @property
    def forecast_month(self) -> Column:
        return F.add_months(self.previous_month, 1)

    @property
    def previous_month(self) -> Column:
        return op.latest_month(self.counts)

    def dense(self) -> DataFrame:
        return op.dense_counts(self.on_grid, CELL, self.calendar, self.all_cells)

    def scored(self, threshold: float = HIT_THRESHOLD) -> DataFrame:
        return op.trailing_scores(self.dense(), CELL, threshold=threshold)

    def cell_scores(self, threshold: float = HIT_THRESHOLD) -> DataFrame:
        axis = op.month_axis(self.on_grid, self.calendar)
        return op.cell_scores(self.scored(threshold), CELL, self.previous_month, axis)

    def rank(self, count: int = HOT_SPOTS, threshold: float = HIT_THRESHOLD) -> DataFrame:
        return op.top_cells(self.cell_scores(threshold), count)


def hot_cells(cells: DataFrame, ranked: DataFrame) -> DataFrame:
    """Grid cells that are in the ranked list.

    Spark knows the list's length from its limit and picks the join by it.
    """
    return cells.join(ranked.select("grid_id"), "grid_id", "left_semi")


POLYGON = ["polygon_id", "part_no"]


def incident_points(table: DataFrame) -> DataFrame:
    """``occurred_at, lon, lat`` of a CSV table with ``Date, Latitude, Longitude``."""
    return table.select(
        timestamps.parse_first("Date", timestamps.FILE_DATE_FORMS).alias("occurred_at"),
        text.to_double("Longitude").alias("lon"), text.to_double("Latitude").alias("lat"))


def hot_spots_from_files(spark: SparkSession, incidents_csv: str, boundary_geojson: str,
                         grid_table: str, output: str, count: int = HOT_SPOTS,
                         step: float = CELL_SIZE) -> DataFrame:
    """Forecast from files to a FeatureCollection; returns the ranked cells.

    The grid is kept as a table at ``grid_table`` and built anew when the boundary or the step
    is not the one noted beside it.
    """
    boundary = scan_geojson(spark, boundary_geojson)
    grid = grid_over(boundary, step)
    hashes = F.xxhash64(F.to_json(F.struct(*boundary.columns))).cast("decimal(38,0)")
    spec = f"{grid} {step} {boundary.agg(F.sum(hashes)).first()[0]}"
    noted = f"{grid_table}_spec"
    if not path_exists(spark, noted) or spark.read.text(noted).first()[0] != spec:
        grid_cells(boundary, grid, POLYGON).write.mode("overwrite").parquet(grid_table)
        spark.createDataFrame([(spec,)], "spec string").coalesce(1).write.mode("overwrite").text(noted)
    cells = load_or_build(spark, grid_table, lambda: grid_cells(boundary, grid, POLYGON))
    points = incident_points(scan_csv_skip_long(spark, incidents_csv))
    ranked = materialize(HotSpotModel.fit(points, cells, grid).rank(count), "hot-spots")
    write_feature_collection(hot_cells(cells, ranked), output, ["grid_id"])
    return ranked
