"""Collection of changed rows, and of the incidents inside polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_engine.functions import text
from incident_engine.functions.geo import GridSpec
from incident_engine.operators.joins import fits_broadcast, join_keyed
from incident_engine.operators.spatial import points_in_polygons
from incident_engine.sinks.messages import keyed_json, routed_by_month, write_messages
from incident_engine.sources.messages import MessageSource
from incident_engine.sources.pull import pull_once


def collect_changes(table: DataFrame, update_field: str, key: str, state: str, feed: str,
                    sink: MessageSource, keep_null_key: bool = False) -> int:
    """Send the rows changed since the feed's mark as keyed JSON; returns their number.

    Counts changed rows, those without a key included.
    """
    def send(rows: DataFrame) -> None:
        write_messages(keyed_json(rows, key, keep_null_key), sink)

    return pull_once(table, update_field, state, feed, send)


def worklist(forces: DataFrame, neighbourhoods: DataFrame, months: list[str]) -> DataFrame:
    """Every neighbourhood of every force for every month of a given list.

    The join leaves the rows placed by force alone, and a force has many neighbourhoods times the
    months: the rows are spread by all three columns, so that no task of a later step holds a force.
    """
    each = F.explode(F.array(*[F.lit(m) for m in months]))
    return forces.join(neighbourhoods, "force").select("force", "neighbourhood", each.alias("month")) \
        .repartition("force", "neighbourhood", "month")


def requests(work: DataFrame, polygons: DataFrame) -> DataFrame:
    """Request texts of a work list; polygons have ``force, neighbourhood, poly``.

    A neighbourhood whose polygon is empty has nothing to ask for.
    """
    drawn = polygons.filter(F.col("poly") != "")
    return work.join(drawn, ["force", "neighbourhood"]).select(
        "force", "neighbourhood", "month",
        text.request_path("force", "neighbourhood").alias("path"),
        text.request_body("poly", "month").alias("body"),
    )


def collect_in_polygons(points: DataFrame, cover: DataFrame, grid: GridSpec,
                        x: str = "lon", y: str = "lat") -> DataFrame:
    """Incidents inside each polygon, in one join; all of them, however many a polygon has.

    ``cover`` is a written ``polygon_cover``.
    """
    return points_in_polygons(points, cover, grid, x, y, fits_broadcast(cover))


def collect_by_worklist(points: DataFrame, work: DataFrame, cover: DataFrame, grid: GridSpec,
                        keys: list[str], month: str = "month") -> DataFrame:
    """Incidents of exactly the pairs of polygon and month that the work list names."""
    inside = collect_in_polygons(points, cover, grid)
    return join_keyed(inside, work.select(*keys, month).distinct(), [*keys, month], "left_semi")


def collect_months(points: DataFrame, cover: DataFrame, grid: GridSpec, keys: list[str],
                   months: list[str], sink: MessageSource, month: str = "month") -> None:
    """Send the incidents of the given months, each to the topic of its month."""
    wanted = points.filter(F.col(month).isin(months))
    found = collect_in_polygons(wanted, cover, grid)
    write_messages(routed_by_month(found.drop(*keys), month), sink)
