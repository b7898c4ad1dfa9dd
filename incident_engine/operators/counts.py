"""Monthly counts per grid cell and the scores built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from incident_engine.functions import scores, timestamps
from incident_engine.functions.geo import GridSpec
from incident_engine.operators.spatial import with_cell_index
from incident_engine.schemas import HIT_THRESHOLD, HOT_SPOTS, TRAILING_MONTHS


def cell_month_counts(points: DataFrame, grid: GridSpec, time: str = "occurred_at",
                      x: str = "lon", y: str = "lat") -> DataFrame:
    """Rows per cell index and month: ``ix, iy, month, n, last_at``.

    Counts come before any join, so a hot cell shrinks to one row per month
    in each map task. Points in no cell are counted under null indices, which
    lets the latest date of the whole input come out of the same pass.
    """
    return (
        with_cell_index(points, grid, x, y)
        .groupBy("ix", "iy", timestamps.month_start(time).alias("month"))
        .agg(F.count(F.lit(1)).alias("n"), F.max(time).alias("last_at"))
    )


def name_cells(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Add ``grid_id``, null for counts off the kept cells."""
    return counts.join(cells.select("ix", "iy", "grid_id"), ["ix", "iy"], "left")


def counts_on_grid(named: DataFrame) -> DataFrame:
    """Counts of the kept cells by month; rows in no cell or without a date are dropped."""
    return named.filter(F.col("grid_id").isNotNull() & F.col("month").isNotNull()).select(
        "grid_id", "ix", "iy", "month", "n")


def latest_month(counts: DataFrame) -> Column:
    """Month of the latest date of the input, as a scalar subquery."""
    return counts.agg(timestamps.month_start(F.max("last_at"))).scalar()


def month_axis(counts: DataFrame, calendar: bool = False) -> Column:
    """Sorted months that occur, as a scalar subquery (or all months between)."""
    if calendar:
        months = F.sequence(F.min("month"), F.max("month"), F.expr("interval 1 month"))
    else:
        months = F.sort_array(F.collect_set("month"))
    return counts.agg(months).scalar()


def dense_counts(counts: DataFrame, keys: list[str], calendar: bool = False,
                 all_cells: DataFrame | None = None) -> DataFrame:
    """Long form of the cell by month matrix, zeros filled in.

    One shuffle by cell; a cell's months travel as a map whose size is bounded
    by the calendar, and stay in place for the window and the aggregate after.
    ``all_cells`` adds cells without any count.
    """
    entries = F.collect_list(F.struct("month", "n"))
    per_cell = counts.groupBy(*keys).agg(F.map_from_entries(entries).alias("seen"))
    if all_cells is not None:
        per_cell = all_cells.select(*keys).join(per_cell, keys, "left")
    months = per_cell.select(*keys, "seen", F.explode(month_axis(counts, calendar)).alias("month"))
    filled = F.coalesce(F.col("seen")[F.col("month")], F.lit(0).cast("bigint"))
    return months.select(*keys, "month", filled.alias("n"))


def wide_rows(dense: DataFrame, keys: list[str]) -> DataFrame:
    """Wide view of all months of the axis: one array per cell, in order of the months."""
    rows = F.array_sort(F.collect_list(F.struct("month", "n")))
    return dense.groupBy(*keys).agg(rows.getField("n").alias("counts"))


def wide_counts(counts: DataFrame, keys: list[str], months: list) -> DataFrame:
    """Wide view of chosen months, one column each, zeros filled in."""
    return counts.groupBy(*keys).pivot("month", months).agg(F.sum("n")).fillna(0)


def trailing_scores(dense: DataFrame, keys: list[str], window: int = TRAILING_MONTHS,
                    threshold: float = HIT_THRESHOLD) -> DataFrame:
    """Add ``mu, p, flag``: mean of the months before, chance of any, hit.

    The first ``window`` months of a cell warm up and carry nulls.
    """
    by_month = Window.partitionBy(*keys).orderBy("month")
    warm = F.row_number().over(by_month) > window
    mean = F.avg("n").over(by_month.rowsBetween(-window, -1))
    scored = dense.withColumn("mu", F.when(warm, mean))
    scored = scored.withColumn("p", scores.chance_of_any("mu"))
    flag = F.when(F.col("mu").isNotNull(), scores.hit_flag("p", "n", threshold))
    return scored.withColumn("flag", flag)


def cell_scores(scored: DataFrame, keys: list[str], previous: Column, axis: Column) -> DataFrame:
    """Per cell: mean hit flag and the count of the previous month, in one aggregate."""
    known = F.array_contains(axis, previous)
    missing = F.raise_error(F.concat(
        F.lit("no counts for the previous month "), previous.cast("string")))
    last = F.max(F.when(F.col("month") == previous, F.col("n")))
    return scored.groupBy(*keys).agg(
        F.avg("flag").alias("avg_tp"),
        F.when(known, last).otherwise(missing.cast("bigint")).alias("prev_n"),
    )


def top_cells(cells: DataFrame, count: int = HOT_SPOTS, tie: tuple[str, ...] = ("grid_id",)
              ) -> DataFrame:
    """Best cells by hit rate, then by last month's count, then by id; adds ``rk``."""
    order = [F.desc_nulls_last("avg_tp"), F.desc_nulls_last("prev_n"), *map(F.asc, tie)]
    best = cells.orderBy(*order).limit(count)
    # The window sees only the rows that the limit let through.
    return best.withColumn("rk", F.row_number().over(Window.orderBy(*order)))
