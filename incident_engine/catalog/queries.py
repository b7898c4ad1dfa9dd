"""One query per operator, over the given tables.

Ids and counts come out as bigint, dates and times as text, doubles rounded.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine.catalog import feeds
from incident_engine.catalog.feeds import PRECINCT, feed
from incident_engine.functions import text, timestamps
from incident_engine.functions.geo import GridSpec
from incident_engine.operators import counts, features, forecast, records, sets, spatial
from incident_engine.plans import collect, hotspot, incidents
from incident_engine.schemas import CELL_SIZE, CHICAGO_RECORD, LA_RECORD, UK_RECORD
from incident_engine.session import load_or_build, materialize, use_utc, workspace_dir
from incident_engine.sinks import batch_log
from incident_engine.sinks import files as file_sinks
from incident_engine.sinks import messages as message_sinks
from incident_engine.sources import files as file_sources
from incident_engine.sources import pages, pull
from incident_engine.sources.messages import MessageSource, only_topics
from incident_engine.streaming import feeds as live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MARK = "2024-01-20T00:00:00.000"
CUTOFF = "2024-01-20 01:00:00"
HOT_CELLS = 40
HORIZON = (2001, 6, 10)
PAGE_PART_ROWS = 2000
# the page at three fifths of the rows
DEEP_PAGE = (3, 5)


def query(run: Query) -> Query:
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(use_utc(spark), sf_dir)

    QUERIES[run.__name__] = in_utc
    return run


def n_rows() -> Column:
    return F.count(F.lit(1)).alias("n")


def as_long(*names: str) -> list[Column]:
    return [F.col(c).cast("bigint").alias(c) for c in names]


def rounded(places: int, *names: str) -> list[Column]:
    return [F.round(c, places).alias(c) for c in names]


def as_text(*names: str) -> list[Column]:
    return [timestamps.to_text(c).alias(c) for c in names]


def month_text(name: str = "month") -> Column:
    return F.date_format(name, "yyyy-MM").alias(name)


def day_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def _run_folder(spark, name: str) -> str:
    return f"{workspace_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Sources and sinks


@query
def src_messages(spark, sf):
    df = records.message_text(feeds.chi_messages(spark, sf))
    return df.select(F.col("key").cast("string").alias("id"),
                     (F.length("value") > 2).alias("value_len_ok"))


def _months(spark, sf) -> list[str]:
    """Every month of the feed, which is also its list of topics."""
    return sorted(r["month"] for r in feed(spark, sf, "uk").select("month").distinct().collect())


@query
def src_multi_topic(spark, sf):
    return only_topics(feeds.uk_messages(spark, sf), *_months(spark, sf)).groupBy("topic").agg(n_rows())


@query
def csv_to_messages(spark, sf):
    df = message_sinks.table_json(feeds.la_table(spark, sf))
    fields = F.json_tuple("value", "DR_NO", "Premis Desc", "Status")
    return df.select(fields.alias("dr_no", "premis", "status"),
                     F.contains("value", F.lit('"Cross Street":null')).alias("has_null_key"))


@query
def pull_since_mark(spark, sf):
    rows = pull.rows_since(feed(spark, sf, "chi"), "updated_ts", MARK)
    return rows.select("id", timestamps.to_text("updated_ts").alias("updated_on"))


@query
def pull_page(spark, sf):
    rows = pull.page(feed(spark, sf, "chi"), "updated_ts", "event_id", offset=1000)
    return rows.select("id", timestamps.to_text("updated_ts").alias("updated_on"))


@query
def pull_page_deep(spark, sf):
    """A page far down, by an order index: only the ranges that hold it are read."""
    index = pages.build_page_index(
        feed(spark, sf, "chi").select("id", "updated_ts", "event_id"), "updated_ts", "event_id",
        _run_folder(spark, "pages"), part_rows=PAGE_PART_ROWS)
    rows = index.page(DEEP_PAGE[0] * index.rows // DEEP_PAGE[1])
    return rows.select("id", timestamps.to_text("updated_ts").alias("updated_on"))


@query
def pull_next_mark(spark, sf):
    df = pull.next_mark(feed(spark, sf, "chi"), "updated_ts", MARK)
    return df.select(*as_text("next_mark"))


@query
def stream_pull(spark, sf):
    """Two runs of the pull stream with a restart between; rows were added meanwhile."""
    folder = _run_folder(spark, "stream-pull")
    rows = feed(spark, sf, "chi").select("id", "updated_ts")
    late = F.col("updated_ts") > F.lit(MARK).cast("timestamp_ntz")
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(f"{folder}/table")
        live.start_pull_stream(spark, f"{folder}/table", rows.schema, "updated_ts", f"{folder}/out",
                               f"{folder}/checkpoint", poll=None).awaitTermination()
    out = batch_log.read_batches(spark, f"{folder}/out", rows.schema, "parquet")
    return out.groupBy("id", timestamps.to_text("updated_ts").alias("updated_on")).agg(
        n_rows(), F.min("batch_id").alias("batch_id"))


def _streamed(spark, sf, spec: live.FeedSpec, messages: DataFrame) -> DataFrame:
    """What a live feed wrote, in several batches, as the log of its batches has it."""
    folder = _run_folder(spark, f"stream-{spec.name}")
    messages.repartition(4).write.parquet(f"{folder}/in")
    source = MessageSource("parquet", (spec.name,), {"path": f"{folder}/in", "maxFilesPerTrigger": "2"})
    live.start_feed(spark, spec, source, f"{folder}/out", f"{folder}/checkpoint", poll=None,
                    writer=batch_log.logged_csv_writer).awaitTermination()
    schema = spec.rows(messages).schema
    return batch_log.read_batches(spark, f"{folder}/out", schema).select(*schema.fieldNames())


@query
def stream_chicago(spark, sf):
    return _streamed(spark, sf, live.CHICAGO, feeds.chi_messages(spark, sf))


@query
def stream_seattle(spark, sf):
    return _streamed(spark, sf, live.SEATTLE, feeds.sea_messages(spark, sf))


@query
def mark_round_trip(spark, sf):
    """Four cycles of a pull over a growing table: the rows each sent and the mark it saved."""
    folder = _run_folder(spark, "marks")
    rows = materialize(feed(spark, sf, "chi").select("id", "updated_ts"), "mark-rows")
    days = [r["day"] for r in rows.select(
        F.to_date("updated_ts").alias("day")).distinct().orderBy("day").collect()]
    saved = []
    for cycle in range(4):
        last = cycle == 3
        known = rows if last else rows.filter(
            F.col("updated_ts") < F.lit(days[len(days) * (cycle + 1) // 4]))
        pull.pull_once(known, "updated_ts", f"{folder}/state", "chi",
                       lambda new: new.write.parquet(f"{folder}/out/cycle={cycle}"))  # noqa: B023
        saved.append((cycle, pull.load_mark(spark, f"{folder}/state", "chi")))
    listed = ", ".join(f"({cycle}L, timestamp_ntz '{mark}')" for cycle, mark in saved)
    marks = spark.sql(f"select * from values {listed} as t(cycle, mark)").withColumn(
        "mark", timestamps.to_text("mark"))
    sent = spark.read.parquet(f"{folder}/out").groupBy(F.col("cycle").cast("bigint").alias("cycle"))
    return sent.agg(n_rows(), F.countDistinct("id").alias("ids")).join(F.broadcast(marks), "cycle")


@query
def collect_worklist(spark, sf):
    precincts = feed(spark, sf, "precincts").select("force", "neighbourhood")
    return collect.worklist(precincts.select("force").distinct(), precincts, _months(spark, sf))


@query
def collect_in_polygon(spark, sf):
    points = feed(spark, sf, "inc").withColumn("month", F.date_format("occurred_at", "yyyy-MM"))
    grid, cover = _cover(spark, sf)
    rows = collect.collect_in_polygons(points, cover, grid)
    return rows.groupBy(*PRECINCT, "month").agg(n_rows())


@query
def collect_by_worklist(spark, sf):
    points = feed(spark, sf, "inc").withColumn("month", F.date_format("occurred_at", "yyyy-MM"))
    grid, cover = _cover(spark, sf)
    rows = collect.collect_by_worklist(points, collect_worklist(spark, sf), cover, grid, PRECINCT)
    return rows.groupBy(*PRECINCT, "month").agg(n_rows())


@query
def csv_skip_long(spark, sf):
    """Files of one table whose headers name the columns in another order; one line in thirteen
    has a field too many."""
    folder = _run_folder(spark, "csv")
    names = ["dr_no", "area", "premis", "status"]
    rows = feed(spark, sf, "la").select(*names, F.col("dr_no").cast("bigint").alias("no"))
    lines = None
    for turn in range(3):
        order = names[turn:] + names[:turn]
        here = rows.filter(F.pmod("no", F.lit(3)) == turn)
        surplus = F.when(F.pmod("no", F.lit(13)) == 0, ",surplus").otherwise("")
        text_lines = here.select(F.lit(turn).alias("file"), F.lit(1).alias("nth"), F.concat(
            F.concat_ws(",", *order), surplus).alias("value"))
        header = spark.createDataFrame([(turn, 0, ",".join(order))], text_lines.schema)
        lines = header.union(text_lines) if lines is None else lines.union(header).union(text_lines)
    lines.repartition("file").sortWithinPartitions("file", "nth").select("file", "value") \
        .write.partitionBy("file").text(f"{folder}/rows")
    return file_sources.scan_csv_skip_long(spark, f"{folder}/rows").select(*names)


@query
def csv_infer_round_trip(spark, sf):
    """A table written as CSV with a header, over a former one, and read with inferred types."""
    path = f"{_run_folder(spark, 'csv')}/la"
    rows = feed(spark, sf, "la").select("dr_no", "area", "premis", "status", "lat", "lon")
    for table in (rows.limit(3), rows):
        file_sinks.write_csv(table, path)
    read = file_sources.scan_csv(spark, path)
    return read.select(*as_long("dr_no", "area"), "premis", "status", *rounded(6, "lat", "lon"))


@query
def csv_batches_round_trip(spark, sf):
    """Micro-batches as CSV without a header, one of them replayed."""
    path = f"{_run_folder(spark, 'csv')}/rows"
    rows = feed(spark, sf, "chi").select("id", "primary_type", "event_id")
    write = file_sinks.csv_batch_writer(path)
    for batch in (0, 1, 1, 2):
        write(rows.filter(F.col("event_id") % 3 == batch).drop("event_id"), batch)
    read = spark.read.schema("id string, primary_type string, batch_id int").csv(path)
    return read.select("id", "primary_type", *as_long("batch_id"))


@query
def side_table_round_trip(spark, sf):
    """Rates from an optional file that is there, and from one that is not."""
    path = f"{_run_folder(spark, 'rate')}/rate"
    file_sinks.write_csv(_rate(spark, sf).select("month", "AREA", "year", "unemployment_rate"), path)
    columns = "year int, month int, AREA string, unemployment_rate double"
    known, none = (file_sources.optional_csv(spark, p, columns) for p in (path, f"{path}-none"))
    counts = materialize(features.with_calendar(_area_counts(spark, sf)), "area-counts")
    here = features.with_rate(counts, known).select("AREA", "year", "month", "unemployment_rate")
    gone = features.with_rate(counts, none).select(
        "AREA", "year", "month", F.col("unemployment_rate").alias("rate_without_file"))
    return _area(here.join(gone, ["AREA", "year", "month"])).select(
        "area", *as_long("year", "month"), *rounded(6, "unemployment_rate", "rate_without_file"))


@query
def geojson_round_trip(spark, sf):
    """The grid as one GeoJSON document that many tasks write, and back as polygons."""
    path = f"{_run_folder(spark, 'geojson')}/grid"
    file_sinks.write_feature_collection(_grid(spark, sf)[1], path, ["grid_id"], part_rows=500)
    rings = file_sources.scan_geojson(spark, path, collection_lines=True)
    return rings.select(F.col("properties")["grid_id"].cast("bigint").alias("grid_id"), *[
        F.round(F.expr(f"array_{end}(ring.{axis})"), 9).alias(f"{axis}{end}")
        for axis in "xy" for end in ("min", "max")], F.size("ring").cast("bigint").alias("points"))


@query
def preview_rows(spark, sf):
    rows = feed(spark, sf, "la").select("dr_no")
    seen = sets.preview(rows, 25)
    return seen.join(rows, "dr_no", "left_semi").agg(n_rows(), F.countDistinct("dr_no").alias("ids"))


def _half_keyed(spark, sf) -> DataFrame:
    gone = F.col("event_id") % 50 == 0
    df = feed(spark, sf, "chi").withColumn("record", F.col("id"))
    blank = F.when(F.col("event_id") % 100 == 0, F.lit("")).otherwise(F.lit(None).cast("string"))
    return df.select(F.when(gone, blank).otherwise(F.col("id")).alias("id"), "record")


@query
def sink_keyed_json(spark, sf):
    df = message_sinks.keyed_json(_half_keyed(spark, sf), "id")
    return df.select("key", F.get_json_object("value", "$.record").alias("id_in_value"))


@query
def sink_keyed_json_nullkey(spark, sf):
    df = message_sinks.keyed_json(_half_keyed(spark, sf), "id", keep_null_key=True)
    return df.select("key", F.get_json_object("value", "$.record").alias("id_in_value"))


@query
def sink_topic_route(spark, sf):
    df = message_sinks.routed_by_month(feed(spark, sf, "uk").select("id", "month"))
    read_back = df.filter(F.get_json_object("value", "$.month") == F.col("topic"))
    return read_back.groupBy("topic").agg(n_rows())


# Parsing and feed views


@query
def json_parse_chi(spark, sf):
    df = records.parse_records(feeds.chi_messages(spark, sf), CHICAGO_RECORD)
    return df.select("id", *as_text("date"), "arrest", "latitude",
                     F.col("location.latitude").alias("loc_latitude"))


@query
def json_parse_bad(spark, sf):
    broken = F.col("key").cast("string").cast("bigint") % 13 == 0
    messages = feeds.chi_messages(spark, sf).withColumn(
        "value", F.when(broken, F.lit("{ not json").cast("binary")).otherwise(F.col("value")))
    df = records.parse_records(messages, CHICAGO_RECORD)
    return df.agg(F.count_if(F.col("id").isNotNull()).alias("parsed"),
                  F.count_if(F.col("id").isNull()).alias("null_rows"))


def _chicago(spark, sf) -> DataFrame:
    return records.chicago_view(
        records.parse_records(feeds.chi_messages(spark, sf), CHICAGO_RECORD))


@query
def chi_format(spark, sf):
    has_location = F.col("location").isNotNull().alias("location")
    view = _chicago(spark, sf)
    return view.select(*[c for c in view.columns if c != "location"], has_location)


@query
def chi_sink_layout(spark, sf):
    return live.CHICAGO.rows(feeds.chi_messages(spark, sf))


@query
def chi_location_json(spark, sf):
    parts = F.from_json("location", "latitude string, longitude string, human_address string")
    return _chicago(spark, sf).select("ID", parts.alias("p")).select(
        F.col("ID").alias("id"), F.col("p.latitude").alias("lat"), F.col("p.longitude").alias("lon"),
        F.col("p.human_address").alias("human_address"))


@query
def sea_format(spark, sf):
    return live.SEATTLE.rows(feeds.sea_messages(spark, sf))


@query
def align_columns(spark, sf):
    df = feed(spark, sf, "chi").select(
        "id", F.col("case_number").alias("Case Number"),
        timestamps.to_text("date_ts").alias("date"),
        F.col("primary_type").alias("Primary Type"), "community_area", "beat")
    return records.align_titles(df)


def _uk(spark, sf) -> DataFrame:
    return records.parse_records(
        feeds.uk_messages(spark, sf), UK_RECORD, fields=records.UK_INCIDENT_FIELDS)


def _unified_out(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "timestamp": timestamps.to_text("timestamp"),
        "month": F.col("month").cast("bigint"), "year": F.col("year").cast("bigint")})


@query
def uk_normalize(spark, sf):
    return _unified_out(records.uk_incidents(_uk(spark, sf)))


@query
def uk_severity(spark, sf):
    severity = records.uk_severity("category").alias("severity")
    return feed(spark, sf, "uk").groupBy(severity).agg(n_rows())


@query
def uk_district_view(spark, sf):
    df = records.uk_district_view(_uk(spark, sf))
    return df.withColumn("timestamp", timestamps.to_text("timestamp"))


@query
def la_normalize(spark, sf):
    messages = message_sinks.table_json(feeds.la_table(spark, sf))
    return _unified_out(records.la_incidents(records.parse_records(
        messages, LA_RECORD, fields=records.LA_INCIDENT_FIELDS)))


@query
def la_severity(spark, sf):
    severity = records.la_severity("crime").alias("severity")
    return feed(spark, sf, "la").groupBy(severity).agg(n_rows())


# Merges


@query
def unified_incidents(spark, sf):
    la_messages = message_sinks.table_json(feeds.la_table(spark, sf))
    return _unified_out(incidents.unified_incidents(la_messages, feeds.uk_messages(spark, sf)))


@query
def union_topics(spark, sf):
    names = {"chicago": "id", "seattle": "report_number", "uk": "id", "la": "dr_no"}
    tables = {"chicago": "chi", "seattle": "sea", "uk": "uk", "la": "la"}
    return sets.union_all(*[
        feed(spark, sf, tables[topic]).select(F.lit(topic).alias("topic"), F.col(name).cast("string").alias("id"))
        for topic, name in names.items()])


@query
def archive_merge(spark, sf):
    in_archive = F.col("event_id") % 2 == 0
    twelve = "MM/dd/yyyy hh:mm:ss a"
    archive = feed(spark, sf, "chi").filter(in_archive).select(
        F.col("id").alias("ID"), F.date_format("date_ts", twelve).alias("Date"),
        F.date_format("updated_ts", twelve).alias("Updated On"))
    fresh = incidents.updated_until(incidents.archive_rows(archive), CUTOFF)
    odd = F.col("key").cast("string").cast("bigint") % 2 == 1
    streamed = incidents.streamed_rows(feeds.chi_messages(spark, sf).filter(odd))
    merged = incidents.archive_merge(fresh, streamed)
    return merged.select("ID", *as_text("Date", "Updated On"))


@query
def filter_cutoff(spark, sf):
    return incidents.updated_until(
        feed(spark, sf, "chi"), F.lit(CUTOFF).cast("timestamp_ntz"), "updated_ts").select("id")


@query
def latest_updates(spark, sf):
    df = incidents.latest_updates(feed(spark, sf, "chi"), "updated_ts", "event_id")
    return df.select("id", timestamps.to_text("updated_ts").alias("updated_on"))


@query
def audit_counts(spark, sf):
    chi = feed(spark, sf, "chi")
    kept = F.col("updated_ts") <= F.lit(CUTOFF).cast("timestamp_ntz")
    return incidents.audit_counts(
        chi, scanned=F.lit(True), until_cutoff=kept,
        changed=F.col("updated_ts") > F.lit(MARK).cast("timestamp_ntz"))


# Filters, cleaning and scalar functions


@query
def filter_nonzero_xy(spark, sf):
    lon = F.when(F.col("l_orderkey") % 17 == 0, 0.0).otherwise(F.col("lon"))
    lon = F.when(F.col("l_orderkey") % 19 == 0, None).otherwise(lon)
    df = feed(spark, sf, "inc").withColumn("lon", lon)
    kept = spatial.known_position()
    return df.agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))


@query
def clean_required(spark, sf):
    marked = F.date_format("occurred_at", "MM/dd/yyyy HH:mm:ss a")
    df = feed(spark, sf, "inc").select(
        F.when(F.col("l_orderkey") % 23 != 0, marked).alias("Report Date"),
        F.when(F.col("l_orderkey") % 19 != 0, F.concat("area", F.lit(".0"))).alias("Community Area"))
    clean = features.clean_incidents(df)
    return clean.groupBy(F.col("AREA").alias("area"), F.col("month").cast("bigint").alias("month")
                         ).agg(n_rows())


@query
def strip_float_suffix(spark, sf):
    area = text.strip_float_suffix(F.concat("area", F.lit(".0"))).alias("area")
    return feed(spark, sf, "la").groupBy(area).agg(n_rows())


@query
def parse_iso_ts(spark, sf):
    iso = F.date_format("date_ts", feeds.ISO_MILLIS)
    df = feed(spark, sf, "chi").withColumn(
        "ts", F.when(F.col("event_id") % 9 == 0, F.lit("n/a")).otherwise(iso))
    return df.select("id", timestamps.to_text(timestamps.parse_iso("ts")).alias("ts"))


@query
def parse_month(spark, sf):
    df = feed(spark, sf, "uk")
    return df.select("id", timestamps.to_text(timestamps.parse_month("month")).alias("ts"))


@query
def parse_12h(spark, sf):
    df = feeds.la_table(spark, sf)
    return df.select(F.col("DR_NO").alias("dr_no"),
                     timestamps.to_text(timestamps.parse_12h("DATE OCC")).alias("ts"))


@query
def parse_h24_ampm(spark, sf):
    df = feed(spark, sf, "la").withColumn("t", F.date_format("occ_ts", "MM/dd/yyyy HH:mm:ss a"))
    return df.select("dr_no", timestamps.to_text(timestamps.parse_24h_marked("t")).alias("ts"))


@query
def ts_parts(spark, sf):
    df = feed(spark, sf, "la")
    return df.groupBy(F.year("occ_ts").cast("bigint").alias("year"),
                      F.month("occ_ts").cast("bigint").alias("month")).agg(n_rows())


@query
def calendar_features(spark, sf):
    months = feed(spark, sf, "inc").select(timestamps.month_start("occurred_at").alias("ds"))
    df = months.distinct()
    df = df.withColumns(timestamps.calendar_features("ds"))
    return df.select(
        day_text("ds"), *as_long("days_in_month", "day_of_week", "is_holiday"),
        *rounded(9, "month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos"))


@query
def encode_request(spark, sf):
    polygons = _polygon_texts(spark, sf)
    work = collect.worklist(polygons.select("force").distinct(),
                            polygons.select(*PRECINCT), _months(spark, sf))
    return collect.requests(work, polygons).select("neighbourhood", "path", "body")


# Spatial


def _version(spark, sf) -> str:
    """Files behind the precincts: a table that was written anew has other ones."""
    return " ".join(f"{name}:{size}:{changed}" for table in feeds.FEEDS["precincts"][0]
                    for name, size, changed in file_sources.file_states(spark, f"{sf}/{table}.parquet"))


# Grid and cover of the precincts, made once per session and version of their tables.
_GRIDS: dict[tuple[str, str, float], GridSpec] = {}


def _spec(spark, sf, step: float = CELL_SIZE) -> GridSpec:
    key = (spark.sparkContext.applicationId, _version(spark, sf), step)
    if key not in _GRIDS:
        _GRIDS[key] = spatial.grid_over(feeds.precinct_boundary(spark, sf), step)
    return _GRIDS[key]


def _saved(spark, sf, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    folder = hashlib.sha256(_version(spark, sf).encode()).hexdigest()[:16]
    return load_or_build(spark, f"{workspace_dir(spark)}/{name}-{folder}", build)


def _grid(spark, sf):
    grid = _spec(spark, sf)
    cells = _saved(spark, sf, "grid", lambda: spatial.grid_cells(
        feeds.precinct_boundary(spark, sf), grid, PRECINCT))
    return grid, cells


def _cover(spark, sf):
    """Polygon cover at a quarter of the analysis cell, so that most cells lie within."""
    grid = _spec(spark, sf, CELL_SIZE / 4)
    cover = _saved(spark, sf, "cover", lambda: spatial.polygon_cover(
        feeds.precinct_boundary(spark, sf), grid, PRECINCT))
    return grid, cover


def _corners() -> list[Column]:
    return rounded(9, "xmin", "ymin", "xmax", "ymax")


@query
def spatial_point_cell(spark, sf):
    grid, cells = _grid(spark, sf)
    located = spatial.points_to_cells(feed(spark, sf, "inc"), cells, grid)
    return located.groupBy("grid_id").agg(n_rows())


@query
def spatial_point_polygon(spark, sf):
    grid, cover = _cover(spark, sf)
    inside = spatial.points_in_polygons(feed(spark, sf, "inc"), cover, grid)
    month = F.date_format("occurred_at", "yyyy-MM").alias("month")
    return inside.groupBy("neighbourhood", month).agg(F.count(F.lit(1)).alias("inside_n"))


@query
def grid_cells(spark, sf):
    cells = spatial.grid_cells(feeds.precinct_boundary(spark, sf), _spec(spark, sf), PRECINCT)
    return cells.select("grid_id", "ix", "iy", *_corners())


@query
def grid_cells_on_boundary(spark, sf):
    boundary = feeds.precinct_boundary(spark, sf)
    return spatial.cells_on_boundary(boundary, _spec(spark, sf), PRECINCT)


@query
def grid_ids(spark, sf):
    boundary = feeds.precinct_boundary(spark, sf)
    cells = materialize(
        spatial.cells_on_boundary(boundary, _spec(spark, sf), PRECINCT), "boundary-cells")
    return spatial.number_cells(cells)


@query
def boundary_extent(spark, sf):
    return spatial.boundary_extent(feeds.precinct_boundary(spark, sf)).select(*_corners())


def _polygon_texts(spark, sf) -> DataFrame:
    corner = ["xa ya", "xc ya", "xc yb", "xb yb", "xb yc", "xa yc"]

    def coordinate(name: str) -> Column:
        return F.col(name).cast("decimal(12,6)").cast("string")

    points = [F.struct(coordinate(y).alias("latitude"), coordinate(x).alias("longitude"))
              for x, y in (c.split() for c in corner)]
    return feed(spark, sf, "precincts").select(
        *PRECINCT, text.polygon_text(F.array(*points)).alias("poly"))


@query
def boundary_poly_text(spark, sf):
    return _polygon_texts(spark, sf)


# Hot spots


def _model(spark, sf) -> hotspot.HotSpotModel:
    grid, cells = _grid(spark, sf)
    return hotspot.HotSpotModel.fit(feed(spark, sf, "inc"), cells, grid)


@query
def hotspot_counts(spark, sf):
    return _model(spark, sf).on_grid.select("grid_id", "ix", "iy", month_text(), "n")


@query
def hotspot_dense(spark, sf):
    return _model(spark, sf).dense().select("grid_id", "ix", "iy", month_text(), "n")


@query
def hotspot_pivot(spark, sf):
    wide = counts.wide_rows(_model(spark, sf).dense(), hotspot.CELL)
    return wide.select(*hotspot.CELL, F.array_join(F.col("counts").cast("array<string>"), ",").alias("counts"))


def _scored(spark, sf) -> DataFrame:
    return _model(spark, sf).scored().filter(F.col("mu").isNotNull())


@query
def hotspot_trailing_mean(spark, sf):
    return _scored(spark, sf).select("grid_id", "ix", "iy", month_text(), *rounded(6, "mu"))


@query
def hotspot_poisson(spark, sf):
    return _scored(spark, sf).select("grid_id", "ix", "iy", month_text(), *rounded(6, "p"))


@query
def hotspot_flags(spark, sf):
    return _scored(spark, sf).select("grid_id", "ix", "iy", month_text(), *as_long("flag"))


@query
def hotspot_hit_rate(spark, sf):
    return _model(spark, sf).cell_scores().select("grid_id", "ix", "iy", *rounded(6, "avg_tp"))


@query
def hotspot_prev_month(spark, sf):
    return _model(spark, sf).cell_scores().select("grid_id", "ix", "iy", "prev_n")


@query
def hotspot_forecast_month(spark, sf):
    latest = feed(spark, sf, "inc").agg(F.max("occurred_at").alias("latest"))
    return latest.select(
        timestamps.next_month("latest").alias("forecast_month"),
        timestamps.month_start("latest").alias("previous_month"),
    ).select(day_text("forecast_month"), day_text("previous_month"))


@query
def hotspot_rank(spark, sf):
    return _model(spark, sf).rank().select(
        "grid_id", "ix", "iy", *rounded(6, "avg_tp"), *as_long("prev_n", "rk"))


def _hot_cells(spark, sf) -> DataFrame:
    grid, cells = _grid(spark, sf)
    ranked = hotspot.HotSpotModel.fit(feed(spark, sf, "inc"), cells, grid).rank(HOT_CELLS)
    return hotspot.hot_cells(cells, ranked)


@query
def hotspot_cells(spark, sf):
    return _hot_cells(spark, sf).select("grid_id", *_corners())


@query
def hotspot_geojson(spark, sf):
    df = file_sinks.cell_features(_hot_cells(spark, sf), ["grid_id"])
    ring = F.from_json("feature", "geometry struct<coordinates: array<array<array<double>>>>")
    df = df.select(
        F.get_json_object("feature", "$.properties.grid_id").cast("bigint").alias("grid_id"),
        ring["geometry"]["coordinates"][0].alias("ring"))
    return df.select(
        "grid_id", F.round(F.col("ring")[0][0], 9).alias("xmin"),
        F.round(F.col("ring")[0][1], 9).alias("ymin"),
        F.round(F.col("ring")[2][0], 9).alias("xmax"),
        F.round(F.col("ring")[2][1], 9).alias("ymax"))


# Monthly counts and forecasts per area


def _clean(spark, sf) -> DataFrame:
    return features.clean_incidents(feed(spark, sf, "inc"), "occurred_at", "area")


def _area_counts(spark, sf) -> DataFrame:
    return features.area_month_counts(_clean(spark, sf))


def _rate(spark, sf) -> DataFrame:
    return feed(spark, sf, "rate").withColumnRenamed("area", "AREA")


def _split(spark, sf) -> DataFrame:
    return forecast.split_series(features.with_calendar(_area_counts(spark, sf)))



def _area(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("AREA", "area")


@query
def area_month_counts(spark, sf):
    df = _area(_area_counts(spark, sf))
    return df.select("area", *as_long("year", "month", "crime_count"))


@query
def rate_join_default(spark, sf):
    df = features.with_rate(_area_counts(spark, sf), _rate(spark, sf))
    return _area(df).select("area", *as_long("year", "month"), *rounded(6, "unemployment_rate"))


@query
def area_month_features(spark, sf):
    df = features.area_month_features(_clean(spark, sf), _rate(spark, sf))
    return _area(df).select(
        "area", day_text("ds"),
        *as_long("year", "month", "crime_count", "days_in_month", "day_of_week", "is_holiday"),
        *rounded(9, "month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos"),
        *rounded(6, "unemployment_rate"))


@query
def forecast_split(spark, sf):
    return _area(_split(spark, sf)).select("area", day_text("ds"), "is_test")


@query
def forecast_trend_season(spark, sf):
    df = _area(forecast.fit_predict_trend_season(_split(spark, sf)))
    return df.select("area", day_text("ds"), *as_long("y"), *rounded(6, "yhat"))


@query
def forecast_mse(spark, sf):
    df = forecast.holdout_mse(forecast.fit_predict_trend_season(_split(spark, sf)))
    return _area(df).select("area", *rounded(6, "mse"))


@query
def forecast_predict(spark, sf):
    models = forecast.fit_trend_season(_split(spark, sf))
    asked = _rate(spark, sf).select(
        "AREA", (F.col("year") + 2).alias("year"), "month")
    df = forecast.predict_trend_season(asked, models)
    return _area(df).select("area", *as_long("year", "month"), *rounded(6, "yhat"))


@query
def forecast_horizon(spark, sf):
    models = materialize(forecast.fit_trend_season(_split(spark, sf)), "area-models")
    asked = forecast.horizon(models, *HORIZON)
    df = forecast.predict_trend_season(asked, models)
    return _area(df).select("area", day_text("ds"), *rounded(6, "yhat"))


def _ridge_split(spark, sf) -> DataFrame:
    df = features.with_rate(features.with_calendar(_area_counts(spark, sf)), _rate(spark, sf))
    return materialize(forecast.split_series(df), "ridge-months")


@query
def forecast_fit(spark, sf):
    models = forecast.fit_ridge(_ridge_split(spark, sf))
    rows = models.select("AREA", "n_train", F.posexplode("weight").alias("term", "weight"))
    return _area(rows).select("area", *as_long("n_train", "term"), *rounded(6, "weight"))


@query
def forecast_ridge_predict(spark, sf):
    asked = _rate(spark, sf).select(
        "AREA", (F.col("year") + 2).alias("year"), "month", "unemployment_rate")
    df = forecast.predict_ridge(asked, forecast.fit_ridge(_ridge_split(spark, sf)))
    return _area(df).select("area", *as_long("year", "month"), *rounded(4, "yhat"))


@query
def forecast_ridge_mse(spark, sf):
    split = _ridge_split(spark, sf)
    asked = split.select("AREA", "year", "month", "unemployment_rate", "ds", "is_test",
                         F.col("crime_count").alias("y"))
    df = forecast.holdout_mse(forecast.predict_ridge(asked, forecast.fit_ridge(split)))
    return _area(df).select("area", *rounded(4, "mse"))
