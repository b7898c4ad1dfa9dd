"""Parsing, feed views and severity on hand-made rows."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from incident_engine.operators import records
from incident_engine.operators.sets import union_all
from incident_engine.schemas import (
    CHICAGO_FILE,
    CHICAGO_RECORD,
    CHICAGO_RECORD_TEXT_DATES,
    CHICAGO_VIEW,
    EMPTY_ADDRESS,
    LA_RECORD,
    SEATTLE_RECORD,
    SEATTLE_VIEW,
    UK_RECORD,
    UNIFIED_INCIDENT,
)


def messages(spark, *values):
    rows = [(None, v if v is None or isinstance(v, str) else json.dumps(v)) for v in values]
    return spark.createDataFrame(rows, "key string, value string").withColumn(
        "value", F.col("value").cast("binary"))


def parse(spark, schema, *values, **options):
    return records.parse_records(messages(spark, *values), schema, **options).collect()


def test_bad_text_is_kept_as_nulls(spark):
    rows = parse(spark, CHICAGO_RECORD, {"id": "1"}, "not json", "", None, "[1,2")
    assert [r["id"] for r in rows] == ["1", None, None, None, None]
    assert all(v is None for v in rows[1])


def test_bad_text_can_be_dropped_or_fail(spark):
    rows = parse(spark, CHICAGO_RECORD, {"id": "1"}, "not json", "", bad_rows="drop")
    assert [r["id"] for r in rows] == ["1"]
    with pytest.raises(PySparkException, match="no readable record"):
        parse(spark, CHICAGO_RECORD, {"id": "1"}, "not json", bad_rows="fail")
    with pytest.raises(ValueError, match="bad_rows"):
        parse(spark, CHICAGO_RECORD, {"id": "1"}, bad_rows="skip")


def test_fields_limit_the_parse(spark):
    df = records.parse_records(messages(spark, {"id": "1", "beat": "2"}, "junk"), CHICAGO_RECORD,
                               fields=["beat", "id"])
    assert df.columns == ["id", "beat"] and df.count() == 2
    with pytest.raises(ValueError, match="kept"):
        records.parse_records(messages(spark, "{}"), CHICAGO_RECORD, "drop", ["id"])


def test_bad_field_is_null_and_the_rest_stays(spark):
    row, = parse(spark, CHICAGO_RECORD,
                 {"id": 200.0, "date": "yesterday", "arrest": "true", "beat": "7"})
    assert (row["id"], row["date"], row["arrest"], row["beat"]) == ("200.0", None, None, "7")


def test_integer_field_does_not_take_a_float(spark):
    rows = parse(spark, LA_RECORD, {"DR_NO": "1", "Vict Age": 36.0}, {"DR_NO": "2", "Vict Age": 36})
    assert [r["Vict Age"] for r in rows] == [None, 36]


def view(spark, *values, schema=CHICAGO_RECORD, **options):
    return records.chicago_view(
        records.parse_records(messages(spark, *values), schema), **options)


def test_chicago_view_columns_and_dates(spark):
    record = {"id": "9", "date": "2025-05-20T16:02:26.000", "updated_on": "2025-05-21T00:00:01.500"}
    for schema in (CHICAGO_RECORD, CHICAGO_RECORD_TEXT_DATES):
        df = view(spark, record, schema=schema)
        assert df.columns == CHICAGO_VIEW and len(CHICAGO_VIEW) == 22
        row, = df.collect()
        assert row["Date"] == "2025-05-20 16:02:26"
        assert row["Updated On"] == "2025-05-21 00:00:01"
        assert records.chicago_file_layout(df).columns == CHICAGO_FILE
    assert len(CHICAGO_FILE) == 21


@pytest.mark.parametrize("location, expected", [
    (None, None),
    ({}, {"latitude": "41.5", "longitude": "-87.5", "human_address": EMPTY_ADDRESS}),
    ({"latitude": "1.0"},
     {"latitude": "1.0", "longitude": "-87.5", "human_address": EMPTY_ADDRESS}),
    ({"latitude": "1.0", "longitude": "2.0", "human_address": "here"},
     {"latitude": "1.0", "longitude": "2.0", "human_address": "here"}),
])
@pytest.mark.parametrize("numeric", [False, True])
def test_location_json(spark, location, expected, numeric):
    record = {"id": "1", "latitude": "41.5", "longitude": "-87.5", "location": location}
    row, = view(spark, record, numeric_coordinates=numeric).collect()
    assert (row["location"] and json.loads(row["location"])) == expected


def test_location_json_leaves_out_parts_that_are_nowhere(spark):
    row, = view(spark, {"id": "1", "location": {"longitude": "2"}}).collect()
    assert json.loads(row["location"]) == {"longitude": "2", "human_address": EMPTY_ADDRESS}


def test_chicago_coordinates_as_numbers(spark):
    df = view(spark, {"latitude": "41.5", "longitude": "east"}, numeric_coordinates=True)
    row, = df.collect()
    assert (row["latitude"], row["longitude"]) == (41.5, None)


def test_seattle_view(spark):
    df = records.seattle_view(records.parse_records(messages(spark, {
        "report_number": "r", "latitude": "REDACTED", "longitude": "-122.25",
        "report_date_time": "2024-02-29T23:59:59.000", "nibrs_group_a_b": "A"}), SEATTLE_RECORD))
    assert df.columns == SEATTLE_VIEW and len(SEATTLE_VIEW) == 19
    row, = df.collect()
    assert row["latitude"] is None and row["longitude"] == -122.25
    assert row["Report Date Time"] == "2024-02-29 23:59:59"
    assert row["NIBRS Group A/B"] == "A" and row["Offense Date"] is None


@pytest.mark.parametrize("category, uk, la", [
    (None, "low", "high"), ("robbery", "high", "high"), ("ROBBERY", "low", "medium"),
    ("burglary", "medium", "high"), ("PANDERING", "low", "low"), ("else", "low", "high"),
])
def test_severity(spark, category, uk, la):
    df = spark.createDataFrame([(category,)], "c string")
    row = df.select(records.uk_severity("c").alias("uk"), records.la_severity("c").alias("la")).first()
    assert (row["uk"], row["la"]) == (uk, la)


UK = {"category": "drugs", "month": "2024-02", "location_type": "Force",
      "location": {"latitude": "51.5", "longitude": "x", "street": {"id": 1, "name": "High St"}},
      "outcome_status": {"category": "Under investigation", "date": "2024-03"}}
LA = {"DATE OCC": "03/01/2020 12:00:00 AM", "Crm Cd Desc": "PANDERING", "AREA": "3",
      "Premis Desc": "STREET", "Status": "IC", "Lat": 33.9, "Lon": -118.1}


def test_feeds_merge_by_name(spark):
    uk = records.uk_incidents(records.parse_records(messages(spark, UK), UK_RECORD))
    la = records.la_incidents(records.parse_records(messages(spark, LA), LA_RECORD))
    merged = union_all(la, uk)
    # Names and types; severity is never null, which its schema may say.
    assert [(f.name, f.dataType) for f in merged.schema] == [
        (f.name, f.dataType) for f in UNIFIED_INCIDENT]
    a, b = merged.orderBy("year").collect()
    assert (a["timestamp"].isoformat(), a["month"], a["year"]) == ("2020-03-01T00:00:00", 3, 2020)
    assert (a["crime_type"], a["AREA"], a["severity"]) == ("PANDERING", "3", "low")
    assert (b["timestamp"].isoformat(), b["AREA"]) == ("2024-02-01T00:00:00", "High St")
    assert (b["latitude"], b["longitude"], b["outcome_status"]) == (51.5, None, "Under investigation")


def test_uk_district_view(spark):
    df = records.uk_district_view(records.parse_records(messages(spark, UK), UK_RECORD))
    assert df.columns == ["timestamp", "crime_type", "district", "severity", "latitude",
                          "longitude", "outcome_status"]
    assert df.first()["district"] == "High St"


def test_align_titles_twice_is_once(spark):
    df = spark.createDataFrame([("1", "x", "q")], "id string, `Case Number` string, other string")
    once = records.align_titles(df)
    assert once.columns == ["ID", "Case Number", "other"]
    assert records.align_titles(once).columns == once.columns


def test_union_all_needs_a_frame(spark):
    with pytest.raises(ValueError):
        union_all()
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3, 4)], "b int, a int")
    c = spark.createDataFrame([(5,)], "a int")
    rows = union_all(a, b, c, allow_missing=True).collect()
    assert [tuple(r) for r in rows] == [(1, 2), (4, 3), (5, None)]
