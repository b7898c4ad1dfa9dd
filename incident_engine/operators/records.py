"""Messages to typed records, and records to the feed views."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from incident_engine.functions import scores, text, timestamps
from incident_engine.schemas import (
    CHICAGO_FILE,
    CHICAGO_TITLES,
    CHICAGO_VIEW,
    EMPTY_ADDRESS,
    LA_SEVERITY,
    LA_SEVERITY_DEFAULT,
    SEATTLE_TITLES,
    SEATTLE_VIEW,
    UK_SEVERITY,
    UK_SEVERITY_DEFAULT,
    UNIFIED_INCIDENT,
)

BAD_ROW_POLICIES = ("keep", "drop", "fail")

# Record fields that the merged incident table reads.
UK_INCIDENT_FIELDS = ["category", "location_type", "location", "outcome_status", "month"]
LA_INCIDENT_FIELDS = ["DATE OCC", "AREA", "Crm Cd Desc", "Premis Desc", "Status", "Lat", "Lon"]


def message_text(messages: DataFrame) -> DataFrame:
    """Message bytes to text; key and topic stay as they are."""
    return messages.withColumn("value", F.col("value").cast("string"))


def parse_records(messages: DataFrame, schema: StructType, bad_rows: str = "keep",
                  fields: list[str] | None = None) -> DataFrame:
    """JSON messages to flat columns under a fixed schema.

    A field that does not fit its type becomes null. Text that is no JSON gives
    a row of nulls, which is kept, dropped or made an error as ``bad_rows`` says.
    ``fields`` limits the parse to what is needed, which Spark cannot work out
    by itself once the record is spread over columns; a row is judged readable
    by all its fields, so the limit goes with kept rows only.
    """
    if bad_rows not in BAD_ROW_POLICIES:
        raise ValueError(f"bad_rows must be one of {BAD_ROW_POLICIES}, not {bad_rows!r}")
    if fields is not None:
        if bad_rows != "keep":
            raise ValueError("fields can be limited only where bad rows are kept")
        schema = StructType([f for f in schema.fields if f.name in fields])
    body = F.col("value").cast("string")
    records = messages.select(F.from_json(body, schema).alias("record")).select("record.*")
    if bad_rows == "keep":
        return records
    readable = reduce(or_, [F.col(f"`{name}`").isNotNull() for name in schema.fieldNames()])
    if bad_rows == "drop":
        return records.filter(readable)
    return records.filter(F.when(readable, True).otherwise(
        F.raise_error(F.lit("a message holds no readable record")).cast("boolean")))


def _time(df: DataFrame, name: str) -> Column:
    """The column as a time, parsed when the record schema left it as text."""
    is_text = isinstance(df.schema[name].dataType, StringType)
    return timestamps.parse_iso(name) if is_text else F.col(name)


def location_json(latitude: Column, longitude: Column) -> Column:
    """Location as JSON text: nested parts first, then the top-level values."""
    parts = F.struct(
        F.coalesce(F.col("location.latitude"), latitude.cast("string")).alias("latitude"),
        F.coalesce(F.col("location.longitude"), longitude.cast("string")).alias("longitude"),
        F.coalesce(F.col("location.human_address"), F.lit(EMPTY_ADDRESS)).alias("human_address"),
    )
    return F.when(F.col("location").isNotNull(), F.to_json(parts))


def chicago_view(records: DataFrame, numeric_coordinates: bool = False) -> DataFrame:
    """The 22-column Chicago view: titles, dates as text, location as JSON text.

    Records that were parsed without their location give the file layout.
    """
    df = align_titles(records)
    place = {name: F.col(name) for name in ("latitude", "longitude")}
    if numeric_coordinates:
        place = {name: text.to_double(c) for name, c in place.items()}
    computed = {
        "Date": timestamps.to_text(_time(df, "Date")),
        "Updated On": timestamps.to_text(_time(df, "Updated On")),
        **place,
    }
    if "location" in df.columns:
        computed["location"] = location_json(**place)
    layout = CHICAGO_VIEW if "location" in df.columns else CHICAGO_FILE
    return df.select(*[computed.get(name, F.col(name)).alias(name) for name in layout])


def chicago_file_layout(view: DataFrame) -> DataFrame:
    """The 21 columns that the Chicago files hold: the view without location."""
    return view.select(*CHICAGO_FILE)


def seattle_view(records: DataFrame) -> DataFrame:
    """The 19-column Seattle view, which is also its file layout."""
    df = records.withColumnsRenamed(SEATTLE_TITLES)
    computed = {
        "Report Date Time": timestamps.to_text(_time(df, "Report Date Time")),
        "Offense Date": timestamps.to_text(_time(df, "Offense Date")),
        "latitude": text.to_double("latitude"),
        "longitude": text.to_double("longitude"),
    }
    return df.select(*[computed.get(name, F.col(name)).alias(name) for name in SEATTLE_VIEW])


def align_titles(df: DataFrame, titles: dict[str, str] = CHICAGO_TITLES) -> DataFrame:
    """Bring field names to their titles; names already aligned stay."""
    return df.withColumnsRenamed(titles)


def uk_severity(category: Column | str) -> Column:
    return scores.classify(category, UK_SEVERITY, UK_SEVERITY_DEFAULT)


def la_severity(description: Column | str) -> Column:
    return scores.classify(description, LA_SEVERITY, LA_SEVERITY_DEFAULT)


def _incident(source: DataFrame, when: Column, **columns: Column) -> DataFrame:
    """Project a feed to the merged incident table, in its column order."""
    columns |= {"timestamp": when, "month": F.month(when), "year": F.year(when)}
    return source.select(*[
        columns[f.name].cast(f.dataType).alias(f.name) for f in UNIFIED_INCIDENT.fields
    ])


def uk_incidents(records: DataFrame) -> DataFrame:
    """UK records in the merged layout; the street name stands for the area."""
    return _incident(
        records,
        timestamps.parse_month("month"),
        crime_type=F.col("category"),
        AREA=F.col("location.street.name"),
        severity=uk_severity("category"),
        latitude=text.to_double("location.latitude"),
        longitude=text.to_double("location.longitude"),
        location=F.col("location_type"),
        outcome_status=F.col("outcome_status.category"),
    )


def uk_district_view(records: DataFrame) -> DataFrame:
    """The 7-column UK table, with the area under the name ``district``."""
    return (
        uk_incidents(records)
        .withColumnRenamed("AREA", "district")
        .select("timestamp", "crime_type", "district", "severity",
                "latitude", "longitude", "outcome_status")
    )


def la_incidents(records: DataFrame) -> DataFrame:
    """LA records in the merged layout."""
    return _incident(
        records,
        timestamps.parse_12h("DATE OCC"),
        crime_type=F.col("Crm Cd Desc"),
        AREA=F.col("AREA"),
        severity=la_severity("Crm Cd Desc"),
        latitude=F.col("Lat"),
        longitude=F.col("Lon"),
        location=F.col("Premis Desc"),
        outcome_status=F.col("Status"),
    )
