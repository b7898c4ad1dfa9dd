"""Message schemas, rename maps and output layouts.

Everything in this module is a fixed value: field names, types, titles and
column orders are the public contract of the feeds and of the written files.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

def record(fields: list[str], **typed) -> StructType:
    """Nullable struct in field order; text unless ``typed`` names another type.

    Keys of ``typed`` use underscores where the field name has spaces.
    """
    out = StructType()
    for name in fields:
        out.add(name, typed.get(name.replace(" ", "_"), "string"))
    return out


# Chicago record, 22 fields. The two date fields are typed or left as text.
_CHICAGO_FIELDS = [
    "id", "case_number", "date", "block", "iucr", "primary_type", "description",
    "location_description", "arrest", "domestic", "beat", "district", "ward",
    "community_area", "fbi_code", "x_coordinate", "y_coordinate", "year", "updated_on",
    "latitude", "longitude", "location",
]
_CHICAGO_TYPES = {
    "arrest": "boolean",
    "domestic": "boolean",
    "location": record(["latitude", "longitude", "human_address"]),
}
CHICAGO_RECORD = record(_CHICAGO_FIELDS, date="timestamp", updated_on="timestamp", **_CHICAGO_TYPES)
CHICAGO_RECORD_TEXT_DATES = record(_CHICAGO_FIELDS, **_CHICAGO_TYPES)

# Seattle record, 19 fields.
SEATTLE_RECORD = record(
    [
        "report_number", "report_date_time", "offense_id", "offense_date", "nibrs_group_a_b",
        "nibrs_crime_against_category", "offense_sub_category", "shooting_type_group",
        "block_address", "latitude", "longitude", "beat", "precinct", "sector",
        "neighborhood", "reporting_area", "offense_category",
        "nibrs_offense_code_description", "nibrs_offense_code",
    ],
    report_date_time="timestamp",
    offense_date="timestamp",
)

# UK record, nested two levels; month is yyyy-MM text.
UK_RECORD = record(
    [
        "category", "location_type", "location", "context", "outcome_status",
        "persistent_id", "id", "location_subtype", "month",
    ],
    location=record(["latitude", "street", "longitude"], street=record(["id", "name"])),
    outcome_status=record(["category", "date"]),
)

# LA record, 28 columns with spaces in the names.
LA_RECORD = record(
    [
        "DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA", "AREA NAME", "Rpt Dist No",
        "Part 1-2", "Crm Cd", "Crm Cd Desc", "Mocodes", "Vict Age", "Vict Sex",
        "Vict Descent", "Premis Cd", "Premis Desc", "Weapon Used Cd", "Weapon Desc",
        "Status", "Status Desc", "Crm Cd 1", "Crm Cd 2", "Crm Cd 3", "Crm Cd 4",
        "LOCATION", "Cross Street", "Lat", "Lon",
    ],
    Vict_Age="integer",
    Lat="double",
    Lon="double",
)

# Titles that the written files use in place of the message field names.
CHICAGO_TITLES = {
    "id": "ID",
    "case_number": "Case Number",
    "date": "Date",
    "block": "Block",
    "iucr": "IUCR",
    "primary_type": "Primary Type",
    "description": "Description",
    "location_description": "Location Description",
    "community_area": "Community Area",
    "fbi_code": "FBI Code",
    "x_coordinate": "X Coordinate",
    "y_coordinate": "Y Coordinate",
    "updated_on": "Updated On",
}
SEATTLE_TITLES = {
    "report_number": "Report Number",
    "report_date_time": "Report Date Time",
    "offense_id": "Offense ID",
    "offense_date": "Offense Date",
    "nibrs_group_a_b": "NIBRS Group A/B",
    "nibrs_crime_against_category": "NIBRS Crime Against Category",
    "offense_sub_category": "Offense Sub Category",
    "shooting_type_group": "Shooting Type Group",
    "block_address": "Block Address",
    "beat": "Beat",
    "precinct": "Precinct",
    "sector": "Sector",
    "neighborhood": "Neighborhood",
    "reporting_area": "Reporting Area",
    "offense_category": "Offense Category",
    "nibrs_offense_code_description": "NIBRS Offense Code Description",
    "nibrs_offense_code": "NIBRS Offense Code",
}

# An address part that the Chicago location column carries when it has none.
EMPTY_ADDRESS = '{"address": "", "city": "", "state": "", "zip": ""}'


def titled(schema: StructType, titles: dict[str, str]) -> list[str]:
    """Layout of a feed view: the record's field order under its titles."""
    return [titles.get(name, name) for name in schema.fieldNames()]


CHICAGO_VIEW = titled(CHICAGO_RECORD, CHICAGO_TITLES)
CHICAGO_FILE = [name for name in CHICAGO_VIEW if name != "location"]
SEATTLE_VIEW = titled(SEATTLE_RECORD, SEATTLE_TITLES)

# The merged incident table.
UNIFIED_INCIDENT = record(
    [
        "timestamp", "month", "year", "crime_type", "AREA", "severity", "latitude",
        "longitude", "location", "outcome_status",
    ],
    timestamp="timestamp", month="integer", year="integer", latitude="double", longitude="double",
)

# Severity classes by feed; anything else, null included, takes the default.
UK_SEVERITY = {
    "high": ["violent-crime", "robbery", "possession-of-weapons"],
    "medium": ["burglary", "vehicle-crime", "theft-from-the-person"],
}
UK_SEVERITY_DEFAULT = "low"
LA_SEVERITY = {
    "medium": ["VEHICLE - STOLEN", "BURGLARY FROM VEHICLE", "ROBBERY", "RESISTING ARREST"],
    "low": ["BIKE - STOLEN", "SHOPLIFTING-GRAND THEFT ($950.01 & OVER)", "PANDERING"],
}
LA_SEVERITY_DEFAULT = "high"

# Text forms of dates in the feeds (Spark patterns).
TEXT_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
MONTH_TEXT = "yyyy-MM"
TWELVE_HOUR_TEXT = "MM/dd/yyyy hh:mm:ss a"

# Analysis parameters.
CELL_SIZE = 0.006
HOT_SPOTS = 120
TRAILING_MONTHS = 12
HIT_THRESHOLD = 0.5
HOLDOUT_SHARE = 0.2
DEFAULT_RATE = 5.0
HOLIDAY_MONTHS = (1, 7, 12)
PAGE_SIZE = 1000
