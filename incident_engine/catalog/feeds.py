"""Feeds derived from the given tables.

Each feed is one SELECT that Spark and DuckDB both run unchanged. Coordinates
are laid out so that no point lies on the edge of a cell or of a polygon.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine.sources.messages import as_messages

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"

# Columns of the given tables that the feeds read.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}

# feed name -> (tables it reads, query)
FEEDS: dict[str, tuple[tuple[str, ...], str]] = {
    "inc": (("lineitem",), """
        select l_orderkey, cast(l_linenumber as bigint) as line_no, l_shipdate as occurred_at,
          cast(l_suppkey % 20 as varchar(10)) as area,
          -87.94e0 + ((l_partkey*37 + l_linenumber*11) % 200)*0.00042e0 + 0.0001e0 as lon,
          41.64e0 + ((l_suppkey*53 + l_linenumber*7) % 200)*0.00038e0 + 0.0001e0 as lat,
          cast(l_partkey % 8 as bigint) as cat_no
        from {lineitem}"""),
    "chi": (("events",), """
        select cast(event_id as varchar(20)) as id,
          concat('JA', lpad(cast(event_id as varchar(20)), 6, '0')) as case_number,
          ts as date_ts, ts + (event_id % 72) * interval '1' hour as updated_ts,
          upper(event_type) as primary_type, event_type = 'error' as arrest, value > 50 as domestic,
          cast(user_id % 25 as varchar(10)) as beat,
          cast(user_id % 77 + 1 as varchar(10)) as community_area,
          concat('41.', lpad(cast(640000 + (user_id*53 + event_id*7) % 76000 as varchar(10)), 6, '0'))
            as latitude,
          concat('-87.', lpad(cast(856000 + (user_id*37 + event_id*11) % 84000 as varchar(10)), 6, '0'))
            as longitude,
          event_id % 5 <> 0 as has_location, event_id % 7 <> 0 as has_nested_lat, event_id
        from {events}"""),
    "sea": (("events",), """
        select cast(event_id as varchar(20)) as report_number, ts as report_ts,
          ts - (event_id % 48) * interval '1' hour as offense_ts, event_type as offense_category,
          case when event_id % 11 = 0 then 'REDACTED' else
            concat('47.', lpad(cast(500000 + (user_id*53 + event_id*7) % 200000 as varchar(10)), 6, '0'))
          end as latitude,
          concat('-122.', lpad(cast(250000 + (user_id*37 + event_id*11) % 180000 as varchar(10)), 6, '0'))
            as longitude,
          cast(user_id % 17 as varchar(10)) as beat, cast(user_id % 5 as varchar(10)) as precinct
        from {events}"""),
    "uk": (("orders",), """
        select cast(o_orderkey as varchar(20)) as id, cast(o_orderkey % 8 as bigint) as cat_no,
          concat('51.', lpad(cast(300000 + (o_custkey*53 + o_orderkey*7) % 400000 as varchar(10)), 6, '0'))
            as latitude,
          concat('-0.', lpad(cast((o_custkey*37 + o_orderkey*11) % 500000 as varchar(10)), 6, '0'))
            as longitude,
          concat('On or near ', cast(o_custkey % 50 as varchar(10))) as street_name,
          case when o_orderstatus = 'O' then null else o_orderstatus end as outcome_category,
          cast(extract(year from o_orderdate) as bigint) as y,
          cast(extract(month from o_orderdate) as bigint) as mo,
          concat(cast(extract(year from o_orderdate) as varchar(4)), '-',
            lpad(cast(extract(month from o_orderdate) as varchar(2)), 2, '0')) as month,
          case o_orderkey % 8 when 0 then 'violent-crime' when 1 then 'robbery'
            when 2 then 'possession-of-weapons' when 3 then 'burglary' when 4 then 'vehicle-crime'
            when 5 then 'theft-from-the-person' when 6 then 'shoplifting' else 'drugs' end as category
        from {orders}"""),
    "la": (("events",), """
        select cast(event_id as varchar(20)) as dr_no, ts as occ_ts,
          case event_id % 10 when 0 then 'VEHICLE - STOLEN' when 1 then 'BURGLARY FROM VEHICLE'
            when 2 then 'ROBBERY' when 3 then 'RESISTING ARREST' when 4 then 'BIKE - STOLEN'
            when 5 then 'SHOPLIFTING-GRAND THEFT ($950.01 & OVER)' when 6 then 'PANDERING'
            when 7 then 'ARSON' when 8 then 'VANDALISM' end as crime,
          cast(user_id % 21 as varchar(10)) as area,
          33.7e0 + (user_id % 100)*0.005e0 as lat,
          -118.6e0 + (event_id % 100)*0.005e0 as lon, event_type as premis,
          case when event_id % 3 = 0 then 'AO' else 'IC' end as status
        from {events}"""),
    "rate": (("lineitem",), """
        select distinct cast(extract(year from l_shipdate) as bigint) as year,
          cast(extract(month from l_shipdate) as bigint) as month,
          cast(l_suppkey % 20 as varchar(10)) as area,
          3.0e0 + ((l_suppkey % 20)*7 + extract(month from l_shipdate)) % 50 / 10.0e0
            as unemployment_rate
        from {lineitem} where (l_suppkey % 20 + extract(month from l_shipdate)) % 3 <> 0"""),
    # One L-shaped precinct per supplier with gaps between them: the union of the
    # boxes [xa,xc]x[ya,yb] and [xa,xb]x[ya,yc]. They stand in blocks of five by
    # five, forty blocks to a row; the first block lies over the incidents.
    "precincts": (("supplier", "nation"), """
        select force, neighbourhood, xa, xa + 0.006733e0 as xb, xa + 0.015133e0 as xc,
          ya, ya + 0.005913e0 as yb, ya + 0.013313e0 as yc
        from (select n_name as force,
          concat('Precinct ', cast(s_suppkey as varchar(20))) as neighbourhood,
          -87.940005e0 + (s_suppkey % 5 + floor(s_suppkey / 25) % 40 * 5)*0.02131e0 as xa,
          41.639995e0 + (floor(s_suppkey / 5) % 5 + floor(s_suppkey / 1000) * 5)*0.01873e0 as ya
          from {supplier} join {nation} on s_nationkey = n_nationkey) as placed"""),
}

PRECINCT = ["force", "neighbourhood"]


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, query = FEEDS[name]
    frames = {t: spark.read.schema(TABLES[t]).parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    return spark.sql(query, **frames)


def feed_sql(name: str) -> str:
    """The feed as SQL over the plain table names."""
    tables, query = FEEDS[name]
    return query.format(**{t: t for t in tables})


def precinct_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``force, neighbourhood, ring``: precincts as closed rings."""
    corners = ["xa ya", "xc ya", "xc yb", "xb yb", "xb yc", "xa yc", "xa ya"]
    points = [F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
              for x, y in (c.split() for c in corners)]
    return feed(spark, sf_dir, "precincts").select(*PRECINCT, F.array(*points).alias("ring"))


def chi_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chicago JSON messages; location and its latitude are absent where the feed says."""
    df = feed(spark, sf_dir, "chi")
    nested = F.struct(
        F.when(F.col("has_nested_lat"), F.col("latitude")).alias("latitude"), "longitude")
    record = F.struct(
        "id", "case_number", F.date_format("date_ts", ISO_MILLIS).alias("date"), "primary_type",
        "arrest", "domestic", "beat", "community_area",
        F.date_format("updated_ts", ISO_MILLIS).alias("updated_on"), "latitude", "longitude",
        F.when(F.col("has_location"), nested).alias("location"),
    )
    return as_messages(df, F.col("id"), F.to_json(record), F.lit("chicago"))


def sea_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feed(spark, sf_dir, "sea")
    record = F.struct(
        "report_number", F.date_format("report_ts", ISO_MILLIS).alias("report_date_time"),
        F.date_format("offense_ts", ISO_MILLIS).alias("offense_date"), "offense_category",
        "latitude", "longitude", "beat", "precinct",
    )
    return as_messages(df, F.col("report_number"), F.to_json(record), F.lit("seattle"))


def uk_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UK JSON messages, one topic per month."""
    df = feed(spark, sf_dir, "uk")
    street = F.struct(F.lit("0").alias("id"), F.col("street_name").alias("name"))
    outcome = F.when(F.col("outcome_category").isNotNull(),
                     F.struct(F.col("outcome_category").alias("category")))
    record = F.struct(
        "category", F.lit("Force").alias("location_type"), "id", "month",
        F.struct("latitude", street.alias("street"), "longitude").alias("location"),
        outcome.alias("outcome_status"),
    )
    return as_messages(df, F.col("id"), F.to_json(record), F.col("month"))


def la_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LA rows under their file column names."""
    return feed(spark, sf_dir, "la").select(
        F.col("dr_no").alias("DR_NO"),
        F.date_format("occ_ts", "MM/dd/yyyy hh:mm:ss a").alias("DATE OCC"),
        F.col("area").alias("AREA"), F.col("crime").alias("Crm Cd Desc"),
        F.col("premis").alias("Premis Desc"), F.col("status").alias("Status"),
        F.col("lat").alias("Lat"), F.col("lon").alias("Lon"),
        F.lit(None).cast("string").alias("Cross Street"),
    )
