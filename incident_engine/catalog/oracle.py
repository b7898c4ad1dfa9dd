"""The same results in plain SQL, for the queries that SQL can express.

Shapes are stated differently from the operators on purpose: boxes instead of
rings, range comparisons instead of cell covers, joins instead of windows.
"""

from __future__ import annotations

from incident_engine.catalog import queries as q
from incident_engine.catalog.feeds import FEEDS, feed_sql

_TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _ts(expr: str) -> str:
    return _TS.format(expr)


# The inputs of the ridge model for the month {m}: waves over the days since 1970, then regressors.
_INPUTS = "[" + ", ".join(
    [f"{f}(date_diff('day', date '1970-01-01', {{m}}::date) * 2 * pi() * {k} / {period})"
     for period, order in (("365.25e0", 10), ("7e0", 3)) for k in range(1, order + 1)
     for f in ("sin", "cos")]
    + ["month({m})::double", "year({m})::double", "day(last_day({m}))::double",
       "sin(2*pi()*month({m})/12)", "cos(2*pi()*month({m})/12)",
       "sin(2*pi()*(isodow({m}) - 1)/7)", "cos(2*pi()*(isodow({m}) - 1)/7)",
       "(month({m}) in (1, 7, 12))::double", "{rate}"]) + "]"

# Shared steps: name -> (steps it needs, query).
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "ext": (("precincts",), """
        select min(xa) as x0, min(ya) as y0, max(xc) as x1, max(yc) as y1 from precincts"""),
    "boxes": (("precincts",), """
        select force, neighbourhood, xa as bx0, xc as bx1, ya as by0, yb as by1 from precincts
        union all
        select force, neighbourhood, xa, xb, ya, yc from precincts"""),
    "allcells": (("ext",), """
        select ix, iy, x0 + ix*0.006e0 as xmin, y0 + iy*0.006e0 as ymin,
          x0 + ix*0.006e0 + 0.006e0 as xmax, y0 + iy*0.006e0 + 0.006e0 as ymax
        from (select *, unnest(range(cast(ceil((y1 - y0)/0.006e0) as bigint))) as iy from (
          select *, unnest(range(cast(ceil((x1 - x0)/0.006e0) as bigint))) as ix from ext))"""),
    "grid": (("allcells", "boxes"), """
        select row_number() over (order by ix, iy) - 1 as grid_id, ix, iy, xmin, ymin, xmax, ymax
        from allcells where exists (select 1 from boxes
          where bx0 <= xmax and bx1 >= xmin and by0 <= ymax and by1 >= ymin)"""),
    "located": (("inc", "ext"), """
        select inc.*, cast(floor((lon - x0)/0.006e0) as bigint) as ix,
          cast(floor((lat - y0)/0.006e0) as bigint) as iy from inc, ext"""),
    "gridded": (("located", "grid"), """
        select located.*, grid_id from located left join grid on located.ix = grid.ix
          and located.iy = grid.iy and lon > xmin and lon < xmax and lat > ymin and lat < ymax"""),
    "counted": (("gridded",), """
        select grid_id, ix, iy, date_trunc('month', occurred_at) as m, count(*) as n
        from gridded where grid_id is not null group by all"""),
    "dense": (("counted",), """
        select c.grid_id, c.ix, c.iy, months.m, coalesce(n, 0) as n
        from (select distinct grid_id, ix, iy from counted) c
        cross join (select distinct m from counted) months
        left join counted on counted.grid_id = c.grid_id and counted.m = months.m"""),
    "scored": (("dense",), """
        select *, 1 - exp(-mu) as p, case when 1 - exp(-mu) > 0.5 and n > 0 then 1 else 0 end as flag
        from (select *, avg(n) over (partition by grid_id order by m
              rows between 12 preceding and 1 preceding) as mu,
            row_number() over (partition by grid_id order by m) as rn from dense)
        where rn > 12"""),
    "latest": (("inc",), """
        select date_trunc('month', max(occurred_at)) as last_m from inc"""),
    "rates": (("scored", "dense"), """
        select c.grid_id, c.ix, c.iy, avg_tp from (select distinct grid_id, ix, iy from dense) c
        left join (select grid_id, avg(flag) as avg_tp from scored group by grid_id) s
          on s.grid_id = c.grid_id"""),
    "prev": (("dense", "latest"), """
        select grid_id, ix, iy, n as prev_n from dense, latest where m = last_m"""),
    "ranked": (("rates", "prev"), """
        select rates.*, prev_n, row_number() over (
          order by avg_tp desc nulls last, prev_n desc nulls last, rates.grid_id) as rk
        from rates join prev on prev.grid_id = rates.grid_id
        qualify rk <= 120"""),
    "areas": (("inc",), """
        select area, year(occurred_at) as year, month(occurred_at) as month,
          date_trunc('month', occurred_at) as m, count(*) as crime_count from inc group by all"""),
    "split": (("areas",), """
        select *, rn > n - cast(ceil(n * 0.2e0) as bigint) as is_test,
          year*12 + month - min(year*12 + month) over (partition by area) as t
        from (select *, row_number() over (partition by area order by m) as rn,
            count(*) over (partition by area) as n from areas) where n > 2"""),
    "lines": (("split",), """
        select area, min(year*12 + month) as origin,
          regr_slope(crime_count, t) filter (not is_test) as b,
          regr_intercept(crime_count, t) filter (not is_test) as a
        from split group by area"""),
    "designed": (("split", "rate"), """
        select split.*, """ + _INPUTS.format(m="split.m", rate="coalesce(unemployment_rate, 5.0e0)") + """ as x
        from split left join rate on rate.area = split.area and rate.year = split.year
          and rate.month = split.month"""),
    "trained": (("designed", "lines"), """
        select d.*, a + b*d.t as trend, a, b, origin,
          sqrt(avg((a + b*d.t)^2) over (partition by d.area)) as level
        from designed d join lines on lines.area = d.area where not is_test"""),
    "spread": (("trained",), """
        select area, list(mean order by i) as c, list(case when dev > 1e-9 then dev else 1 end order by i) as s
        from (select area, i, avg(x[i]) as mean, stddev_pop(x[i]) as dev
          from trained, unnest(range(1, 36)) u(i) group by area, i) group by area"""),
    "equations": (("trained", "spread"), """
        select area, i, list(p order by j) as r
        from (select area, i, j, sum(u[i] * u[j]) + case when i = j then 1 else 0 end as p
          from (select t.area, list_append(list_transform(x, lambda v, k: (v - c[k]) / s[k]
                * trend / level), (crime_count - trend) / level) as u
              from trained t join spread on spread.area = t.area) z,
            unnest(range(1, 36)) n(i), unnest(range(1, 37)) o(j) group by area, i, j)
        group by area, i"""),
    # elimination, one row and column after the other
    "weights": (("equations", "trained", "spread"), """
        with recursive solving(area, k, m) as (
          select area, 1, list(r order by i) from equations group by area
          union all
          select area, k + 1, list_transform(m, lambda r, i: case when i = k
              then list_transform(r, lambda v: v / m[k][k])
              else list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) end)
          from solving where k <= 35)
        select g.area, list_transform(m, lambda r: r[36]) as w, c, s, n_train, a, b, origin
        from solving g join spread on spread.area = g.area join (
          select area, count(*) as n_train, any_value(a) as a, any_value(b) as b,
            any_value(origin) as origin from trained group by area) l on l.area = g.area
        where k = 36"""),
    "seasons": (("split", "lines"), """
        select split.area, month, avg(crime_count / (a + b*t)) as idx
        from split join lines on lines.area = split.area where not is_test group by all"""),
    "fitted": (("split", "lines", "seasons"), """
        select split.*, greatest((a + b*t) * coalesce(idx, 1), 0) as yhat
        from split join lines on lines.area = split.area
        left join seasons on seasons.area = split.area and seasons.month = split.month"""),
}

_CALENDAR = """
    strftime({m}, '%Y-%m-%d') as ds, day(last_day({m})) as days_in_month,
    isodow({m}) - 1 as day_of_week, cast(month({m}) in (1, 7, 12) as bigint) as is_holiday,
    round(sin(2*pi()*month({m})/12), 9) as month_sin, round(cos(2*pi()*month({m})/12), 9) as month_cos,
    round(sin(2*pi()*(isodow({m}) - 1)/7), 9) as day_of_week_sin,
    round(cos(2*pi()*(isodow({m}) - 1)/7), 9) as day_of_week_cos"""

_WORK = """select force, neighbourhood, month
    from precincts, (select distinct month from uk) listed"""
_CORNERS = ("round(xmin, 9) as xmin, round(ymin, 9) as ymin, "
            "round(xmax, 9) as xmax, round(ymax, 9) as ymax")
_POLY = """
    select force, neighbourhood, concat_ws(':', y1||','||x1, y1||','||x3, y2||','||x3,
      y2||','||x2, y3||','||x2, y3||','||x1, y1||','||x1) as poly
    from (select force, neighbourhood, {cols} from precincts)""".format(cols=", ".join(
        f"cast(cast({c} as decimal(12,6)) as varchar) as {a}"
        for c, a in [("xa", "x1"), ("xb", "x2"), ("xc", "x3"),
                     ("ya", "y1"), ("yb", "y2"), ("yc", "y3")]))
_UK_SEVERITY = """case when cat_no in (0, 1, 2) then 'high' when cat_no in (3, 4, 5) then 'medium'
    else 'low' end"""
_LA_SEVERITY = """case when cast(dr_no as bigint) % 10 between 0 and 3 then 'medium'
    when cast(dr_no as bigint) % 10 between 4 and 6 then 'low' else 'high' end"""
_UK_ROWS = f"""
    select {_ts("make_timestamp(y, mo, 1, 0, 0, 0)")} as timestamp, mo as month, y as year,
      category as crime_type, street_name as "AREA", {_UK_SEVERITY} as severity,
      cast(latitude as double) as latitude, cast(longitude as double) as longitude,
      'Force' as location, outcome_category as outcome_status from uk"""
_LA_ROWS = f"""
    select {_ts("occ_ts")} as timestamp, month(occ_ts) as month, year(occ_ts) as year,
      crime as crime_type, area as "AREA", {_LA_SEVERITY} as severity,
      lat as latitude, lon as longitude, premis as location, status as outcome_status from la"""
_CHI_COLUMNS = f"""
    id as "ID", case_number as "Case Number", {_ts("date_ts")} as "Date",
    cast(null as varchar) as "Block", cast(null as varchar) as "IUCR",
    primary_type as "Primary Type", cast(null as varchar) as "Description",
    cast(null as varchar) as "Location Description", arrest, domestic, beat,
    cast(null as varchar) as district, cast(null as varchar) as ward,
    community_area as "Community Area", cast(null as varchar) as "FBI Code",
    cast(null as varchar) as "X Coordinate", cast(null as varchar) as "Y Coordinate",
    cast(null as varchar) as year, {_ts("updated_ts")} as "Updated On", latitude, longitude"""
_SEA_NULLS = ", ".join(f'cast(null as varchar) as "{c}"' for c in [
    "Offense ID", "NIBRS Group A/B", "NIBRS Crime Against Category", "Offense Sub Category",
    "Shooting Type Group", "Block Address", "Sector", "Neighborhood", "Reporting Area",
    "NIBRS Offense Code Description", "NIBRS Offense Code"])
_PAGE_COLUMNS = f"id, {_ts('updated_ts')} as updated_on"
_KEYED = """select case when event_id % 50 <> 0 then id end as key, id as id_in_value from chi"""
_INSIDE = """lon > bx0 and lon < bx1 and lat > by0 and lat < by1"""
_START = f"date '{q.HORIZON[0]}-{q.HORIZON[1]:02d}-01'"

# query name -> (steps it reads, SELECT)
_SELECTS: dict[str, tuple[tuple[str, ...], str]] = {
    "src_messages": (("chi",), "select id, true as value_len_ok from chi"),
    "src_multi_topic": (("uk",), "select month as topic, count(*) as n from uk group by month"),
    "csv_to_messages": (("la",), "select dr_no, premis, status, true as has_null_key from la"),
    "pull_since_mark": (("chi",), f"""
        select {_PAGE_COLUMNS} from chi where updated_ts > timestamp '{q.MARK}'"""),
    "pull_page": (("chi",), f"""
        select {_PAGE_COLUMNS} from (select * from chi order by updated_ts desc, event_id
          limit 1000 offset 1000)"""),
    "pull_page_deep": (("chi",), f"""
        select {_PAGE_COLUMNS} from (select *, row_number() over (
            order by updated_ts desc, event_id) - 1 as place, count(*) over () as n from chi)
        where place >= n * {q.DEEP_PAGE[0]} // {q.DEEP_PAGE[1]}
          and place < n * {q.DEEP_PAGE[0]} // {q.DEEP_PAGE[1]} + 1000"""),
    "csv_infer_round_trip": (("la",), """
        select dr_no::bigint as dr_no, area::bigint as area, premis, status, round(lat, 6) as lat,
          round(lon, 6) as lon from la"""),
    "csv_batches_round_trip": (("chi",), """
        select id, primary_type, (event_id % 3)::bigint as batch_id from chi"""),
    "side_table_round_trip": (("areas", "rate"), """
        select areas.area, areas.year, areas.month,
          round(coalesce(unemployment_rate, 5.0e0), 6) as unemployment_rate, 5.0e0 as rate_without_file
        from areas left join rate on rate.area = areas.area and rate.year = areas.year
          and rate.month = areas.month"""),
    "geojson_round_trip": (("grid",), """
        select grid_id, round(xmin, 9) as xmin, round(xmax, 9) as xmax, round(ymin, 9) as ymin,
          round(ymax, 9) as ymax, 5::bigint as points from grid"""),
    "preview_rows": (("la",), """
        select least(25, count(*)) as n, least(25, count(distinct dr_no)) as ids from la"""),
    "csv_skip_long": (("la",), """
        select dr_no, area, premis, status from la where dr_no::bigint % 13 <> 0"""),
    "pull_next_mark": (("chi",), f"""
        select {_ts(f"greatest(max(updated_ts), timestamp '{q.MARK}')")} as next_mark from chi"""),
    "stream_pull": (("chi",), f"""
        select {_PAGE_COLUMNS}, 1::bigint as n,
          case when updated_ts > timestamp '{q.MARK}' then 1 else 0 end::bigint as batch_id from chi"""),
    "stream_chicago": (("chi",), f"select {_CHI_COLUMNS} from chi"),
    "stream_seattle": (("sea",), f"""
        select report_number as "Report Number", {_ts("report_ts")} as "Report Date Time",
          {_ts("offense_ts")} as "Offense Date", try_cast(latitude as double) as latitude,
          try_cast(longitude as double) as longitude, beat as "Beat", precinct as "Precinct",
          offense_category as "Offense Category", {_SEA_NULLS} from sea"""),
    "mark_round_trip": (("chi",), f"""
        select cycle, count(*) as n, count(distinct id) as ids, {_ts("max(updated_ts)")} as mark
        from (select chi.*, (select count(*) from unnest([1, 2, 3]) u(i)
            where cast(updated_ts as date) >= days[len(days) * i // 4 + 1]) as cycle
          from chi, (select list(distinct cast(updated_ts as date) order by
            cast(updated_ts as date)) as days from chi)) group by cycle"""),
    "collect_worklist": (("precincts", "uk"), _WORK),
    "collect_in_polygon": (("inc", "boxes"), f"""
        select force, neighbourhood, strftime(occurred_at, '%Y-%m') as month, count(*) as n
        from (select distinct force, neighbourhood, pos, occurred_at from boxes join (
          select row_number() over () as pos, * from inc) p on {_INSIDE})
        group by all"""),
    "collect_by_worklist": (("inc", "boxes", "precincts", "uk"), f"""
        select force, neighbourhood, month, count(*) as n
        from (select distinct force, neighbourhood, pos, strftime(occurred_at, '%Y-%m') as month
          from boxes join (select row_number() over () as pos, * from inc) p on {_INSIDE}) found
        semi join ({_WORK}) w using (force, neighbourhood, month)
        group by all"""),
    "sink_keyed_json": (("chi",), f"select * from ({_KEYED}) where key is not null"),
    "sink_keyed_json_nullkey": (("chi",), _KEYED),
    "sink_topic_route": (("uk",), "select month as topic, count(*) as n from uk group by month"),
    "json_parse_chi": (("chi",), f"""
        select id, {_ts("date_ts")} as date, arrest, latitude,
          case when has_location and has_nested_lat then latitude end as loc_latitude from chi"""),
    "json_parse_bad": (("chi",), """
        select count(*) filter (event_id % 13 <> 0) as parsed,
          count(*) filter (event_id % 13 = 0) as null_rows from chi"""),
    "chi_format": (("chi",), f"select {_CHI_COLUMNS}, has_location as location from chi"),
    "chi_sink_layout": (("chi",), f"select {_CHI_COLUMNS} from chi"),
    "chi_location_json": (("chi",), """
        select id, case when has_location then latitude end as lat,
          case when has_location then longitude end as lon,
          case when has_location then '{"address": "", "city": "", "state": "", "zip": ""}' end
            as human_address from chi"""),
    "sea_format": (("sea",), f"""
        select report_number as "Report Number", {_ts("report_ts")} as "Report Date Time",
          {_ts("offense_ts")} as "Offense Date", try_cast(latitude as double) as latitude,
          try_cast(longitude as double) as longitude, beat as "Beat", precinct as "Precinct",
          offense_category as "Offense Category", {_SEA_NULLS} from sea"""),
    "align_columns": (("chi",), f"""
        select id as "ID", case_number as "Case Number", {_ts("date_ts")} as "Date",
          primary_type as "Primary Type", community_area as "Community Area", beat from chi"""),
    "uk_normalize": (("uk",), _UK_ROWS),
    "uk_severity": (("uk",), f"select {_UK_SEVERITY} as severity, count(*) as n from uk group by all"),
    "uk_district_view": (("uk",), f"""
        select timestamp, crime_type, "AREA" as district, severity, latitude, longitude,
          outcome_status from ({_UK_ROWS})"""),
    "la_normalize": (("la",), _LA_ROWS),
    "la_severity": (("la",), f"select {_LA_SEVERITY} as severity, count(*) as n from la group by all"),
    "unified_incidents": (("la", "uk"), f"{_LA_ROWS} union all by name {_UK_ROWS}"),
    "union_topics": (("chi", "sea", "uk", "la"), """
        select 'chicago' as topic, cast(id as varchar) as id from chi
        union all select 'seattle', cast(report_number as varchar) from sea
        union all select 'uk', cast(id as varchar) from uk
        union all select 'la', cast(dr_no as varchar) from la"""),
    "archive_merge": (("chi",), f"""
        select id as "ID", {_ts("date_ts")} as "Date", {_ts("updated_ts")} as "Updated On" from chi
        where event_id % 2 = 1 or date_trunc('second', updated_ts) <= timestamp '{q.CUTOFF}'"""),
    "filter_cutoff": (("chi",), f"select id from chi where updated_ts <= timestamp '{q.CUTOFF}'"),
    "latest_updates": (("chi",), f"""
        select {_PAGE_COLUMNS} from (
          select * from chi order by updated_ts desc, event_id limit 5)"""),
    "audit_counts": (("chi",), f"""
        select 'scanned' as stage, count(*) as n from chi union all
        select 'until_cutoff', count(*) from chi where updated_ts <= timestamp '{q.CUTOFF}' union all
        select 'changed', count(*) from chi where updated_ts > timestamp '{q.MARK}'"""),
    "filter_nonzero_xy": (("inc",), """
        select count(*) filter (lon is distinct from 0 and lat is distinct from 0) as kept,
          count(*) filter (not (lon is distinct from 0 and lat is distinct from 0)) as dropped
        from (select lat, case when l_orderkey % 19 = 0 then null when l_orderkey % 17 = 0 then 0
          else lon end as lon from inc)"""),
    "clean_required": (("inc",), """
        select area, month(occurred_at) as month, count(*) as n from inc
        where l_orderkey % 23 <> 0 and l_orderkey % 19 <> 0 group by all"""),
    "strip_float_suffix": (("la",), """
        select regexp_replace(area || '.0', '\\.0$', '') as area, count(*) as n from la group by all"""),
    "parse_iso_ts": (("chi",), f"""
        select id, case when event_id % 9 <> 0 then {_ts("date_ts")} end as ts from chi"""),
    "parse_month": (("uk",), f"select id, {_ts('make_timestamp(y, mo, 1, 0, 0, 0)')} as ts from uk"),
    "parse_12h": (("la",), f"select dr_no, {_ts('occ_ts')} as ts from la"),
    "parse_h24_ampm": (("la",), f"select dr_no, {_ts('occ_ts')} as ts from la"),
    "ts_parts": (("la",), """
        select year(occ_ts) as year, month(occ_ts) as month, count(*) as n from la group by all"""),
    "calendar_features": (("inc",), f"""
        select {_CALENDAR.format(m="m")}
        from (select distinct date_trunc('month', occurred_at) as m from inc)"""),
    "encode_request": (("precincts", "uk"), f"""
        select w.neighbourhood, concat('/', w.force, '/', replace(w.neighbourhood, ' ', '%20'),
            '/boundary') as path,
          concat('poly=', replace(replace(poly, ',', '%2C'), ':', '%3A'), '&date=', month) as body
        from ({_WORK}) w join ({_POLY}) p
          on p.force = w.force and p.neighbourhood = w.neighbourhood"""),
    "spatial_point_cell": (("gridded",), "select grid_id, count(*) as n from gridded group by grid_id"),
    "spatial_point_polygon": (("inc", "boxes"), f"""
        select neighbourhood, month, count(*) as inside_n from (
          select distinct neighbourhood, strftime(occurred_at, '%Y-%m') as month, pos
          from boxes join (select row_number() over () as pos, * from inc) p on {_INSIDE})
        group by all"""),
    "grid_cells": (("grid",), f"select grid_id, ix, iy, {_CORNERS} from grid"),
    "grid_cells_on_boundary": (("grid",), "select ix, iy from grid"),
    "grid_ids": (("grid",), "select grid_id, ix, iy from grid"),
    "boundary_extent": (("ext",), """
        select round(x0, 9) as xmin, round(y0, 9) as ymin, round(x1, 9) as xmax,
          round(y1, 9) as ymax from ext"""),
    "boundary_poly_text": (("precincts",), _POLY),
    "hotspot_counts": (("counted",), """
        select grid_id, ix, iy, strftime(m, '%Y-%m') as month, n from counted"""),
    "hotspot_dense": (("dense",), """
        select grid_id, ix, iy, strftime(m, '%Y-%m') as month, n from dense"""),
    "hotspot_pivot": (("dense",), """
        select grid_id, ix, iy, string_agg(cast(n as varchar), ',' order by m) as counts
        from dense group by all"""),
    "hotspot_trailing_mean": (("scored",), """
        select grid_id, ix, iy, strftime(m, '%Y-%m') as month, round(mu, 6) as mu from scored"""),
    "hotspot_poisson": (("scored",), """
        select grid_id, ix, iy, strftime(m, '%Y-%m') as month, round(p, 6) as p from scored"""),
    "hotspot_flags": (("scored",), """
        select grid_id, ix, iy, strftime(m, '%Y-%m') as month, cast(flag as bigint) as flag
        from scored"""),
    "hotspot_hit_rate": (("rates",), """
        select grid_id, ix, iy, round(avg_tp, 6) as avg_tp from rates"""),
    "hotspot_prev_month": (("prev",), "select * from prev"),
    "hotspot_forecast_month": (("latest",), """
        select strftime(last_m + interval 1 month, '%Y-%m-%d') as forecast_month,
          strftime(last_m, '%Y-%m-%d') as previous_month from latest"""),
    "hotspot_rank": (("ranked",), """
        select grid_id, ix, iy, round(avg_tp, 6) as avg_tp, prev_n, rk from ranked"""),
    "hotspot_cells": (("ranked", "grid"), f"""
        select grid_id, {_CORNERS} from grid
        where grid_id in (select grid_id from ranked where rk <= {q.HOT_CELLS})"""),
    "hotspot_geojson": (("ranked", "grid"), f"""
        select grid_id, {_CORNERS} from grid
        where grid_id in (select grid_id from ranked where rk <= {q.HOT_CELLS})"""),
    "area_month_counts": (("areas",), "select area, year, month, crime_count from areas"),
    "rate_join_default": (("areas", "rate"), """
        select areas.area, areas.year, areas.month,
          round(coalesce(unemployment_rate, 5.0), 6) as unemployment_rate
        from areas left join rate on rate.area = areas.area and rate.year = areas.year
          and rate.month = areas.month"""),
    "area_month_features": (("areas", "rate"), f"""
        select areas.area, areas.year, areas.month, crime_count,
          round(coalesce(unemployment_rate, 5.0), 6) as unemployment_rate,
          {_CALENDAR.format(m="m")}
        from areas left join rate on rate.area = areas.area and rate.year = areas.year
          and rate.month = areas.month"""),
    "forecast_split": (("split",), "select area, strftime(m, '%Y-%m-%d') as ds, is_test from split"),
    "forecast_trend_season": (("fitted",), """
        select area, strftime(m, '%Y-%m-%d') as ds, crime_count as y, round(yhat, 6) as yhat
        from fitted"""),
    "forecast_mse": (("fitted",), """
        select area, round(avg((crime_count - yhat)^2), 6) as mse from fitted
        where is_test group by area"""),
    "forecast_fit": (("weights",), """
        select area, n_train, unnest(range(35)) as term, round(unnest(w), 6) as weight from weights"""),
    "forecast_ridge_predict": (("rate", "weights"), f"""
        select area, year, month, round(greatest((a + b*t) * (1 + list_dot_product(
            list_transform(x, lambda v, i: (v - c[i]) / s[i]), w)), 0), 4) as yhat
        from (select weights.*, asked.year, asked.month, asked.year*12 + asked.month - origin as t,
            {_INPUTS.format(m="make_date(asked.year, asked.month, 1)", rate="asked.rate")} as x
          from (select area, year + 2 as year, month, unemployment_rate as rate from rate) asked
          join weights on weights.area = asked.area)"""),
    "forecast_ridge_mse": (("designed", "weights"), """
        select d.area, round(avg((d.crime_count - greatest((w.a + w.b*d.t) * (1 + list_dot_product(
            list_transform(d.x, lambda v, i: (v - w.c[i]) / w.s[i]), w.w)), 0))^2), 4) as mse
        from designed d join weights w on w.area = d.area where d.is_test group by d.area"""),
    "forecast_predict": (("rate", "lines", "seasons"), f"""
        select asked.area, asked.year, asked.month,
          round(greatest((a + b*(asked.year*12 + asked.month - origin)) * coalesce(idx, 1), 0), 6)
            as yhat
        from (select area, year + 2 as year, month from rate) asked
        join lines on lines.area = asked.area
        left join seasons on seasons.area = asked.area and seasons.month = asked.month"""),
    "forecast_horizon": (("lines", "seasons"), f"""
        select area, strftime(d, '%Y-%m-%d') as ds,
          round(greatest((a + b*(year(d)*12 + month(d) - origin)) * coalesce(idx, 1), 0), 6) as yhat
        from (select lines.*, {_START} + to_months(cast(k as integer)) as d
          from lines, range({q.HORIZON[2]}) s(k)) h
        left join (select area as sa, month as sm, idx from seasons) on sa = area and sm = month(d)"""),
}


def _ordered(names: tuple[str, ...], seen: dict[str, str]) -> dict[str, str]:
    """The steps behind ``names``, each after those it reads."""
    for name in names:
        if name in seen:
            continue
        if name in FEEDS:
            seen[name] = feed_sql(name)
        else:
            needs, body = STEPS[name]
            _ordered(needs, seen)
            seen[name] = body
    return seen


def sql_of(name: str) -> str:
    needs, select = _SELECTS[name]
    steps = ",\n".join(f"{step} as ({body})" for step, body in _ordered(needs, {}).items())
    return f"with {steps}\n{select}"


ORACLE = {name: sql_of(name) for name in _SELECTS}
