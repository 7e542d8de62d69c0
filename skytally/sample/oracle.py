"""The sample queries as plain SQL over the same Parquet tables (DuckDB dialect)."""

from __future__ import annotations

from skytally.functions.country import CONTINENTS, COUNTRIES, OVERRIDES
from skytally.sample.views import ACTIVE, AS_OF, EARLIER, TRANSITION

_AIRPORT = """airport as (
  select c_name icao, cast(c_custkey % 3000 as int) altitude, n_name country,
    case when c_custkey % 50 = 49 then ''
         else concat('A', cast(c_custkey - case when c_custkey % 10 = 9 then 1 else 0 end as varchar)) end iata,
    case when c_custkey % 41 = 0 then null else cast((c_custkey*37) % 170 - 85 as float) end latitude,
    case when c_custkey % 41 = 0 then null else cast((c_custkey*73) % 358 - 179 as float) end longitude,
    concat('Airport ', c_name) as name, r_name continent
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""

_AIRLINE = """airline as (
  select concat('S', cast(s_suppkey as varchar)) icao, concat('C', cast(s_suppkey % 10 as varchar)) code,
    s_name as name, n_name country
  from supplier join nation on s_nationkey = n_nationkey)"""

_FLIGHT = """flight as (
  select cast(o_orderkey as varchar) id, p_name aircraft_model,
    case when o_orderkey % 11 = 0 then '' when o_orderkey % 13 = 0 then null
         else concat('C', cast(o_orderkey % 12 as varchar)) end airline_iata,
    case when carrier is not null then concat('S', cast(carrier as varchar)) end airline_icao,
    concat('A', cast(o_custkey as varchar)) origin_airport_iata,
    case when last_part is not null then concat('A', cast(last_part as varchar)) end destination_airport_iata,
    case when o_orderstatus = 'F' then 1 else 0 end on_ground,
    cast(o_orderkey % 40000 as int) altitude,
    cast(epoch(o_orderdate) as int) as "time", o_custkey, o_orderkey, o_totalprice
  from orders left join (
    select l_orderkey, min(l_partkey) model_part, max(l_partkey) last_part, max(l_suppkey) carrier
    from lineitem group by 1) on l_orderkey = o_orderkey
  left join part on p_partkey = model_part)"""

# Two clocks, and every transition of each.
_LEGS = f"""clock(batch) as (select unnest([{EARLIER}, {AS_OF}])),
leg as (
  select batch, f.id flight_id, f.airline_iata, f.airline_icao,
    oa.name origin_airport_name, oa.latitude origin_airport_latitude, oa.longitude origin_airport_longitude,
    oa.continent origin_zone_name,
    da.name destination_airport_name, da.latitude destination_airport_latitude,
    da.longitude destination_airport_longitude, da.continent destination_zone_name
  from clock join flight f on f."time" > batch - {TRANSITION} and f."time" <= batch
  join airport oa on f.origin_airport_iata = oa.iata
  join airport da on f.destination_airport_iata = da.iata)"""

_SPHERE = """2*6371.0088*asin(sqrt(case when a > 1 then 1.0 else a end))"""


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"pow(sin(radians({lat2}-{lat1})/2),2) + cos(radians({lat1}))*cos(radians({lat2}))"
        f"*pow(sin(radians({lon2}-{lon1})/2),2)"
    )


def _spheroid(source: str) -> str:
    """CTEs up to ``km(lat1, lon1, lat2, lon2, km)``: 200 steps of Vincenty's inverse for each pair of
    ``source``, read from its columns of these names."""
    f = "(1/298.257223563)"
    a = "6378137.0"
    b = f"({a}*(1-{f}))"
    step = f"""
      select lat1, lon1, lat2, lon2, u1, u2, dl, n + 1 n, ss, cs, sg, sa, ca, m,
        dl + (1-c)*{f}*sa*(sg + c*ss*(m + c*cs*(2*m*m-1))) lam
      from (select *, {f}/16*ca*(4+{f}*(4-3*ca)) c from (
        select *, case when ca < 1e-15 then 0.0 else cs - 2*sin(u1)*sin(u2)/ca end m from (
          select *, 1 - sa*sa ca from (
            select *, atan2(ss, cs) sg, case when ss = 0 then 0.0 else cos(u1)*cos(u2)*sin(lam)/ss end sa from (
              select lat1, lon1, lat2, lon2, u1, u2, dl, n, lam,
                sqrt(pow(cos(u2)*sin(lam), 2) + pow(cos(u1)*sin(u2) - sin(u1)*cos(u2)*cos(lam), 2)) ss,
                sin(u1)*sin(u2) + cos(u1)*cos(u2)*cos(lam) cs
              from vincenty where n < 200)))))"""
    return f"""pair as (
      select distinct lat1, lon1, lat2, lon2 from {source}
      where lat1 is not null and lon1 is not null and lat2 is not null and lon2 is not null),
    start as (
      select *, atan((1-{f})*tan(radians(lat1))) u1, atan((1-{f})*tan(radians(lat2))) u2,
        radians(least(abs(lon2-lon1) % 360, 360 - abs(lon2-lon1) % 360)) dl from pair),
    vincenty(lat1, lon1, lat2, lon2, u1, u2, dl, n, ss, cs, sg, sa, ca, m, lam) as (
      select lat1, lon1, lat2, lon2, u1, u2, dl, 0, 0.0::double, 0.0::double, 0.0::double, 0.0::double,
        0.0::double, 0.0::double, dl from start
      union all {step}),
    km as (
      select lat1, lon1, lat2, lon2,
        {b}/1000*ba*(sg - bb*ss*(m + bb/4*(cs*(2*m*m-1) - bb/6*m*(4*ss*ss-3)*(4*m*m-3)))) km
      from (select *, 1 + w/16384*(4096+w*(-768+w*(320-175*w))) ba, w/1024*(256+w*(-128+w*(74-47*w))) bb
            from (select *, ca*(({a}*{a}-{b}*{b})/({b}*{b})) w from vincenty where n = 200)))"""


_PLACED = """placed as (
  select *, cast(origin_airport_latitude as double) lat1, cast(origin_airport_longitude as double) lon1,
    cast(destination_airport_latitude as double) lat2, cast(destination_airport_longitude as double) lon2 from leg)"""

_TRANSITION = f"""{_LEGS}, {_PLACED}, {_spheroid("placed")},
azt as (
  select p.*, cast(km as float) distance_km from placed p
  left join km using (lat1, lon1, lat2, lon2))"""

_ENDS = ", ".join(
    f"{e}_{c}"
    for e in ("origin", "destination")
    for c in ("airport_name", "airport_latitude", "airport_longitude", "zone_name")
)
_ROUNDED = "round(cast(distance_km as double), 1) distance_km"
_BASE = f"with recursive {_FLIGHT}, {_AIRPORT}, {_AIRLINE}"

_MODELS = """select a.name airline_name, a.country, f.aircraft_model model_name, cast(count(*) as int) aircraft_count
  from airline a join flight f on f.airline_icao = a.icao group by all"""

_LOCAL = f"""select azt.airline_iata airline_code, al.name airline_name, azt.origin_zone_name continent,
    cast(count(distinct f.id) as int) flight_count
  from azt left join airline al on al.code = azt.airline_iata left join flight f on f.id = azt.flight_id
  where f."time" > {AS_OF} - {ACTIVE} and azt.origin_zone_name = azt.destination_zone_name group by all"""


def _ranked(ties: str, order: str) -> str:
    return f"""{_BASE} select * from (
      select country, model_name, cast(sum(aircraft_count) as int) flight_count,
        cast({ties}() over (partition by country order by sum(aircraft_count) desc{order}) as int) rank
      from ({_MODELS}) group by country, model_name) where rank <= 3"""


def _longest(nulls: str) -> str:
    return f"""{_BASE}, {_TRANSITION}
      select flight_id, airline_iata, {_ENDS}, {_ROUNDED} from azt
      where batch = (select max(batch) from azt)
      order by azt.distance_km desc nulls {nulls}, flight_id, airline_iata, {_ENDS} limit 1"""


_REFERENCE = """reference as (
  select concat('S', cast(s_suppkey as varchar)) icao, s_acctbal <= 9000 has_country,
    case when s_acctbal > 8000 then '' when s_acctbal <= 7000 then n_name end country
  from supplier join nation on s_nationkey = n_nationkey where s_acctbal >= 0)"""

_COUNTRY = "case when r.icao is null or not r.has_country then 'Unknown' else r.country end country"

_OVERRIDE = "override(country, continent) as (values " + ", ".join(
    f"('{country}', '{continent}')" for country, continent in OVERRIDES.items()
) + ")"

_STANDARD = """standard as (
  select n_name country, ['Africa', 'North America', 'Asia', 'Europe', 'Oceania'][n_regionkey + 1] continent
  from nation)"""

_CELLS = """page as (
  select s_suppkey page_id, [
    [s_name, ''],
    [],
    ['', concat('IATA:', cast(s_suppkey as varchar)), 'Callsign:'],
    [concat('ICAO:', case when s_acctbal < 0 then '' else concat('Z', cast(s_suppkey % 60 as varchar)) end),
     'a', 'b', 'c', case when s_acctbal > 9000 then 'no colon' else concat('Country:', n_name, ':x') end]] as "rows"
  from supplier join nation on s_nationkey = n_nationkey),
cell as (select page_id, list_filter(flatten("rows"), lambda c: length(c) > 0) cells from page),
field as (
  select page_id, cells[1] as name,
    case when contains(cells[4], ':') then split_part(cells[4], ':', 2) end icao,
    case when contains(cells[8], ':') then split_part(cells[8], ':', 2) end country from cell)"""

_BATCH = "case event_type when 'click' then 2 when 'error' then 1 else 0 end"


def _runs() -> str:
    """What each job stores for both clocks; the later run sees the transitions of both."""
    parts = []
    for as_of in (EARLIER, AS_OF):
        active = f'f."time" > {as_of} - {ACTIVE} and f."time" <= {as_of}'
        ends = "flight_id a, origin_airport_name b, destination_airport_name c, round(cast(distance_km as double), 1) n"
        parts += [
            f"""select 'most_flights_in_progress' table_name, {as_of} batch_id, f.airline_iata a, al.name b, null c, count(*) n
              from flight f left join airline al on al.code = f.airline_iata
              where {active} and on_ground = 0 and airline_iata != '' group by all""",
            f"select 'airport_and_zone_transition', {as_of}, {ends} from azt where batch = {as_of}",
            f"""select 'aircraft_model_per_airline_country', {as_of}, airline_name, country, model_name, aircraft_count
              from ({_MODELS}) where model_name is not null""",
            f"""select 'airline_with_most_active_flights_per_continent', {as_of}, azt.airline_iata, al.name, origin_zone_name,
                count(distinct f.id)
              from azt left join airline al on al.code = azt.airline_iata join flight f on f.id = azt.flight_id
              where {active} and batch <= {as_of} and origin_zone_name = destination_zone_name group by all""",
            f"""select 'average_flight_distance_per_continent', {as_of}, origin_zone_name, null, null,
                round_even(avg(cast(distance_km as double)), 0)
              from (select azt.* from azt join flight f on f.id = azt.flight_id where {active} and batch <= {as_of}
                qualify row_number() over (partition by flight_id order by batch desc,
                  origin_zone_name desc nulls last, distance_km desc nulls last) = 1) group by all""",
            f"""select * from (select 'current_longest_flight', {as_of}, {ends} from azt where batch = {as_of}
              order by azt.distance_km desc nulls first, flight_id, airline_iata, {_ENDS} limit 1)""",
            f"""select 'most_active_flights_per_builder', {as_of}, split_part(aircraft_model, ' ', 1), null, null, count(*)
              from flight group by all""",
        ]
    return " union all ".join(parts)


ORACLE: dict[str, str] = {
    "most_flights_in_progress": f"""{_BASE}
      select fl.airline_iata airline_code, al.name airline_name, cast(count(distinct fl.id) as int) flight_count
      from flight fl left join airline al on al.code = fl.airline_iata
      where "time" > {AS_OF} - {ACTIVE} and on_ground = 0 and airline_iata != '' group by all""",
    "airport_and_zone_transition": f"""{_BASE}, {_TRANSITION}
      select flight_id, airline_iata, airline_icao, {_ENDS}, {_ROUNDED} from azt where batch = {AS_OF}""",
    "airport_and_zone_transition_sphere": f"""{_BASE}, {_LEGS}, {_PLACED},
      haversine as (select *, {_haversine("lat1", "lon1", "lat2", "lon2")} a from placed)
      select flight_id, airline_iata, airline_icao, {_ENDS},
        round(cast(cast({_SPHERE} as float) as double), 1) distance_km from haversine where batch = {AS_OF}""",
    "aircraft_model_per_airline_country": f"{_BASE} {_MODELS}",
    "airline_with_most_active_flights_per_continent": f"{_BASE}, {_LEGS}, azt as (select * from leg) {_LOCAL}",
    "average_flight_distance_per_continent": f"""{_BASE}, {_TRANSITION},
      one as (
        select azt.* from azt left join flight f on f.id = azt.flight_id where f."time" > {AS_OF} - {ACTIVE}
        qualify row_number() over (partition by flight_id
          order by batch desc, origin_zone_name desc nulls last, distance_km desc nulls last) = 1)
      select origin_zone_name continent, cast(round_even(avg(cast(distance_km as double)), 0) as int) average_flight_distance
      from one group by all""",
    "current_longest_flight": _longest("first"),
    "current_longest_flight_known": _longest("last"),
    "most_active_flights_per_builder": f"""{_BASE}
      select split_part(aircraft_model, ' ', 1) builder, cast(count(id) as int) flight_count from flight group by 1""",
    "top_models_per_country": _ranked("row_number", ", model_name"),
    "top_models_per_country_rank": _ranked("rank", ""),
    "top_models_per_country_dense_rank": _ranked("dense_rank", ""),
    "top_airline_per_continent": f"""{_BASE}, {_LEGS}, azt as (select * from leg)
      select *, cast(1 as int) rank from ({_LOCAL})
      qualify row_number() over (partition by continent
        order by flight_count desc, airline_code nulls last, airline_name nulls last) = 1""",
    "load_airlines": f"""with {_AIRLINE}, {_REFERENCE}
      select a.icao, a.code, a.name, {_COUNTRY} from airline a left join reference r on a.icao = r.icao""",
    "load_airports": f"""with {_AIRPORT}, {_OVERRIDE}, {_STANDARD},
      feed as (
        select a.* replace (case when c_mktsegment = 'BUILDING' then 'Hong Kong' else country end as country)
        from airport a join customer on icao = c_name)
      select icao, altitude, feed.country, iata, latitude, longitude, name,
        coalesce(override.continent, standard.continent) continent
      from feed left join override on feed.country = override.country
      left join standard on feed.country = standard.country""",
    "clean_airline_countries": f"""with {_CELLS}
      select icao, name, country from field where icao is not null and icao <> '' and country is not null
      qualify row_number() over (partition by icao order by page_id desc) = 1""",
    "clean_airline_countries_rejects": f"""with {_CELLS}
      select page_id from field where icao is null or (icao <> '' and country is null)""",
    "extract_page_tables": """with page as (
        select page_id, url, trim(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&amp;', '&')) title
        from pages where contains(url, '?')),
      cell(page_id, row_no, cell_no, cell) as (
        select page_id, 0, null, null from page
        union all select page_id, 1, 0, title from page
        union all select page_id, 1, 1, concat('url: ', url) from page
        union all select page_id, 2, 0, '' from page)
      select page_id, cast(row_no as int) row_no, cast(cell_no as int) cell_no, cell from cell""",
    "extract_page_tables_raw": """select page_id, cast((length(html) - length(replace(lower(html), '<table', ''))) // 6 as int) row_count
      from pages""",
    "ingest_flights": f"""with {_FLIGHT}
      select cast(o_custkey as varchar) id, airline_iata, airline_icao, altitude, on_ground, "time", aircraft_model
      from flight where o_totalprice <= 400000
      qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1""",
    "publish_flights": f"""with {_FLIGHT}
      select cast(to_json({{
        'id': id, 'aircraft_code': null, 'airline_iata': airline_iata, 'airline_icao': airline_icao,
        'altitude': altitude, 'callsign': null, 'destination_airport_iata': destination_airport_iata,
        'ground_speed': null, 'heading': null, 'icao_24bit': null, 'latitude': null, 'longitude': null,
        'number': null, 'on_ground': on_ground, 'origin_airport_iata': origin_airport_iata, 'registration': null,
        'squawk': null, 'time': "time", 'vertical_speed': null, 'aircraft_model': aircraft_model}}) as varchar) as "value"
      from flight""",
    "snapshot_run": f"""{_BASE}, {_TRANSITION}
      select table_name, cast(batch_id as bigint) batch_id, a, b, c, cast(n as double) n from ({_runs()})""",
    "recent_filter": f"""with {_FLIGHT} select id, "time" from flight where "time" > {AS_OF} - {ACTIVE}""",
    "recent_filter_short": f"""with {_FLIGHT} select id, "time" from flight
      where "time" > {AS_OF} - {TRANSITION} and "time" <= {AS_OF}""",
    "in_the_air_non_empty": f"""with {_FLIGHT} select id, airline_iata from flight
      where on_ground = 0 and airline_iata <> ''""",
    "same_zone_filter": f"""{_BASE}, {_LEGS}
      select flight_id, origin_zone_name, origin_airport_name, destination_airport_name from leg
      where batch = {AS_OF} and origin_zone_name = destination_zone_name""",
    "inner_join_fan_out": f"""with {_FLIGHT}, {_AIRPORT}
      select f.id, f.origin_airport_iata, a.name airport_name
      from flight f join airport a on f.origin_airport_iata = a.iata""",
    "left_join_fan_out": f"""with {_FLIGHT}, {_AIRLINE}
      select f.airline_iata, f.n flight_count, a.name airline_name
      from (select airline_iata, count(*) n from flight group by 1) f left join airline a on a.code = f.airline_iata""",
    "semi_join_active": f"""{_BASE}, {_LEGS}
      select distinct flight_id, origin_zone_name from leg where batch = {EARLIER} and flight_id in (
        select id from flight where "time" > {AS_OF} - {ACTIVE})""",
    "lookup_default": f"""with {_AIRLINE}, {_REFERENCE}
      select a.icao, {_COUNTRY} from airline a left join reference r on a.icao = r.icao""",
    "lookup_two_levels": f"""with {_OVERRIDE}, {_STANDARD},
      named as (
        select c_custkey, case c_mktsegment when 'MACHINERY' then 'Greenland' when 'HOUSEHOLD' then 'Nowhere'
          else n_name end country from customer join nation on c_nationkey = n_nationkey)
      select c_custkey, named.country, coalesce(override.continent, standard.continent) continent
      from named left join override on named.country = override.country
      left join standard on named.country = standard.country""",
    "distinct_on": """select user_id, event_id, event_type from events
      qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "top_k_per_group": """select o_custkey, o_orderkey, o_totalprice,
        cast(row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as int) rank
      from orders qualify rank <= 3""",
    "topk_nulls_first": f"""with {_AIRPORT} select icao, latitude from airport
      order by latitude desc nulls first, icao limit 5""",
    "topk_nulls_last": f"""with {_AIRPORT} select icao, latitude from airport
      order by latitude desc nulls last, icao limit 5""",
    "three_key_sort": f"""with {_AIRPORT} select country, iata, name from airport
      order by country nulls last, iata nulls last, name nulls last""",
    "upsert_latest": f"""select user_id, event_id, event_type, value from events
      qualify row_number() over (partition by user_id order by {_BATCH} desc, ts desc) = 1""",
    "upsert_event_time": """select user_id, event_id, event_type, value, cast(floor(epoch(ts)) as int) seen from events
      qualify row_number() over (partition by user_id order by floor(epoch(ts)) desc, event_id desc) = 1""",
    "snapshot_append": f"""select event_type, cast(count(*) as int) event_count, stamp, batch_id
      from events, (values (cast({EARLIER} as bigint), cast(1 as bigint)), ({AS_OF}, 2)) b(stamp, batch_id)
      group by event_type, stamp, batch_id""",
    "last_wins_per_key": """select s_suppkey page_id, s_suppkey % 60 code, s_name from supplier
      qualify row_number() over (partition by s_suppkey % 60 order by s_suppkey desc) = 1""",
    "distinct_count": f"""with {_FLIGHT} select airline_icao,
        cast(count(distinct origin_airport_iata) as int) origins, cast(count(airline_iata) as int) with_code
      from flight group by 1""",
    "mean_half_even": f"""with {_FLIGHT} select airline_iata,
        cast(round_even(avg(altitude), 0) as int) mean_altitude from flight group by 1""",
    "conform_types": """select cast(p_partkey as int) p_partkey, cast(round_even(p_size / 2, 0) as int) half,
        p_size "size", p_name from part""",
    "null_policy": f"with {_AIRPORT} select icao, name from airport where latitude is null or longitude is null",
    "json_projection": """select event_id, cast(json_extract(props, '$.k') as int) k, cast(null as varchar) _reason
      from events""",
    "json_messages": f"""with {_AIRLINE}
      select cast(to_json({{'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey}}) as varchar) "value"
      from nation
      union all
      select cast(to_json({{'icao': icao, 'code': code, 'name': name, 'country': country}}) as varchar) from airline""",
    "lower_case_public_columns": f"with {_AIRLINE} select icao, code, name from airline",
    "split_part_first_word": "select p_partkey, split_part(p_name, ' ', 1) builder from part",
    "colon_field": """select page_id, case when contains(url, ':') then split_part(url, ':', 2) end after_colon,
        case when contains(url, '?') then split_part(url, '?', 2) end after_question from pages""",
    "strip_whitespace": "select c_custkey, c_name as name from customer",
    "flatten_cells": f"""with {_CELLS}
      select page_id, cast(len(cells) as int) cell_count, cells[4] fourth from cell""",
    "window_threshold": "select event_id, cast(round(epoch(ts) - 600) as bigint) threshold from events",
    "geodesic_sphere": f"""with {_AIRPORT}, place as (
        select icao, cast(latitude as double) lat1, cast(longitude as double) lon1,
          cast(altitude % 90 as double) lat2, cast(altitude % 150 as double) - 75 lon2 from airport),
      haversine as (select icao, {_haversine("lat1", "lon1", "lat2", "lon2")} a from place)
      select icao, round({_SPHERE}, 3) km from haversine""",
    "geodesic_spheroid": f"""with recursive {_AIRPORT}, place as (
        select icao, cast(latitude as double) lat1, cast(longitude as double) lon1,
          cast(altitude % 90 as double) lat2, cast(altitude % 150 as double) - 75 lon2 from airport),
      {_spheroid("place")}
      select icao, round(km, 3) km from place left join km using (lat1, lon1, lat2, lon2)""",
}

_LAST_ORDER = "qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1"

_KNOWN = [(n, CONTINENTS[code]) for code, names in COUNTRIES.items() for n in names.split(", ")] + list(OVERRIDES.items())


def _texts(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


ORACLE |= {
    "load_airports_built_in": f"""with {_AIRPORT},
      numbered as (select *, cast(regexp_extract(icao, '([0-9]+)$', 1) as int) % {len(_KNOWN)} + 1 place from airport)
      select icao, altitude, {_texts(n for n, _ in _KNOWN)}[place] country, iata, latitude, longitude, name,
        {_texts(c for _, c in _KNOWN)}[place] continent from numbered""",
    "upsert_after_interrupted_compaction": ORACLE["upsert_latest"],
    "upsert_two_writers": ORACLE["upsert_latest"],
    "upsert_new_checkpoint": ORACLE["ingest_flights"],
    # A costly last order is refused, and the customer's first one stays, unless it was costly too.
    "ingest_resumed": f"""with {_FLIGHT},
      ends as (
        select *, row_number() over (partition by o_custkey order by o_orderkey) as up,
          row_number() over (partition by o_custkey order by o_orderkey desc) down from flight)
      select cast(o_custkey as varchar) id, airline_iata, altitude, on_ground, "time", aircraft_model
      from ends where (up = 1 or down = 1) and o_totalprice <= 400000 {_LAST_ORDER}""",
    "upsert_late_batch": """select user_id, event_id, event_type, value from events
      qualify row_number() over (partition by user_id
        order by case event_type when 'click' then 2 when 'error' then 0 else 1 end desc, ts desc) = 1""",
    "upsert_pruned_compaction": ORACLE["upsert_latest"],
    "distinct_count_sketched": f"""with {_FLIGHT}
      select airline_icao, count(distinct origin_airport_iata) origins, true as within from flight group by 1""",
    "maintained_counts": f"select event_type, count(*) users from ({ORACLE['upsert_latest']}) group by 1",
    "active_per_window": f"""with {_FLIGHT}, {_AIRLINE},
      seen as (select *, (("time" - 1) // {ACTIVE} + 1) * {ACTIVE} as_of from flight),
      last as (select * from seen qualify row_number() over (
        partition by as_of, origin_airport_iata order by "time" desc, o_orderkey desc) = 1),
      counted as (select as_of, airline_iata, count(*) n from last where on_ground = 0 and airline_iata != '' group by all)
      select cast(as_of as bigint) as_of, airline_iata airline_code, a.name airline_name, cast(n as int) flight_count
      from counted left join (select distinct code, name from airline) a on a.code = airline_iata""",
    "flights_with_details": f"""with {_FLIGHT}
      select id, "time", case when o_orderkey % 4 > 0 and o_orderkey % 7 <= 4 then aircraft_model end aircraft_model from flight""",
    "lookup_current_rows": f"""select * from ({ORACLE["upsert_latest"]})
      where user_id in (select user_id from events where event_type = 'error')""",
    "ingest_topic": ORACLE["ingest_flights"],
    "airport_and_zone_transition_hot": f"""with recursive {_FLIGHT.replace("flight as", "flown as", 1)},
      flight as (select * replace (
        case when o_orderkey % 100 = 0 then '' else origin_airport_iata end as origin_airport_iata,
        case when o_orderkey % 100 = 0 then '' else destination_airport_iata end as destination_airport_iata) from flown),
      {_AIRPORT}, {_AIRLINE}, {_TRANSITION}
      select flight_id, airline_iata, airline_icao, {_ENDS}, {_ROUNDED} from azt where batch = {AS_OF}""",
    "average_flight_distance_joined": ORACLE["average_flight_distance_per_continent"],
    "snapshot_ids": """select row_number() over (order by o_custkey desc, o_orderkey) id, o_orderkey from orders""",
    "publish_landed": ORACLE["publish_flights"],
    "jobs_after_each_batch": f"""with {_FLIGHT}, {_AIRLINE},
      state as (select * from flight where o_totalprice <= 400000 {_LAST_ORDER})
      select fl.airline_iata airline_code, al.name airline_name, cast(count(*) as int) flight_count
      from state fl left join airline al on al.code = fl.airline_iata
      where "time" > {AS_OF} - {ACTIVE} and on_ground = 0 and airline_iata != '' group by all""",
    "topic_offset_order": """select event_id, max(cast(floor(epoch(ts)) as bigint) - (event_id * 37 % 1000) * 60)
        over (partition by user_id % 4 order by event_id) arrived from events""",
    "landed_airline_feed": ORACLE["load_airlines"],
    "landed_airport_feed": f"""with {_AIRPORT}, {_STANDARD}
      select icao, altitude, airport.country, iata, latitude, longitude, name, standard.continent
      from airport left join standard on airport.country = standard.country""",
    "reference_objects": """select cast(s_suppkey as varchar) icao, s_name as name, n_name country
      from supplier join nation on s_nationkey = n_nationkey""",
    "reference_large_object": """select cast(s_suppkey as varchar) icao, s_name || ', "{[\\' as name, n_name country
      from supplier join nation on s_nationkey = n_nationkey""",
    "upsert_airports": ORACLE["load_airports"],
    "catalog_views": f"""with {_FLIGHT}, {_AIRLINE}, {_AIRPORT}
      select a.name airline, count(*) flights, count(distinct p.icao) airports from flight f
      join airline a on f.airline_icao = a.icao left join airport p on p.iata = f.origin_airport_iata group by a.name
      union all select 'builder ' || builder, n, 1 from (
        select split_part(aircraft_model, ' ', 1) builder, count(*) n from flight group by 1)""",
    "json_refused": """select event_id, case when event_id % 6 in (2, 5) then event_id end id,
        cast(case when event_id % 6 = 3 then 1 end as int) k,
        case event_id % 6 when 0 then 'not a JSON object' when 1 then 'absent: id, k' when 2 then 'wrong type: k'
          when 3 then 'NULL key: id' when 4 then 'not a JSON object' end _reason from events""",
}
