"""The same models and reports in DuckDB SQL, as named common table expressions.

``sql(body)`` puts the expressions a statement needs in front of it. The SQL is
written on its own from the model definitions: it joins the dimensions where the
library computes keys in place, and tests points against whole polygon outlines
where the library uses a grid.
"""

from __future__ import annotations

import re

from workload import inputs as I

TOKEN = "'_dbt_utils_surrogate_key_null_'"


def key(*exprs: str) -> str:
    texts = ", ".join(f"coalesce(cast({e} as varchar), {TOKEN})" for e in exprs)
    return f"md5(concat_ws('-', {texts}))"


def yes_no(col: str) -> str:
    return f"case lower({col}) when 'y' then true when 'n' then false end"


def flag(col: str, clear: str, clear_is: str, other: str) -> str:
    return (
        f"case when {col} is null then null when lower({col}) = 'unknown' then null"
        f" when lower({col}) = '{clear}' then {clear_is} else {other} end"
    )


def last(table: str) -> str:
    return f"from {table} where partition_date = (select max(partition_date) from {table})"


def parts(geometry: str) -> str:
    return (
        f"case when json_extract_string({geometry}, '$.type') = 'Polygon'"
        f" then [try_cast(json_extract({geometry}, '$.coordinates') as double[][][])]"
        f" else try_cast(json_extract({geometry}, '$.coordinates') as double[][][][]) end"
    )


def number(e: str) -> str:
    return f"regexp_replace(cast({e} as varchar), '\\.0$', '')"


def wkt(geometry: str) -> str:
    position = f"{number('p[1]')} || ' ' || {number('p[2]')}"
    ring = f"'(' || array_to_string(list_transform(r, lambda p: {position}), ', ') || ')'"
    part = f"'(' || array_to_string(list_transform(g, lambda r: {ring}), ', ') || ')'"
    texts = f"list_transform({parts(geometry)}, lambda g: {part})"
    return (
        f"case when json_extract_string({geometry}, '$.type') = 'Polygon' then 'POLYGON' ||"
        f" ({texts})[1] else 'MULTIPOLYGON(' || array_to_string({texts}, ', ') || ')' end"
    )


def edges(table: str, key_column: str) -> str:
    return f"""
    select k, ring[i][1] as x1, ring[i][2] as y1,
           ring[i + 1][1] as x2, ring[i + 1][2] as y2
    from (select {key_column} as k, unnest(flatten({parts('geometry')})) as ring from {table}) r,
         lateral (select unnest(range(1, len(ring))) as i) n
    """


def within(edge_table: str) -> str:
    """(x, y, k): points strictly inside polygon k, by the even-odd rule"""
    return f"""
    select x, y, k from (
      select x, y, k,
        sum(case when (y1 > y) <> (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
                 then 1 else 0 end) % 2 as inside,
        max(case when (x2 - x1) * (y - y1) = (y2 - y1) * (x - x1)
                  and x between least(x1, x2) and greatest(x1, x2)
                  and y between least(y1, y2) and greatest(y1, y2) then 1 else 0 end) as on_edge
      from (select p.x, p.y, e.* from (select distinct longitude as x, latitude as y
            from dim_location where longitude is not null and latitude is not null) p
            cross join {edge_table} e) t
      group by x, y, k) t
    where inside = 1 and on_edge = 0
    """


CTES = {
    **{f"raw_{name}": I.raw_sql(name) for name in I.COLUMNS},
    "staging_crash": f"""
    select cast(crash_record_id as varchar) as crash_id,
      make_timestamp((crash_date // 1000000) * 1000) as crash_datetime,
      cast(posted_speed_limit as bigint) as crash_speed_limit, traffic_control_device,
      weather_condition as weather_condition_code, lighting_condition as lighting_condition_code,
      first_crash_type as first_crash_type_code, trafficway_type as trafficway_type_code,
      roadway_surface_cond as roadway_surface_condition_code, road_defect as road_defect_code,
      crash_type as crash_severity_code,
      {yes_no('intersection_related_i')} as is_intersection_related,
      {yes_no('hit_and_run_i')} as is_hit_and_run, damage as damage_level_code,
      prim_contributory_cause as primary_cause_explanation,
      cast(street_no as bigint) as street_number, street_direction as street_direction_code,
      street_name, {yes_no('dooring_i')} as is_dooring_related,
      {yes_no('work_zone_i')} as is_work_zone, {yes_no('workers_present_i')} as is_workers_present,
      cast(injuries_total as bigint) as total_injuries_number,
      cast(injuries_fatal as bigint) as total_fatal_injuries_number,
      latitude as location_latitude, longitude as location_longitude, partition_date
    {last('raw_crash')}""",
    "staging_people": f"""
    select nullif(person_id, '') as person_id, nullif(person_type, '') as person_type_code,
      nullif(crash_record_id, '') as crash_id, cast(vehicle_id as bigint) as vehicle_id,
      upper(nullif(sex, '')) as person_sex_code, cast(age as bigint) as person_age_number,
      nullif(driver_vision, '') as driver_vision,
      upper(nullif(drivers_license_state, '')) as drivers_license_state,
      nullif(physical_condition, '') as driver_physical_condition,
      nullif(bac_result, '') as bac_result, cast(bac_result_value as double) as bac_result_number,
      {yes_no('cell_phone_use')} as is_phone_use, partition_date
    {last('raw_people')}""",
    "staging_vehicle": f"""
    select cast(crash_unit_id as varchar) as crash_vehicle_id, crash_record_id as crash_id,
      nullif(unit_type, '') as unit_type, cast(num_passengers as bigint) as passengers_number,
      cast(vehicle_id as bigint) as vehicle_id, nullif(make, '') as vehicle_make,
      nullif(model, '') as vehicle_model, upper(nullif(lic_plate_state, '')) as license_plate_state,
      cast(vehicle_year as bigint) as vehicle_year_number,
      nullif(vehicle_defect, '') as vehicle_defect, nullif(vehicle_type, '') as vehicle_type,
      nullif(vehicle_use, '') as vehicle_use_code,
      upper(nullif(travel_direction, '')) as vehicle_travel_direction,
      nullif(maneuver, '') as vehicle_maneuver, {yes_no('exceed_speed_limit_i')} as is_speeding,
      partition_date
    {last('raw_vehicle')}""",
    "staging_ward": f"""
    select globalid as global_id, cast(ward as bigint) as ward, cast(ward_id as bigint) as ward_id,
      {wkt('geometry')} as ward_geometry, objectid as object_id,
      cast(edit_date as timestamp) as edit_date, cast(st_length_ as double) as st_length,
      cast(st_area_sh as double) as st_area, partition_date
    {last('raw_ward')}""",
    "staging_neighborhood": f"""
    select upper(pri_neigh) as primary_neighborhood, sec_neigh as secondary_neighborhood,
      {wkt('geometry')} as neighborhood_geometry, cast(shape_len as double) as shape_length,
      cast(shape_area as double) as shape_area, partition_date
    {last('raw_neighborhood')}""",
    "dim_datetime": f"""
    select {key('crash_datetime')} as date_hkey, crash_datetime,
      cast(extract(year from crash_datetime) as bigint) as year,
      cast(extract(month from crash_datetime) as bigint) as month,
      cast(extract(quarter from crash_datetime) as bigint) as quarter,
      cast(strftime(crash_datetime, '%U') as bigint) as week,
      cast(extract(day from crash_datetime) as bigint) as day,
      cast(extract(dayofweek from crash_datetime) + 1 as bigint) as day_of_week,
      cast(extract(hour from crash_datetime) as bigint) as hour,
      case when extract(dayofweek from crash_datetime) + 1 in (1, 7) then true else false end
        as is_weekend,
      case when extract(month from crash_datetime) in (12, 1, 2) then true else false end
        as is_winter,
      case when extract(hour from crash_datetime) in (7, 8, 9, 16, 17, 18) then true else false end
        as is_rush_hour
    from (select distinct crash_datetime from staging_crash) t""",
    "dim_location": f"""
    select {key('latitude', 'longitude')} as location_hkey,
      case when latitude is not null then longitude end as point_lon,
      case when longitude is not null then latitude end as point_lat, latitude, longitude
    from (select distinct location_latitude as latitude, location_longitude as longitude
          from staging_crash) t""",
    "refined_ward": f"""
    select {key('ward_id', 'ward_geometry', 'st_length', 'st_area')} as ward_hkey, ward_id,
      ward_geometry, st_length, st_area, partition_date from staging_ward""",
    "refined_neighborhood": f"""
    select {key('primary_neighborhood', 'neighborhood_geometry', 'shape_length', 'shape_area')}
        as neighborhood_hkey, primary_neighborhood as neighborhood, neighborhood_geometry,
      shape_length, shape_area, partition_date from staging_neighborhood""",
    "ward_edges": edges("raw_ward", "cast(ward_id as bigint)"),
    "area_edges": edges("raw_neighborhood", "upper(pri_neigh)"),
    "in_ward": within("ward_edges"),
    "in_area": within("area_edges"),
    "dim_location_enriched": """
    select l.location_hkey, l.point_lon, l.point_lat, l.longitude, l.latitude,
      w.ward_hkey, w.ward_id, n.neighborhood_hkey, n.neighborhood
    from dim_location l
    left join in_ward iw on iw.x = l.longitude and iw.y = l.latitude
    left join refined_ward w on w.ward_id = iw.k
    left join in_area ia on ia.x = l.longitude and ia.y = l.latitude
    left join refined_neighborhood n on n.neighborhood = ia.k""",
    "fact_crash": f"""
    select {key('crash_id', 'date_hkey', 'location_hkey')} as crash_hkey, c.crash_id,
      c.first_crash_type_code, c.crash_severity_code, c.total_injuries_number,
      c.total_fatal_injuries_number, c.weather_condition_code, c.lighting_condition_code,
      c.is_intersection_related, c.is_hit_and_run, c.is_work_zone, c.is_workers_present,
      c.is_dooring_related, c.crash_speed_limit, c.roadway_surface_condition_code,
      {flag('c.road_defect_code', 'no defects', 'false', 'true')} as is_road_defect,
      c.damage_level_code, c.primary_cause_explanation, d.date_hkey, l.location_hkey,
      c.partition_date
    from staging_crash c
    left join dim_datetime d on c.crash_datetime = d.crash_datetime
    left join dim_location l on c.location_longitude = l.longitude
      and c.location_latitude = l.latitude""",
    "fact_vehicle": f"""
    select {key('v.crash_vehicle_id', 'c.crash_hkey', 'v.vehicle_id')} as vehicle_hkey,
      v.crash_vehicle_id, c.crash_hkey, v.crash_id, v.vehicle_id, v.unit_type, v.passengers_number,
      case when lower(v.vehicle_make) = 'unknown' then null else v.vehicle_make end as vehicle_make,
      case when lower(v.vehicle_model) = 'unknown' then null else v.vehicle_model end
        as vehicle_model,
      v.license_plate_state, v.vehicle_year_number,
      {flag('v.vehicle_defect', 'none', 'true', 'false')} as is_vehicle_defect, v.vehicle_type,
      case when lower(v.vehicle_use_code) = 'unknown/na' then null else v.vehicle_use_code end
        as vehicle_use_code,
      case when lower(v.vehicle_maneuver) = 'unknown/na' then null else v.vehicle_maneuver end
        as vehicle_maneuver,
      v.is_speeding, v.partition_date
    from staging_vehicle v left join fact_crash c on v.crash_id = c.crash_id""",
    "fact_people": f"""
    select {key('p.person_id', 'c.crash_hkey', 'v.vehicle_hkey')} as person_hkey, p.person_id,
      p.person_type_code, p.crash_id, p.vehicle_id, p.person_sex_code, p.person_age_number,
      p.drivers_license_state, p.bac_result, p.bac_result_number, p.is_phone_use,
      p.partition_date, c.crash_hkey, v.vehicle_hkey,
      {flag('p.driver_vision', 'not obscured', 'false', 'true')} as is_vision_obscured,
      {flag('p.driver_physical_condition', 'normal', 'false', 'true')} as is_physically_impaired
    from staging_people p
    left join fact_crash c on p.crash_id = c.crash_id
    left join fact_vehicle v on p.vehicle_id = v.vehicle_id""",
}


_NEWEST = re.compile(r"from (raw_\w+) where partition_date = \(select max\(partition_date\) from raw_\w+\)")
# What a run builds from the incident feeds of its date, and what it merges into.
_BUILT = ["staging_crash", "staging_people", "staging_vehicle", "dim_datetime", "dim_location"]
_FACTS = ["fact_crash", "fact_vehicle", "fact_people"]


def accumulated(dates: list[str]) -> dict[str, str]:
    """The facts and dimensions after the job has run for the dates in turn, as expressions:
    ``<name>_<n>`` is what run n builds, ``<name>_all_<n>`` the table after it. Vehicles and
    people look up the crashes and vehicles of all runs so far. Places are accumulated before
    they are enriched. The date dimension is built anew: with a missing crash time in it, no
    version passes its check, so no run merges into one."""
    texts = [c for c, e in I.CRASH.items() if e.startswith("case") and "'" in e or e.startswith("concat")]
    empty = ", ".join(f"coalesce({c}, '') as {c}" for c in texts)
    out: dict[str, str] = {"landed_crash": f"select * replace ({empty}) from raw_crash"}
    keys = {"dim_location": "location_hkey", "fact_crash": "crash_hkey", "fact_vehicle": "vehicle_hkey", "fact_people": "person_hkey"}
    for n, date in enumerate(dates, 1):
        names = {b: f"{b}_{n}" for b in _BUILT}
        names |= {f: f"{f}_all_{n}" for f in _FACTS}
        for name in [*_BUILT, *_FACTS]:
            text = _NEWEST.sub(rf"from \1 where partition_date = date '{date}'", CTES[name])
            out[f"{name}_{n}"] = _renamed(text.replace("from raw_crash where", "from landed_crash where"), names)
            if name in keys:
                mine, key_column = f"{name}_{n}", keys[name]
                rows = f"select * from {mine}"
                if n > 1:
                    rows += (
                        f" union all select * from {name}_all_{n - 1} o where not exists"
                        f" (select 1 from {mine} m where m.{key_column} is not distinct from o.{key_column})"
                    )
                out[f"{name}_all_{n}"] = rows
    last_run = len(dates)
    places = {"dim_location": f"dim_location_all_{last_run}", "in_ward": "in_ward_all", "in_area": "in_area_all"}
    for name in ("in_ward", "in_area", "dim_location_enriched"):
        out[f"{name}_all"] = _renamed(CTES[name], places)
    return out


def _renamed(text: str, names: dict[str, str]) -> str:
    return re.sub(r"\b(" + "|".join(names) + r")\b", lambda m: names[m[1]], text)


def _needed(text: str) -> list[str]:
    """Names used by ``text``, directly or through each other, in defining order."""
    names: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in CTES:
            if name in words and name not in names:
                names.add(name)
                todo.append(CTES[name])
    return [name for name in CTES if name in names]


def sql(body: str, extra: dict[str, str] | None = None) -> str:
    """A statement with the common table expressions it needs; ``extra`` are its own."""
    own = extra or {}
    text = " ".join([body, *own.values()])
    ctes = [(name, CTES[name]) for name in _needed(text)] + list(own.items())
    if not ctes:
        return body
    return "with " + ", ".join(f"{name} as ({query})" for name, query in ctes) + " " + body
