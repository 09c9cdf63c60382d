"""Staging models: latest snapshot, renamed and typed.

Each model is one projection described by rows of (source, target, kind). Kinds:
string, int, double, date, timestamp, nanos, yes_no, geometry; text is a string
whose '' is NULL, upper and upper_text are the same in upper case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions import cleanse as C
from snapledger.functions.geometry import polygon_from_geojson
from snapledger.operators.snapshot import SNAPSHOT, latest_snapshot

CRASH = [
    ("crash_record_id", "crash_id", "string"),
    ("crash_date", "crash_datetime", "nanos"),
    ("posted_speed_limit", "crash_speed_limit", "int"),
    ("traffic_control_device", "traffic_control_device", "string"),
    ("weather_condition", "weather_condition_code", "string"),
    ("lighting_condition", "lighting_condition_code", "string"),
    ("first_crash_type", "first_crash_type_code", "string"),
    ("trafficway_type", "trafficway_type_code", "string"),
    ("roadway_surface_cond", "roadway_surface_condition_code", "string"),
    ("road_defect", "road_defect_code", "string"),
    ("crash_type", "crash_severity_code", "string"),
    ("intersection_related_i", "is_intersection_related", "yes_no"),
    ("hit_and_run_i", "is_hit_and_run", "yes_no"),
    ("damage", "damage_level_code", "string"),
    ("prim_contributory_cause", "primary_cause_explanation", "string"),
    ("street_no", "street_number", "int"),
    ("street_direction", "street_direction_code", "string"),
    ("street_name", "street_name", "string"),
    ("dooring_i", "is_dooring_related", "yes_no"),
    ("work_zone_i", "is_work_zone", "yes_no"),
    ("workers_present_i", "is_workers_present", "yes_no"),
    ("injuries_total", "total_injuries_number", "int"),
    ("injuries_fatal", "total_fatal_injuries_number", "int"),
    ("latitude", "location_latitude", "double"),
    ("longitude", "location_longitude", "double"),
    (SNAPSHOT, SNAPSHOT, "date"),
]

PEOPLE = [
    ("person_id", "person_id", "text"),
    ("person_type", "person_type_code", "text"),
    ("crash_record_id", "crash_id", "text"),
    ("vehicle_id", "vehicle_id", "int"),
    ("sex", "person_sex_code", "upper_text"),
    ("age", "person_age_number", "int"),
    ("driver_vision", "driver_vision", "text"),
    ("drivers_license_state", "drivers_license_state", "upper_text"),
    ("physical_condition", "driver_physical_condition", "text"),
    ("bac_result", "bac_result", "text"),
    ("bac_result_value", "bac_result_number", "double"),
    ("cell_phone_use", "is_phone_use", "yes_no"),
    (SNAPSHOT, SNAPSHOT, "date"),
]

VEHICLE = [
    ("crash_unit_id", "crash_vehicle_id", "string"),
    ("crash_record_id", "crash_id", "string"),
    ("unit_type", "unit_type", "text"),
    ("num_passengers", "passengers_number", "int"),
    ("vehicle_id", "vehicle_id", "int"),
    ("make", "vehicle_make", "text"),
    ("model", "vehicle_model", "text"),
    ("lic_plate_state", "license_plate_state", "upper_text"),
    ("vehicle_year", "vehicle_year_number", "int"),
    ("vehicle_defect", "vehicle_defect", "text"),
    ("vehicle_type", "vehicle_type", "text"),
    ("vehicle_use", "vehicle_use_code", "text"),
    ("travel_direction", "vehicle_travel_direction", "upper_text"),
    ("maneuver", "vehicle_maneuver", "text"),
    ("exceed_speed_limit_i", "is_speeding", "yes_no"),
    (SNAPSHOT, SNAPSHOT, "date"),
]

NEIGHBORHOOD = [
    ("pri_neigh", "primary_neighborhood", "upper"),
    ("sec_neigh", "secondary_neighborhood", "string"),
    ("geometry", "neighborhood_geometry", "geometry"),
    ("shape_len", "shape_length", "double"),
    ("shape_area", "shape_area", "double"),
    (SNAPSHOT, SNAPSHOT, "date"),
]

WARD = [
    ("globalid", "global_id", "string"),
    ("ward", "ward", "int"),
    ("ward_id", "ward_id", "int"),
    ("geometry", "ward_geometry", "geometry"),
    ("objectid", "object_id", "string"),
    ("edit_date", "edit_date", "timestamp"),
    ("st_length_", "st_length", "double"),
    ("st_area_sh", "st_area", "double"),
    (SNAPSHOT, SNAPSHOT, "date"),
]

MODELS = {
    "crash": CRASH,
    "people": PEOPLE,
    "vehicle": VEHICLE,
    "neighborhood": NEIGHBORHOOD,
    "ward": WARD,
}


def typed(df: DataFrame, source: str, kind: str) -> Column:
    """The column ``source`` of ``df`` converted as ``kind`` says."""
    col = F.col(source)
    if kind == "string":
        return col.cast("string")
    if kind == "text":
        return C.empty_to_null(col.cast("string"))
    if kind == "upper":
        return F.upper(col.cast("string"))
    if kind == "upper_text":
        return F.upper(C.empty_to_null(col.cast("string")))
    if kind == "int":
        return C.to_bigint(col, df.schema[source].dataType)
    if kind == "nanos":
        return C.nanos_to_timestamp(col)
    if kind == "yes_no":
        return C.yes_no_to_boolean(col)
    if kind == "geometry":
        return polygon_from_geojson(col, strict=True)
    if kind in ("double", "date", "timestamp"):
        return col.cast(kind)
    raise ValueError(f"unknown kind {kind}")


def rename_and_type(df: DataFrame, model: str) -> DataFrame:
    return df.select(*[typed(df, s, kind).alias(t) for s, t, kind in MODELS[model]])


def stage(raw: DataFrame, model: str) -> DataFrame:
    """Latest snapshot of a raw table as its staging model."""
    return rename_and_type(latest_snapshot(raw), model)
