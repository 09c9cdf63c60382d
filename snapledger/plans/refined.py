"""Refined models: dimensions, boundaries and facts, built from staging frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.functions import calendar as D
from snapledger.functions import cleanse as C
from snapledger.functions.geometry import make_point, polygon_wkt
from snapledger.functions.keys import location_key, packed_key, surrogate_key, unpacked_key
from snapledger.operators.joins import left_join, split_left_join
from snapledger.operators.spatial import spatial_left_join

# The category that means "nothing wrong", per flag.
NO_ROAD_DEFECT = "no defects"
CLEAR_VISION = "not obscured"
NORMAL_CONDITION = "normal"
NO_VEHICLE_DEFECT = "none"

# Grid size of the boundary join in degrees, about one kilometre.
CELL = 0.01


def dim_datetime(crash: DataFrame) -> DataFrame:
    """One row per crash time, the missing time included."""
    t = F.col("crash_datetime")
    return (
        crash.select("crash_datetime")
        .distinct()
        # Sorted before the key is there, which would travel with the time.
        .orderBy("crash_datetime")
        .select(
            surrogate_key("crash_datetime").alias("date_hkey"),
            "crash_datetime",
            *[part.alias(name) for name, part in D.date_parts(t).items()],
            *[flag.alias(name) for name, flag in D.calendar_flags(t).items()],
        )
    )


def dim_location(crash: DataFrame) -> DataFrame:
    """One row per coordinate pair, missing coordinates included."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return (
        crash.select(
            F.col("location_latitude").alias("latitude"),
            F.col("location_longitude").alias("longitude"),
        )
        .distinct()
        .select(
            location_key(lat, lon).alias("location_hkey"),
            make_point(lon, lat).alias("location_point"),
            "latitude",
            "longitude",
        )
    )


def ward(staged: DataFrame) -> DataFrame:
    key = surrogate_key("ward_id", polygon_wkt(F.col("ward_geometry")), "st_length", "st_area")
    return staged.select(
        key.alias("ward_hkey"), "ward_id", "ward_geometry", "st_length", "st_area", "partition_date"
    )


def neighborhood(staged: DataFrame) -> DataFrame:
    key = surrogate_key(
        "primary_neighborhood",
        polygon_wkt(F.col("neighborhood_geometry")),
        "shape_length",
        "shape_area",
    )
    return staged.select(
        key.alias("neighborhood_hkey"),
        F.col("primary_neighborhood").alias("neighborhood"),
        "neighborhood_geometry",
        "shape_length",
        "shape_area",
        "partition_date",
    )


def dim_location_enriched(
    locations: DataFrame, wards: DataFrame, neighborhoods: DataFrame, cell: float = CELL
) -> DataFrame:
    """Locations with the ward and the neighborhood around them. A location without
    one stays, a location in several overlapping ones is repeated."""
    # Digests in half the bytes, before rows travel.
    locations, wards, neighborhoods = (
        df.withColumn(key, packed_key(F.col(key)))
        for df, key in ((locations, "location_hkey"), (wards, "ward_hkey"), (neighborhoods, "neighborhood_hkey"))
    )
    with_ward = spatial_left_join(
        locations,
        "location_point",
        wards,
        "ward_geometry",
        {"ward_hkey": "ward_hkey", "ward_id": "ward_id"},
        cell,
    )
    with_both = spatial_left_join(
        with_ward,
        "location_point",
        neighborhoods,
        "neighborhood_geometry",
        {"neighborhood_hkey": "neighborhood_hkey", "neighborhood": "neighborhood"},
        cell,
    )
    return with_both.select(
        unpacked_key(F.col("location_hkey")).alias("location_hkey"),
        "location_point",
        "longitude",
        "latitude",
        unpacked_key(F.col("ward_hkey")).alias("ward_hkey"),
        "ward_id",
        unpacked_key(F.col("neighborhood_hkey")).alias("neighborhood_hkey"),
        "neighborhood",
    )


def with_dimension_keys(
    crash: DataFrame, dates: DataFrame | None = None, locations: DataFrame | None = None
) -> DataFrame:
    """Add ``date_hkey`` and ``location_hkey`` to staged crashes.

    With the dimensions given they are looked up by two left joins, which split hot times
    and places themselves, as dimensions are often not stored yet. Both keys are
    functions of crash columns, though, and dimensions built from the same crashes
    hold exactly one row for each value, so by default the keys are computed in
    place and the fact table is not shuffled at all. A crash without a time or
    without a full coordinate pair matches no dimension row either way.
    """
    lat, lon = F.col("location_latitude"), F.col("location_longitude")
    if dates is None:
        t = F.col("crash_datetime")
        crash = crash.withColumn("date_hkey", F.when(t.isNotNull(), surrogate_key(t)))
    else:
        crash = split_left_join(
            crash,
            dates,
            {"crash_datetime": "crash_datetime"},
            {"date_hkey": "date_hkey"},
            spread_by="crash_id",
        )
    if locations is None:
        return crash.withColumn(
            "location_hkey",
            F.when(lat.isNotNull() & lon.isNotNull(), location_key(lat, lon)),
        )
    return split_left_join(
        crash,
        locations,
        {"location_longitude": "longitude", "location_latitude": "latitude"},
        {"location_hkey": "location_hkey"},
        spread_by="crash_id",
    )


def fact_crash(
    crash: DataFrame, dates: DataFrame | None = None, locations: DataFrame | None = None
) -> DataFrame:
    """One row per staged crash (see :func:`with_dimension_keys` for the dimensions)."""
    keyed = with_dimension_keys(crash, dates, locations)
    return keyed.select(
        surrogate_key("crash_id", "date_hkey", "location_hkey").alias("crash_hkey"),
        "crash_id",
        "first_crash_type_code",
        "crash_severity_code",
        "total_injuries_number",
        "total_fatal_injuries_number",
        "weather_condition_code",
        "lighting_condition_code",
        "is_intersection_related",
        "is_hit_and_run",
        "is_work_zone",
        "is_workers_present",
        "is_dooring_related",
        "crash_speed_limit",
        "roadway_surface_condition_code",
        C.category_flag(F.col("road_defect_code"), NO_ROAD_DEFECT).alias("is_road_defect"),
        "damage_level_code",
        "primary_cause_explanation",
        "date_hkey",
        "location_hkey",
        "partition_date",
    )


def fact_vehicle(vehicle: DataFrame, crashes: DataFrame) -> DataFrame:
    """One row per staged vehicle and fact row of its crash."""
    # 'none' sets the defect flag and any named defect clears it: kept as it is.
    defect = C.category_flag(F.col("vehicle_defect"), NO_VEHICLE_DEFECT, clear_is=True)
    keyed = left_join(
        # The flag instead of the text, before rows travel.
        vehicle.withColumn("is_vehicle_defect", defect),
        _packed(crashes, "crash_id", "crash_hkey"),
        {"crash_id": "crash_id"},
        {"crash_hkey": "crash_hkey"},
        spread_by="crash_vehicle_id",
    ).withColumn("crash_hkey", unpacked_key(F.col("crash_hkey")))
    return keyed.select(
        surrogate_key("crash_vehicle_id", "crash_hkey", "vehicle_id").alias("vehicle_hkey"),
        "crash_vehicle_id",
        "crash_hkey",
        "crash_id",
        "vehicle_id",
        "unit_type",
        "passengers_number",
        C.sentinel_to_null(F.col("vehicle_make"), "unknown").alias("vehicle_make"),
        C.sentinel_to_null(F.col("vehicle_model"), "unknown").alias("vehicle_model"),
        "license_plate_state",
        "vehicle_year_number",
        "is_vehicle_defect",
        "vehicle_type",
        C.sentinel_to_null(F.col("vehicle_use_code"), "unknown/na").alias("vehicle_use_code"),
        C.sentinel_to_null(F.col("vehicle_maneuver"), "unknown/na").alias("vehicle_maneuver"),
        "is_speeding",
        "partition_date",
    )


def fact_people(
    people: DataFrame,
    crashes: DataFrame,
    vehicles: DataFrame,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """One row per staged person, fact row of the crash and fact row of the vehicle. With
    ``store`` (frame -> stored frame), people are stored with their vehicles before they meet
    the crashes, in columns, which takes a fraction of their shuffled rows."""
    # Flags instead of texts, and digests in half the bytes, before rows travel.
    people = people.withColumns(
        {
            "is_vision_obscured": C.category_flag(F.col("driver_vision"), CLEAR_VISION),
            "is_physically_impaired": C.category_flag(F.col("driver_physical_condition"), NORMAL_CONDITION),
        }
    ).drop("driver_vision", "driver_physical_condition")
    flags = ["is_vision_obscured", "is_physically_impaired"]
    own = [c for c in people.columns if c not in flags]
    keyed = left_join(
        people,
        _packed(vehicles, "vehicle_id", "vehicle_hkey"),
        {"vehicle_id": "vehicle_id"},
        {"vehicle_hkey": "vehicle_hkey"},
        spread_by="person_id",
    )
    # Last, so that the people of a crash are stored side by side.
    keyed = left_join(
        store(keyed),
        _packed(crashes, "crash_id", "crash_hkey"),
        {"crash_id": "crash_id"},
        {"crash_hkey": "crash_hkey"},
        spread_by="person_id",
    )
    keys = ["crash_hkey", "vehicle_hkey"]
    keyed = keyed.withColumns({key: unpacked_key(F.col(key)) for key in keys})
    return keyed.select(surrogate_key("person_id", *keys).alias("person_hkey"), *own, *keys, *flags)


def _packed(parents: DataFrame, field: str, key: str) -> DataFrame:
    return parents.select(field, packed_key(F.col(key)).alias(key))
