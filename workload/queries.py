"""Named queries: each is a function (spark, sf_dir) -> DataFrame next to the SQL
that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger import schemas, shared_dir, use_utc
from snapledger.functions import calendar as D
from snapledger.functions import cleanse as C
from snapledger.functions import geometry as G
from snapledger.functions.keys import surrogate_key
from snapledger.operators import joins, quality, snapshot, spatial, upsert
from snapledger.plans import checks, history, job, marts, refined, reports, staging
from snapledger.sources import feeds, geojson, raw, tables
from snapledger.sources.folders import STORED
from workload import inputs as I
from workload import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str, extra: dict[str, str] | None = None):
    """Register a query under ``name`` with its SQL."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(use_utc(spark), sf_dir.rstrip("/"))

        run.__doc__ = function.__doc__
        QUERIES[name] = run
        SQL[name] = O.sql(sql, extra)
        return function

    return register


# --- building the models from the derived inputs -------------------------------


def staged(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return staging.stage(I.raw(spark, sf, name), name)


def refined_frames(
    spark: SparkSession,
    sf: str,
    *names: str,
    store: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> dict[str, DataFrame]:
    """The refined models of the last snapshot, unsaved. With ``store`` (name, frame) -> stored
    frame, the dimensions and facts wanted are stored, and each fact is built from stored ones."""
    crash = staged(spark, sf, "crash")
    out = {}
    if "refined_dim_datetime" in names:
        out["refined_dim_datetime"] = store("refined_dim_datetime", refined.dim_datetime(crash))
    if "refined_dim_location" in names or "refined_dim_location_enriched" in names:
        out["refined_dim_location"] = refined.dim_location(crash)
    if "refined_dim_location_enriched" in names:
        out["refined_ward"] = refined.ward(staged(spark, sf, "ward"))
        out["refined_neighborhood"] = refined.neighborhood(staged(spark, sf, "neighborhood"))
        enriched = refined.dim_location_enriched(
            out["refined_dim_location"], out["refined_ward"], out["refined_neighborhood"], I.CELL
        )
        out["refined_dim_location_enriched"] = store("refined_dim_location_enriched", enriched)
    crashes = out["refined_fact_crash"] = store("refined_fact_crash", refined.fact_crash(crash))
    if "refined_fact_vehicle" in names or "refined_fact_people" in names:
        vehicles = store("refined_fact_vehicle", refined.fact_vehicle(staged(spark, sf, "vehicle"), crashes))
        out["refined_fact_vehicle"] = vehicles
    if "refined_fact_people" in names:
        people = refined.fact_people(staged(spark, sf, "people"), crashes, vehicles)
        out["refined_fact_people"] = store("refined_fact_people", people)
    return out


def one(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return refined_frames(spark, sf, name)[name]


def flat_point(df: DataFrame) -> DataFrame:
    """The point column as two plain columns, which any SQL engine can compare."""
    return df.withColumns(
        {"point_lon": F.col("location_point.lon"), "point_lat": F.col("location_point.lat")}
    ).drop("location_point")


def as_wkt(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, G.polygon_wkt(F.col(column)))


def last_of(df: DataFrame, date: str = I.LAST) -> DataFrame:
    return df.where(F.col("partition_date") == F.lit(date).cast("date"))


# --- feeds, landing, raw tables ------------------------------------------------


def _csv_columns(name: str) -> str:
    """The columns of a feed as its CSV files hold them: times in whole milliseconds, no
    difference between empty and missing text."""
    types = dict(part.split() for part in schemas.FEEDS[name].split(","))
    shown = {"timestamp": "make_timestamp(({0} // 1000000) * 1000) as {0}", "string": "nullif({0}, '') as {0}"}
    return ", ".join(shown.get(types[c], "{0}").format(c) for c in I.COLUMNS[name] if c != "partition_date")


@query(
    "scan_csv",
    " union all by name ".join(
        f"select '{name}' as dataset, {_csv_columns(name)} {O.last('raw_' + name)}" for name in schemas.FEEDS
    ),
)
def scan_csv(spark, sf):
    """All rows and columns of the three feeds, read back from CSV files."""
    parts = []
    for name, types in schemas.FEEDS.items():
        path = I.write_csv_feed(spark, sf, name, shared_dir(spark, f"{name}-csv"))
        parts.append(feeds.scan_csv(spark, path, types).withColumn("dataset", F.lit(name)))
    together = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return together.unionByName(parts[2], allowMissingColumns=True)


CRASH_TEXT = [
    n for n, _, kind in staging.CRASH if kind in ("string", "yes_no") and n != "crash_record_id"
]


@query(
    "csv_to_parquet",
    "select crash_record_id, (crash_date // 1000000) * 1000000 as crash_date, posted_speed_limit,"
    " street_no, injuries_total, injuries_fatal, latitude, longitude, "
    + ", ".join(f"coalesce({c}, '') as {c}" for c in CRASH_TEXT)
    + f" {O.last('raw_crash')}",
)
def csv_to_parquet(spark, sf):
    csv = I.write_csv_feed(spark, sf, "crash", shared_dir(spark, "crash-csv"))
    path = feeds.csv_to_parquet(spark, csv, shared_dir(spark, "landing"), "crash", I.LAST)
    return feeds.read_landed(spark, path)


@query("landing_roundtrip", f"select *, strftime(partition_date, '%Y%m%d') as ds {O.last('raw_vehicle')}")
def landing_roundtrip(spark, sf):
    root = shared_dir(spark, "landing")
    feeds.land(last_of(I.raw(spark, sf, "vehicle")), root, "vehicle", I.LAST)
    return spark.read.parquet(f"{root}/vehicle").withColumn("ds", F.col("ds").cast("string"))


def _appended(spark, sf, name, dates) -> str:
    path = shared_dir(spark, f"raw-{name}")
    for date in dates:
        rows = last_of(I.raw(spark, sf, name), date).drop("partition_date")
        raw.append_snapshot(rows, path, date)
    return path


@query("raw_append", "select * from raw_crash")
def raw_append(spark, sf):
    return raw.read_raw(spark, _appended(spark, sf, "crash", I.SNAPSHOTS))


@query(
    "snapshot_append",
    "select partition_date, cast(count(*) as bigint) as row_count,"
    " cast(count(distinct person_id) as bigint) as key_count from raw_people group by 1",
)
def snapshot_append(spark, sf):
    """Appending the last snapshot a second time changes nothing."""
    path = _appended(spark, sf, "people", [*I.SNAPSHOTS, I.LAST])
    return snapshot.snapshot_history(raw.read_raw(spark, path), "person_id")


@query("raw_replace", "select * from raw_ward")
def raw_replace(spark, sf):
    """A newer boundary set replaces the older one."""
    path, wards = shared_dir(spark, "raw-ward"), I.raw(spark, sf, "ward").drop("partition_date")
    raw.replace_snapshot(wards.withColumn("ward", F.lit("old")), path, I.SNAPSHOTS[0])
    raw.replace_snapshot(wards, path, I.LAST)
    return raw.read_raw(spark, path)


@query(
    "geojson_scan",
    "select ward_id, globalid, json_extract_string(geometry, '$.type') as geometry_type,"
    " geometry from raw_ward",
)
def geojson_scan(spark, sf):
    path = I.write_geojson_feed(spark, sf, "ward", shared_dir(spark, "ward-geojson"))
    features = geojson.scan_geojson(spark, path, multi_line=False)
    return features.select(
        F.get_json_object("properties", "$.ward_id").alias("ward_id"),
        F.get_json_object("properties", "$.globalid").alias("globalid"),
        F.get_json_object("geometry", "$.type").alias("geometry_type"),
        "geometry",
    )


@query(
    "geojson_documents",
    "select 'ward' as dataset, cast(json_extract_string(geometry, '$.type') as varchar) as kind, ward_id as id"
    " from raw_ward union all select 'neighborhood' as dataset, json_extract_string(geometry, '$.type') as kind,"
    " pri_neigh as id from raw_neighborhood",
)
def geojson_documents(spark, sf):
    """Features of collections that are one JSON document of many lines per file."""
    parts = []
    for name, key in (("ward", "ward_id"), ("neighborhood", "pri_neigh")):
        path = I.write_geojson_documents(spark, sf, name, shared_dir(spark, f"{name}-documents"))
        features = geojson.scan_geojson(spark, path, multi_line=True)
        flat = geojson.flatten_features(features, schemas.BOUNDARIES[name])
        kind = F.get_json_object("geometry", "$.type").alias("kind")
        parts.append(flat.select(F.lit(name).alias("dataset"), kind, F.col(key).alias("id")))
    return parts[0].unionByName(parts[1])


@query("geojson_flatten", "select * from raw_ward")
def geojson_flatten(spark, sf):
    """Features to newline-delimited JSON and back, then stamped."""
    path = I.write_geojson_feed(spark, sf, "ward", shared_dir(spark, "ward-geojson"))
    features = geojson.scan_geojson(spark, path, multi_line=False)
    out = shared_dir(spark, "ward-ndjson")
    geojson.write_ndjson(geojson.flatten_features(features, schemas.WARD), out)
    rows = geojson.read_ndjson(spark, out, f"{schemas.WARD}, geometry string")
    return snapshot.stamp_snapshot(rows, I.LAST)


@query(
    "geojson_all_properties",
    "select ward_id, globalid, ward, objectid, edit_date, st_length_, st_area_sh,"
    " cast(ward_id as bigint) as whole, cast(ward_id as double) + 0.5 as half,"
    " concat('{\"id\":', ward_id, '}') as nested, geometry from raw_ward",
)
def geojson_all_properties(spark, sf):
    """Only the id is declared; all other properties are found and typed."""
    path = I.write_geojson_feed(spark, sf, "ward", shared_dir(spark, "ward-geojson"))
    features = geojson.scan_geojson(spark, path, multi_line=False)
    number = F.get_json_object("properties", "$.ward_id")
    more = [
        F.lit(', "whole": '), number, F.lit(', "half": '), number, F.lit('.5, "nested": {"id": '),
        number, F.lit("}}"),
    ]
    features = features.withColumn(
        "properties", F.concat(F.expr("left(properties, length(properties) - 1)"), *more)
    )
    return geojson.flatten_features(features, geojson.all_properties(features, "ward_id string"))


EVENT_PROPERTIES = (
    "concat('{\"event_id\": ', cast(event_id as string), ', \"kind\": \"', event_type,"
    " '\", \"value\": ', cast(value as string), ', \"ok\": ',"
    " case when event_id % 2 = 0 then 'true' else 'false' end, ', \"nothing\": null, \"mixed\": ',"
    " case when event_id % 2 = 0 then '1' else '\"x\"' end, ', \"sometimes\": ',"
    " case when event_id % 3 = 0 then 'null' else '7' end, ', \"props\": ', props, '}')"
)


@query(
    "property_schema",
    """
    select name, case when bool_and(t = 'VARCHAR') then 'string'
      when bool_and(t in ('BIGINT', 'UBIGINT', 'BOOLEAN')) then 'int64' else 'float64' end as type
    from (select name, nullif(json_type(p, '$.' || name), 'NULL') as t from
           (select p, unnest(json_keys(p)) as name from properties) k) t
    group by name""",
    {"properties": f"select {EVENT_PROPERTIES} as p from events"},
)
def property_schema(spark, sf):
    events = I.table(spark, sf, "events")
    return geojson.infer_property_schema(events.select(F.expr(EVENT_PROPERTIES).alias("properties")))


# --- snapshots -----------------------------------------------------------------


@query("ensure_column", "select o_orderkey, o_custkey, cast(null as date) as partition_date from orders")
def ensure_column(spark, sf):
    return snapshot.ensure_column(I.table(spark, sf, "orders").select("o_orderkey", "o_custkey"))


@query(
    "stamp_snapshot",
    f"select crash_record_id, case when partition_date = date '{I.LAST}' then date '2002-02-04'"
    " else partition_date end as partition_date from raw_crash",
)
def stamp_snapshot(spark, sf):
    """The rows of the last snapshot arrive without a date."""
    unstamped = I.raw(spark, sf, "crash").select(
        "crash_record_id",
        F.nullif(F.col("partition_date"), F.lit(I.LAST).cast("date")).alias("partition_date"),
    )
    return snapshot.stamp_snapshot(unstamped, "2002-02-04")


@query("latest_snapshot", f"select * {O.last('raw_people')}")
def latest_snapshot(spark, sf):
    return snapshot.latest_snapshot(I.raw(spark, sf, "people"))


@query("snapshot_as_of", "select * from raw_crash where partition_date = (select max(partition_date)"
       " from raw_crash where partition_date <= date '2001-06-30')")
def snapshot_as_of(spark, sf):
    return snapshot.snapshot_as_of(I.raw(spark, sf, "crash"), "2001-06-30")


@query(
    "snapshot_history",
    "select partition_date, cast(count(*) as bigint) as row_count,"
    " cast(count(distinct crash_record_id) as bigint) as key_count from raw_crash group by 1",
)
def snapshot_history(spark, sf):
    return snapshot.snapshot_history(I.raw(spark, sf, "crash"), "crash_record_id")


@query(
    "record_versions",
    """
    select crash_record_id, cast(count(*) as bigint) as snapshot_count,
      min(partition_date) as first_snapshot, max(partition_date) as last_snapshot,
      cast(count(distinct (road_defect, longitude, latitude)) as bigint) as version_count
    from raw_crash group by 1""",
)
def record_versions(spark, sf):
    return snapshot.record_versions(
        I.raw(spark, sf, "crash"), "crash_record_id", ["road_defect", "longitude", "latitude"]
    )


# --- casts and cleansing -------------------------------------------------------


INTERVALS = {
    "seen": "select distinct s.crash_record_id, s.road_defect, s.street_no, s.partition_date, d.n, d.nxt"
    " from (select * from raw_crash where not (injuries_total = 2 and partition_date = date"
    f" '{I.SNAPSHOTS[1]}')) s join (select partition_date, row_number() over (order by partition_date) as n,"
    " lead(partition_date) over (order by partition_date) as nxt from (select distinct partition_date"
    " from raw_crash) t) d on d.partition_date = s.partition_date",
    "runs": "select *, n - row_number() over (partition by crash_record_id, road_defect, street_no order by n)"
    " as island from seen",
}


@query(
    "record_intervals",
    "select crash_record_id, road_defect, street_no, min(partition_date) as valid_from,"
    " max(partition_date) as valid_to, cast(count(*) as bigint) as snapshot_count,"
    " arg_max_null(nxt, n) as next_snapshot from runs group by crash_record_id, road_defect, street_no, island",
    INTERVALS,
)
def record_intervals(spark, sf):
    """Versions of crashes over time; some crashes are missing from the second snapshot and
    come back in the third."""
    rows = I.raw(spark, sf, "crash")
    missing = (F.col("injuries_total") == 2) & (F.col("partition_date") == F.lit(I.SNAPSHOTS[1]).cast("date"))
    return snapshot.record_intervals(rows.where(~missing), "crash_record_id", ["road_defect", "street_no"])


@query(
    "cast_int_rounding",
    "select l_orderkey, l_linenumber, l_partkey, cast(round((l_quantity - 25) / 2) as bigint) as half,"
    " cast(round(l_extendedprice) as bigint) as price from lineitem",
)
def cast_int_rounding(spark, sf):
    double = F.lit(0.0).cast("double")
    rows = I.table(spark, sf, "lineitem")
    half = (F.col("l_quantity") - 25) / 2 + double
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        C.to_bigint(half, rows.schema["l_quantity"].dataType).alias("half"),
        C.to_bigint(F.col("l_extendedprice"), rows.schema["l_extendedprice"].dataType).alias("price"),
    )


@query(
    "cast_timestamp",
    "select o_orderkey, cast(concat(cast(cast(o_orderdate as date) as string), 'T08:30:00.250')"
    " as timestamp) as edit_date from orders",
)
def cast_timestamp(spark, sf):
    text = F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T08:30:00.250"))
    texts = I.table(spark, sf, "orders").select("o_orderkey", text.alias("edit_date"))
    return texts.select("o_orderkey", staging.typed(texts, "edit_date", "timestamp").alias("edit_date"))


@query(
    "nanos_to_timestamp",
    "select crash_record_id, partition_date,"
    " make_timestamp((crash_date // 1000000) * 1000) as crash_datetime from raw_crash",
)
def nanos_to_timestamp(spark, sf):
    return I.raw(spark, sf, "crash").select(
        "crash_record_id",
        "partition_date",
        C.nanos_to_timestamp(F.col("crash_date")).alias("crash_datetime"),
    )


@query(
    "normalize_case",
    "select person_id, partition_date, upper(sex) as sex,"
    " upper(drivers_license_state) as drivers_license_state from raw_people",
)
def normalize_case(spark, sf):
    people = I.raw(spark, sf, "people")
    return people.select(
        "person_id",
        "partition_date",
        staging.typed(people, "sex", "upper").alias("sex"),
        staging.typed(people, "drivers_license_state", "upper").alias("drivers_license_state"),
    )


@query(
    "empty_to_null",
    "select crash_unit_id, partition_date, nullif(make, '') as make, nullif(model, '') as model,"
    " nullif(unit_type, '') as unit_type from raw_vehicle",
)
def empty_to_null(spark, sf):
    columns = ["make", "model", "unit_type"]
    return I.raw(spark, sf, "vehicle").select(
        "crash_unit_id", "partition_date", *[C.empty_to_null(F.col(c)).alias(c) for c in columns]
    )


@query(
    "yes_no_to_boolean",
    "select crash_record_id, partition_date, hit_and_run_i as answer,"
    f" {O.yes_no('hit_and_run_i')} as is_hit_and_run from raw_crash",
)
def yes_no_to_boolean(spark, sf):
    return I.raw(spark, sf, "crash").select(
        "crash_record_id",
        "partition_date",
        F.col("hit_and_run_i").alias("answer"),
        C.yes_no_to_boolean(F.col("hit_and_run_i")).alias("is_hit_and_run"),
    )


@query(
    "sentinel_to_null",
    "select crash_unit_id, partition_date,"
    " case when lower(make) = 'unknown' then null else make end as make,"
    " case when lower(vehicle_use) = 'unknown/na' then null else vehicle_use end as vehicle_use"
    " from raw_vehicle",
)
def sentinel_to_null(spark, sf):
    return I.raw(spark, sf, "vehicle").select(
        "crash_unit_id",
        "partition_date",
        C.sentinel_to_null(F.col("make"), "unknown").alias("make"),
        C.sentinel_to_null(F.col("vehicle_use"), "unknown/na").alias("vehicle_use"),
    )


@query(
    "category_flags",
    "select crash_record_id as id, partition_date, "
    + O.flag("road_defect", "no defects", "false", "true")
    + " as flag from raw_crash union all select cast(crash_unit_id as string), partition_date, "
    + O.flag("vehicle_defect", "none", "true", "false")
    + " from raw_vehicle",
)
def category_flags(spark, sf):
    road = C.category_flag(F.col("road_defect"), refined.NO_ROAD_DEFECT)
    vehicle = C.category_flag(F.col("vehicle_defect"), refined.NO_VEHICLE_DEFECT, clear_is=True)
    crashes = I.raw(spark, sf, "crash").select(
        F.col("crash_record_id").alias("id"), "partition_date", road.alias("flag")
    )
    vehicles = I.raw(spark, sf, "vehicle").select(
        F.col("crash_unit_id").cast("string").alias("id"), "partition_date", vehicle.alias("flag")
    )
    return crashes.unionByName(vehicles)


@query(
    "calendar_flags",
    "select event_id, extract(dayofweek from ts) in (0, 6) as is_weekend,"
    " extract(month from ts) in (12, 1, 2) as is_winter,"
    " extract(hour from ts) in (7, 8, 9, 16, 17, 18) as is_rush_hour from events",
)
def calendar_flags(spark, sf):
    flags = D.calendar_flags(F.col("ts").cast("timestamp"))
    return I.table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in flags.items()])


@query(
    "date_parts",
    "select event_id, cast(extract(year from ts) as bigint) as year,"
    " cast(extract(month from ts) as bigint) as month,"
    " cast(extract(quarter from ts) as bigint) as quarter,"
    " cast(strftime(ts, '%U') as bigint) as week, cast(extract(day from ts) as bigint) as day,"
    " cast(extract(dayofweek from ts) + 1 as bigint) as day_of_week,"
    " cast(extract(hour from ts) as bigint) as hour from events",
)
def date_parts(spark, sf):
    parts = D.date_parts(F.col("ts").cast("timestamp"))
    return I.table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query(
    "week_sunday",
    "select o_orderkey, cast(strftime(o_orderdate, '%U') as bigint) as week from orders",
)
def week_sunday(spark, sf):
    week = D.week_sunday(F.col("o_orderdate").cast("date")).cast("bigint")
    return I.table(spark, sf, "orders").select("o_orderkey", week.alias("week"))


@query(
    "project_except",
    "select * exclude (driver_vision, driver_physical_condition) from staging_people",
)
def project_except(spark, sf):
    return staged(spark, sf, "people").drop("driver_vision", "driver_physical_condition")


@query(
    "null_predicates",
    "select partition_date, cast(count(*) filter (where road_defect is null) as bigint) as n_null,"
    " cast(count(*) filter (where road_defect = '') as bigint) as n_empty,"
    " cast(count(*) filter (where road_defect in ('Unknown', 'NO DEFECTS')) as bigint) as n_listed,"
    " cast(count(*) filter (where not (road_defect in ('Unknown', 'NO DEFECTS'))) as bigint)"
    " as n_other, cast(count(*) filter (where longitude is null and latitude is not null) as bigint)"
    " as n_half_located from raw_crash group by 1 having count(*) > 1",
)
def null_predicates(spark, sf):
    defect, lon, lat = F.col("road_defect"), F.col("longitude"), F.col("latitude")
    listed = defect.isin("Unknown", "NO DEFECTS")
    return (
        I.raw(spark, sf, "crash")
        .groupBy("partition_date")
        .agg(
            F.count_if(defect.isNull()).alias("n_null"),
            F.count_if(defect == "").alias("n_empty"),
            F.count_if(listed).alias("n_listed"),
            F.count_if(~listed).alias("n_other"),
            F.count_if(lon.isNull() & lat.isNotNull()).alias("n_half_located"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1")
        .drop("n")
    )


@query(
    "surrogate_key",
    "select o_orderkey, "
    + O.key("o_orderkey", "nullif(o_orderstatus, 'F')", "o_totalprice", "cast(o_orderdate as date)")
    + " as hkey from orders",
)
def surrogate_key_query(spark, sf):
    return I.table(spark, sf, "orders").select(
        "o_orderkey",
        surrogate_key(
            "o_orderkey",
            F.nullif(F.col("o_orderstatus"), F.lit("F")),
            "o_totalprice",
            F.col("o_orderdate").cast("date"),
        ).alias("hkey"),
    )


# --- joins and distinct --------------------------------------------------------


@query("distinct_datetimes", "select distinct crash_datetime from staging_crash")
def distinct_datetimes(spark, sf):
    return staged(spark, sf, "crash").select("crash_datetime").distinct()


@query(
    "distinct_locations",
    "select distinct location_latitude as latitude, location_longitude as longitude"
    " from staging_crash",
)
def distinct_locations(spark, sf):
    return (
        staged(spark, sf, "crash")
        .select(
            F.col("location_latitude").alias("latitude"),
            F.col("location_longitude").alias("longitude"),
        )
        .distinct()
    )


@query(
    "left_join_dim",
    "select c.crash_id, d.date_hkey, d.is_weekend from staging_crash c"
    " left join dim_datetime d on c.crash_datetime = d.crash_datetime",
)
def left_join_dim(spark, sf):
    crash = staged(spark, sf, "crash").select("crash_id", "crash_datetime")
    return joins.split_left_join(
        crash,
        refined.dim_datetime(crash),
        {"crash_datetime": "crash_datetime"},
        {"date_hkey": "date_hkey", "is_weekend": "is_weekend"},
        spread_by="crash_id",
    ).drop("crash_datetime")


@query(
    "left_join_location",
    "select c.crash_id, c.location_longitude, c.location_latitude, l.location_hkey"
    " from staging_crash c left join dim_location l on c.location_longitude = l.longitude"
    " and c.location_latitude = l.latitude",
)
def left_join_location(spark, sf):
    crash = staged(spark, sf, "crash").select("crash_id", "location_longitude", "location_latitude")
    return joins.split_left_join(
        crash,
        refined.dim_location(crash),
        {"location_longitude": "longitude", "location_latitude": "latitude"},
        {"location_hkey": "location_hkey"},
        spread_by="crash_id",
    )


@query(
    "joined_dimension_keys",
    "select crash_id, date_hkey, location_hkey from fact_crash",
)
def joined_dimension_keys(spark, sf):
    """The two chained dimension joins of the crash fact."""
    crash = staged(spark, sf, "crash")
    keyed = refined.with_dimension_keys(
        crash, refined.dim_datetime(crash), refined.dim_location(crash)
    )
    return keyed.select("crash_id", "date_hkey", "location_hkey")


@query(
    "spatial_left_join",
    "select l.longitude, l.latitude, w.k as ward_id from dim_location l"
    " left join in_ward w on w.x = l.longitude and w.y = l.latitude",
)
def spatial_left_join(spark, sf):
    points = refined.dim_location(staged(spark, sf, "crash"))
    wards = staged(spark, sf, "ward")
    return spatial.spatial_left_join(
        points, "location_point", wards, "ward_geometry", {"ward_id": "ward_id"}, I.CELL
    ).select("longitude", "latitude", "ward_id")


# --- geometry ------------------------------------------------------------------


@query(
    "parse_geojson",
    f"""
    select ward_id, json_extract_string(geometry, '$.type') as geometry_type,
      cast(len(p) as bigint) as part_count, cast(len(flatten(p)) as bigint) as ring_count,
      cast(list_sum(list_transform(flatten(p), lambda r: len(r))) as bigint) as position_count,
      list_max(list_transform(flatten(flatten(p)), lambda q: q[1])) as max_lon,
      list_min(list_transform(flatten(flatten(p)), lambda q: q[2])) as min_lat
    from (select ward_id, geometry, {O.parts('geometry')} as p from raw_ward) t""",
)
def parse_geojson(spark, sf):
    polygon = G.polygon_from_geojson(F.col("geometry"))
    rings = F.flatten("g.parts")
    positions = F.flatten(rings)
    return (
        I.raw(spark, sf, "ward")
        .select("ward_id", polygon.alias("g"))
        .select(
            "ward_id",
            F.col("g.type").alias("geometry_type"),
            F.size("g.parts").cast("bigint").alias("part_count"),
            F.size(rings).cast("bigint").alias("ring_count"),
            F.size(positions).cast("bigint").alias("position_count"),
            F.array_max(F.transform(positions, lambda p: p[0])).alias("max_lon"),
            F.array_min(F.transform(positions, lambda p: p[1])).alias("min_lat"),
        )
    )


@query("geometry_wkt", f"select ward_id, {O.wkt('geometry')} as wkt from raw_ward")
def geometry_wkt(spark, sf):
    polygon = G.polygon_from_geojson(F.col("geometry"))
    return I.raw(spark, sf, "ward").select("ward_id", G.polygon_wkt(polygon).alias("wkt"))


@query("geometry_key", f"select ward_id, {O.key(O.wkt('geometry'))} as hkey from raw_ward")
def geometry_key(spark, sf):
    polygon = G.polygon_from_geojson(F.col("geometry"))
    return I.raw(spark, sf, "ward").select(
        "ward_id", surrogate_key(G.polygon_wkt(polygon)).alias("hkey")
    )


@query(
    "make_point",
    "select crash_record_id, partition_date, longitude is not null and latitude is not null as"
    " has_point, case when latitude is not null then longitude end as point_lon,"
    " case when longitude is not null then latitude end as point_lat from raw_crash",
)
def make_point(spark, sf):
    rows = I.raw(spark, sf, "crash").withColumn(
        "location_point", G.make_point(F.col("longitude"), F.col("latitude"))
    )
    return flat_point(
        rows.select(
            "crash_record_id",
            "partition_date",
            F.col("location_point").isNotNull().alias("has_point"),
            "location_point",
        )
    )


@query(
    "point_within",
    """
    select p.longitude, p.latitude, p.ward_id, case when w.ward_id is not null then i.k is not null end as is_within
    from (select *, cast(floor(latitude) * 10 + floor(longitude) as bigint) + 1 as ward_id from dim_location) p
    left join staging_ward w on w.ward_id = p.ward_id
    left join in_ward i on i.x = p.longitude and i.y = p.latitude and i.k = w.ward_id""",
)
def point_within(spark, sf):
    """The exact test on pairs found by an ordinary join: each point with the ward whose
    square it should be in, or NULL where there is no such ward."""
    points = refined.dim_location(staged(spark, sf, "crash"))
    square = F.floor("latitude") * 10 + F.floor("longitude") + 1
    pairs = points.withColumn("ward_id", square).join(staged(spark, sf, "ward"), "ward_id", "left")
    within = G.point_within(F.col("location_point"), F.col("ward_geometry"))
    return pairs.select("longitude", "latitude", "ward_id", within.alias("is_within"))


# --- merge ---------------------------------------------------------------------


@query(
    "upsert_by_key",
    f"""
    select k, v, partition_date from src union all
    select t.k, t.v, t.partition_date from tgt t left join src on t.k = src.k where src.k is null""",
    {
        "src": "select crash_record_id as k, road_defect as v, partition_date from raw_crash"
        f" where partition_date = date '{I.LAST}'",
        "tgt": "select case when injuries_total = 3 then concat('gone ', crash_record_id)"
        " else crash_record_id end as k, road_defect as v, partition_date from raw_crash"
        f" where partition_date = date '{I.SNAPSHOTS[1]}'",
    },
)
def upsert_by_key(spark, sf):
    """The last snapshot merged into the one before, which also has other keys."""
    rows = I.raw(spark, sf, "crash")
    gone = F.when(
        F.col("injuries_total") == 3, F.concat(F.lit("gone "), F.col("crash_record_id"))
    ).otherwise(F.col("crash_record_id"))
    source = last_of(rows).select(
        F.col("crash_record_id").alias("k"), F.col("road_defect").alias("v"), "partition_date"
    )
    target = last_of(rows, I.SNAPSHOTS[1]).select(
        gone.alias("k"), F.col("road_defect").alias("v"), "partition_date"
    )
    upsert.require_unique(source, "k")
    return upsert.upsert(target, source, "k")


MERGES = {
    "src": "select crash_record_id as k, road_defect as v, partition_date from raw_crash"
    f" where partition_date = date '{I.LAST}'",
    "tgt": "select case when injuries_total = 3 then concat('gone ', crash_record_id)"
    " else crash_record_id end as k, road_defect as v, partition_date from raw_crash"
    f" where partition_date = date '{I.SNAPSHOTS[1]}'",
    "kept": "select t.k, t.v, t.partition_date from tgt t left join src on t.k = src.k where src.k is null",
}


@query(
    "merge_repeated",
    "select 'both checked' as state, * from src union all select 'both checked' as state, * from kept"
    " union all select 'first repeated, not checked' as state, * from src"
    " union all select 'first checked again' as state, * from src"
    " union all select 'first checked again' as state, * from kept where v is not null",
    MERGES,
)
def merge_repeated(spark, sf):
    """A stored table after two run dates, after the first date was built again, smaller, but
    not checked and the second one repeated, and after the first has been checked and the
    second repeated once more. No state shows rows of an attempt that no longer holds."""
    rows = I.raw(spark, sf, "crash")
    gone = F.when(
        F.col("injuries_total") == 3, F.concat(F.lit("gone "), F.col("crash_record_id"))
    ).otherwise(F.col("crash_record_id"))
    second = last_of(rows).select(F.col("crash_record_id").alias("k"), F.col("road_defect").alias("v"), "partition_date")
    first = last_of(rows, I.SNAPSHOTS[1]).select(gone.alias("k"), F.col("road_defect").alias("v"), "partition_date")
    path = shared_dir(spark, "merged")

    def build(df, date, check):
        attempt = tables.write_attempt(df, path, "k", date)
        if check:
            attempt.mark_checked(spark)

    def state(name):
        # The newest attempt of the second date is checked, so it is what readers get.
        return tables.read_version(spark, path).select(F.lit(name).alias("state"), "k", "v", "partition_date")

    build(first, I.SNAPSHOTS[1], True)
    build(second, I.LAST, True)
    states = [state("both checked")]
    build(first.where("v is not null"), I.SNAPSHOTS[1], False)
    build(second, I.LAST, True)
    states.append(state("first repeated, not checked"))
    tables.mark_checked(spark, path, I.SNAPSHOTS[1])
    build(second, I.LAST, True)
    states.append(state("first checked again"))
    return states[0].unionByName(states[1]).unionByName(states[2])


def _keyed_crashes(date: str) -> str:
    t = "make_timestamp((crash_date // 1000000) * 1000)"
    date_key = f"case when crash_date is not null then {O.key(t)} end"
    place_key = (
        "case when latitude is not null and longitude is not null then "
        + O.key("latitude", "longitude")
        + " end"
    )
    return (
        f"select {O.key('crash_record_id', date_key, place_key)} as crash_hkey,"
        f" crash_record_id as crash_id, {place_key} as location_hkey, partition_date"
        f" from raw_crash where partition_date = date '{date}'"
    )


REKEYED = {
    "src": _keyed_crashes(I.LAST),
    "tgt": _keyed_crashes(I.SNAPSHOTS[1]),
    "merged": "select * from src union all select tgt.* from tgt left join src"
    " on tgt.crash_hkey = src.crash_hkey where src.crash_hkey is null",
}


def _rekeyed(spark, sf) -> DataFrame:
    rows = I.raw(spark, sf, "crash")
    old = staging.rename_and_type(last_of(rows, I.SNAPSHOTS[1]), "crash")
    new = staging.rename_and_type(last_of(rows), "crash")
    merged = upsert.upsert(refined.fact_crash(old), refined.fact_crash(new), "crash_hkey")
    return merged.select("crash_hkey", "crash_id", "location_hkey", "partition_date")


@query("upsert_rekeyed", "select * from merged", REKEYED)
def upsert_rekeyed(spark, sf):
    """Crashes whose location was corrected have a new key and keep the old row."""
    return _rekeyed(spark, sf)


@query(
    "current_only",
    "select * from merged where partition_date = (select max(partition_date) from merged)",
    REKEYED,
)
def current_only(spark, sf):
    """On the stored table, as the newest date is looked up in it first."""
    path = shared_dir(spark, "merged")
    _rekeyed(spark, sf).write.parquet(path)
    return snapshot.current_only(spark.read.parquet(path))


# --- checks --------------------------------------------------------------------


@query("check_not_null", "select * from raw_crash where crash_date is null")
def check_not_null(spark, sf):
    return quality.is_null(I.raw(spark, sf, "crash"), "crash_date")


@query(
    "check_unique",
    "select l_orderkey, l_linenumber, cast(count(*) as bigint) as n_records from lineitem"
    " where l_orderkey is not null and l_linenumber is not null group by 1, 2 having count(*) > 1",
)
def check_unique(spark, sf):
    return quality.not_unique(I.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "check_unique_in_partition",
    "select vehicle_id as record_id, partition_date, cast(count(*) as bigint) as record_count"
    " from raw_people group by 1, 2 having count(*) > 1",
)
def check_unique_in_partition(spark, sf):
    return quality.not_unique_in_snapshot(I.raw(spark, sf, "people"), "vehicle_id")


@query(
    "check_relationships",
    "select p.person_id, p.crash_record_id, p.partition_date from raw_people p"
    " where p.crash_record_id is not null and not exists (select 1 from raw_crash c"
    " where c.crash_record_id = p.crash_record_id)",
)
def check_relationships(spark, sf):
    people = I.raw(spark, sf, "people").select("person_id", "crash_record_id", "partition_date")
    crashes = I.raw(spark, sf, "crash")
    return quality.no_parent(people, "crash_record_id", crashes, "crash_record_id")


# Raw tables with faults in an older snapshot: crashes that are there twice, and crashes
# and people without an id.
HISTORY = {"raw_crash": "crash_history", "raw_people": "people_history"}
FAULTS = {
    "crash_history": "select * from raw_crash union all select * replace"
    " (case when injuries_total = 1 then null else crash_record_id end as crash_record_id)"
    f" from raw_crash where partition_date = date '{I.SNAPSHOTS[0]}' and injuries_total in (1, 2)",
    "people_history": "select * from raw_people union all select * replace (null as person_id)"
    f" from raw_people where partition_date = date '{I.SNAPSHOTS[1]}' and age = 33",
}


def _histories(spark, sf) -> dict[str, DataFrame]:
    frames = {f"raw_{name}": I.raw(spark, sf, name) for name in I.COLUMNS}
    crash, people = frames["raw_crash"], frames["raw_people"]
    no_id = F.when(F.col("injuries_total") != 1, F.col("crash_record_id"))
    repeated = last_of(crash, I.SNAPSHOTS[0]).where("injuries_total in (1, 2)")
    unnamed = last_of(people, I.SNAPSHOTS[1]).where("age = 33")
    frames["raw_crash"] = crash.unionByName(repeated.withColumn("crash_record_id", no_id))
    frames["raw_people"] = people.unionByName(unnamed.withColumn("person_id", F.lit(None).cast("string")))
    return frames


def _failures_sql(check: checks.Check) -> str:
    table = marts.MARTS.get(check.model, check.model)
    table = {"refined_ward": table, "refined_neighborhood": table}.get(
        table, table.removeprefix("refined_")
    )
    rows = f"(select * from {HISTORY.get(table, table)})"
    if check.kind == "not_null":
        body = f"select count(*) from {rows} t where {check.column} is null"
    elif check.kind == "unique":
        body = (
            f"select count(*) from (select {check.column} from {rows} t where {check.column}"
            " is not null group by 1 having count(*) > 1) g"
        )
    elif check.kind == "unique_id_partition":
        body = (
            f"select count(*) from (select {check.column} from {rows} t"
            f" group by {check.column}, partition_date having count(*) > 1) g"
        )
    else:
        body = (
            f"select count(*) from {rows} t where {check.column} is not null and not exists"
            f" (select 1 from {HISTORY.get(check.to, check.to)} p where p.{check.field} = t.{check.column}"
            " and p.partition_date = t.partition_date)"
        )
    return (
        f"select '{check.model}' as model, '{check.kind}' as \"check\","
        f" '{check.column}' as \"column\", cast(({body}) as bigint) as failures"
    )


@query("quality_report", " union all ".join(_failures_sql(c) for c in checks.ALL_CHECKS), FAULTS)
def quality_report(spark, sf):
    """All declared checks, raw tables with all their snapshots. The facts are stored
    before they are checked, as the next one is built from them."""
    frames = _histories(spark, sf)
    staged_rows = {
        n: staging.rename_and_type(last_of(frames[f"raw_{n}"]), n) for n in I.COLUMNS
    }
    folder = shared_dir(spark, "checked")

    def store(name: str, df: DataFrame) -> DataFrame:
        df.write.options(**STORED).parquet(f"{folder}/{name}")
        frames[name] = spark.read.parquet(f"{folder}/{name}")
        return frames[name]

    frames["refined_dim_datetime"] = refined.dim_datetime(staged_rows["crash"])
    locations = store("refined_dim_location", refined.dim_location(staged_rows["crash"]))
    wards = store("refined_ward", refined.ward(staged_rows["ward"]))
    hoods = store("refined_neighborhood", refined.neighborhood(staged_rows["neighborhood"]))
    frames["refined_dim_location_enriched"] = refined.dim_location_enriched(
        locations, wards, hoods, I.CELL
    )
    crashes = store("refined_fact_crash", refined.fact_crash(staged_rows["crash"]))
    vehicles = store("refined_fact_vehicle", refined.fact_vehicle(staged_rows["vehicle"], crashes))
    store("refined_fact_people", refined.fact_people(staged_rows["people"], crashes, vehicles))
    return checks.with_mart_results(checks.report(frames))


@query(
    "quality_report_incremental",
    " union all ".join(_failures_sql(c) for c in checks.SOURCE_CHECKS),
    FAULTS,
)
def quality_report_incremental(spark, sf):
    """The checks of the raw tables over all snapshots, as the last of three runs gives them:
    each run adds a snapshot, and the last one delivers the first snapshot of crashes and the
    second of people anew, with faults. Only new and changed snapshots are counted."""
    root = shared_dir(spark, "raw-history")
    paths = {f"raw_{name}": f"{root}/{name}" for name in I.COLUMNS}
    faulty = _histories(spark, sf)

    def deliver(frames, model, date):
        raw.append_snapshot(last_of(frames[model], date).drop("partition_date"), paths[model], date)

    for date in I.SNAPSHOTS:
        clean = {f"raw_{name}": I.raw(spark, sf, name) for name in I.COLUMNS}
        job._all_at_once(lambda model: deliver(clean, model, date), list(paths))
        if date == I.LAST:
            deliver(faulty, "raw_crash", I.SNAPSHOTS[0])
            deliver(faulty, "raw_people", I.SNAPSHOTS[1])
        found = history.history_results(spark, paths, checks.SOURCE_CHECKS, f"{root}/counts")
    return history.result_rows(spark, found)


# --- models --------------------------------------------------------------------


@query("stage_crash", "select * from staging_crash")
def stage_crash(spark, sf):
    return staged(spark, sf, "crash")


@query("stage_people", "select * from staging_people")
def stage_people(spark, sf):
    return staged(spark, sf, "people")


@query("stage_vehicle", "select * from staging_vehicle")
def stage_vehicle(spark, sf):
    return staged(spark, sf, "vehicle")


@query("stage_ward", "select * from staging_ward")
def stage_ward(spark, sf):
    return as_wkt(staged(spark, sf, "ward"), "ward_geometry")


@query("stage_neighborhood", "select * from staging_neighborhood")
def stage_neighborhood(spark, sf):
    return as_wkt(staged(spark, sf, "neighborhood"), "neighborhood_geometry")


@query("dim_datetime", "select * from dim_datetime")
def dim_datetime(spark, sf):
    return one(spark, sf, "refined_dim_datetime")


@query("dim_location", "select * from dim_location")
def dim_location(spark, sf):
    return flat_point(one(spark, sf, "refined_dim_location"))


@query("refined_ward", "select * from refined_ward")
def refined_ward(spark, sf):
    return as_wkt(refined.ward(staged(spark, sf, "ward")), "ward_geometry")


@query("refined_neighborhood", "select * from refined_neighborhood")
def refined_neighborhood(spark, sf):
    hoods = refined.neighborhood(staged(spark, sf, "neighborhood"))
    return as_wkt(hoods, "neighborhood_geometry")


@query("dim_location_enriched", "select * from dim_location_enriched")
def dim_location_enriched(spark, sf):
    return flat_point(one(spark, sf, "refined_dim_location_enriched"))


@query("fact_crash", "select * from fact_crash")
def fact_crash(spark, sf):
    return one(spark, sf, "refined_fact_crash")


OVERLAP = {
    "places": "select location_hkey, longitude, latitude from dim_location_enriched"
    " union all select location_hkey, longitude, latitude from dim_location_enriched"
    " where ward_id % 2 = 0",
    "fanned": "select f.* from fact_crash f join staging_crash c on f.crash_id = c.crash_id"
    " left join places l on c.location_longitude = l.longitude"
    " and c.location_latitude = l.latitude",
}


@query("fact_crash_overlap", "select * from fanned", OVERLAP)
def fact_crash_overlap(spark, sf):
    """Every other ward has a second outline over it, so a crash there has two rows."""
    crash = staged(spark, sf, "crash")
    wards = refined.ward(staged(spark, sf, "ward"))
    second = wards.where("ward_id % 2 = 0").withColumns(
        {"ward_hkey": F.concat("ward_hkey", F.lit("-2")), "ward_id": F.col("ward_id") + 1_000_000}
    )
    hoods = refined.neighborhood(staged(spark, sf, "neighborhood"))
    places = refined.dim_location_enriched(
        refined.dim_location(crash), wards.unionByName(second), hoods, I.CELL
    )
    return refined.fact_crash(crash, locations=places)


@query("fact_vehicle", "select * from fact_vehicle")
def fact_vehicle(spark, sf):
    return one(spark, sf, "refined_fact_vehicle")


@query("fact_people", "select * from fact_people")
def fact_people(spark, sf):
    return one(spark, sf, "refined_fact_people")


def _register_mart(mart: str, source: str) -> None:
    shown = source.removeprefix("refined_")

    @query(f"mart_{mart}", f"select * from {shown}")
    def mart_query(spark, sf):
        frame = one(spark, sf, source)
        marts.publish_views({mart: frame}, "mart_")
        shown = spark.sql(f"select * from mart_{mart}")
        return flat_point(shown) if "location_point" in shown.columns else shown


for _mart, _source in marts.MARTS.items():
    _register_mart(_mart, _source)


@query(
    "mart_export",
    " union all by name ".join(
        f"select '{mart}' as mart, * from {source.removeprefix('refined_')}" for mart, source in marts.MARTS.items()
    ),
)
def mart_export(spark, sf):
    """All rows and columns of the five marts, read back from the exported files. A mart is
    exported before the next one is built from it, so that none is computed twice."""
    root = shared_dir(spark, "marts")
    names = {source: mart for mart, source in marts.MARTS.items()}

    def export(source: str, df: DataFrame) -> DataFrame:
        mart = names[source]
        return spark.read.parquet(marts.export({mart: df}, root)[mart])

    frames = marts.marts(refined_frames(spark, sf, *names, store=export))
    out = None
    for mart, rows in frames.items():
        rows = rows.withColumn("mart", F.lit(mart))
        rows = flat_point(rows) if "location_point" in rows.columns else rows
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


# --- reports -------------------------------------------------------------------

SUMS = (
    "cast(count(*) as bigint) as crash_count, cast(sum(f.total_injuries_number) as bigint)"
    " as injury_count, cast(sum(f.total_fatal_injuries_number) as bigint) as fatal_count"
)


@query(
    "report_trend",
    f"select d.year, d.month, {SUMS} from fact_crash f"
    " left join dim_datetime d on f.date_hkey = d.date_hkey group by 1, 2",
)
def report_trend(spark, sf):
    frames = refined_frames(spark, sf, "refined_dim_datetime")
    return reports.trend(frames["refined_fact_crash"], frames["refined_dim_datetime"])


@query(
    "report_rhythm",
    f"select d.day_of_week, d.hour, d.is_weekend, d.is_rush_hour, d.is_winter, {SUMS}"
    " from fact_crash f left join dim_datetime d on f.date_hkey = d.date_hkey"
    " group by 1, 2, 3, 4, 5",
)
def report_rhythm(spark, sf):
    frames = refined_frames(spark, sf, "refined_dim_datetime")
    return reports.rhythm(frames["refined_fact_crash"], frames["refined_dim_datetime"])


@query(
    "report_severity",
    f"select crash_severity_code, first_crash_type_code, {SUMS} from fact_crash f group by 1, 2",
)
def report_severity(spark, sf):
    return reports.severity(one(spark, sf, "refined_fact_crash"))


@query(
    "report_geography",
    f"select l.ward_id, l.neighborhood, {SUMS} from fact_crash f"
    " left join dim_location_enriched l on f.location_hkey = l.location_hkey group by 1, 2",
)
def report_geography(spark, sf):
    frames = refined_frames(spark, sf, "refined_dim_location_enriched")
    return reports.geography(frames["refined_fact_crash"], frames["refined_dim_location_enriched"])


@query(
    "report_cause_weather",
    "select primary_cause_explanation, weather_condition_code,"
    " cast(count(*) as bigint) as crash_count from fact_crash group by 1, 2",
)
def report_cause_weather(spark, sf):
    return reports.cause_weather(one(spark, sf, "refined_fact_crash"))


# --- the whole job -------------------------------------------------------------


def _job(spark, sf, dates: list[str] = [I.LAST]) -> job.Build:
    """Feeds as files, all written at once, then the batch job for each date."""
    root = shared_dir(spark, "warehouse")

    def write(feed: tuple[str, str | None]) -> str:
        name, date = feed
        if date is None:
            return I.write_geojson_feed(spark, sf, name, f"{root}/feeds/{name}")
        return I.write_csv_feed(spark, sf, name, f"{root}/feeds/{date}/{name}", date)

    wanted = [(n, d) for d in reversed(dates) for n in schemas.FEEDS] + [(n, None) for n in schemas.BOUNDARIES]
    paths = dict(zip(wanted, job._all_at_once(write, wanted)))
    for date in dates:
        build = job.run(
            spark,
            date,
            {name: path for (name, of), path in paths.items() if of in (date, None)},
            root,
            strict=False,
            multi_line_geojson=False,
            cell=I.CELL,
        )
    return build


@query("batch_job", "select * from fact_people")
def batch_job(spark, sf):
    """The people mart after the job for the last date has run from files."""
    return _job(spark, sf).marts["fact_people"]


RUNS = I.SNAPSHOTS[1:]


@query(
    "batch_job_two_dates",
    " union all by name ".join(
        f"select '{mart}' as mart, * from {rows}"
        for mart, rows in {
            "fact_crash": f"fact_crash_all_{len(RUNS)}",
            "fact_people": f"fact_people_all_{len(RUNS)}",
            "fact_vehicle": f"fact_vehicle_all_{len(RUNS)}",
            "dim_datetime": f"dim_datetime_{len(RUNS)}",
            "dim_location": "dim_location_enriched_all",
        }.items()
    ),
    O.accumulated(RUNS),
)
def batch_job_two_dates(spark, sf):
    """All rows and columns of the five marts after the job has run for two dates: corrected
    crashes keep their old rows, and so does everything that hangs on those."""
    out = None
    for mart, rows in _job(spark, sf, RUNS).marts.items():
        rows = rows.withColumn("mart", F.lit(mart))
        rows = flat_point(rows) if "location_point" in rows.columns else rows
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
