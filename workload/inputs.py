"""Look-alike feeds derived from the given tables.

orders become crashes and vehicles, lineitem becomes people, supplier becomes wards
and neighborhoods. Every feed grows with its table. The column expressions are
plain SQL that Spark and DuckDB both understand; only the rows they run on are put
together in each dialect (``spark_*`` here, ``BASES`` for the SQL checks).

A snapshot holds what had happened by its date, so three snapshots of growing size
come out, and the last one holds every row. Some values change between snapshots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a feed file at most.
FEED_FILE_ROWS = 250_000
# At this level feeds take about a tenth more than at the usual one, and little over half the time.
FEED_LEVEL = {"compression": "gzip", "zlib.compress.level": "THREE"}

SNAPSHOTS = ["1998-01-05", "2000-01-03", "2002-01-07"]
LAST = SNAPSHOTS[-1]


def _pick(expr: str, *values: str | None) -> str:
    """case expression choosing a value by ``expr`` modulo the number of values"""
    arms = [
        f"when {i} then " + ("null" if v is None else f"'{v}'") for i, v in enumerate(values)
    ]
    return f"case ({expr}) % {len(values)} {' '.join(arms)} end"


CRASH = {
    "crash_record_id": "concat('C', cast(o_orderkey as string))",
    "crash_date": "case when o_orderkey % 101 = 0 then null else (o_day * 86400"
    " + (o_orderkey % 1440) * 60) * 1000000000 + (o_orderkey % 7) * 1000000 + 456 end",
    "posted_speed_limit": "20 + (o_orderkey % 6) * 5",
    "traffic_control_device": _pick("o_orderkey", "NO CONTROLS", "TRAFFIC SIGNAL", "STOP SIGN"),
    "weather_condition": _pick("o_custkey", "CLEAR", "RAIN", "SNOW", "UNKNOWN", ""),
    "lighting_condition": _pick("o_orderkey", "DAYLIGHT", "DARKNESS", "DUSK", "DAWN"),
    "first_crash_type": "case o_orderstatus when 'F' then 'REAR END' when 'O' then 'TURNING'"
    " else 'ANGLE' end",
    "trafficway_type": _pick("o_custkey", "NOT DIVIDED", "ONE-WAY", "PARKING LOT"),
    "roadway_surface_cond": _pick("o_custkey", "DRY", "WET", "SNOW OR SLUSH", None),
    "road_defect": _pick("o_orderkey + snap_no", "NO DEFECTS", "Unknown", "RUT, HOLES", "", None),
    "crash_type": "case when o_orderpriority in ('1-URGENT', '2-HIGH') then"
    " 'INJURY AND / OR TOW DUE TO CRASH' else 'NO INJURY / DRIVE AWAY' end",
    "intersection_related_i": _pick("o_custkey", "Y", "N", ""),
    "hit_and_run_i": _pick("o_orderkey", "Y", "N", "", "y", None, "n", "YES"),
    "damage": _pick("o_orderkey", "$500 OR LESS", "$501 - $1,500", "OVER $1,500"),
    "prim_contributory_cause": _pick(
        "o_orderkey + o_custkey",
        "FOLLOWING TOO CLOSELY",
        'SO-CALLED "WEATHER"',
        "UNABLE TO DETERMINE",
        "IMPROPER TURNING/NO SIGNAL",
    ),
    "street_no": "o_custkey * 10 + 5",
    "street_direction": _pick("o_custkey", "N", "S", "E", "W"),
    "street_name": "concat('STREET, ', cast(o_custkey % 200 as string))",
    "dooring_i": _pick("o_custkey + 1", "Y", "", None, "N"),
    "work_zone_i": _pick("o_orderkey", "", "Y", "N"),
    "workers_present_i": _pick("o_orderkey", None, "n", "y", ""),
    "injuries_total": "o_orderkey % 4",
    "injuries_fatal": "cast(case when o_orderkey % 50 = 0 then 1 else 0 end as bigint)",
    "latitude": "case when o_custkey % 97 = 0 then null else"
    " cast(o_custkey as double) / 150 + cast(o_orderkey % 4 as double) / 64 end",
    "longitude": "case when o_custkey % 97 = 0 or o_custkey % 89 = 0 then null else"
    " (cast(o_custkey % 51 as double) + cast((o_orderkey +"
    " case when o_orderkey % 10 = 0 then snap_no else 0 end) % 8 as double) / 8) / 5 end",
    "partition_date": "partition_date",
}

VEHICLE = {
    "crash_unit_id": "o_orderkey * 2 + u",
    "crash_record_id": "concat('C', cast(o_orderkey as string))",
    "unit_type": _pick("o_orderkey", "PEDESTRIAN", "", "DRIVER", "PARKED"),
    "num_passengers": "case when o_orderkey % 3 = 0 then null else o_orderkey % 5 end",
    "vehicle_id": "case when (o_orderkey + u) % 9 = 0 then null else o_orderkey * 2 + u end",
    "make": _pick("o_orderkey + u", "UNKNOWN", "Ford", "", "Unknown", "HONDA"),
    "model": _pick("o_custkey + u", "unknown", "Civic", None, ""),
    "lic_plate_state": _pick("o_orderkey", "il", "", "IN", None),
    "vehicle_year": "1990 + (o_custkey + u) % 30",
    "vehicle_defect": _pick("o_orderkey + u", "NONE", "UNKNOWN", "BRAKES", "", None),
    "vehicle_type": _pick("o_custkey", "PASSENGER", "TRUCK", ""),
    "vehicle_use": _pick("o_orderkey", "UNKNOWN/NA", "PERSONAL", None, ""),
    "travel_direction": _pick("o_orderkey + u", "n", "S", "", "unknown"),
    "maneuver": _pick("o_custkey + u", "STRAIGHT AHEAD", "Unknown/NA", "", None, "PARKED"),
    "exceed_speed_limit_i": _pick("o_orderkey + u", "Y", "N", "", None),
    "partition_date": "partition_date",
}

PEOPLE = {
    "person_id": "concat('P', cast(l_orderkey as string), '-', cast(l_linenumber as string), '-',"
    " cast(l_partkey as string), '-', cast(l_suppkey as string), '-',"
    " cast(cast(l_shipdate as date) as string))",
    "person_type": _pick("l_linenumber", "DRIVER", "PASSENGER", "PEDESTRIAN", ""),
    "crash_record_id": "concat(case when l_partkey % 50 = 0 then 'X' else 'C' end,"
    " cast(l_orderkey as string))",
    "vehicle_id": "case when l_linenumber > 5 then null else l_orderkey * 2 + l_linenumber % 2 end",
    "sex": _pick("l_partkey", "m", "F", "", "X"),
    "age": "case when l_suppkey % 11 = 0 then null else (l_partkey + l_suppkey) % 90 end",
    "driver_vision": _pick("l_suppkey", "NOT OBSCURED", "UNKNOWN", "TREES", ""),
    "drivers_license_state": _pick("l_partkey", "il", "WI", "", None, "xx"),
    "physical_condition": _pick("l_suppkey", "NORMAL", "unknown", "FATIGUED", None),
    "bac_result": _pick("l_linenumber", "TEST NOT OFFERED", "", "TEST TAKEN"),
    "bac_result_value": "case when l_linenumber % 3 = 2 then cast(l_partkey % 40 as double) / 100"
    " else null end",
    "cell_phone_use": _pick("l_linenumber", "Y", "n", "", None),
    "partition_date": "partition_date",
}


def _shape(kind: str, coordinates: str) -> str:
    return f'{{"type": "{kind}", "coordinates": {coordinates}}}'


# Unit square shapes; @x, @X, @y, @Y are the integer bounds of the square.
_SQUARE = "[[@x.0, @y.0], [@X.0, @y.0], [@X.0, @Y.0], [@x.0, @Y.0], [@x.0, @y.0]]"
_HOLE = "[[@x.25, @y.25], [@x.75, @y.25], [@x.75, @y.75], [@x.25, @y.75], [@x.25, @y.25]]"
_STRIP_1 = "[[@x.0, @y.0], [@x.5, @y.0], [@x.5, @Y.0], [@x.0, @Y.0], [@x.0, @y.0]]"
_STRIP_2 = "[[@x.625, @y.0], [@X.0, @y.0], [@X.0, @Y.0], [@x.625, @Y.0], [@x.625, @y.0]]"
_CORNER = (
    "[[@x.0, @y.0], [@X.0, @y.0], [@X.0, @y.5], [@x.5, @y.5], [@x.5, @Y.0], [@x.0, @Y.0],"
    " [@x.0, @y.0]]"
)
WARD_SHAPES = [
    _shape("Polygon", f"[{_SQUARE}, {_HOLE}]"),
    _shape("MultiPolygon", f"[[{_STRIP_1}], [{_STRIP_2}]]"),
    _shape("Polygon", f"[{_SQUARE}]"),
    _shape("Polygon", f"[{_CORNER}]"),
]

# 2 x 2 blocks; @x, @m, @X and @y, @n, @Y are low, middle and high.
_DIAMOND = "[[@m.0, @y.0], [@X.0, @n.0], [@m.0, @Y.0], [@x.0, @n.0], [@m.0, @y.0]]"
_BLOCK = "[[@x.0, @y.0], [@X.0, @y.0], [@X.0, @Y.0], [@x.0, @Y.0], [@x.0, @y.0]]"
_LOW_CORNER = "[[@x.0, @y.0], [@m.0, @y.0], [@x.0, @n.0], [@x.0, @y.0]]"
_HIGH_CORNER = "[[@X.0, @Y.0], [@m.0, @Y.0], [@X.0, @n.0], [@X.0, @Y.0]]"
AREA_SHAPES = [
    _shape("Polygon", f"[{_DIAMOND}]"),
    _shape("MultiPolygon", f"[[{_LOW_CORNER}], [{_HIGH_CORNER}]]"),
    _shape("Polygon", f"[{_BLOCK}, {_DIAMOND}]"),
]


def _placed(number: str, shapes: list[str], tokens: dict[str, str]) -> str:
    text = _pick(number, *shapes)
    for token, value in tokens.items():
        text = f"replace({text}, '{token}', cast(cast({value} as bigint) as string))"
    return text


WARD = {
    "globalid": "concat('{W-', cast(s_suppkey as string), '}')",
    "ward": "cast(s_suppkey + 1 as string)",
    "ward_id": "cast(s_suppkey + 1 as string)",
    "objectid": "cast(s_suppkey + 1000 as string)",
    "edit_date": "concat('2022-0', cast(1 + s_suppkey % 9 as string), '-15T08:30:00.250')",
    "st_length_": "concat(cast(4 + s_suppkey % 4 as string), '.5')",
    "st_area_sh": "concat('0.', cast(s_suppkey % 9 + 1 as string))",
    "geometry": _placed(
        "s_suppkey",
        WARD_SHAPES,
        {
            "@x": "s_suppkey % 10",
            "@X": "s_suppkey % 10 + 1",
            "@y": "floor(s_suppkey / 10)",
            "@Y": "floor(s_suppkey / 10) + 1",
        },
    ),
    "partition_date": f"date '{LAST}'",
}

NEIGHBORHOOD = {
    "pri_neigh": "concat('Area ', cast(area_no as string))",
    "sec_neigh": "concat('AREA, ', cast(area_no as string))",
    "shape_len": "concat(cast(area_no as string), '.25')",
    "shape_area": "cast(area_no % 7 + 1 as string)",
    "geometry": _placed(
        "area_no",
        AREA_SHAPES,
        {
            "@x": "(area_no % 5) * 2",
            "@m": "(area_no % 5) * 2 + 1",
            "@X": "(area_no % 5) * 2 + 2",
            "@y": "floor(area_no / 5) * 2",
            "@n": "floor(area_no / 5) * 2 + 1",
            "@Y": "floor(area_no / 5) * 2 + 2",
        },
    ),
    "partition_date": f"date '{LAST}'",
}

# Grid size that suits the unit squares above.
CELL = 0.25

COLUMNS = {
    "crash": CRASH,
    "vehicle": VEHICLE,
    "people": PEOPLE,
    "ward": WARD,
    "neighborhood": NEIGHBORHOOD,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _per_snapshot(df: DataFrame, happened: str) -> DataFrame:
    """Each row once per snapshot that is not older than the row."""
    snapshots = ", ".join(
        f"named_struct('snap_no', {i}, 'partition_date', date '{d}')" for i, d in enumerate(SNAPSHOTS)
    )
    return df.selectExpr("*", f"inline(array({snapshots}))").where(
        f"cast({happened} as date) <= partition_date"
    )


def spark_base(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """The rows the column expressions of a dataset run on."""
    if dataset in ("crash", "vehicle"):
        rows = _per_snapshot(table(spark, sf_dir, "orders"), "o_orderdate")
        day = "cast(unix_date(cast(o_orderdate as date)) as bigint) as o_day"
        if dataset == "crash":
            return rows.selectExpr("*", day)
        return rows.selectExpr("*", day, "explode(array(0, 1)) as u")
    if dataset == "people":
        return _per_snapshot(table(spark, sf_dir, "lineitem"), "l_shipdate")
    suppliers = table(spark, sf_dir, "supplier")
    if dataset == "ward":
        return suppliers
    return suppliers.selectExpr("cast(floor(s_suppkey / 4) as bigint) as area_no").distinct()


_SNAPSHOT_ROWS = ", ".join(f"({i}, date '{d}')" for i, d in enumerate(SNAPSHOTS))
_ORDERS = (
    "select o.*, s.*, cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as bigint)"
    f" as o_day from orders o join (values {_SNAPSHOT_ROWS}) s(snap_no, partition_date)"
    " on cast(o_orderdate as date) <= s.partition_date"
)
BASES = {
    "crash": _ORDERS,
    "vehicle": f"select b.*, u from ({_ORDERS}) b, unnest([0, 1]) t(u)",
    "people": f"select l.*, s.* from lineitem l join (values {_SNAPSHOT_ROWS}) s(snap_no,"
    " partition_date) on cast(l_shipdate as date) <= s.partition_date",
    "ward": "select * from supplier",
    "neighborhood": "select distinct cast(floor(s_suppkey / 4) as bigint) as area_no from supplier",
}


def raw(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """A raw table with all its snapshots."""
    base = spark_base(spark, sf_dir, dataset)
    return base.selectExpr(*[f"{e} as {n}" for n, e in COLUMNS[dataset].items()])


def raw_sql(dataset: str) -> str:
    """The same raw table for DuckDB."""
    columns = ", ".join(f"{e} as {n}" for n, e in COLUMNS[dataset].items())
    return f"select {columns} from ({BASES[dataset]}) base"


def write_csv_feed(
    spark: SparkSession, sf_dir: str, dataset: str, path: str, snapshot: str = LAST
) -> str:
    """One snapshot of an incident feed as CSV files, times as ISO text."""
    rows = raw(spark, sf_dir, dataset).where(F.col("partition_date") == F.lit(snapshot).cast("date"))
    if dataset == "crash":
        time = F.timestamp_millis(F.call_function("div", F.col("crash_date"), F.lit(1_000_000)))
        rows = rows.withColumn("crash_date", F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    # A compressed file is read by one task, so files are bounded by rows.
    options = {"header": "true", "escape": '"', "maxRecordsPerFile": FEED_FILE_ROWS, **FEED_LEVEL}
    rows.drop("partition_date").write.options(**options).csv(path)
    return path


def write_geojson_feed(spark: SparkSession, sf_dir: str, dataset: str, path: str) -> str:
    """A boundary set as feature collections, one per line and at most 50 features
    each, so that no line grows with the data."""
    number = {"ward": "s_suppkey", "neighborhood": "area_no"}[dataset]
    columns = {n: F.expr(e) for n, e in COLUMNS[dataset].items() if n != "partition_date"}
    properties = F.to_json(F.struct(*[c.alias(n) for n, c in columns.items() if n != "geometry"]))
    feature = F.concat(
        F.lit('{"type": "Feature", "properties": '),
        properties,
        F.lit(', "geometry": '),
        columns["geometry"],
        F.lit("}"),
    )
    lines = (
        spark_base(spark, sf_dir, dataset)
        .groupBy(F.floor(F.col(number) / 50).alias("line"))
        .agg(F.collect_list(feature).alias("features"))
        .select(
            F.concat(
                F.lit('{"type": "FeatureCollection", "features": ['),
                F.array_join("features", ", "),
                F.lit("]}"),
            ).alias("value")
        )
    )
    lines.write.text(path)
    return path


def write_geojson_documents(spark: SparkSession, sf_dir: str, dataset: str, path: str) -> str:
    """The same collections as documents of many lines, one per file."""
    lines = write_geojson_feed(spark, sf_dir, dataset, f"{path}-lines")
    broken = F.regexp_replace(F.regexp_replace("value", r", \{\"type\": \"Feature\"", ',\n  {\n    "type": "Feature"'), r"\]\}$", "\n]\n}\n")
    documents = spark.read.text(lines).select(broken.alias("value"), F.xxhash64("value").alias("document"))
    documents.repartition("document").write.partitionBy("document").text(path)
    return path
