"""Column functions on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions import calendar as D
from snapledger.functions import cleanse as C
from snapledger.functions import geometry as G
from snapledger.functions.keys import location_key, packed_key, surrogate_key, unpacked_key
from snapledger.plans import refined, staging


def apply(spark, values, dtype, function):
    """function over one column, in input order"""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v")).alias("r")).collect()]


def test_yes_no(spark):
    got = apply(spark, ["Y", "y", "N", "n", "", "YES", None], "string", C.yes_no_to_boolean)
    assert got == [True, True, False, False, None, None, None]


def test_empty_to_null_keeps_blanks(spark):
    assert apply(spark, ["", " ", "a", None], "string", C.empty_to_null) == [None, " ", "a", None]


def test_sentinel(spark):
    got = apply(
        spark, ["Unknown", "UNKNOWN", "Ford", None], "string", lambda c: C.sentinel_to_null(c, "unknown")
    )
    assert got == [None, None, "Ford", None]


def test_road_defect_flag(spark):
    got = apply(
        spark,
        [None, "unknown", "No Defects", "RUT", ""],
        "string",
        lambda c: C.category_flag(c, refined.NO_ROAD_DEFECT),
    )
    assert got == [None, None, False, True, True]


def test_vehicle_defect_flag_is_inverted(spark):
    got = apply(
        spark,
        [None, "unknown", "NONE", "BRAKES"],
        "string",
        lambda c: C.category_flag(c, refined.NO_VEHICLE_DEFECT, clear_is=True),
    )
    assert got == [None, None, True, False]


def test_nanos_drop_digits_below_milliseconds(spark):
    got = apply(spark, [1690635600123456789, None], "bigint", C.nanos_to_timestamp)
    assert got == [dt.datetime(2023, 7, 29, 13, 0, 0, 123000), None]


def test_int_cast_rounds_half_away_from_zero(spark):
    got = apply(
        spark, [2.5, -2.5, 2.4, 3.5, None], "double", lambda c: C.to_bigint(c, T.DoubleType())
    )
    assert got == [3, -3, 2, 4, None]


def test_int_cast_of_bad_text_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, [""], "string", lambda c: C.to_bigint(c, T.StringType()))


def test_integer_division_truncates_toward_zero(spark):
    assert apply(spark, [-7, 7], "bigint", lambda c: F.call_function("div", c, F.lit(2))) == [-3, 3]


def test_week_starts_on_sunday(spark):
    days = ["2024-01-06", "2024-01-07", "2023-01-01"]
    got = apply(spark, days, "string", lambda c: D.week_sunday(c.cast("date")))
    assert got == [0, 1, 1]


def test_week_equals_the_standard_rule_on_ten_years(spark):
    days = spark.sql("select explode(sequence(date '2015-01-01', date '2025-12-31')) as d")
    for row in days.select("d", D.week_sunday(F.col("d")).alias("w")).collect():
        assert row.w == int(row.d.strftime("%U"))


def test_calendar_flags(spark):
    days = ["2024-01-06 07:00:00", "2024-07-07 10:00:00", "2024-01-08 18:59:59", None]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, t string")
    t = F.col("t").cast("timestamp")
    flags = [c.alias(n) for n, c in D.calendar_flags(t).items()]
    parts = D.date_parts(t)
    got = rows.orderBy("i").select(parts["day_of_week"].alias("dow"), *flags).collect()
    assert [tuple(r) for r in got] == [
        (7, True, True, True),
        (1, True, False, False),
        (2, False, True, True),
        (None, False, False, False),
    ]


def test_keys_of_null_and_empty_differ(spark):
    null_key, empty_key = apply(spark, [None, ""], "string", surrogate_key)
    # Fixed value: md5 of the text that stands for NULL.
    assert null_key == "f14cc5cdce0420f4a5a6b6d9d7b85f39"
    assert empty_key and empty_key != null_key


def test_negative_zero_is_the_same_place(spark):
    keys = apply(spark, [0.0, -0.0], "double", lambda c: location_key(c, c))
    assert keys[0] == keys[1]


TRIANGLE = '{"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}'
HOLE = (
    '{"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]],'
    " [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]]}"
)
TWO_PARTS = (
    '{"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]],'
    " [[[5, 5], [7, 5], [7, 7], [5, 7], [5, 5]]]]}"
)


def within(spark, polygon, points):
    rows = [(i, *(p or (None, None))) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "i int, x double, y double").orderBy("i")
    test = G.point_within(
        G.make_point(F.col("x"), F.col("y")), G.polygon_from_geojson(F.lit(polygon))
    )
    return [r[0] for r in df.select(test).collect()]


def test_boundary_points_are_not_within(spark):
    points = [(0.5, 0.25), (0.25, 0.5), (0.5, 0.5), (0.0, 0.0), (1.0, 0.5), None]
    assert within(spark, TRIANGLE, points) == [True, False, False, False, False, None]


def test_holes_and_parts(spark):
    points = [(0.5, 0.5), (2.0, 2.0), (1.0, 2.0), (3.5, 2.0)]
    assert within(spark, HOLE, points) == [True, False, False, True]
    points = [(6.0, 6.0), (0.75, 0.25), (3.0, 3.0), (5.0, 6.0)]
    assert within(spark, TWO_PARTS, points) == [True, True, False, False]


def test_point_needs_both_coordinates(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, None)], "x double, y double")
    got = df.select(G.make_point(F.col("x"), F.col("y")).alias("p")).collect()
    assert [r.p is not None for r in got] == [True, False, False]


def test_wkt(spark):
    got = apply(
        spark, [HOLE, TWO_PARTS, None], "string", lambda c: G.polygon_wkt(G.polygon_from_geojson(c))
    )
    assert got == [
        "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))",
        "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)), ((5 5, 7 5, 7 7, 5 7, 5 5)))",
        None,
    ]


BAD_GEOMETRIES = [
    '{"type": "Point", "coordinates": [1, 2]}',
    '{"type": "Polygon", "coordinates": [[1, 2], [3, 4]]}',
    '{"type": "Polygon", "coordinates": [[["a", 2], [3, 4]]]}',
    '{"type": "Polygon"}',
    "{oops",
    "null",
]


def test_other_geometries_are_null(spark):
    assert apply(spark, BAD_GEOMETRIES, "string", G.polygon_from_geojson) == [None] * 6


@pytest.mark.parametrize("text", BAD_GEOMETRIES)
def test_strict_parsing_raises(spark, text):
    with pytest.raises(Exception, match="no polygon in GeoJSON"):
        apply(spark, [text], "string", lambda c: G.polygon_from_geojson(c, strict=True))


def test_morton_key(spark):
    from snapledger.functions.geometry import morton_key

    spots = [(-180.0, -90.0), (180.0, 90.0), (0.0, 0.0), (-87.65, 41.88), (-87.65, 41.87), (200.0, -95.0), (None, 1.0)]
    df = spark.createDataFrame(spots, "x double, y double").select("x", "y", morton_key(F.col("x"), F.col("y")).alias("k"))

    def plain(x, y):
        if x is None or y is None:
            return None
        a, b = (int(min(1.0, max(0.0, (v + h) / (2 * h))) * ((1 << 26) - 1)) for v, h in ((x, 180.0), (y, 90.0)))
        return sum((a >> i & 1) << (2 * i) | (b >> i & 1) << (2 * i + 1) for i in range(26))

    assert [r.k for r in df.collect()] == [plain(*s) for s in spots]


def test_packed_keys_are_read_back(spark):
    digest = "0123456789abcdef" * 2
    texts = [digest, digest.upper(), digest + "\n", digest[:16], "k1", "", "é" * 8, " " * 17, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", packed_key(F.col("t")).alias("p")).select("i", F.length("p").alias("n"), unpacked_key(F.col("p")).alias("t"))
    found = {r.i: (r.n, r.t) for r in got.collect()}
    assert [found[i][1] for i in range(len(texts))] == texts
    assert [i for i in found if found[i][0] == 16] == [0]


def test_facts_with_any_keys(spark):
    """Keys that are no digests, repeated parents and missing keys go through the lookups."""
    people = spark.createDataFrame(
        [("p1", "c1", 1), ("p2", "c1", None), ("p3", None, 2), ("p4", None, None), ("p5", "c9", 9)],
        "person_id string, crash_id string, vehicle_id int",
    ).withColumns({"driver_vision": F.lit("trees"), "driver_physical_condition": F.lit("normal")})
    crashes = spark.createDataFrame([("c1", "x"), ("c1", "y"), (None, "z")], "crash_id string, crash_hkey string")
    vehicles = spark.createDataFrame([(1, "v"), (2, None), (None, "w")], "vehicle_id int, vehicle_hkey string")
    got = refined.fact_people(people, crashes, vehicles)
    assert got.columns == [
        "person_hkey", "person_id", "crash_id", "vehicle_id", "crash_hkey", "vehicle_hkey",
        "is_vision_obscured", "is_physically_impaired",
    ]
    rows = {(r.person_id, r.crash_hkey, r.vehicle_hkey) for r in got.collect()}
    assert rows == {
        ("p1", "x", "v"), ("p1", "y", "v"), ("p2", "x", None), ("p2", "y", None), ("p3", None, None),
        ("p4", None, None), ("p5", None, None),
    }
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in text and "driver_vision" not in text.split("Join")[0]


def test_vehicle_flag_travels_instead_of_the_text(spark):
    names = [t for _, t, _ in staging.VEHICLE if t not in ("crash_id", "crash_vehicle_id", "vehicle_defect", "partition_date")]
    vehicles = spark.createDataFrame(
        [("v1", "c1", "None"), ("v2", "c1", "BRAKES"), ("v3", None, None)],
        "crash_vehicle_id string, crash_id string, vehicle_defect string",
    ).withColumns({**{n: F.lit(None).cast("string") for n in names}, "partition_date": F.lit(None).cast("date")})
    crashes = spark.createDataFrame([("c1", "x")], "crash_id string, crash_hkey string")
    got = refined.fact_vehicle(vehicles, crashes)
    assert {(r.crash_vehicle_id, r.crash_hkey, r.is_vehicle_defect) for r in got.collect()} == {
        ("v1", "x", True), ("v2", "x", False), ("v3", None, None)
    }
    assert "vehicle_defect#" not in got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0].replace("is_vehicle_defect#", "")


def test_locations_with_any_keys(spark):
    """Keys of places are digests in half the bytes while they travel, any other text is kept."""
    keys = ["0123456789abcdef" * 2, "k1", "", None]
    places = spark.createDataFrame(
        [(k, {"lon": 0.5, "lat": 0.5}, 0.5, 0.5) for k in keys],
        "location_hkey string, location_point struct<lon: double, lat: double>, longitude double, latitude double",
    )
    ring = '{"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}'
    shape = G.polygon_from_geojson(F.lit(ring), strict=True)
    wards = spark.range(1).select(F.lit("w").alias("ward_hkey"), F.lit(1).alias("ward_id"), shape.alias("ward_geometry"))
    hoods = spark.range(1).select(
        F.lit("n").alias("neighborhood_hkey"), F.lit("N").alias("neighborhood"), shape.alias("neighborhood_geometry")
    )
    got = refined.dim_location_enriched(places, wards, hoods, 0.25)
    found = {(r.location_hkey, r.ward_hkey, r.neighborhood_hkey, r.ward_id, r.neighborhood) for r in got.collect()}
    assert found == {(k, "w", "n", 1, "N") for k in keys}
    assert "unhex" in got._jdf.queryExecution().optimizedPlan().toString()
