"""DataFrame operators on small frames, and the plans they lead to."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from snapledger.functions import geometry as G
from snapledger.operators import joins, quality, snapshot, spatial, upsert


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def dated(spark, values):
    return spark.createDataFrame(values, "k string, d string").select(
        "k", F.col("d").cast("date").alias("partition_date")
    )


# --- snapshots -----------------------------------------------------------------


def test_latest_snapshot_ignores_undated_rows(spark):
    df = dated(spark, [("a", "2024-01-01"), ("b", "2024-01-08"), ("c", None)])
    assert [r.k for r in snapshot.latest_snapshot(df).collect()] == ["b"]


def test_latest_snapshot_of_nothing(spark):
    assert snapshot.latest_snapshot(dated(spark, [])).count() == 0
    assert snapshot.latest_snapshot(dated(spark, [("a", None)])).count() == 0


def test_as_of(spark):
    df = dated(spark, [("a", "2024-01-01"), ("b", "2024-01-08"), ("c", "2024-01-15")])
    assert [r.k for r in snapshot.snapshot_as_of(df, "2024-01-10").collect()] == ["b"]
    assert snapshot.snapshot_as_of(df, "2023-01-10").count() == 0


def test_stamp_keeps_existing_dates(spark):
    df = dated(spark, [("a", "2024-01-01"), ("b", None)])
    got = {r.k: str(r.partition_date) for r in snapshot.stamp_snapshot(df, "2024-02-01").collect()}
    assert got == {"a": "2024-01-01", "b": "2024-02-01"}
    assert snapshot.ensure_column(df).columns == df.columns


def test_history_and_versions(spark):
    df = spark.createDataFrame(
        [("a", 1, "2024-01-01"), ("a", 1, "2024-01-08"), ("a", 2, "2024-01-15"), ("b", 1, "2024-01-15"),
         (None, 1, "2024-01-15")],
        "k string, v int, d string",
    ).withColumn("partition_date", F.col("d").cast("date"))
    history = {str(r[0]): (r.row_count, r.key_count) for r in snapshot.snapshot_history(df, "k").collect()}
    assert history == {"2024-01-01": (1, 1), "2024-01-08": (1, 1), "2024-01-15": (3, 2)}
    versions = {r.k: r for r in snapshot.record_versions(df, "k", ["v"]).collect()}
    a = versions["a"]
    assert (a.snapshot_count, a.version_count, str(a.first_snapshot), str(a.last_snapshot)) == (
        3, 2, "2024-01-01", "2024-01-15",
    )
    moved = spark.createDataFrame(
        [("a", None, 1.0, "2024-01-01"), ("a", 1.0, None, "2024-01-08")],
        "k string, x double, y double, partition_date string",
    )
    found = snapshot.record_versions(moved, "k", ["x", "y"]).first()
    assert (found.snapshot_count, found.version_count) == (2, 2)
    trail = snapshot.versions_of(df, F.col("k") == "a").collect()
    assert [r.v for r in trail] == [1, 1, 2]


def test_record_intervals(spark):
    """A, B, A; a record that vanishes and returns; NULLs and repeated rows."""
    values = [
        ("r", "A", 1), ("r", "B", 2), ("r", "A", 3), ("r", "A", 4),
        ("s", "A", 1), ("s", "A", 2), ("s", "A", 4),
        ("t", None, 2), ("t", None, 3), (None, "N", 4),
        ("u", "A", 3), ("u", "A", 3), ("u", "B", 3),
    ]
    day = lambda n: None if n is None else f"2024-01-{7 * n + 1:02d}"
    df = spark.createDataFrame([(k, v, day(n)) for k, v, n in values], "k string, v string, d string").select(
        "k", "v", F.col("d").cast("date").alias("partition_date")
    )
    undated = df.limit(1).withColumn("partition_date", F.lit(None).cast("date"))
    got = snapshot.record_intervals(df.unionByName(undated), "k", ["v"])
    assert got.columns == ["k", "v", "valid_from", "valid_to", "snapshot_count", "next_snapshot"]
    want = [
        ("r", "A", 1, 1, 1, 2), ("r", "B", 2, 2, 1, 3), ("r", "A", 3, 4, 2, None),
        ("s", "A", 1, 2, 2, 3), ("s", "A", 4, 4, 1, None),
        ("t", None, 2, 3, 2, 4), (None, "N", 4, 4, 1, None),
        ("u", "A", 3, 3, 1, 4), ("u", "B", 3, 3, 1, 4),
    ]
    found = sorted([(r[0], r[1], *[x and str(x) for x in (r[2], r[3])], r[4], r[5] and str(r[5])) for r in got.collect()], key=repr)
    assert found == sorted([(k, v, day(a), day(b), n, day(c)) for k, v, a, b, n, c in want], key=repr)
    assert snapshot.record_intervals(df.limit(0), "k", ["v"]).count() == 0


# --- joins ---------------------------------------------------------------------


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_left_join_keeps_all_and_matches_no_nulls(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        left = spark.createDataFrame(
            [(1, "x"), (2, "y"), (3, None), (4, None), (5, "z")], "id int, k string"
        )
        right = spark.createDataFrame([("x", 10), ("x", 11), (None, 12), ("y", 13)], "k string, v int")
        for spread in (None, "id"):
            got = joins.left_join(left, right, {"k": "k"}, {"w": "v"}, spread_by=spread)
            assert got.columns == ["id", "k", "w"]
            assert rows(got) == sorted(
                [(1, "x", 10), (1, "x", 11), (2, "y", 13), (3, None, None), (4, None, None), (5, "z", None)],
                key=repr,
            )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_parent_table_is_not_broadcast_on_an_estimate(spark):
    left = spark.range(100).select("id", F.col("id").alias("k"))
    right = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    joined = joins.left_join(left, right, {"k": "k"}, {"v": "v"}, spread_by="id")
    assert joined.where("v = 1").count() == 50
    assert "BroadcastHashJoin" not in plan(joined)


def test_location_row_without_coordinates_never_matches(spark):
    crash = spark.createDataFrame([(1, None, None), (2, 1.0, 2.0)], "id int, x double, y double")
    dim = spark.createDataFrame([(None, None, "n"), (1.0, 2.0, "p")], "x double, y double, h string")
    got = joins.left_join(crash, dim, {"x": "x", "y": "y"}, {"h": "h"}, spread_by="id")
    assert {r.id: r.h for r in got.collect()} == {1: None, 2: "p"}


def _no_broadcast(spark, extra=None):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", **(extra or {})}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def test_rows_without_key_are_spread_over_partitions(spark):
    conf = _no_broadcast(spark, {"spark.sql.adaptive.enabled": "false"})
    try:
        left = spark.range(4000).select("id", F.lit(None).cast("string").alias("k"))
        right = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
        joined = joins.left_join(left, right, {"k": "k"}, {"v": "v"}, spread_by="id")
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and len(sizes) == 8 and max(sizes) < 1000
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_hot_key_partition_is_split(spark):
    """A third of the rows share one key: adaptive execution splits that partition."""
    conf = _no_broadcast(
        spark,
        {
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        },
    )
    try:
        left = spark.range(0, 60000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
        )
        right = left.where("id = 0 or k <> 'hot'").select("k", F.length("k").alias("v"))
        joined = joins.left_join(left, right, {"k": "k"}, {"v": "v"}, spread_by="id")
        assert len(joined.collect()) == 60000
        assert "skew=true" in plan(joined).split("Initial Plan")[0]
    finally:
        for k in conf:
            spark.conf.unset(k)


@pytest.mark.parametrize("pieces", [1, 8])
def test_split_join_equals_left_join(spark, pieces):
    left = spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('k', id % 40) end as k", "id % 2 as j"
    )
    right = spark.createDataFrame(
        [("hot", 0, 1), ("hot", 0, 2), ("hot", 1, 3), ("k1", 1, 4), (None, 0, 5), ("k2", None, 6)], "k string, j bigint, v int"
    )
    on = {"k": "k", "j": "j"}
    want = joins.left_join(left, right, on, {"w": "v"})
    got = joins.split_left_join(left, right, on, {"w": "v"}, "id", pieces)
    assert got.columns == want.columns and rows(got) == rows(want)
    nothing = joins.split_left_join(left.limit(0), right, on, {"w": "v"}, "id")
    assert nothing.count() == 0
    alone = joins.split_left_join(left, right.limit(0), on, {"w": "v"}, "id", pieces)
    assert alone.where("w is null").count() == 3000


def test_split_join_deals_hot_keys_of_an_aggregate(spark):
    """A time and a place with 30 % of the rows each: no task has over three times the rows
    of the median one, and the right side is not stored."""
    conf = _no_broadcast(spark, {"spark.sql.adaptive.enabled": "false"})
    try:
        left = spark.range(0, 80_000, 1, 8).selectExpr(
            "id", "case when id % 10 < 3 then -1 when id % 10 < 6 then -2 else id end as k"
        )
        right = left.groupBy("k").agg(F.count("*").alias("n"))
        joined = joins.split_left_join(left, right, {"k": "k"}, {"n": "n"}, "id", 8)

        def per_task(df):
            return sorted(r[1] for r in df.groupBy(F.spark_partition_id()).agg(F.count("n")).collect())

        sizes = per_task(joined)
        assert sum(sizes) == 80_000 and sizes[-1] <= 3 * sizes[len(sizes) // 2], sizes
        plain = joins.left_join(left, right, {"k": "k"}, {"n": "n"}, spread_by="id")
        assert per_task(plain)[-1] > 24_000
        assert {r.n for r in joined.where("k < 0").collect()} == {24_000}
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_hot_keys_are_few_and_complete(spark):
    df = spark.range(0, 50_000, 1, 8).selectExpr("case when id % 4 = 0 then null when id % 4 = 1 then 7 else id end as k")
    found = joins.hot_keys(df, ["k"], 8).collect()
    hot = spark.sql("select xxhash64(7L)").first()[0]
    assert {r._hot: r._pieces for r in found}[hot] == 6 and len(found) <= joins.HOT_KEYS


def test_missing_parent(spark):
    child = spark.createDataFrame(
        [(1, "a", "s1"), (2, None, "s1"), (3, "b", "s1"), (4, "a", "s2")], "id int, k string, s string"
    )
    parent = spark.createDataFrame([("a", "s1")], "p string, s string")
    assert [r.id for r in joins.missing_parent(child, parent, "k", "p").collect()] == [3]
    within = joins.missing_parent(child, parent, "k", "p", within="s")
    assert sorted(r.id for r in within.collect()) == [3, 4]
    assert joins.count_missing_parent(child, parent, "k", "p").first().n == 1
    assert joins.count_missing_parent(child, parent, "k", "p", "s").first().n == 2
    assert joins.count_missing_parent(child.where("id = 2"), parent, "k", "p").first().n == 0


def test_people_fact_with_hot_and_missing_keys(spark):
    """A third of the people in one crash, a third without a vehicle."""
    from snapledger.plans import refined, staging

    conf = _no_broadcast(
        spark,
        {
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        },
    )
    try:
        n = 30000
        texts = [t for _, t, kind in staging.PEOPLE if kind in ("text", "upper_text")]
        people = spark.range(n).select(
            F.col("id").cast("string").alias("person_id"),
            F.expr("if(id % 3 = 0, 'c0', concat('c', id % 1500))").alias("crash_id"),
            F.expr("if(id % 3 = 1, null, id % 4000)").alias("vehicle_id"),
            *[F.lit("x").alias(t) for t in texts if t not in ("person_id", "crash_id")],
        )
        crashes = spark.range(1000).select(
            F.expr("concat('c', id)").alias("crash_id"), F.expr("concat('h', id)").alias("crash_hkey")
        )
        vehicles = spark.range(2000).select(
            F.col("id").alias("vehicle_id"), F.expr("concat('v', id)").alias("vehicle_hkey")
        )
        got = refined.fact_people(people, crashes, vehicles)
        found = {r.person_id: (r.crash_hkey, r.vehicle_hkey) for r in got.collect()}
        for i in range(n):
            crash = 0 if i % 3 == 0 else i % 1500
            crash_key = f"h{crash}" if crash < 1000 else None
            vehicle_key = f"v{i % 4000}" if i % 3 != 1 and i % 4000 < 2000 else None
            assert found[str(i)] == (crash_key, vehicle_key)
        assert len(found) == got.count() == n
        assert "skew=true" in plan(got)
    finally:
        for k in conf:
            spark.conf.unset(k)


# --- spatial -------------------------------------------------------------------


def polygon_text(ring):
    ring = [*ring, ring[0]]
    return '{"type": "Polygon", "coordinates": [[' + ", ".join(f"[{x}, {y}]" for x, y in ring) + "]]}"


def star(random_, cx, cy):
    """A spiky ring around a centre, far from convex"""
    import math

    corners = random_.randint(5, 14)
    return [
        (
            round(cx + math.cos(2 * math.pi * i / corners) * (r := random_.uniform(0.4, 3)), 3),
            round(cy + math.sin(2 * math.pi * i / corners) * r, 3),
        )
        for i in range(corners)
    ]


@pytest.fixture(scope="module")
def polygons(spark):
    random_ = random.Random(7)
    rings = [(f"s{i}", star(random_, random_.uniform(-8, 8), random_.uniform(-8, 8))) for i in range(12)]
    texts = [(name, polygon_text(ring)) for name, ring in rings]
    texts.append(("none", None))
    return spark.createDataFrame(texts, "name string, t string").select(
        "name", G.polygon_from_geojson(F.col("t")).alias("g")
    )


@pytest.fixture(scope="module")
def points(spark, polygons):
    random_ = random.Random(8)
    found = [(random_.uniform(-12, 12), random_.uniform(-12, 12)) for _ in range(1200)]
    found += [(float(x), float(y)) for x, y in itertools.product(range(-10, 11, 2), repeat=2)]
    # All corners of the polygons: on the boundary, hence outside of their own polygon.
    edges = polygons.select(F.inline(G.polygon_edges(F.col("g")))).collect()
    found += [(e.x1, e.y1) for e in edges]
    found += [(None, None), (1.0, None)]
    return spark.createDataFrame([(i, *p) for i, p in enumerate(found)], "id int, x double, y double").select(
        "id", G.make_point(F.col("x"), F.col("y")).alias("p")
    )


@pytest.fixture(scope="module")
def brute_force(points, polygons):
    inside = G.point_within(F.col("p"), F.col("g"))
    pairs = points.join(F.broadcast(polygons), inside, "left").select("id", "name")
    return rows(pairs)


@pytest.mark.parametrize("cell", [0.37, 1.0, 2.5, 50.0])
@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_grid_join_equals_brute_force(spark, points, polygons, brute_force, cell, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = spatial.spatial_left_join(points, "p", polygons, "g", {"name": "name"}, cell)
        assert got.columns == ["id", "p", "name"]
        assert rows(got.select("id", "name")) == brute_force
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert threshold != "-1" or "BroadcastHashJoin" not in plan
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cells_are_not_broadcast_on_an_estimate(spark, points, polygons):
    """Small outlines in a small file fill many cells; no task may hold them all."""
    got = spatial.spatial_left_join(points, "p", polygons, "g", {"name": "name"}, 0.05)
    assert got.count() >= points.count()
    text = plan(got)
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_inside_cells_need_no_edges(spark):
    square = polygon_text([(0, 0), (10, 0), (10, 10), (0, 10)])
    df = spark.createDataFrame([("a", square)], "name string, t string").select(
        "name", G.polygon_from_geojson(F.col("t")).alias("g")
    )
    cells = spatial.polygon_cells(df, "g", ["name"], 1.0).select("_cx", "_cy", F.size("_edges").alias("n"))
    empty = {(r[0], r[1]) for r in cells.where("n = 0").collect()}
    assert empty == {(x, y) for x in range(1, 9) for y in range(1, 9)}


def test_parts_holes_and_repeated_corners(spark):
    """Rings that touch at corners and along edges, holes, repeated and unclosed corners."""
    ring = lambda *p: "[" + ", ".join(f"[{x}, {y}]" for x, y in p) + "]"
    shapes = {
        "hole": f"[[{ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))}, {ring((1, 1), (3, 1), (3, 3), (1, 3), (1, 1))}]]",
        "parts": f"[[{ring((0, 0), (2, 0), (2, 2), (0, 2))}], [{ring((2, 2), (4, 2), (4, 4), (2, 4))}]]",
        "bow": f"[[{ring((0, 0), (3, 3), (3, 0), (0, 3), (0, 0))}]]",
        "repeats": f"[[{ring((0, 0), (0, 0), (3, 0.5), (3, 0.5), (3, 0.5), (1.5, 3), (0, 0), (0, 0))}]]",
        "flat": f"[[{ring((0, 1), (3, 1), (0, 1))}]]",
        "dot": f"[[{ring((1, 1), (1, 1))}]]",
        "empty": "[]",
    }
    texts = [(n, '{"type": "MultiPolygon", "coordinates": ' + c + "}") for n, c in shapes.items()]
    outlines = spark.createDataFrame(texts, "name string, t string").select(
        "name", G.polygon_from_geojson(F.col("t")).alias("g")
    )
    spots = [(x / 4, y / 4) for x, y in itertools.product(range(-2, 19), repeat=2)]
    grid = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], "id int, x double, y double").select(
        "id", G.make_point(F.col("x"), F.col("y")).alias("p")
    )
    want = rows(grid.join(F.broadcast(outlines), G.point_within(F.col("p"), F.col("g")), "left").select("id", "name"))
    for cell in (0.25, 0.3, 1.0, 7.0):
        got = spatial.spatial_left_join(grid, "p", outlines, "g", {"name": "name"}, cell)
        assert rows(got.select("id", "name")) == want, cell


def test_a_long_outline_is_prepared_by_several_tasks(spark):
    """200,000 corners: no task has more than a part of the edges, no list holds them."""
    n = 200_000
    corner = "array(cos(2 * pi() * i / {n}) * (5 + sin(i / 50)), sin(2 * pi() * i / {n}) * (5 + sin(i / 50)))".format(n=n)
    wide = spark.range(1).selectExpr(
        "'w' as name", f"struct('Polygon' as type, array(array(transform(sequence(0, {n}), i -> {corner}))) as parts) as g"
    )
    spots = spark.range(0, 250).selectExpr("id", "struct(rand(3) * 14 - 7 as lon, rand(4) * 14 - 7 as lat) as p").cache()
    want = rows(spots.join(wide, G.point_within(F.col("p"), F.col("g"))).select("id"))
    for cell in (0.05, 0.11):
        cells = spatial.polygon_cells(wide, "g", ["name"], cell)
        dealt = cells.groupBy(F.spark_partition_id()).count().collect()
        assert len(dealt) > 1
        longest = cells.agg(F.max(F.size("_edges"))).first()[0]
        assert longest < n / 20
        got = spatial.spatial_left_join(spots, "p", wide, "g", {"name": "name"}, cell)
        assert rows(got.where("name is not null").select("id")) == want
    text = plan(cells)
    assert "RoundRobinPartitioning" in text
    assert all("_cx" in line for line in text.splitlines() if "collect_list" in line and "keys=" in line)


# --- merge ---------------------------------------------------------------------


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    once = upsert.upsert(target, source, "k")
    assert rows(once) == [("a", 1), ("b", 3), ("c", 4)]
    assert rows(upsert.upsert(once, source, "k")) == rows(once)
    assert rows(upsert.upsert(None, source, "k")) == rows(source)


def test_upsert_with_a_new_column(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("b", 3, "n")], "k string, v int, w string")
    assert rows(upsert.upsert(target, source, "k")) == [("a", 1, None), ("b", 3, "n")]


def test_keys_of_a_merge_are_not_broadcast_on_an_estimate(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("b", 4), (None, 5)], "k string, v int")
    kept = upsert.kept_rows(target, source, "k")
    assert rows(kept) == [("a", 1), (None, 3)]
    assert "BroadcastHashJoin" not in plan(kept)


def test_duplicate_source_keys_raise(spark):
    source = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(upsert.DuplicateKeys):
        upsert.require_unique(source, "k")
    upsert.require_unique(source.limit(1), "k")


# --- checks --------------------------------------------------------------------


def test_checks_on_missing_ids(spark):
    df = dated(spark, [(None, "2024-01-01"), (None, "2024-01-01"), ("a", "2024-01-01"), ("a", "2024-01-08")])
    assert quality.not_unique_in_snapshot(df, "k").count() == 1
    assert rows(quality.not_unique(df, "k")) == [("a", 2)]
    assert quality.is_null(df, "k").count() == 2
    parent = spark.createDataFrame([("a",)], "k string")
    assert quality.no_parent(df, "k", parent, "k").count() == 0
