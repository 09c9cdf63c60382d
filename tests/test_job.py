"""The batch job over three run dates of small hand-made feeds."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from snapledger import session
from snapledger.operators.upsert import DuplicateKeys
from snapledger.plans import checks, job, marts, refined, reports, staging
from snapledger.sources import tables

CRASH_COLUMNS = (
    "crash_record_id,crash_date,hit_and_run_i,road_defect,crash_type,injuries_total,"
    "injuries_fatal,latitude,longitude,extra"
)
ALL_CRASH = [
    "posted_speed_limit", "traffic_control_device", "weather_condition", "lighting_condition",
    "first_crash_type", "trafficway_type", "roadway_surface_cond", "intersection_related_i",
    "damage", "prim_contributory_cause", "street_no", "street_direction", "street_name",
    "dooring_i", "work_zone_i", "workers_present_i",
]


def csv(path, header, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def square(x, y, size=1.0):
    return {
        "type": "Polygon",
        "coordinates": [[[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]],
    }


def collection(path, features):
    path.parent.mkdir(parents=True, exist_ok=True)
    found = [{"type": "Feature", "properties": p, "geometry": g} for p, g in features]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": found}, indent=1))
    return str(path)


def feed_paths(folder, crashes, vehicles=("10,c1,5", "11,c2,"), people=("p1,c1,5", "p2,c2,"), wards=None):
    pad = "," * len(ALL_CRASH)
    return {
        "crash": csv(
            folder / "crash.csv",
            CRASH_COLUMNS + "," + ",".join(ALL_CRASH),
            [line + pad for line in crashes],
        ),
        "vehicle": csv(
            folder / "vehicle.csv",
            "crash_unit_id,crash_record_id,vehicle_id,unit_type,num_passengers,make,model,"
            "lic_plate_state,vehicle_year,vehicle_defect,vehicle_type,vehicle_use,"
            "travel_direction,maneuver,exceed_speed_limit_i",
            [f"{v},DRIVER,,Unknown,Civic,il,1999,NONE,,,n,,Y" for v in vehicles],
        ),
        "people": csv(
            folder / "people.csv",
            "person_id,crash_record_id,vehicle_id,person_type,sex,age,driver_vision,"
            "drivers_license_state,physical_condition,bac_result,bac_result_value,cell_phone_use",
            [f"{p},DRIVER,m,33,TREES,il,NORMAL,,0.5,N" for p in people],
        ),
        "ward": collection(
            folder / "ward.geojson",
            wards
            or [
                (
                    {"globalid": "g1", "ward": "1", "ward_id": "1", "objectid": 7,
                     "edit_date": "2022-01-15T08:30:00.000", "st_length_": "4", "st_area_sh": 1.0},
                    square(0, 0),
                )
            ],
        ),
        "neighborhood": collection(
            folder / "neighborhood.geojson",
            [({"pri_neigh": "Loop", "sec_neigh": "LOOP", "shape_len": "8", "shape_area": "4"}, square(0, 0, 2))],
        ),
    }


C1 = "c1,2024-01-06T07:00:00.000,Y,NO DEFECTS,INJURY,2,0,0.5,0.5,x"
C1_MOVED = "c1,2024-01-06T07:00:00.000,Y,NO DEFECTS,INJURY,2,0,1.5,1.5,x"
C2 = "c2,2024-01-08T10:00:00.000,,,NO INJURY,0,0,1.5,0.5,x"
C3 = "c3,2024-01-14T23:59:00.000,N,RUT,INJURY,1,1,9.0,9.0,x"


@pytest.fixture(scope="module")
def builds(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    root = str(base / "warehouse")
    options = {"cell": 0.25}
    first = job.run(spark, "2024-01-08", feed_paths(base / "1", [C1, C2]), root, **options)
    kept = {k: v.count() for k, v in first.refined.items()}
    second = job.run(spark, "2024-01-15", feed_paths(base / "2", [C1_MOVED, C2, C3]), root, **options)
    return root, kept, first, second


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_all_checks_ran_and_passed(builds):
    for build in builds[2:]:
        assert len(build.results) == len(checks.ALL_CHECKS) == 48
        assert {(r[0], r[1], r[2]) for r in build.results} == {
            (c.model, c.kind, c.column) for c in checks.ALL_CHECKS
        }
        assert not [r for r in build.results if r[3]]


def test_declared_checks_by_kind():
    count = lambda kind: len([c for c in checks.ALL_CHECKS if c.kind == kind])
    kinds = {k: count(k) for k in ("not_null", "unique", "unique_id_partition", "relationships")}
    assert kinds == {"not_null": 29, "unique": 12, "unique_id_partition": 5, "relationships": 2}


def test_first_build(builds):
    _, kept, first, _ = builds
    assert kept["refined_fact_crash"] == 2 and kept["refined_fact_people"] == 2
    crash = {r.crash_id: r for r in first.marts["fact_crash"].collect()}
    assert crash["c1"].is_hit_and_run is True and crash["c2"].is_hit_and_run is None
    # The empty defect is a category of its own here, not a missing value.
    assert crash["c1"].is_road_defect is False and crash["c2"].is_road_defect is True
    vehicle = {r.crash_vehicle_id: r for r in first.marts["fact_vehicle"].collect()}
    assert vehicle["10"].is_vehicle_defect is True and vehicle["10"].vehicle_make is None
    people = {r.person_id: r for r in first.marts["fact_people"].collect()}
    assert people["p1"].vehicle_hkey == vehicle["10"].vehicle_hkey
    assert people["p2"].vehicle_hkey is None
    assert people["p1"].is_vision_obscured is True and people["p1"].is_physically_impaired is False


def test_locations_get_their_boundaries(builds):
    got = values(builds[3].marts["dim_location"], "longitude", "latitude", "ward_id", "neighborhood")
    assert got == [
        (0.5, 0.5, 1, "LOOP"),
        (0.5, 1.5, None, "LOOP"),
        (1.5, 1.5, None, "LOOP"),
        (9.0, 9.0, None, None),
    ]


def test_the_boundary_join_runs_once(spark, builds):
    """Its rows are stored before they are checked and shown, those of this run alone."""
    root, _, _, second = builds
    places = second.marts["dim_location"]
    assert "Join" not in places._jdf.queryExecution().optimizedPlan().toString()
    stored = tables.read_version(spark, f"{root}/refined/refined_dim_location_enriched")
    assert values(stored, "location_hkey", "ward_id") == values(places, "location_hkey", "ward_id")
    assert places.count() == places.select("location_hkey").distinct().count() == 4


def test_all_feeds_are_written_at_once(spark, monkeypatch):
    """Before the first run, each by a job that does not wait for the others."""
    from workload import inputs, queries

    together, written = threading.Barrier(8, timeout=60), []

    def write(spark, sf, name, path, date=None):
        together.wait()
        written.append((name, date))
        return path

    def run(spark, date, paths, *_, **__):
        assert len(written) == 8
        assert paths["ward"].endswith("feeds/ward") and paths["crash"].endswith(f"feeds/{date}/crash")
        return sorted(paths)

    monkeypatch.setattr(inputs, "write_csv_feed", write)
    monkeypatch.setattr(inputs, "write_geojson_feed", write)
    monkeypatch.setattr(job, "run", run)
    assert len(queries._job(spark, "sf", queries.RUNS)) == 5


def test_steps_free_their_shuffles(spark, tmp_path, monkeypatch):
    """Every table is written with the setting on, also people with their vehicles alone, no
    frame that is returned needs a shuffle, and the session is left as it was."""
    seen, write = [], DataFrameWriter.parquet
    freed = lambda: spark.conf.get(session.SHUFFLES_FREED, None)

    def written(self, path, *args, **options):
        seen.append((path, freed()))
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", written)
    before = freed()
    build = job.run(spark, "2024-01-08", feed_paths(tmp_path, [C1, C2]), str(tmp_path / "w"), cell=0.25)
    assert freed() == before != "true"
    tables_written = [(p, on) for p, on in seen if "/refined/" in p or "/people-" in p]
    assert len(tables_written) == 9 and all(on == "true" for _, on in tables_written)
    for frame in [*build.refined.values(), *build.marts.values()]:
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_shuffles_of_a_finished_query_are_freed(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = [f.toString() for f in env.blockManager().diskBlockManager().localDirs()]

    def shuffles():
        return {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before = shuffles()
    with session.shuffles_freed(spark):
        frame = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count()
        frame.write.format("noop").mode("overwrite").save()
        assert spark.range(1000).repartition(5, "id").where("id >= 0").collect()
    until = time.monotonic() + 20
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffles() - before
    assert frame.count() == 1000


def test_people_are_stored_between_their_two_joins(spark, builds):
    second, stored = builds[3], []
    people = staging.rename_and_type(second.raw["people"], "people")
    parents = second.refined["refined_fact_crash"], second.refined["refined_fact_vehicle"]

    def store(rows):
        stored.append(rows)
        return rows

    got = refined.fact_people(people, *parents, store)
    assert "vehicle_hkey" in stored[0].columns and "crash_hkey" not in stored[0].columns
    assert values(got, *got.columns) == values(refined.fact_people(people, *parents), *got.columns)


def test_corrected_crash_keeps_its_old_row(builds):
    second = builds[3]
    got = values(second.marts["fact_crash"], "crash_id", F.col("partition_date").cast("string"))
    assert got == [
        ("c1", "2024-01-08"), ("c1", "2024-01-15"), ("c2", "2024-01-15"), ("c3", "2024-01-15"),
    ]
    # Both rows of the crash match its vehicle and its driver.
    vehicles = second.marts["fact_vehicle"]
    assert vehicles.where("crash_id = 'c1'").count() == 2
    assert second.marts["fact_people"].where("person_id = 'p1'").count() == 4


def test_reports_on_the_build(builds):
    m = builds[3].marts
    geo = {(r.ward_id, r.neighborhood): r.crash_count for r in reports.geography(m["fact_crash"], m["dim_location"]).collect()}
    assert geo == {(1, "LOOP"): 1, (None, "LOOP"): 2, (None, None): 1}
    trend = {(r.year, r.month): (r.crash_count, r.injury_count, r.fatal_count)
             for r in reports.trend(m["fact_crash"], m["dim_datetime"]).collect()}
    assert trend == {(2024, 1): (4, 5, 1)}


def test_mart_views_and_export(spark, builds, tmp_path):
    frames = builds[3].marts
    marts.publish_views(frames, "t_")
    assert spark.sql("select count(*) from t_fact_crash").first()[0] == 4
    paths = marts.export(frames, str(tmp_path))
    assert {n: spark.read.parquet(p).count() for n, p in paths.items()} == {
        n: f.count() for n, f in frames.items()
    }


def test_repeating_a_run_changes_nothing(spark, builds, tmp_path):
    root, _, _, second = builds
    before = {k: values(v, *[c for c in v.columns if "geometry" not in c and "point" not in c])
              for k, v in second.refined.items()}
    again = job.run(
        spark, "2024-01-15", feed_paths(tmp_path, [C1_MOVED, C2, C3]), root, cell=0.7
    )
    after = {k: values(v, *[c for c in v.columns if "geometry" not in c and "point" not in c])
             for k, v in again.refined.items()}
    assert after == before
    history = spark.read.parquet(f"{root}/raw/crash").groupBy("partition_date").count().collect()
    assert sorted(r[1] for r in history) == [2, 3]


def test_failed_check_stops_the_build(spark, tmp_path):
    root = str(tmp_path / "w")
    bad = feed_paths(tmp_path, [C1, C2], people=("p1,c1,5", "p2,gone,", "p2,c2,"))
    with pytest.raises(checks.ChecksFailed) as error:
        job.run(spark, "2024-01-08", bad, root, cell=0.25)
    assert {(f[0], f[1], f[3]) for f in error.value.failed} == {
        ("raw_people", "relationships", 1), ("raw_people", "unique_id_partition", 1),
    }
    assert tables.versions(spark, f"{root}/refined/refined_fact_crash") == []
    # Without strict checks the build goes through and reports them.
    build = job.transform(spark, "2024-01-08", root, strict=False, cell=0.25)
    assert len(build.results) == 48 and sum(r[3] for r in build.results) > 0


def test_duplicate_keys_in_a_merge_raise(spark, tmp_path):
    root = str(tmp_path / "w")
    job.run(spark, "2024-01-08", feed_paths(tmp_path / "1", [C1, C2]), root, cell=0.25)
    twice = feed_paths(tmp_path / "2", [C1, C1, C2])
    with pytest.raises(DuplicateKeys):
        job.run(spark, "2024-01-15", twice, root, strict=False, cell=0.25)
    # The next run starts from the last good version.
    third = feed_paths(tmp_path / "3", [C1, C2])
    good = job.run(spark, "2024-01-22", third, root, strict=False, cell=0.25)
    assert good.marts["fact_crash"].count() == 2
    # The repeated crash is still in the history, which strict runs check as a whole.
    assert {r[:3] for r in good.results if r[3]} == {("raw_crash", "unique_id_partition", "crash_record_id")}
    with pytest.raises(checks.ChecksFailed):
        job.transform(spark, "2024-01-22", root, cell=0.25)
    # Delivering that date again without the repeated row mends it.
    job.load(spark, "2024-01-15", feed_paths(tmp_path / "4", [C1, C2]), root)
    job.transform(spark, "2024-01-22", root, cell=0.25)


def test_redrawn_boundaries(spark, tmp_path):
    root = str(tmp_path / "w")
    props = {"globalid": "g1", "ward": "1", "ward_id": "1", "objectid": 7,
             "edit_date": "2022-01-15T08:30:00.000", "st_length_": "4", "st_area_sh": "1"}
    job.run(spark, "2024-01-08", feed_paths(tmp_path / "1", [C1, C2]), root, cell=0.25)
    redrawn = feed_paths(tmp_path / "2", [C1, C2], wards=[(props, square(0, 0, 1.25))])
    # Both outlines are kept, so a location lies in two of them and the check fails.
    with pytest.raises(checks.ChecksFailed):
        job.run(spark, "2024-01-15", redrawn, root, cell=0.25)
    build = job.transform(spark, "2024-01-15", root, current_boundaries=True, cell=0.25)
    assert build.marts["dim_location"].where("ward_id = 1").count() == 1


def test_overlapping_boundaries_fan_out_the_crash_fact(spark, tmp_path):
    props = {"globalid": "g", "ward": "1", "objectid": 7,
             "edit_date": "2022-01-15T08:30:00.000", "st_length_": "4", "st_area_sh": "1"}
    wards = [(props | {"ward_id": "1"}, square(0, 0)), (props | {"ward_id": "2"}, square(0.25, 0.25))]
    paths = feed_paths(tmp_path, [C1, C2], wards=wards)
    build = job.run(spark, "2024-01-08", paths, str(tmp_path / "w"), strict=False, cell=0.25)
    crashes = sorted(r.crash_id for r in build.marts["fact_crash"].collect())
    assert crashes == ["c1", "c1", "c2"]
    failed = {r[:3] for r in build.results if r[3]}
    assert ("refined_dim_location_enriched", "unique", "location_hkey") in failed
    assert ("refined_fact_crash", "unique", "crash_hkey") in failed
    assert tables.versions(spark, f"{tmp_path}/w/refined/refined_fact_crash") == []


def test_run_for_an_earlier_date(spark, tmp_path):
    """Runs A, B, A: the boundary set of B stays, and A gives what it gave but for that."""
    root = str(tmp_path / "w")
    moved = [({"globalid": "g1", "ward": "1", "ward_id": "1", "objectid": 7,
               "edit_date": "2022-01-15T08:30:00.000", "st_length_": "4", "st_area_sh": "1",
               "Extra name": {"deep": [1, 2]}, "count": 3, "open": True}, square(9, 9))]
    job.run(spark, "2024-01-08", feed_paths(tmp_path / "a", [C1, C2]), root, cell=0.25)
    options = {"cell": 0.25, "current_boundaries": True}
    job.run(spark, "2024-01-15", feed_paths(tmp_path / "b", [C1, C2, C3], wards=moved), root, **options)
    again = job.run(spark, "2024-01-08", feed_paths(tmp_path / "a", [C1, C2]), root, **options)
    assert again.raw["crash"].count() == 2 and again.marts["fact_crash"].count() == 2
    ward = again.raw["ward"].first()
    assert str(ward.partition_date) == "2024-01-15"
    # Properties nobody declared are kept, too.
    assert (ward["Extra name"], ward["count"], ward["open"]) == ('{"deep":[1,2]}', 3, "true")


def test_places_are_stored_by_area(spark, tmp_path):
    """A small box of the map meets few of the stored files, by their column statistics."""
    import pyarrow.parquet as pq

    root, n = str(tmp_path / "w"), 6000
    crashes = [f"c{i},2024-01-06T07:00:00.000,,,,0,0,{41 + (i * 7919 % n) / n},{-88 + (i * 104729 % n) / n},x" for i in range(n)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        build = job.run(spark, "2024-01-08", feed_paths(tmp_path / "1", crashes, ["1,c1,5"], ["p1,c1,5"]), root, cell=0.25)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = build.refined["refined_dim_location"].inputFiles()
    met = 0
    for file in files:
        groups = pq.ParquetFile(file.removeprefix("file://")).metadata
        names = {groups.schema.column(i).name: i for i in range(len(groups.schema))}
        stats = [groups.row_group(0).column(names[c]).statistics for c in ("longitude", "latitude")]
        low, high = (-87.9, 41.1), (-87.8, 41.2)
        met += all(s.min <= h and s.max >= l for s, l, h in zip(stats, low, high))
    assert len(files) >= 6 and met <= len(files) // 2
    assert build.refined["refined_dim_location"].count() == n


def test_unknown_dataset(spark, tmp_path):
    with pytest.raises(ValueError):
        job.load(spark, "2024-01-08", {"weather": "x"}, str(tmp_path))
