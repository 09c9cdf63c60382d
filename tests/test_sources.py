"""Feeds, landing, GeoJSON, raw snapshots and versioned tables on real files."""

import datetime as dt
import json
import os
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from snapledger import shared_dir
from snapledger.operators.snapshot import latest_snapshot
from snapledger.plans import marts
from snapledger.sources import feeds, geojson, raw, tables
from workload import inputs


def write(path, text):
    path.write_text(text)
    return str(path)


CSV = (
    "id,note,n,x,at\n"
    "1,,5,0.5,2023-07-29T13:00:00.000\n"
    '2,"",,,\n'
    '3,"a ""quoted"", word",7,1e-3,2023-07-29T13:00:00.123\n'
)


def test_csv_types_and_empty_strings(spark, tmp_path):
    path = write(tmp_path / "feed.csv", CSV)
    df = feeds.warehouse_types(feeds.scan_csv(spark, path))
    assert dict(df.dtypes) == {
        "id": "bigint", "note": "string", "n": "bigint", "x": "double", "at": "bigint",
    }
    got = [tuple(r) for r in df.orderBy("id").collect()]
    noon = 1690635600 * 10**9
    assert got == [
        (1, "", 5, 0.5, noon),
        (2, "", None, None, None),
        (3, 'a "quoted", word', 7, 0.001, noon + 123 * 10**6),
    ]


def test_declared_types_go_by_name(spark, tmp_path):
    path = write(tmp_path / "feed.csv", CSV)
    df = feeds.scan_csv(spark, path, "x double, id bigint")
    assert dict(df.dtypes) == {"id": "bigint", "note": "string", "n": "string", "x": "double", "at": "string"}
    assert [r.x for r in df.orderBy("id").collect()] == [0.5, None, 0.001]


def test_csv_that_does_not_fit_raises(spark, tmp_path):
    path = write(tmp_path / "feed.csv", "id,n\n1,abc\n")
    with pytest.raises(Exception):
        feeds.scan_csv(spark, path, "id bigint, n bigint").collect()
    with pytest.raises(Exception):
        feeds.csv_to_parquet(spark, path, str(tmp_path), "x", "2024-01-01", "id bigint, n bigint")


def test_all_rows_are_landed(spark, tmp_path):
    path = write(tmp_path / "feed.csv", CSV)
    landed = feeds.csv_to_parquet(spark, path, str(tmp_path / "l"), "feed", "2024-01-01")
    assert spark.read.parquet(landed).count() == 3


def test_landing_path():
    assert feeds.landing_path("/r/", "crash", "2024-01-08") == "/r/crash/ds=20240108"
    assert feeds.landing_path("/r", "crash", dt.date(2024, 1, 8)) == "/r/crash/ds=20240108"


def test_nanosecond_parquet_arrives_as_integers(spark, tmp_path):
    times = pa.array([1690635600123456789, None], pa.timestamp("ns"))
    path = str(tmp_path / "nanos.parquet")
    pq.write_table(pa.table({"crash_date": times}), path, version="2.6")
    df = feeds.read_landed(spark, path)
    assert df.dtypes == [("crash_date", "bigint")]
    assert [r[0] for r in df.collect()] == [1690635600123456789, None]


FEATURES = {
    "type": "FeatureCollection",
    "features": [
        {
            "properties": {"name": "A", "n": 1, "x": 1.5, "ok": True, "none": None, "odd": 1, "l": [1]},
            "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]},
        },
        {
            "properties": {"name": "B", "n": 2, "x": 2, "ok": False, "none": None, "odd": "x", "l": None},
            "geometry": {"type": "Polygon", "coordinates": [[[5, 0], [6, 0], [6, 1], [5, 0]]]},
        },
    ],
}


@pytest.mark.parametrize("multi_line", [True, False])
def test_geojson_to_ndjson(spark, tmp_path, multi_line):
    text = json.dumps(FEATURES, indent=2 if multi_line else None)
    path = write(tmp_path / "f.geojson", text)
    features = geojson.scan_geojson(spark, path, multi_line)
    assert features.count() == 2
    flat = geojson.flatten_features(features, "name string, n bigint, x double, none string")
    out = str(tmp_path / "out")
    geojson.write_ndjson(flat, out)
    lines = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted(lines[0]) == ["geometry", "n", "name", "none", "x"]
    assert {r["name"]: json.loads(r["geometry"])["coordinates"][0][0] for r in lines} == {
        "A": [0, 0], "B": [5, 0],
    }
    back = geojson.read_ndjson(spark, out).orderBy("n").collect()
    assert [(r.name, r.n, r.x) for r in back] == [("A", 1, 1.5), ("B", 2, 2.0)]


def test_property_types(spark, tmp_path):
    path = write(tmp_path / "f.geojson", json.dumps(FEATURES))
    got = geojson.infer_property_schema(geojson.scan_geojson(spark, path))
    assert {r.name: r.type for r in got.collect()} == {
        "name": "string", "n": "int64", "x": "float64", "ok": "int64", "none": "float64",
        "odd": "float64", "l": "float64", "geometry": "GEOGRAPHY",
    }


def test_all_properties(spark, tmp_path):
    path = write(tmp_path / "f.geojson", json.dumps(FEATURES))
    features = geojson.scan_geojson(spark, path)
    schema = geojson.all_properties(features, "name string, absent int")
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        "name": "string", "absent": "int", "n": "bigint", "x": "double", "ok": "string",
        "none": "double", "odd": "string", "l": "string",
    }
    assert [f.name for f in schema][:2] == ["name", "absent"]
    with pytest.raises(ValueError):
        geojson.all_properties(features, "NAME string")


def test_history_has_the_columns_of_the_newest_snapshot(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw.append_snapshot(frame(spark, "a"), path, "2024-01-01")
    raw.append_snapshot(frame(spark, "b").withColumn("v", F.lit(1)), path, "2024-01-08")
    raw.append_snapshot(frame(spark, "c"), path, "2024-01-15")
    assert {r.k: r.v for r in raw.read_history(spark, path, "2024-01-08").collect()} == {"a": None, "b": 1}
    assert sorted(r.k for r in raw.read_history(spark, path).collect()) == ["a", "b", "c"]


def test_broken_geojson_raises(spark, tmp_path):
    path = write(tmp_path / "f.geojson", '{"features": [{"properties": {')
    with pytest.raises(Exception):
        geojson.scan_geojson(spark, path).collect()


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def test_append_keeps_history_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw.append_snapshot(frame(spark, "a"), path, "2024-01-01")
    raw.append_snapshot(frame(spark, "a", "b"), path, "2024-01-08")
    raw.append_snapshot(frame(spark, "a", "b"), path, "2024-01-08")
    assert raw.read_raw(spark, path).count() == 3
    assert raw.snapshot_dates(spark, path) == ["2024-01-01", "2024-01-08"]
    newest = raw.read_snapshot(spark, path)
    assert sorted(r.k for r in newest.collect()) == ["a", "b"]
    assert dict(newest.dtypes)["partition_date"] == "date"
    assert raw.read_snapshot(spark, path, "2024-01-07").count() == 1
    with pytest.raises(FileNotFoundError):
        raw.read_snapshot(spark, path, "2023-01-01")


def test_latest_of_appended_is_the_appended_snapshot(spark, tmp_path):
    path = str(tmp_path / "raw")
    for date, values in [("2024-01-01", "abc"), ("2024-01-08", "bcd")]:
        raw.append_snapshot(frame(spark, *values), path, date)
        assert sorted(r.k for r in latest_snapshot(raw.read_raw(spark, path)).collect()) == list(values)


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "raw")
    for day in range(1, 7):
        raw.append_snapshot(frame(spark, str(day)), path, f"2024-01-0{day}")
    df = latest_snapshot(raw.read_raw(spark, path))
    assert [r.k for r in df.collect()] == ["6"]
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*partition_date#\d+ = (Reused)?Subquery", text), text


def test_new_columns_are_null_in_older_snapshots(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw.append_snapshot(frame(spark, "a"), path, "2024-01-01")
    raw.append_snapshot(frame(spark, "b").withColumn("v", F.lit(1)), path, "2024-01-08")
    got = {r.k: r.v for r in raw.read_raw(spark, path).collect()}
    assert got == {"a": None, "b": 1}


def test_replace_drops_history(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw.replace_snapshot(frame(spark, "a"), path, "2024-01-01")
    raw.replace_snapshot(frame(spark, "b"), path, "2024-01-08")
    assert [r.k for r in raw.read_raw(spark, path).collect()] == ["b"]


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "k string, v int"
    first = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    second = spark.createDataFrame([("b", 3), ("c", 4)], schema)
    assert tables.read_version(spark, path) is None
    assert pairs(tables.merge_version(first, path, "k", "2024-01-01")) == [("a", 1), ("b", 2)]
    # Not visible to later runs before it is marked.
    assert tables.read_version(spark, path) is None
    tables.mark_checked(spark, path, "2024-01-01")
    for _ in range(2):
        merged = tables.merge_version(second, path, "k", "2024-01-08", order_by="k")
        assert pairs(merged) == [("a", 1), ("b", 3), ("c", 4)]
        assert tables.versions(spark, path) == ["2024-01-01"]
        tables.mark_checked(spark, path, "2024-01-08")
    assert tables.versions(spark, path) == ["2024-01-01", "2024-01-08"]
    assert pairs(tables.read_version(spark, path, before="2024-01-08")) == [("a", 1), ("b", 2)]


def test_shared_dir_is_read_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one.startswith(base) and one != two


def test_empty_rerun_replaces_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw.append_snapshot(frame(spark, "a"), path, "2024-01-01")
    raw.append_snapshot(frame(spark, "a", "b"), path, "2024-01-08")
    raw.append_snapshot(frame(spark, "a").where("false"), path, "2024-01-08")
    assert raw.read_snapshot(spark, path).count() == 0
    assert raw.read_raw(spark, path).count() == 1


def test_repeated_dates_do_not_mix_with_older_attempts(spark, tmp_path):
    """The newest attempt of a date holds, also while it is not checked."""
    path = str(tmp_path / "table")
    one = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    two = spark.createDataFrame([("c", 3)], "k string, v int")
    for df, date in ((one, "2024-01-01"), (two, "2024-01-08")):
        tables.merge_version(df, path, "k", date)
        tables.mark_checked(spark, path, date)
    assert pairs(tables.read_version(spark, path)) == [("a", 1), ("b", 2), ("c", 3)]
    again = tables.write_attempt(one.where("k = 'a'"), path, "k", "2024-01-01")
    assert tables.versions(spark, path) == ["2024-01-08"]
    assert pairs(tables.merge_version(two, path, "k", "2024-01-08")) == [("c", 3)]
    assert tables.versions(spark, path) == []
    # Two attempts at a time: the one that began later holds, whichever is checked.
    late = tables.write_attempt(one.where("k = 'b'"), path, "k", "2024-01-01")
    again.mark_checked(spark)
    assert tables.versions(spark, path) == []
    late.mark_checked(spark)
    assert pairs(tables.read_version(spark, path)) == [("b", 2)]


@pytest.mark.parametrize("at", ["build", "kept", "written"])
def test_a_crash_leaves_the_version_as_it_was(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "table")
    rows = lambda *r: spark.createDataFrame(r, "k string, v int")
    for df, date in ((rows(("a", 1), ("b", 2)), "2024-01-01"), (rows(("b", 3)), "2024-01-08")):
        tables.merge_version(df, path, "k", date)
        tables.mark_checked(spark, path, date)
    before = pairs(tables.read_version(spark, path))
    broken = rows(("b", 9))

    def fail(*_, **__):
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        if at == "build":  # while the rows are written: some files are there, no job commit
            broken = broken.withColumn("v", F.raise_error(F.lit("crash")).cast("int"))
        patch.setattr(tables, "kept_rows" if at == "kept" else "touch", fail)
        with pytest.raises(Exception, match="crash"):
            tables.write_attempt(broken, path, "k", "2024-01-08")
    assert tables.versions(spark, path) == ["2024-01-01", "2024-01-08"]
    assert pairs(tables.read_version(spark, path)) == before == [("a", 1), ("b", 3)]
    # Readers of the old attempt are not disturbed by the next one.
    old = tables.read_version(spark, path)
    assert pairs(tables.merge_version(rows(("b", 9)), path, "k", "2024-01-08")) == [("a", 1), ("b", 9)]
    assert pairs(old) == before
    tables.mark_checked(spark, path, "2024-01-08")
    assert pairs(tables.read_version(spark, path)) == [("a", 1), ("b", 9)]


def test_marking_what_is_not_there_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.mark_checked(spark, str(tmp_path / "none"), "2024-01-01")


def _codecs(folder):
    found = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
    files = [pq.ParquetFile(f).metadata for f in found]
    return {m.row_group(g).column(0).compression for m in files for g in range(m.num_row_groups)}


def test_tables_are_stored_by_an_entropy_coder(spark, tmp_path):
    """Hex digests take half the bytes; byte matches alone find nothing in them."""
    rows = spark.range(10).select("id", F.md5(F.col("id").cast("string")).alias("k"))
    raw.append_snapshot(rows, str(tmp_path / "appended"), "2024-01-01")
    raw.replace_snapshot(rows.withColumn("partition_date", F.lit("2024-01-01").cast("date")), str(tmp_path / "replaced"), "2024-01-01")
    feeds.land(rows, str(tmp_path / "landed"), "x", "2024-01-01")
    for date in ("2024-01-01", "2024-01-08"):
        tables.write_attempt(rows, str(tmp_path / "table"), "k", date).mark_checked(spark)
    marts.export({"m": rows}, str(tmp_path / "marts"))
    for name in ("appended", "replaced", "landed", "table", "marts"):
        assert _codecs(tmp_path / name) == {"ZSTD"}, name


def test_feeds_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "FEED_FILE_ROWS", 10)
    orders = spark.range(35).coalesce(1).selectExpr(
        "id as o_orderkey", "id % 7 as o_custkey", "'F' as o_orderstatus", "'1-URGENT' as o_orderpriority",
        "date '1996-01-01' as o_orderdate",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    path = inputs.write_csv_feed(spark, str(tmp_path), "crash", str(tmp_path / "feed"))
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".csv.gz") for f in files)
    assert feeds.scan_csv(spark, path).count() == 35
