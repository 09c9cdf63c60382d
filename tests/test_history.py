"""Check results kept per snapshot."""

import os

import pytest
from pyspark.sql import functions as F

from snapledger.plans import checks, history
from snapledger.sources import raw

CHECKS = [
    checks.Check("child", "not_null", "id"),
    checks.Check("child", "unique_id_partition", "id"),
    checks.Check("child", "not_null", "ref"),
    checks.Check("child", "relationships", "ref", "parent", "pid"),
    checks.Check("parent", "not_null", "pid"),
]
DATES = ["2024-01-01", "2024-01-08", "2024-01-15"]
CHILD = {
    DATES[0]: [("a", "x"), ("a", None), (None, "y"), (None, "z")],
    DATES[1]: [("a", "x"), ("b", "gone"), ("c", "gone")],
    DATES[2]: [],
}
PARENT = {DATES[0]: [("x",), ("y",)], DATES[1]: [("x",), (None,)], DATES[2]: [("q",)]}


@pytest.fixture
def tables(spark, tmp_path):
    paths = {m: str(tmp_path / m) for m in ("child", "parent")}
    for date in DATES:
        deliver(spark, paths, "child", date, CHILD[date])
        deliver(spark, paths, "parent", date, PARENT[date])
    return paths, str(tmp_path / "counts")


def deliver(spark, paths, model, date, values):
    schema = "id string, ref string" if model == "child" else "pid string"
    raw.append_snapshot(spark.createDataFrame(values, schema), paths[model], date)


def whole(spark, paths, up_to=None):
    """The same checks on all rows at once."""
    frames = {m: raw.read_raw(spark, p) for m, p in paths.items()}
    if up_to:
        frames = {m: df.where(F.col("partition_date") <= F.lit(up_to).cast("date")) for m, df in frames.items()}
    return sorted(map(tuple, checks.report(frames, CHECKS).collect()))


def results(spark, tables, as_of=None):
    limits = None if as_of is None else {"child": as_of, "parent": as_of}
    return sorted(history.history_results(spark, tables[0], CHECKS, tables[1], limits))


def opened(monkeypatch):
    """The snapshots that are opened from here on."""
    seen = []
    read = history._snapshots

    def recording(spark, path, dates, columns, known):
        seen.extend((os.path.basename(path), d) for d in dates)
        return read(spark, path, dates, columns, known)

    monkeypatch.setattr(history, "_snapshots", recording)
    return seen


def test_results_are_those_of_all_rows(spark, tables):
    want = whole(spark, tables[0])
    assert ("child", "relationships", "ref", 3) in want and ("child", "unique_id_partition", "id", 2) in want
    assert results(spark, tables) == want
    assert results(spark, tables) == want
    assert results(spark, tables, DATES[0]) == whole(spark, tables[0], DATES[0])


def test_unchanged_snapshots_are_not_opened(spark, tables, monkeypatch):
    want = results(spark, tables)
    seen = opened(monkeypatch)
    assert results(spark, tables) == want and seen == []
    # Not even their footers: the files of the oldest snapshot are no Parquet any more.
    folder = f"{tables[0]['child']}/partition_date={DATES[0]}"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            path, stat = f"{folder}/{name}", os.stat(f"{folder}/{name}")
            with open(path, "r+b") as file:
                file.write(b"x" * stat.st_size)
            os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    later = "2024-01-22"
    deliver(spark, tables[0], "child", later, [("a", "q")])
    deliver(spark, tables[0], "parent", later, [("x",)])
    got = dict((r[:3], r[3]) for r in results(spark, tables))
    assert {d for _, d in seen} == {later}
    assert got["child", "relationships", "ref"] == 4
    with pytest.raises(Exception):
        raw.read_raw(spark, tables[0]["child"]).collect()


def test_replaced_snapshots_are_counted_again(spark, tables, monkeypatch):
    results(spark, tables)
    seen = opened(monkeypatch)
    deliver(spark, tables[0], "child", DATES[1], [("a", "x"), ("a", "x"), (None, "gone")])
    assert results(spark, tables) == whole(spark, tables[0])
    assert set(seen) == {("child", DATES[1]), ("parent", DATES[1])}
    # A new parent changes the references of the child, too, and nothing else of it.
    seen.clear()
    deliver(spark, tables[0], "parent", DATES[0], [("z",)])
    assert results(spark, tables) == whole(spark, tables[0])
    assert {d for _, d in seen} == {DATES[0]}


def test_snapshots_are_read_for_the_checks_that_are_wanted_alone(spark, tables, monkeypatch):
    results(spark, tables)
    asked, read = [], history._snapshots

    def recording(spark, path, dates, columns, known):
        asked.append((os.path.basename(path), tuple(dates), tuple(columns)))
        return read(spark, path, dates, columns, known)

    monkeypatch.setattr(history, "_snapshots", recording)
    deliver(spark, tables[0], "child", DATES[1], [("a", "x"), ("a", "x"), (None, "gone")])
    deliver(spark, tables[0], "parent", DATES[0], [("z",)])
    assert results(spark, tables) == whole(spark, tables[0])
    ids = [dates for name, dates, columns in asked if name == "child" and "id" in columns]
    assert ids == [(DATES[1],)], asked


def test_references_are_counted_without_a_join(spark, tables):
    rows = spark.createDataFrame(
        [("d1", "x"), ("d1", "x"), ("d1", "y"), ("d2", "x"), ("d1", None)], "snapshot string, ref string"
    )
    parents = spark.createDataFrame([("d1", "x"), ("d1", "x"), ("d2", "z"), ("d2", None)], "snapshot string, key string")
    check = checks.Check("child", "relationships", "ref", "parent", "key")
    got = history._references(rows, parents, check)
    assert {(r.snapshot, r.failures) for r in got.collect()} == {("d1", 1), ("d2", 1)}
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_a_new_check_is_counted_for_old_snapshots(spark, tables):
    first = history.history_results(spark, tables[0], CHECKS[:1], tables[1])
    assert first == [("child", "not_null", "id", 2)]
    assert results(spark, tables) == whole(spark, tables[0])


def test_columns_that_come_go_and_change_type(spark, tables):
    rows = spark.createDataFrame([(1, 7), (2, None)], "id int, other int")
    raw.append_snapshot(rows, tables[0]["child"], "2024-01-22")
    got = dict((r[:3], r[3]) for r in results(spark, tables))
    assert got["child", "not_null", "ref"] == 1 + 2 and got["child", "not_null", "id"] == 2
    assert got["child", "relationships", "ref"] == 3


def test_counts_written_twice_or_never(spark, tables):
    want = whole(spark, tables[0])
    assert results(spark, (tables[0], tables[1] + "/a")) == want
    # Another run that was not seen has kept the same counts.
    counts = spark.read.schema(history.STORE).parquet(tables[1] + "/a").collect()
    spark.createDataFrame(counts, history.STORE).write.mode("append").parquet(tables[1] + "/a")
    assert results(spark, (tables[0], tables[1] + "/a")) == want


def test_tables_without_snapshots(spark, tmp_path):
    paths = {"child": str(tmp_path / "no"), "parent": str(tmp_path / "nothing")}
    got = history.history_results(spark, paths, CHECKS, str(tmp_path / "counts"))
    assert [r[3] for r in got] == [0] * len(CHECKS)


def test_many_snapshots_are_counted_in_several_jobs(spark, tables, monkeypatch):
    monkeypatch.setattr(history, "TOGETHER", 2)
    assert results(spark, tables) == whole(spark, tables[0])


def test_checks_that_span_snapshots_are_refused(spark, tables):
    with pytest.raises(ValueError):
        history.history_results(spark, tables[0], [checks.Check("child", "unique", "id")], tables[1])
