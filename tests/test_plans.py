"""Physical plans of the named queries, with broadcasts by size switched off."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# These run their jobs when they are called and return a stored result.
STORED = {
    "batch_job", "batch_job_two_dates", "mart_export", "scan_csv", "snapshot_append",
    "merge_repeated", "quality_report_incremental",
}
LAZY = sorted(set(entry.QUERIES) - STORED)


def initial_plan(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.QUERIES[name](spark, SF)
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return text


@pytest.fixture(scope="module")
def plans(spark):
    return {name: initial_plan(spark, name) for name in LAZY}


def test_no_cross_joins_and_no_python(plans):
    for name, text in plans.items():
        for bad in ("NestedLoop", "CartesianProduct", "Python", "Pandas", "CollectLimit"):
            assert bad not in text, (name, bad)


def test_windows_are_of_one_grid_row_one_record_or_one_file(plans):
    """Elsewhere there is none: a window holds its partition in one task."""
    for name, text in plans.items():
        for window in re.findall(r"Window \[(.*)", text):
            grid_row = re.search(r"\[_polygon#\d+L?, _cy#\d+L?\], \[_cx", window)
            record = name == "record_intervals" and re.search(r"\[crash_record_id#\d+, _content#\d+\], \[_number", window)
            # Blocks of a file, or the few totals of its blocks.
            file = name == "geojson_documents" and re.search(r"\], \[file#\d+|\], \[file#\d+, block#\d+L\], \[id", window)
            assert grid_row or record or file, (name, window)


def test_only_single_rows_meet_in_one_task(plans):
    """An exchange to one partition is allowed for partial maxima and counts only."""
    for name, text in plans.items():
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "HashAggregate(keys=[]" in lines[i + 1], (name, lines[i + 1])


def test_crash_fact_is_not_shuffled(plans):
    assert "hashpartitioning" not in plans["fact_crash"]
    assert "SortMergeJoin" in plans["joined_dimension_keys"]


def test_scans_read_only_what_is_needed(plans):
    columns = re.findall(r"ReadSchema: struct<([^>]*)>", plans["report_severity"])
    used = {c.split(":")[0] for line in columns for c in line.split(",")}
    assert "o_totalprice" not in used and "o_orderkey" in used


def test_people_fact_needs_three_joins(plans):
    text = plans["fact_people"]
    assert text.count("SortMergeJoin") == 3
    assert text.count("Exchange hashpartitioning") == 6


def test_checks_read_a_model_once(spark):
    """One pass for all checks on a model itself, two more keys-only sides a reference."""
    from snapledger.plans import checks
    from workload import inputs as I

    frames = {f"raw_{n}": I.raw(spark, SF, n) for n in ("crash", "people", "vehicle")}
    wanted = [c for c in checks.SOURCE_CHECKS if c.model in frames]
    text = checks.report(frames, wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [") == 3 + 2 * 2, text


def test_exported_marts_are_built_from_exported_ones(spark, monkeypatch):
    """No mart is computed a second time for the one that hangs on it."""
    from snapledger.plans import marts

    frames, export = {}, marts.export
    monkeypatch.setattr(marts, "export", lambda f, root: [frames.update(f), export(f, root)][1])
    entry.QUERIES["mart_export"](spark, SF)
    assert set(frames) == set(marts.MARTS)

    def read(mart):
        return {m for m in marts.MARTS for path in frames[mart].inputFiles() if f"/{m}/part-" in path}

    assert read("fact_vehicle") == {"fact_crash"}
    assert read("fact_people") == {"fact_crash", "fact_vehicle"}
    joins = {m: f._jdf.queryExecution().optimizedPlan().toString().count("Join ") for m, f in frames.items()}
    assert (joins["fact_vehicle"], joins["fact_people"]) == (1, 2)
