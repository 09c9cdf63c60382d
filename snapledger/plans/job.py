"""The batch job: feeds of one run date to checked marts."""

from __future__ import annotations

import datetime as dt
import functools
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger import schemas
from snapledger.functions.geometry import morton_key
from snapledger.operators.snapshot import current_only
from snapledger.operators.upsert import DuplicateKeys
from snapledger.plans import checks, history, refined, staging
from snapledger.plans.marts import marts
from snapledger.session import shared_dir, shuffles_freed, use_utc
from snapledger.sources import feeds as feed_io
from snapledger.sources import geojson, raw, tables
from snapledger.sources.folders import STORED

# Refined table -> its merge key.
KEYS = {
    "refined_dim_datetime": "date_hkey",
    "refined_dim_location": "location_hkey",
    "refined_ward": "ward_hkey",
    "refined_neighborhood": "neighborhood_hkey",
    "refined_fact_crash": "crash_hkey",
    "refined_fact_vehicle": "vehicle_hkey",
    "refined_fact_people": "person_hkey",
}

# Tables stored in an order by which files can be skipped: times by the clock, places along a
# curve, so that a file holds the places of a small area.
ORDER = {
    "refined_dim_datetime": lambda: F.col("crash_datetime"),
    "refined_dim_location": lambda: morton_key(F.col("longitude"), F.col("latitude")),
}


@dataclass
class Build:
    """Frames read back from storage, and one result row per declared check."""

    raw: dict[str, DataFrame] = field(default_factory=dict)
    refined: dict[str, DataFrame] = field(default_factory=dict)
    marts: dict[str, DataFrame] = field(default_factory=dict)
    results: list[tuple] = field(default_factory=list)


def load(
    spark: SparkSession,
    run_date: str | dt.date,
    paths: dict[str, str],
    root: str,
    infer_types: bool = False,
    multi_line_geojson: bool = True,
) -> None:
    """Land the given feeds (dataset name -> path) and bring them into the raw
    tables: incident feeds are appended, boundary sets are replaced. A boundary set of
    an earlier date than the stored one is landed, but does not replace it."""
    use_utc(spark)
    landing, tables_root = f"{root}/landing", f"{root}/raw"
    unknown = set(paths) - set(schemas.FEEDS) - set(schemas.BOUNDARIES)
    if unknown:
        raise ValueError(f"unknown datasets {sorted(unknown)}")

    def load_one(name: str) -> None:
        if name in schemas.FEEDS:
            types = None if infer_types else schemas.FEEDS[name]
            landed = feed_io.csv_to_parquet(
                spark, paths[name], landing, name, run_date, types
            )
            rows = feed_io.read_landed(spark, landed)
            raw.append_snapshot(rows, f"{tables_root}/{name}", run_date)
        else:
            features = geojson.scan_geojson(spark, paths[name], multi_line_geojson)
            properties = geojson.all_properties(features, schemas.BOUNDARIES[name])
            landed = feed_io.landing_path(landing, name, run_date)
            geojson.write_ndjson(geojson.flatten_features(features, properties), landed)
            path = f"{tables_root}/{name}"
            if all(d <= str(run_date) for d in raw.snapshot_dates(spark, path)):
                rows = geojson.read_ndjson(spark, landed, properties.add("geometry", "string"))
                raw.replace_snapshot(rows, path, run_date)

    _all_at_once(load_one, list(paths))


def _all_at_once(action, names: list) -> list:
    """Submit independent Spark jobs together, so that the small ones fill the gaps
    of the large ones; returns when all are done and raises the first error."""
    with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
        return list(pool.map(action, names))


def _frees_shuffles(step):
    """A step of the job whose result needs no shuffle, as all its frames are stored."""

    @functools.wraps(step)
    def run_step(spark: SparkSession, *args, **options):
        with shuffles_freed(spark):
            return step(spark, *args, **options)

    return run_step


@_frees_shuffles
def transform(
    spark: SparkSession,
    run_date: str | dt.date,
    root: str,
    strict: bool = True,
    current_boundaries: bool = False,
    cell: float = refined.CELL,
) -> Build:
    """Build and check all layers from the newest raw snapshots up to the run date. Raw
    tables are checked with all their snapshots up to that date; what was counted in an
    unchanged snapshot by an earlier run is not counted again.

    Every refined table is written before the next one reads it, so a lost executor
    repeats tasks of one table and not the whole chain. Checks run layer by layer;
    with ``strict`` a failure stops the build before anything depends on it.
    ``current_boundaries`` uses only the newest version of each boundary set.
    """
    use_utc(spark)
    build = Build()
    merged: set[str] = set()
    attempts: dict[str, tables.Attempt] = {}

    def check(*names: str) -> None:
        """Check tables, and let later runs see the ones that were stored."""
        wanted = [c for c in checks.ALL_CHECKS if c.model in names]
        report = checks.with_mart_results(checks.report(build.refined, wanted))
        found = [tuple(row) for row in report.collect()]
        build.results += found
        repeated = [r[0] for r in found if r[1] == "unique" and r[3] and r[0] in merged]
        if repeated:
            raise DuplicateKeys(f"several source rows share one key in {', '.join(repeated)}")
        if strict:
            checks.enforce(found)
        failed = {r[0] for r in found if r[3]}
        for name in names:
            if name in attempts and name not in failed:
                attempts[name].mark_checked(spark)

    def merge(name: str, source: DataFrame) -> DataFrame:
        path = f"{root}/refined/{name}"
        if tables.read_version(spark, path, before=run_date) is not None:
            merged.add(name)
        order = ORDER[name]() if name in ORDER else None
        attempts[name] = tables.write_attempt(source, path, KEYS[name], run_date, order)
        build.refined[name] = attempts[name].read(spark)
        return build.refined[name]

    for name in staging.MODELS:
        path = f"{root}/raw/{name}"
        # Only the newest boundary set is stored, so an earlier run date uses that, too.
        as_of = None if name in schemas.BOUNDARIES else run_date
        build.raw[name] = raw.read_snapshot(spark, path, as_of)
    paths = {f"raw_{name}": f"{root}/raw/{name}" for name in staging.MODELS}
    limits = {f"raw_{name}": run_date for name in schemas.FEEDS}
    found = history.history_results(spark, paths, checks.SOURCE_CHECKS, f"{root}/checks/raw", limits)
    build.results += found
    if strict:
        checks.enforce(found)
    staged = {name: staging.rename_and_type(build.raw[name], name) for name in staging.MODELS}

    independent = {
        "refined_dim_datetime": refined.dim_datetime(staged["crash"]),
        "refined_dim_location": refined.dim_location(staged["crash"]).orderBy(
            ORDER["refined_dim_location"]()
        ),
        "refined_ward": refined.ward(staged["ward"]),
        "refined_neighborhood": refined.neighborhood(staged["neighborhood"]),
    }
    _, locations, wards, hoods = _all_at_once(
        lambda name: merge(name, independent[name]), list(independent)
    )
    if current_boundaries:
        wards, hoods = current_only(wards), current_only(hoods)
    # Built anew from all locations by every run, and stored so that the boundary join runs once.
    enriched = "refined_dim_location_enriched"
    rows = refined.dim_location_enriched(locations, wards, hoods, cell)
    attempts[enriched] = tables.write_attempt(rows, f"{root}/refined/{enriched}", None, run_date)
    build.refined[enriched] = attempts[enriched].read(spark)
    check(*build.refined)

    # A location in several boundaries of one kind has several rows. The keys can be
    # computed in place only if there is none; else the crashes are joined with the rows.
    several = any(r[:2] == (enriched, "unique") and r[3] for r in build.results)
    places = build.refined[enriched] if several else None
    crashes = merge("refined_fact_crash", refined.fact_crash(staged["crash"], locations=places))
    check("refined_fact_crash")
    vehicles = merge("refined_fact_vehicle", refined.fact_vehicle(staged["vehicle"], crashes))
    check("refined_fact_vehicle")

    def store(rows: DataFrame) -> DataFrame:
        path = shared_dir(spark, "people")
        rows.write.options(**STORED).parquet(path)
        return spark.read.parquet(path)

    # In two steps, so that the shuffles of the first are gone when the second one runs.
    people = refined.fact_people(staged["people"], crashes, vehicles, store)
    merge("refined_fact_people", people)
    check("refined_fact_people")

    build.marts = marts(build.refined)
    return build


def run(
    spark: SparkSession,
    run_date: str | dt.date,
    paths: dict[str, str],
    root: str,
    **options,
) -> Build:
    """Load the feeds of a run date, then build and check everything."""
    use_utc(spark)
    load_options = {
        k: options.pop(k) for k in ("infer_types", "multi_line_geojson") if k in options
    }
    load(spark, run_date, paths, root, **load_options)
    return transform(spark, run_date, root, **options)
