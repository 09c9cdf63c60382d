"""The declared data checks, and running them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.functions.keys import packed_key
from snapledger.operators import quality as Q
from snapledger.operators.joins import count_missing_parent
from snapledger.operators.snapshot import SNAPSHOT
from snapledger.plans.marts import MARTS


@dataclass(frozen=True)
class Check:
    model: str
    kind: str  # not_null, unique, unique_id_partition, relationships
    column: str
    to: str | None = None
    field: str | None = None


def _source(model: str, key: str, *required: str) -> list[Check]:
    return [
        Check(model, "not_null", key),
        Check(model, "unique_id_partition", key),
        *[Check(model, "not_null", column) for column in required],
    ]


def _keyed(model: str, key: str) -> list[Check]:
    return [Check(model, "unique", key), Check(model, "not_null", key)]


SOURCE_CHECKS = [
    *_source("raw_crash", "crash_record_id"),
    *_source("raw_people", "person_id", "crash_record_id"),
    Check("raw_people", "relationships", "crash_record_id", "raw_crash", "crash_record_id"),
    Check("raw_people", "relationships", "vehicle_id", "raw_vehicle", "vehicle_id"),
    *_source("raw_vehicle", "crash_unit_id", "crash_record_id"),
    *_source("raw_ward", "ward_id", "geometry"),
    *_source("raw_neighborhood", "pri_neigh", "geometry"),
]

DATE_COLUMNS = ["year", "month", "day", "quarter", "week", "day_of_week", "is_weekend", "is_winter"]

REFINED_CHECKS = [
    *_keyed("refined_dim_datetime", "crash_datetime"),
    *[Check("refined_dim_datetime", "not_null", column) for column in DATE_COLUMNS],
    *_keyed("refined_dim_location", "location_hkey"),
    *_keyed("refined_ward", "ward_hkey"),
    *_keyed("refined_neighborhood", "neighborhood_hkey"),
    *_keyed("refined_dim_location_enriched", "location_hkey"),
    *_keyed("refined_fact_crash", "crash_hkey"),
    *_keyed("refined_fact_people", "person_hkey"),
    *_keyed("refined_fact_vehicle", "vehicle_hkey"),
]

MART_CHECKS = [
    *_keyed("fact_crash", "crash_hkey"),
    *_keyed("fact_people", "person_hkey"),
    *_keyed("fact_vehicle", "vehicle_hkey"),
    *_keyed("dim_location", "location_hkey"),
]

ALL_CHECKS = SOURCE_CHECKS + REFINED_CHECKS + MART_CHECKS

COLUMNS = ["model", "check", "column", "failures"]


class ChecksFailed(RuntimeError):
    def __init__(self, failed: list[tuple]):
        self.failed = failed
        lines = ", ".join(f"{m}.{c} {k}: {n}" for m, k, c, n in failed)
        super().__init__(f"data checks failed: {lines}")


def report(frames: dict[str, DataFrame], checks: list[Check] = ALL_CHECKS) -> DataFrame:
    """``model, check, column, failures`` for every check whose model is given.

    A model is read once for all checks on itself: its key is grouped (within the
    snapshot, if that is what is declared), and the groups carry the counts of missing
    values in the other columns. Only references take further passes, over keys alone.
    """
    checks = [c for c in checks if c.model in frames]
    parts, done = [], set()
    for model in dict.fromkeys(c.model for c in checks):
        own = [c for c in checks if c.model == model]
        keys = [c for c in own if c.kind in ("unique", "unique_id_partition")]
        required = sorted(c.column for c in own if c.kind == "not_null")
        if keys:
            parts.append(_key_counts(frames[model], keys[0], required))
            done.add(keys[0])
        elif required:
            parts.append(_null_counts(frames[model], model, required))
    for check in checks:
        if check.kind != "not_null" and check not in done:
            failures = _failures(check, frames)
            parts.append(_result(failures, check.model, check.kind, check.column))
    return reduce(DataFrame.unionByName, parts).select(*COLUMNS)


def _failures(check: Check, frames: dict[str, DataFrame]) -> DataFrame:
    if check.kind == "relationships":
        child, parent = frames[check.model], frames[check.to]
        count = count_missing_parent(child, parent, check.column, check.field, within=SNAPSHOT)
        return count.select(F.col("n").alias("failures"))
    return violations(check, frames).agg(F.count(F.lit(1)).alias("failures"))


def _result(failures: DataFrame, model: str, kind: str, column: str) -> DataFrame:
    labels = {"model": model, "check": kind, "column": column}
    return failures.select(*[F.lit(v).alias(k) for k, v in labels.items()], "failures")


def violations(check: Check, frames: dict[str, DataFrame]) -> DataFrame:
    """The violating rows or groups of one check. References are looked up within
    the same snapshot."""
    df = frames[check.model]
    if check.kind == "not_null":
        return Q.is_null(df, check.column)
    if check.kind == "unique":
        return Q.not_unique(df, check.column)
    if check.kind == "unique_id_partition":
        return Q.not_unique_in_snapshot(df, check.column)
    if check.kind == "relationships":
        return Q.no_parent(df, check.column, frames[check.to], check.field, within=SNAPSHOT)
    raise ValueError(f"unknown check {check.kind}")


def _null_counts(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    counts = [
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("failures"))
        for c in columns
    ]
    rows = df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
    return rows.select(
        F.lit(model).alias("model"), F.lit("not_null").alias("check"), "column", "failures"
    )


def _key_counts(df: DataFrame, key: Check, required: list[str]) -> DataFrame:
    """Values of the key held by several rows, and rows without a value in the required
    columns, from one grouping by the key. Within a snapshot, rows without an id are a
    group like any other."""
    by_snapshot = key.kind == "unique_id_partition"
    # Keys that are digests travel in half the bytes; equal keys stay equal, others apart.
    value = F.col(key.column)
    if key.column.endswith("_hkey") and dict(df.dtypes)[key.column] == "string":
        value = packed_key(value)
    groups = df.groupBy(value.alias("v"), *([SNAPSHOT] if by_snapshot else [])).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(required)],
    )
    repeated = F.col("n") > 1
    if not by_snapshot:
        repeated = F.col("v").isNotNull() & repeated

    def row(kind: str, column: str, failures):
        return F.struct(
            F.lit(kind).alias("check"), F.lit(column).alias("column"), failures.alias("failures")
        )

    counts = groups.agg(
        F.array(
            row(key.kind, key.column, F.count_if(repeated)),
            *[
                row("not_null", c, F.coalesce(F.sum(f"m{i}"), F.lit(0)))
                for i, c in enumerate(required)
            ],
        ).alias("counts")
    )
    return counts.select(F.inline("counts")).select(
        F.lit(key.model).alias("model"), "check", "column", "failures"
    )


def with_mart_results(results: DataFrame) -> DataFrame:
    """Add the results of the mart checks. A mart shows a refined table unchanged, so
    they are the results of that table and nothing is scanned again."""
    mart = F.coalesce(
        *[
            F.when(
                (F.col("model") == MARTS[c.model])
                & (F.col("check") == c.kind)
                & (F.col("column") == c.column),
                F.lit(c.model),
            )
            for c in MART_CHECKS
        ]
    )
    names = F.array_compact(F.array("model", mart))
    return results.select(F.explode(names).alias("model"), *COLUMNS[1:])


def enforce(results: list[tuple]) -> None:
    """Raise if any result row has failures. There is one row per declared check."""
    failed = [tuple(r) for r in results if r[3]]
    if failed:
        raise ChecksFailed(failed)
