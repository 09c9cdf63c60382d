"""Dashboard aggregates over the marts.

A report on dimension attributes first adds the facts up per dimension key. The
facts then never travel: partial sums do, one row per key and task, so a key that
holds a third of all crashes weighs no more than any other in the join after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _first_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("crash_count"),
        F.sum("total_injuries_number").alias("injury_count"),
        F.sum("total_fatal_injuries_number").alias("fatal_count"),
    ]


def _sums_of_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("crash_count", "injury_count", "fatal_count")]


def _by_dimension(
    facts: DataFrame, dimension: DataFrame, key: str, attributes: list[str]
) -> DataFrame:
    per_key = facts.groupBy(key).agg(*_first_sums())
    looked_up = per_key.join(dimension.select(key, *attributes), key, "left")
    return looked_up.groupBy(*attributes).agg(*_sums_of_sums())


def trend(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Crashes and injuries by year and month."""
    return _by_dimension(facts, dates, "date_hkey", ["year", "month"])


def rhythm(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Crashes and injuries by weekday and hour with the calendar flags."""
    attributes = ["day_of_week", "hour", "is_weekend", "is_rush_hour", "is_winter"]
    return _by_dimension(facts, dates, "date_hkey", attributes)


def severity(facts: DataFrame) -> DataFrame:
    """Crashes and injuries by severity and first crash type."""
    return facts.groupBy("crash_severity_code", "first_crash_type_code").agg(*_first_sums())


def geography(facts: DataFrame, locations: DataFrame) -> DataFrame:
    """Crashes and injuries by ward and neighborhood; crashes outside all of them
    are the rows without a ward or a neighborhood."""
    return _by_dimension(facts, locations, "location_hkey", ["ward_id", "neighborhood"])


def cause_weather(facts: DataFrame) -> DataFrame:
    """Crashes by contributing cause and weather."""
    return facts.groupBy("primary_cause_explanation", "weather_condition_code").agg(
        F.count(F.lit(1)).alias("crash_count")
    )
