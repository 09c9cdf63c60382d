"""Calendar parts and flags of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day numbers (1 = Sunday), month numbers, hours.
WEEKEND_DAYS = [1, 7]
WINTER_MONTHS = [12, 1, 2]
RUSH_HOURS = [7, 8, 9, 16, 17, 18]


def week_sunday(col: Column) -> Column:
    """Week of the year, weeks starting on Sunday; the days before the first
    Sunday are week 0."""
    return F.floor((F.dayofyear(col) + 7 - F.dayofweek(col)) / 7)


def in_list(col: Column, values: list[int]) -> Column:
    """Membership that is false, not NULL, for a NULL input."""
    return F.coalesce(col.isin(values), F.lit(False))


def date_parts(col: Column) -> dict[str, Column]:
    parts = {
        "year": F.year(col),
        "month": F.month(col),
        "quarter": F.quarter(col),
        "week": week_sunday(col),
        "day": F.dayofmonth(col),
        "day_of_week": F.dayofweek(col),
        "hour": F.hour(col),
    }
    return {name: part.cast("bigint") for name, part in parts.items()}


def calendar_flags(col: Column) -> dict[str, Column]:
    return {
        "is_weekend": in_list(F.dayofweek(col), WEEKEND_DAYS),
        "is_winter": in_list(F.month(col), WINTER_MONTHS),
        "is_rush_hour": in_list(F.hour(col), RUSH_HOURS),
    }
