"""Data checks. Each returns the violating rows (or groups); none means passed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.operators.joins import missing_parent
from snapledger.operators.snapshot import SNAPSHOT


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values held by several rows, with the number of rows; NULLs do not count."""
    rows = df
    for column in columns:
        rows = rows.where(F.col(column).isNotNull())
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def not_unique_in_snapshot(df: DataFrame, column: str, snapshot: str = SNAPSHOT) -> DataFrame:
    """Ids held by several rows of one snapshot. NULL ids form a group, too."""
    return (
        df.groupBy(F.col(column).alias("record_id"), snapshot)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .where("record_count > 1")
    )


def no_parent(
    df: DataFrame, column: str, parent: DataFrame, field: str, within: str | None = None
) -> DataFrame:
    """Rows whose reference is set but leads nowhere."""
    return missing_parent(df, parent, column, field, within)
