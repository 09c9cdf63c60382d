"""Snapshot stamping and selection on a ``partition_date`` column."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SNAPSHOT = "partition_date"


def ensure_column(df: DataFrame, name: str = SNAPSHOT, dtype: str = "date") -> DataFrame:
    """Add a NULL column unless it is there already."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def stamp_snapshot(df: DataFrame, run_date: str | dt.date, name: str = SNAPSHOT) -> DataFrame:
    """Put the run date where no snapshot date is set yet."""
    stamped = F.coalesce(F.col(name), F.lit(str(run_date)).cast("date"))
    return ensure_column(df, name).withColumn(name, stamped)


def latest_snapshot(df: DataFrame, name: str = SNAPSHOT) -> DataFrame:
    """Rows of the newest snapshot; nothing if there is no dated row.

    The maximum is a scalar subquery, so on a dataset partitioned by ``name`` it
    becomes a partition filter of the outer scan.
    """
    newest = df.agg(F.max(name)).scalar()
    return df.where(F.col(name) == newest)


def snapshot_as_of(df: DataFrame, as_of: str | dt.date, name: str = SNAPSHOT) -> DataFrame:
    """Rows of the newest snapshot that is not later than ``as_of``."""
    limit = F.lit(str(as_of)).cast("date")
    newest = df.where(F.col(name) <= limit).agg(F.max(name)).scalar()
    return df.where(F.col(name) == newest)


def current_only(df: DataFrame, name: str = SNAPSHOT) -> DataFrame:
    """Of an accumulating table, only what the newest snapshot brought or renewed."""
    return latest_snapshot(df, name)


def snapshot_history(df: DataFrame, key: str, name: str = SNAPSHOT) -> DataFrame:
    """Rows and distinct keys per snapshot. Keys are first grouped per snapshot,
    which spreads a snapshot's rows over all tasks and leaves one number per
    (snapshot, key) to add up."""
    per_key = df.groupBy(name, key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(name).agg(
        F.sum("n").alias("row_count"), F.count(key).alias("key_count")
    )


def record_versions(
    df: DataFrame, key: str, content: list[str], name: str = SNAPSHOT
) -> DataFrame:
    """For every record: in how many snapshots it appears, the first and the last
    of them, and how many different contents it had. Contents are compared by their
    columns, NULL being a value like any other."""
    seen = df.groupBy(key, F.struct(*content).alias("content")).agg(
        F.count(F.lit(1)).alias("n"), F.min(name).alias("lo"), F.max(name).alias("hi")
    )
    return seen.groupBy(key).agg(
        F.sum("n").alias("snapshot_count"),
        F.min("lo").alias("first_snapshot"),
        F.max("hi").alias("last_snapshot"),
        F.count(F.lit(1)).alias("version_count"),
    )


def record_intervals(
    df: DataFrame, key: str, content: list[str], name: str = SNAPSHOT
) -> DataFrame:
    """The versions of every record over time: the key, the content, ``valid_from`` and
    ``valid_to`` (first and last snapshot of an unbroken run with that content),
    ``snapshot_count``, and ``next_snapshot``, the one in which it was first gone or changed
    (NULL for what is still there).

    A content that comes back after another one, or after the record was missing from a
    snapshot, is a version of its own. Snapshots are those of the whole table, so a snapshot
    in which a record is missing is noticed. A record that repeats within a snapshot has
    parallel versions, one for each content, and equal rows count once. NULL is a key and a
    content like any other; rows without a snapshot date belong to none.

    Runs are islands in the order of the snapshots: a record's versions are numbered by
    snapshot, and as long as both numbers grow alike the run goes on. Only rows of one record
    and content meet, one for each snapshot. The list of snapshots is one row.
    """
    dated = df.where(F.col(name).isNotNull())
    snapshots = dated.agg(F.sort_array(F.collect_set(name)).alias("_all")).scalar()
    seen = dated.select(F.col(key), F.struct(*content).alias("_content"), name).distinct()
    of = Window.partitionBy(key, "_content").orderBy("_number")
    islands = seen.withColumn("_number", F.array_position(snapshots, F.col(name)).cast("int")).withColumn(
        "_island", F.col("_number") - F.row_number().over(of)
    )
    runs = islands.groupBy(key, "_content", "_island").agg(
        F.min(name).alias("valid_from"),
        F.max(name).alias("valid_to"),
        F.count(F.lit(1)).alias("snapshot_count"),
        F.max("_number").alias("_last"),
    )
    following = F.get(snapshots, F.col("_last")).alias("next_snapshot")
    return runs.select(key, "_content.*", "valid_from", "valid_to", "snapshot_count", following)


def versions_of(df: DataFrame, condition: Column, name: str = SNAPSHOT) -> DataFrame:
    """All snapshot rows of the chosen record(s), oldest first."""
    return df.where(condition).orderBy(name)
