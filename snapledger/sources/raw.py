"""Raw snapshot tables: Parquet, one ``partition_date=<date>`` folder per snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.operators.snapshot import SNAPSHOT, ensure_column, stamp_snapshot
from snapledger.sources.folders import STORED, dated_values


def append_snapshot(df: DataFrame, path: str, run_date: str | dt.date) -> None:
    """Add one full snapshot, stamped with its run date, to the history. Only the
    folder of this date is written, so running a date again replaces that snapshot
    instead of doubling it, also by an empty one, and no older file is touched."""
    if SNAPSHOT not in df.columns:
        # All rows are of the run date.
        df.write.mode("overwrite").options(**STORED).parquet(f"{path}/{SNAPSHOT}={_iso(run_date)}")
        return
    (
        stamp_snapshot(df, run_date)
        .write.mode("overwrite")
        .options(**STORED)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT)
        .parquet(path)
    )


def _iso(run_date: str | dt.date) -> str:
    return dt.date.fromisoformat(str(run_date)).isoformat()


def replace_snapshot(df: DataFrame, path: str, run_date: str | dt.date) -> None:
    """Throw the old content away and keep this snapshot only."""
    (
        stamp_snapshot(df, run_date)
        .write.mode("overwrite")
        .options(**STORED)
        .option("partitionOverwriteMode", "static")
        .partitionBy(SNAPSHOT)
        .parquet(path)
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The whole history; columns added over time are NULL in older snapshots."""
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    return ensure_column(rows).withColumn(SNAPSHOT, ensure_column(rows)[SNAPSHOT].cast("date"))


def snapshot_dates(spark: SparkSession, path: str) -> list[str]:
    return dated_values(spark, path, SNAPSHOT)


def read_history(spark: SparkSession, path: str, as_of: str | dt.date | None = None) -> DataFrame:
    """All snapshots (up to ``as_of``) with the columns of the newest of them. No footer
    of an older file is opened to define it, and only the columns that are used are read."""
    newest = read_snapshot(spark, path, as_of)
    rows = spark.read.schema(newest.schema).parquet(path)
    return rows if as_of is None else rows.where(F.col(SNAPSHOT) <= F.lit(str(as_of)).cast("date"))


def read_snapshot(spark: SparkSession, path: str, as_of: str | dt.date | None = None) -> DataFrame:
    """The newest snapshot (up to ``as_of``). The date comes from the folder names
    and only that folder is opened: files of older snapshots are neither listed nor
    read, however long the history is."""
    dates = [d for d in snapshot_dates(spark, path) if as_of is None or d <= str(as_of)]
    if not dates:
        raise FileNotFoundError(f"no snapshot in {path}" + (f" up to {as_of}" if as_of else ""))
    rows = spark.read.option("basePath", path).parquet(f"{path}/{SNAPSHOT}={dates[-1]}")
    return rows.withColumn(SNAPSHOT, rows[SNAPSHOT].cast("date"))
