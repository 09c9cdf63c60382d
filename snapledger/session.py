"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results. They are runtime settings, so use_utc() can
# also apply them to a session somebody else created.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Nanosecond timestamps in Parquet are read as whole numbers instead of refused.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

# Settings that only change speed. AQE picks the join strategy from measured
# sizes, splits skewed join partitions and merges small shuffle partitions.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Rows that travel hold digests and long ids, which only an entropy coder makes smaller.
    "spark.io.compression.codec": "zstd",
    # Wide projections are built from hundreds of calls; do not record the Python
    # stack for each of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "snapledger",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the settings above.

    On a cluster leave ``master`` unset and choose ``shuffle_partitions`` so that
    one shuffle partition is about 200 MB; AQE merges them when there is less
    data. A local master also pins the driver to the loopback address.
    """
    builder = SparkSession.builder.appName(app)
    conf = {**SEMANTIC_CONF, **PLAN_CONF, "spark.ui.enabled": "false"}
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            conf["spark.driver.host"] = "127.0.0.1"
            conf["spark.driver.bindAddress"] = "127.0.0.1"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Apply the result-changing settings to an existing session."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# A runtime setting of Spark 4.1: shuffle files go when the query that wrote them is over.
SHUFFLES_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Free the shuffle files of every query as soon as it is over. Otherwise they stay until
    the driver happens to collect garbage, and a job of many steps holds those of all of them.

    For steps that are run once each: a frame that shuffles and was defined in here must not
    be run a second time.
    """
    before = spark.conf.get(SHUFFLES_FREED, None)
    spark.conf.set(SHUFFLES_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_FREED)
        else:
            spark.conf.set(SHUFFLES_FREED, before)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; where it is unset, the folder
    is below the session's warehouse, which all machines of a cluster share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
