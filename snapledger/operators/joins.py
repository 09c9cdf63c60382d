"""Equi-joins of facts with their dimensions and parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys a sketch of the left side follows, and how many of them are taken for hot at most.
SKETCHED_KEYS = 10_000
HOT_KEYS = 1_000

def left_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    take: dict[str, str],
    spread_by: str | None = None,
) -> DataFrame:
    """Left join adding the columns ``take`` ({new name: right column}).

    ``on`` maps left key columns to right key columns. All matches are kept, and a
    NULL key matches nothing. Only keys and taken columns of the right side travel.

    Hash partitioning sends all rows whose key is NULL to one task. Those rows can
    be a large share of a fact table, so a second key spreads them by the value of
    ``spread_by`` (any column with many values); rows with a key always have 0
    there, on both sides. Hot non-NULL keys are left to adaptive execution, which
    splits the left side of a skewed shuffle partition for this join type, given that
    the right side is shuffled as it is: a stored table rather than an aggregate.

    Both sides are shuffled whatever is estimated. The right side is a table that grows like
    the left one, and the estimate is of its compressed file: a broadcast would go through
    the driver until the table is too large for it.
    """
    keys = {f"_r{i}": r for i, r in enumerate(on.values())}
    slim = right.select(
        *[F.col(r).alias(k) for k, r in keys.items()],
        *[F.col(c).alias(name) for name, c in take.items()],
    )
    if spread_by is not None:
        has_key = _all(F.col(l).isNotNull() for l in on)
        group = F.xxhash64(spread_by)
        left = left.withColumn("_lg", F.when(has_key, F.lit(0)).otherwise(group))
        # Not a plain literal: the optimizer would fold it out of the join key.
        slim = slim.withColumn("_rg", F.when(F.col("_r0").isNotNull(), F.lit(0).cast("bigint")))
    slim = slim.hint("merge")
    condition = _all(left[l] == slim[k] for l, k in zip(on, keys))
    if spread_by is not None:
        condition = condition & (left["_lg"] == slim["_rg"])
    return left.join(slim, condition, "left").drop("_lg", "_rg", *keys)


def hot_keys(df: DataFrame, on: list[str], pieces: int) -> DataFrame:
    """``_hot, _pieces`` for the hash of every key that may hold over half of an even share of
    the rows, when they are dealt to ``pieces`` tasks: into how many pieces its rows should go.

    One pass with a frequent-items sketch per task, ``SKETCHED_KEYS`` counters each, whatever
    the number of keys; its counts are never too low for a key it lists, and a key above one
    in ``SKETCHED_KEYS`` of the rows is always listed. At most ``HOT_KEYS`` rows come out.
    """
    sketch = df.where(_all(F.col(c).isNotNull() for c in on)).select(F.xxhash64(*on).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {HOT_KEYS}, {SKETCHED_KEYS})").alias("_top"),
        F.count(F.lit(1)).alias("_rows"),
    )
    found = sketch.select("_rows", F.inline("_top")).toDF("_rows", "_hot", "_count")
    share = F.ceil(F.col("_count") * F.lit(2 * pieces) / F.col("_rows")).cast("int")
    return found.where(F.col("_hot").isNotNull()).select("_hot", share.alias("_pieces")).where("_pieces > 1")


def split_left_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    take: dict[str, str],
    spread_by: str,
    pieces: int | None = None,
) -> DataFrame:
    """The same rows as :func:`left_join`, with hot keys split by the join itself.

    Rows of a hot key are dealt into pieces by ``spread_by`` and meet as many copies of the
    right rows with that key; all others meet one. This needs no stored right side: it also
    holds where the right side is an aggregate, which adaptive execution does not split.
    The left side is read once more, for its keys alone. The hot keys are broadcast: at most
    ``HOT_KEYS`` rows of two numbers. Two keys with one hash are split alike, no more.
    """
    if pieces is None:
        pieces = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left, list(on), pieces))
    keys = {f"_r{i}": r for i, r in enumerate(on.values())}
    slim = right.select(
        *[F.col(r).alias(k) for k, r in keys.items()],
        *[F.col(c).alias(name) for name, c in take.items()],
    )
    slim = slim.where(_all(F.col(k).isNotNull() for k in keys))
    slim = slim.withColumn("_h", F.xxhash64(*keys)).join(hot, F.col("_h") == F.col("_hot"), "left")
    numbers = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_pieces", F.lit(1)).cast("bigint") - 1)
    slim = slim.withColumn("_rg", F.explode(numbers)).drop("_h", "_hot", "_pieces")
    # Rows without a key match nothing: any piece will do.
    has_key = _all(F.col(c).isNotNull() for c in on)
    spread = F.xxhash64(spread_by)
    dealt = left.withColumn("_h", F.when(has_key, F.xxhash64(*on))).join(hot, F.col("_h") == F.col("_hot"), "left")
    piece = F.when(has_key, F.pmod(spread, F.coalesce("_pieces", F.lit(1)))).otherwise(spread)
    dealt = dealt.withColumn("_lg", piece).drop("_h", "_hot", "_pieces")
    condition = _all(dealt[l] == slim[k] for l, k in zip(on, keys)) & (dealt["_lg"] == slim["_rg"])
    return dealt.join(slim, condition, "left").drop("_lg", "_rg", *keys)


def missing_parent(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, within: str | None = None
) -> DataFrame:
    """Child rows whose key is set but has no parent row (anti join). With
    ``within`` the parent must also agree on that column, e.g. the snapshot."""
    pairs = {child_key: parent_key, **({within: within} if within else {})}
    parents = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(pairs.values())])
    rows = child.where(F.col(child_key).isNotNull())
    condition = _all(rows[c] == parents[f"_p{i}"] for i, c in enumerate(pairs))
    return rows.join(parents, condition, "left_anti")


def count_missing_parent(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, within: str | None = None
) -> DataFrame:
    """Number of child rows without a parent, as the single row ``n``. Both sides are
    reduced to their distinct keys before they are shuffled, so neither a parent with
    many children nor a repeated parent weighs on the join."""
    pairs = {child_key: parent_key, **({within: within} if within else {})}
    names = {f"_p{i}": pair for i, pair in enumerate(pairs.items())}
    children = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(*[F.col(c).alias(n) for n, (c, _) in names.items()])
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    parents = parent.select(*[F.col(p).alias(n) for n, (_, p) in names.items()]).distinct()
    missing = children.join(parents, list(names), "left_anti")
    return missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))


def _all(conditions) -> Column:
    result = None
    for condition in conditions:
        result = condition if result is None else result & condition
    return result
