"""Keyed merge of a new build into an accumulated table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from snapledger.operators.quality import not_unique


class DuplicateKeys(ValueError):
    """The source of a merge has several rows for one key."""


def require_unique(df: DataFrame, key: str) -> None:
    """Raise if several rows share a key; a merge with such a source is undefined."""
    if not not_unique(df, key).isEmpty():
        raise DuplicateKeys(f"several source rows share one value of {key}")


def kept_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows the source does not replace. Only the keys of the source travel;
    a NULL key matches nothing, so such rows stay.

    Both sides are shuffled whatever is estimated. The source grows like the target, and the
    estimate is of its compressed file: a broadcast would bring all keys to the driver.
    """
    return target.join(source.select(key).hint("merge"), key, "left_anti").select(*target.columns)


def upsert(target: DataFrame | None, source: DataFrame, key: str) -> DataFrame:
    """Source rows replace target rows with the same key, other source rows are
    added, target rows without a source row stay. Without a target the source is
    the first build.

    The source is evaluated twice, for its rows and for its keys: hand over stored
    rows rather than a long computation.
    """
    if target is None:
        return source
    return source.unionByName(kept_rows(target, source, key), allowMissingColumns=True)
