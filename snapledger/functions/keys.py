"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for NULL inside a key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """Hex md5 over the values as text, joined by '-'. Never NULL."""
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
        for c in cols
    ]
    return F.md5(F.concat_ws("-", *texts))


def location_key(latitude: Column, longitude: Column) -> Column:
    """Key of a coordinate pair. Adding 0.0 turns -0.0 into 0.0, which are the
    same place to a join but not the same text."""
    return surrogate_key(latitude + F.lit(0.0), longitude + F.lit(0.0))


# More than a digest is long, so that no other text is taken for one.
_NO_DIGEST = " " * 17


def packed_key(key: Column) -> Column:
    """A text key for a shuffle: hex digests in half the bytes, any other text as it is."""
    return F.when(key.rlike(r"\A[0-9a-f]{32}\z"), F.unhex(key)).otherwise(
        F.concat(key, F.lit(_NO_DIGEST)).cast("binary")
    )


def unpacked_key(packed: Column) -> Column:
    """The text of a :func:`packed_key`."""
    text = F.substring(packed, F.lit(1), F.length(packed) - F.lit(len(_NO_DIGEST))).cast("string")
    return F.when(F.length(packed) == 16, F.lower(F.hex(packed))).otherwise(text)
