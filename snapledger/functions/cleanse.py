"""Cleansing expressions used by the staging and refined models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_to_null(col: Column) -> Column:
    """'' becomes NULL. Whitespace is content and stays."""
    return F.nullif(col, F.lit(""))


def yes_no_to_boolean(col: Column) -> Column:
    """y/n in either case become true/false; anything else is NULL."""
    answer = F.lower(col)
    return F.when(answer == "y", F.lit(True)).when(answer == "n", F.lit(False))


def sentinel_to_null(col: Column, sentinel: str) -> Column:
    """The given word (in any case) becomes NULL."""
    return F.when(F.lower(col) != sentinel, col)


def category_flag(col: Column, clear_value: str, clear_is: bool = False) -> Column:
    """Three-valued flag: NULL and 'unknown' give NULL, ``clear_value`` gives
    ``clear_is``, every other category (also '') gives the opposite."""
    word = F.lower(col)
    return F.when(word != "unknown", (word == clear_value) == F.lit(clear_is))


def to_bigint(col: Column, source_type: T.DataType) -> Column:
    """Integer cast that rounds fractions half away from zero (Spark's own cast
    truncates). Text that is no integer raises under ANSI mode."""
    if isinstance(source_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        col = F.round(col)
    return col.cast("bigint")


def nanos_to_timestamp(col: Column) -> Column:
    """Epoch nanoseconds to a timestamp with millisecond precision."""
    return F.timestamp_millis(F.call_function("div", col, F.lit(1_000_000)))
