"""What several corpus operators share: stored steps and texts as bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.session import shared_dir

# White space of the contracts: space and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it back. This cuts the lineage: a
    lost executor repeats tasks of one step, and nothing is computed twice."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, id_col: str) -> DataFrame:
    """``_row``, a whole number of its own for each row, ``_key``, which sorts rows by id with
    null ids last and equal ids in any order, and ``_doc``, the columns. What is decided by
    row number holds for that row alone. Whole-number ids that are set and differ in all rows
    serve as they are; else the rows are numbered and stored."""
    whole = isinstance(docs.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType))
    id_, doc = F.col(id_col), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    counts = docs.groupBy(id_.alias("id")).agg(F.count("*").alias("n")).where("n > 1 or id is null") if whole else None
    if whole and counts.isEmpty():
        rows = docs.select(id_.cast("long").alias("_row"), id_.alias("_id"), doc)
    else:
        rows = stored(docs.select(F.monotonically_increasing_id().alias("_row"), id_.alias("_id"), doc), "numbered")
    key = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    return rows.select("_row", key.alias("_key"), "_doc")


def text_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text, empty for null."""
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def release() -> None:
    """Give the memory of batches that are done back to the system. Python workers outlive
    their stage, and what they keep is missing to the next ones."""
    pa.default_memory_pool().release_unused()


def slices(batch: pa.RecordBatch, column: int, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts have about ``limit`` bytes together, so that
    what a task makes of them stays small whatever the rows of a batch."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def ranges(texts: Sequence[bytes | str], limit: int) -> Iterator[tuple[int, int]]:
    """Cut a batch into index ranges whose texts have about ``limit`` bytes together, so
    that work arrays stay small. A longer text is a range of its own."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > limit:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def ascii_lower(col: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
