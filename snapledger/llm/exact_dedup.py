"""Exact duplicates by a tree merge of digest runs.

Every input partition is one run: its texts' digests, each with the smallest id and a
count. In every round the runs of ``FAN`` neighbouring partitions are exchanged and
merged by digest, until one run is left; only one row per digest and run moves, however
often a text repeats. The verdicts go back down the same tree: a run learns its
survivors from the run it was merged into, so a text that fills a third of the corpus is
never gathered under one key, only once per run.

Rounds are DataFrame groupings (sorted or hashed runs, as Spark chooses), and each level
is a stored table, so a lost executor repeats tasks of one level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import numbered, stored

# Runs merged into one in a round, as a power of two: 16.
FAN_BITS = 4

# Equal texts agree in all three. The digest alone decides in practice; length and a
# second, unrelated hash verify it at every level, since they are part of the key.
KEY = ["_sha", "_len", "_second"]


def normal_text(text: Column) -> Column:
    """Null as empty, every run of white space as one space. Single spaces are left
    alone, so that the pattern only matches where something changes."""
    return F.regexp_replace(
        F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " "
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id column, ``keep_id`` (smallest id among equal
    normalised texts), ``group_size``, ``kept`` and ``text_sha256``.

    Null text counts as empty. A null id never wins against another id; if all ids of a
    group are null, all its rows are kept. Rows that repeat the smallest id of their
    group cannot be told apart and are all kept. An empty table gives no rows. Other
    columns are not read, whatever their names.
    """
    text = normal_text(F.col(text_col))
    rows = stored(
        docs.select(F.col(id_col).alias("_id"), text.alias("_text")).select(
            "_id",
            F.spark_partition_id().cast("long").alias("_run"),
            F.unhex(F.sha2("_text", 256)).alias("_sha"),
            F.octet_length("_text").alias("_len"),
            F.xxhash64("_text").alias("_second"),
        ),
        "digests",
    )
    last = rows.agg(F.max("_run")).first()[0] or 0

    # Up: merge the runs of FAN neighbours, one round after the other.
    parent = F.shiftright("_run", FAN_BITS)
    levels = [rows.withColumns({"_keep": F.col("_id"), "_n": F.lit(1).cast("long")})]
    while True:
        levels.append(
            stored(
                levels[-1]
                .groupBy(parent.alias("_run"), *KEY)
                .agg(F.min("_keep").alias("_keep"), F.sum("_n").alias("_n")),
                "runs",
            )
        )
        last >>= FAN_BITS
        if last == 0:
            break

    # Down: every run takes the verdicts of the run it went into.
    found = levels[-1]
    for level in [*levels[-2:0:-1], rows]:
        mine = level.drop("_keep", "_n").withColumn("_parent", parent)
        theirs = found.select(F.col("_run").alias("_parent"), *KEY, "_keep", "_n")
        found = mine.join(theirs, ["_parent", *KEY]).drop("_parent")
    return found.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: of equal texts exactly one, with
    the smallest id. Null ids come last, and of rows that share the smallest id any one stays,
    whatever their other columns hold."""
    rows = numbered(docs, id_col)
    groups = exact_groups(rows.select("_key", F.col("_doc")[text_col].alias("_text")), "_key", "_text")
    dropped = groups.where(~F.col("kept")).select(F.col("_key.row").alias("_row"))
    return rows.join(dropped, "_row", "left_anti").select("_doc.*")


EXACT_SQL = r"""
    with t as (
        select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as x
        from documents
    )
    select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
        doc_id is not distinct from min(doc_id) over w as kept, sha256(x) as text_sha256
    from t
    window w as (partition by x)
"""
