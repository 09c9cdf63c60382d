import hashlib
import re

from pyspark.sql import functions as F

from snapledger.llm import exact_dedup as E
from tests import compare

DOCS = "doc_id long, text string, keep_id string, kept string"


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), x in zip(rows, norm):
        same = [j for (j, _), y in zip(rows, norm) if y == x]
        keep = min((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(x.encode()).hexdigest()))
    return sorted(out, key=str)


def test_edge_cases_and_clashing_columns(spark):
    texts = ["a b", "a \t\n b", None, "", " ", "\x0b", "é  é", "é é", "x" * 50_000, "a b", "a b"]
    rows = [(i if i != 4 else None, t) for i, t in enumerate(texts)] + [(1, "a  b"), (None, None)]
    d = spark.createDataFrame([(i, t, "k", "no") for i, t in rows], DOCS).repartition(40)
    got = sorted(map(tuple, E.exact_groups(d).collect()), key=str)
    assert got == brute(rows)
    kept = E.drop_exact(d)
    assert kept.columns == d.columns
    want = {r[4] for r in got}
    assert {hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest() for r in kept.collect()} == want


def test_empty(spark):
    assert E.exact_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_hot_text_over_many_runs(spark):
    d = spark.range(0, 6000, 1, 300).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot  text").otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("text"),
    )
    got = E.exact_groups(d)
    assert got.where("keep_id = 0").agg(F.count("*"), F.min("group_size"), F.sum(F.col("kept").cast("int"))).first()[:] == (2000, 2000, 1)
    assert got.where("kept").count() == 501


def test_no_python_in_the_plan(spark):
    plan = E.exact_groups(spark.createDataFrame([(1, "a", "", "")], DOCS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    same, note = compare.compare(spark, compare.connect(sf), "op4_exact_dedup", sf)
    assert same, note


def test_verdicts_hold_for_rows_with_null_or_repeated_ids(spark):
    rows = [(None, "only here"), (None, "a  text"), (None, "a text"), (1, "a text"), (1, "other"), (0, "other"),
            (5, "twice"), (5, "twice"), (5, "twice "), (None, None), (None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(None, "only here"), (1, "a text"), (0, "other"), (5, "twice"), (5, "twice "), (None, None)]
    assert sorted(map(tuple, E.drop_exact(d).collect()), key=str) == sorted(want, key=str)
