"""Run named queries in Spark and their SQL in DuckDB and compare all values.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import hashlib
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def canonical(value) -> str:
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (dt.datetime, dt.date, decimal.Decimal)):
        return str(value)
    return repr(value)


def digest(columns: list[str], rows: list[tuple]) -> tuple:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(canonical(r[i]) for i in order) for r in rows)
    text = "\n".join(lines)
    return sorted(columns), len(rows), hashlib.sha256(text.encode()).hexdigest(), lines


TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "INTEGER": "int", "DOUBLE": "double",
         "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp"}


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    mine = digest(df.columns, [tuple(r) for r in df.collect()])
    middle = time.time()
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    theirs = digest(columns, result.fetchall())
    end = time.time()
    mine_types = {k: "timestamp" if v == "timestamp_ntz" else v for k, v in df.dtypes}
    note = f"{mine[1]} rows, spark {middle - start:.2f}s, duckdb {end - middle:.2f}s"
    if mine_types != types:
        return False, f"{note}; types differ: {sorted(set(mine_types.items()) ^ set(types.items()))}"
    if mine[:3] == theirs[:3]:
        return True, note
    extra = [a for a in mine[3] if a not in set(theirs[3])][:3]
    missing = [b for b in theirs[3] if b not in set(mine[3])][:3]
    return False, f"{note}; {theirs[1]} expected\n  only spark: {extra}\n  only sql:   {missing}"


if __name__ == "__main__":
    from snapledger import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(entry.oracle_sql())
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in names:
        try:
            ok, note = compare(spark, con, name, sf)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    sys.exit(1 if bad else 0)
