import hashlib
import random
import re

import pytest

from snapledger.llm import decontaminate as D
from snapledger.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(text)


def brute(text, items, window):
    doc = words(text)
    hit, names = set(), set()
    for name, item in items:
        w = words(item)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            for j in range(len(doc) - k + 1):
                if doc[j : j + k] == w[i : i + k]:
                    hit.update(range(j, j + k))
                    if name is not None:
                        names.add(str(name))
    return len(doc), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def report(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {r[0]: tuple(r)[1:] for r in D.contamination_report(d, b, **options).collect()}


@pytest.mark.parametrize("block", [12, 40, 100_000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed, block):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(["a", "B", "c", "é", "d!"]) for _ in range(n))
    items = [(i, say(rng.randint(0, 25))) for i in range(6)] + [(9, None), (None, say(12)), (2, say(8))]
    docs = [(i, say(rng.randint(0, 80)) + "," + (items[i % 6][1] or "")) for i in range(30)]
    docs += [(100, None), (101, ""), (102, "zz " * 5000)]
    got = report(spark, docs, items, window=5, block_words=block)
    assert got == {i: brute(t, items, 5) for i, t in docs}


def test_empty_tables(spark):
    assert report(spark, [(1, "a b")], []) == {1: brute("a b", [], 10)}
    assert report(spark, [], [(1, "a")]) == {}


def test_decontaminate_cuts_and_drops(spark):
    item = " ".join(f"w{i}" for i in range(12))
    clean = "only other words, " * 10
    docs = [
        (1, clean, "en", "s", 5),
        (2, clean + item.upper() + ". End", None, "s", 5),
        (3, item, "en", None, 5),
        (None, None, None, None, None),
        (5, "", "en", "s", 0),
        (1, clean, "en", "s", 5),
    ]
    d = spark.createDataFrame(docs, DOCS)
    out = D.decontaminate(d, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert out.columns == d.columns
    want = [d for d in docs if d[0] != 3]
    want[1] = (2, clean + ". End", None, "s", 5)
    key = lambda r: str(r)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op1_decontaminate"](spark, sf)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)):
            grams.setdefault(tuple(w[i : i + 10]), set()).add(str(name))
    texts = dict(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    rows = got.collect()
    assert len(rows) == len(texts)
    assert any(r.contaminated for r in rows)
    for r in rows:
        doc = words(texts[r.doc_id])
        at = [i for i in range(len(doc)) if tuple(doc[i : i + 10]) in grams]
        names = set().union(*[grams[tuple(doc[i : i + 10])] for i in at])
        hit = {j for i in at for j in range(i, i + 10)}
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert tuple(r) == (r.doc_id, len(doc), len(hit), len(names), digest, bool(hit))
