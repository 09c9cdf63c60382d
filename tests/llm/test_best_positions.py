import math
import random
import re

import duckdb
import pytest

from snapledger.llm import best_positions as B
from snapledger.llm import queries
from tests import compare

DOCS = "doc_id long, text string, item_id string, rank string, score string"
ITEMS = "item_id long, text string, doc_id string, _w string"
SF = "/root/testdata/sf0.001"


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, top=20):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    total, n = sum(len(w) for _, w in held), len(held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for doc, w in held:
            m = 75 + 25 * len(w) * n // total
            score = 0
            for t in terms(text):
                if t in w:
                    tf = w.count(t)
                    score += math.floor(1000 * math.log((2.0 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        scores.sort(key=lambda s: s[:3])
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(scores[:top])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, "x", "y", "z") for r in docs], DOCS).repartition(5)
    i = spark.createDataFrame([(*r, "x", "w") for r in items], ITEMS)
    found = B.rank_documents(d, i, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    # Frequent and rare words, so that some searches stop early and some read everything.
    word = lambda: f"W{int(rng.paretovariate(0.6)) % 400}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 80)))) for i in range(700)]
    items = [(k, " ".join(word() for _ in range(rng.randrange(1, 30)))) for k in range(25)]
    items += [(30, docs[17][1]), (31, docs[17][1] + " " + docs[17][1]), (32, "unheardof")]
    want = brute(docs, items)
    assert ranked(spark, docs, items) == want
    assert ranked(spark, docs, items, postings=500) == want
    assert ranked(spark, docs, items, block_terms=40) == want


def test_ties_nulls_and_repeated_rows(spark):
    docs = [(i, "same words here") for i in range(60, 0, -1)] + [(None, "same words here"), (None, None), (7, "same words here")]
    docs += [(100, ""), (101, "!? ,"), (102, "Grün ÄB 12 x_y"), (103, None)]
    items = [(1, "SAME words"), (2, None), (3, ""), (None, "grün äb 12 Y"), (5, "ÄB"), (1, "here")]
    assert ranked(spark, docs, items) == brute(docs, items)
    first = [r[2] for r in sorted(ranked(spark, docs, [(1, "same")]), key=lambda r: r[1])]
    assert first == [1, 2, 3, 4, 5, 6, 7, 7, *range(8, 20)]


def test_one_word_in_all_documents_and_very_long_texts(spark):
    docs = [(i, "the " * (1 + i % 3) + f"w{i}") for i in range(300)] + [(999, "the long " * 200_000 + "end"), (1000, "x" * 3_000_000)]
    items = [(1, "the"), (2, "the end"), (3, "long " * 3000), (4, "x" * 3_000_000)]
    assert ranked(spark, docs, items) == brute(docs, items)


def test_text_in_pieces_has_the_same_words(monkeypatch):
    text = " ".join(f"Wörd{i}--x{i % 7}" for i in range(500)).encode()
    whole = B.count_words(text)
    monkeypatch.setattr(B, "_PIECE", 10)
    assert B.count_words(text) == whole and whole[0] == 1000


def test_reading_stops_before_the_end():
    """Two lists whose heads are the same few documents: the rest is never met."""
    import numpy as np

    n = 20_000
    sizes = np.full(n, 2)
    terms_ = np.tile(np.array([0, 1]), n)
    freqs = np.repeat(np.where(np.arange(n) % 500 == 0, 50, 1), 2)
    lists = B.Lists.build(2, (n, 10 * n), np.full(n, 10), sizes, terms_, freqs)
    docs, scores = lists.search(np.array([0, 1]), np.array([10, 10]), np.full(2, -1, np.int32), 20, 0)
    assert len(docs) < 100 and sorted(docs)[:20] == list(range(0, 10_000, 500))


def test_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")]) == [] == ranked(spark, [(1, "a")], []) == ranked(spark, [(1, None)], [(1, "a")])


def test_query_equals_sql(spark):
    con = compare.connect(SF)
    got = sorted(map(tuple, queries.op11_best_positions(spark, SF).collect()))
    assert got and got == sorted(con.execute(B.RANK_SQL).fetchall())
