import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from snapledger.llm import queries
from snapledger.llm import repeated_spans as R

DOCS = "doc_id long, text string, t string, starts string, low int"


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for (name, _), r in zip(rows, raw):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(r, gone) if not g)
        out.append((name, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def report(spark, rows, **options):
    d = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DOCS).repartition(4)
    return sorted(map(tuple, R.repeat_report(d, **options).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    shared = [say(rng.randint(20, 120)) for _ in range(8)]
    rows = []
    for i in range(60):
        text = say(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 15)
            text += s[a : rng.randint(a, len(s))] + say(rng.randint(0, 30))
        rows.append((i, text))
    rows += [(70, "a" * 200), (71, "ab" * 60), (72, None), (73, ""), (None, shared[0]), (None, shared[0]), (74, shared[1]), (0, rows[0][1])]
    rows += [(80 + k, rows[k][1]) for k in range(3)]
    assert report(spark, rows, length=40, gram=10, node=4) == brute(rows, 40)


def test_production_lengths(spark):
    rng = random.Random(3)
    say = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n // 7))
    passage, long = say(900), say(30_000)
    rows = [(i, say(rng.randint(10, 1500)) + passage[i : 900 - 3 * i] + say(500)) for i in range(40)]
    rows += [(50, long), (51, long[:9000] + "#" + long[9000:]), (52, long[5000:5399]), (53, long[5000:5400]), (54, "x" * 399), (55, "y" * 401), (56, "z" * 5000)]
    assert report(spark, rows) == brute(rows, 400)


def test_empty_and_texts(spark):
    assert report(spark, []) == []
    text = "".join(chr(97 + i * i % 26) for i in range(50)) + "é" * 30
    d = spark.createDataFrame([(1, text + "1", "x", None, 1), (2, "2" + text, "x", None, 1), (3, None, None, None, None)], DOCS)
    out = R.remove_repeats(d, length=40, gram=10, node=4)
    assert out.columns == d.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "1"), (2, "2"), (3, "")]


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op6_repeated_spans"](spark, sf).collect()), key=str)
    assert got == brute(rows, 400)
    assert any(r[2] for r in got)


def test_long_texts_are_taken_in_pieces():
    """The same anchors as in one piece, wherever the cuts fall; and memory that does not grow."""
    rng = np.random.default_rng(5)
    for length, gram in ((40, 10), (400, 100)):
        raw = bytes(rng.integers(97, 101, 6000, dtype=np.uint8)) + b"ab" * 900 + b"x" * 1500 + bytes(rng.integers(97, 99, 500, dtype=np.uint8))
        whole = np.column_stack(R.anchors([raw], length, gram))
        for piece in (1, 37, 401, 1000, 5000, 100_000):
            if piece > 1 or length < 100:
                assert np.array_equal(np.column_stack(R.anchors_of_long(raw, length, gram, piece)), whole), piece
    assert len(R.anchors_of_long(b"short", 400, 100, 10)[0]) == 0


def test_a_text_of_many_megabytes(spark):
    rng = np.random.default_rng(6)
    big = "".join(map(chr, rng.integers(97, 123, 5_000_000)))
    copied = big[2_000_000:2_001_000]
    d = spark.createDataFrame([(1, big), (2, "start " + copied + " end"), (3, copied[:399])], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in R.repeat_report(d).collect()}
    assert got == {1: (5_000_000, 1000, 1), 2: (1010, 1000, 1), 3: (399, 0, 0)}
