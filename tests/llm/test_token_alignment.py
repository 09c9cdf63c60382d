import hashlib
import random

import numpy as np
import pytest

from snapledger.llm import queries
from snapledger.llm import token_alignment as T

DOCS = "doc_id long, text string, id string, run string, pairs string, n string"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bpes():
    return T.ByteBpe(T.BYTE_BPE), T.PieceBpe(T.PIECE_BPE)


def spans(ids, table):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(table[i])))
        at += len(table[i])
    return out


def brute(docs, bpes):
    """Whole texts, all pairs of tokens compared."""
    links, shapes = [], []
    for _, text in docs:
        a = spans(bpes[0].encode([" " + (text or "")])[0], bpes[0].bytes)
        b = spans(bpes[1].encode([text or ""])[0], bpes[1].bytes)
        raw = (" " + (text or "")).encode()
        if not text or any(b"".join(t[i] for i, _, _ in x) != raw for x, t in ((a, bpes[0].bytes), (b, bpes[1].bytes))):
            links.append([])
            shapes.append((0, 0, 0, ""))
            continue
        links.append([(x, y) for x, s, e in a for y, u, v in b if s < v and u < e])
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, _, e in x if low < e <= cut) for x in (a, b)))
            low = cut
        shapes.append((len(a), len(b), len(cuts), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = {}
    for own in links:
        for pair in set(own):
            counts[pair] = counts.get(pair, 0) + 1
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    return sorted(
        (
            (i, n_a, n_b, g, len(own), sum(counts[p] == most[p[0]] for p in own), sum(counts[p] for p in own), sha)
            for (i, _), own, (n_a, n_b, g, sha) in zip(docs, links, shapes)
        ),
        key=str,
    )


def aligned(spark, docs):
    d = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in docs], DOCS).repartition(5)
    found = T.align_report(d)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, found.collect()), key=str)


def test_equals_brute_force(spark, bpes):
    docs = [(r["doc_id"], r["text"] and r["text"][:400]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    docs += [(1000 + i, t) for i, t in enumerate(["", None, " ", "  two  spaces ", "a", "Ünï▁x", "tab\there\r\n\n", "日本語 text 🙂🙂", "<|endoftext|> <s></s>"])]
    docs += [(None, "twice"), (None, "twice"), (5, "twice"), (5, None)]
    assert aligned(spark, docs) == brute(docs, bpes)


def test_hot_pair_and_empty_table(spark, bpes):
    docs = [(i, "the the the" if i % 3 else f"the word {i}") for i in range(400)]
    assert aligned(spark, docs) == brute(docs, bpes)
    assert aligned(spark, []) == []


def test_long_texts_in_pieces_are_tokenized_alike(spark, bpes, monkeypatch):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").collect()]
    texts += [" ".join(texts)[:200_000], "x" * 70_000, "no  cut , here " * 20]
    for text in texts:
        some = T.pieces(text, 300)
        assert " ".join(some) == text
        for bpe, mark in zip(bpes, (" ", "")):
            assert [i for p in bpe.encode([mark + s for s in some]) for i in p] == bpe.encode([mark + text])[0]
    whole = [t[:5] for t in T._Aligner(*bpes).align(texts)]
    monkeypatch.setattr(T, "_PIECE", 300)
    assert [t[:5] for t in T._Aligner(*bpes).align(texts)] == whole


def test_both_libraries_give_the_same_ids(spark, bpes):
    """Every character the faster one is used for, alone, in words, after spaces, in numbers."""
    chars = [chr(c) for c in range(0x2100) if not T._OTHER.search(chr(c))]
    texts = [f" {c}|a{c}b 1{c}2  {c}{c} {c}'s\n{c}\n" for c in chars] + [" <|endoftext|> we'll DON'T 'Ve", "   ", "\t\n x"]
    texts += [" " + r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").collect()]
    assert bpes[0]._fast is not None and len(chars) > 700
    assert bpes[0].encode(texts) == bpes[0]._slow(texts)
    assert any(T._OTHER.search(t) is None for t in texts[-50:])


def test_gallop():
    rng = np.random.default_rng(3)
    for n, m, top in [(1, 1, 3), (50, 400, 1000), (300, 20, 500), (1000, 1000, 1500), (5, 0, 9), (0, 5, 9)]:
        short, long = (np.unique(rng.integers(0, top, k)) for k in (n, m))
        assert np.array_equal(T.gallop(short, long), np.searchsorted(long, short))


def test_overlaps():
    rng = random.Random(4)
    for _ in range(200):
        end = rng.randrange(1, 60)
        a, b = (np.array(sorted({end, *(rng.randrange(1, end + 1) for _ in range(rng.randrange(30)))})) for _ in "ab")
        at_a, at_b, cuts_a, cuts_b = T.overlaps(a, b)
        sa, sb = np.concatenate(([0], a[:-1])), np.concatenate(([0], b[:-1]))
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if sa[i] < b[j] and sb[j] < a[i]}
        assert len(at_a) == len(want) == len(a) + len(b) - len(cuts_a) and set(zip(at_a, at_b)) == want
        assert a[cuts_a - 1].tolist() == b[cuts_b - 1].tolist() == sorted(set(a) & set(b))


def test_query(spark):
    found = queries.op12_token_alignment(spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert found.where("n_links <> n_a + n_b - n_groups or n_best > n_links or count_sum < n_links").isEmpty()
