import math
import random

import pytest

from snapledger.llm import mixing as M
from tests import compare

DOCS = "doc_id long, text string, source string, weight string, _block string, mix_copies int"


def totals(spark, tokens):
    return spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(tokens)], "_source string, _tokens long")


@pytest.mark.parametrize("tokens", [[1000, 10, 1], [500, 400, 3, 0], [7, 7]])
def test_exponent(spark, tokens):
    t = totals(spark, tokens)
    p = [n for n in tokens if n]
    spread = math.log(max(p) / min(p))
    want = 0.0 if not spread else max(0.0, 1 - math.log(4) / spread)
    assert M.bisect_exponent(t, 4.0) == pytest.approx(want, abs=2e-6)

    def entropy(a):
        w = [n**a for n in p]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    goal = (entropy(0) + entropy(1)) / 2
    a = M.bisect_exponent(t, None, goal)
    assert entropy(a) == pytest.approx(goal, abs=1e-5)
    assert M.bisect_exponent(totals(spark, []), 4.0) == 1.0


def table(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randint(0, 30), "big" if i % 3 else rng.choice(["a", "b", None, ""]), "x", "y", 1) for i in range(n)]
    rows += [(None, None, "a", "x", "y", 1), (5, "w", "empty", "x", "y", 1), (6, None, "none", "x", "y", 1), (1, "w " * 5000, "big", "", "", 1)]
    return rows, spark.createDataFrame(rows, DOCS)


def test_schedule(spark):
    rows, d = table(spark)
    got = M.mix(d, block_tokens=200, max_repeats=3.0).collect()
    epochs = {}
    for r in got:
        epochs.setdefault((r.source, r.epoch), []).append(r)
    size = {}
    for _, text, source, *_ in rows:
        size[source or ""] = size.get(source or "", 0) + len((text or "").split())
    first = [r for r in got if r.epoch == 0]
    assert len(first) == len(rows)  # every document is used
    most = max(size.values())
    used = {s: sum(r.n_tokens for r in got if r.source == s) for s in size}
    repeats = {s: used[s] / size[s] for s in size if size[s]}
    assert repeats["big"] == 1 and max(repeats.values()) <= 3.0
    alpha = 1 - math.log(3) / math.log(most / 1)
    for s, n in size.items():
        if n:
            assert used[s] <= n * (n / most) ** (alpha - 1) + 1e-3
            assert used[s] > n * (n / most) ** (alpha - 1) - 1 - max(
                sum(r.n_tokens for r in first if r.source == s and r.block == b) for b in {r.block for r in first if r.source == s}
            )
    # A permutation: each block has one rank per epoch, ranks lie in the epoch's part.
    for (_, _), part in epochs.items():
        places = {r.block: r.mix_rank for r in part}
        assert all(r.mix_rank == places[r.block] for r in part)
    orders = [tuple(sorted({(r.mix_rank, r.block) for r in part})) for (s, _), part in epochs.items() if s == "a"]
    assert len(orders) >= 2


def test_budget_and_weigh(spark):
    rows, d = table(spark)
    got = M.mix(d, block_tokens=100, max_repeats=2.0, budget=2000).collect()
    assert 0 < sum(r.n_tokens for r in got) <= 2000
    out = M.weigh(d, block_tokens=100, max_repeats=3.0)
    assert out.columns == [*[c for c in d.columns if c != "mix_copies"], "mix_copies", "mix_rank"]
    assert out.count() == len(rows)
    assert out.agg({"mix_copies": "min"}).first()[0] == 1


def test_empty(spark):
    d = spark.createDataFrame([], DOCS)
    assert M.mix(d).count() == 0 and M.weigh(d).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    same, note = compare.compare(spark, compare.connect(sf), "op2_mixing", sf)
    assert same, note


def test_null_ids_are_dealt_over_blocks(spark):
    """Half of the ids are null: blocks stay near their size."""
    d = spark.range(4000).selectExpr("if(id % 2 = 0, null, id) as doc_id", "concat('some words of text ', id) as text", "'s' as source")
    sizes = M.mix(d, block_tokens=1000).where("epoch = 0").groupBy("block").sum("n_tokens").collect()
    assert len(sizes) == 20 and max(r[1] for r in sizes) < 1500
