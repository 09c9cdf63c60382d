import numpy as np

from snapledger.llm import queries
from snapledger.llm import sorted_projections as P

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, component_id string, v string, pass string"


def brute(rows, cosine=0.9):
    """Component and links of every row, all pairs compared."""
    n = len(rows)
    links = [set() for _ in rows]
    ok = [r[1] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    for dim in {len(r[1]) for r, k in zip(rows, ok) if k}:
        at = [i for i in range(n) if ok[i] and len(rows[i][1]) == dim]
        x = np.array([rows[i][1] for i in at], np.float32).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i, row in zip(at, x @ x.T >= cosine):
            links[i] = {at[j] for j in np.flatnonzero(row)} - {i}
    comp, out = [None] * n, []
    for i in range(n):
        if comp[i] is None:
            todo = [i]
            comp[i] = i
            while todo:
                for j in links[todo.pop()]:
                    if comp[j] is None:
                        comp[j] = i
                        todo.append(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[comp[i]] = min(r[0], least.get(comp[i], r[0]))
    for i, r in enumerate(rows):
        c = least.get(comp[i])
        out.append((r[0], len(links[i]), c, r[0] == c))
    return sorted(out, key=str)


def frame(spark, rows):
    plain = [(i, None if v is None else [None if x is None else float(x) for x in v], "c", "v", "p") for i, v in rows]
    return spark.createDataFrame(plain, SCHEMA).repartition(5)


def found(spark, rows, **options):
    out = P.near_vectors(frame(spark, rows), **options)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=str)


def clusters(rng, sizes, dim, spread):
    rows = []
    for size, s in zip(sizes, spread):
        centre = rng.standard_normal(dim)
        rows += [centre / np.linalg.norm(centre) + s * rng.standard_normal(dim) / np.sqrt(dim) for _ in range(size)]
    return rows


def test_tight_groups_and_copies_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = clusters(rng, [600, 40, 5, 2], 32, [0.1, 0.15, 0.1, 0.05]) + list(rng.standard_normal((300, 32)))
    vectors += [vectors[0] * 3] * 50 + [vectors[-1]] * 400
    rows = [(i, v) for i, v in enumerate(vectors)]
    rng.shuffle(rows)
    want = brute(rows)
    assert found(spark, rows) == want
    # Windows far narrower than the groups, and parts narrower than the table.
    assert found(spark, rows, width=8, passes=8) == want


def test_wide_groups_are_compared_with_all_members(spark, monkeypatch):
    monkeypatch.setattr(P, "_FAR", 7)
    monkeypatch.setattr(P, "_SLICE", 64)
    rng = np.random.default_rng(2)
    # Chains: neighbours link, ends do not.
    a, b = np.eye(8)[0], np.eye(8)[1]
    rows = [(i, a * np.cos(t) + b * np.sin(t)) for i, t in enumerate(np.linspace(0, 1.5, 120))]
    rows += [(1000 + i, v) for i, v in enumerate(clusters(rng, [80, 60], 8, [0.45, 0.3]))]
    want = brute(rows)
    got = found(spark, rows)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)
    assert found(spark, rows, passes=12) == want


def test_recall_at_the_limit(spark):
    """Pairs just above the limit, the hardest to find."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= b @ a * a
        b /= np.linalg.norm(b)
        c = rng.uniform(0.901, 0.93)
        rows += [(2 * i, a), (2 * i + 1, c * a + np.sqrt(1 - c * c) * b)]
    rows += [(10_000 + i, v) for i, v in enumerate(rng.standard_normal((8000, 64)))]
    got, want = found(spark, rows), brute(rows)
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in want) > 700
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0])]
    rows += [(8, [1.0, 2.0, 0.0]), (9, [2.0, 4.0]), (None, [1.0, 2.0]), (None, [-1.0, -2.0]), (9, [1.0, 2.1]), (11, [-1e-30, -2e-30])]
    rows += [(12, [3e38, 3e38]), (13, [1e-40, 1e-40])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_doubles_and_decimals(spark):
    rows = spark.sql("select id as vec_id, array(1.5d, id + 0d) as embedding from range(3)")
    plain = spark.sql("select id as vec_id, array(cast(1.5 as decimal(5,2)), id + 0) as embedding from range(3)")
    assert sorted(map(tuple, P.near_vectors(rows).collect())) == sorted(map(tuple, P.near_vectors(plain).collect()))


def test_rounded_cosines_stay_within_their_bound():
    rng = np.random.default_rng(4)
    unit = rng.standard_normal((200, 48))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    q, step, lost = P._decode(P._encode(unit), 48)
    about = (q @ q.T) * step[:, None] * step
    assert (np.abs(about - unit @ unit.T) <= lost[:, None] * (1 + lost) + lost).all()


def test_query_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op13_sorted_projections(spark, SF).collect()), key=str) == brute(rows)
