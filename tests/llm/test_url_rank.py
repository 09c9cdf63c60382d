import random
import re

import pytest

from snapledger.llm import queries
from snapledger.llm import url_rank as U

PAGES = "page_id long, url string, html string, host string, verdict string"


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return "".join(c.lower() if c.isascii() else c for c in m[1]), m[2]


def rule_of(host, path):
    best = None
    for action, rule in U.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or len(rule) > len(best[1]):
                best = action, rule
    return best


def brute(rows, rounds=U.ROUNDS):
    pages = [(i, *split(u), h or "") for i, u, h, *_ in rows]
    hosts = {h for _, h, _, _ in pages if h}
    links = {}
    for _, host, _, html in pages:
        for to in {x.lower() for x in re.findall(r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)""", html)}:
            if host and to != host:
                links[host, to] = links.get((host, to), 0) + 1
                hosts.add(to)

    def seeds(action):
        out = {}
        for h in hosts:
            own = [rule_of(a, p) for _, a, p, _ in pages if a == h]
            out[h] = float(bool(own) and sum(bool(r) and r[0] == action for r in own) > 0.5 * len(own))
        n = sum(out.values())
        return {h: v / max(n, 1) for h, v in out.items()}, max(n, 1)

    def walk(start, edges):
        out = {h: sum(n for (a, _), n in edges.items() if a == h) for h in hosts}
        now = dict(start)
        for _ in range(rounds):
            got = dict.fromkeys(hosts, 0.0)
            for (a, b), n in edges.items():
                got[b] += now[a] * n / out[a]
            lost = 1 - sum(got.values())
            now = {h: 0.15 * start[h] + 0.85 * (got[h] + start[h] * lost) for h in hosts}
        return now

    good, n_good = seeds("allow")
    bad, n_bad = seeds("block")
    trust = walk(good, links)
    distrust = walk(bad, {(b, a): n for (a, b), n in links.items()})
    out = []
    for i, host, path, _ in pages:
        rule = rule_of(host, path)
        t, d = trust.get(host, 0) * n_good, distrust.get(host, 0) * n_bad
        verdict = rule[0] if rule else "block" if d >= U.THRESHOLD and d > t else "allow"
        out.append((i, host, path, rule and rule[1], verdict))
    return sorted(out, key=str)


def judged(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_graph_against_brute_force(spark):
    rng = random.Random(3)
    hosts = ["a.example.com", "www.example.com", "bad.net", "x.org", "y.org", "z.org", "w.org", "B.Net", "blog.x.org"]
    rows = []
    for i in range(120):
        host, path = rng.choice(hosts), rng.choice(["/en/1", "/fr/2?x=/es/", "/es/", "", "?q", "#f", "/de//x"])
        html = "".join(
            f"<p>{rng.choice(['<a href=', '<A class=x HREF = '])}\"{rng.choice(['http:', 'https:', ''])}//{rng.choice(hosts)}/p\">t</a>"
            for _ in range(rng.randint(0, 3))
        )
        rows.append((i, f"http://{host}{path}", html, "h", "v"))
    rows += [(200 + i, f"http://bad.net/es/{i}", "<a href=//x.org>", "h", "v") for i in range(60)]
    rows += [(300 + i, f"http://worse.org/{i}", "<a href=//bad.net/>", "h", "v") for i in range(3)]
    rows += [(None, None, None, None, None), (500, "no scheme", "<a href='//x.org'>", "", ""), (1, "", "", "", ""), (1, "", "", "", ""),
             (501, "http://É.COM/é\n?x", "", "", ""), (502, "x://y://z/", "<a href=/rel>", "", "")]
    got = judged(U.judge_pages(spark.createDataFrame(rows, PAGES), tolerance=0.0))
    assert got == brute(rows)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_empty(spark):
    assert U.judge_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert judged(queries.QUERIES["op5_url_filter"](spark, sf)) == brute(rows)


@pytest.mark.parametrize("copies", [1, 300])
def test_scores_do_not_depend_on_the_number_of_seeds(spark, copies):
    """Chains of hosts that link to a blocked host, at a damping and a tolerance of few rounds."""
    chain = spark.range(copies).selectExpr("id", "explode(sequence(0, 2)) as k")
    edges = chain.selectExpr("concat('h', k + 1, '-', id) as _from", "concat('h', k, '-', id) as _to", "1L as _links")
    seen = spark.range(copies).selectExpr("concat('h0-', id) as _host", "'block' as _verdict")
    got = U.host_scores(seen, edges, damping=0.5, tolerance=0.01).collect()
    assert len(got) == 4 * copies
    for r in got:
        want = 0.5 / (1 - 0.5**4) * 0.5 ** int(r["_host"][1])
        assert abs(r["_distrust"] - want) <= 0.01 and r["_trust"] == 0 and r["_blocked"]


def test_rounds_follow_from_the_tolerance():
    assert U.most_rounds(1, 0.85, 1e-9) > U.most_rounds(1, 0.85, 1e-6) == U.ROUNDS
    assert 2 * 10**6 * 0.85 ** (U.most_rounds(10**6, 0.85, 1e-6) - 1) * 0.85 / 0.15 <= 1e-6
