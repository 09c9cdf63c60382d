"""URL filter: rules first, then trust and distrust spread over links between hosts.

Trust starts at hosts most of whose pages a rule allows and follows links; distrust starts
at hosts most of whose pages a rule blocks and follows links backwards, so a host inherits
it from the hosts it links to. Both are personalised PageRanks, iterated as joins and sums
over host edges. A host is blocked if its distrust is a multiple of its trust and more than
a share of what an average seed has.

Pages are reduced to hosts and host pairs before anything is joined, so a host with a third
of all pages is one row there; the verdicts meet the pages over salted keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import ascii_lower, stored

# (action, host and path). A host rule holds for all subdomains.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
SEED_SHARE = 0.5
DAMPING = 0.85
# No score is further from its limit, in units of one seed.
TOLERANCE = 1e-6
# Relative precision of sums of doubles; nothing is asked to be closer.
PRECISION = 1e-12
RATIO = 1.0
THRESHOLD = 0.05
SALTS = 16


def most_rounds(seeds: float, damping: float, tolerance: float) -> int:
    """Rounds after which ``spread`` has met the tolerance. Every round shrinks the sum of all
    changes, at most twice the seeds at first, by the damping; what is left to come is the
    last sum times damping / (1 - damping)."""
    if not 0 < damping < 1:
        return 1
    return 2 + math.ceil(math.log(tolerance * (1 - damping) / damping / (2 * seeds)) / math.log(damping))


ROUNDS = most_rounds(1, DAMPING, TOLERANCE)

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null. The rules are a list of
    the configuration, tried from the longest to the shortest; equally long ones in their
    given order."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for action, rule in reversed(sorted(rules, key=lambda r: -len(r[1]))):
        of_host, _, rest = rule.partition("/")
        fits = ((host == of_host) | host.endswith(f".{of_host}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, host: Column, html: Column) -> DataFrame:
    """Links between different hosts: _from, _to, and the number of pages with such a link."""
    links = F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(_LINK), 1), ascii_lower))
    pairs = pages.select(host.alias("_from"), F.explode(links).alias("_to"))
    pairs = pairs.where((F.col("_from") != "") & (F.col("_from") != F.col("_to")))
    return pairs.groupBy("_from", "_to").agg(F.count("*").alias("_links"))


def spread(hosts: DataFrame, edges: DataFrame, damping: float, tolerance: float) -> DataFrame:
    """``hosts`` (_host, _trust0, _distrust0: 1 for a seed, else 0) with the stationary
    ``_trust`` and ``_distrust``, in units of one seed. What a host without links would pass
    on goes back to the seeds in equal parts. Iterates until no host can be further than
    ``tolerance`` from its limit, whatever the number of seeds."""
    good, bad = (float(x or 0) for x in hosts.agg(F.sum("_trust0"), F.sum("_distrust0")).first())
    seeds = max(good + bad, 1.0)
    tolerance = max(tolerance, PRECISION * seeds)
    gives = edges.groupBy("_from").agg(F.sum("_links").alias("_given"))
    takes = edges.groupBy("_to").agg(F.sum("_links").alias("_taken"))
    weighted = stored(
        edges.join(gives, "_from")
        .join(takes, "_to")
        .select("_from", "_to", (F.col("_links") / F.col("_given")).alias("_on"), (F.col("_links") / F.col("_taken")).alias("_back")),
        "host-edges",
    )
    state = stored(hosts.withColumns({"_trust": F.col("_trust0"), "_distrust": F.col("_distrust0")}), "host-scores")
    zero = F.lit(0.0)
    for _ in range(most_rounds(seeds, damping, tolerance)):
        on = weighted.join(state, weighted["_from"] == state["_host"]).select(
            F.col("_to").alias("_host"), (F.col("_trust") * F.col("_on")).alias("_t"), zero.alias("_d")
        )
        back = weighted.join(state, weighted["_to"] == state["_host"]).select(
            F.col("_from").alias("_host"), zero.alias("_t"), (F.col("_distrust") * F.col("_back")).alias("_d")
        )
        moved = on.unionByName(back).groupBy("_host").agg(F.sum("_t").alias("_t"), F.sum("_d").alias("_d"))
        moved = stored(state.join(moved, "_host", "left").fillna(0.0, ["_t", "_d"]), "host-moved")
        sums = moved.agg(F.sum("_t"), F.sum("_d")).first()
        lost_t, lost_d = ((n - (x or 0.0)) / max(n, 1.0) for x, n in zip(sums, (good, bad)))
        new_t = (1 - damping) * F.col("_trust0") + damping * (F.col("_t") + F.col("_trust0") * lost_t)
        new_d = (1 - damping) * F.col("_distrust0") + damping * (F.col("_d") + F.col("_distrust0") * lost_d)
        step = stored(
            moved.select("_host", "_trust0", "_distrust0", F.col("_trust").alias("_t0"), F.col("_distrust").alias("_d0"),
                         new_t.alias("_trust"), new_d.alias("_distrust")),
            "host-scores",
        )
        change = step.agg(F.sum(F.abs(F.col("_trust") - F.col("_t0")) + F.abs(F.col("_distrust") - F.col("_d0")))).first()[0]
        state = step.drop("_t0", "_d0")
        if (change or 0.0) * damping <= tolerance * (1 - damping):
            return state
    raise RuntimeError(f"trust and distrust did not settle: all scores together still move by {change}")


def host_scores(
    seen: DataFrame, edges: DataFrame, seed_share: float = SEED_SHARE, damping: float = DAMPING,
    tolerance: float = TOLERANCE, ratio: float = RATIO, threshold: float = THRESHOLD,
) -> DataFrame:
    """Per host: trust, distrust, and ``_blocked``. ``seen`` has _host and _verdict (of a rule,
    or null) of every page; linked hosts without pages take part as well."""
    counts = seen.where("_host != ''").groupBy("_host").agg(
        F.count("*").alias("_pages"),
        F.count_if(F.col("_verdict") == "allow").alias("_allowed"),
        F.count_if(F.col("_verdict") == "block").alias("_blocked"),
    )
    edges = stored(edges, "host-links")
    named = edges.select(F.col("_from").alias("_host")).union(edges.select("_to")).distinct()
    every = stored(
        counts.join(named, "_host", "full").select(
            "_host",
            F.coalesce((F.col("_allowed") > seed_share * F.col("_pages")).cast("double"), F.lit(0.0)).alias("_good"),
            F.coalesce((F.col("_blocked") > seed_share * F.col("_pages")).cast("double"), F.lit(0.0)).alias("_bad"),
        ),
        "hosts",
    )
    seeds = every.select("_host", F.col("_good").alias("_trust0"), F.col("_bad").alias("_distrust0"))
    scores = spread(seeds, edges, damping, tolerance).select("_host", "_trust", "_distrust")
    return scores.withColumn("_blocked", (F.col("_distrust") >= threshold) & (F.col("_distrust") > ratio * F.col("_trust")))


def judge_pages(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    **options,
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``.

    Null urls and urls without ``://`` have an empty host and path; no rule fits them, no
    host is behind them, and they are allowed, as are hosts without trust and distrust. Null
    html has no links. Repeated rows and null ids are judged like others, an empty table
    gives no rows, other columns are not read.
    """
    rows = stored(
        pages.select(
            F.col(id_col).alias("_id"),
            url_host(F.col(url_col)).alias("_host"),
            url_path(F.col(url_col)).alias("_path"),
        ).withColumn("_rule", fitting_rule(F.col("_host"), F.col("_path"), rules)),
        "judged-urls",
    )
    edges = host_edges(pages, url_host(F.col(url_col)), F.col(html_col))
    scores = host_scores(rows.select("_host", F.col("_rule.verdict").alias("_verdict")), edges, **options)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_id", "_path"), F.lit(SALTS)).cast("int"))
    found = salted.join(scores.withColumn("_salt", salts), ["_host", "_salt"], "left")
    by_host = F.when(F.col("_blocked"), "block").otherwise("allow")
    return found.select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_host).alias("verdict"),
        F.coalesce("_trust", F.lit(0.0)).alias("trust"),
        F.coalesce("_distrust", F.lit(0.0)).alias("distrust"),
    )
