"""The corpus operators as named queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapledger.llm import (
    best_positions,
    decontaminate,
    exact_dedup,
    language_id,
    main_text,
    mixing,
    parity_join,
    repeated_spans,
    sorted_projections,
    token_alignment,
    token_files,
    url_rank,
    warc_zip,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc_zip.write_pages(_table(spark, sf_dir, "pages"))
    return warc_zip.read_packages(packages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rank.judge_pages(_table(spark, sf_dir, "pages"))


def op6_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.repeat_report(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(_table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_pages(_table(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.count_tokens(_table(spark, sf_dir, "documents"))


def op10_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.near_groups(_table(spark, sf_dir, "documents"))


def op11_best_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_positions.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_report(_table(spark, sf_dir, "documents"))


def op13_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_projections.near_vectors(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: f for name, f in globals().items() if name.startswith("op")
}

WARC_SQL = """
    with t as (select page_id, url, coalesce(html, '') as x from pages),
    u as (
        select *, octet_length(encode(x)) as n, sha256(x) as h, min(page_id) over (partition by x) as first_id
        from t
    )
    select page_id, n as payload_bytes, h as payload_digest, url,
        case when n >= 100 and page_id is distinct from first_id then 'revisit' else 'response' end as record_type,
        case when n >= 100 and page_id is distinct from first_id then first_id end as refers_to
    from u
"""

# Results over all pairs or windows, by plain joins: for small tables only.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
MATCH_SQL = rf"""
    with d as (
        select row_number() over () as r, doc_id,
            coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as ws
        from documents
    ),
    items as (
        select item_id::varchar as item_id, ws, least(len(ws), 10) as k
        from (select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark)
        where len(ws) > 0
    ),
    windows as (
        select distinct item_id, k, array_to_string(ws[s : s + k - 1], ' ') as w
        from (select *, unnest(range(1, len(ws) - k + 2)) as s from items)
    ),
    sizes as (select distinct k from windows),
    places as (
        select r, k, s, array_to_string(ws[s : s + k - 1], ' ') as w
        from (select r, k, ws, unnest(range(1, len(ws) - k + 2)) as s from d, sizes where len(ws) >= k)
    ),
    hits as (select r, s, k, item_id from places join windows using (k, w)),
    words as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + k)) as p from hits) group by r),
    named as (
        select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
        from (select distinct r, item_id from hits where item_id is not null) group by r
    )
    select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
        sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join words using (r) left join named using (r)
"""
NEAR_SQL = rf"""
    with recursive d as (
        select row_number() over () as r, doc_id,
            coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) as ws
        from documents
    ),
    shingles as (
        select distinct r, array_to_string(ws[s : s + 4], ' ') as sh
        from (select r, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as s from d where len(ws) > 0)
    ),
    sizes as (select r, count(*) as n from shingles group by r),
    common as (
        select a.r as a, b.r as b, count(*) as shared from shingles a join shingles b on a.sh = b.sh and a.r <> b.r group by all
    ),
    links as (
        select a, b from common join sizes x on x.r = a join sizes y on y.r = b where 100 * shared >= 80 * (x.n + y.n - shared)
    ),
    reach as (
        select r, r as other from d
        union
        select reach.r, links.b from reach join links on links.a = reach.other
    ),
    least as (select reach.r, min(doc_id) as component_id from reach join d on d.r = reach.other group by reach.r)
    select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
    from d join least using (r) left join sizes using (r)
"""
VECTOR_SQL = """
    with recursive v as (
        select row_number() over () as r, vec_id, embedding::double[] as x,
            coalesce(len(embedding) > 0 and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
                and len(list_filter(embedding, lambda e: e <> 0)) > 0, false) as ok
        from embeddings
    ),
    links as (
        select a.r as a, b.r as b from v a join v b on a.r <> b.r and len(a.x) = len(b.x)
        where a.ok and b.ok and list_cosine_similarity(a.x, b.x) >= 0.9
    ),
    reach as (
        select r, r as other from v
        union
        select reach.r, links.b from reach join links on links.a = reach.other
    ),
    least as (select reach.r, min(vec_id) as component_id from reach join v on v.r = reach.other group by reach.r),
    counts as (select a as r, count(*) as n from links group by a)
    select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id is not distinct from component_id as kept
    from v join least using (r) left join counts using (r)
"""
REPEAT_SQL = """
    with d as (
        select row_number() over () as r, doc_id, octet_length(encode(coalesce(text, ''))) as n, hex(encode(coalesce(text, ''))) as h
        from documents
    ),
    windows as (
        select r, s, md5(substr(h, 2 * s + 1, 800)) as w from (select r, h, unnest(range(0, n - 399)) as s from d where n >= 400)
    ),
    repeated as (select r, s from windows where w in (select w from windows group by w having count(*) > 1)),
    marked as (
        select *, sum(case when s - before <= 400 then 0 else 1 end) over (partition by r order by s) as island
        from (select r, s, lag(s) over (partition by r order by s) as before from repeated)
    ),
    spans as (select r, island, min(s) as low, max(s) + 400 as high from marked group by r, island),
    kept as (
        select r, sum(high - low) as n_removed, count(*) as n_spans, max(high) as last,
            string_agg(substr(h, 2 * after + 1, 2 * (low - after)), '' order by low) as part
        from (
            select spans.*, h, coalesce(lag(high) over (partition by r order by low), 0) as after from spans join d using (r)
        ) group by r
    )
    select doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
        sha256(unhex(case when last is null then h else part || substr(h, 2 * last + 1) end)) as kept_sha256
    from d left join kept using (r)
"""

SQL: dict[str, str] = {
    "op1_decontaminate": MATCH_SQL,
    "op2_mixing": mixing.MIX_SQL,
    "op3_warc": WARC_SQL,
    "op4_exact_dedup": exact_dedup.EXACT_SQL,
    "op6_repeated_spans": REPEAT_SQL,
    "op10_parity_join": NEAR_SQL,
    "op11_best_positions": best_positions.RANK_SQL,
    "op13_sorted_projections": VECTOR_SQL,
}
