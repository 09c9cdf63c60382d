"""Mixing sources to temperature weights, realised as budgeted block permutations.

A source with a share p of all tokens gets the weight p^a / sum of p^a. The exponent a is
bisected until the weights meet a target entropy or a limit on how much more often one
source is repeated than another. Every source's documents are dealt into blocks by a hash;
an epoch is a permutation of the blocks, and a source's epochs follow each other until its
token budget is used up, the last one cut after the last block that fits.

Everything is DataFrame or SQL functions. The driver sees one row per bisection round.
Running sums over the blocks of a source are taken in two steps, so that no task gets all
blocks of a large source, and the join on the source is salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapledger.llm.common import stored

BLOCK_TOKENS = 1 << 18
MAX_REPEATS = 4.0
SALTS = 16
# Points tried between the ends of the bracket in one round: four halvings at a time.
POINTS = 16
ROUNDS = 8


def word_count(text: Column) -> Column:
    """Words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_name(source: Column) -> Column:
    """Null and empty names are one source."""
    return F.coalesce(source, F.lit(""))


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _deal(id_col: str, text_col: str) -> Column:
    """What a document is dealt by: its id or, where that is null, its text."""
    return _hash(F.coalesce(F.col(id_col).cast("string"), F.col(text_col)))


def bisect_exponent(
    totals: DataFrame, max_repeats: float | None = None, target_entropy: float | None = None
) -> float:
    """The smallest exponent in [0, 1] whose weights keep the repetition limit (the most
    repeated source has at most ``max_repeats`` times the epochs of the least), or whose
    entropy in nats is at most ``target_entropy``; with both, the larger one. ``totals`` has
    ``_source`` and ``_tokens``; sources without tokens do not count. 1 if nothing does."""
    if max_repeats is None and target_entropy is None:
        raise ValueError("give max_repeats or target_entropy")
    total = totals.agg(F.sum("_tokens")).first()[0]
    if not total:
        return 1.0
    logs = totals.where("_tokens > 0").select(F.log(F.col("_tokens") / F.lit(float(total))).alias("_ln"))
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / POINTS
        grid = F.explode(F.sequence(F.lit(0), F.lit(POINTS - 1)))
        points = logs.select("_ln", grid.alias("_k")).withColumn("_a", F.lit(low) + F.col("_k") * F.lit(step))
        mass = F.exp(F.col("_a") * F.col("_ln"))
        tried = points.groupBy("_k").agg(
            F.exp((1 - F.first("_a")) * (F.max("_ln") - F.min("_ln"))).alias("repeats"),
            (F.log(F.sum(mass)) - F.sum(mass * F.col("_a") * F.col("_ln")) / F.sum(mass)).alias("entropy"),
        )
        good = F.lit(True)
        if max_repeats is not None:
            good = good & (F.col("repeats") <= max_repeats)
        if target_entropy is not None:
            good = good & (F.col("entropy") <= target_entropy)
        first = tried.where(good).agg(F.min("_k")).first()[0]
        if first == 0:
            return round(low, 6)
        first = POINTS if first is None else first
        low, high = low + (first - 1) * step, low + first * step
    return round(high, 6)


def plan_blocks(
    rows: DataFrame,
    block_tokens: int,
    max_repeats: float | None,
    target_entropy: float | None,
    budget: int | None,
) -> tuple[DataFrame, DataFrame]:
    """From ``rows`` (_source, _hash, _tokens): the sources with weight, epochs and number of
    blocks, and the schedule, one row for each scheduled block and epoch."""
    totals = stored(rows.groupBy("_source").agg(F.sum("_tokens").alias("_tokens")), "totals")
    alpha = bisect_exponent(totals, max_repeats, target_entropy)
    row = totals.where("_tokens > 0").agg(
        F.max("_tokens").alias("most"),
        F.sum(F.pow(F.col("_tokens").cast("double"), F.lit(alpha))).alias("mass"),
    ).first()
    most, mass = float(row["most"] or 1), float(row["mass"] or 1)
    tokens = F.col("_tokens").cast("double")
    weight = F.when(F.col("_tokens") > 0, F.pow(tokens, F.lit(alpha)) / F.lit(mass)).otherwise(0.0)
    if budget is None:  # the largest source, repeated least, is used exactly once
        epochs = F.pow(tokens / F.lit(most), F.lit(alpha - 1))
    else:
        epochs = F.lit(float(budget)) * F.pow(tokens, F.lit(alpha - 1)) / F.lit(mass)
    sources = totals.select(
        "_source",
        "_tokens",
        F.round(weight, 9).alias("_weight"),
        F.when(F.col("_tokens") > 0, F.round(epochs, 6)).otherwise(1.0).alias("_epochs"),
        F.greatest(F.ceil(tokens / F.lit(float(block_tokens))), F.lit(1)).cast("long").alias("_blocks"),
    )
    cells = in_blocks(rows, sources).groupBy("_source", "_block").agg(F.sum("_tokens").alias("_size"))
    each = cells.join(sources, "_source").select(
        "*",
        F.floor(F.col("_tokens") * F.col("_epochs")).alias("_budget"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor("_epochs"))).alias("_epoch"),
    )
    each = each.withColumn("_order", _hash(F.col("_source"), F.col("_epoch"), F.col("_block")))
    each = stored(each.withColumn("_part", F.substring("_order", 1, 2)), "block-order")
    # Running sums: over parts of the permutation, then inside each part.
    parts = each.groupBy("_source", "_epoch", "_part").agg(F.sum("_size").alias("_sum"))
    over = Window.partitionBy("_source", "_epoch").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "_source", "_epoch", "_part", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_offset")
    )
    inner = (
        Window.partitionBy("_source", "_epoch", "_part")
        .orderBy("_order", "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum("_size").over(inner), F.lit(0))
    before = F.col("_epoch") * F.col("_tokens") + F.col("_offset") + F.col("_inside")
    schedule = (
        each.withColumn("_inside", inside)
        .join(parts, ["_source", "_epoch", "_part"])
        .withColumn("_before", before)
        .where((F.col("_epoch") < F.floor("_epochs")) | (F.col("_before") + F.col("_size") <= F.col("_budget")))
        .where((F.col("_epoch") == 0) | (F.col("_size") > 0))
        .select(
            "_source",
            "_block",
            "_epoch",
            (F.col("_before") / F.greatest(F.col("_budget"), F.lit(1))).alias("_rank"),
        )
    )
    return sources, stored(schedule, "schedule")


def in_blocks(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the block of their source. Rows of one source are dealt over SALTS
    keys, so that a source with a third of the corpus is no single join key."""
    salted = rows.withColumn("_salt", F.pmod(F.conv(F.substring("_hash", 9, 4), 16, 10).cast("long"), F.lit(SALTS)))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    every = sources.select("_source", "_blocks", "_weight", salts.alias("_salt"))
    number = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long")
    return salted.join(every, ["_source", "_salt"]).withColumn("_block", number % F.col("_blocks")).drop("_salt", "_blocks")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_tokens: int = BLOCK_TOKENS,
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    budget: int | None = None,
) -> DataFrame:
    """One row per scheduled use of a document: the id column, ``source``, ``n_tokens``,
    ``weight`` of the source, ``block``, ``epoch`` and ``mix_rank``, the place of its block in
    its source's schedule from 0 to 1. Reading by ``mix_rank`` interleaves the sources in
    their weights. Without ``budget`` (in tokens) the mix is as large as it has to be for
    every document to be used at least once.

    Null and empty source names are one source, null texts have no tokens, a source without
    tokens is used once. Rows that share an id go to one block; rows whose id is null are dealt
    by their text. An empty table gives no rows.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("_id"),
            source_name(F.col(source_col)).alias("_source"),
            word_count(F.col(text_col)).alias("_tokens"),
            _deal(id_col, text_col).alias("_hash"),
        ),
        "token-counts",
    )
    sources, schedule = plan_blocks(rows, block_tokens, max_repeats, target_entropy, budget)
    return in_blocks(rows, sources).join(schedule, ["_source", "_block"]).select(
        F.col("_id").alias(id_col),
        F.col("_source").alias("source"),
        F.col("_tokens").alias("n_tokens"),
        F.col("_weight").alias("weight"),
        F.col("_block").alias("block"),
        F.col("_epoch").alias("epoch"),
        F.col("_rank").alias("mix_rank"),
    )


def weigh(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with ``mix_copies``, how often the mix uses a document, and ``mix_rank``, the
    first place. Documents outside the budget are left out; without one all stay."""
    options = {"block_tokens": BLOCK_TOKENS, "max_repeats": MAX_REPEATS, "target_entropy": None, "budget": None} | options
    rows = docs.withColumns(
        {"_source": source_name(F.col(source_col)), "_hash": _deal(id_col, text_col)}
    )
    narrow = stored(rows.select("_source", "_hash", word_count(F.col(text_col)).alias("_tokens")), "token-counts")
    sources, schedule = plan_blocks(narrow, **options)
    used = schedule.groupBy("_source", "_block").agg(
        F.count("*").alias("mix_copies"), F.min("_rank").alias("mix_rank")
    )
    taken = [c for c in docs.columns if c not in ("mix_copies", "mix_rank")]
    dealt = in_blocks(rows.drop("mix_copies", "mix_rank"), sources)
    return dealt.join(used, ["_source", "_block"]).select(*taken, "mix_copies", "mix_rank")


MIX_SQL = rf"""
    with t as (
        select doc_id, coalesce(source, '') as source, md5(coalesce(doc_id::varchar, text, '')) as h,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n_tokens
        from documents
    ),
    totals as (select source, sum(n_tokens)::bigint as tokens from t group by source),
    ends as (
        select max(tokens)::double as most, sum(tokens)::double as total,
            ln(max(tokens)::double / min(tokens)) as spread
        from totals where tokens > 0
    ),
    a as (
        select most, total,
            case when spread <= 0 then 0.0
                else round(greatest(0.0, 1 - ln({MAX_REPEATS}::double) / spread), 6) end as alpha
        from ends
    ),
    z as (select sum(pow(tokens::double, alpha)) as mass from totals, a where tokens > 0),
    sources as (
        select source, tokens,
            case when tokens > 0 then round(pow(tokens::double, alpha) / mass, 9) else 0.0 end as weight,
            case when tokens > 0 then round(pow(tokens::double / most, alpha - 1), 6) else 1.0 end as epochs,
            greatest(ceil(tokens::double / {BLOCK_TOKENS}), 1)::bigint as blocks
        from totals, a, z
    ),
    dealt as (
        select t.*, weight, ('0x' || substr(h, 1, 8))::bigint % blocks as block
        from t join sources using (source)
    ),
    cells as (select source, block, sum(n_tokens)::bigint as size from dealt group by source, block),
    each_epoch as (
        select source, block, size, tokens, epochs, floor(tokens * epochs)::bigint as budget,
            unnest(range(0, floor(epochs)::bigint + 1)) as epoch
        from cells join sources using (source)
    ),
    ranked as (
        select *, epoch * tokens + coalesce(sum(size) over (
            partition by source, epoch order by md5(source || '|' || epoch || '|' || block), block
            rows between unbounded preceding and 1 preceding), 0)::bigint as before
        from each_epoch
    )
    select doc_id, source, n_tokens, weight, block, epoch, before / greatest(budget, 1) as mix_rank
    from dealt join ranked using (source, block)
    where (epoch < floor(epochs) or before + size <= budget) and (epoch = 0 or size > 0)
"""
