"""Ranked lexical search with the Best Position Algorithm.

Each term of an item has an impact list: the documents that hold it, by falling impact. The
lists are read from their heads side by side; every document met is looked up in all other
lists at once (direct access), which gives its whole score and marks its positions there as
seen. The best position of a list is the end of its unbroken run of seen positions, often
far beyond the last one read. No document that has not been met can score more than the
weighted impacts at the best positions together, so reading stops when that is strictly
below the lowest score kept; at an equal score a document with a smaller id might be missing.

Documents are searched where they are read: a task builds the lists of a bounded number of
postings, ranks all items of a block on them, and takes the lowest score it has kept for an
item along to the next lists. Neither documents nor postings are shuffled. Items come in
blocks of at most ``BLOCK_TERMS`` different (item, term) pairs, about; only one block at a
time is held by the driver and sent to the tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import ascii_lower, stored

TOP = 20
BLOCK_TERMS = 200_000  # (item, term) pairs of a block, about
POSTINGS = 1 << 20  # postings in the lists of a task at a time, about

# Fixed values of the score.
SCALE, LENGTH, SHARE = 1_000_000_000, 12, 25

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_PIECE = 1 << 20  # bytes of a text split into words at once
_STEP = 64  # positions read from each list in the first round

# A to Z in lower case, word bytes as they are, all others a space.
_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_SPACE = re.compile(rb" ")


def words(text: bytes) -> Iterator[list[bytes]]:
    """The lower-case words of a text, in lists of about ``_PIECE`` bytes."""
    clean = text.translate(_WORDS)
    start = 0
    while start < len(clean):
        cut = _SPACE.search(clean, start + _PIECE)
        end = cut.start() if cut else len(clean)
        yield clean[start:end].split()
        start = end


def count_words(text: bytes) -> tuple[int, Counter]:
    n, counts = 0, Counter()
    for some in words(text):
        n += len(some)
        counts.update(some)
    return n, counts


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Row number, id, term and number of times it occurs in the item."""
    rows = stored(
        items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("id"), F.col(text_col).alias("text")),
        "items",
    )
    found = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(_WORD), F.lit(0))
    return rows.select("item", "id", F.explode(found).alias("term")).groupBy("item", "id", "term").agg(F.count("*").alias("times"))


def _postings(vocabulary):
    """Row number and id of every document, its number of terms, and the numbers and
    frequencies of those in the vocabulary."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            lengths, terms, freqs = [], [], []
            for text in batch.column(1):
                n, counts = count_words(text.as_buffer().to_pybytes() if text.is_valid else b"")
                held = [t for t in counts if t in number]
                lengths.append(n)
                terms.append([number[t] for t in held])
                freqs.append([counts[t] for t in held])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(freqs, pa.list_(pa.int64()))],
                names=["id", "n", "terms", "freqs"],
            )

    return read


@dataclass
class Lists:
    """Impact lists of some documents, one behind the other, and where each document is in
    them. Entry ``i`` of ``doc_terms`` is one posting by document; ``place[i]`` is its place
    in the lists, ``impact`` and ``doc`` are by place."""

    starts: np.ndarray  # first place of every term's list, and the end of the last
    doc: np.ndarray
    impact: np.ndarray
    doc_starts: np.ndarray
    doc_terms: np.ndarray
    place: np.ndarray

    @classmethod
    def build(cls, n_terms: int, mean: tuple[int, int], lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, freqs: np.ndarray) -> Lists:
        """``mean`` is the number of documents that count and of all their terms."""
        docs, total = mean
        m = 100 - SHARE + (SHARE * lengths * docs) // total
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        impact = (SCALE * freqs) // (1000 * freqs + LENGTH * m[owner])
        order = np.lexsort((-impact, terms))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        return cls(starts, owner[order], impact[order], np.concatenate(([0], np.cumsum(sizes))), terms, place)

    def search(self, terms: np.ndarray, weights: np.ndarray, slot: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the ``top`` best, with their scores: all that reach
        the lowest of them, and ``least``. ``weights`` are those of ``terms``, repeats
        included; ``slot`` is a work array with -1 for every term."""
        low, high = self.starts[terms], self.starts[terms + 1]
        used = (high > low) & (weights > 0)
        terms, weights, low, high = terms[used], weights[used], low[used], high[used]
        if not len(terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        slot[terms] = np.arange(len(terms))
        flat = np.zeros((high - low).sum(), bool)
        offset = np.concatenate(([0], np.cumsum(high - low)[:-1]))
        seen = [flat[a : a + n] for a, n in zip(offset, high - low)]
        met = np.zeros(len(self.doc_starts) - 1, bool)
        best, read, step = np.zeros(len(terms), np.int64), 0, _STEP
        kept_docs, kept_scores = np.empty(0, np.int64), np.empty(0, np.int64)
        while True:
            heads = [self.doc[a + read : min(a + read + step, b)] for a, b in zip(low, high)]
            fresh = np.unique(np.concatenate(heads))
            fresh = fresh[~met[fresh]]
            met[fresh] = True
            # Direct access: all postings of the new documents, then those of the item's terms.
            sizes = self.doc_starts[fresh + 1] - self.doc_starts[fresh]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.doc_starts[fresh] - (ends - sizes), sizes)
            kind = slot[self.doc_terms[at]]
            mine = np.flatnonzero(kind >= 0)
            kind, place = kind[mine], self.place[at[mine]]
            sums = np.concatenate(([0], np.cumsum(weights[kind] * self.impact[place])))
            cuts = np.searchsorted(mine, np.concatenate(([0], ends)))
            scores = sums[cuts[1:]] - sums[cuts[:-1]]
            flat[place + (offset - low)[kind]] = True
            read, step = read + step, step * 2
            for k in range(len(terms)):
                rest = seen[k][best[k] :]
                gap = int(rest.argmin()) if len(rest) else 0
                best[k] += len(rest) if len(rest) and rest[gap] else gap
            kept_docs, kept_scores = np.concatenate((kept_docs, fresh)), np.concatenate((kept_scores, scores))
            if len(kept_scores) >= top:
                least = max(least, int(np.partition(kept_scores, -top)[-top]))
            keep = kept_scores >= max(least, 1)
            kept_docs, kept_scores = kept_docs[keep], kept_scores[keep]
            # The impact at the best position; nothing is left behind the end of a list.
            bound = np.where(low + best < high, weights * self.impact[low + best - 1], 0).sum()
            if bound < least or bound == 0:
                break
        slot[terms] = -1
        return kept_docs, kept_scores


def _search(block, mean: tuple[int, int], top: int, limit: int):
    """Best documents of every item of the block in these rows: item, id, score."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_terms, items = block.value
        slot = np.full(n_terms, -1, np.int32)
        least = dict.fromkeys(items, 0)
        best: dict[int, np.ndarray] = {}

        def rank(part: pa.Table) -> Iterator[pa.RecordBatch]:
            column = lambda c: part.column(c).combine_chunks()
            terms, freqs = column("terms"), column("freqs")
            ids = column("id")
            lists = Lists.build(
                n_terms,
                mean,
                column("n").to_numpy(),
                np.asarray(terms.value_lengths()),
                terms.flatten().to_numpy(),
                freqs.flatten().to_numpy(),
            )
            for item, (own, weights) in items.items():
                docs, scores = lists.search(own, weights, slot, top, least[item])
                if not len(docs):
                    continue
                known = np.concatenate((best.get(item, scores[:0]), scores))
                best[item] = np.sort(known)[-top:]
                if len(best[item]) == top:
                    least[item] = int(best[item][0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(docs), item, np.int64)), ids.take(pa.array(docs)), pa.array(scores)],
                    names=["item", "doc", "score"],
                )

        held, size = [], 0
        for batch in batches:
            start = 0
            sizes = np.cumsum(np.asarray(batch.column("terms").value_lengths()))
            while start < batch.num_rows:
                done = sizes[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(sizes, done + limit - size, "right")))
                held.append(batch.slice(start, end - start))
                size += int(sizes[end - 1] - done)
                start = end
                if size >= limit or start < batch.num_rows:
                    yield from rank(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield from rank(pa.Table.from_batches(held))

    return search


def _block(rows: list, counts: dict[int, int], number: dict[bytes, int], docs: int) -> tuple[int, dict]:
    """Number of terms, and per item the terms that occur with their weights."""
    df = np.array([counts.get(i, 0) for i in range(len(number))], np.float64)
    weight = np.floor(1000 * np.log((2.0 * docs + 2) / (2 * df + 1))).astype(np.int64)
    grouped: dict[int, list] = {}
    for r in rows:
        grouped.setdefault(r["item"], []).append((number[r["term"].encode()], r["times"]))
    items = {}
    for item, found in grouped.items():
        terms, times = np.array(found, np.int64).T
        items[item] = terms, weight[terms] * times
    return len(number), items


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
    postings: int = POSTINGS,
) -> DataFrame:
    """The ``top`` documents of every item by score: item id, ``rank`` from 1, document id and
    ``score``. Equal scores go by ascending id, null ids last; only scores above 0 count.

    Null and empty texts have no terms: such items give no rows, such documents are never
    found and do not count in any statistic. Every row is an item or a document of its own,
    also if ids repeat; equal rows of both are interchangeable. Without items or documents
    there are no rows. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    terms = stored(item_terms(items, item_id, item_text), "item-terms")
    blocks = max(1, -(-terms.count() // block_terms))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    results = []
    for k in range(blocks):
        rows = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).select("item", "term", "times").collect()
        number = {t: i for i, t in enumerate(sorted({r["term"].encode() for r in rows}))}
        sent = spark.sparkContext.broadcast(number)
        found = stored(
            texts.mapInArrow(_postings(sent), f"id {kind}, n long, terms array<int>, freqs array<long>"), "postings"
        )
        total = found.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        counts = {r["term"]: r["n"] for r in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
        if total["docs"]:
            block = spark.sparkContext.broadcast(_block(rows, counts, number, total["docs"]))
            ranked = found.where(F.size("terms") > 0).mapInArrow(
                _search(block, (total["docs"], total["terms"]), top, postings), f"item long, doc {kind}, score long"
            )
            results.append(stored(ranked, "ranked"))
    names = terms.select("item", "id").distinct()
    if not results:
        named = items.schema[item_id].dataType.simpleString()
        return spark.createDataFrame([], f"`{item_id}` {named}, rank int, `{id_col}` {kind}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    best = reduce(DataFrame.union, results).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(names, "item").select(F.col("id").alias(item_id), "rank", F.col("doc").alias(id_col), "score")


RANK_SQL = """
    with d as (
        select row_number() over () as r, doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as ws
        from documents
    ),
    lengths as (select r, doc_id, len(ws)::bigint as n from d where len(ws) > 0),
    corpus as (select count(*)::bigint as docs, sum(n)::bigint as terms from lengths),
    postings as (select r, t, count(*)::bigint as tf from (select r, unnest(ws) as t from d) group by r, t),
    weights as (
        select t, floor(1000 * ln((2.0::double * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w
        from postings, corpus group by t
    ),
    items as (
        select item, item_id, unnest(ws) as t from (
            select row_number() over () as item, item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as ws
            from benchmark)
    ),
    scores as (
        select item, item_id, doc_id, r,
            sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::bigint as score
        from items join postings using (t) join weights using (t) join lengths using (r), corpus
        group by all
    ),
    ranked as (
        select *, row_number() over (partition by item order by score desc, doc_id nulls last, r) as rank
        from scores where score > 0
    )
    select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20
"""
