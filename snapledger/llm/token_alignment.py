"""Alignment of two tokenizations of the same text, and the pairs of ids that go together.

Both tokenizers cover the same bytes, so their tokens are told by where they end. The
shorter list of ends drives a galloping search in the longer one: from where the end before
was found, steps of growing length until they are past it, then a binary search. Ends that
both lists have cut the text into groups; the ranks found for the start and the end of a
token are the range of tokens of the other side that it overlaps.

Pairs of ids that overlap somewhere in a document count once for it. Every document then
needs the counts of its own pairs: pairs are counted per run of documents, so that a pair
which every document has is one row of a run, and a run's counts meet its documents in one
pass, sorted in front of them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import stored

# Vocabulary files of public tokenizers; paths as the tasks see them.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"

_PIECE = 1 << 16  # characters of a text tokenized at once, about
_BATCH = 1 << 20  # characters aligned at once, about
_LEADER = 32  # ends of the shorter list that start from one place of the longer one
# A single space between ASCII letters or digits: neither tokenizer joins over it.
_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")

_DONE = (
    "id {id}, run int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<long>"
)


# Fixed value: how byte-level BPE of this kind cuts a text into words.
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters that are letters, digits or spaces in every version of the character tables or
# in none. Texts with others are left to the library the file belongs to.
_OTHER = re.compile(r"[^\x00-\u02ff\u2010-\u2027\u20ac]")


class ByteBpe:
    """Byte-level BPE of a ``tokenizers`` file; special tokens are plain text. Where the
    order of ids is that of the merges, as it is in the usual vocabularies, most texts are
    encoded by ``tiktoken`` from the same vocabulary, in a third of the time."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._bpe = Tokenizer.from_file(path)
        self._bpe.encode_special_tokens = True
        shown = _byte_letters()
        size = self._bpe.get_vocab_size(with_added_tokens=True)
        tokens = [self._bpe.id_to_token(i) or "" for i in range(size)]
        self.bytes = [bytes(shown[c] for c in t) if all(c in shown for c in t) else t.encode() for t in tokens]
        self._fast = self._ranked(path)

    def _ranked(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, words = whole["model"], whole["pre_tokenizer"] or {}
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", ())]
        order = [model["vocab"][m] for m in merges]
        single = {i for i, b in enumerate(self.bytes) if len(b) == 1}
        plain = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space")
        if not plain or whole.get("normalizer") or order != sorted(order) or len(single) != 256:
            return None
        ranks = {self.bytes[i]: i for i in {*single, *order}}
        return tiktoken.Encoding("byte-bpe", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._fast is None:
            return self._slow(texts)
        others = [i for i, t in enumerate(texts) if _OTHER.search(t)]
        left = dict(zip(others, self._slow([texts[i] for i in others])))
        return [left[i] if i in left else self._fast.encode_ordinary(t) for i, t in enumerate(texts)]

    def _slow(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._bpe.encode_batch_fast(texts, add_special_tokens=False)]


class PieceBpe:
    """BPE of a ``sentencepiece`` file, which puts a space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._bpe = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self._bpe.get_piece_size()
        names = [self._bpe.id_to_piece(i) for i in range(n)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self._bpe.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)
        ]
        # A piece with a space behind other letters could lie over a cut.
        self.cuts = not any("▁" in p.lstrip("▁") for p in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._bpe.encode(texts, num_threads=1)


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones of Latin-1
    stand for themselves, the others, in order, are the letters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def _aligner(byte_bpe: str, piece_bpe: str) -> _Aligner:
    return _Aligner(ByteBpe(byte_bpe), PieceBpe(piece_bpe))


def pieces(text: str, limit: int = _PIECE) -> list[str]:
    """A text cut, where it is long, at spaces no token lies over. Each piece but the first
    is short of the space it starts with, which both tokenizers get back."""
    out, start = [], 0
    while len(text) - start > limit and (cut := _CUT.search(text, start + limit)):
        out.append(text[start : cut.start()])
        start = cut.end()
    return [*out, text[start:]]


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For every value of ``short`` the number of smaller values in ``long``; both ascend.
    Every value gallops from the place of its leader, the last one of those ``_LEADER`` apart:
    steps of double length until past the value, then halves of the last step."""
    leaders = np.searchsorted(long, short[::_LEADER])
    low = np.repeat(leaders, _LEADER)[: len(short)]
    high = low.copy()
    step, going = 1, np.flatnonzero(_below(long, high, short))
    while len(going):
        low[going] = high[going] + 1
        high[going] += step
        step *= 2
        going = going[_below(long, high[going], short[going])]
    high = np.minimum(high, len(long))
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) >> 1
        under = long[middle] < short[open_]
        low[open_[under]] = middle[under] + 1
        high[open_[~under]] = middle[~under]
    return low


def _below(values: np.ndarray, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Whether the value at a place is below the limit; none is behind the end."""
    inside = at < len(values)
    out = np.zeros(len(at), bool)
    out[inside] = values[at[inside]] < limit[inside]
    return out


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers of both sides of every overlapping pair, in text order, and the numbers
    (from 1) of the tokens of a and b that end a group."""
    swap = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    rank = gallop(short, long)
    common = np.flatnonzero(long[np.minimum(rank, len(long) - 1)] == short)
    # A token overlaps from the one in which it starts to the one in which it ends.
    met = np.zeros(len(short), np.int64)
    met[common] = 1
    first = np.concatenate(([0], (rank + met)[:-1]))
    width = rank - first + 1
    mine = np.repeat(np.arange(len(short)), width)
    before = np.concatenate(([0], np.cumsum(width)[:-1]))
    other = np.arange(len(mine)) - np.repeat(before - first, width)
    cut_short, cut_long = common + 1, rank[common] + 1
    return (other, mine, cut_long, cut_short) if swap else (mine, other, cut_short, cut_long)


class _Aligner:
    def __init__(self, byte_bpe: ByteBpe, piece_bpe: PieceBpe):
        self.a, self.b = byte_bpe, piece_bpe
        self.size_a, self.size_b = (np.fromiter(map(len, x.bytes), np.int64) for x in (self.a, self.b))
        # Every id with what may follow it in the text of the groups.
        self.most = max(len(self.a.bytes), len(self.b.bytes))
        self.shown = [b"%d%c" % (i, mark) for mark in b",|;" for i in range(self.most)]
        self.limit = _PIECE if piece_bpe.cuts else None

    def align(self, texts: list[str]) -> list[tuple]:
        """Per text: tokens of both, groups, links, hash of the groups, pairs of ids and how
        often each links. Texts whose bytes a tokenizer does not give back have none."""
        parts = [pieces(t, self.limit or max(1, len(t))) if t else [] for t in texts]
        flat = [p for some in parts for p in some]
        ids = self.a.encode([" " + p for p in flat]), self.b.encode(flat)
        out: list[tuple] = [(0, 0, 0, 0, "", [], [])] * len(texts)
        whole, first, k = [], [], 0
        for i, some in enumerate(parts):
            if some and all(self._same(flat[j], ids[0][j], ids[1][j]) for j in range(k, k + len(some))):
                whole.append(i)
                first.append(k)
            k += len(some)
        if whole:
            for i, row in zip(whole, self._aligned([slice(f, f + len(parts[i])) for i, f in zip(whole, first)], *ids)):
                out[i] = row
        return out

    def _same(self, piece: str, a: list[int], b: list[int]) -> bool:
        raw = (" " + piece).encode()
        return b"".join(map(self.a.bytes.__getitem__, a)) == raw == b"".join(map(self.b.bytes.__getitem__, b))

    def _aligned(self, places: list[slice], ids_a: list, ids_b: list) -> Iterator[tuple]:
        """Rows of texts that both tokenizers give back, all at once: their tokens one behind
        the other, so that a text is a run of groups."""
        counts, joined = [], []
        for ids in (ids_a, ids_b):
            own = [list(chain.from_iterable(ids[p])) for p in places]
            counts.append(np.cumsum([0, *map(len, own)]))
            joined.append(np.fromiter(chain.from_iterable(own), np.int64, counts[-1][-1]))
        a, b = joined
        at_a, at_b, cuts_a, cuts_b = overlaps(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
        # Groups of every text, and the bytes that show them: each token behind those before it.
        groups = np.searchsorted(cuts_a, counts[0], "right")
        mark_a, mark_b = (np.zeros(len(x), np.int64) for x in (a, b))
        mark_a[cuts_a - 1], mark_b[cuts_b - 1] = 1, 2
        before_a = np.concatenate(([0], cuts_a))[np.searchsorted(cuts_b, np.arange(len(b)), "right") + 1]
        before_b = np.concatenate(([0], cuts_b))[np.searchsorted(cuts_a, np.arange(len(a)), "right")]
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before_b] = a + mark_a * self.most
        order[np.arange(len(b)) + before_a] = b + mark_b * self.most
        shown = list(map(self.shown.__getitem__, order.tolist()))
        # Links of every text, and its pairs of ids.
        text = np.searchsorted(counts[0], at_a, "right") - 1
        width = len(self.size_b)
        span = len(self.size_a) * width
        keys, times = np.unique(text * span + a[at_a] * width + b[at_b], return_counts=True)
        links = np.searchsorted(text, np.arange(len(places) + 1))
        cuts = np.searchsorted(keys, np.arange(len(places) + 1) * span)
        codes = keys % span
        pairs = (codes // width << 32) | codes % width
        for i, (low_a, high_a, low_b, high_b) in enumerate(zip(counts[0], counts[0][1:], counts[1], counts[1][1:])):
            raw = b"".join(shown[low_a + low_b : high_a + high_b])
            own = slice(cuts[i], cuts[i + 1])
            yield (
                int(high_a - low_a),
                int(high_b - low_b),
                int(groups[i + 1] - groups[i]),
                int(links[i + 1] - links[i]),
                hashlib.sha256(raw[:-1]).hexdigest(),
                pairs[own],
                times[own],
            )


def _tokenize(byte_bpe: str, piece_bpe: str):
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        aligner = _aligner(byte_bpe, piece_bpe)
        for batch in batches:
            sizes = np.cumsum(_lengths(batch.column(2)))
            start = 0
            while start < batch.num_rows:
                done = sizes[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(sizes, done + _BATCH, "right")))
                part = batch.slice(start, end - start)
                start = end
                columns = list(zip(*aligner.align([t or "" for t in part.column(2).to_pylist()])))
                types = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(c, t) for c, t in zip(columns, types)]],
                    names=["id", "run", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    return tokenize


def _lengths(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE
) -> DataFrame:
    """Stored table of the alignment of every document: id, run (the input partition it was
    read with), n_a, n_b, n_groups, n_links, groups_sha256, and the pairs of ids that overlap
    (id of a times 2**32 plus id of b) with the number of times each does."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.spark_partition_id().alias("run"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(_tokenize(byte_bpe, piece_bpe), _DONE.format(id=kind)), "alignments")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Stored table of run, pair, the number of documents of all runs that hold it linked, and
    whether no other pair of the same id of a has a higher one."""
    by_run = stored(
        aligned.select("run", F.explode("pairs").alias("pair")).groupBy("run", "pair").agg(F.count("*").alias("n")), "run-pairs"
    )
    counts = stored(by_run.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    best = counts.withColumn("a", a).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    return stored(by_run.select("run", "pair").join(best, "pair"), "counted-pairs").select("run", "pair", "n", "best")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by run, its counted pairs before its documents. Documents with the
    number of links whose pair is best, and the sum of the counts of all links."""
    of, pairs, counts, best, fresh = None, [], [], [], True
    for batch in batches:
        runs = batch.column("run").to_numpy()
        is_doc = batch.column("is_doc").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((runs[1:] != runs[:-1]) | (is_doc[1:] != is_doc[:-1])) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            if runs[start] != of:
                of, pairs, counts, best = runs[start], [], [], []
            if not is_doc[start]:
                pairs.append(part.column("pair").to_numpy())
                counts.append(part.column("n").to_numpy())
                best.append(part.column("best").to_numpy(zero_copy_only=False).astype(bool))
                fresh = True
                continue
            if fresh and pairs:
                pair, count, is_best = (np.concatenate(x) for x in (pairs, counts, best))
                fresh = False
            own, times = part.column("pairs"), part.column("times").flatten().to_numpy()
            sizes = np.asarray(own.value_lengths())
            found = own.flatten().to_numpy()
            totals = np.zeros((2, len(sizes) + 1), np.int64)
            if len(found):
                at = np.searchsorted(pair, found)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                for row, value in zip(totals, (is_best[at], count[at])):
                    row[:] = np.concatenate(([0], np.cumsum(times * value)))[bounds]
            n_best, count_sum = totals[:, 1:] - totals[:, :-1]
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")],
                    pa.array(n_best),
                    pa.array(count_sum),
                    part.column("groups_sha256"),
                ],
                names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def align_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE
) -> DataFrame:
    """One row per document: the id column, n_a, n_b, n_groups, n_links, n_best (links whose
    pair is the most frequent one of its id of a), count_sum (documents that hold the pair,
    over all links) and groups_sha256.

    Null and empty texts, and texts a tokenizer does not give back byte by byte, have zeros and
    an empty hash. Every row is a document of its own, also if ids repeat or are null. An empty
    table gives no rows; other columns are not read, whatever their names. Long texts are
    tokenized in pieces, cut where neither tokenizer can tell the difference.
    """
    aligned = align(docs, id_col, text_col, byte_bpe, piece_bpe)
    kind = aligned.schema["id"].dataType.simpleString()
    counted = pair_counts(aligned).select(F.lit(False).alias("is_doc"), "run", "pair", "n", "best")
    documents = aligned.withColumn("is_doc", F.lit(True))
    both = counted.unionByName(documents, allowMissingColumns=True)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(parts, "run").sortWithinPartitions("run", "is_doc", "pair")
    sums = dealt.mapInArrow(
        _sums, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
    return sums.withColumnRenamed("id", id_col)
