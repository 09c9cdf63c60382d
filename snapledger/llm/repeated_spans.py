"""Remove every byte covered by a string of LENGTH bytes that also starts anywhere else.

A suffix array of all bytes needs many times the corpus on disk. Only sampled suffixes are
carried here: of all the positions in a window of LENGTH bytes, the one whose next GRAM bytes
have the smallest hash is its anchor, so equal windows have the same anchor at the same
distance. An anchor stands for a range of windows. Its tuple (hash of the gram, hash of the
whole range) goes through Spark's external sorts and groupings, and the answer is induced
for the windows in front of it, in ranges that become shorter:

* the gram occurs nowhere else: no window of the range is repeated;
* the whole range has an equal one: all are;
* otherwise the range is cut into parts of NODE windows. A part is decided in the same way,
  by what all its windows have in common and by all it covers, or window by window.

Every decision groups positions by the hash of a text range and keeps the smallest and the
largest position, so a passage in a third of all documents is never gathered anywhere.
Equality is that of 64-bit hashes. The result is exact but for their collisions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import ranges, stored, text_bytes

LENGTH = 400
GRAM = 100
NODE = 19
PIECE = (1 << 20) - 4096  # bytes looked at together; with a window more, below a power of two

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33, _S32 = np.uint64(33), np.uint64(32)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BYTES = np.random.default_rng(1).integers(0, 2**64, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 2**bits of them."""
    out = []
    for base in (_BASE, _INVERSE):
        x = np.full(1 << bits, base, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x))
    return out[0], out[1]


class Ranges:
    """Hashes of any byte ranges of a text, in constant time each."""

    def __init__(self, raw: bytes):
        n = len(raw)
        self.up, self.down = _powers(max(20, n.bit_length()))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[np.frombuffer(raw, np.uint8)] * self.up[:n], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray, tag: np.ndarray | int = 0) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.down[start]
        size = (np.asarray(end - start).astype(np.uint64) << _S32) + np.asarray(tag).astype(np.uint64)
        return _mix(value ^ _mix(size + _M2))


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values."""
    n = len(values) - width + 1
    pad = -len(values) % width
    blocks = np.concatenate((values, np.full(pad, 2**64 - 1, np.uint64))).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Per anchor: number of its text, its place there, the first and last window start it
    stands for, hash of its gram, hash of the range these windows cover."""
    raw = b"".join(texts)
    if len(raw) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(texts)), sizes)
    by = Ranges(raw)
    at = np.arange(len(raw) - gram + 1)
    grams = by.hash(at, at + gram)
    # The leftmost of equal ones, told by 32 bits of the hash.
    packed = (grams >> _S32 << _S32) | at.astype(np.uint64)
    chosen = (_lowest(packed, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.arange(len(raw) - length + 1)
    whole = owner[starts] == owner[starts + length - 1]
    starts, chosen = starts[whole], chosen[whole]
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1))))
    last = np.concatenate((new[1:], [len(starts)])) - 1
    x, low, high = chosen[new], starts[new], starts[last]
    cover = by.hash(low, high + length, (x - low) * 4096 + (x - high))
    text = owner[x]
    base = first[text]
    return text, x - base, low - base, high - base, grams[x].view(np.int64), cover.view(np.int64)


def anchors_of_long(raw: bytes, length: int, gram: int, piece: int) -> tuple[np.ndarray, ...]:
    """The anchors of one text, found in pieces of ``piece`` window starts, so that the work
    arrays do not grow with it. Windows of one anchor on both sides of a cut are put together."""
    found = []
    for at in range(0, max(1, len(raw) - length + 1), piece):
        _, x, low, high, g, w = anchors([raw[at : at + piece + length - 1]], length, gram)
        found.append(np.column_stack((x + at, low + at, high + at, g, w)))
    rows = np.concatenate(found)
    if len(found) > 1:
        joined = np.flatnonzero((rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 2] + 1))
        for i in joined[::-1]:
            x, low, high = rows[i, 0], rows[i, 1], rows[i + 1, 2]
            by = Ranges(raw[low : high + length])
            ends = np.array([0]), np.array([high + length - low])
            rows[i, 2], rows[i, 4] = high, by.hash(*ends, np.array([(x - low) * 4096 + (x - high)])).view(np.int64)[0]
        rows = np.delete(rows, joined + 1, axis=0)
    return np.zeros(len(rows), np.int64), *rows.T


def _anchor_rows(length: int, gram: int):
    names = ["t", "x", "low", "high", "g", "w"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            texts = text_bytes(batch.column(1))
            for start, end in ranges(texts, PIECE):
                if end == start + 1 and len(texts[start]) > PIECE:
                    text, *rest = anchors_of_long(texts[start], length, gram, PIECE)
                else:
                    text, *rest = anchors(texts[start:end], length, gram)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (keys[start:end][text], *rest)], names=names)

    return scan


def _contexts(length: int):
    """The bytes that the windows of each wanted anchor cover."""
    names = ["t", "x", "low", "high", "bytes"]
    types = [pa.int64()] * 4 + [pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, raw, wanted in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                rows = [(t, w["x"], w["low"], w["high"], raw[w["low"] : w["high"] + length]) for w in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names=names)

    return cut


def _node_rows(length: int, node: int):
    names = ["t", "x", "low", "high", "core", "cover"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts of fixed distances from the anchor: what their windows share and cover."""
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for t, x, low, high, raw in zip(*(c.to_pylist() for c in batch.columns)):
                by = Ranges(raw)
                j = np.arange((x - high) // node, (x - low) // node + 1)
                a, b = np.maximum(x - high, j * node), np.minimum(x - low, j * node + node - 1)
                core = by.hash(x - j * node - low, x - j * node - node + 1 + length - low, j)
                cover = by.hash(x - b - low, x - a + length - low, j * 1_000_000 + (a % node) * 1000 + b % node)
                for col, values in zip(out, ([t] * len(j), [x] * len(j), x - b, x - a, core.view(np.int64), cover.view(np.int64))):
                    col.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    return split


def _window_rows(length: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for t, first, low, high, raw in zip(*(c.to_pylist() for c in batch.columns)):
                at = np.arange(low, high + 1)
                value = Ranges(raw).hash(at - first, at - first + length)
                for col, values in zip(out, ([t] * len(at), at, value.view(np.int64))):
                    col.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["t", "low", "cover"])

    return windows


def repeated_starts(docs: DataFrame, text_col: str, length: int = LENGTH, gram: int = GRAM, node: int = NODE) -> DataFrame:
    """Per text (``t``: its hash) the ``starts`` of windows that also start anywhere else, as
    an array of [low, high] with both ends. Texts without any are left out."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text")).select(F.xxhash64("_text").alias("t"), "_text")
    schema = "t long, x long, low long, high long, g long, w long"
    every = stored(texts.mapInArrow(_anchor_rows(length, gram), schema), "anchors")
    grams = every.groupBy("g").agg(F.count("*").alias("c"), F.min("w").alias("w0"), F.max("w").alias("w1"))
    # Tables of their own, here and below, so that the rows of a frequent gram or text can be
    # split in the join.
    again = every.join(stored(grams.where("c > 1"), "repeated-grams"), "g")
    place = F.struct("t", "x", "low", "high")
    again = stored(again.select("t", "x", "low", "high", "g", "w", (F.col("w0") == F.col("w1")).alias("alike")), "gram-groups")
    found = [again.where("alike").select("t", "low", "high")]

    # Grams with several surroundings: one anchor for each, equal ones are settled.
    mixed = again.where("not alike")
    classes = mixed.groupBy("g", "w").agg(F.count("*").alias("c"), F.min(place).alias("p"))
    classes = stored(classes, "surroundings")
    found.append(mixed.join(classes.where("c > 1").select("g", "w"), ["g", "w"]).select("t", "low", "high"))
    wanted = classes.groupBy("p.t").agg(F.collect_list(F.struct("p.x", "p.low", "p.high")).alias("wanted"))
    wanted = stored(wanted, "wanted")
    # Copies of a text come with it and change nothing: positions are told apart by (t, x).
    contexts = stored(
        texts.join(wanted, "t").select("t", "_text", "wanted").mapInArrow(
            _contexts(length), "t long, x long, low long, high long, bytes binary"
        ).dropDuplicates(["t", "x"]),
        "contexts",
    )

    nodes = stored(
        contexts.mapInArrow(_node_rows(length, node), "t long, x long, low long, high long, core long, cover long"),
        "nodes",
    )
    ends = lambda key: nodes.groupBy(key).agg(
        F.min(F.struct("t", "x")).alias("p0"), F.max(F.struct("t", "x")).alias("p1")
    )
    shared = nodes.join(ends("core").where("p0 <> p1").select("core"), "core")
    shared = stored(shared.join(ends("cover").select("cover", "p0", (F.col("p0") != F.col("p1")).alias("all")), "cover"), "shared-nodes")
    found.append(shared.where("all").select("t", "low", "high"))
    # One of each cover goes on, where a core has several covers.
    several = shared.groupBy("core").agg(F.min("cover").alias("c0"), F.max("cover").alias("c1")).where("c0 <> c1")
    going = shared.where("p0.t = t and p0.x = x").join(several.select("core"), "core").select("t", "x", "low", "high")
    leaves = (
        going.join(contexts.select("t", "x", F.col("low").alias("first"), "bytes"), ["t", "x"])
        .select("t", "first", "low", "high", "bytes")
        .mapInArrow(_window_rows(length), "t long, low long, cover long")
    )
    leaves = stored(leaves, "windows")
    spot = F.struct("t", "low")
    twice = leaves.groupBy("cover").agg(F.min(spot).alias("p0"), F.max(spot).alias("p1")).where("p0 <> p1")
    hit = leaves.join(twice.select("cover"), "cover")
    found.append(hit.select("t", "low", F.col("low").alias("high")))

    intervals = found[0]
    for more in found[1:]:
        intervals = intervals.union(more)
    return intervals.distinct().groupBy("t").agg(F.collect_list(F.array("low", "high")).alias("starts"))


def _spans(starts: list[list[int]] | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(starts or ()):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high + length))
        else:
            out.append((low, high + length))
    return out


def _removed(length: int, text_at: int, with_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = text_bytes(batch.column(text_at))
            spans = [_spans(s, length) for s in batch.column(batch.num_columns - 1).to_pylist()]
            kept = []
            for text, own in zip(raw, spans):
                parts, done = [], 0
                for start, end in own:
                    parts.append(text[done:start])
                    done = end
                kept.append(b"".join([*parts, text[done:]]))
            cols, names = batch.columns[:-1], batch.schema.names[:-1]
            if with_text:
                cols[text_at] = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
            else:
                cols = [
                    c for i, c in enumerate(cols) if i != text_at
                ] + [
                    pa.array([len(t) for t in raw], pa.int64()),
                    pa.array([sum(b - a for a, b in own) for own in spans], pa.int64()),
                    pa.array([len(own) for own in spans], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ]
                names = [n for i, n in enumerate(names) if i != text_at] + ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return remove


def _with_starts(docs: DataFrame, text_col: str, length: int, gram: int, node: int) -> DataFrame:
    starts = stored(repeated_starts(docs, text_col, length, gram, node).withColumnRenamed("t", "_t"), "starts")
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.withColumn("_t", key).join(starts.withColumnRenamed("starts", "_starts"), "_t", "left").drop("_t")


def remove_repeats(
    docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, node: int = NODE
) -> DataFrame:
    """``docs`` with the kept bytes as text. Where a cut falls inside a character, what is left
    of it goes as well. Other columns, nulls and repeated rows are as they were (a null text
    becomes empty)."""
    found = _with_starts(docs, text_col, length, gram, node)
    at = found.columns.index(text_col)
    return found.mapInArrow(_removed(length, at, True), docs.select(*found.columns[:-1]).schema).select(*docs.columns)


def repeat_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, node: int = NODE
) -> DataFrame:
    """Per document: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of the bytes that
    stay. Null counts as empty; texts shorter than ``length`` keep all; of equal texts none
    keeps a window. An empty table gives no rows, other columns are not read."""
    found = _with_starts(docs.select(F.col(id_col), F.col(text_col)), text_col, length, gram, node)
    kind = dict(docs.dtypes)[id_col]
    return found.mapInArrow(
        _removed(length, 1, False), f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
