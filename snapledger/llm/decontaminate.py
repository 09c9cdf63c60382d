"""Benchmark passages in documents, by a suffix automaton of the test items.

The words of all items form one generalised suffix automaton. A document's words are
streamed through it, and the length of the longest item passage that ends at each word is
tracked. Where that length reaches the window, all its words are hit. Words that no item
uses reset the automaton, so only runs of known words that are long enough for a window
are streamed.

Items are stored in the shared folder in blocks of about ``BLOCK_WORDS`` words, longer ones
in overlapping parts. A task holds the automaton of one block at a time and takes the texts
of a batch through one block after the other, so neither the driver nor a task holds more as
the benchmark grows. The documents themselves are not shuffled.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.llm.common import ascii_lower, release, slices, text_bytes
from snapledger.llm.warc_zip import filesystem
from snapledger.session import shared_dir

WINDOW = 10
BLOCK_WORDS = 100_000

# A to Z become lower case; all other ASCII characters but digits and a to z separate
# words. Bytes from 0x80 on belong to characters outside ASCII, which are word characters.
_LOWER = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


class Automaton:
    """Generalised suffix automaton over the words of items.

    ``items``: (item id or None, words). ``full`` items may end a match by themselves
    although they are shorter than the window.
    """

    def __init__(self, items: list[tuple[str | None, tuple[bytes, ...]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        # Items per state, collected along the suffix links of all their prefixes.
        self.found: list[set[str]] = [set() for _ in self.link]
        short: dict[int, list[tuple[int, str | None]]] = {}
        self.shortest = window
        for k, (name, codes) in enumerate(coded):
            seen: set[int] = set()
            state = 0
            for c in codes:
                state = self.next[state][c]
                up = state
                while up > 0 and up not in seen:
                    seen.add(up)
                    if name is not None:
                        self.found[up].add(name)
                    up = self.link[up]
            if 0 < len(codes) < window:
                short.setdefault(state, []).append((len(codes), name))
                self.shortest = min(self.shortest, len(codes))
        # Per state: where its suffix of window words lives, and the short items among its suffixes.
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.anchor = [0] * len(self.link)
        self.short: list[list[tuple[int, str | None]]] = [[] for _ in self.link]
        for v in order:
            up = self.link[v]
            self.anchor[v] = self.anchor[up] if self.length[up] >= window else v
            self.short[v] = short.get(v, []) + self.short[up] if v in short else self.short[up]

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._clone(last, known, c)
        new = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and c not in self.next[last]:
            self.next[last][c] = new
            last = self.link[last]
        if last >= 0:
            known = self.next[last][c]
            whole = self.length[known] == self.length[last] + 1
            self.link[new] = known if whole else self._clone(last, known, c)
        return new

    def _clone(self, last: int, known: int, c: int) -> int:
        clone = self._state(self.length[last] + 1, dict(self.next[known]), self.link[known])
        self.link[known] = clone
        while last >= 0 and self.next[last].get(c) == known:
            self.next[last][c] = clone
            last = self.link[last]
        return clone

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, int]], set[str]]:
        """Hit word ranges [start, end), merged, each with 1 if it holds a whole item shorter
        than the window, else 0; and the items with occurring windows."""
        none = ([], set())
        if len(words) < self.shortest:
            return none
        codes = np.fromiter((self.ids.get(w, -1) for w in words), np.int32, len(words))
        edge = np.diff(np.concatenate(([0], (codes >= 0).view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - starts >= self.shortest
        if not long.any():
            return none
        spans: list[tuple[int, int, int]] = []
        names: set[str] = set()
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            self._stream(codes[start:end].tolist(), start, spans, names)
        return spans, names

    def _stream(self, codes: list[int], at: int, spans: list, names: set[str]) -> None:
        follow, link, length, window = self.next, self.link, self.length, self.window
        short = self.short if self.shortest < window else None
        state = matched = 0
        for end, c in enumerate(codes, at + 1):
            to = follow[state].get(c)
            while to is None:
                state = link[state]
                matched = length[state]
                to = follow[state].get(c)
            state = to
            matched += 1
            hit = whole = 0
            if matched >= window:
                hit = matched
                names |= self.found[self.anchor[state]]
            if short is not None:
                for size, name in short[state]:
                    if size <= matched:
                        hit, whole = max(hit, size), 1
                        if name is not None:
                            names.add(name)
            if hit:
                start = end - hit
                while spans and start <= spans[-1][1]:
                    first, _, held = spans.pop()
                    start, whole = min(start, first), max(whole, held)
                spans.append((start, end, whole))


def item_blocks(
    items: DataFrame, id_col: str, text_col: str, window: int, block_words: int
) -> tuple[str, int]:
    """Store the items in blocks of about ``block_words`` words: their folder and number. A
    longer item is cut into parts that overlap by all but one word of a window, so that no
    window is lost."""
    pattern = F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = F.regexp_extract_all(ascii_lower(F.col(text_col).cast("string")), pattern, F.lit(0))
    rows = items.select(F.col(id_col).cast("string").alias("name"), words.alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last, F.lit(max(1, block_words - window + 1))))
    parts = rows.select("name", "words", starts.alias("start")).select(
        "name", F.slice("words", F.col("start") + 1, block_words).alias("words")
    )
    total = parts.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks, root = -(-total // block_words), shared_dir(items.sparkSession, "item-blocks")
    if blocks:
        number = F.pmod(F.xxhash64("words"), F.lit(blocks))
        parts.withColumn("block", number).write.partitionBy("block").json(root)
    return root, blocks


@lru_cache(maxsize=1)
def _automaton(root: str, block: int, window: int) -> Automaton | None:
    """Built once per Python worker, as long as it stays with the block. None for a block
    that no item fell into."""
    fs, path = filesystem(f"{root}/block={block}")
    if fs.get_file_info(path).type != pafs.FileType.Directory:
        return None
    rows = []
    for file in fs.get_file_info(pafs.FileSelector(path)):
        if not file.base_name.startswith((".", "_")):
            with fs.open_input_stream(file.path) as lines:
                rows += map(json.loads, lines.read().splitlines())
    # In an order of their own, so that every task builds the same automaton.
    items = sorted(((r.get("name"), tuple(w.encode() for w in r["words"])) for r in rows), key=lambda r: (r[1], r[0] or ""))
    return Automaton(items, window)


_FOUND = T.StructType(
    [
        T.StructField("_n_words", T.LongType()),
        T.StructField("_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("_items", T.ArrayType(T.StringType())),
    ]
)


def _merged(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end, whole in sorted(map(tuple, spans)):
        if out and start <= out[-1][1]:
            out[-1][1:] = max(out[-1][1], end), max(out[-1][2], whole)
        else:
            out.append([start, end, whole])
    return out


def _matches(texts: list[bytes], root: str, blocks: int, window: int) -> list[tuple]:
    """Number of words, hit spans and items of every text."""
    found: list[tuple] = [(len(words_of(t)), [], []) for t in texts]
    for block in range(blocks):
        automaton = _automaton(root, block, window)
        if automaton is None:
            continue
        for i, text in enumerate(texts):
            spans, names = automaton.scan(words_of(text))
            if spans:
                n, old, known = found[i]
                found[i] = n, _merged([*spans, *old]), sorted(names.union(known))
    return found


def _batches(batches: Iterator[pa.RecordBatch], text_at: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """Pieces of batches: small ones, unless every piece has to load several blocks."""
    for batch in batches:
        yield from slices(batch, text_at) if blocks < 2 else [batch]
        release()


def _scan(root: str, blocks: int, window: int, text_at: int) -> Callable:
    types = [pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, text_at, blocks):
            rows = _matches(text_bytes(batch.column(text_at)), root, blocks, window)
            arrays = [pa.array(x, t) for x, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *_FOUND.names])

    return scan


def match_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with ``_n_words``, ``_spans`` (hit word ranges [start, end), merged and in
    order, and 1 if a whole item shorter than the window is in it, else 0) and ``_items``
    (sorted ids, as strings, of items with an occurring window).

    A window is ``window`` consecutive words of one item; an item with fewer words, but
    not none, is one window. Null and empty texts have no words, on either side. A null
    item id is matched but not listed, equal ids count once. An empty benchmark hits
    nothing. Column names that start with an underscore belong to this operator.
    """
    root, blocks = item_blocks(items, item_id, item_text, window, block_words)
    schema = T.StructType([*docs.schema.fields, *_FOUND.fields])
    return docs.mapInArrow(_scan(root, blocks, window, docs.columns.index(text_col)), schema)


def _cut(raw: bytes, spans: list) -> bytes:
    at = [m.span() for m in _WORD.finditer(raw)]
    kept, done = [], 0
    for start, end, _ in spans:
        kept.append(raw[done : at[start][0]])
        done = at[end - 1][1]
    return b"".join([*kept, raw[done:]])


def _clean(root: str, blocks: int, window: int, text_at: int, least: int, max_coverage: float) -> Callable:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Take the bytes of hit spans that are long enough or hold a whole short item out of
        the texts, and leave out texts that are mostly hit."""
        for batch in _batches(batches, text_at, blocks):
            texts, keep, changed = text_bytes(batch.column(text_at)), [], {}
            for i, (n, spans, _) in enumerate(_matches(texts, root, blocks, window)):
                keep.append(sum(end - start for start, end, _ in spans) <= max_coverage * n)
                spans = [s for s in spans if s[2] or s[1] - s[0] >= least]
                if keep[-1] and spans:
                    changed[i] = _cut(texts[i], spans).decode()
            if changed:
                cols, new = batch.columns, batch.column(text_at).to_pylist()
                for i, text in changed.items():
                    new[i] = text
                cols[text_at] = pa.array(new, pa.string())
                batch = pa.RecordBatch.from_arrays(cols, names=batch.schema.names)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return clean


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    max_span: int = WINDOW - 1,
    max_coverage: float = 0.5,
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without benchmark passages: hit spans of more than ``max_span`` words, or
    with a whole item shorter than the window, are cut out of the text, and documents of
    which more than ``max_coverage`` of the words are hit are dropped. Columns and clean rows
    are unchanged; nulls, empty texts and repeated rows pass through. Empty tables give what they have."""
    root, blocks = item_blocks(items, item_id, item_text, window, block_words)
    at = docs.columns.index(text_col)
    return docs.mapInArrow(_clean(root, blocks, window, at, max_span + 1, max_coverage), docs.schema)


def contamination_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` of the comma
    joined item ids, and ``contaminated``."""
    found = match_items(docs.select(id_col, options.get("text_col", "text")), items, **options)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        id_col,
        F.col("_n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
