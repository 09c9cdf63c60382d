"""Near duplicates: all pairs of texts whose word shingles have a Jaccard similarity of at
least 4/5, joined on parity sketches.

A sketch toggles one bit for every shingle, so two sketches differ in at most as many bits
as the shingle sets differ in elements. Sets of a and b shingles link if they differ in at
most (a + b) / 9. For every band of sizes a sketch is cut into more blocks than linking sets
can differ in, by a given spare number: as many blocks as that are equal in both, and the
pairs meet on a block (the pigeonhole join). A block's bits are kept as the exclusive or of
the codes of its set bits. Blocks without a bit say nothing and are not joined on; a text
with as many of those as there are spare blocks is cut again by another hash, and partners
that agree only on empty blocks are, too.

What meets on a block is not paired off. Each member is compared with the smallest one.
Members that ended up in different components are then compared by a shorter parity sketch,
in tiles of bounded size: first every member only offers its nearest one of another
component, until no offer links any more, then the few pairs left are taken one and all.
Members of one component need no comparison. All links are verified on the full sets.

No step gathers a block's members, a component or a group of copies in one task, and
nothing of them reaches the driver. Equal sets are one vertex from the start.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import numbered, release, slices, stored, text_bytes
from snapledger.llm.components import components
from snapledger.llm.repeated_spans import PIECE, Ranges

WORDS = 5
# Linking sets differ in at most 1/DIFFER of their summed sizes: 80 % similarity.
DIFFER = 9
# Sizes differ by at most a quarter then, and bands are wider, so partners are in one band
# or in neighbouring ones.
REACH = 1.25
BAND = 1.3
LEAST = 4  # smaller sets only link if they are equal
CUTS = 6  # hashes tried for texts with many empty blocks
TILE = 1000
CHUNK = 256  # comparisons with one text in a task
RUN_BITS = 4

_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.cumprod(np.full(WORDS, _M3, np.uint64))
_SEEDS = np.arange(CUTS, dtype=np.uint64) * _M3
_S33, _S32 = np.uint64(33), np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes."""
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _word_codes(text: bytes) -> np.ndarray:
    """Hash of every word, by one pass of vector operations over the bytes; a long text is
    taken in pieces that end with a word."""
    if len(text) <= PIECE:
        return _piece_codes(text)
    out, start = [], 0
    while start < len(text):
        cut = _GAP.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        out.append(_piece_codes(text[start:end]))
        start = end
    return np.concatenate(out)


def _piece_codes(text: bytes) -> np.ndarray:
    raw = text.lower()
    gaps = np.concatenate(([True], _SPACE[np.frombuffer(raw, np.uint8)], [True]))
    edges = np.flatnonzero(gaps[1:] != gaps[:-1])
    return Ranges(raw).hash(edges[::2], edges[1::2])


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of all runs of WORDS words; of all words if there are fewer."""
    codes = _word_codes(text)
    size = min(WORDS, len(codes))
    if not size:
        return codes
    n = len(codes) - size + 1
    # Word hashes are random already: a sum with one odd factor for each place, mixed once.
    mixed = codes[:n] * _PLACES[0]
    for k in range(1, size):
        mixed += codes[k : k + n] * _PLACES[k]
    mixed = np.sort(_mix(mixed + np.uint64(size)))
    fresh = np.empty(n, bool)
    fresh[0] = True
    np.not_equal(mixed[1:], mixed[:-1], out=fresh[1:])
    return mixed[fresh]


def vertex(found: np.ndarray) -> int:
    """Identity of a shingle set, as a signed 64-bit hash."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


@lru_cache(maxsize=None)
def bands(n: int) -> tuple[tuple[int, int, int], ...]:
    """(band, blocks, spare blocks) a set of n shingles is joined in: its own band, and the
    one below if partners can be there."""
    if n < LEAST:
        return ()
    starts = [LEAST]
    while starts[-1] <= n:
        starts.append(int(np.ceil(starts[-1] * BAND)))
    out = []
    for k in range(max(0, len(starts) - 3), len(starts) - 1):
        largest = starts[k + 1] - 1
        if n <= int(largest * REACH):
            differ = (largest + int(largest * REACH)) // DIFFER
            spare = 2 + -(-differ // 8)
            out.append((k, differ + spare, spare))
    return tuple(out)


def block_keys(found: np.ndarray) -> np.ndarray:
    """Join keys of a shingle set: one for each block with a bit, in each of its bands."""
    out = []
    for band, blocks, spare in bands(len(found)):
        for cut in range(CUTS):
            codes = found if cut == 0 else np.sort(_mix(found ^ _SEEDS[cut]))
            place = ((codes >> _S32) * np.uint64(blocks)) >> _S32
            starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            parity = np.bitwise_xor.reduceat(codes, starts)
            at = place[starts] + np.uint64((band * CUTS + cut) << 32)
            out.append(_mix(parity ^ _mix(at + _M1)))
            empty = blocks - len(starts)
            if empty < spare:
                break
        else:
            # Partners share `spare` empty blocks of the last cut at least; the first ones
            # of each, in order, must have one in common.
            none = np.setdiff1d(np.arange(blocks, dtype=np.uint64), place[starts])[: empty - spare + 1]
            out.append(_mix(none + np.uint64((band * CUTS + CUTS - 1) << 32) + _M2))
    return np.concatenate(out) if out else found[:0]


def sketch(found: np.ndarray) -> bytes:
    """Parity sketch of four to eight bits a shingle, at least 64, a power of two."""
    bits = max(64, 1 << (4 * len(found) - 1).bit_length())
    counts = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts.astype(np.uint8) & 1, bitorder="little").tobytes()


def _folded(raw: bytes, size: int) -> np.ndarray:
    """A sketch as 64-bit words, folded to ``size`` bytes. Folding cannot add differences."""
    words = np.frombuffer(raw, np.uint64)
    while len(words) * 8 > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            rows = []
            for text in text_bytes(part.column(1)):
                found = shingles(text)
                rows.append((len(found), vertex(found), sketch(found) if len(found) else b""))
            n, v, s = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), part.column(3), pa.array(n, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.binary())],
                names=["_id", "_text_hash", "_run", "_n", "_v", "_sketch"],
            )
        release()


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 0, 1 << 20):
            keys, owners = [], []
            for text in text_bytes(part.column(0)):
                found = shingles(text)
                own = block_keys(found)
                keys.append(own)
                owners.append(np.full(len(own), vertex(found), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))], names=["key", "v"]
            )
        release()


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key. Those whose key has more than one row; most have not. The
    last row of a batch is held until the next one is known."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        before = False
        if held is not None:
            key, v, before = np.concatenate((held[0], key)), np.concatenate((held[1], v)), held[2]
        same = key[1:] == key[:-1]
        as_before, as_after = np.concatenate(([before], same)), np.concatenate((same, [False]))
        held = key[-1:], v[-1:], bool(as_before[-1])
        keep = (as_before | as_after)[:-1]
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[:-1][keep]), pa.array(v[:-1][keep])], names=["key", "v"])
    if held is not None and held[2]:
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["key", "v"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key and vertex. Every member but the first of its key, once, with
    the first. Nothing is held but the last row and the first vertex of its key."""
    last_key = last_v = first = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.empty(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        new[0] = last_key is None or key[0] != last_key
        fresh = np.empty(len(key), bool)
        fresh[1:] = v[1:] != v[:-1]
        fresh[0] = last_v is None or v[0] != last_v
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        firsts = np.concatenate((v[starts], [0])) if first is None else np.concatenate((v[starts], [first]))
        head = firsts[run]  # run is -1 for rows that go on from the batch before
        keep = ~new & fresh & (v != head)
        last_key, last_v, first = key[-1], v[-1], head[-1]
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[keep]), pa.array(head[keep]), pa.array(v[keep])], names=["key", "a", "b"]
            )


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that sketches allow to link. Columns a, b, na, nb, sa, sb."""
    for batch in batches:
        keep = []
        for x, y, s, t in zip(*(c.to_pylist() for c in batch.columns[2:])):
            size = min(len(s), len(t))
            apart = np.bitwise_count(_folded(s, size) ^ _folded(t, size)).sum(dtype=np.int64)
            keep.append(bool(apart <= (x + y) // DIFFER))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: the text of a hub, then the texts to compare with it. Another text
    with the id and the hash of the right one is told by its vertex."""
    hub, hub_set = None, None
    for batch in batches:
        hubs, others = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        chunks = batch.column(2).to_pylist()
        out_a, out_b = [], []
        for a, b, chunk, text in zip(hubs, others, chunks, text_bytes(batch.column(3))):
            found = shingles(text)
            if vertex(found) != b:
                continue
            if a == b:
                hub, hub_set = (a, chunk), found
            elif hub == (a, chunk):
                union = len(found) + len(hub_set)
                common = np.intersect1d(found, hub_set, assume_unique=True).size
                if 100 * common >= 80 * (union - common):
                    out_a.append(a)
                    out_b.append(b)
            else:
                raise ValueError("text of a compared vertex is missing")
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def _tile_pairs(rows: list[dict], nearest: bool) -> set[tuple[int, int]]:
    """Pairs of different components that sizes and sketches allow to link; with ``nearest``
    only the one with the most differences to spare for each member."""
    size = min(len(r["_sketch"]) for r in rows)
    bits = np.stack([_folded(r["_sketch"], size) for r in rows])
    n, comp, v, tile = (np.array([r[c] for r in rows], np.int64) for c in ("_n", "comp", "v", "own"))
    two_tiles = rows[0]["low"] != rows[0]["high"]
    spare, partner = np.full(len(rows), -1), np.zeros(len(rows), int)
    out = set()
    for i in range(len(rows) - 1):
        most = (n[i + 1 :] + n[i]) // DIFFER
        left = most - np.bitwise_count(bits[i + 1 :] ^ bits[i]).sum(axis=1, dtype=np.int64)
        ok = (left >= 0) & (np.abs(n[i + 1 :] - n[i]) <= most) & (comp[i + 1 :] != comp[i])
        if two_tiles:  # pairs inside a tile are compared once, by themselves
            ok &= tile[i + 1 :] != tile[i]
        if not nearest:
            out.update((min(v[i], x), max(v[i], x)) for x in v[i + 1 :][ok])
            continue
        left[~ok] = -1
        better = left > spare[i + 1 :]
        spare[i + 1 :][better], partner[i + 1 :][better] = left[better], i
        j = int(left.argmax())
        if left[j] > spare[i]:
            spare[i], partner[i] = left[j], i + 1 + j
    for i in np.flatnonzero(spare >= 0):
        x, y = v[i], v[partner[i]]
        out.add((min(x, y), max(x, y)))
    return out


def _tiles(nearest: bool):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile pair, of which one is held at a time."""
        rows: list[dict] = []

        def flush() -> pa.RecordBatch:
            got = sorted(_tile_pairs(rows, nearest)) if len(rows) > 1 else []
            cols = [[rows[0]["key"]] * len(got), [g[0] for g in got], [g[1] for g in got]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["key", "a", "b"])

        for batch in batches:
            for row in batch.to_pylist():
                if rows and (row["key"], row["low"], row["high"]) != (rows[0]["key"], rows[0]["low"], rows[0]["high"]):
                    yield flush()
                    rows.clear()
                rows.append(row)
        if rows:
            yield flush()

    return compare


class _Texts:
    """The documents, and per vertex its size, sketch and smallest id."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        self.spark = docs.sparkSession
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.docs = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
        sets = self.docs.select(
            "_id", "_text", F.xxhash64("_text").alias("_text_hash"), F.spark_partition_id().alias("_run")
        ).mapInArrow(_sets, "_id long, _text_hash long, _run int, _n long, _v long, _sketch binary")
        self.rows = stored(sets, "shingle-sets")
        self.vertices = stored(
            self.rows.where("_n > 0").groupBy("_v").agg(
                F.min("_id").alias("_id"),
                F.first("_n").alias("_n"),
                F.first("_sketch").alias("_sketch"),
                F.min(F.struct("_id", "_text_hash")).alias("_of"),
            ),
            "vertices",
        )

    def meeting(self, members: DataFrame) -> DataFrame:
        """A text of every vertex that meets another one, once, spread by vertex. Rows that
        share an id or have none are told apart by the hash of their text."""
        v = members.select(F.col("a").alias("_v")).union(members.select("b")).distinct()
        chosen = self.vertices.join(v, "_v").select("_v", "_of.*")
        # Equal keys on both sides, so that grouping by them needs no shuffle of its own.
        keys = [F.col("_id").isNull().alias("_none"), F.coalesce("_id", F.lit(0)).alias("_known"), "_text_hash"]
        hashed = self.docs.withColumn("_text_hash", F.xxhash64("_text")).select(*keys, "_text")
        # Sorted by them at every size, so that rows of one text follow each other.
        found = hashed.join(chosen.select(*keys, "_v").hint("merge"), ["_none", "_known", "_text_hash"])
        once = found.groupBy("_none", "_known", "_text_hash", "_v").agg(F.first("_text").alias("_text"))
        return stored(once.select("_v", "_text"), "meeting-texts")

    def candidates(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) whose sizes and sketches allow a link."""
        end = lambda x: self.vertices.select(
            F.col("_v").alias(x), F.col("_n").alias(f"n{x}"), F.col("_sketch").alias(f"s{x}")
        )
        known = pairs.distinct().join(end("a"), "a").join(end("b"), "b")
        near = F.abs(F.col("na") - F.col("nb")) * DIFFER <= F.col("na") + F.col("nb")
        return known.where(near).select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_near, "a long, b long")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that link. Comparisons with one text are dealt out in chunks."""
        pairs = stored(pairs.distinct(), "candidates")
        chunks = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("_chunks"))
        dealt = pairs.join(chunks, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("_chunks")))
        wanted = dealt.select("a", "b", "chunk").union(dealt.select("a", F.col("a").alias("b"), "chunk").distinct())
        # Texts are small where they are stored and large in memory: they are not to be broadcast.
        texts = wanted.join(self.texts.withColumnRenamed("_v", "b").hint("merge"), "b").select("a", "b", "chunk", "_text")
        # The hub's own row first: it is the one whose vertices are equal.
        dealt_out = texts.repartition(self.parts, "a", "chunk").sortWithinPartitions(
            "a", "chunk", (F.col("a") != F.col("b")), "b"
        )
        return stored(dealt_out.mapInArrow(_verify, "a long, b long").distinct(), "links")

    def links(self) -> DataFrame:
        """Enough links that their components are those of all links."""
        keys = self.docs.select("_text").mapInArrow(_keys, "key long, v long")
        # All rows are sorted by one number only; by vertex, too, only those that meet another.
        met = keys.repartition(self.parts, "key").sortWithinPartitions("key").mapInArrow(_several, "key long, v long")
        # Stored in between, so that a task has one Python worker and not two.
        met = stored(met, "met").repartition(self.parts, "key")
        members = stored(
            met.sortWithinPartitions("key", "v").mapInArrow(_meet, "key long, a long, b long"), "block-members"
        )
        self.texts = self.meeting(members)
        links = self.verified(self.candidates(members.select("a", "b")))
        while True:
            comps = components(links)
            known = comps.select(F.col("v").alias("a"), F.col("comp").alias("b"))
            pairs = self._across(members, comps, True)
            more = self.verified(pairs.select("a", "b"))
            # Components only grow, so a block without such a pair will not have one later.
            members = members.join(pairs.select("key").distinct(), "key", "left_semi")
            if more.isEmpty():
                rest = self._across(members, comps, False)
                return known.union(self.verified(rest.select("a", "b")))
            links = known.union(more)

    def _across(self, members: DataFrame, comps: DataFrame, nearest: bool) -> DataFrame:
        """Pairs of different components that meet on a block and may link, with the block."""
        of = comps.select(F.col("v").alias("b"), F.col("comp").alias("_comp"))
        labelled = members.join(of, "b", "left").select("key", "a", "b", F.coalesce("_comp", "b").alias("comp"))
        several = labelled.groupBy("key").agg(F.count("*").alias("c"), F.min("comp").alias("x"), F.max("comp").alias("y"))
        # The first member has been compared with all others, so only those count here.
        several = several.where("c > 1 and x <> y").select("key", F.ceil(F.col("c") / F.lit(TILE)).cast("int").alias("tiles"))
        own = F.pmod(F.xxhash64("b"), F.col("tiles")).cast("int")
        rows = labelled.join(several, "key").select("key", F.col("b").alias("v"), "comp", "tiles", own.alias("own"))
        other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
        rows = rows.select("*", other.alias("other")).select(
            "key", "v", "comp", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
        )
        rows = rows.join(self.vertices.select(F.col("_v").alias("v"), "_n", "_sketch"), "v")
        sorted_ = rows.repartition(self.parts, "key", "low", "high").sortWithinPartitions("key", "low", "high", "v")
        return stored(sorted_.mapInArrow(_tiles(nearest), "key long, a long, b long"), "tile-pairs")

    def classes(self) -> DataFrame:
        """Vertex, component and the component's smallest id."""
        comps = components(self.links())
        named = self.vertices.join(comps.withColumnRenamed("v", "_v"), "_v", "left").select(
            "_v", F.coalesce("comp", "_v").alias("comp"), "_id"
        )
        least = named.groupBy("comp").agg(F.min("_id").alias("_least"))
        return stored(named.join(least, "comp").select("_v", "comp", "_least"), "classes")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id column, ``n_shingles`` and ``component_id``, the smallest id
    that is reachable by links.

    Null texts and texts without words have no shingles and are a component each, named by
    their own id. A null id does not name a component unless all its ids are null. Repeated
    rows are in one component. An empty table gives no rows, other columns are not read. Ids
    are whole numbers, or texts of such; others raise. Sets are told apart by a 64-bit hash,
    as are shingles.
    """
    texts = _Texts(docs, id_col, text_col)
    classes = texts.classes().select("_v", "_least")
    # Copies of one text may be a third of all rows: they meet their class once per run of
    # neighbouring input partitions and then only within the run.
    rows = texts.rows.select("_id", "_n", "_v", F.shiftright("_run", RUN_BITS).alias("_run"))
    by_run = rows.where("_n > 0").select("_run", "_v").distinct().join(classes, "_v")
    return rows.join(by_run, ["_run", "_v"], "left").select(
        F.col("_id").alias(id_col),
        F.col("_n").alias("n_shingles"),
        F.when(F.col("_n") > 0, F.col("_least")).otherwise(F.col("_id")).alias("component_id"),
    )


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with their own columns: all without words, and of each
    component exactly one, with the smallest id. Null ids come last, and of rows that share
    the smallest id any one stays."""
    rows = numbered(docs, id_col)
    groups = near_groups(rows.select("_row", F.col("_doc")[text_col].alias("_text")), "_row", "_text")
    of = stored(groups.where("n_shingles > 0").select("_row", F.col("component_id").alias("_component")), "components-of")
    sizes = of.groupBy("_component").agg(F.count("*").alias("_size")).where("_size > 1").select("_component")
    keyed = of.join(stored(sizes, "shared-components"), "_component").join(rows.select("_row", "_key"), "_row")
    best = stored(keyed.groupBy("_component").agg(F.min("_key").alias("_best")), "kept-rows")
    dropped = keyed.join(best, "_component").where(F.col("_key") != F.col("_best")).select("_row")
    return rows.join(dropped, "_row", "left_anti").select("_doc.*")
