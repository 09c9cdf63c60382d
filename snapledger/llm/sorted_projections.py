"""Near-duplicate vectors by sorted projection passes.

Every pass hashes a unit vector to the signs of ``BITS`` random projections, orders all
vectors by the concatenated signs and compares each with the ``WIDTH`` vectors before it.
What is sorted are copies rounded to one byte a component. The length of what rounding took
off bounds the error of a cosine, so nearly all pairs are decided in the window; pairs in
doubt are verified on the full vectors. Of the certain links in a window only as many are
written as join its rows: one for a row, and those between rows joined by nothing else.

The links of all passes are united to components. Inside a component links are counted
whole, however narrow the windows were. Members within half the limiting angle of the
first member are linked with each other by the triangle inequality and need no comparison;
each of the others is compared with all members, in bounded pieces. So a group of copies
costs one comparison a member, and no group is gathered in a task or written as pairs.
Two vectors that no pass brings together and no chain of links joins are not found: recall
is a matter of ``PASSES`` and ``WIDTH`` and measured in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.llm.common import stored
from snapledger.llm.components import components

COSINE = 0.9
PASSES = 6
WIDTH = 256  # vectors before it that a vector is compared with in a pass
BITS = 48  # signs in the sort key of a pass
SEED = 13

_ROWS = 256  # rows compared at once
_VALUES = 1 << 20  # components held as doubles at once
_PART_ROWS = 100_000  # rows of a pass in a task, about
_FAR = 512  # members that are compared with others at once
_SLICE = 1 << 16  # others they are compared with in a task
_GUARD = 1e-6  # for rounding in bounds, far above that of doubles

_KEYS = "pass int, dim int, key long, v long, code binary"
_FOUND = "kind int, a long, b long, pass int, dim int, key long, code binary"
_LINK, _DOUBT, _EDGE = 0, 1, 2


def _vectors(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors, as doubles, of the usable vectors of a column; those of
    one call have one length. Null, empty and zero vectors and those with null or non-finite
    components are not usable."""
    if not len(col):
        return
    sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.list_flatten(col).cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    for dim in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == dim)
        step = max(1, _VALUES // int(dim))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            x = values[starts[some][:, None] + np.arange(dim)]
            # The largest component first, so that no square overflows or vanishes.
            with np.errstate(invalid="ignore", divide="ignore"):
                x = x / np.abs(x).max(axis=1, keepdims=True)
            ok = np.isfinite(x).all(axis=1)
            x = x[ok]
            yield some[ok], x / np.linalg.norm(x, axis=1, keepdims=True)


def _encode(unit: np.ndarray) -> list[bytes]:
    """Components rounded to one byte, the size of a step, and what rounding took off."""
    step = np.abs(unit).max(axis=1) / 127
    rounded = np.rint(unit / step[:, None]).astype(np.int8)
    lost = np.linalg.norm(unit - rounded * step[:, None], axis=1) + _GUARD
    tail = np.column_stack((step, lost)).astype("<f8")
    return [a.tobytes() + b.tobytes() for a, b in zip(rounded, tail)]


def _decode(codes: list[bytes], dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), dim + 16)
    tail = raw[:, dim:].copy().view("<f8")
    # Sums of products of bytes are exact in single precision up to some 1000 components.
    return raw[:, :dim].view(np.int8).astype(np.float32 if dim <= 1000 else np.float64), tail[:, 0], tail[:, 1]


def _keys(passes: int, seed: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = np.int64(1) << np.arange(BITS, dtype=np.int64)[::-1]
        for batch in batches:
            v = batch.column(0).to_numpy()
            for rows, unit in _vectors(batch.column(1)):
                dim = unit.shape[1]
                if dim not in planes:
                    planes = {dim: np.random.default_rng((seed, dim)).standard_normal((dim, passes * BITS))}
                signs = (unit @ planes[dim] > 0).reshape(len(unit), passes, BITS)
                keys = signs.astype(np.int64) @ powers
                codes = pa.array(_encode(unit), pa.binary())
                for k in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), k, np.int32)),
                            pa.array(np.full(len(rows), dim, np.int32)),
                            pa.array(np.ascontiguousarray(keys[:, k])),
                            pa.array(v[rows]),
                            codes,
                        ],
                        names=["pass", "dim", "key", "v", "code"],
                    )

    return emit


class _Window:
    """The last ``width`` rows of a sorted run and the first row each is joined with."""

    def __init__(self, dim: int, width: int, cosine: float):
        self.dim, self.width, self.cosine = dim, width, cosine
        self.v = self.joined = np.empty(0, np.int64)
        self.codes: list[bytes] = []

    def add(self, v: np.ndarray, codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Compare rows with those before them. Links (a, b) whose ends are certainly of one
        component, and pairs of different ones that are in doubt."""
        old, self.codes = len(self.v), self.codes + codes
        v = np.concatenate((self.v, v))
        q, step, lost = _decode(self.codes, self.dim)
        about = (q[old:] @ q.T) * step[old:, None] * step
        error = lost[old:, None] * (1 + lost) + lost + _GUARD
        apart = np.arange(old, len(v))[:, None] - np.arange(len(v))
        about[(apart < 1) | (apart > self.width)] = -2
        sure = about >= self.cosine + error
        # Each row points at the nearest one before it that it links with, then at the first.
        point = np.arange(len(v))
        has = sure.any(axis=1)
        nearest = len(v) - 1 - sure[:, ::-1].argmax(axis=1)
        point[old:][has] = nearest[has]
        while not np.array_equal(further := point[point], point):
            point = further
        joined = np.concatenate((self.joined, v[old:]))[point]
        other = joined[old:, None] != joined
        rows, cols = np.nonzero(sure & other)
        links = np.column_stack((np.concatenate((v[old:][has], joined[old:][rows])), np.concatenate((joined[old:][has], joined[cols]))))
        rows, cols = np.nonzero((about >= self.cosine - error) & ~sure & other)
        doubts = np.column_stack((v[old:][rows], v[cols]))
        self.v, self.joined, self.codes = v[-self.width :], joined[-self.width :], self.codes[-self.width :]
        return np.unique(links, axis=0), doubts


def _found(kind: int, pairs: np.ndarray) -> pa.RecordBatch:
    n = len(pairs)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, kind, np.int32)),
            pa.array(np.ascontiguousarray(pairs[:, 0])),
            pa.array(np.ascontiguousarray(pairs[:, 1])),
            pa.nulls(n, pa.int32()),
            pa.nulls(n, pa.int32()),
            pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.binary()),
        ],
        names=["kind", "a", "b", "pass", "dim", "key", "code"],
    )


def _edge(batch: pa.RecordBatch, boundary: int) -> pa.RecordBatch:
    n = batch.num_rows
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, _EDGE, np.int32)),
            batch.column("v"),
            pa.array(np.full(n, boundary, np.int64)),
            *[batch.column(c) for c in ("pass", "dim", "key", "code")],
        ],
        names=["kind", "a", "b", "pass", "dim", "key", "code"],
    )


def _compare(width: int, cosine: float, run: str | None = None):
    """Rows come sorted. Links and pairs in doubt; without a ``run`` column also the first and
    last ``width`` rows of the partition, for the windows that reach into the next one."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, of = None, None
        first, last = 0, []
        part = TaskContext.get().partitionId()
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                if run is None:
                    if first < width:
                        yield _edge(batch.slice(0, width - first), part - 1)
                        first += min(batch.num_rows, width - first)
                    last.append(batch)
                    while sum(b.num_rows for b in last[1:]) >= width:
                        last.pop(0)
                marks = [batch.column(c).to_numpy() for c in ("pass", "dim", *([run] if run else []))]
                cuts = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
                v, codes = batch.column("v").to_numpy(), batch.column("code").to_pylist()
                for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                    mark = tuple(m[start] for m in marks)
                    if mark != of:
                        window, of = _Window(int(mark[1]), width, cosine), mark
                    links, doubts = window.add(v[start:end], codes[start:end])
                    if len(links):
                        yield _found(_LINK, links)
                    if len(doubts):
                        yield _found(_DOUBT, doubts)
        spare = sum(b.num_rows for b in last) - width
        for batch in last:
            yield _edge(batch.slice(max(0, spare)), part)
            spare = 0

    return compare


def _cosines(threshold: float):
    """Columns a, b, x, y: the pairs whose vectors x and y reach the threshold."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for (rows, x), (_, y) in zip(_vectors(batch.column(2)), _vectors(batch.column(3))):
                keep[rows] = np.einsum("ij,ij->i", x, y) >= threshold
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep))

    return verify


def candidate_links(rows: DataFrame, passes: int, width: int, cosine: float, seed: int) -> DataFrame:
    """Pairs (a, b) of row numbers that are of one component, from all passes over the stored
    ``rows`` (v, vec). Their components are those of all links the windows see."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["pass", "dim", "key", "v"]
    # Few parts for few rows: the windows are to be narrower than a part.
    parts = max(1, min(parts, -(-rows.count() * passes // _PART_ROWS)))
    keyed = rows.select("v", "vec").mapInArrow(_keys(passes, seed), _KEYS)
    sorted_ = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = stored(sorted_.mapInArrow(_compare(width, cosine), _FOUND), "windows")
    edges = found.where(F.col("kind") == _EDGE).select("pass", "dim", "key", F.col("a").alias("v"), "code", F.col("b").alias("run"))
    edges = edges.where(F.col("run").between(0, parts - 2))
    across = edges.repartition("run").sortWithinPartitions("run", *order).mapInArrow(_compare(width, cosine, "run"), _FOUND)
    found = found.select("kind", "a", "b").union(stored(across.select("kind", "a", "b"), "boundaries"))
    end = lambda n, x: rows.select(F.col("v").alias(n), F.col("vec").alias(x))
    doubts = found.where(F.col("kind") == _DOUBT).select("a", "b").distinct()
    proven = doubts.join(end("a", "x"), "a").join(end("b", "y"), "b").select("a", "b", "x", "y")
    return found.where(F.col("kind") == _LINK).select("a", "b").union(proven.mapInArrow(_cosines(cosine), "a long, b long"))


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns v, comp, vec, first: the angle between the two vectors."""
    for batch in batches:
        angle = np.zeros(batch.num_rows)
        for (rows, x), (_, y) in zip(_vectors(batch.column(2)), _vectors(batch.column(3))):
            angle[rows] = np.arccos(np.clip(np.einsum("ij,ij->i", x, y), -1, 1))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(angle)], names=["v", "comp", "angle"])


def _count(cosine: float):
    """Rows come sorted by piece, its far members first. Links between a far member and any
    other member, counted for the far one, and for the other one if it is near."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, far, far_v, total = None, [], np.empty(0, np.int64), np.empty(0, np.int64)

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(far_v), pa.array(total)], names=["v", "n"])

        for batch in batches:
            marks = [batch.column(c).to_numpy() for c in ("comp", "chunk", "slice")]
            v = batch.column("v").to_numpy()
            is_far, is_own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("far", "own"))
            unit = np.empty(batch.num_rows, object)
            for rows, x in _vectors(batch.column("vec")):
                for i, u in zip(rows, x):
                    unit[i] = u
            cuts = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if start == end:
                    continue
                mark = tuple(m[start] for m in marks)
                if mark != of:
                    if len(far_v):
                        yield piece()
                    of, far, far_v, total = mark, [], np.empty(0, np.int64), np.empty(0, np.int64)
                own = np.arange(start, end)[is_own[start:end]]
                far.extend(unit[own])
                far_v = np.concatenate((far_v, v[own]))
                total = np.concatenate((total, np.zeros(len(own), np.int64)))
                others = np.arange(start, end)[~is_own[start:end]]
                for at in range(0, len(others), _SLICE // 64):
                    some = others[at : at + _SLICE // 64]
                    linked = (np.stack(unit[some]) @ np.stack(far).T >= cosine) & (v[some][:, None] != far_v)
                    total += linked.sum(axis=0)
                    near = ~is_far[some]
                    got = linked[near].sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v[some][near][got > 0]), pa.array(got[got > 0].astype(np.int64))], names=["v", "n"]
                    )
        if len(far_v):
            yield piece()

    return count


def _far_links(members: DataFrame, comps: DataFrame, rows: DataFrame, cosine: float) -> DataFrame:
    """(v, n): links of which one end at least is far from the first member. ``members`` has
    v, comp, far; ``comps`` comp, n, n_far. Far members are dealt into chunks, all members into
    slices, and every chunk meets every slice of its component."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = comps.where("n_far > 0").select(
        "comp",
        F.ceil(F.col("n_far") / F.lit(_FAR)).cast("int").alias("chunks"),
        F.ceil(F.col("n") / F.lit(_SLICE)).cast("int").alias("slices"),
    )
    mine = members.join(sized, "comp").withColumns(
        {"c": F.pmod(F.xxhash64("v", F.lit(1)), "chunks").cast("int"), "s": F.pmod(F.xxhash64("v"), "slices").cast("int")}
    )
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    far = mine.where("far").select("v", "comp", F.col("c").alias("chunk"), each("slices").alias("slice"), "far", F.lit(True).alias("own"))
    others = mine.select("v", "comp", each("chunks").alias("chunk"), F.col("s").alias("slice"), "far", F.lit(False).alias("own"))
    dealt = far.union(others).join(rows.select("v", "vec"), "v")
    pieces = dealt.repartition(parts, "comp", "chunk", "slice").sortWithinPartitions("comp", "chunk", "slice", F.desc("own"), "v")
    found = pieces.select("v", "comp", "chunk", "slice", "far", "own", "vec").mapInArrow(_count(cosine), "v long, n long")
    return found.groupBy("v").agg(F.sum("n").alias("n"))


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    passes: int = PASSES,
    width: int = WIDTH,
    cosine: float = COSINE,
    seed: int = SEED,
) -> DataFrame:
    """One row per vector: the id column, ``n_links`` (other rows with a cosine of at least
    ``cosine`` in its component), ``component_id`` (smallest id that is reachable by links) and
    ``kept`` (that id is its own).

    Vectors that are null, empty or zero or have null or non-finite components link with
    nothing, nor do vectors of different length. Repeated rows are vectors of their own and
    link with each other. A null id names no component unless all its ids are null. An empty
    table gives no rows; other columns are not read, whatever their names.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    kind = vectors.schema[vec_col].dataType.elementType
    vec = F.col(vec_col) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(vec_col).cast("array<double>")
    rows = stored(
        vectors.select(F.monotonically_increasing_id().alias("v"), F.col(id_col).alias("id"), vec.alias("vec")), "vectors"
    )
    comps = components(candidate_links(rows, passes, width, cosine, seed))
    named = comps.join(rows, "v").select("v", "comp", "vec")
    first = rows.select(F.col("v").alias("comp"), F.col("vec").alias("first"))
    measured = named.join(first, "comp").select("v", "comp", "vec", "first")
    angles = measured.mapInArrow(_angles, "v long, comp long, angle double")
    far = F.col("angle") > float(np.arccos(cosine)) / 2 - _GUARD
    members = stored(angles.select("v", "comp", far.alias("far")), "members")
    by_comp = members.join(rows.select("v", "id"), "v").groupBy("comp").agg(
        F.min("id").alias("least"), F.count("*").alias("n"), F.count_if("far").alias("n_far")
    )
    by_comp = stored(by_comp, "balls")
    near = members.join(by_comp, "comp").select(
        "v", "least", F.when(F.col("far"), 0).otherwise(F.col("n") - F.col("n_far") - 1).alias("near")
    )
    if not by_comp.where("n_far > 0").isEmpty():
        more = stored(_far_links(members, by_comp, rows, cosine), "far-links")
        near = near.join(more, "v", "left").select("v", "least", (F.col("near") + F.coalesce("n", F.lit(0))).alias("near"))
    out = rows.select("v", "id").join(near, "v", "left")
    own = F.when(F.col("near").isNotNull(), F.col("least")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce(F.col("near"), F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.col("id").eqNullSafe(own).alias("kept"),
    )
