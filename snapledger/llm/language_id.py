"""Language of a text from averaged hashed subword embeddings and a linear softmax.

Subwords are all runs of 2, 3 and 4 bytes of the lower-cased letters of a text, words
separated by one space; each is hashed to one of ``BUCKETS`` embeddings. Embeddings and
the softmax layer are trained by stochastic gradient descent in numpy, on a bounded
sample of labelled rows. After training the two layers are one table (bucket x language),
so a task needs a few MB and predicting a text is one pass of vector operations.

Scores are calibrated: a temperature is fitted on sample rows kept out of the training,
and texts whose score is below a threshold learned from the same rows are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import release, slices

# Bounds of the sample the model is fitted on: rows, and characters of a piece of each.
SAMPLE_ROWS = 2000
LANGUAGES = 500  # languages that are learned at most, those with the most rows
LANGUAGE_ROWS = 20  # of each language at least, if there are so many of them that its part is less
SAMPLE_CHARS = 2000

BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
DIM = 16
SEGMENT = 300  # bytes of a training example
EPOCHS = 2
RATE = 0.5
BOOST = 50.0  # embeddings move faster than the plain mean has them, as each is seen rarely
SEED = 7
# Share of right predictions, among the rows kept out, that the threshold may reject; and
# the score from which nothing is rejected.
REJECT_SHARE = 0.001
REJECT_BELOW = 0.4

UNKNOWN = "und"
_PIECE = 1 << 18  # bytes scored at once; a longer text is scored piece by piece
_FOUND = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
_LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)  # odd multipliers, one for each length


def normal(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "


def buckets(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per length the bucket at every byte, the first byte of every text, and the number of
    bytes. Texts are set apart by zeros, so that no subword that starts in a text has bytes
    of the next one; those that start in a gap must not be used."""
    gap = b"\0" * (max(GRAMS) - 1)
    raw = np.frombuffer(gap.join([*texts, b""]), np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    code, out = raw.copy(), []
    for size in range(2, max(GRAMS) + 1):
        code[: len(raw) - size + 1] |= raw[size - 1 :] << np.uint32(8 * (size - 1))
        if size in GRAMS:
            mixed = code * np.uint32(_MIX[GRAMS.index(size)])
            out.append((mixed >> np.uint32(16)).astype(np.int32))
    return out, np.concatenate(([0], np.cumsum(sizes + len(gap))[:-1])), sizes


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # per language, the value of every bucket
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, texts: list[bytes]) -> np.ndarray:
        sums = np.zeros((len(texts), len(self.labels)))
        held: list[tuple[int, bytes, int]] = []
        size = 0
        for piece in _pieces(texts):
            if held and size + len(piece[1]) > _PIECE:
                self._add(sums, held)
                held, size = [], 0
            held.append(piece)
            size += len(piece[1])
        if held:
            self._add(sums, held)
        return sums / (len(GRAMS) * np.fromiter(map(len, texts), np.int64, len(texts)))[:, None] + self.bias

    def _add(self, sums: np.ndarray, pieces: list[tuple[int, bytes, int]]) -> None:
        owners, parts, used = zip(*pieces)
        found, starts, _ = buckets(list(parts))
        ends = np.column_stack((starts, starts + used)).ravel()  # of what counts and what does not, in turn
        for k, values in enumerate(self.table):
            total = values[found[0]]
            for more in found[1:]:
                total += values[more]
            np.add.at(sums[:, k], list(owners), np.add.reduceat(total, ends, dtype=np.float64)[::2])

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Language number and calibrated score of every text."""
        p = _softmax(self.logits(texts) / self.temperature)
        return p.argmax(axis=1), np.round(p.max(axis=1), 6)


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes, int]]:
    """Number of the text, bytes, and how many of them start a subword here. The pieces of a
    long text overlap, so that each of its subwords is whole in one of them."""
    for i, text in enumerate(texts):
        for at in range(0, len(text), _PIECE):
            yield i, text[at : at + _PIECE + max(GRAMS) - 1], min(_PIECE, len(text) - at)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(texts: list[str], langs: list[str], seed: int = SEED) -> Model | None:
    """Train on four fifths of the rows, and one of every label at least, calibrate on the
    others. None without a label."""
    rows = [(normal(t), lang) for t, lang in zip(texts, langs) if has_letter(t)]
    labels = sorted({lang for _, lang in rows})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    kept_out, used = rows[: len(rows) // 5], rows[len(rows) // 5 :]
    missing = set(labels).difference(lang for _, lang in used)
    used += [r for r in kept_out if r[1] in missing]
    kept_out = [r for r in kept_out if r[1] not in missing]
    examples = [
        (text[i : i + SEGMENT], labels.index(lang))
        for text, lang in used
        for i in range(0, len(text), SEGMENT)
    ]
    embed = rng.uniform(-0.5, 0.5, (BUCKETS, DIM)).astype(np.float32) / DIM
    layer = np.zeros((DIM, len(labels)), np.float32)
    bias = np.zeros(len(labels), np.float32)
    step, steps = 0, EPOCHS * len(examples)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            text, label = examples[i]
            found, _, sizes = buckets([text])
            ids, counts = np.unique(np.concatenate([x[: sizes[0]] for x in found]), return_counts=True)
            share = (counts / (len(GRAMS) * sizes[0])).astype(np.float32)
            mean = share @ embed[ids]
            slope = _softmax(mean @ layer + bias).astype(np.float32)
            slope[label] -= 1
            rate = np.float32(RATE * (1 - step / steps))
            back = layer @ slope
            layer -= rate * np.outer(mean, slope)
            bias -= rate * slope
            embed[ids] -= rate * np.outer(np.minimum(share * BOOST, 1), back)
            step += 1
    model = Model(labels, np.ascontiguousarray((embed @ layer).T), bias.astype(np.float64))
    if kept_out:
        _calibrate(model, [t for t, _ in kept_out], np.array([labels.index(x) for _, x in kept_out]))
    return model


def _calibrate(model: Model, texts: list[bytes], truth: np.ndarray) -> None:
    """The temperature with the least cross entropy, and the rejection threshold."""
    logits = model.logits(texts)
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 120))
    loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(logits / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    if len(right):
        model.threshold = float(min(REJECT_BELOW, np.quantile(right, REJECT_SHARE)))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Of every language (the LANGUAGES most frequent, should there be more labels) an equal
    part of SAMPLE_ROWS rows, LANGUAGE_ROWS at least, in the order of a hash, a piece of SAMPLE_CHARS characters from anywhere in the text of each.
    Texts without a letter are left out, and of equal texts all but one. The rows of each
    language are counted first, and those whose hash is too high to be among its lowest are
    left out where they are read, so that what is sorted does not grow with the table."""
    order = F.xxhash64(F.col(id_col).cast("string"), F.lit(SEED))
    room = F.greatest(F.length(text_col) - SAMPLE_CHARS, F.lit(0)) + 1
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = known.groupBy(F.col(lang_col).alias("_lang")).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    counts = counts.orderBy(F.desc("_n"), "_lang").limit(LANGUAGES).collect()
    known = known.where(F.col(lang_col).isin([r["_lang"] for r in counts]))
    rows = max(LANGUAGE_ROWS, SAMPLE_ROWS // max(1, len(counts)))
    shares = {r["_lang"]: 4 * rows / r["_n"] for r in counts}
    limits = {r["_lang"]: max(r["_first"], int(-(2**63) + shares[r["_lang"]] * 2**64)) for r in counts if shares[r["_lang"]] < 1}
    if limits:
        highest = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        known = known.where(order <= F.coalesce(F.try_element_at(highest, F.col(lang_col)), F.lit(2**63 - 1)))
    chosen = known.select(
        F.col(lang_col).alias("_lang"),
        F.substr(F.col(text_col), 1 + F.pmod(order, room).cast("int"), F.lit(SAMPLE_CHARS)).alias("_text"),
        order.alias("_order"),
        F.xxhash64(text_col).alias("_same"),
    )
    once = chosen.groupBy("_lang", "_same").agg(F.min(F.struct("_order", "_text")).alias("_row")).select("_lang", "_row.*")
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_order", "_text"))
    lowest = once.withColumn("_place", place).where(F.col("_place") <= rows)
    return lowest.select("_lang", "_text", "_order").orderBy("_order", "_lang", "_text")


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    rows = sample(labelled, id_col, text_col, lang_col).collect()
    return fit([r["_text"] for r in rows], [r["_lang"] for r in rows])


def identify(model: Model | None, text: Column) -> Column:
    """Struct of ``lang``, ``score`` and ``rejected`` for the whole text.

    Null texts and texts without a letter are ``und``, score 0, and rejected. Without a
    model (no labelled rows) every text is ``und``, and texts with letters are not rejected.
    """

    @F.arrow_udf("lang string, score double, rejected boolean")
    def predict(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            out = []
            for piece in slices(pa.RecordBatch.from_arrays([part], names=["text"]), 0, _PIECE):
                rows = piece.column(0).to_pylist()
                langs, scores, rejected = [UNKNOWN] * len(rows), [0.0] * len(rows), [True] * len(rows)
                at = [i for i, t in enumerate(rows) if has_letter(t)]
                for i in at:
                    rejected[i] = False
                if model is not None and at:
                    best, score = model.predict([normal(rows[i]) for i in at])
                    for i, b, s in zip(at, best.tolist(), score.tolist()):
                        langs[i], scores[i], rejected[i] = model.labels[b], s, s < model.threshold
                arrays = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
                out.append(pa.StructArray.from_arrays(arrays, names=["lang", "score", "rejected"]))
            yield pa.concat_arrays(out) if out else pa.array([], _FOUND)
            release()

    return predict(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows no model may learn from; a null id counts as neither, see usable()."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def usable(id_col: str = "doc_id") -> Column:
    """Rows a model may learn from: a known id whose checksum leaves another remainder."""
    return F.col(id_col).isNotNull() & ~held_out(id_col)


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score``, ``rejected``."""
    model = train(docs.where(usable(id_col)), id_col, text_col, lang_col)
    found = docs.select(
        F.col(id_col), held_out(id_col).alias("held_out"), identify(model, F.col(text_col)).alias("_found")
    )
    return found.select(
        id_col,
        "held_out",
        F.col("_found.lang").alias("lang_pred"),
        F.col("_found.score").alias("score"),
        F.col("_found.rejected").alias("rejected"),
    )


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose language can be told, with their own columns."""
    model = train(docs.where(usable(id_col)), id_col, text_col, lang_col)
    return docs.where(~identify(model, F.col(text_col))["rejected"])
