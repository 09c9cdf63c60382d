"""Token counts of documents in flat token files without an index.

A token file is nothing but token ids of fixed width, one document after the other, each
ended by a separator id. Blocks of a fixed number of bytes are read in parallel and searched
for separators with one vector operation; a block tells the lengths of the pieces between
them. A running sum of the separators in the blocks before gives every piece the number of
its document, and adding up pieces by that number stitches documents that cross blocks.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapledger.llm.common import stored
from snapledger.llm.warc_zip import filesystem
from snapledger.session import shared_dir

# A public byte-level vocabulary; its file is read on the driver and sent to the tasks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SEPARATOR = 50256  # the first id the vocabulary leaves free
# Fixed value: how byte-level vocabularies of this family split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BLOCK_BYTES = 4 << 20
FILE_BYTES = 256 << 20


@lru_cache(maxsize=1)
def _encoding(ranks: bytes) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("documents", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def _writer(root: str, ranks: bytes, separator: int, dtype: str, limit: int) -> Callable:
    schema = pa.schema([("path", pa.string()), ("ordinal", pa.int64()), ("id", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks).encode_ordinary
        fs, folder = filesystem(root)
        part, k, out = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            rows: dict[str, list] = {"path": [], "ordinal": [], "id": []}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if out is None:
                    fs.create_dir(folder, recursive=True)
                    name, temp, ordinal, size = f"tokens-{part:05d}-{k:03d}.bin", f".{uuid.uuid4().hex}", 0, 0
                    out = fs.open_output_stream(f"{folder}/{temp}")
                raw = np.array([*encode(text or ""), separator], dtype).tobytes()
                out.write(raw)
                for key, value in zip(rows, (f"{root}/{name}", ordinal, doc_id)):
                    rows[key].append(value)
                ordinal, size = ordinal + 1, size + len(raw)
                if size >= limit:
                    out.close()
                    fs.move(f"{folder}/{temp}", f"{folder}/{name}")
                    out, k = None, k + 1
            yield pa.RecordBatch.from_pydict(rows, schema)
        if out is not None:
            out.close()
            fs.move(f"{folder}/{temp}", f"{folder}/{name}")

    return write


def write_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    separator: int = SEPARATOR,
    dtype: str = "uint16",
    limit: int = FILE_BYTES,
) -> DataFrame:
    """Write whole texts as token files in the shared folder; null counts as empty. Returns
    the stored list of which document is where: path, ordinal (place in the file) and the id
    column. A repeated task replaces its files by equal ones, and a file gets its name only
    when it is complete."""
    with open(vocabulary, "rb") as file:
        ranks = file.read()
    if separator > np.iinfo(dtype).max:
        raise ValueError(f"{dtype} cannot hold the separator {separator}")
    root = shared_dir(docs.sparkSession, "token-files")
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    made = rows.mapInArrow(_writer(root, ranks, separator, dtype, limit), "path string, ordinal long, id long")
    return stored(made.withColumnRenamed("id", id_col), "token-places")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        sizes = []
        for path in paths:
            fs, name = filesystem(path)
            sizes.append(fs.get_file_info(name).size)
        yield pa.RecordBatch.from_pydict({"path": paths, "size": pa.array(sizes, pa.int64())})


def _pieces(separator: int, dtype: str) -> Callable:
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("pieces", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, name = filesystem(row["path"])
                with fs.open_input_file(name) as file:
                    ids = np.frombuffer(file.read_at(row["length"], row["start"]), dtype)
                at = np.flatnonzero(ids == separator)
                # Lengths before, between and after the separators.
                lengths = np.diff(np.concatenate(([-1], at, [len(ids)]))) - 1
                yield pa.RecordBatch.from_pydict(
                    {"path": [row["path"]], "block": [row["block"]], "pieces": [lengths]}, schema
                )

    return scan


def scan_tokens(
    files: DataFrame,
    path_col: str = "path",
    separator: int = SEPARATOR,
    dtype: str = "uint16",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Path, ordinal and ``n_tokens`` (without the separator) of every document in the files.
    Two separators in a row are an empty document; tokens after the last one are a document
    as well. An empty file has none. A file must hold whole ids."""
    spark = files.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block_bytes -= block_bytes % np.dtype(dtype).itemsize
    paths = files.select(F.col(path_col).cast("string").alias("path")).distinct()
    sizes = paths.mapInArrow(_sizes, "path string, size long").where("size > 0")
    numbers = F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / block_bytes))
    blocks = sizes.select("path", "size", F.explode(numbers).alias("block")).select(
        "path",
        "block",
        (F.col("block") * block_bytes).alias("start"),
        F.least(F.lit(block_bytes), F.col("size") - F.col("block") * block_bytes).alias("length"),
    )
    found = stored(
        blocks.repartition(n).mapInArrow(_pieces(separator, dtype), "path string, block long, pieces array<long>"),
        "token-pieces",
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = found.select("path", "block", (F.size("pieces") - 1).cast("long").alias("_n"))
    offsets = counts.select("path", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ends = counts.groupBy("path").agg(F.sum("_n").alias("_all"))
    pieces = found.join(offsets.join(ends, "path"), ["path", "block"]).select(
        "path", "_first", "_all", F.posexplode("pieces").alias("_at", "_length")
    )
    documents = pieces.groupBy("path", (F.col("_first") + F.col("_at")).alias("ordinal"), "_all").agg(
        F.sum("_length").alias("n_tokens")
    )
    # What follows the last separator is a document only if there is something.
    return documents.where("ordinal < _all or n_tokens > 0").drop("_all")


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: the id column and ``n_tokens``, counted from token files that
    are written for it. Null and empty texts have 0; repeated rows and null ids are counted
    like others; an empty table gives no rows; other columns are not read. Ids are whole
    numbers, or texts of such; others raise."""
    block = {"block_bytes": options.pop("block_bytes")} if "block_bytes" in options else {}
    places = write_tokens(docs, id_col, text_col, **options)
    same = {k: options[k] for k in ("separator", "dtype") if k in options}
    counts = scan_tokens(places, **same, **block)
    return places.join(counts, ["path", "ordinal"]).select(id_col, "n_tokens")
