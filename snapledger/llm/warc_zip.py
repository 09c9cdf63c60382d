"""WARC records inside ZIP packages: written by partition, read by ranges.

A package holds one stored (not compressed by ZIP) WARC member, whose records are gzip
members of their own, and a stored index of them. The reader takes the ZIP directory from the end of the file, ZIP64 included,
finds the stored WARC members and their index, and reads only the byte ranges of the
records: nothing is extracted and no package is held in memory. Packages live in the
shared folder; their paths come from a stored table, so any executor can read any one.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.common import stored
from snapledger.session import shared_dir

# Shorter payloads are never made into revisits.
LEAST_REVISIT = 100
# A package is closed when its WARC member has so many bytes; ranges are read in such steps.
PACKAGE_BYTES = 256 << 20
READ_BYTES = 8 << 20
# Fixed, so that a repeated task writes the same bytes.
WARC_DATE = datetime(2024, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

# --- fixed values of the ZIP and WARC formats
END = struct.Struct("<4s4H2LH")  # PK\5\6
END64_LOCATOR = struct.Struct("<4sLQL")  # PK\6\7
END64 = struct.Struct("<4sQ2H2L4Q")  # PK\6\6
ENTRY = struct.Struct("<4s6H3L5H2L")  # PK\1\2
LOCAL = struct.Struct("<4s5H3L2H")  # PK\3\4
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, as Spark names it, and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


# --- writing


def _record(page_id, url, payload: bytes, digest: str, first) -> bytes:
    """One WARC record. ``first`` is None for a response, else the page it repeats."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
    block = http % len(payload) + (payload if first is None else b"")
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", WARC_DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Bytes", len(payload)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if first is not None:
        fields += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", f"<urn:page:{first}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _write_package(root: str, name: str, rows: Iterator[tuple], limit: int) -> tuple | None:
    """Write rows into one package until it is full. A repeated task replaces the file
    by an equal one, and a half written file never has the final name."""
    fs, folder = filesystem(root)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    index, at = [], 0
    first_row = next(rows, None)
    if first_row is None:
        return None
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(part) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
        with package.open(zipfile.ZipInfo("archive/data.warc.gz"), "w", force_zip64=True) as member:
            row = first_row
            while row is not None:
                record = gzip.compress(_record(*row), mtime=0)
                member.write(record)
                index.append(json.dumps({"offset": at, "length": len(record), "digest": row[3]}))
                at += len(record)
                row = next(rows, None) if at < limit else None
        package.writestr(zipfile.ZipInfo("indexes/index.cdxj"), "\n".join(index) + "\n")
    fs.move(part, f"{folder}/{name}.zip")
    return f"{root}/{name}.zip", at, len(index)


def _writer(root: str, limit: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for page_id, url, html, digest, first, again in zip(*(c.to_pylist() for c in batch.columns)):
                    yield page_id, url, (html or "").encode(), digest, first if again else None

        source, k = rows(), 0
        part = TaskContext.get().partitionId()
        while made := _write_package(root, f"pages-{part:05d}-{k:03d}", source, limit):
            k += 1
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("path", "n_bytes", "n_records"), made))],
                pa.schema([("path", pa.string()), ("n_bytes", pa.int64()), ("n_records", pa.int64())]),
            )

    return write


def write_pages(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = LEAST_REVISIT,
    limit: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write every row as a WARC record and return the stored table of packages (path,
    n_bytes, n_records).

    Of rows with equal payloads of at least ``least`` bytes, the one with the smallest id
    is a response and the others are revisits of it; rows that repeat this id are all
    responses, and so are all rows where every id is null. Null html is an empty payload,
    a null url is left out. Ids are whole numbers, or texts of such. A url is written without
    spaces around it and with line breaks escaped. Other columns are not read.
    """
    root = shared_dir(pages.sparkSession, "packages")
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("_url"),
        F.col(html_col).alias("_html"),
        F.sha2(payload, 256).alias("_sha"),
        F.octet_length(payload).alias("_n"),
    )
    # Only ids and digests move to find repeats; the pages then meet them by id, which no
    # group of equal pages can crowd.
    narrow = rows.where(F.col("_n") >= least).select("_id", "_sha")
    firsts = narrow.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count("*").alias("_c"))
    again = (
        narrow.join(firsts.where("_c > 1 and _first is not null"), "_sha")
        .where(~F.col("_id").eqNullSafe(F.col("_first")))
        .select(F.col("_id").alias("_id2"), F.col("_sha").alias("_sha2"), "_first")
        .distinct()
    )
    same = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_sha") == F.col("_sha2"))
    marked = rows.join(again, same, "left").select(
        "_id", "_url", "_html", "_sha", "_first", F.col("_first").isNotNull().alias("_again")
    )
    made = marked.mapInArrow(_writer(root, limit), "path string, n_bytes long, n_records long")
    return stored(made, "package-list")


# --- reading


@dataclass
class Member:
    name: str
    method: int
    size: int
    start: int


def zip_members(file: pa.NativeFile) -> list[Member]:
    """Parse the central directory, by its ZIP64 records where there are any."""
    total = file.size()
    tail_at = max(0, total - END.size - FULL16)
    tail = file.read_at(total - tail_at, tail_at)
    at = tail.rfind(b"PK\5\6")
    while at >= 0 and (len(tail) - at < END.size or at + END.size + END.unpack_from(tail, at)[7] > len(tail)):
        at = tail.rfind(b"PK\5\6", 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    _, _, _, _, count, length, start, _ = END.unpack_from(tail, at)
    if FULL16 in (count,) or FULL32 in (length, start):
        where = tail_at + at - END64_LOCATOR.size
        sign, _, end64, _ = END64_LOCATOR.unpack(file.read_at(END64_LOCATOR.size, where))
        if sign == b"PK\6\7":
            fields = END64.unpack(file.read_at(END64.size, end64))
            if fields[0] != b"PK\6\6":
                raise ValueError("no ZIP64 end where its locator points")
            count, length, start = fields[7:10]
    directory = file.read_at(length, start)
    members, at = [], 0
    for _ in range(count):
        sign, _, _, _, method, _, _, _, packed, size, n_name, n_extra, n_note, _, _, _, local = (
            ENTRY.unpack_from(directory, at)
        )
        if sign != b"PK\1\2":
            raise ValueError("broken ZIP directory")
        name = directory[at + ENTRY.size : at + ENTRY.size + n_name].decode("utf-8", "replace")
        extra = directory[at + ENTRY.size + n_name : at + ENTRY.size + n_name + n_extra]
        at += ENTRY.size + n_name + n_extra + n_note
        size, packed, local = _zip64(extra, size, packed, local)
        head = LOCAL.unpack(file.read_at(LOCAL.size, local))
        if head[0] != b"PK\3\4":
            raise ValueError(f"no local header of {name}")
        members.append(Member(name, method, packed, local + LOCAL.size + head[9] + head[10]))
    return members


def _zip64(extra: bytes, size: int, packed: int, local: int) -> tuple[int, int, int]:
    """Sizes and place from the ZIP64 field, which has only those that are full."""
    values, i = [size, packed, local], 0
    while i + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, i)
        if kind == 1:
            at = i + 4
            for k, v in enumerate(values):
                if v == FULL32:
                    (values[k],) = struct.unpack_from("<Q", extra, at)
                    at += 8
        i += 4 + n
    return tuple(values)


def _index(file: pa.NativeFile, members: list[Member]) -> list[dict]:
    """Records from stored index members (JSON after an optional key), by WARC member."""
    found = []
    for m in members:
        if m.method == zipfile.ZIP_STORED and m.name.endswith((".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz")):
            raw = file.read_at(m.size, m.start)
            raw = gzip.decompress(raw) if m.name.endswith(".gz") else raw
            for line in raw.decode("utf-8").splitlines():
                if "{" in line:
                    found.append(json.loads(line[line.index("{") :]))
    return found


def _walk(file: pa.NativeFile, m: Member) -> Iterator[tuple[int, int]]:
    """Places of the records of an uncompressed WARC member without an index."""
    at, end = m.start, m.start + m.size
    while at < end:
        head, step = b"", 4096
        while b"\r\n\r\n" not in head and at + len(head) < end:
            head += file.read_at(min(step, end - at - len(head)), at + len(head))
        fields = _fields(head.split(b"\r\n\r\n", 1)[0])
        length = head.index(b"\r\n\r\n") + 4 + int(fields["content-length"]) + 4
        yield at, min(length, end - at)
        at += length


def record_ranges(file: pa.NativeFile) -> list[tuple[int, int, bool]]:
    """(start, length, gzipped) of every record of the stored WARC members."""
    members = zip_members(file)
    archives = [m for m in members if m.name.endswith((".warc", ".warc.gz"))]
    for m in archives:
        if m.method != zipfile.ZIP_STORED:
            raise ValueError(f"{m.name} is compressed by ZIP; only stored members can be read by ranges")
    index = _index(file, members)
    out = []
    for m in archives:
        zipped = m.name.endswith(".gz")
        name = m.name.rsplit("/", 1)[-1]
        own = [x for x in index if x.get("filename", name) in (name, m.name)]
        if own and (len(archives) == 1 or all("filename" in x for x in own)):
            out += [(m.start + int(x["offset"]), int(x["length"]), zipped) for x in own]
        elif zipped:
            raise ValueError(f"{m.name} has no index")
        else:
            out += [(at, n, False) for at, n in _walk(file, m)]
    return sorted(out)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse_record(raw: bytes) -> dict:
    """Fields of a response or revisit. A response's payload must have its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    kind = fields["warc-type"]
    page = lambda x: int(x) if (x := fields.get(x, "").removeprefix("<urn:page:").rstrip(">")) else None
    digest, size = fields.get("warc-payload-digest", "").removeprefix("sha256:"), len(payload)
    if kind == "response":
        own = hashlib.sha256(payload).hexdigest()
        if digest and digest != own:
            raise ValueError(f"payload of {fields.get('warc-record-id')} differs from its digest")
        digest = own
    else:
        size = int(fields.get("x-payload-bytes", 0))
    return {
        "page_id": page("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("warc-refers-to"),
    }


RECORD = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
)
RECORD_DDL = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)
_STEP = pa.schema([("path", pa.string()), ("records", pa.list_(pa.list_(pa.int64())))])


def _locate(step_bytes: int):
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = filesystem(path)
                with fs.open_input_file(name) as file:
                    step: list[list[int]] = []
                    for start, length, zipped in record_ranges(file):
                        if step and start + length - step[0][0] > step_bytes:
                            yield pa.RecordBatch.from_pylist([{"path": path, "records": step}], _STEP)
                            step = []
                        step.append([start, length, int(zipped)])
                    if step:
                        yield pa.RecordBatch.from_pylist([{"path": path, "records": step}], _STEP)

    return locate


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            fs, name = filesystem(row["path"])
            with fs.open_input_file(name) as file:
                start = row["records"][0][0]
                end = max(a + n for a, n, _ in row["records"])
                raw = memoryview(file.read_at(end - start, start))
            out = []
            for at, n, zipped in row["records"]:
                one = bytes(raw[at - start : at - start + n])
                out.append(parse_record(gzip.decompress(one) if zipped else one))
            yield pa.RecordBatch.from_pylist(out, RECORD)


def read_packages(packages: DataFrame, path_col: str = "path", step_bytes: int = READ_BYTES) -> DataFrame:
    """Records of the packages at the given paths: page_id, url, payload (null for a
    revisit), payload_bytes, payload_digest, record_type, refers_to. Directories are read
    first; then ranges of some ``step_bytes`` are dealt out over all tasks."""
    spark: SparkSession = packages.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = packages.select(F.col(path_col).cast("string")).repartition(n)
    steps = paths.mapInArrow(_locate(step_bytes), "path string, records array<array<long>>")
    return steps.repartition(n).mapInArrow(_read, RECORD_DDL)
