import gzip
import hashlib
import io
import json
import zipfile

import pyarrow as pa
import pytest

from snapledger.llm import queries
from snapledger.llm import warc_zip as Z

PAGES = "page_id long, url string, html string, payload_digest string, record_type int"


def expected(rows):
    out = []
    for i, _, html, *_ in rows:
        p = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == p and r[0] is not None]
        first = min(same, default=None) if len(p) >= 100 else None
        again = first is not None and i != first
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip_and_edge_cases(spark):
    big, long = "x" * 100, "é\r\n\r\nWARC/1.1 " * 40_000
    rows = [
        (5, "http://a/", big), (3, "http://b/\n", big), (9, None, big), (1, "", None), (2, "u", ""),
        (4, "u", "short"), (7, "u", "short"), (8, "u", long), (10, "u", long), (None, None, big),
        (None, "u", "é" * 50), (None, "u", "é" * 50), (3, "http://b/", big), (11, "u", big[1:]),
    ]
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES).repartition(5)
    packages = Z.write_pages(d, limit=1000)
    got = Z.read_packages(packages, step_bytes=500)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    back = got.collect()
    assert sorted((tuple(r[c] for c in cols) for r in back), key=str) == expected(rows)
    texts = {(r[0], (r[2] or "").encode()) for r in rows}
    assert all((r.page_id, bytes(r.payload)) in texts for r in back if r.record_type == "response")
    assert packages.agg({"n_records": "sum"}).first()[0] == len(rows)


def test_empty(spark):
    assert Z.read_packages(Z.write_pages(spark.createDataFrame([], PAGES))).count() == 0


def record(i, body):
    return Z._record(i, "u", body, hashlib.sha256(body).hexdigest(), None)


def read(raw):
    file = pa.BufferReader(raw)
    out = []
    for at, n, zipped in Z.record_ranges(file):
        one = file.read_at(n, at)
        out.append(Z.parse_record(gzip.decompress(one) if zipped else one)["payload"])
    return out


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("form", ["plain", "no index", "gz"])
def test_directories(monkeypatch, zip64, form):
    if zip64:  # make the writer use ZIP64 records although the sizes are small
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    bodies = [b"one" * 50, b"", b"PK\5\6" * 10]
    parts = [record(i, b) for i, b in enumerate(bodies)]
    name = "archive/x.warc"
    if form == "gz":
        parts, name = [gzip.compress(p) for p in parts], name + ".gz"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"PK\5\6 in a comment"
        z.writestr("readme.txt", "x" * 30)
        z.writestr(name, b"".join(parts))
        if form != "no index":
            at = [sum(map(len, parts[:i])) for i in range(3)]
            z.writestr("indexes/index.cdxj", "\n".join(
                f"com,x)/ 2024 {json.dumps({'offset': str(a), 'length': str(len(p)), 'filename': name.split('/')[1]})}"
                for a, p in zip(at, parts)
            ))
    assert read(out.getvalue()) == bodies


def test_compressed_member_is_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.warc", record(1, b"x" * 500))
    with pytest.raises(ValueError, match="stored"):
        read(out.getvalue())


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op3_warc"](spark, sf).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows)
