"""Archives written and read back: contract, chunks, damaged archives, edges."""

import base64
import gzip
import hashlib
import io
from collections import defaultdict

import pytest

from starloom.llm import warc as W
from starloom.llm.scratch import fresh_path


def expected(rows):
    groups = defaultdict(list)
    for p, _, h in rows:
        groups[h or ""].append(p)
    out = []
    for p, _, h in rows:
        body = (h or "").encode()
        ids = [x for x in groups[h or ""] if x is not None]
        top = max(ids) if ids else None
        again = p != top
        out.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def archive(spark, rows, chunk=W.CHUNK):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = fresh_path(spark, "warc-test")
    manifest = W.write_archives(W.records(df, chunk=chunk), folder)
    return manifest, W.read_archives(spark, manifest, folder)


ROWS = [(1, "http://a/\r\nX: y", "ab" * 3000), (2, None, None), (3, "u", ""), (None, "u", "é" * 1000), (None, "u", "ab" * 3000),
        (5, "ü", "ab" * 3000), (5, "u", "ab" * 3000), (6, "u", "\r\n\r\nWARC/1.1\r\n"), (7, "u", "x")]


@pytest.mark.parametrize("chunk", [7, 1000, W.CHUNK])
def test_round_trip(spark, chunk):
    manifest, table = archive(spark, ROWS, chunk)
    rows = table.where("last").collect()
    got = sorted(((r["page_id"], r["n_bytes"], r["digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)
    assert got == expected(ROWS)
    assert sum(r["n_records"] for r in manifest.collect()) == len(ROWS)


def test_chunks_carry_running_digests():
    body = bytes(range(256)) * 50
    raw = W.record_head(1, "u", hashlib.sha1(body).hexdigest(), len(body), "response", None) + body + b"\r\n\r\n"
    rows = list(W.chunk_rows(io.BytesIO(gzip.compress(raw) * 2), "p", chunk=1000))
    assert len(rows) == 26
    for _, record, page, kind, _, no, done, digest, last, data in rows:
        assert (record, page, kind) == ("<urn:page:1>", 1, "response") and len(data) <= 1000
        assert digest == base64.b32encode(hashlib.sha1(body[:done]).digest()).decode()
        assert last == (done == len(body)) and done == min(len(body), (no + 1) * 1000)
    with pytest.raises(ValueError, match="ends within"):
        list(W.chunk_rows(io.BytesIO(gzip.compress(raw)[:-20]), "p"))
    bad = gzip.compress(raw.replace(body, body[::-1]))
    with pytest.raises(ValueError, match="declared"):
        list(W.chunk_rows(io.BytesIO(bad), "p"))


def test_empty_table_and_query(spark):
    _, table = archive(spark, [])
    assert table.count() == 0
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    got = W.op3_warc(spark, "/root/testdata/sf0.001")
    keep = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.select(*keep).collect()), key=str) == expected(rows)
