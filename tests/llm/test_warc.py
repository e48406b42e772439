import base64
import gzip
import hashlib
import os

import pytest

from affinity.llm import warc
from affinity.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm.helpers import table


def expected(rows, least=0):
    last = {}
    for i, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, h in rows:
        data = (h or "").encode()
        keep = last.get(h or "")
        again = keep is not None and keep != i and len(data) >= least
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if again else "response", keep if again else None))
    return sorted(out, key=str)


def stored(spark, rows, **options):
    pages = spark.createDataFrame([(i, "http://a/\r\nX: y", h, 1, b"z", "k") for i, h in rows],
                                  "page_id long, url string, html string, id int, payload binary, key string")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path, **options)
    return path, warc.read_archives(spark, path).collect()


def columns(rows):
    assert all(r.status == "ok" for r in rows)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def test_pages_in_small_segments(spark):
    rows = [(r["page_id"], r["html"]) for r in table(f"{SF_SMALL}/pages.parquet")]
    rows += [(10_000 + k, rows[k % 7][1]) for k in range(30)]
    path, got = stored(spark, rows, segment_bytes=301, chunk_bytes=97, records_per_file=50)
    assert columns(got) == expected(rows)
    texts = dict(rows)
    assert all(r.payload.decode() == texts[r.page_id] for r in got if r.record_type == "response")
    assert sum(f.endswith(".gz") for f in os.listdir(path.removeprefix("file:"))) > 10


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "é" * 40_000), (4, "é" * 40_000), (5, "a\r\n\r\nWARC/1.1\r\n0\r\n\r\n"), (6, "x"),
            (6, "x"), (None, "x"), (None, "lone"), (7, "0\r\n\r\n" * 9000), (8, "\U0001F600" * 11)]
    _, got = stored(spark, rows)
    assert columns(got) == expected(rows)
    _, got = stored(spark, rows, min_revisit_bytes=1000)
    assert columns(got) == expected(rows, 1000)
    _, got = stored(spark, [])
    assert got == []


@pytest.mark.parametrize("damage, status", [("drop", "incomplete"), ("total", "incomplete"), ("digest", "other digest"),
                                            ("chunk", "bad framing")])
def test_damaged_archives(spark, tmp_path, damage, status):
    records = list(warc._records(1, "http://a", b"abc" * 500, None, False, 400, 64))
    if damage == "drop":
        del records[1]
    elif damage == "total":
        records[-1] = records[-1].replace(b"Total-Length: ", b"Total-Length: 1")
    elif damage == "digest":
        records[0] = records[0].replace(b"sha1:", b"sha1:AA")
    else:
        records[1] = records[1].replace(b"\r\n40\r\n", b"\r\nzz\r\n")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(r + b"\r\n\r\n" for r in records)))
    row, = warc.read_archives(spark, str(tmp_path)).collect()
    assert (row.page_id, row.status) == (1, status)


def test_records_of_other_types_and_plain_archives(spark, tmp_path):
    def other(kind, *more):
        return warc._record([("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{kind}>"), *more], b"k: v")

    records = [other("warcinfo"), other("request"), other("resource", ("WARC-Segment-Number", 1)),
               *warc._records(1, "http://a", b"abc" * 500, None, False, 400, 64)]
    (tmp_path / "a.warc").write_bytes(b"".join(r + b"\r\n\r\n" for r in records))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(other("metadata") + b"\r\n\r\n"))
    (tmp_path / "readme.txt").write_text("no archive")
    row, = warc.read_archives(spark, str(tmp_path)).collect()
    assert (row.page_id, row.status, row.payload) == (1, "ok", b"abc" * 500)


def test_chunk_framing():
    for n in (0, 1, 63, 64, 65, 1000):
        assert warc.dechunk(warc.chunked(b"q" * n, 64)) == b"q" * n
    assert warc.dechunk(b"3;name=x\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"
    assert warc.dechunk(b"5\r\nabc\r\n0\r\n\r\n") is None and warc.dechunk(b"") is None
