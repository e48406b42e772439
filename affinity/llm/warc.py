"""WARC archives: records written in segments, and their reassembly.

Method: a payload becomes an HTTP response with chunked transfer framing; a
record longer than ``segment_bytes`` is cut into a first record and
continuation records.  Reading groups continuation records by the id of their
origin, orders them by segment number, verifies the total length and decodes
the chunked framing.

Archives are written by Spark's text writer, whose line separator is the empty
line pair that ends a WARC record; so task commits, retries and file systems
are Spark's.  A file holds ``records_per_file`` records of at most
``segment_bytes`` each, which bounds what reading it takes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm.common import map_slices

#: Names and line ends of the WARC 1.1 and HTTP/1.1 formats.
VERSION = b"WARC/1.1"
CRLF = b"\r\n"
END = "\r\n\r\n"
KINDS = ("response", "revisit")
HTTP_CHUNKED = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
HTTP_SIZED = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    """SHA-1 in bare upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """A body in chunked transfer framing, ``size`` bytes a chunk."""
    out = []
    for a in range(0, len(payload), size):
        part = payload[a:a + size]
        out += [b"%x" % len(part), CRLF, part, CRLF]
    return b"".join([*out, b"0", CRLF, CRLF])


def dechunk(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0].strip() or b"x", 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size:at + size + 2] != CRLF:
            return None
        out.append(body[at:at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"%s\r\n%sContent-Length: %d\r\n\r\n%s" % (VERSION, head.encode(), len(block), block)


def _records(page_id, url, payload: bytes, keep, refers: bool, segment_bytes: int, chunk_bytes: int):
    own = f"<urn:uuid:{uuid.uuid4()}>"
    uri = "".join(c for c in url or "" if c >= " ") or None
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri), ("Page-ID", page_id),
              ("WARC-Payload-Digest", "sha1:" + digest_of(payload))]
    if refers:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("Refers-To-Page-ID", keep),
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("Content-Type", "application/http;msgtype=response")], HTTP_SIZED % len(payload))
        return
    block = HTTP_CHUNKED + chunked(payload, chunk_bytes)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common,
             ("Content-Type", "application/http;msgtype=response")]
    if len(block) <= segment_bytes:
        yield _record(first, block)
        return
    cuts = range(0, len(block), segment_bytes)
    for n, a in enumerate(cuts, 1):
        part = block[a:a + segment_bytes]
        if n == 1:
            yield _record([*first, ("WARC-Segment-Number", 1)], part)
        else:
            yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                           ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", n),
                           ("WARC-Segment-Total-Length", len(block) if n == len(cuts) else None)], part)


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_revisit_bytes: int = 0, segment_bytes: int = 32 << 10,
                   chunk_bytes: int = 8 << 10, records_per_file: int = 4096) -> None:
    """Write one response or revisit record per row.

    Of rows with equal payloads (null: empty) of ``min_revisit_bytes`` or more,
    the one with the largest id is the response, the others are revisits of it.
    Repeated rows of that id are responses each.  A row whose id is null is a
    revisit if an equal payload has an id, else a response.  An empty table
    gives a folder without records.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("key", F.sha1("payload"))
    keep = rows.groupBy("key").agg(F.max("id").alias("keep"))
    rows = rows.join(keep, "key").withColumn(
        "refers", (F.octet_length("payload") >= min_revisit_bytes) & F.col("keep").isNotNull()
        & ~F.col("id").eqNullSafe(F.col("keep")))

    def render(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row in batch.to_pylist():
            out += _records(row["id"], row["url"], row["payload"], row["keep"], row["refers"],
                            segment_bytes, chunk_bytes)
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = map_slices(rows.select("id", "url", "payload", "keep", "refers"), render, "record binary", "payload")
    (records.select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def _parse(data: bytes):
    """(fields, block) of each record of an archive."""
    at, end = 0, len(data)
    while at < end:
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {}
        for line in data[at:stop].split(CRLF)[1:]:
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode()
        size = int(fields["content-length"])
        yield fields, data[stop + 4:stop + 4 + size]
        at = stop + 4 + size + 4


def _unpacked(data: bytes) -> bytes:
    return gzip.decompress(data) if data.startswith(b"\x1f\x8b") else data


def _payload(block: bytes) -> tuple[bytes | None, int | None]:
    """(payload, size told by the header) of an HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(CRLF)[1:])}
    size = int(fields[b"content-length"]) if b"content-length" in fields else None
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        return dechunk(body), size
    return body, size


_OUT = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "status string, payload binary")


def _result(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    out: dict[str, list] = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type",
                                            "refers_to", "status", "payload")}
    for page, kind, refers, told, block, whole in rows:
        payload, size = _payload(block) if whole else (None, None)
        if kind == "revisit":
            values = (page, size, told, kind, refers, "ok" if size is not None else "no length", None)
        elif payload is None:
            values = (page, None, told, kind, None, "bad framing" if whole else "incomplete", None)
        else:
            own = digest_of(payload)
            values = (page, len(payload), own, kind, None, "ok" if told in (None, own) else "other digest",
                      payload if with_payload else None)
        for k, v in zip(out, values, strict=True):
            out[k].append(v)
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))


def _number(value: str | None) -> int | None:
    return int(value) if value is not None else None


def read_archives(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """One row per response or revisit record, its payload reassembled.

    ``status`` is "ok", "incomplete" (a segment is missing or the total length
    differs), "bad framing" (of the chunks), "other digest" (the payload does
    not match the digest of its header) or "no length" (a revisit that tells no
    size).  Digest and size of a revisit are those its own headers tell.
    Records of other types (warcinfo, request and the like) are passed over.
    Archives are files ``*.gz`` and ``*.warc``; other files are not read.  An
    empty folder gives an empty table; an archive that does not parse is an error.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,warc}")
             .option("recursiveFileLookup", "true").load(path).select("content"))

    def whole(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for f, block in _parse(_unpacked(content.as_py())):
                    if f["warc-type"] not in KINDS or "warc-segment-number" in f:
                        continue
                    rows.append((_number(f.get("page-id")), f["warc-type"], _number(f.get("refers-to-page-id")),
                                 f.get("warc-payload-digest", "").removeprefix("sha1:") or None, block, True))
                    held += len(block)
                    if held > 8 << 20:
                        yield _result(rows, with_payload)
                        rows, held = [], 0
                yield _result(rows, with_payload)

    def parts(batches):
        names = ["origin", "kind", "segment", "total", "page_id", "digest", "block"]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                rows = [(f.get("warc-segment-origin-id") or f["warc-record-id"],
                         f["warc-type"] if f["warc-type"] != "continuation" else None,
                         _number(f["warc-segment-number"]), _number(f.get("warc-segment-total-length")), _number(f.get("page-id")),
                         f.get("warc-payload-digest", "").removeprefix("sha1:") or None, block)
                        for f, block in _parse(_unpacked(content.as_py())) if "warc-segment-number" in f]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    segments = files.mapInArrow(parts, "origin string, kind string, segment long, total long, page_id long, "
                                       "digest string, block binary")
    # A group is the segments of one record: what one payload was in one cell before.
    joined = segments.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("s"), F.max("total").alias("total"),
        F.max("page_id").alias("page_id"), F.max("digest").alias("digest"), F.max("kind").alias("kind"))
    joined = joined.where(F.coalesce("kind", F.lit("response")) == "response")  # no kind: the first segment is lost
    joined = joined.select(
        "page_id", "digest", "total",
        F.col("s.segment").alias("numbers"), F.col("s.block").alias("blocks"),
        F.expr("aggregate(s.block, 0L, (a, x) -> a + octet_length(x))").alias("size"))

    def assemble(batches):
        for batch in batches:
            for row in (r for one in range(batch.num_rows) for r in batch.slice(one, 1).to_pylist()):
                good = row["numbers"] == list(range(1, len(row["numbers"]) + 1)) and row["total"] == row["size"]
                yield _result([(row["page_id"], "response", None, row["digest"],
                                b"".join(row["blocks"]) if good else b"", good)], with_payload)

    return files.mapInArrow(whole, _OUT).unionByName(joined.mapInArrow(assemble, _OUT))
