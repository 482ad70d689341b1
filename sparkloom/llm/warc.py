"""WARC archives: writing with revisits and segments, and reading with segment reassembly.

Writing: of pages with equal payloads of at least MIN_DEDUP bytes that with the
smallest id becomes a response, the others revisit it. A response's HTTP message
has its body in chunked transfer framing; a message longer than the segment size
is split: the first record is a response with segment number 1, continuation
records name it as their origin, and the last one tells the total length. Each
record is a gzip member of its own. Archives of some MB are rows of a table in the
shared folder; each is, byte for byte, a .warc.gz file, and `read_files` reads such
files.

Reading: whole messages are decoded as they are met; segments are grouped by origin
identifier, ordered by number, joined and checked for gaps and total length, and
their transfer framing is undone.

Rules for odd input: null html is empty; a null page_id never is the smallest; rows that
repeat a page with its id all are responses; pages whose ids are all null are
responses; extra columns are ignored; damaged messages come out with null payloads and
an error; an empty table gives no records.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_DEDUP, SEGMENT, CHUNK, ARCHIVE_BYTES = 100, 8192, 4096, 4 << 20
DATE = "2024-01-01T00:00:00Z"
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    """A body in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(p), p) for p in (body[i : i + size] for i in range(0, len(body), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The body in chunked transfer framing; ValueError if it is cut short or malformed."""
    out, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size missing")
        size = int(framed[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        part = framed[end + 2 : end + 2 + size]
        if len(part) < size or framed[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(part)
        at = end + 4 + size


def record(fields: dict[str, str], block: bytes) -> bytes:
    """A WARC record as a gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def page_records(record_id: str, page_id, url: str | None, body: bytes, digest: str, refers_to, size: int, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page."""
    base = {"WARC-Date": DATE, "WARC-Record-ID": f"<{record_id}>", "WARC-Target-URI": (url or "").replace("\r", "").replace("\n", ""), "Page-ID": "" if page_id is None else str(page_id)}
    if refers_to is not None:
        more = {"WARC-Type": "revisit", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Refers-To": f"<urn:page:{refers_to}>"}
        yield record(base | more, HEAD + b"Content-Length: %d\r\n\r\n" % size)
        return
    message = HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(body)
    parts = [message[i : i + segment] for i in range(0, len(message), segment)]
    first = base | {"WARC-Type": "response", "WARC-Payload-Digest": f"sha256:{digest}"}
    if len(parts) == 1:
        yield record(first, message)
        return
    yield record(first | {"WARC-Segment-Number": "1"}, parts[0])
    for i, p in enumerate(parts[1:], 2):
        own = {"WARC-Type": "continuation", "WARC-Date": DATE, "WARC-Record-ID": f"<{record_id}:{i}>", "WARC-Segment-Origin-ID": f"<{record_id}>", "WARC-Segment-Number": str(i)}
        yield record(own | ({"WARC-Segment-Total-Length": str(len(message))} if i == len(parts) else {}), p)


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, body, digest, size, refers_to (null for responses)."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256)).withColumn("size", F.length("body").cast("long"))
    twins = common.written(rows.filter(F.col("size") >= MIN_DEDUP).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL"), "warc-twins", 4)
    total = twins.agg(F.sum("n")).first()[0]
    if not total:
        return rows.withColumn("refers_to", F.lit(None).cast(pages.schema["page_id"].dataType))
    hot = common.hot_keys(twins, "digest", "n", total, common.partitions(pages.sparkSession))
    met = common.salted_left_join(rows, twins.drop("n"), "digest", hot, "page_id")
    return met.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def written_archives(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """archive (name), content: archives in the shared folder that hold all pages."""
    common.session(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial, files, now, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def archive() -> pa.RecordBatch:
            nonlocal files, now, size
            name, content = f"part-{task:05d}-{files:05d}.warc.gz", b"".join(now)
            files, now, size = files + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["archive", "content"])

        for b in batches:
            for r in b.to_pylist():
                for x in page_records(f"urn:sparkloom:{task}:{serial}", r["page_id"], r["url"], r["body"], r["digest"], r["refers_to"], r["size"], segment):
                    now.append(x)
                    size += len(x)
                serial += 1
                if size >= ARCHIVE_BYTES:
                    yield archive()
        if now:
            yield archive()

    rows = with_revisits(pages).select("page_id", "url", "body", "digest", "refers_to", "size")
    return common.written(rows.mapInArrow(run, "archive string, content binary"), "warc")


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of a .warc.gz or .warc file; field names in lower case."""
    at = 0
    while at < len(content):
        if content[at : at + 2] == b"\x1f\x8b":
            z = zlib.decompressobj(31)
            data = z.decompress(content[at:at + (64 << 10)])
            used = at + (64 << 10)
            while not z.eof and used < len(content):
                data += z.decompress(content[used : used + (1 << 20)])
                used += 1 << 20
            at = min(used, len(content)) - len(z.unused_data)
            if not z.eof:
                raise ValueError("gzip member cut short")
        else:
            data, at = content[at:], len(content)
        lo = 0
        while lo < len(data):
            end = data.find(b"\r\n\r\n", lo)
            if end < 0:
                break
            lines = data[lo:end].decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("not a WARC record")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            size = int(fields["content-length"])
            yield fields, data[end + 4 : end + 4 + size]
            lo = end + 4 + size + 4


def http(message: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower case) and the body, its transfer framing undone."""
    head, gap, body = message.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("HTTP header cut short")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}
    return fields, unchunked(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body


def joined(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """The whole of (number, total length or none, block) segments in any order; ValueError if any is missing or lengths differ."""
    segments = sorted(dict.fromkeys(segments))
    if [n for n, _, _ in segments] != list(range(1, len(segments) + 1)):
        raise ValueError("segment missing")
    total, whole = segments[-1][1], b"".join(x for _, _, x in segments)
    if total is None or total != len(whole):
        raise ValueError("total length differs")
    return whole


READ = "page_id string, record_type string, refers_to string, url string, payload binary, payload_bytes long, payload_digest string, error string"


def _row(fields: dict[str, str], message: bytes | None, error: str | None) -> tuple:
    kind, refers, payload, size, digest = fields.get("warc-type"), None, None, None, None
    try:
        if error:
            raise ValueError(error)
        head, body = http(message)
        if kind == "revisit":
            refers = fields["warc-refers-to"].strip("<>").removeprefix("urn:page:")
            size, digest = int(head["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
        else:
            payload, size, digest = body, len(body), sha256(body).hexdigest()
    except (ValueError, KeyError) as e:
        error = str(e)
    return fields.get("page-id") or None, kind, refers, fields.get("warc-target-uri"), payload, size, digest, error


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]
    names = [x.split()[0] for x in READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read(archives: DataFrame) -> DataFrame:
    """page_id, record_type, refers_to, url, payload, payload_bytes, payload_digest, error of all responses and revisits in archives (column content)."""
    common.session(archives)

    def whole(batches):
        for b in batches:
            for content in b.column(0).to_pylist():
                rows = []
                for fields, block in parse(content or b""):
                    if fields.get("warc-type") in ("response", "revisit") and "warc-segment-number" not in fields:
                        rows.append(_row(fields, block, None))
                        if len(rows) == 256:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    def parts(batches):
        names = ["origin", "number", "total", "fields", "block"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
        for b in batches:
            for content in b.column(0).to_pylist():
                rows = []
                for fields, block in parse(content or b""):
                    if "warc-segment-number" in fields:
                        total = fields.get("warc-segment-total-length")
                        origin = fields.get("warc-segment-origin-id") or fields["warc-record-id"]
                        rows.append((origin, int(fields["warc-segment-number"]), int(total) if total else None, list(fields.items()), block))
                for at in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 256], strict=True), types, strict=True)], names=names)

    def rebuilt(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        first = next((dict(r["fields"]) for r in rows if r["number"] == 1), {"warc-type": "response"})
        try:
            out = _row(first, joined([(r["number"], r["total"], r["block"]) for r in rows]), None)
        except ValueError as e:
            out = _row(first, None, str(e))
        return pa.Table.from_batches([_batch([out])])

    segments = archives.select("content").mapInArrow(parts, "origin string, number long, total long, fields map<string,string>, block binary")
    return archives.select("content").mapInArrow(whole, READ).unionByName(segments.groupBy("origin").applyInArrow(rebuilt, READ))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """`read` over .warc and .warc.gz files, each of which fits in a task."""
    return read(spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(path).select("content"))


def op8(pages: DataFrame) -> DataFrame:
    """What reading back says of each page."""
    kind = pages.schema["page_id"].dataType
    back = read(written_archives(pages))
    return back.select(F.col("page_id").try_cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").try_cast(kind).alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
