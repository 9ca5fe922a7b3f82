"""WARC archives: records with segments, written by Spark, read back and reassembled.

Writing: a record holds an HTTP response with chunked transfer framing. Of equal large payloads
one record is a ``response`` and the others ``revisit`` it. A block over ``segment_bytes`` is
cut into a first record and ``continuation`` records that name it. Every record has a date and a random identifier of its own, so that
repeated rows have records of their own; a revisit names its target by URI and payload digest, and by the page's id. Archives are
written by Spark's text writer, one record to a row, the record end as the row separator.

Reading: archives come in whole as binary files; records are cut out by their Content-Length,
so payloads may hold any bytes. Continuations are grouped by the identifier of their origin alone,
ordered by segment number, verified against the total length, joined and dechunked; the rows of
a group are the segments of one record, so a group is as large as one payload. What else is known of a record comes from its first
segment. Records without segments don't shuffle. Archives of other writers are read as well: digests may be hexadecimal or base32, in
any case; a record without a page id has a null one.

Scale: deduplication shuffles digests and ids (with partial aggregation, so a payload that
fills a third of the table is one row per task), and sends the payloads that repeat back to the pages by broadcast if they are few, else by
a join on the digest; archives are bounded by ``records_per_file``.

Edge cases: a null payload is empty; empty payloads are responses; null ids and urls are written as empty
fields and ids read back as null; repeated page ids get a record each, rows equal to the response in id and payload are responses too;
extra columns are ignored; an empty table writes no record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import materialize, small_batches

END = "\r\n\r\n"
_FIELDS = re.compile(rb"^([A-Za-z-]+):[ \t]*([^\r\n]*)\r$", re.M)


def slices(body: bytes, size: int) -> Iterator[bytes]:
    """``body`` in pieces of about ``size`` bytes that end between characters, as records are written as text."""
    at = 0
    while at < len(body):
        end = at + size
        while end < len(body) and body[end] & 0xC0 == 0x80:
            end += 1
        yield body[at:end]
        at = end


def chunked(body: bytes, size: int = 4096) -> bytes:
    """HTTP/1.1 chunked transfer framing."""
    return b"".join(b"%x\r\n%s\r\n" % (len(x), x) for x in slices(body, size)) + b"0\r\n\r\n"


def dechunked(framed: bytes) -> bytes:
    """The body of chunked framing; chunk extensions and trailers are skipped. Raises ValueError if it is cut short."""
    out, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            raise ValueError("no chunk size")
        n = int(framed[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if n == 0:
            return b"".join(out)
        if framed[at + n : at + n + 2] != b"\r\n":
            raise ValueError("a chunk ends early")
        out.append(framed[at : at + n])
        at += n + 2


def with_digests(pages: DataFrame, least: int = 1000, broadcast_rows: int = 500_000) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, refers_to and refers_to_url (null for responses)."""
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), F.octet_length(raw).cast("long").alias("payload_bytes"), F.sha1(raw).alias("payload_digest"))
    large = rows.filter(F.col("payload_bytes") >= least).select("page_id", "url", F.unhex("payload_digest").alias("digest"))
    first = large.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("holder"), F.count("*").alias("n")).filter("n > 1").select("digest", "holder")
    first = materialize(first, "warc-repeated")
    few = first.count() <= broadcast_rows  # some hundred bytes a row
    again = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder.page_id"))
    joined = rows.join(F.broadcast(first) if few else first, (F.unhex("payload_digest") == first["digest"]) & (rows["payload_bytes"] >= least), "left")
    return joined.select(*rows.columns, F.when(again, F.col("holder.page_id")).alias("refers_to"), F.when(again, F.coalesce("holder.url", F.lit(""))).alias("refers_to_url"))


def _head(fields: list[tuple[str, object]], length: int) -> str:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {length}\r\n\r\n"


#: Fixed value: the profile of revisit records for equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def records_of(row: dict, date: str, segment_bytes: int, chunk_bytes: int) -> list[str]:
    """The records of one page as text, in order, without their ends."""

    def uri(x: str | None) -> str:
        return re.sub(r"[\r\n]+", " ", x or "")

    def own() -> list[tuple[str, object]]:
        return [("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", date), ("WARC-Target-URI", uri(row["url"]))]

    page = "" if row["page_id"] is None else row["page_id"]
    fields = [*own(), ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"), ("Content-Type", "application/http; msgtype=response"), ("X-Page-Id", page)]
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if row["refers_to"] is not None:
        target = [("WARC-Profile", PROFILE), ("WARC-Refers-To-Target-URI", uri(row["refers_to_url"])), ("X-Refers-To-Page-Id", row["refers_to"])]
        return [_head([("WARC-Type", "revisit"), *fields, *target], len(http)) + http]
    block = http.encode() + chunked(row["html"].encode(), chunk_bytes)
    if len(block) <= segment_bytes:
        return [_head([("WARC-Type", "response"), *fields], len(block)) + block.decode()]
    out = []
    pieces = list(slices(block, segment_bytes))
    for number, piece in enumerate(pieces, 1):
        kind = [("WARC-Type", "response"), *fields] if number == 1 else [("WARC-Type", "continuation"), *own(), ("WARC-Segment-Origin-ID", fields[0][1])]
        total = ("WARC-Segment-Total-Length", len(block) if number == len(pieces) else None)
        out.append(_head([*kind, ("WARC-Segment-Number", number), total], len(piece)) + piece.decode())
    return out


def write_archives(pages: DataFrame, path: str, least: int = 1000, segment_bytes: int = 16_384, chunk_bytes: int = 4096, records_per_file: int = 20_000, date: str | None = None) -> None:
    """Write gzip-compressed archives of all ``pages`` (page_id, url, html) into the folder ``path``; ``date`` is now by default."""
    small_batches(pages.sparkSession)
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            for row in batch.to_pylist():
                out += records_of(row, date, segment_bytes, chunk_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    records = with_digests(pages, least).drop("payload_bytes").mapInArrow(build, "value string")
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _plain(content: bytes) -> bytes:
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:  # members may follow each other
        d = zlib.decompressobj(31)
        out.append(d.decompress(content) + d.flush())
        content = d.unused_data
    return b"".join(out)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record, found by its Content-Length. Raises ValueError on a broken record."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        fields = {k.decode().lower(): v.decode("utf-8", "surrogateescape") for k, v in _FIELDS.findall(data[at : end + 2])}
        n = int(fields["content-length"])
        block = data[end + 4 : end + 4 + n]
        if len(block) < n or data[end + 4 + n : end + 8 + n] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut short")
        yield fields, block
        at = end + 8 + n


def hex_digest(field: str | None) -> str | None:
    """The SHA-1 of a digest field in lower-case hexadecimal, from that or base32; null for other algorithms and malformed values."""
    name, _, value = (field or "").partition(":")
    value = value.strip()
    if name.strip().lower().replace("-", "") != "sha1":
        return None
    if re.fullmatch(r"[0-9A-Fa-f]{40}", value):
        return value.lower()
    if re.fullmatch(r"[A-Za-z2-7]{32}", value):
        return base64.b32decode(value.upper()).hex()
    return None


_RECORD = "kind string, page_id long, uri string, origin string, segment int, total long, digest string, refers_to long, block binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives below ``path``; ``origin`` is the identifier of a record's first segment."""
    small_batches(spark)

    def number(x: str | None) -> int | None:
        return int(x) if x and re.fullmatch(r"-?\d+", x) else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _RECORD.split(", ")]
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                held = 0
                for f, block in parse_archive(_plain(content.as_py())):
                    get = f.get
                    rows.append(
                        (
                            get("warc-type"), number(get("x-page-id")), get("warc-target-uri"), get("warc-segment-origin-id") or get("warc-record-id"), number(get("warc-segment-number")),
                            number(get("warc-segment-total-length")), hex_digest(get("warc-payload-digest")), number(get("x-refers-to-page-id")), block,
                        )
                    )
                    held += len(block)
                    if len(rows) >= 1000 or held > 4_000_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, _RECORD)


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP response block; chunked framing is decoded where the header names it."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if re.search(rb"^transfer-encoding:[ \t]*chunked\r?$", head, re.I | re.M) else body


KINDS = ("response", "resource", "conversion", "revisit")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per captured page: page_id, record_type, uri, refers_to, payload (of all but revisits), payload_digest, error.

    ``error`` names a total length, segment order or digest that doesn't hold; it is null for sound records. Records that hold no
    page (requests, metadata and so on) are left out; a continuation without its first segment is an error.
    """
    records = read_records(spark, path)
    single = records.filter(F.col("segment").isNull() & F.col("kind").isin(*KINDS)).select("kind", "page_id", "uri", "digest", "refers_to", F.col("block").alias("whole"), F.lit(None).cast("string").alias("error"))
    piece = F.struct("segment", "kind", "total", "block", "page_id", "uri", "digest", "refers_to")
    group = records.filter(F.col("segment").isNotNull()).groupBy("origin").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    total = F.array_max(F.transform("pieces", lambda p: p["total"]))
    whole = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["block"]))
    order = F.exists(F.transform("pieces", lambda p, i: p["segment"] != i + 1), lambda x: x)
    error = F.when(F.col("bad"), "a segment is missing").when(~F.octet_length("whole").cast("long").eqNullSafe(F.col("total")), "the total length is wrong")
    joined = group.select(F.col("pieces")[0].alias("first"), whole.alias("whole"), total.alias("total"), order.alias("bad")).select(*[f"first.{c}" for c in ("kind", "page_id", "uri", "digest", "refers_to")], "whole", error.alias("error"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payload, digests, errors = [], [], []
            for kind, digest, whole, wrong in zip(*[batch.column(i).to_pylist() for i in (0, 3, 5, 6)], strict=True):
                body = None
                if kind != "revisit" and wrong is None:
                    try:
                        body = payload_of(whole) if kind == "response" else whole
                        found = hashlib.sha1(body).hexdigest()
                        wrong = None if digest in (None, found) else "the digest is wrong"
                        digest = digest or found
                    except ValueError as e:
                        wrong = str(e)
                payload.append(body)
                digests.append(digest)
                errors.append(wrong)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), batch.column(2), batch.column(4), pa.array(payload, pa.binary()), pa.array(digests, pa.string()), pa.array(errors, pa.string())], names=["page_id", "record_type", "uri", "refers_to", "payload", "payload_digest", "error"])

    schema = "page_id long, record_type string, uri string, refers_to long, payload binary, payload_digest string, error string"
    return single.unionByName(joined).mapInArrow(decode, schema)


def digests(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of pages as read; a revisit has the size of the response with its payload.

    Both sides of the join are a few numbers per record; the size comes from the payload that the response really held.
    """
    rows = pages.select("page_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("held"), F.coalesce(F.sha1("payload"), F.col("payload_digest")).alias("payload_digest"))
    rows = materialize(rows, "warc-digests")
    targets = rows.filter("record_type = 'response' and held >= 1").groupBy(F.col("page_id").alias("target"), F.col("payload_digest").alias("target_digest")).agg(F.max("held").alias("target_held"))
    wanted = rows.filter("refers_to is not null").select(F.col("refers_to").alias("target"), F.col("payload_digest").alias("target_digest")).distinct()
    joined = rows.join(targets.join(wanted, ["target", "target_digest"], "left_semi"), (rows["refers_to"] == F.col("target")) & (rows["payload_digest"] == F.col("target_digest")), "left")
    return joined.select("page_id", F.coalesce("held", "target_held").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
