"""WARC archives: a writer with revisit records, and a reader that salvages what a damaged file still holds."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder, stage

#: Every record carries one date, so that reruns write equal files.
DATE = "2000-01-01T00:00:00Z"
RECORDS_PER_FILE = 4000
#: A gzip member ends with its length; for fewer bytes than this the last byte is zero.
SHORT = 1 << 24
FIRST_LINE = b"WARC/1."
GZIP = b"\x1f\x8b\x08"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> bytes:
    """One record without the two line ends that close it. A revisit keeps the HTTP head and leaves out the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if revisit:
        head.append(f"WARC-Refers-To: {record_id(first)}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    else:
        block += payload
    head += [f"WARC-Block-Digest: sha1:{digest_of(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block


def gzip_member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(
    pages: DataFrame, folder: str | None = None, *, min_bytes: int = 0, compress: bool = True, level: int = 2,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> str:
    """Write a WARC record for each page and return the folder (a new one in the shared folder by default).

    Of pages with equal payloads of ``min_bytes`` or more, the one with the largest id is written as a response, the
    others as revisits of it. Repeated rows of that id are responses too. A NULL payload is empty; a NULL id is
    written as ``null``, is smaller than any other, and among equal payloads without an id all are responses. URLs are
    written as they are, but for white space, and left out when NULL. Other columns are ignored.

    Only digests with several pages are gathered (one row each); the join to the pages sees their staged size, so
    payloads are shuffled only where there are too many such digests to broadcast, and then AQE splits a hot one.
    Files are written by Spark's own committer: the separator between rows is what closes a record (plain: the two
    line ends; gzip: the last byte of a member, which is zero), so a lost task leaves nothing behind.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(html_col), F.lit(""))
    slim = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), body.alias("html"),
        F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).alias("bytes"),
    )
    shared = stage(slim.filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1"), "warc-equal")
    joined = slim.join(shared.drop("n"), "digest", "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull() & (F.col("bytes") >= min_bytes), F.lit(False))
    rows = joined.select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("first"), revisit.alias("revisit"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, out = batch.slice(at, 500).to_pylist(), []
                for r in part:
                    data = record_bytes(r["page_id"], r["url"], r["html"].encode(), r["first"], r["revisit"])
                    if compress:
                        data += b"\r\n\r\n"
                        member = gzip_member(data, level)
                        if len(data) >= SHORT:  # an empty member, so that the file still ends in a zero byte
                            member += gzip_member(b"", level)
                        data = member[:-1]
                    out.append(data)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    path = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    encoded = rows.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value"))
    encoded.write.option("lineSep", "\x00" if compress else "\r\n\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    return path


def parse_record(data: memoryview, at: int, end: int) -> tuple[int, dict[str, str], bytes] | str:
    """The record that begins at ``at``: where it ends, its headers and its block; or why there is none."""
    raw = data.obj
    if raw[at:at + len(FIRST_LINE)] != FIRST_LINE:
        return "no version line"
    stop = raw.find(b"\r\n\r\n", at, end)
    if stop < 0:
        return "header does not end"
    lines = raw[at:stop].split(b"\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "bad header line"
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return "no content length"
    begin = stop + 4
    close = begin + int(length)
    if close + 4 > end:
        return "block is cut off"
    if raw[close:close + 4] != b"\r\n\r\n":
        return "record does not close"
    block = raw[begin:close]
    told = headers.get("warc-block-digest", "")
    if told.startswith("sha1:") and told[5:] != digest_of(block):
        return "block digest differs"
    told = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and told.startswith("sha1:") and told[5:] != digest_of(payload_of(block)):
        return "payload digest differs"
    return close + 4, headers, block


def payload_of(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block


def unpack(raw: bytes, at: int) -> tuple[int, bytes] | str:
    """The gzip member that begins at ``at``: where it ends and what it holds, after its checksum."""
    unzip, out, pos = zlib.decompressobj(31), [], at
    view = memoryview(raw)
    try:
        while not unzip.eof:
            chunk = view[pos:pos + 65536]
            if not len(chunk):
                return "member is cut off"
            out.append(unzip.decompress(chunk))
            pos += len(chunk)
    except zlib.error as error:
        return f"bad member: {error}"
    return pos - len(unzip.unused_data), b"".join(out)


def record_at(raw: bytes, at: int) -> tuple[int, dict[str, str] | None, bytes] | str:
    """A plain record, a member that holds exactly one record, or an empty member (without headers)."""
    if raw[at:at + 3] != GZIP:
        return parse_record(memoryview(raw), at, len(raw))
    member = unpack(raw, at)
    if isinstance(member, str):
        return member
    end, inner = member
    if not inner:
        return end, None, b""
    found = parse_record(memoryview(inner), 0, len(inner))
    if isinstance(found, str):
        return found
    return (end, *found[1:]) if found[0] == len(inner) else "member holds more than a record"


def next_start(raw: bytes, at: int) -> int:
    """The next place where a member or a version line may begin, or the end of the file."""
    found = [p for p in (raw.find(GZIP, at), raw.find(FIRST_LINE, at)) if p >= 0]
    return min(found, default=len(raw))


def salvage(raw: bytes) -> Iterator[tuple[int, int, str | None, dict[str, str] | None, bytes]]:
    """All valid records of a file as (offset, length, None, headers, block), and between them the gaps as (offset,
    length, reason, None, b""). After a failed check the search goes on at the next start that passes all checks, so a
    damaged record costs its own bytes only; the reason is that of the first failure in the gap."""
    at, gap, why = 0, None, ""
    while at < len(raw):
        found = record_at(raw, at)
        if isinstance(found, str):
            if gap is None:
                gap, why = at, found
            at = next_start(raw, at + 1)
            continue
        if gap is not None:
            yield gap, at - gap, why, None, b""
            gap = None
        end, headers, block = found
        if headers is not None:
            yield at, end - at, None, headers, block
        at = end
    if gap is not None:
        yield gap, len(raw) - gap, why, None, b""


READ = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap_reason", pa.string()),
    ("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to_id", pa.string()),
    ("payload_digest", pa.string()), ("http_length", pa.int64()), ("payload", pa.binary()),
])
READ_DDL = (
    "file string, offset long, length long, gap_reason string, warc_type string, record_id string, target_uri string, "
    "refers_to_id string, payload_digest string, http_length long, payload binary"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record and every quarantined gap of the archives under ``path``, plain or gzip by record.

    Rows with a ``gap_reason`` are gaps: bytes of the file (offset, length) that no valid record covers; the other
    columns describe valid records. The two together cover each file, but for empty members. A file is read as a
    whole by one task (Spark's binary files hold up to 2 GB; the writer here makes files of ``RECORDS_PER_FILE``
    records). Empty files give no rows.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, raw = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows, held = [], 0
                for offset, length, why, headers, block in salvage(raw):
                    row = {"file": name, "offset": offset, "length": length, "gap_reason": why}
                    if headers is not None:
                        payload = payload_of(block)
                        http = [x for x in block[:block.find(b"\r\n\r\n")].split(b"\r\n") if x.lower().startswith(b"content-length:")]
                        row |= {
                            "warc_type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"),
                            "target_uri": headers.get("warc-target-uri"), "refers_to_id": headers.get("warc-refers-to"),
                            "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                            "http_length": int(http[0].split(b":")[1]) if http else None, "payload": payload,
                        }
                        held += len(payload)
                    rows.append(row)
                    if held > 1 << 22 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, READ)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, READ)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(decode, READ_DDL)


def records(read: DataFrame) -> DataFrame:
    """Valid records by page: (page_id, payload_bytes, payload_digest, record_type, refers_to, payload). The length of
    a revisit's payload comes from the HTTP head it kept."""
    page = lambda c: F.regexp_extract(F.coalesce(F.col(c), F.lit("")), r"<urn:page:(-?\d+)>", 1).try_cast("long")
    revisit = F.col("warc_type") == "revisit"
    return read.filter("gap_reason IS NULL").select(
        page("record_id").alias("page_id"),
        F.when(revisit, F.col("http_length")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        "payload_digest", F.col("warc_type").alias("record_type"),
        F.when(revisit, page("refers_to_id")).alias("refers_to"), "payload",
    )
