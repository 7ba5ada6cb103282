"""WARC archives: writing pages, and reading that goes on after damage.

Writing: pages with equal payloads are found by digest; the one with the smallest id is written as
a response, the others as revisits that refer to it. Every record is a gzip member of its own (or plain
text). They are parted by an empty member; an archive is a row that Spark's text writer puts out as a file, so the
archives go through Spark's commit protocol to any store Spark can write to, and a task that is run
again leaves nothing half written.

Reading: an archive is read member by member (or record by record). Checks are the member's own
sum, the version line, the header fields, the length of the block, the end of the record and, where
given, the digests of block and payload. Where a check fails, the reader looks for the next place
that starts a valid member or a version line of a valid record, goes on from there, and reports the
bytes in between as a gap with the reason. Nothing is lost without a gap that covers it.

An archive is one row of Spark's binary reader, so it has to fit in a task's memory. The writer counts what it
puts into an archive and starts a new one once ``FILE_BYTES`` are reached, so none is larger by more than one record.

Defined results: null html is an empty payload; payloads under 100 bytes are always responses; of
equal payloads all rows with the smallest id are responses, rows without an id are revisits unless
no row has one; a null or odd url is written as a placeholder or percent-encoded; an empty table
gives no archive and an empty result; columns of any other name are not written.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import lookup, table
from tidegrid.session import materialise, work_path

#: Payloads shorter than this are not looked for in other records (fixed by the contract).
LEAST_REVISIT = 100
#: Bytes of records, before compression, at which an archive is full.
FILE_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
#: What parts two members: a member without content.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
END = b"\r\n\r\n"
#: Compressed bytes tried at first at a place that may start a member.
TASTE = 256


def record(kind: str, page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A record without the empty lines that end it. Revisits keep the HTTP header only."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if kind == "revisit" else http + payload
    target = quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else f"urn:page:{_name(page)}"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{_name(page)}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{_name(refers_to)}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block


def _name(page: int | None) -> str:
    return "" if page is None else str(page)



def write_pages(pages: DataFrame, path: str, compressed: bool = True) -> None:
    """``pages`` (``page_id``, ``url``, ``html``) as WARC archives in the folder ``path``."""
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2("html", 256))
    equal = materialise(
        rows.filter(F.octet_length("html") >= LEAST_REVISIT).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1"), "equal-payloads"
    )
    marked = lookup(rows, equal, "digest", F.col("n")).withColumn(
        "revisit", F.expr("n IS NOT NULL AND first_id IS NOT NULL AND NOT page_id <=> first_id")
    )

    between = EMPTY_MEMBER if compressed else END

    def archive(members: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([between.join(members)], pa.binary())], names=["value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, size = [], 0
        for batch in batches:
            for row in zip(*[batch.column(c) for c in ("page_id", "url", "html", "digest", "first_id", "revisit")], strict=True):
                page, url, html, digest, first, revisit = (v.as_py() for v in row)
                plain = record("revisit" if revisit else "response", page, url, html.encode("utf-8", "surrogatepass"), digest, first)
                members.append(gzip.compress(plain + END, 6, mtime=0) if compressed else plain)
                size += len(plain)
                if size >= FILE_BYTES:
                    yield archive(members)
                    members, size = [], 0
        if members:
            yield archive(members)

    (
        marked.select("page_id", "url", "html", "digest", "first_id", "revisit").mapInArrow(run, "value binary")
        # the cast keeps the bytes as they are, and so does the writer
        .select(F.col("value").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1").option("lineSep", between.decode("latin-1"))
        .option("maxRecordsPerFile", 1).text(path)
    )


@dataclass
class Found:
    """A record, or with a reason a gap, at a byte offset of an archive.

    Within a gzip member of several records ``offset`` and ``length`` are the member's.
    """

    offset: int
    length: int
    reason: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    @property
    def payload(self) -> bytes | None:
        """What follows the HTTP header; the whole block if it is not an HTTP message."""
        if self.headers.get("warc-type") == "revisit":
            return None
        if "application/http" in self.headers.get("content-type", ""):
            return self.block.partition(END)[2]
        return self.block

    @property
    def payload_length(self) -> int | None:
        """Bytes of the payload; for a revisit those that its HTTP header tells."""
        if self.payload is not None:
            return len(self.payload)
        for line in self.block.partition(END)[0].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                return int(value)
        return None


class Broken(Exception):
    pass


def _digest_differs(declared: str | None, data: bytes) -> bool:
    """Whether a declared digest of a known kind, in hex or base32, is not that of ``data``."""
    kind, _, value = (declared or "").partition(":")
    if kind.lower().replace("-", "") not in ("sha1", "sha256", "md5"):
        return False
    own = hashlib.new(kind.lower().replace("-", ""), data)
    base32 = base64.b32encode(own.digest()).decode().rstrip("=")
    return value.lower() != own.hexdigest() and value.upper().rstrip("=") != base32


def parse_record(data: bytes, at: int) -> tuple[Found, int]:
    """The record whose version line is at ``at``, and where the next starts; ``Broken`` if a check fails."""
    if not data.startswith(VERSION, at):
        raise Broken("no version line")
    stop = data.find(END, at)
    if stop < 0:
        raise Broken("header without end")
    lines = data[at:stop].split(b"\r\n")
    headers: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (b" ", b"\t") and name:
            headers[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        key, colon, value = line.partition(b":")
        if not colon:
            raise Broken("header line without colon")
        name = key.strip().lower().decode("utf-8", "replace")
        headers[name] = value.strip().decode("utf-8", "replace")
    for needed in NEEDED:
        if needed not in headers:
            raise Broken(f"header without {needed}")
    if not headers["content-length"].isdigit():
        raise Broken("content-length is no number")
    begin = stop + len(END)
    end = begin + int(headers["content-length"])
    if end > len(data):
        raise Broken("block shorter than content-length")
    if data[end : end + len(END)] != END:
        raise Broken("no end of record after the block")
    found = Found(at, end + len(END) - at, None, headers, data[begin:end])
    if _digest_differs(headers.get("warc-block-digest"), found.block):
        raise Broken("block digest differs")
    payload = found.payload
    if payload is not None and "warc-truncated" not in headers and _digest_differs(headers.get("warc-payload-digest"), payload):
        raise Broken("payload digest differs")
    return found, end + len(END)


def inflate(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """Content of the member at ``at``, where it ends, and what is wrong with it."""
    stream = zlib.decompressobj(31)
    out, place = [], at
    try:
        while not stream.eof:
            piece = data[place : place + (1 << 16)]
            if not piece:
                return b"".join(out), len(data), "member without end"
            out.append(stream.decompress(piece))
            place += len(piece)
    except zlib.error as error:
        return _before_damage(data, at, place), place, f"member damaged: {error}"
    return b"".join(out), place - len(stream.unused_data), None


def _before_damage(data: bytes, at: int, place: int) -> bytes:
    """All content of the member at ``at`` up to the damage, which is in the piece at ``place``."""
    stream = zlib.decompressobj(31)
    out = [stream.decompress(data[at:place])]
    for step in (1 << 12, 1 << 8, 1 << 4, 1):
        while place < len(data):
            ahead = stream.copy()
            try:
                out.append(ahead.decompress(data[place : place + step]))
            except zlib.error:
                break
            stream, place = ahead, place + step
    return b"".join(out)


def _may_start(data: bytes, at: int) -> bool:
    """Whether a member at ``at`` starts with a version line or is empty."""
    stream = zlib.decompressobj(31)
    head = b""
    try:
        # the member's own header may be longer than a taste
        while len(head) < len(VERSION) and not stream.eof and at < len(data):
            head += stream.decompress(data[at : at + TASTE], len(VERSION) - len(head))
            at += TASTE
    except zlib.error:
        return False
    return head.startswith(VERSION) or (stream.eof and not head)


def _valid_at(data: bytes, at: int) -> bool:
    """Whether a member with a valid record, or a valid plain record, starts at ``at``."""
    if data.startswith(GZIP, at):
        if not _may_start(data, at):
            return False
        content, _, wrong = inflate(data, at)
        if wrong:
            return False
        if not content:
            return True
        data, at = content, 0
    try:
        parse_record(data, at)
    except Broken:
        return False
    return True


def _next_valid(data: bytes, start: int) -> int:
    """The next place from ``start`` on where reading can go on; the end if there is none.

    After a cut a version line need not stand at the start of a line.
    """
    member, line = data.find(GZIP, start), data.find(VERSION, start)
    while member >= 0 or line >= 0:
        if member >= 0 and (line < 0 or member < line):
            if _valid_at(data, member):
                return member
            member = data.find(GZIP, member + 1)
        else:
            if _valid_at(data, line):
                return line
            line = data.find(VERSION, line + 1)
    return len(data)


def salvage(data: bytes) -> Iterator[Found]:
    """Records and gaps of an archive in order; together with empty members they cover all its bytes."""
    at = 0
    while at < len(data):
        if data.startswith(GZIP, at):
            content, end, wrong = inflate(data, at)
            if wrong is None:
                for inner in salvage(content) if not content.startswith(GZIP) else ():
                    yield Found(at, end - at, inner.reason, inner.headers, inner.block)
                if content.startswith(GZIP):
                    yield Found(at, end - at, "member within a member")
                at = end
                continue
            # of a damaged member, records that prove themselves by a digest are still good
            for inner in salvage(content):
                if inner.reason is None and "warc-block-digest" in inner.headers:
                    yield Found(at, 0, None, inner.headers, inner.block)
        else:
            try:
                found, end = parse_record(data, at)
            except Broken as broken:
                wrong = str(broken)
            else:
                yield found
                at = end
                continue
        after = _next_valid(data, at + 1)
        yield Found(at, after - at, wrong)
        at = after


ROWS = (
    "file string, offset long, length long, gap_reason string, warc_type string, record_id string, target_uri string,"
    " warc_date string, refers_to string, payload_digest string, payload_length long, payload binary"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives under ``path``; a gap has a reason and nothing else but its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap_reason", pa.string()),
            ("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()),
            ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_length", pa.int64()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, held = [], 0
                for f in salvage(content.as_py()):
                    h = f.headers.get
                    gap = f.reason is not None
                    rows.append((
                        file.as_py(), f.offset, f.length, f.reason, h("warc-type"), h("warc-record-id"), h("warc-target-uri"),
                        h("warc-date"), h("warc-refers-to"), h("warc-payload-digest"),
                        None if gap else f.payload_length, None if gap else f.payload,
                    ))
                    held += len(f.block)
                    if held > FILE_BYTES // 4:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, ROWS)


def records(archives: DataFrame) -> DataFrame:
    return archives.filter("gap_reason IS NULL").drop("gap_reason")


def gaps(archives: DataFrame) -> DataFrame:
    """The quarantine log: where bytes were skipped, and why."""
    return archives.filter("gap_reason IS NOT NULL").select("file", "offset", "length", "gap_reason")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it comes back from the archives."""
    path = work_path(spark, "warc")
    write_pages(table(spark, sf_dir, "pages"), path)
    number = r"^<urn:page:(-?\d+)>$"
    return records(read_archives(spark, path)).select(
        F.expr(f"try_cast(nullif(regexp_extract(record_id, r'{number}', 1), '') AS bigint)").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.when(F.col("payload").isNotNull(), F.sha2("payload", 256))
        .otherwise(F.expr("substring(payload_digest, 8)")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.expr(f"try_cast(nullif(regexp_extract(refers_to, r'{number}', 1), '') AS bigint)").alias("refers_to"),
    )


OP2_SQL = f"""
    WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                      sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p),
    r AS (SELECT *, payload_bytes >= {LEAST_REVISIT} AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again FROM f)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN again THEN first_id END AS refers_to FROM r"""
