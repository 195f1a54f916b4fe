"""WARC archives: one gzip member per record, written by Spark and read by byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmart.llm.common import stored

MAGIC = b"\x1f\x8b\x08"
#: Uncompressed bytes from which the last byte of a gzip member may not be zero.
_LONG = 1 << 24
_CRLF = b"\r\n"


def gzip_member(data: bytes) -> bytes:
    """One gzip member whose last byte is zero.

    It is the highest byte of the length; a record of 16 MB or more is followed by an empty
    member, which readers skip.
    """
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    if len(data) < _LONG:
        return out
    empty = zlib.compressobj(6, zlib.DEFLATED, 31)
    return out + empty.compress(b"") + empty.flush()


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """A WARC record: a response with its payload, or a revisit that only names it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + payload if kind == "response" else http

    def urn(page) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"

    clean = "".join(c if c.isprintable() and not c.isspace() else f"%{ord(c):02X}" for c in url or "urn:none")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {urn(page_id)}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {clean}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {urn(refers_to)}")
        head.append(f"X-Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(head).encode() + _CRLF * 2 + body + _CRLF * 2


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of an uncompressed record."""
    head, _, rest = data.partition(_CRLF * 2)
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return headers, rest[: int(headers.get("content-length", len(rest)))]


def _members(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                out = []
                for page, url, html, keeper in zip(*(part.column(k).to_pylist() for k in ("page_id", "url", "html", "keeper")), strict=True):
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    revisit = keeper is not None and page != keeper and len(payload) >= least
                    kind = "revisit" if revisit else "response"
                    out.append(gzip_member(record_bytes(page, url, payload, base32_sha1(payload), kind, keeper))[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return run


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """Write one record per row of pages (page_id, url, html) into gzip archives at path.

    The payload is the html in UTF-8; a null one is empty. Of rows with equal payloads of at least
    `least` bytes, that with the largest page_id is a response and the others are revisits of it; rows
    that share the largest page_id are all responses, and so are rows without any page_id.

    Payloads are compared by SHA-1, from ids and digests alone; pages are joined by id. Spark's
    text writer commits the files; it ends each row with a line separator, here the zero byte that
    every member ends with.
    """
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    sha = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    digests = stored(pages.select("page_id", sha.alias("sha")), "digests")
    keepers = digests.groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count("*").alias("rows"))
    keepers = stored(keepers.where("rows > 1 AND keeper IS NOT NULL").select("sha", "keeper"), "keepers")
    owners = digests.join(keepers, "sha").select(F.col("page_id").alias("page"), F.col("sha").alias("page_sha"), "keeper").distinct()
    owners = stored(owners, "owners")
    same = F.col("page_id").eqNullSafe(F.col("page")) & (F.col("sha") == F.col("page_sha"))
    marked = pages.withColumn("sha", sha).join(owners, same, "left").select("page_id", "url", "html", "keeper")
    members = marked.mapInArrow(_members(least), "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.mode("errorifexists").option("lineSep", "\u0000").option("compression", "none").text(path)


class _Open:
    """A member that is being decoded; chunks are added until it ends."""

    def __init__(self, chunk: bytes):
        self.packed, self.out, self.done, self.bad = [], [], False, False
        self.decoder = zlib.decompressobj(31)
        self.feed(MAGIC + chunk)

    def feed(self, data: bytes) -> None:
        self.packed.append(data)
        try:
            self.out.append(self.decoder.decompress(data))
            self.done = self.decoder.eof
        except zlib.error:
            self.bad = True


def starts_record(chunk: bytes) -> bool:
    """Whether bytes after a magic begin a member whose content begins like a WARC record.

    A member without content, which may follow a long one, also counts.
    """
    decoder = zlib.decompressobj(31)
    try:
        head = decoder.decompress(MAGIC + chunk, 8)
    except zlib.error:
        return False
    return head.startswith(b"WARC/1.") or (not head and decoder.eof)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the chunks of one byte range, and the loose ends that another range completes.

    Chunks lie between gzip magics. One that does not begin a record continues the member before it:
    its magic was chance. Chunks before the first record of a range, and a last
    member without end, leave as loose ends with their place.
    """
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("record", pa.binary()), ("loose", pa.binary())])
    current, here, at = None, None, 0
    rows: list[tuple] = []

    def close():
        nonlocal current
        if current is None:
            return
        data = b"".join(current.out)
        if current.done and not current.bad:
            if data:
                rows.append((*here, at, data, None))
        else:
            rows.append((*here, at, None, b"".join(current.packed)))
        current = None

    for batch in batches:
        for file, block, chunk in zip(*(batch.column(k).to_pylist() for k in ("file", "block", "chunk")), strict=True):
            if (file, block) != here:
                close()
                here, at = (file, block), 0
                lead = block == 0  # what stands before the first magic of a file is no member
            at += 1
            if lead:
                lead = False
                if not chunk:
                    continue
            if starts_record(chunk):
                close()
                current = _Open(chunk)
            elif current is not None and not current.done:
                current.feed(MAGIC + chunk)
            elif current is None:
                rows.append((*here, at, None, MAGIC + chunk))
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
            rows = []
    close()
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the loose ends of each file, in order of place, into members."""
    current, file = None, None
    for batch in batches:
        out = []
        for name, loose in zip(batch.column("file").to_pylist(), batch.column("loose").to_pylist(), strict=True):
            if name != file:
                current, file = None, name
            if starts_record(loose[len(MAGIC) :]):
                current = _Open(loose[len(MAGIC) :])
            elif current is not None:
                current.feed(loose)
            if current is not None and current.done and not current.bad:
                out.append(b"".join(current.out))
                current = None
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of gzip archives (record: uncompressed bytes), in any order.

    Spark's text reader splits files into byte ranges and cuts them at the gzip magic, given as the
    line separator; a range owns the chunks that start inside it. Each chunk counts as a
    member only if it decodes to a WARC header; others belong to the member before. A member that a
    chance magic cuts right at the border of two ranges is put together from both. Damaged
    members, and what is not gzip, give no record.
    """
    lines = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    chunks = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("chunk"),
    )
    kinds = "file string, block long, at long, record binary, loose binary"
    found = stored(chunks.mapInArrow(_scan, kinds), "records")
    loose = found.where("loose IS NOT NULL").select("file", "block", "at", "loose")
    loose = loose.repartition("file").sortWithinPartitions("file", "block", "at")
    return found.where("record IS NOT NULL").select("record").unionByName(loose.mapInArrow(_stitched, "record binary"))


def describe(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of archived pages.

    A response's length and digest are taken from its payload, a revisit's from its headers.
    """
    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            rows = []
            for data in batch.column("record"):
                headers, block = parse_record(data.as_py())
                kind, page, other = headers["warc-type"], headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                payload = block.partition(_CRLF * 2)[2]
                size, digest = len(payload), base32_sha1(payload)
                if kind == "revisit":
                    size, digest = int(headers["x-payload-length"]), headers["warc-payload-digest"].removeprefix("sha1:")
                values = (None if page is None else int(page), size, digest, kind, None if other is None else int(other))
                rows.append(dict(zip(schema.names, values, strict=True)))
            yield pa.RecordBatch.from_pylist(rows, schema)

    return records.mapInArrow(run, kinds)
