"""WARC records in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding whole records, and a last skippable frame with the
seek table. The index maps record identifiers to (bundle, frame, offset in the frame), so one record costs one ranged
read and one frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_dir, open_fs, read_range, small_batches

# Fixed values of the seekable format: skippable frame, seek table footer, flag for checksums.
SKIPPABLE, FOOTER, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
FRAME_BYTES, FRAME_RECORDS, BUNDLE_BYTES = 1 << 20, 256, 64 << 20
INDEX = "page_id long, record_id string, bundle string, frame int, frame_start long, frame_bytes long, start int, length int"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A WARC/1.1 response record with its HTTP block, or a revisit record without payload."""
    payload = (html or "").encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the payload behind the HTTP head."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = data[end + 4 : end + 4 + int(fields["content-length"])]
    if len(data) != end + 8 + len(block) or data[-4:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} is cut")
    return fields, block[block.index(b"\r\n\r\n") + 4 :]


class Bundle:
    """Writes one bundle under an attempt's own name and renames it when whole."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
        self.fs, self.path = open_fs(self.uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.out = self.fs.open_output_stream(self.path + ".tmp")
        self.zstd = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.at, self.pending, self.size = 0, [], 0

    def add(self, page_id: int | None, data: bytes) -> Iterator[tuple]:
        if self.pending and (self.size + len(data) > FRAME_BYTES or len(self.pending) == FRAME_RECORDS):
            yield from self.flush()
        self.pending.append((page_id, data))
        self.size += len(data)

    def flush(self) -> Iterator[tuple]:
        """Ends the frame; gives its index rows."""
        if not self.pending:
            return
        raw = b"".join(d for _, d in self.pending)
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        at = 0
        for page_id, data in self.pending:
            yield page_id, record_id(page_id), self.uri, len(self.frames), self.at, len(packed), at, len(data)
            at += len(data)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.at += len(packed)
        self.pending, self.size = [], 0

    def close(self) -> Iterator[tuple]:
        yield from self.flush()
        body = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUMS, FOOTER)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()
        self.fs.move(self.path + ".tmp", self.path)


def seek_table(uri: str) -> list[tuple[int, int, int, int]]:
    """(start, packed bytes, raw bytes, checksum) of each frame, from the end of the bundle alone."""
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        n, flags, magic = struct.unpack("<IBI", f.read_at(9, f.size() - 9))
        if magic != FOOTER or flags != CHECKSUMS:
            raise ValueError(f"{uri} has no seek table")
        body = f.read_at(12 * n, f.size() - 9 - 12 * n)
    out, at = [], 0
    for packed, raw, check in struct.iter_unpack("<III", body):
        out.append((at, packed, raw, check))
        at += packed
    return out


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages whose payload another page holds as response; narrow rows only."""
    narrow = pages.select("page_id", F.sha1("html").alias("digest"), F.octet_length("html").alias("n")).filter(F.col("n") >= min_bytes)
    shared = narrow.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return narrow.join(shared, ["digest", "n"]).filter("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Index rows of the bundles that this plan writes below ``folder`` when it runs; write the rows down once.

    ``pages(page_id, url, html)``: null html is an empty payload, a null url leaves the header out. Of pages with equal
    payloads of at least ``min_bytes``, those with the largest page_id are responses (a repeated row is one as well),
    the others revisits. A null page_id is never a revisit's target. Extra columns are ignored.
    """
    small_batches(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    marked = pages.withColumn("digest", F.sha1("html")).join(revisits(pages, min_bytes), ["page_id", "digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, rows = None, []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bundle is None:
                    bundle = Bundle(folder)
                rows += bundle.add(page_id, record(page_id, url, html, refers_to, refers_to is not None, date))
                if bundle.at >= BUNDLE_BYTES:
                    rows += bundle.close()
                    bundle = None
        if bundle is not None:
            rows += bundle.close()
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in INDEX.split(", ")])

    return marked.select("page_id", "url", "html", "refers_to").mapInArrow(run, INDEX)


def read_warc(index: DataFrame) -> DataFrame:
    """Reads the records that ``index`` names: a frame is one ranged read, whichever records of it are wanted.

    Gives ``page_id, record_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` (null for
    revisits, whose payload is that of refers_to). Digests of responses are computed again and compared.
    """
    frames = index.groupBy("bundle", "frame", "frame_start", "frame_bytes").agg(F.collect_list(F.struct("start", "length")).alias("records"))
    small_batches(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for x in batch.to_pylist():
                raw = unzip.decompress(read_range(x["bundle"], x["frame_start"], x["frame_bytes"]))
                rows = []
                for r in x["records"]:
                    fields, payload = parse(raw[r["start"] : r["start"] + r["length"]])
                    claimed, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
                    if kind == "response" and (digest(payload) != claimed or len(payload) != int(fields["x-payload-length"])):
                        raise ValueError(f"payload of {fields['warc-record-id']} is not what its digest says")
                    number = lambda k, f=fields: int(f[k]) if k in f else None
                    rows.append((number("x-page-id"), fields["warc-record-id"], fields.get("warc-target-uri"), number("x-payload-length"), claimed, kind, number("x-refers-to-page"), payload if kind == "response" else None))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "record_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    return frames.mapInArrow(run, "page_id long, record_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the bundles and their index into the shared folder; returns the index that was written."""
    spark, folder = pages.sparkSession, fresh_dir(pages.sparkSession, "warc")
    write_warc(pages, folder, min_bytes).write.parquet(f"{folder}/index.parquet")
    return spark.read.parquet(f"{folder}/index.parquet")


def op6(spark, sf_dir: str) -> DataFrame:
    return read_warc(archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB has no base32: the digest's 40 hex digits are eight groups of 20 bits, four letters each.
ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (SELECT hex, max(page_id) AS top FROM p GROUP BY hex
), b AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, 5 * k + 1, 5))::BIGINT >> (15 - 5 * j)) & 31)::INT + 1, 1), '' ORDER BY k, j) AS digest
  FROM g CROSS JOIN range(8) a(k) CROSS JOIN range(4) c(j) GROUP BY hex
)
SELECT page_id, payload_bytes, digest AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM p JOIN g USING (hex) JOIN b USING (hex)
"""
