"""WARC archives in Zstandard: writing pages, and reading archives back record by record.

An archive begins with a skippable frame that holds a dictionary, trained by the writing task
on its own first pages; every record is one frame after it. Of pages with equal payloads, one
is written as a response, the others as revisits of it. Files are written by the tasks
into a shared folder; a table of the files of successful tasks is written with Spark, and only
those are read, so files of failed attempts do no harm. Reading streams frame by frame.

A record is checked on reading: version line, needed headers, content length against the block,
closing line ends, length and SHA-1 of the payload. A fault raises an error that names the
archive and the place, or, with ``strict=False``, is returned in the column ``fault``.

Cases: a null page is an empty payload; a null url is left out. Revisits are found by SHA-1 and length.
Rows that repeat the largest id of a payload are all responses; a null id is never referred to. An
empty table writes no archive and reads as no record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runatlas.llm.scratch import Scratch, let_workers_import, plain_columns

REVISIT_FROM = 1000  # bytes of payload from which equal payloads are stored once
ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 16 << 10
TRAINING_BYTES = 1 << 20  # pages of a task that its dictionary is trained on, at most
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
READ_BYTES = 64 << 10
READ_TASKS = 20_000

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


class Fault(ValueError):
    """A record or archive that does not keep to the format."""


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, head: int | None) -> bytes:
    """One record; ``head`` is the page that a revisit refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if head is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if head is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if url:
        lines.append("WARC-Target-URI: " + "".join(url.split()))
    if head is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{head}>"]
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; of few or tiny samples, their bytes themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b" ")


class ArchiveWriter:
    """Writes records of one task, starting a new archive at ``ARCHIVE_BYTES``."""

    def __init__(self, folder: str, dictionary: bytes):
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.dictionary = dictionary
        kept = zstandard.ZstdCompressionDict(dictionary)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=kept, write_content_size=True)
        self.out, self.done = None, []

    def write(self, record: bytes) -> None:
        if self.out is None:
            self.store.create_dir(self.path, recursive=True)
            self.name, self.size, self.records = f"{uuid.uuid4().hex}.warc.zst", 0, 0
            self.out = self.store.open_output_stream(f"{self.path}/{self.name}", compression=None)
            self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(self.dictionary)) + self.dictionary)
        frame = self.compressor.compress(record)
        self.out.write(frame)
        self.size += len(frame)
        self.records += 1
        if self.size >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append((self.name, self.records))


def _write(folder: str):
    def run(batches):
        writer, waiting, size = None, [], 0
        for batch in batches:
            for page_id, url, html, digest, head in zip(*[batch.column(c).to_pylist() for c in batch.schema.names], strict=True):
                record = record_bytes(page_id, url, (html or "").encode("utf-8"), digest, head)
                if writer is not None:
                    writer.write(record)
                    continue
                waiting.append(record)
                size += len(record)
                if size >= TRAINING_BYTES:
                    writer = ArchiveWriter(folder, train_dictionary(waiting))
                    for held in waiting:
                        writer.write(held)
                    waiting = []
        if waiting:
            writer = ArchiveWriter(folder, train_dictionary(waiting))
            for held in waiting:
                writer.write(held)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "archive": pa.array([f"{folder}/{name}" for name, _ in writer.done], pa.string()),
                    "records": pa.array([n for _, n in writer.done], pa.int64()),
                }
            )

    return run


def with_heads(pages: DataFrame, scratch: Scratch, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Add ``digest`` and ``head``: the page that the row is a revisit of, or null."""
    pages = pages.withColumn("html", F.coalesce("html", F.lit(""))).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = pages.filter(F.octet_length("html") >= revisit_from)
    heads = large.groupBy("digest").agg(F.max("page_id").alias("head"), F.count("*").alias("pages"))
    # Written first: the join then has an exchange of its own on either side, which can be split where a payload is frequent.
    heads = scratch.save(heads.filter("pages > 1 and head is not null").select("digest", "head"), "heads")
    head = F.when(~F.col("page_id").eqNullSafe(F.col("head")), F.col("head"))
    return pages.join(heads, "digest", "left").select("page_id", "url", "html", "digest", head.alias("head"))


def write_archives(pages: DataFrame, scratch: Scratch, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write ``pages(page_id, url, html)``; the table of the archives written, ``(archive, records)``."""
    folder = scratch.path("archives")
    written = with_heads(pages, scratch, revisit_from).mapInArrow(_write(folder), "archive string, records long")
    return scratch.save(written, "manifest")


def frames(stream) -> Iterator[bytes]:
    """The content of each frame after the dictionary frame of an archive."""
    held = stream.read(READ_BYTES)
    if len(held) < 8:
        raise Fault("the archive is shorter than a frame header")
    magic, length = struct.unpack("<II", held[:8])
    kept = None
    if magic == DICTIONARY_MAGIC:
        while len(held) < 8 + length and (more := stream.read(READ_BYTES)):
            held += more
        if len(held) < 8 + length:
            raise Fault("the dictionary frame is cut off")
        dictionary, held = held[8 : 8 + length], held[8 + length :]
        if dictionary[:4] == struct.pack("<I", FRAME_MAGIC):
            dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
        kept = zstandard.ZstdCompressionDict(dictionary)
    elif magic != FRAME_MAGIC:
        raise Fault("the archive does not begin with a Zstandard frame")
    decompressor = zstandard.ZstdDecompressor(dict_data=kept)
    while held or (held := stream.read(READ_BYTES)):
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not held and not (held := stream.read(READ_BYTES)):
                raise Fault("the last frame is cut off")
            parts.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def _headers(lines: list[str]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise Fault(f"a header line without a colon: {line[:60]!r}")
        out[name.strip()] = value.strip()
    return out


def _page(reference: str) -> int | None:
    number = reference.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_record(data: bytes) -> dict:
    """The checked fields of one record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise Fault("no WARC version line")
    headers = _headers(lines[1:])
    if missing := [h for h in REQUIRED if h not in headers]:
        raise Fault(f"headers missing: {', '.join(missing)}")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise Fault(f"the block has {len(rest) - 4} bytes, its header says {length}")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    if not gap:
        raise Fault("no end of the HTTP headers")
    full = int(_headers(http.decode("utf-8").split("\r\n")[1:])["Content-Length"])
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = headers["WARC-Type"]
    if kind == "response":
        if len(payload) != full:
            raise Fault(f"the payload has {len(payload)} bytes, its header says {full}")
        if hashlib.sha1(payload).hexdigest() != digest:
            raise Fault("the payload does not have the digest of its header")
    elif kind != "revisit" or "WARC-Refers-To" not in headers or payload:
        raise Fault(f"a record of type {kind!r} that refers to nothing, or has a payload")
    return {
        "page_id": _page(headers["WARC-Record-ID"]),
        "url": headers.get("WARC-Target-URI"),
        "payload_bytes": full,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(headers["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


FIELDS = {
    "page_id": pa.int64(),
    "url": pa.string(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
    "payload": pa.binary(),
    "fault": pa.string(),
}
SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, fault string"


def read_archives(archives: DataFrame, tasks: int, strict: bool = True, payloads: bool = True) -> DataFrame:
    """Every record of the archives named in ``archive``."""
    let_workers_import(archives.sparkSession)

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({c: pa.array([r.get(c) for r in rows], t) for c, t in FIELDS.items()})

    def read(path: str) -> Iterator[dict]:
        store, name = fs.FileSystem.from_uri(path)
        try:
            with store.open_input_stream(name, compression=None) as stream:
                for n, data in enumerate(frames(stream)):
                    try:
                        row = parse_record(data)
                    except (Fault, KeyError, ValueError) as error:
                        raise Fault(f"record {n}: {error}") from error
                    yield row if payloads else row | {"payload": None}
        except (Fault, zstandard.ZstdError) as error:
            if strict:
                raise Fault(f"{path}, {error}") from error
            yield {"fault": f"{path}, {error}"}

    def run(batches):
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                rows, size = [], 0
                for row in read(path):
                    rows.append(row)
                    size += 500 + len(row.get("payload") or b"")
                    if size > 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    dealt = archives.select("archive").repartitionByRange(max(1, min(tasks, READ_TASKS)), "archive")
    return dealt.mapInArrow(run, SCHEMA)


def round_trip(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Write all pages as archives and read them back, without the payloads themselves."""
    scratch = Scratch(pages.sparkSession, "warc")
    pages = plain_columns(pages, page_id=id_column, url=url_column, html=html_column).withColumn("page_id", F.col("page_id").cast("long"))
    manifest = write_archives(pages, scratch)
    records = read_archives(manifest, manifest.count(), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
