"""Zstandard WARC archives: writing with a dictionary in a leading skippable frame, reading back.

An archive is a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary,
plain or itself compressed, and then one frame per record. The reader loads the
dictionary, takes the frames one at a time from a stream, and checks each record: version
line, header syntax, Content-Length against the block, the HTTP head, the payload's
SHA-1 against WARC-Payload-Digest, and that nothing follows the two closing line ends.

Equal payloads of at least ``least_bytes``: the record with the smallest page_id is the
response, others revisit it.

Each task of the writer streams its rows into files of its own name below a shared
folder and returns a manifest row per file. The manifest is a Parquet table, so only
files of tasks that committed are in it; a lost executor leaves an unlisted file behind.
The dictionary is trained on the first records of a file, at most ``SAMPLE_RECORDS`` and
``SAMPLE_BYTES`` of them. The reader's tasks take one file each.

Defined cases: null html is an empty payload; a null url is ``urn:page:`` and the page's
id, and control characters in urls are percent-coded; a null page_id is larger than any
other, its record is read back with null; if several rows have the smallest page_id of
their payload they are all responses; other columns are not read; an empty table makes no
archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_BYTES = 16 << 10
SAMPLE_RECORDS, SAMPLE_BYTES = 128, 1 << 20
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 18
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


class ArchiveError(ValueError):
    """The archive or a record in it breaks the format."""


def _name(page_id: int | None) -> str:
    return f"<urn:page:{uuid.uuid4() if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(m[1]) if m else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisits: int | None) -> bytes:
    """The bytes of a response record, or of a revisit of page ``revisits``."""
    uri = f"urn:page:{page_id}" if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if revisits is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if revisits is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {uri}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if revisits is not None:
        head[2:2] = [f"WARC-Refers-To: {_name(revisits)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!-9;-~]+", name):
            raise ArchiveError(f"bad header line {line[:80]!r}")
        out[name.decode().lower()] = value.strip().decode()
    return out


def parse_record(raw: bytes) -> dict:
    """The checked fields of one record."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise ArchiveError("no WARC version line")
    fields = _headers(lines[1:])
    kind = fields.get("warc-type")
    missing = [k for k in ("warc-record-id", "content-length", "warc-date") if k not in fields]
    if missing or kind not in ("response", "revisit"):
        raise ArchiveError(f"missing {missing or 'record type'}")
    length = int(fields["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"Content-Length {length} doesn't fit a block of {len(rest) - 4}")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    status = http.split(b"\r\n")
    if not gap or not status[0].startswith(b"HTTP/"):
        raise ArchiveError("no HTTP head")
    size = int(_headers(status[1:]).get("content-length", len(payload)))
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if size != len(payload) or digest != payload_digest(payload):
            raise ArchiveError("payload length or digest differ")
    elif payload or fields.get("warc-profile") != PROFILE:
        raise ArchiveError("a revisit has no payload and names its profile")
    return {
        "page_id": _number(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _number(fields.get("warc-refers-to")),
        "payload": payload,
    }


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train(samples: list[bytes]) -> bytes:
    """A dictionary of the samples, or nothing if they are too few or too alike for one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def frames(stream) -> Iterator[bytes]:
    """The records of an archive, one frame each."""
    head = stream.read(8)
    dictionary, rest = None, head
    if int.from_bytes(head[:4], "little") == DICTIONARY_MAGIC:
        size = int.from_bytes(head[4:8], "little")
        raw = stream.read(size)
        if len(raw) != size:
            raise ArchiveError("the dictionary is cut off")
        if raw[:4] == FRAME_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary, rest = zstandard.ZstdCompressionDict(raw), b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        frame, parts = reader.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as e:
                raise ArchiveError(str(e)) from e
            if frame.eof:
                rest = frame.unused_data
                break
            rest = stream.read(READ_BYTES)
            if not rest:
                raise ArchiveError("the last frame is cut off")
        yield b"".join(parts)


def _files(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


class _Archive:
    """One file: buffers records until its dictionary is trained, then streams frames."""

    def __init__(self, folder: str) -> None:
        store, base = _files(folder)
        store.create_dir(base, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = store.open_output_stream(f"{base}/{self.name}", compression=None)
        self.path = f"{folder}/{self.name}"
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.records = self.bytes = 0
        self.compressor: zstandard.ZstdCompressor | None = None

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def _begin(self) -> None:
        raw = train(self.waiting)
        if raw:
            self._write(DICTIONARY_MAGIC.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw)
        dictionary = zstandard.ZstdCompressionDict(raw) if raw else None
        if dictionary:
            dictionary.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        for r in self.waiting:
            self._write(self.compressor.compress(r))
        self.waiting = []

    def add(self, raw: bytes) -> None:
        self.records += 1
        if self.compressor:
            self._write(self.compressor.compress(raw))
            return
        self.waiting.append(raw)
        self.waiting_bytes += len(raw)
        if len(self.waiting) >= SAMPLE_RECORDS or self.waiting_bytes >= SAMPLE_BYTES:
            self._begin()

    def close(self) -> tuple[str, int, int]:
        if not self.compressor:
            self._begin()
        self.out.close()
        return self.path, self.records, self.bytes


def _write_task(folder: str, archive_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "sha1", "refers_to")]
            for page_id, url, html, sha1, refers in zip(*columns, strict=True):
                archive = archive or _Archive(folder)
                payload = (html.as_py() or "").encode()
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                archive.add(record(page_id.as_py(), url.as_py(), payload, digest, refers.as_py()))
                if archive.bytes >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["path", "records", "bytes"],
        )

    return run


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record per page (page_id, url, html) below ``folder``; returns the manifest."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(html).alias("sha1"))
    large = rows.where(F.octet_length(html) >= least_bytes)
    first = (
        large.groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null")
        .select("sha1", "first_id")
    )
    first.write.parquet(f"{folder}/repeats")
    first = spark.read.schema(first.schema).parquet(f"{folder}/repeats")
    others = F.octet_length(html) >= least_bytes
    refers = F.when(others & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    marked = rows.join(first, "sha1", "left").withColumn("refers_to", refers)
    made = marked.select("page_id", "url", "html", "sha1", "refers_to").mapInArrow(
        _write_task(f"{folder}/archives", archive_bytes), MANIFEST
    )
    made.write.parquet(f"{folder}/manifest")
    return spark.read.schema(made.schema).parquet(f"{folder}/manifest")


def _read_task(payload: bool) -> Callable:
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                store, place = _files(path)
                found, rows, held = 0, [], 0
                with store.open_input_stream(place, compression=None) as stream:
                    for raw in frames(stream):
                        row = parse_record(raw)
                        held += len(row["payload"]) if payload else 0
                        if not payload:
                            row["payload"] = None
                        rows.append(row)
                        found += 1
                        if len(rows) >= 4096 or held >= 1 << 24:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                if found != expected:
                    raise ArchiveError(f"{path}: {found} records, {expected} were written")

    return run


def read_archives(manifest: DataFrame, payload: bool = False) -> DataFrame:
    """The records of all archives; ``payload`` adds the bytes of responses."""
    files = manifest.repartition(max(1, manifest.count()))
    return files.mapInArrow(_read_task(payload), RECORDS)


def archive_round_trip(spark: SparkSession, pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives and read them back."""
    return read_archives(write_archives(pages, folder, least_bytes)).drop("payload")
