"""WARC archives of Zstandard frames: writer with revisit records, and reader.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary, raw or itself compressed; an empty
one means no dictionary. Then comes one frame per record. The reader loads the dictionary, decodes frame by frame (memory
is bounded by one record) and checks version line, required headers, block length, trailer, HTTP length and digest.

Tasks write to the shared folder under names of their own attempt and move the file when it is complete; the manifest (a
written table) lists the files of the attempts that counted, so retries leave no doubles.

Defined results: a null payload is an empty one; payloads under `MIN_REVISIT` bytes are never revisits; of equal payloads
those with the smallest page_id are responses (also if that row is repeated), rows without page_id revisit it, and where no
row has an id all are responses; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlight.session import shared_dir, ship, stored

DICT_MAGIC = 0x184D2A5D
DICT_BYTES = 32 << 10
#: Payload bytes of the sample from which a partition's dictionary is trained.
SAMPLE_BYTES = 2 << 20
#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 1 << 30
MIN_REVISIT = 100
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
MANIFEST = "path string, records long, bytes long"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, length: int, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127))).replace("%", "")))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict | None:
    """Row of a response or revisit record, None for other types; raises ValueError where the record is not valid."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    if absent := [h for h in REQUIRED if h.lower() not in headers]:
        raise ValueError(f"missing headers {absent}")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, Content-Length {length}")
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    if not gap or "Content-Length" not in fields:
        raise ValueError("no HTTP headers in the block")
    size = int(fields["Content-Length"])
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("payload does not agree with its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in headers):
        raise ValueError("revisit with a payload or without its original")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "page_id": number("x-page-id"),
        "url": unquote(headers["warc-target-uri"]) if "warc-target-uri" in headers else None,
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number("x-refers-to-page-id"),
        "payload": payload if kind == "response" else None,
    }


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the samples; None where they are too few or too small for one."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples) if len(samples) >= 8 else None
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Writes one archive; it appears under its name only when closed."""

    def __init__(self, folder: str, name: str, dictionary: zstandard.ZstdCompressionDict | None, date: str) -> None:
        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(root, recursive=True)
        self.path, self.uri = f"{root}/{name}", f"{folder}/{name}"
        self.out = self.fs.open_output_stream(self.path + ".part", compression=None)
        self.frames = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True, write_content_size=True)
        raw = dictionary.as_bytes() if dictionary else b""
        self.out.write(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)
        self.bytes, self.records = 8 + len(raw), 0
        info = b"software: harborlight\r\nformat: WARC File Format 1.1\r\n"
        head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id(None, name)}\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
        self._frame(head.encode() + info + b"\r\n\r\n")

    def _frame(self, record: bytes) -> None:
        frame = self.frames.compress(record)
        self.out.write(frame)
        self.bytes += len(frame)

    def add(self, record: bytes) -> None:
        self._frame(record)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        self.fs.move(self.path + ".part", self.path)
        return self.uri, self.records, self.bytes


def read_archive(uri: str) -> Iterator[bytes]:
    """The decoded records of an archive, one per frame."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_stream(path, compression=None) as source:
        head = source.read(8)
        if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICT_MAGIC:
            raise ValueError(f"{uri}: no dictionary frame at the start")
        size = struct.unpack("<I", head[4:])[0]
        raw = source.read(size)
        if len(raw) != size:
            raise ValueError(f"{uri}: dictionary is cut off")
        if raw[:4] == b"\x28\xb5\x2f\xfd":
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        pending = b""
        while True:
            if not pending:
                pending = source.read(READ_BYTES)
                if not pending:
                    return
            frame, parts = decoder.decompressobj(), []
            while True:
                parts.append(frame.decompress(pending))
                if frame.eof:
                    pending = frame.unused_data
                    break
                pending = source.read(READ_BYTES)
                if not pending:
                    raise ValueError(f"{uri}: last frame is cut off")
            yield b"".join(parts)


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, digest, refers_to, revisit for each page.

    Only payload hashes are grouped; groups of one never reach the join.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("payload_bytes", F.length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    groups = rows.filter(F.col("payload_bytes") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = stored(groups.filter("n > 1 and first is not null").select("digest", "first"), "equal-payloads")
    joined = rows.join(groups, "digest", "left")
    revisit = F.col("first").isNotNull() & F.coalesce(F.col("page_id") != F.col("first"), F.lit(True))
    return joined.select("page_id", "url", "payload", "payload_bytes", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(records: DataFrame, folder: str | None = None, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write planned records to archives in a shared folder; the manifest: path, records, bytes of each archive."""
    ship(records.sparkSession)
    target = folder or f"{shared_dir(records.sparkSession)}/harborlight/warc-{uuid.uuid4().hex}"
    if "://" not in target and not target.startswith("file:"):
        target = "file://" + target
    elif target.startswith("file:/") and not target.startswith("file://"):
        target = "file://" + target.removeprefix("file:")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, held, size, dictionary = None, [], 0, None
        done = []

        def put(row: dict) -> None:
            nonlocal writer
            if writer is None:
                writer = ArchiveWriter(target, f"{uuid.uuid4().hex}.warc.zst", dictionary, date)
            writer.add(build_record(row["page_id"], row["url"], b"" if row["revisit"] else row["payload"], row["payload_bytes"], row["digest"], row["refers_to"], row["revisit"], date))
            if writer.bytes >= archive_bytes:
                done.append(writer.close())
                writer = None

        sampling = True
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                row = {n: c[i].as_py() for n, c in zip(batch.schema.names, columns, strict=True)}
                if sampling:
                    held.append(row)
                    size += row["payload_bytes"]
                    if size < SAMPLE_BYTES:
                        continue
                    sampling, dictionary = False, train([r["payload"] for r in held if not r["revisit"]])
                    for r in held:
                        put(r)
                    held = []
                else:
                    put(row)
        if sampling and held:
            dictionary = train([r["payload"] for r in held if not r["revisit"]])
        for r in held:
            put(r)
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], ["path", "records", "bytes"])

    return stored(records.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The response and revisit records of the archives that the manifest lists."""
    ship(manifest.sparkSession)
    names = [c.split(" ")[0] for c in RECORD.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in RECORD.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, size = [], 0
                for raw in read_archive(uri):
                    row = parse_record(raw)
                    if row is None:
                        continue
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    size += len(row["payload"] or b"") + 200
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = manifest.select("path").repartition(tasks, "path").mapInArrow(read, RECORD)
    return out if with_payload else out.select(*[n for n in names if n != "payload"])
