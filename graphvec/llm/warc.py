"""WARC records in seekable Zstandard bundles.

A task streams its records into bundles: frames of about FRAME_BYTES are compressed on their
own, and a seek table in a skippable frame ends the file, so standard Zstandard tools read the
bundle as a whole and a reader with the table reads one frame.  The index maps each record to
its bundle, its frame and its offset inside the decompressed frame.

Equal payloads (by SHA-1) of at least `min_bytes` are stored once: the record with the smallest
page_id is a response, the others are revisits that refer to it.

A bundle gets its name when it is complete, and only bundles named in the written index count,
so a task that runs twice leaves a stray file and no wrong result.  Files go through the
filesystem of the given URI; names that Spark uses for stores (s3a, s3n, wasb, wasbs, dbfs) are
put as Arrow has them, and for any other store pass `opened_by`, which gives a filesystem and a path in it for a URI.

Edge cases: a null html is an empty payload; rows with a null page_id are always responses;
rows that repeat the smallest page_id with the same payload are all responses; a null url is
written as an empty one; an empty table gives an empty index and no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphvec.storage import materialize, new_path

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 28
FRAMES_A_TASK = 64
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

Opener = Callable[[str], tuple[pa.fs.FileSystem, str]]

INDEX = "page_id bigint, record_id string, bundle string, frame int, offset int, length int"
RECORD = "page_id bigint, record_id string, record_type string, url string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def arrow_uri(uri: str) -> str:
    """The URI by which Arrow reaches what Spark names so."""
    scheme, rest = urlsplit(uri).scheme, uri.partition(":")[2]
    if scheme in ("s3a", "s3n"):
        return "s3:" + rest
    if scheme in ("wasb", "wasbs"):  # container@account.blob..., the same account's other address
        return "abfss:" + rest.replace(".blob.", ".dfs.", 1)
    if scheme == "dbfs":
        return "file:///dbfs/" + rest.lstrip("/")
    return uri if scheme else "file://" + uri


def filesystem_of(uri: str) -> tuple[pa.fs.FileSystem, str]:
    try:
        return pa.fs.FileSystem.from_uri(arrow_uri(uri))
    except (pa.ArrowInvalid, NotImplementedError) as e:
        raise ValueError(f"no filesystem for {uri}: pass opened_by") from e


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:page:{page_id}" if page_id is not None else f"urn:page:null:{digest}"


def page_of(name: str) -> int | None:
    tail = name.removeprefix("urn:page:")
    return None if tail.startswith("null:") else int(tail)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[str, bytes]:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    name = record_id(page_id, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = "".join(c if c.isprintable() else quote(c, safe="", errors="replace") for c in url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{record_id(refers_to, digest)}>"]
    head += [f"Content-Length: {len(block)}", "", ""]
    return name, "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at `at`, and where the next one starts."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    size = int(head["Content-Length"])
    block = data[end + 4 : end + 4 + size]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    name, kind = head["WARC-Record-ID"].strip("<>"), head["WARC-Type"]
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        got = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (got, len(payload)) != (digest, length):
            raise ValueError(f"payload of {name} does not match its digest")
    refers = page_of(head["WARC-Refers-To"].strip("<>")) if "WARC-Refers-To" in head else None
    return {"page_id": page_of(name), "record_id": name, "record_type": kind, "url": head.get("WARC-Target-URI", ""), "payload_bytes": length,
            "payload_digest": digest, "refers_to": refers, "payload": payload if kind == "response" else None}, end + 8 + size


class BundleWriter:
    """One seekable bundle: records in, (record, frame, offset, length) out."""

    def __init__(self, fs: pa.fs.FileSystem, path: str, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.fs, self.path, self.frame_bytes = fs, path, frame_bytes
        self.out = fs.open_output_stream(path + ".part", compression=None)
        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = self.total = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        place = len(self.frames), self.size, len(record)
        self.held.append(record)
        self.size += len(record)
        if self.size >= self.frame_bytes:
            self.flush()
        return place

    def flush(self) -> None:
        if self.held:
            frame = self.compress(b"".join(self.held))
            self.out.write(frame)
            self.frames.append((len(frame), self.size))
            self.total += len(frame)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *x) for x in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        self.fs.move(self.path + ".part", self.path)


def seek_table(f: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, from a bundle's footer."""
    end = f.size()
    f.seek(end - 9)
    count, descriptor, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC or descriptor:
        raise ValueError("no seek table at the end of the bundle")
    f.seek(end - 9 - 8 * count)
    raw, at, out = f.read(8 * count), 0, []
    for k in range(count):
        packed, size = struct.unpack_from("<II", raw, 8 * k)
        out.append((at, packed, size))
        at += packed
    return out


def _frame(f: pa.NativeFile, at: int, packed: int, size: int) -> bytes:
    f.seek(at)
    return zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=size)


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to): the page whose equal payload is stored instead."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    first = p.where((F.octet_length("html") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("sha").agg(F.min("page_id").alias("first"))
    return p.join(first, "sha", "left").select("page_id", "url", "html", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"))


def write_bundles(pages: DataFrame, to: str | None = None, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
                  opened_by: Opener = filesystem_of) -> DataFrame:
    """Write a record for each row of `pages` into bundles under the URI `to` (by default a
    new folder of the shared one) and return the index, itself a written table."""
    to = to or new_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened_by(to)
        fs.create_dir(root, recursive=True)
        writer, name = None, ""
        for b in batches:
            rows = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(fs, f"{root}/{name}", frame_bytes)
                record, data = build_record(page_id, url, html.encode("utf-8", "surrogatepass"), refers_to)
                rows.append((page_id, record, f"{to}/{name}", *writer.add(data)))
                if writer.total >= bundle_bytes:
                    writer.close()
                    writer = None
            cols = list(zip(*rows)) or [()] * 6
            types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["page_id", "record_id", "bundle", "frame", "offset", "length"])
        if writer is not None:
            writer.close()

    return materialize(mark_revisits(pages, min_bytes).mapInArrow(run, INDEX), "warc-index")


def _opened(uri: str, opened_by: Opener) -> pa.NativeFile:
    fs, path = opened_by(uri)
    return fs.open_input_file(path)


def _records(rows: list[dict]) -> pa.RecordBatch:
    types = {"page_id": pa.int64(), "record_id": pa.string(), "record_type": pa.string(), "url": pa.string(), "payload_bytes": pa.int64(),
             "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in types.items()], names=list(types))


def frames(bundles: DataFrame, opened_by: Opener = filesystem_of) -> DataFrame:
    """(bundle, at, packed, size) of every frame of the given bundles, from their footers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                with _opened(uri, opened_by) as f:
                    table = seek_table(f)
                cols = list(zip(*table)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array([uri] * len(table), pa.string()), *(pa.array(c, pa.int64()) for c in cols)], names=["bundle", "at", "packed", "size"])

    return bundles.select("bundle").distinct().mapInArrow(run, "bundle string, at bigint, packed bigint, size bigint")


def read_bundles(bundles: DataFrame, opened_by: Opener = filesystem_of) -> DataFrame:
    """Every record of the bundles named in column bundle, read frame by frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, at, packed, size in zip(*(c.to_pylist() for c in b.columns)):
                with _opened(uri, opened_by) as f:
                    data = _frame(f, at, packed, size)
                rows, place = [], 0
                while place < len(data):
                    row, place = parse_record(data, place)
                    rows.append(row)
                yield _records(rows)

    found = materialize(frames(bundles, opened_by), "frames")
    # a row is small and what it names is not: a fixed number keeps the tasks from being merged
    tasks = max(1, -(-found.count() // FRAMES_A_TASK))
    return found.repartition(tasks, "bundle", "at").mapInArrow(run, RECORD)


def fetch(index: DataFrame, wanted: DataFrame, opened_by: Opener = filesystem_of) -> DataFrame:
    """The records of `wanted` (record_id) by random access: only their frames are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None, b"")
        for b in batches:
            rows = []
            for uri, k, offset in zip(*(c.to_pylist() for c in b.columns)):
                if held[:2] != (uri, k):
                    with _opened(uri, opened_by) as f:
                        held = uri, k, _frame(f, *seek_table(f)[k])
                rows.append(parse_record(held[2], offset)[0])
            yield _records(rows)

    found = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi").select("bundle", "frame", "offset")
    return found.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame").mapInArrow(run, RECORD)
