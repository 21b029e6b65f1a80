"""WARC archives in seekable Zstandard bundles: written by tasks, read back, and entered at single records.

A bundle is a row of independent Zstandard frames, each holding some whole records, and a seek table in a
skippable frame at the end (the public seekable format). A reader takes the table from the file's last
bytes and can then decompress any frame alone. The index written beside the bundles maps each record
identifier to its bundle, frame and place inside the frame, so one record costs one frame.

Of pages with equal payloads of ``least`` bytes or more the one with the smallest id is a response, the
others are revisits that name it and hold no payload. Groups are counted by digest, partly in each task.
At most ``HOT`` groups can hold more than a ``HOT``-th of the repeated rows; those are broadcast, so that no
digest of a third of all pages meets in one task; the rest join by digest.

A task writes bundles of its own, named by attempt, in the shared folder; the index holds those of
finished attempts only, so files of lost executors are never read.

Defined results: a null payload counts as empty; a null id sorts after all others, an id that is null or
repeated stays as it is, and rows with the least id of their group are all responses; a null address gives
no address line; an empty table gives an index without rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soldscope.llm.common import groups_in_order, saved
from soldscope.session import checkpoint_root

# fixed values of the seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")  # frames, descriptor, magic
ENTRY = struct.Struct("<II")  # compressed and plain size of a frame
HEADER = struct.Struct("<II")  # skippable magic, size of what follows

# fixed values of the archive format
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = b"\r\n\r\n"

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
HOT = 1_000
INDEX_SCHEMA = "record_id string, bundle string, frame int, offset long, length long"
PAGE_SCHEMA = (
    "page_id long, record_id string, record_type string, url string, date string, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary"
)


# ---- frames and bundles -----------------------------------------------------------------------------


class BundleWriter:
    """Frames of whole records, then the seek table."""

    def __init__(self, out: BinaryIO, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.out, self.frame_bytes = out, frame_bytes
        self.coder = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.held = 0
        self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in it) of the record."""
        if self.held and self.held + len(record) > self.frame_bytes:
            self._flush()
        place = len(self.sizes), self.held
        self.open.append(record)
        self.held += len(record)
        return place

    def _flush(self) -> None:
        if not self.held:
            return
        frame = self.coder.compress(b"".join(self.open))
        self.out.write(frame)
        self.sizes.append((len(frame), self.held))
        self.written += len(frame)
        self.open, self.held = [], 0

    def close(self) -> None:
        self._flush()
        table = b"".join(ENTRY.pack(*s) for s in self.sizes) + FOOTER.pack(len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(HEADER.pack(SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class BundleReader:
    """Any frame of a bundle by its number."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        size = file.size()
        file.seek(size - FOOTER.size)
        frames, _, magic = FOOTER.unpack(file.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a seekable bundle")
        file.seek(size - FOOTER.size - frames * ENTRY.size)
        self.sizes = list(ENTRY.iter_unpack(file.read(frames * ENTRY.size)))
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        self.decoder = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        packed, plain = self.sizes[number]
        self.file.seek(self.starts[number])
        return self.decoder.decompress(self.file.read(packed), max_output_size=plain)


def file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a folder given by path or address."""
    if "://" in folder:
        return pa.fs.FileSystem.from_uri(folder)
    return pa.fs.LocalFileSystem(), folder.removeprefix("file:")


# ---- records ----------------------------------------------------------------------------------------


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}:{digest}"


def _address(url: str) -> str:
    return quote(url, safe="%!#$&'()*+,/:;=?@[]~")


def record(kind: str, page_id: int | None, url: str | None, date: str, size: int, digest: str, first: int | None, payload: bytes | None) -> bytes:
    """One response with its payload, or one revisit without."""
    block = HTTP_HEAD + (payload or b"")
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id(page_id, digest)}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Payload-Length", str(size)),
    ]
    if url is not None:
        lines.append(("WARC-Target-URI", _address(url)))
    if kind == "revisit":
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_id(first, digest)}>")]
    head = "".join(f"{name}: {value}\r\n" for name, value in lines).encode()
    return b"".join((VERSION, head, b"\r\n", block, END))


def parsed(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block and end of the record that starts at ``at``."""
    head = data.index(b"\r\n\r\n", at)
    if not data.startswith(VERSION, at):
        raise ValueError("no record starts here")
    fields = dict(line.split(": ", 1) for line in data[at + len(VERSION) : head].decode().split("\r\n"))
    start = head + 4
    end = start + int(fields["Content-Length"])
    if data[end : end + len(END)] != END:
        raise ValueError("record without an end")
    return fields, data[start:end], end + len(END)


def _page_of(identifier: str) -> int | None:
    page = identifier.strip("<>").split(":")[2]
    return int(page) if page else None


def page_row(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A row of ``PAGE_SCHEMA``; a response's payload must have the digest and size that its header names."""
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    kind = fields["WARC-Type"]
    payload = block.split(b"\r\n\r\n", 1)[1] if kind == "response" else None
    if payload is not None and (len(payload), base32_sha1(payload)) != (size, digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    url, first = fields.get("WARC-Target-URI"), fields.get("WARC-Refers-To")
    return (
        _page_of(fields["WARC-Record-ID"]),
        fields["WARC-Record-ID"].strip("<>"),
        kind,
        url,
        fields["WARC-Date"],
        size,
        digest,
        _page_of(first) if first else None,
        payload if with_payload else None,
    )


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- in Spark ---------------------------------------------------------------------------------------


def with_decisions(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """page_id, url, payload, size, sha1, kind and first (the id of the response of a revisit)."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload"), "key": F.sha2("payload", 256)})
    groups = saved(
        rows.where(F.col("size") >= least)
        .groupBy("key")
        .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("key", F.col("first.page_id").alias("first"), "n"),
        "payload-groups",
    )
    bound = (groups.agg(F.sum("n")).first()[0] or 0) // HOT
    named = lambda part, name: part.select(
        F.col("key").alias(f"{name}_key"), F.col("first").alias(f"{name}_first"), F.lit(True).alias(name)
    )
    hot = named(groups.where(F.col("n") > bound), "hot")
    cold = named(groups.where(F.col("n") <= bound), "cold")
    # fewer than HOT groups can each hold more than a HOT-th of all grouped rows
    met = rows.join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left")
    # rows of hot groups look for nothing, under keys of their own
    asked = F.when(F.col("hot").isNull(), F.col("key")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    met = met.withColumn("asked", asked).join(cold, F.col("asked") == F.col("cold_key"), "left")
    first = F.when(F.col("hot"), F.col("hot_first")).otherwise(F.col("cold_first"))
    revisit = (F.col("hot").isNotNull() | F.col("cold").isNotNull()) & ~F.col("page_id").eqNullSafe(first)
    return met.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "size",
        "sha1",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, first).alias("first"),
    )


def write_archive(
    pages: DataFrame,
    folder: str | None = None,
    least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    level: int = 3,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Writes the bundles and returns their index (record_id, bundle, frame, offset, length), written too.

    ``folder`` must be shared by all executors; without one, a new folder below the checkpoint folder.
    """
    folder = folder or f"{checkpoint_root(pages.sparkSession).rstrip('/')}/archive-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        writer, name, bundles = None, "", 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if writer is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{bundles:04d}.warc.zst"
                    writer = BundleWriter(fs.open_output_stream(f"{root}/{name}", compression=None), frame_bytes, level)
                    bundles += 1
                digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                made = record(row["kind"], row["page_id"], row["url"], date, row["size"], digest, row["first"], row["payload"])
                frame, offset = writer.add(made)
                rows.append((record_id(row["page_id"], digest), f"{folder}/{name}", frame, offset, len(made)))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            yield _batch(rows, INDEX_TYPES)
        if writer is not None:
            writer.close()

    decided = with_decisions(pages, least, id_col, url_col, payload_col)
    return saved(decided.mapInArrow(write, INDEX_SCHEMA), "archive-index")


INDEX_TYPES = {"record_id": pa.string(), "bundle": pa.string(), "frame": pa.int32(), "offset": pa.int64(), "length": pa.int64()}
PAGE_TYPES = {
    "page_id": pa.int64(),
    "record_id": pa.string(),
    "record_type": pa.string(),
    "url": pa.string(),
    "date": pa.string(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "refers_to": pa.int64(),
    "payload": pa.binary(),
}


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))


def _opened(bundle: str) -> BundleReader:
    fs, path = file_system(bundle)
    return BundleReader(fs.open_input_file(path))


def read_archive(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the bundles that an index names, checked against its digest."""
    bundles = saved(index.groupBy("bundle").agg(F.count(F.lit(1)).alias("records")), "bundles")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch["bundle"].to_pylist():
                reader = _opened(bundle)
                for number in range(len(reader.sizes)):
                    data, at, rows = reader.frame(number), 0, []
                    while at < len(data):
                        fields, block, at = parsed(data, at)
                        rows.append(page_row(fields, block, with_payload))
                    yield _batch(rows, PAGE_TYPES)

    # a bundle is much work and a short row, so their number, not their bytes, decides on the tasks
    tasks = max(1, bundles.count())
    return bundles.select("bundle").repartition(tasks).mapInArrow(read, PAGE_SCHEMA)


def fetch(index: DataFrame, record_ids: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the given identifiers (column ``record_id``); each frame is read once, by its place."""
    wanted = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    keys = ["bundle", "frame"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for group in groups_in_order(batches, keys):
            rows, at, data = [], None, b""
            for row in group.to_pylist():
                if row["bundle"] != name:
                    name, reader, at = row["bundle"], _opened(row["bundle"]), None
                if row["frame"] != at:
                    at = row["frame"]
                    data = reader.frame(at)
                fields, block, end = parsed(data, row["offset"])
                if end - row["offset"] != row["length"]:
                    raise ValueError("index and bundle differ")
                rows.append(page_row(fields, block, with_payload))
            yield _batch(rows, PAGE_TYPES)

    dealt = wanted.repartition(*keys).sortWithinPartitions(*keys, "offset")
    return dealt.mapInArrow(read, PAGE_SCHEMA)
