"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle is a run of
frames and a seek table in a skippable frame at its end (the public seekable
format), so any Zstandard reader can unpack it and one record costs one frame.
The index maps each record id to bundle, frame and place in the frame.

Equal payloads are stored once: per payload digest the record with the smallest
page_id is the response, the others revisit it (payloads under
``revisit_bytes`` are always stored). Bundles are written by executors straight
to the shared folder, under names that no other attempt uses; the stored index
names the bundles of the attempts that count, so a lost executor or a repeated
task leaves unused files at worst.

Defined results: NULL html is an empty payload; among equal payloads a NULL
page_id is the last choice; rows that repeat the response's page_id and payload
are responses too; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import byte_list, clean_text, original_id, ordinal, shared_folder, small_batches, stored

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 16 << 20
#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
INDEX = "ord long, bundle string, frame long, place long, size long"
RECORD = "ord long, record_type string, refers_ord long, payload_bytes long, payload_digest string, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def record(ord_: int, url: str | None, payload: bytes, sha1: str, refers: int | None) -> bytes:
    """One WARC/1.1 record; ``refers`` makes it a revisit without its payload."""
    body = b"" if refers is not None else payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {record_id(ord_)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{sha1}",
            f"X-Page-Ord: {ord_}", f"X-Payload-Length: {len(payload)}"]
    if refers is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers)}", f"X-Refers-To-Ord: {refers}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header, body and the end of the record at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    start = stop + 4
    end = start + int(head["Content-Length"])
    return head, data[start:end], end + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def frames_of(tail: bytes) -> list[tuple[int, int]]:
    """``(packed, unpacked)`` sizes from the end of a bundle."""
    count, _, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    return [struct.unpack_from("<II", tail, len(tail) - 9 - 8 * (count - i)) for i in range(count)]


class BundleWriter:
    """Collects records into frames; ``finish`` gives the bundle's bytes."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.frame_bytes, self.parts, self.frames, self.open, self.size = frame_bytes, [], [], [], 0
        self.packer = zstandard.ZstdCompressor(level=3)
        self.packed = 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """Frame number, place in the frame, size."""
        if self.size and self.size + len(data) > self.frame_bytes:
            self._close()
        place = (len(self.frames), self.size, len(data))
        self.open.append(data)
        self.size += len(data)
        return place

    def _close(self):
        part = self.packer.compress(b"".join(self.open))
        self.parts.append(part)
        self.frames.append((len(part), self.size))
        self.packed += len(part)
        self.open, self.size = [], 0

    def finish(self) -> bytes:
        if self.open:
            self._close()
        return b"".join(self.parts) + seek_table(self.frames)


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _uri(folder: str) -> str:
    return folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder


def write_bundles(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write ``ord, url, text, sha1, refers`` rows as bundles below ``folder``; returns the stored index."""
    folder = _uri(folder)

    def run(batches):
        system, base = _filesystem(folder)
        system.create_dir(base, recursive=True)

        def done(writer, places):
            name = f"{uuid.uuid4().hex}.warc.zst"
            with system.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(writer.finish())
            cols = list(zip(*places))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array([name] * len(places))] + [pa.array(c, pa.int64()) for c in cols[1:]],
                                              ["ord", "bundle", "frame", "place", "size"])

        writer, places = BundleWriter(frame_bytes), []
        for b in small_batches(batches):
            for o, url, payload, sha1, refers in zip(b.column("ord").to_pylist(), b.column("url").to_pylist(), byte_list(b.column("text")),
                                                     b.column("sha1").to_pylist(), b.column("refers").to_pylist()):
                places.append((o, *writer.add(record(o, url, payload, sha1, refers))))
                if writer.packed + writer.size >= bundle_bytes:
                    yield done(writer, places)
                    writer, places = BundleWriter(frame_bytes), []
        if places:
            yield done(writer, places)

    return stored(records.select("ord", "url", "text", "sha1", "refers").mapInArrow(run, INDEX), "index")


def read_bundles(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """All records of the bundles that ``index`` names, from the files."""
    def run(batches):
        for b in batches:
            for blob in byte_list(b.column("content")):
                at, frames = 0, frames_of(blob)
                unpack = zstandard.ZstdDecompressor()
                for packed, size in frames:
                    data, rows, p = unpack.decompress(blob[at:at + packed], max_output_size=size), [], 0
                    at += packed
                    while p < len(data):
                        head, body, p = parse(data, p)
                        refers = head.get("X-Refers-To-Ord")
                        rows.append((int(head["X-Page-Ord"]), head["WARC-Type"], int(refers) if refers else None,
                                     int(head["X-Payload-Length"]) if refers else len(body),
                                     head["WARC-Payload-Digest"].removeprefix("sha1:") if refers else digest(body), None if refers else body))
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()),
                         pa.array(cols[4]), pa.array(cols[5], pa.binary())],
                        ["ord", "record_type", "refers_ord", "payload_bytes", "payload_digest", "payload"])

    names = index.select("bundle").distinct()
    count = names.count()
    if not count:  # no file was written
        return spark.createDataFrame([], RECORD)
    files = (spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
             .option("pathGlobFilter", "*.warc.zst").load(folder)
             .select("content", F.substring_index("path", "/", -1).alias("bundle")))
    return files.join(F.broadcast(names) if count <= 10_000 else names, "bundle", "left_semi").select("content").mapInArrow(run, RECORD)


def read_record(folder: str, bundle: str, frame: int, place: int, size: int) -> tuple[dict[str, str], bytes]:
    """One record, unpacking only its frame."""
    system, base = _filesystem(_uri(folder))
    with system.open_input_file(f"{base}/{bundle}") as f:
        total = f.size()
        count = struct.unpack("<I", f.read_at(9, total - 9)[:4])[0]
        frames = frames_of(f.read_at(8 * count + 9, total - 8 * count - 9))
        packed = f.read_at(frames[frame][0], sum(x[0] for x in frames[:frame]))
    data = zstandard.ZstdDecompressor().decompress(packed, max_output_size=frames[frame][1])
    head, body, _ = parse(data[place:place + size])
    return head, body


def prepare(pages: DataFrame, revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows for ``write_bundles``: payload digest, and whom a repeated payload refers to."""
    def run(batches):
        for b in small_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column("ord"), b.column("url"), b.column("text"), pa.array([digest(p) for p in byte_list(b.column("text"))])],
                ["ord", "url", "text", "sha1"])

    rows = pages.select(ordinal(pages[id_col]).alias("ord"), pages[url_col].cast("string").alias("url"), clean_text(pages[html_col]).alias("text"))
    hashed = rows.mapInArrow(run, "ord long, url string, text string, sha1 string")
    first = (hashed.where(F.octet_length("text") >= revisit_bytes).groupBy("sha1")
             .agg(F.min("ord").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return (hashed.join(first, "sha1", "left")
            .withColumn("refers", F.when((F.octet_length("text") >= revisit_bytes) & (F.col("first") != F.col("ord")), F.col("first"))))


def archive(pages: DataFrame, folder: str | None = None, revisit_bytes: int = 0) -> tuple[str, DataFrame]:
    """Write all pages; returns the folder and the index."""
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc"
    return folder, write_bundles(prepare(pages, revisit_bytes), folder)


def as_contract(records: DataFrame) -> DataFrame:
    return records.select(original_id().alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          original_id("refers_ord").alias("refers_to"))
