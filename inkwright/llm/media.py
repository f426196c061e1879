"""Media columns: texts as 8-bit images in archives, read back by a data source.

A text's UTF-8 bytes, padded with bytes 0 to a positive multiple of 64, are the
samples of a greyscale PNG of width 64; the unpadded size is kept in a chunk of
its own.  Images lie as stored members in ZIP archives.

The data source ``archive_members`` plans byte ranges over all archives of a
folder from their sizes alone.  Each task reads its archive's central directory,
takes the members whose headers begin in its range and streams them in Arrow
batches.  A member whose bytes can't be read or fail their CRC-32 is read again
from its offset with a new handle; others are not.  One that keeps failing gives
a row with its error and no payload.

Null texts count as empty: 64 bytes 0.  Repeated rows are members of their own;
equal texts give equal bytes; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from inkwright.llm import workspace, words as W

WIDTH = 64
PNG = b"\x89PNG\r\n\x1a\n"
RANGE_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
ATTEMPTS = 4
LOCAL_HEADER = "<4s5H3I2H"


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(raw: bytes) -> bytes:
    rows = max(1, -(-len(raw) // WIDTH))
    lines = np.zeros((rows, WIDTH + 1), np.uint8)  # each line begins with its filter, 0
    padded = raw + bytes(rows * WIDTH - len(raw))
    lines[:, 1:] = np.frombuffer(padded, np.uint8).reshape(rows, WIDTH)
    return PNG + _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, rows, 8, 0, 0, 0, 0)) + _chunk(b"nbYt", struct.pack(">Q", len(raw))) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def from_png(png: bytes) -> tuple[int, np.ndarray]:
    """(unpadded bytes, samples) of an image that to_png made."""
    if png[:8] != PNG:
        raise ValueError("not a PNG")
    at, size, data = 8, -1, []
    while at < len(png):
        n, kind = struct.unpack_from(">I4s", png, at)
        body = png[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", png, at + 8 + n)[0] != zlib.crc32(kind + body):
            raise ValueError(f"chunk {kind!r} is damaged")
        if kind == b"nbYt":
            (size,) = struct.unpack(">Q", body)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(-1, WIDTH + 1)
    return size, lines[:, 1:]


def write_archives(docs: DataFrame, out: str) -> list[tuple[str, int]]:
    """Writes docs (doc_id, text) as archives below the folder out; returns (uri, members) of each.

    Files that failed or speculative attempts leave behind are in no returned list.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = f"{out}/media-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zip"
        file = archive = None
        n = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if archive is None:
                    file = workspace.open_output(uri)
                    archive = zipfile.ZipFile(file, "w", zipfile.ZIP_STORED, allowZip64=True)
                name = zipfile.ZipInfo(f"{n:09d}_{'' if doc_id is None else doc_id}.png")
                archive.writestr(name, to_png((text.as_py() or "").encode()))
                n += 1
        if archive is not None:
            archive.close()
            file.close()
            yield pa.RecordBatch.from_pylist([{"uri": uri, "members": n}], schema=pa.schema([("uri", pa.string()), ("members", pa.int64())]))

    return sorted((r.uri, r.members) for r in docs.select("doc_id", "text").mapInArrow(W.tidy(write), "uri string, members long").collect())


class Range(InputPartition):
    def __init__(self, uri: str, first: int, to: int):
        super().__init__((uri, first, to))


class ArchiveMembers(DataSource):
    """Options: path (a folder), only (archives to read, separated by new lines; default all), range_bytes, attempts."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return "archive string, offset long, name string, payload binary, error string"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.only = set(options["only"].split("\n")) if options.get("only") is not None else None
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.attempts = int(options.get("attempts", ATTEMPTS))

    def partitions(self) -> list[Range]:
        files = [x for x in workspace.list_files(self.path, ".zip") if self.only is None or x[0].rsplit("/", 1)[1] in self.only]
        return [Range(uri, at, min(at + self.range_bytes, size)) for uri, size in files for at in range(0, size, self.range_bytes)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        uri, first, to = partition.value
        if not uri:
            return
        with workspace.open_input(uri) as file:
            members = sorted((m for m in zipfile.ZipFile(file).infolist() if first <= m.header_offset < to), key=lambda m: m.header_offset)
        handle, rows, held = None, [], 0
        for m in members:
            payload = error = None
            for _ in range(self.attempts):
                try:
                    handle = handle or workspace.open_input(uri)
                    payload, error = read_member(handle, m), None
                    break
                except (OSError, ValueError, struct.error) as e:
                    error = f"{type(e).__name__}: {e}"
                    if handle:
                        handle.close()
                    handle = None
            rows.append({"archive": uri, "offset": m.header_offset, "name": m.filename, "payload": payload, "error": error})
            held += len(payload or b"")
            if held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if handle:
            handle.close()
        if rows:
            yield _batch(rows)


def read_member(file, m: zipfile.ZipInfo) -> bytes:
    """A stored member's bytes, from its own offset."""
    file.seek(m.header_offset)
    head = struct.unpack(LOCAL_HEADER, file.read(30))
    if head[0] != b"PK\x03\x04" or m.compress_type != zipfile.ZIP_STORED:
        raise ValueError(f"no stored member begins at {m.header_offset}")
    file.seek(m.header_offset + 30 + head[9] + head[10])
    payload = file.read(m.file_size)
    if len(payload) != m.file_size or zlib.crc32(payload) != m.CRC:
        raise ValueError(f"member at {m.header_offset} is damaged")
    return payload


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("name", pa.string()), ("payload", pa.binary()), ("error", pa.string())]))


def read_archives(spark: SparkSession, path: str, only: list[str] | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    spark.dataSource.register(ArchiveMembers)
    reader = spark.read.format("archive_members").option("path", path).option("range_bytes", str(range_bytes))
    return (reader if only is None else reader.option("only", "\n".join(x.rsplit("/", 1)[1] for x in only))).load()


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def features(members: DataFrame) -> DataFrame:
    """One row per image: sizes, digests of its samples and of its stored form, and statistics of its samples.

    A member that could not be read fails the job: its document must not be missing.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, payload, error in zip(*(batch.column(c).to_pylist() for c in ("name", "payload", "error")), strict=True):
                if error is not None:
                    raise OSError(f"{name}: {error}")
                size, samples = from_png(payload)
                raw = samples.tobytes()
                counts = np.bincount(samples.ravel(), minlength=256)
                p = counts[counts > 0] / len(raw)
                mean = float(counts @ np.arange(256)) / len(raw)
                spread = float(np.sqrt(max(0.0, counts @ (np.arange(256) - mean) ** 2 / len(raw))))
                doc_id = name[10:-4]
                rows.append((int(doc_id) if doc_id else None, size, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]), len(payload), hashlib.sha256(payload).hexdigest(), f"mean={mean:.4f};std={spread:.4f};entropy={abs(float(-(p * np.log2(p)).sum())):.4f};levels={len(p)}"))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in FEATURES.split(", ")])

    return members.select("name", "payload", "error").mapInArrow(W.tidy(look), FEATURES)
