"""Token-id files with Elias-Fano document boundaries.

A shard holds the ids of consecutive documents, one after the other, as 16-bit
or 32-bit numbers, then the boundaries and the document ids as Elias-Fano
sequences: about 2 + log2(tokens / documents) bits for a boundary, and any
boundary is found by one select, without a table of 64-bit offsets.

Documents are in ascending doc_id order over all shards, those without one
first; rows with equal doc_id follow by their text's hash, so one hot id spreads
over shards.  Null texts count as empty: such a document is its end id alone.
An empty table gives no shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.llm import tokens, workspace, words as W

MAGIC = b"IWTOKEF1"
FOOTER = "<8sIQQQQQQq"  # magic, id bytes, documents, tokens, without doc_id, bytes of boundaries, of doc ids, of ids, smallest doc id


class EliasFano:
    """A non-decreasing sequence of unsigned numbers with random access.

    Low bits are packed side by side.  High parts are set bits at (value >> low)
    + i.  A select finds the byte of the i-th set bit by the counts of set bits
    before each byte (32-bit numbers, rebuilt when the sequence is opened).
    """

    HEAD = struct.Struct("<QBQ")

    def __init__(self, n: int, low: int, lows: np.ndarray, highs: np.ndarray):
        self.n, self.low, self.lows, self.highs = n, low, lows, highs
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(highs), dtype=np.uint32)))  # set bits before each byte; rebuilt, not stored

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.ascontiguousarray(values, np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        low = max(0, (top // n).bit_length() - 1) if n else 0
        bits = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        high = np.zeros(n + (top >> low) + 1, np.uint8)
        high[(v >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
        return cls(n, low, np.packbits(bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"))

    def to_bytes(self) -> bytes:
        return self.HEAD.pack(self.n, self.low, len(self.highs)) + self.lows.tobytes() + self.highs.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, low, size = cls.HEAD.unpack_from(raw)
        body = np.frombuffer(raw, np.uint8, offset=cls.HEAD.size)
        return cls(n, low, body[: len(body) - size], body[len(body) - size :])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        byte = int(np.searchsorted(self.before, i, side="right")) - 1
        ones = np.flatnonzero(np.unpackbits(self.highs[byte : byte + 1], bitorder="little"))
        high = 8 * byte + int(ones[i - int(self.before[byte])]) - i
        at = i * self.low
        part = np.unpackbits(self.lows[at // 8 : (at + self.low + 7) // 8], bitorder="little")[at % 8 : at % 8 + self.low]
        return (high << self.low) | sum(int(b) << k for k, b in enumerate(part))

    def part(self, first: int, to: int) -> np.ndarray:
        """The numbers from the first to before the last, by a select for the first; nothing else is decoded."""
        if to <= first:
            return np.zeros(0, np.uint64)
        low, high = (int(np.searchsorted(self.before, i, side="right")) - 1 for i in (first, to - 1))
        ones = np.flatnonzero(np.unpackbits(self.highs[low : high + 1], bitorder="little"))[first - int(self.before[low]) :][: to - first]
        out = (8 * low + ones - np.arange(first, to)).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            at, end = first * self.low, to * self.low
            bits = np.unpackbits(self.lows[at // 8 : (end + 7) // 8], bitorder="little")[at % 8 :][: end - at].reshape(to - first, self.low)
            for k in range(self.low):
                out |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return out

    def all(self) -> np.ndarray:
        high = (np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n] - np.arange(self.n)).astype(np.uint64)
        out = high << np.uint64(self.low)
        if self.low:
            bits = np.unpackbits(self.lows, bitorder="little")[: self.n * self.low].reshape(self.n, self.low)
            for k in range(self.low):
                out |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return out


def with_end(starts: np.ndarray, ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ids) with the end id after each document."""
    n = len(starts) - 1
    last = np.zeros(len(ids) + n, bool)
    last[starts[1:] + np.arange(n)] = True
    out = np.empty(len(last), np.uint32)
    out[last] = end
    out[~last] = ids
    return starts + np.arange(n + 1), out


SHARDS = "shard int, uri string, documents long, tokens long"


def write_token_ids(docs: DataFrame, out: str, tokenizer: str | None = None, end_id: int = 1) -> list[tuple[str, int, int]]:
    """Writes docs (doc_id, text) as shards below the folder out; returns (uri, documents, tokens) of each, in order.

    What a failed or speculative attempt leaves behind is a file that no result names.
    The list has a row for each shard, not for each document.
    """
    path = tokenizer or tokens.default_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = tokens.codec(path)
        width = 2 if max(codec.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        shard = TaskContext.get().partitionId()
        uri = f"{out}/ids-{shard:06d}-{uuid.uuid4().hex}.bin"
        file, sizes, doc_ids = None, [], []
        for batch in batches:
            text = W.texts(batch.column("text"))
            for at, part in W.slices(text):
                file = file or workspace.open_output(uri)
                starts, ids = with_end(*codec.encode(part), end_id)
                file.write(ids.astype(f"<u{width}").tobytes())
                sizes.append(np.diff(starts))
                doc_ids.append(batch.column("doc_id").slice(at, len(part)).cast(pa.int64()))
        if file:
            ends = tokens.starts_of(np.concatenate(sizes))
            known = pa.chunked_array(doc_ids)
            nulls = known.null_count
            known = known.drop_null().to_numpy().astype(np.int64)
            least = int(known[0]) if len(known) else 0
            bounds = EliasFano.of(ends).to_bytes()
            keys = EliasFano.of(known.view(np.uint64) - np.int64(least).astype(np.uint64)).to_bytes()
            file.write(bounds + keys)
            file.write(struct.pack(FOOTER, MAGIC, width, len(ends) - 1, int(ends[-1]), nulls, len(bounds), len(keys), width * int(ends[-1]), least))
            file.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "uri": uri, "documents": len(ends) - 1, "tokens": int(ends[-1])}], schema=pa.schema([("shard", pa.int32()), ("uri", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())]))

    spread = docs.select("doc_id", "text", F.xxhash64("text").alias("_h")).repartitionByRange("doc_id", "_h")
    rows = spread.sortWithinPartitions("doc_id", "_h", "text").mapInArrow(W.tidy(write, keeps=True), SHARDS).collect()
    return [(r.uri, r.documents, r.tokens) for r in sorted(rows)]


class Shard:
    """One written file: offsets by select, ids by document."""

    def __init__(self, uri: str):
        self.file = workspace.open_input(uri)
        self.file.seek(-struct.calcsize(FOOTER), 2)
        end = self.file.tell()
        magic, self.width, self.documents, self.tokens, nulls, b, k, at, least = struct.unpack(FOOTER, self.file.read())
        if magic != MAGIC or at + b + k != end:
            raise ValueError(f"{uri} is not a whole token-id file")
        self.file.seek(at)
        self.bounds = EliasFano.from_bytes(self.file.read(b))
        self.keys, self.nulls, self.least = EliasFano.from_bytes(self.file.read(k)), nulls, least

    def doc_ids(self, first: int, to: int) -> pa.Array:
        """Ids of the documents from the first to before the last; those without one come first."""
        none = max(0, min(to, self.nulls) - first)
        keys = self.keys.part(max(first, self.nulls) - self.nulls, to - self.nulls) + np.int64(self.least).astype(np.uint64)
        return pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(keys.view(np.int64))])

    def block(self, first: int, tokens_: int) -> int:
        """The last document that ends within so many tokens of the first one's start, but one at least, plus one; found by selects."""
        low, high, limit = first + 1, self.documents, self.bounds[first] + tokens_
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.bounds[mid] <= limit else (low, mid - 1)
        return low

    def ids(self, first: int, to: int) -> np.ndarray:
        """Ids from token first up to token to."""
        self.file.seek(first * self.width)
        return np.frombuffer(self.file.read((to - first) * self.width), f"<u{self.width}").astype("<u4")

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.bounds[i], self.bounds[i + 1])


def read_token_ids(spark: SparkSession, shards: list[tuple[str, int, int]], digest: bool = False) -> DataFrame:
    """One row per document of the shards: doc_id, start (tokens of all before it), n_tokens, and its ids.

    With digest, the unsigned CRC-32 of the ids as little-endian 32-bit numbers instead of the ids.
    """
    rows, base = [], 0
    for uri, _, size in shards:
        rows.append((uri, base))
        base += size
    schema = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = Shard(uri)
                at = 0
                while at < shard.documents:
                    to = shard.block(at, 1 << 21)
                    ends = shard.bounds.part(at, to + 1).astype(np.int64)
                    ids, own = shard.ids(int(ends[0]), int(ends[-1])), ends - ends[0]
                    if digest:
                        raw = memoryview(ids).cast("B")
                        last = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)], pa.int64())
                    else:
                        last = pa.ListArray.from_arrays(pa.array(own.astype(np.int32)), pa.array(ids.view(np.int32)))
                    yield pa.RecordBatch.from_arrays([shard.doc_ids(at, to), pa.array(first + ends[:-1]), pa.array(np.diff(own)), last], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])
                    at = to

    listed = spark.createDataFrame(rows, "uri string, base long")
    return listed.repartition(max(1, len(rows))).mapInArrow(W.tidy(read), schema)
