"""Exact deduplication against an immutable snapshot, screened by binary-fuse filters.

Texts are equal when identical after each run of space and \\x09-\\x0D is one
space; null counts as empty.  A snapshot's digests lie in buckets of bounded
size, each with a static three-wise binary-fuse filter of 8-bit fingerprints
(Graf and Lemire, 2022).  A batch's digests are grouped among themselves, then
screened bucket by bucket: what a filter rejects is new to the snapshot, what
passes (all that are there and 0.4 % of the rest) joins the exact bucket.  All
texts that share a digest are then compared byte by byte with the one that stays.

Of equal texts the smallest doc_id stays; rows without doc_id come last.  Of
repeated rows (equal doc_id and text) exactly one is kept.  An empty table gives
no rows.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwright.llm import workspace

#: Digests in a snapshot's bucket, about; a filter takes nine bits for each.
BUCKET_KEYS = 4096


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(normal(text).cast("binary"), 256))


class BinaryFuse:
    """A static set of 64-bit keys: no false negatives, false positives at 1 in 256."""

    HEAD = struct.Struct("<QQII")  # keys, seed, segment length, segments that start a triple

    def __init__(self, n: int, seed: int, length: int, count: int, prints: np.ndarray):
        self.n, self.seed, self.length, self.count, self.prints = n, seed, length, count, prints

    @staticmethod
    def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
        h = keys + np.uint64(seed)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))

    def _slots(self, h: np.ndarray) -> np.ndarray:
        mask = np.uint64(self.length - 1)
        first = ((h >> np.uint64(32)) * np.uint64(self.count * self.length)) >> np.uint64(32)
        second = (first + np.uint64(self.length)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * self.length)) ^ (h & mask)
        return np.stack((first, second, third)).astype(np.int64)

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def of(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        length = 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
        size = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2))))
        count = max(1, -(-size // length) - 2)
        for seed in range(1, 1000):
            f = cls(n, seed * 0x9E3779B97F4A7C15 % (1 << 64), length, count, np.zeros((count + 2) * length, np.uint8))
            if f._fill(keys):
                return f
            if not seed % 20:
                count += 1 + count // 8
        raise RuntimeError("no filter was found")

    def _fill(self, keys: np.ndarray) -> bool:
        h = self._mix(keys, self.seed)
        at, n = self._slots(h), len(keys)
        # peel slots with one key left, a whole round at a time; keys of a round don't depend on each other
        degree = np.bincount(at.ravel(), minlength=len(self.prints))
        which = np.zeros(len(self.prints), np.int64)
        for k in range(3):
            np.bitwise_xor.at(which, at[k], np.arange(n))
        rounds, done = [], 0
        single = np.flatnonzero(degree == 1)
        while single.size:
            key, first = np.unique(which[single], return_index=True)
            slot = single[first]
            rounds.append((key, slot))
            done += len(key)
            touched = at[:, key]
            np.subtract.at(degree, touched.ravel(), 1)
            np.bitwise_xor.at(which, touched.ravel(), np.tile(key, 3))
            near = np.unique(touched)
            single = near[degree[near] == 1]
        if done < n:
            return False
        prints = self._print(h)
        for key, slot in reversed(rounds):
            a, b, c = at[:, key]
            self.prints[slot] = 0
            self.prints[slot] = prints[key] ^ self.prints[a] ^ self.prints[b] ^ self.prints[c]
        return True

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.zeros(len(keys), bool)
        h = self._mix(keys.astype(np.uint64), self.seed)
        a, b, c = self._slots(h)
        return self._print(h) == self.prints[a] ^ self.prints[b] ^ self.prints[c]

    def to_bytes(self) -> bytes:
        return self.HEAD.pack(self.n, self.seed, self.length, self.count) + self.prints.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> BinaryFuse:
        return cls(*cls.HEAD.unpack_from(raw), np.frombuffer(raw, np.uint8, offset=cls.HEAD.size))


def _keys(digests: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The bytes 8 to 15 of each digest as a number; buckets take the first four."""
    return np.frombuffer(b"".join(x[8:16] for x in digests.to_pylist()), "<u8")


def build_filters(snapshot: DataFrame) -> DataFrame:
    """Rows (bucket, filter) of distinct digests (bucket, digest)."""

    def build(group: pa.Table) -> pa.Table:
        return pa.table({"bucket": group["bucket"][:1], "filter": pa.array([BinaryFuse.of(_keys(group["digest"])).to_bytes()], pa.binary())})

    return snapshot.select("bucket", "digest").groupBy("bucket").applyInArrow(build, "bucket long, filter binary")


def screen(batch: DataFrame, filters: DataFrame) -> DataFrame:
    """batch (bucket, digest) with a column hit: whether the bucket's filter lets the digest pass."""

    def look(group: pa.Table, found: pa.Table) -> pa.Table:
        hit = BinaryFuse.from_bytes(found["filter"][0].as_py()).has(_keys(group["digest"])) if found.num_rows and group.num_rows else np.zeros(group.num_rows, bool)
        return group.append_column("hit", pa.array(hit))

    both = batch.select("bucket", "digest").groupBy("bucket").cogroup(filters.groupBy("bucket"))
    return both.applyInArrow(look, "bucket long, digest binary, hit boolean")


def exact_dedup(docs: DataFrame, is_new: Column | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, seen_in ('snapshot', 'batch', 'both').

    ``is_new`` tells the incoming batch from the snapshot; by default the batch
    is the upper half of the range of doc_ids, and rows without one.
    """
    spark = docs.sparkSession
    with workspace.Scratch(spark) as scratch:
        rows = docs.select("doc_id", "text")
        if is_new is None:
            low, high = docs.select(F.min("doc_id"), F.max("doc_id")).first()
            cut = 0 if low is None else (low + high) // 2
            is_new = F.coalesce(F.col("doc_id") > F.lit(cut), F.lit(True))
        digests = docs.select("doc_id", digest(F.col("text")).alias("digest"), is_new.alias("is_new"))
        # a row for each doc_id and text, with the number of such rows
        ids = scratch.table(digests.groupBy("digest", "doc_id", "is_new").agg(F.count("*").alias("n")), "ids")
        sides = scratch.table(ids.groupBy("digest", "is_new").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("n"), F.count("*").alias("ids")), "sides")
        # as many buckets as the larger side needs, so that a large batch meets a small snapshot in many tasks
        counts = {r.is_new: r.n for r in sides.groupBy("is_new").agg(F.count("*").alias("n")).collect()}
        buckets = max(1, -(-max(counts.values(), default=0) // BUCKET_KEYS))
        bucket = F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(buckets)).alias("bucket")
        sides = sides.select("*", bucket)
        snapshot, batch = sides.where("not is_new"), sides.where("is_new")
        filters = build_filters(snapshot)
        screened = scratch.table(screen(batch, filters), "screened")
        hits = screened.where("hit").select("digest")
        # filter positives meet their exact bucket
        shared = scratch.table(snapshot.join(workspace.small_side(hits, 48), "digest", "left_semi").select("digest", "keep_id", "n", "ids"), "shared")
        alone = sides.where("n > 1").select("digest", "keep_id", "n", "ids", "is_new")
        same = F.sum("n").alias("n"), F.min("keep_id").alias("keep_id"), F.when(F.count_distinct("is_new") > 1, "both").when(F.max("is_new"), "batch").otherwise("snapshot").alias("seen_in")
        parts = alone.unionByName(shared.withColumn("is_new", F.lit(False)).where("n = 1")).unionByName(
            batch.where("n = 1").join(workspace.small_side(shared.select("digest"), 48), "digest", "left_semi").select("digest", "keep_id", "n", "ids", "is_new")
        )
        groups = scratch.table(parts.groupBy("digest").agg(*same).where("n > 1"), "groups")
        compare(rows, groups, scratch)
        out = ids.join(workspace.small_side(groups.select("digest", F.col("keep_id").alias("_keep"), F.col("n").alias("_size"), "seen_in"), 80), "digest", "left")
        grouped = F.col("_size").isNotNull()
        keep_id = F.when(grouped, F.col("_keep")).otherwise(F.col("doc_id"))
        result = out.select(
            "doc_id",
            keep_id.alias("keep_id"),
            F.coalesce("_size", "n").alias("group_size"),
            F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("_nth"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            F.coalesce("seen_in", F.when(F.col("is_new"), "batch").otherwise("snapshot")).alias("seen_in"),
        ).select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)).alias("kept"), "text_sha256", "seen_in")
        return scratch.keep(result)


def compare(rows: DataFrame, groups: DataFrame, scratch: workspace.Scratch) -> None:
    """Holds each text of a group against the group's first, byte by byte; raises if they differ (a SHA-256 collision)."""
    texts = rows.select("doc_id", normal(F.col("text")).alias("own"), digest(F.col("text")).alias("digest"))
    members = texts.join(workspace.small_side(groups.select("digest", "keep_id"), 56), "digest")
    # a table of its own: beside it, the members of a group with very many copies can be split among tasks
    first = scratch.table(members.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(F.min("own").alias("first")), "first")
    wrong = members.join(first, "digest").where("own != first").select("doc_id").take(1)
    if wrong:
        raise RuntimeError(f"the text of document {wrong[0].doc_id} has the digest of another text")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """docs, all columns, with one row of each group of equal texts."""
    found = exact_dedup(docs)
    gone = found.where("not kept").select("doc_id", "keep_id", "text_sha256")
    # rows of a doc_id that goes; a doc_id that stays with one of several rows needs a choice among them
    goes = gone.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", F.unhex("text_sha256").alias("__iw_digest")).distinct()
    again = gone.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", F.unhex("text_sha256").alias("__iw_digest")).distinct()
    tagged = docs.withColumn("__iw_digest", digest(F.col("text")))
    on = lambda side: tagged["__iw_digest"].eqNullSafe(side["__iw_digest"]) & tagged["doc_id"].eqNullSafe(side["doc_id"])
    goes = workspace.small_side(goes, 64)
    stays = tagged.join(goes, on(goes), "left_anti")
    if again.isEmpty():
        return stays.drop("__iw_digest")
    again = workspace.small_side(again, 64)
    single = stays.join(again, (stays["__iw_digest"] == again["__iw_digest"]) & stays["doc_id"].eqNullSafe(again["doc_id"]), "left_anti").drop("__iw_digest")
    several = stays.join(again, (stays["__iw_digest"] == again["__iw_digest"]) & stays["doc_id"].eqNullSafe(again["doc_id"]), "left_semi")
    one = several.groupBy("doc_id", "__iw_digest").agg(F.first(F.struct(*docs.columns)).alias("row")).select("row.*")
    return single.unionByName(one)
