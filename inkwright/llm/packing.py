"""Best-fit packing of documents into sequences, on the histogram of lengths.

Which document of a length lies where does not matter, so the bins are planned
from the counts of each length alone: at most ``capacity`` counts, whatever the
size of the corpus.  Lengths above a third of the capacity are matched greedily,
the largest with the largest partner that fits, at most two in a bin; smaller
ones fill the tightest gap that holds them, the largest first.  A plan is a few
thousand patterns with their multiplicities.  Documents then find their places
by their rank among those of equal length.

Null texts count as empty (the end id alone).  Repeated rows and rows without
doc_id are packed like any other; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwright.llm import tokens, token_ids, workspace, words as W


@dataclass
class Pattern:
    """count bins, each with the same items (size, times), in this order."""

    count: int
    items: list[tuple[int, int]] = field(default_factory=list)


def pack_histogram(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Bins for counts[size] items of each size from 1 to capacity."""
    left = {s: n for s, n in counts.items() if n}
    if left and not 1 <= min(left) <= max(left) <= capacity:
        raise ValueError("sizes lie between 1 and the capacity")
    open_bins: dict[int, list[Pattern]] = {}
    gaps: list[int] = []
    full: list[Pattern] = []

    def put(pattern: Pattern, gap: int) -> None:
        if not gap:
            full.append(pattern)
        elif gap in open_bins:
            open_bins[gap].append(pattern)
        else:
            bisect.insort(gaps, gap)
            open_bins[gap] = [pattern]

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        x = large[-1]
        k = bisect.bisect_right(large, capacity - x) - 1
        if k < 0:
            put(Pattern(left[x], [(x, 1)]), capacity - x)
            left[x] = 0
        elif (y := large[k]) == x:
            if n := left[x] // 2:
                put(Pattern(n, [(x, 2)]), capacity - 2 * x)
            if left[x] % 2:
                j = k - 1  # an odd one takes the next smaller partner
                if j >= 0:
                    put(Pattern(1, [(x, 1), (large[j], 1)]), capacity - x - large[j])
                    left[large[j]] -= 1
                else:
                    put(Pattern(1, [(x, 1)]), capacity - x)
            left[x] = 0
        else:
            n = min(left[x], left[y])
            put(Pattern(n, [(x, 1), (y, 1)]), capacity - x - y)
            left[x] -= n
            left[y] -= n
        large = [s for s in large if left[s]]

    for s in sorted((s for s in left if left[s]), reverse=True):
        c = left[s]
        while c:
            k = bisect.bisect_left(gaps, s)
            if k == len(gaps):
                m = capacity // s
                if c // m:
                    put(Pattern(c // m, [(s, m)]), capacity - m * s)
                if c % m:
                    put(Pattern(1, [(s, c % m)]), capacity - c % m * s)
                break
            gap = gaps[k]
            group = open_bins[gap].pop()
            if not open_bins[gap]:
                del open_bins[gap], gaps[k]
            m = gap // s
            n = min(group.count, c // m)
            if n:
                put(Pattern(n, [*group.items, (s, m)]), gap - m * s)
                c -= n * m
                group = Pattern(group.count - n, group.items)
            if c and group.count:  # fewer than m are left
                put(Pattern(1, [*group.items, (s, c)]), gap - c * s)
                group = Pattern(group.count - 1, group.items)
                c = 0
            if group.count:
                put(group, gap)
    return full + [p for gap in gaps for p in open_bins[gap]]


#: A slot's key is size << RANK_BITS | rank.
RANK_BITS = 48


def slots(patterns: list[Pattern]) -> np.ndarray:
    """Rows (key of the first rank, first sequence, times in each, offset of the first), by key."""
    rows, used, base = [], {}, 0
    for p in patterns:
        offset = 0
        for size, times in p.items:
            first = used.get(size, 0)
            rows.append((size << RANK_BITS | first, base, times, offset))
            used[size] = first + p.count * times
            offset += size * times
        base += p.count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def place(table: np.ndarray, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the items with these sizes and ranks among their size."""
    row = table[np.searchsorted(table[:, 0], (size << RANK_BITS) | rank, side="right") - 1]
    nth = rank - (row[:, 0] & ((1 << RANK_BITS) - 1))
    return row[:, 1] + nth // row[:, 2], row[:, 3] + nth % row[:, 2] * size


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, capacity: int, tokenizer: str, end_id: int) -> DataFrame:
    """Each document's ids in pieces; nth counts the pieces of its length before it in its task, part."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = tokens.codec(tokenizer)
        part_id = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            text = W.texts(batch.column("text"))
            for at, part in W.slices(text):
                starts, ids = token_ids.with_end(*codec.encode(part), end_id)
                sizes = np.diff(starts)
                each = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), each)
                piece = np.arange(len(doc)) - np.repeat(tokens.starts_of(each)[:-1], each)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                first = starts[doc] + start
                raw = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                run = length[order]
                new = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
                within = np.arange(len(run)) - np.repeat(new, np.diff(np.append(new, len(run))))
                nth = np.empty(len(run), np.int64)
                nth[order] = within + seen[run]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)).cast(pa.int64()).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), part_id, np.int32)), pa.array(nth)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
                )

    return docs.select("doc_id", "text").mapInArrow(W.tidy(cut, keeps=True), PIECES)


def best_fit_packing(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents of more than capacity tokens are cut.  What the driver gathers
    is the histogram: a row for each length.
    """
    spark = docs.sparkSession
    with workspace.Scratch(spark) as scratch:
        cut = scratch.table(pieces(docs, capacity, tokenizer or tokens.default_path(), end_id), "pieces")
        by_part = scratch.table(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
        counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
        plan = spark.sparkContext.broadcast(slots(pack_histogram(counts, capacity)))
        before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        bases = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

        def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    sequence, offset = place(plan.value, *(b.column(c).to_numpy() for c in ("length", "rank")))
                    yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

        ranked = cut.join(bases, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
        return scratch.keep(ranked.mapInArrow(W.tidy(put, keeps=True), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))
