"""Whole texts as arrays of words, a few megabytes at a time.

Words are runs of other bytes than space and \\x09-\\x0D.  They are split and
numbered by Arrow's kernels; Python sees each distinct word of a slice once.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as large strings; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(text: pa.Array, limit: int = SLICE_BYTES, *beside: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) with at most limit bytes, those of the columns beside counted, or one row."""
    ends = np.cumsum(sum(pc.binary_length(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (text, *beside)), dtype=np.int64)
    at = 0
    while at < len(text):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield at, text.slice(at, to - at)
        at = to


class Words:
    """Words of some texts: ``index`` numbers each word in ``distinct``; text i has words starts[i]:starts[i + 1]."""

    def __init__(self, text: pa.Array):
        lists = pc.ascii_split_whitespace(text)
        flat = lists.flatten()
        starts = lists.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        kept = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        coded = flat.filter(pa.array(kept)).dictionary_encode()
        self.distinct: pa.Array = coded.dictionary
        self.index: np.ndarray = coded.indices.to_numpy(zero_copy_only=False)
        self.starts: np.ndarray = np.concatenate(([0], np.cumsum(kept)))[starts]


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of values[starts[i]:starts[i + 1]] for each i."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


class Memo(dict):
    """Values by word, computed for all new words at once and held up to a number of entries."""

    def __init__(self, compute, most: int = 150_000):
        self.compute, self.most = compute, most

    def of(self, words: list) -> list:
        new = [w for w in words if w not in self]
        if new:
            if len(self) + len(new) > self.most:
                self.clear()
                new = words
            self.update(zip(new, self.compute(new), strict=True))
        return [self[w] for w in words]


#: What a worker keeps from task to task for those operators that use it again.
KEPT: dict = {}
#: Tasks that read so many bytes give memory back; smaller ones took little.
TIDY_BYTES = 4 << 20


def tidy(run: Callable[[Iterator], Iterator], keeps: bool = False) -> Callable[[Iterator], Iterator]:
    """run, for mapInArrow: unless it keeps what is ``KEPT``, that goes first; after much data the worker gives its free memory back."""

    def tidied(batches: Iterator) -> Iterator:
        if not keeps:
            KEPT.clear()
        read = 0

        def counted() -> Iterator:
            nonlocal read
            for batch in batches:
                read += batch.nbytes
                yield batch

        yield from run(counted())
        if read >= TIDY_BYTES:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # another C library
                pass

    return tidied
