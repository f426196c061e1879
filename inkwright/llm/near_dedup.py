"""MinHash near-duplicates with sequential Bayesian verification.

A document's set is that of its distinct runs of ``width`` words (A-Z lowered);
one with fewer words is one run, one without words has an empty set and is
linked with nothing.  Documents with equal sets form classes at once, so copies
never meet as pairs.  Each class's signature is banded; classes that share a
band are candidates.  A candidate pair's signatures are compared in batches, and
the pair is dropped as soon as the chance that its similarity reaches the
threshold, given the matches so far (uniform prior), is below ``miss``.  Pairs
that survive are verified on their whole sets; only those are links.

Bands shared by many classes: up to ``ALL_PAIRS`` classes meet pairwise.  In
larger bands classes first meet a few pivots (``components.link_large``); what
these leave apart is linked by its differences from one pivot (``_dense``).  So
no band is compared in all pairs, and every pair that shares a band is compared,
or in one component, or shown to be no link.

Rows are documents by their own text: of rows that share a doc_id, each has the
component of its text, whose component_id is the smallest doc_id of all rows in it.
Rows without doc_id are never linked, are kept, and their component_id is null.
Null texts count as empty; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, gcd, lgamma, log, log1p

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwright.llm import components, workspace, words as W

#: Sets at the threshold share no band with this probability at most.
BAND_MISS = 1e-4
#: Bands of similarity 0.85 (``bands_for``).
BANDS, ROWS = 21, 6
HASHES = BANDS * ROWS
BATCH = 21  # hashes compared at a time; divides the number of hashes
MISS = 1e-6
#: Numbers for each shingle take several times a text's bytes, so slices are small.
SLICE = 2 << 20
MEMO = 150_000
ALL_PAIRS = 24
#: Clusters of up to so many classes are compared whole, in blocks of so many members or differences (``_met``).
BLOCKED, BLOCK, BLOCK_RUNS = 4096, 512, 1 << 20


def bands_for(threshold: float, miss: float = BAND_MISS) -> int:
    """The fewest bands of ROWS in which sets of this similarity share none with probability miss at most, in whole batches of hashes."""
    least, step = ceil(log(miss) / log1p(-(threshold**ROWS))), BATCH // gcd(BATCH, ROWS)
    return -(-least // step) * step


def _multipliers(n: int) -> np.ndarray:
    raw = b"".join(hashlib.blake2b(b"minhash%d" % k, digest_size=8).digest() for k in range(n))
    return np.frombuffer(raw, "<u8") | np.uint64(1)


MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(text: pa.Array, width: int, memo: W.Memo) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes): 64-bit hashes of the word runs of each text of a slice, repeated ones included."""
    found = W.Words(pc.ascii_lower(text))
    value = np.array(memo.of(found.distinct.to_pylist()), np.uint64)
    own = value[found.index] if len(value) else np.zeros(0, np.uint64)
    size = np.diff(found.starts)
    n = np.where(size == 0, 0, np.maximum(size - width + 1, 1))
    starts = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(found.starts[:-1] - starts[:-1], n) + np.arange(starts[-1])
    out = np.full(len(at), np.uint64(width))
    padded = np.concatenate((own, np.zeros(width, np.uint64)))
    short = np.repeat(size < width, n)
    left = np.repeat(size, n)
    for k in range(width):
        h = padded[at + k] + np.uint64(1)
        if short.any():
            h = np.where(short & (k >= left), np.uint64(0), h)
        out = (out ^ h) * MIX[k % len(MIX)]
        out ^= out >> np.uint64(32)
    return starts, _finish(out)


def hash_words(found: list[str]) -> list[int]:
    return [xxhash.xxh64_intdigest(w) for w in found]


def distinct(starts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text."""
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.concatenate(([0], np.cumsum(np.bincount(d[new], minlength=len(starts) - 1)))), h[new]


def signatures(starts: np.ndarray, hashes: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """MinHash of each non-empty set: an array (sets, multipliers) of 32-bit numbers."""
    sizes = np.diff(starts)
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sizes), len(multipliers)), np.uint32)
    first, end = starts[:-1][full], starts[1:][full]
    lo = 0
    while lo < len(full):  # blocks that stay in the cache
        hi = max(lo + 1, int(np.searchsorted(end, first[lo] + (1 << 16), side="right")))
        block, cut = hashes[first[lo] : end[hi - 1]], first[lo:hi] - first[lo]
        for k, m in enumerate(multipliers):
            out[full[lo:hi], k] = np.minimum.reduceat(block * m, cut) >> np.uint64(32)
        lo = hi
    return out


def least_matches(threshold: float, miss: float = MISS, hashes: int = HASHES) -> list[int]:
    """For each number of compared hashes BATCH, 2 * BATCH, ...: the fewest matches with P(similarity >= threshold | matches) >= miss."""
    x = (np.arange(20_000) + 0.5) / 20_000
    need = []
    for n in range(BATCH, hashes + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(x) + (n - m) * np.log1p(-x) + lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1)
            p = np.exp(log)
            if p[x >= threshold].sum() / p.sum() >= miss:
                break
        need.append(m)
    return need


def plausible(a: np.ndarray, b: np.ndarray, need: list[int]) -> np.ndarray:
    """Which rows of two signature arrays survive all batches."""
    alive = np.arange(len(a))
    met = np.zeros(len(a), np.int64)
    for k, least in enumerate(need):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        met[alive] += (a[alive, cut] == b[alive, cut]).sum(1)
        alive = alive[met[alive] >= least]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def text_key() -> Column:
    """Tells rows that share a doc_id by their texts."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th")


def _sets(documents: DataFrame, width: int, bands: int = BANDS) -> DataFrame:
    """doc_id, th, n_shingles, print (16 bytes of the set), signature."""
    multipliers = _multipliers(bands * ROWS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = W.Memo(hash_words, MEMO)
        for batch in batches:
            text = W.texts(batch.column("text"))
            for at, part in W.slices(text, SLICE):
                starts, hashes = distinct(*shingles(part, width, memo))
                n = np.diff(starts)
                raw = memoryview(hashes).cast("B") if len(hashes) else b""
                prints = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                sig = signatures(starts, hashes, multipliers)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)).cast(pa.int64()), batch.column("th").slice(at, len(part)), pa.array(n), pa.array(prints, pa.binary()), pa.array([s.tobytes() for s in sig], pa.binary())], names=["doc_id", "th", "n_shingles", "print", "signature"]
                )

    return documents.select("doc_id", "text", text_key()).mapInArrow(W.tidy(read), "doc_id long, th long, n_shingles long, print binary, signature binary")


def _bands(classes: DataFrame, bands: int) -> DataFrame:
    """Rows (band, id): one for each band of each class."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column("signature").to_pylist()), "<u4").reshape(-1, bands * ROWS)
            out = np.full((len(sig), bands), 0, np.uint64)
            for k in range(bands):
                h = np.full(len(sig), np.uint64(k + 1))
                for r in range(ROWS):
                    h = (h ^ sig[:, k * ROWS + r].astype(np.uint64)) * MIX[r % len(MIX)]
                    h ^= h >> np.uint64(29)
                out[:, k] = _finish(h)
            ids = np.repeat(b.column("id").to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(out.ravel().view(np.int64)), pa.array(ids)], names=["band", "id"])

    return classes.select("id", "signature").mapInArrow(W.tidy(cut), "band long, id long")


def _verified(pairs: DataFrame, classes: DataFrame, documents: DataFrame, scratch: workspace.Scratch, width: int, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose similarity is at least percent in a hundred."""
    hashes = bands_for(percent / 100) * ROWS
    need = least_matches(percent / 100, hashes=hashes)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").reshape(-1, hashes) for c in ("sa", "sb"))
                n, m = (b.column(c).to_numpy() for c in ("na", "nb"))
                fits = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & plausible(x, y, need)
                yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(fits)), b.column("b").filter(pa.array(fits))], names=["a", "b"])

    side = lambda k: classes.select(F.col("id").alias(k), F.col("signature").alias(f"s{k}"), F.col("n_shingles").alias(f"n{k}"))
    left = scratch.table(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb", "na", "nb").mapInArrow(W.tidy(prune), "a long, b long"), "survivors")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = W.Memo(hash_words, MEMO)
        for b in batches:
            ta, tb = W.texts(b.column("ta")), W.texts(b.column("tb"))
            for at, part in W.slices(ta, SLICE, tb):
                sa, ha = distinct(*shingles(part, width, memo))
                sb, hb = distinct(*shingles(tb.slice(at, len(part)), width, memo))
                keep = np.zeros(len(part), bool)
                for i in range(len(part)):
                    x, y = ha[sa[i] : sa[i + 1]], hb[sb[i] : sb[i + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = 0 < 100 * both >= percent * (len(x) + len(y) - both)
                yield pa.RecordBatch.from_arrays([b.column(c).slice(at, len(part)).filter(pa.array(keep)) for c in "ab"], names=["a", "b"])

    texts = _texts(documents, classes, left.select(F.col("a").alias("id")).union(left.select("b")).distinct(), scratch)
    both = left.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return scratch.table(both.select("a", "b", "ta", "tb").mapInArrow(W.tidy(exact), "a long, b long"), "verified")


def _texts(documents: DataFrame, classes: DataFrame, ids: DataFrame, scratch: workspace.Scratch) -> DataFrame:
    """(id, text) of some classes, each with the text of its smallest doc_id."""
    wanted = scratch.table(ids.join(classes.select("id", F.col("doc_id").alias("_doc"), F.col("th").alias("_th")), "id"), "wanted")
    rows = documents.select("doc_id", "text", text_key())
    met = rows.join(workspace.small_side(wanted, 32), (rows["doc_id"] == F.col("_doc")) & (rows["th"] == F.col("_th"))).select("id", "text")
    texts = scratch.table(met, "texts")
    if texts.count() > wanted.count():  # rows that repeat a doc_id and text
        texts = scratch.table(texts.groupBy("id").agg(F.min("text").alias("text")), "texts")
    return texts


def _apart(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """rows (cluster, id, root, n, k, pivot, pn, least, text, pivot_text) with linked (to the pivot), bare, need, added and lacked.

    added has the runs that the pivot lacks, lacked those that only the pivot has; need is the fewest of them that a
    partner shares, where at least one of the two is not linked to the pivot, but
    1 at least.  A set is bare if it is not linked to the pivot and may be linked
    to one smaller than the pivot without sharing any.
    """

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held = W.Memo(hash_words, MEMO), {}
        for batch in batches:
            text = W.texts(batch.column("text"))
            for at, part in W.slices(text, SLICE):
                starts, hashes = distinct(*shingles(part, width, memo))
                linked, bare, need, added, lacked = [], [], [], [], []
                own = batch.slice(at, len(part))
                for i, (pivot, least) in enumerate(zip(own.column("pivot").to_pylist(), own.column("least").to_pylist(), strict=True)):
                    if pivot not in held:
                        if len(held) >= 256:
                            held.clear()
                        held[pivot] = distinct(*shingles(pa.array([own.column("pivot_text")[i].as_py() or ""], pa.large_string()), width, memo))[1]
                    x, p = hashes[starts[i] : starts[i + 1]], held[pivot]
                    more = np.setdiff1d(x, p, assume_unique=True)
                    n, m, both = len(x), len(p), len(x) - len(more)
                    near = 0 < 100 * both >= percent * (n + m - both)
                    # a partner of size s >= floor shares at least (|x - p| + |p - x| - m + s - c (n + s)) / 2 added runs, c = (100 - percent) / (100 + percent)
                    floor = min(m, max(least, -(-percent * n // 100)))
                    over = (n + m - 2 * both) * (100 + percent) - (100 - percent) * n - (100 + percent) * m + 2 * percent * floor
                    linked.append(near)
                    bare.append(not near and over <= 0)
                    need.append(1 if near else max(1, -(-over // (2 * (100 + percent)))))
                    added.append(more.view(np.int64))
                    lacked.append(np.setdiff1d(p, x, assume_unique=True).view(np.int64))
                lists = [pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(x) for x in c]))).astype(np.int32), np.concatenate(c)) for c in (added, lacked)]
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in ("cluster", "id", "root", "n", "k", "pivot", "pn")), pa.array(linked), pa.array(bare), pa.array(need, pa.int64()), *lists], names=["cluster", "id", "root", "n", "k", "pivot", "pn", "linked", "bare", "need", "added", "lacked"])

    return rows.select("cluster", "id", "root", "n", "k", "pivot", "pn", "least", "text", "pivot_text").mapInArrow(W.tidy(differ), "cluster long, id long, root long, n long, k long, pivot long, pn long, linked boolean, bare boolean, need long, added array<long>, lacked array<long>")


def met(ids: np.ndarray, roots: np.ndarray, n: np.ndarray, linked: np.ndarray, starts: np.ndarray, runs: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (a, b) that connect all linked ones of rows left and right beyond their roots; row i differs from the pivot in runs[starts[i]:starts[i + 1]].

    Of sets x, y, the runs that only one has are those in which only one differs from the pivot.
    """
    size = np.diff(starts)
    known, code = np.unique(runs, return_inverse=True)
    doc = np.repeat(np.arange(len(ids)), size)
    place = np.full(len(ids), -1)
    place[right] = np.arange(len(right))
    kept = place[doc] >= 0
    order = np.argsort(code[kept], kind="stable")
    holders, first = place[doc[kept]][order], np.searchsorted(code[kept][order], np.arange(len(known) + 1))
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            x = up
        return x

    links = []
    for i in left.tolist():
        open_ = (roots[right] != roots[i]) & ~(linked[right] & linked[i])
        if not open_.any():
            continue
        own = code[starts[i] : starts[i + 1]]
        many = first[own + 1] - first[own]
        at = np.repeat(first[own] - np.cumsum(many) + many, many) + np.arange(many.sum())
        same = np.bincount(holders[at], minlength=len(right))
        both = (n[i] + n[right] - (size[i] + size[right] - 2 * same)) // 2
        hits = np.flatnonzero(open_ & (both > 0) & (100 * both >= percent * (n[i] + n[right] - both)))
        for k in hits[np.unique(roots[right][hits], return_index=True)[1]].tolist():
            x, y = find(int(roots[i])), find(int(roots[right[k]]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((int(ids[i]), int(ids[right[k]])))
    return links


def _met(apart: DataFrame, percent: int, scratch: workspace.Scratch) -> DataFrame:
    """Links (a, b) within whole clusters of rows of ``_apart``: each two blocks of a cluster's members meet in one call."""
    sized = apart.withColumn("differs", F.concat("added", "lacked"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.size("differs")) / BLOCK_RUNS)).cast("long").alias("blocks")
    blocks = scratch.table(sized.groupBy("cluster").agg(blocks), "blocks")
    dealt = sized.join(workspace.small_side(blocks, 24), "cluster").withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))

    def run(own: pa.Table) -> pa.Table:
        lists = own.column("differs").combine_chunks()
        starts = lists.offsets.to_numpy().astype(np.int64)
        ids, roots, n, linked, block, lo, hi = (own.column(c).to_numpy() for c in ("id", "root", "n", "linked", "block", "lo", "hi"))
        found = met(ids, roots, n, linked, starts - starts[0], lists.flatten().to_numpy(), np.flatnonzero(block == lo), np.flatnonzero(block == hi), percent)
        return pa.table({"a": pa.array([max(x) for x in found], pa.int64()), "b": pa.array([min(x) for x in found], pa.int64())})

    pair = dealt.select("cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "root", "n", "linked", "differs")
    return scratch.table(pair.groupBy("cluster", "lo", "hi").applyInArrow(run, "a long, b long"), "met")


def _dense(groups: DataFrame, classes: DataFrame, documents: DataFrame, verify, scratch: workspace.Scratch, width: int, percent: int) -> DataFrame:
    """Links (a, b) that connect all that belong together in groups (band, id, root), beyond the components in root.

    Groups with the same largest component are one cluster.  Its pivot is the
    smallest set of that component.  Of two linked sets x, y of which x is not
    linked to the pivot, the runs that the pivot lacks overlap if y has the pivot's
    size at least, or x is not bare: |x - y| + |y - x| is at least |x - p| + |p - x|
    + |y| - |p| - 2 |shared added runs|.  So they meet on their rarest added runs,
    as many as the least overlap demands (prefix filter).  Else y is smaller than
    the pivot and x is bare.  What shares a frequent one of the rarest runs, and
    the sets that are smaller than the pivot or bare, are groups of the next turn,
    which lack the pivot.  A cluster of up to ``ALL_PAIRS`` members meets pairwise;
    one of up to ``BLOCKED`` is compared whole by its differences from the pivot
    (``_met``).  Each turn takes eight times these numbers, so turns come to an end.
    """
    sizes = classes.select("id", F.col("n_shingles").alias("n"))
    links = texts = None
    work, turn = groups, 0
    while True:
        by_root = work.groupBy("band", "root").agg(F.count("*").alias("k"))
        main = by_root.groupBy("band").agg(F.max(F.struct("k", "root")).alias("m"), F.count("*").alias("roots")).where("roots > 1")
        main = scratch.table(main.select("band", F.col("m.root").alias("cluster")), "main")
        own = scratch.table(work.join(workspace.small_side(main, 24), "band").select("cluster", "id", "root").distinct().join(sizes, "id"), "clusters")
        if own.isEmpty():
            return links if links is not None else own.select(F.col("id").alias("a"), F.col("root").alias("b"))
        most = ALL_PAIRS << 3 * turn
        few = own.join(own.groupBy("cluster").agg(F.count("*").alias("k")).where(F.col("k") <= ALL_PAIRS).select("cluster"), "cluster", "left_semi")
        side = lambda c: few.select("cluster", F.col("id").alias(c), F.col("root").alias(f"r{c}"), F.col("n").alias(f"n{c}"))
        fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
        direct = side("a").join(side("b"), "cluster").where("a < b and ra != rb").where(fits).select("a", "b")
        large = own.groupBy("cluster").agg(F.count("*").alias("k")).where(F.col("k") > ALL_PAIRS).select("cluster")
        own = scratch.table(own.join(large, "cluster", "left_semi"), "large")
        first = F.when(F.col("root") == F.col("cluster"), F.struct("n", "id"))
        pivots = scratch.table(own.groupBy("cluster").agg(F.min(first).alias("p"), F.min("n").alias("least"), F.count("*").alias("k")).select("cluster", F.col("p.id").alias("pivot"), F.col("p.n").alias("pn"), "least", "k"), "pivots")
        if texts is None:
            texts = _texts(documents, classes, own.select("id").distinct(), scratch)  # later turns have no other members
        of = scratch.table(pivots.join(texts.select(F.col("id").alias("pivot"), F.col("text").alias("pivot_text")), "pivot"), "pivots")
        total = of.agg(F.coalesce(F.sum(F.octet_length("pivot_text") + 48), F.lit(0)).alias("n")).first().n
        others = own.join(F.broadcast(of) if total <= workspace.BROADCAST_BYTES else of, "cluster").where("id != pivot").join(texts, "id")
        apart = scratch.table(_apart(others, width, percent), "apart")
        whole = _met(apart.where(F.col("k") <= BLOCKED << 3 * turn), percent, scratch)
        large = apart.where(F.col("k") > BLOCKED << 3 * turn)
        runs = large.select("cluster", "id", "root", "n", "linked", "need", F.explode("added").alias("run"))
        runs = scratch.table(runs, "runs")
        often = runs.groupBy("cluster", "run").agg(F.count("*").alias("k"), F.bool_or(~F.col("linked")).alias("far")).where("k > 1 and far")
        each = Window.partitionBy("cluster", "id")
        held = runs.join(often.select("cluster", "run", "k"), ["cluster", "run"]).withColumn("nth", F.row_number().over(each.orderBy("k", "run"))).withColumn("shared", F.count("*").over(each))
        held = scratch.table(held.where("nth <= shared - need + 1").drop("k", "nth", "shared", "need"), "prefixes")
        lists = held.groupBy("cluster", "run").agg(F.count("*").alias("k"), F.bool_or(~F.col("linked")).alias("far")).where("k > 1 and far")
        held = scratch.table(held.join(lists.select("cluster", "run", "k"), ["cluster", "run"]), "lists")
        rare = held.where(F.col("k") <= most)
        one = lambda c: rare.select("cluster", "run", F.col("id").alias(c), F.col("root").alias(f"r{c}"), F.col("n").alias(f"n{c}"), F.col("linked").alias(f"l{c}"))
        pairs = one("a").join(one("b"), ["cluster", "run"]).where("a < b and ra != rb and not (la and lb)").where(fits).select("a", "b").unionByName(direct).distinct()
        found = verify(scratch.table(pairs, "pairs")).unionByName(whole).unionByName(apart.where("linked and root != cluster").select(F.greatest("id", "pivot").alias("a"), F.least("id", "pivot").alias("b")))
        links = found if links is None else links.unionByName(found)
        again = held.where(F.col("k") > most).select(F.xxhash64(F.lit(turn), "cluster", "run").alias("band"), "id", "root")
        small = large.where("n < pn or bare").select(F.xxhash64(F.lit(turn), "cluster").alias("band"), "id", "root")
        work, turn = scratch.table(again.unionByName(small), "work"), turn + 1


def _components(documents: DataFrame, width: int, percent: int, scratch: workspace.Scratch) -> DataFrame:
    """One row per document: doc_id, th, n_shingles, component_id."""
    n_bands = bands_for(percent / 100)
    sets = scratch.table(_sets(documents, width, n_bands), "sets")
    known = sets.where("doc_id is not null")
    first = F.min(F.struct("doc_id", "th", "n_shingles", "signature")).alias("r")
    classes = known.where("n_shingles > 0").groupBy("print").agg(first, F.count("*").alias("rows"))
    # a class has a number of its own, for rows of several classes may share a doc_id
    classes = scratch.table(classes.select("print", "r.*", "rows").withColumn("id", F.monotonically_increasing_id()), "classes")
    bands = _bands(classes, n_bands)
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = scratch.table(bands.join(shared, "band").select("band", "id", "n"), "bands")
    few, many = members.where(F.col("n") <= ALL_PAIRS), members.where(F.col("n") > ALL_PAIRS)
    pairs = few.select("band", F.col("id").alias("a")).join(few.select("band", F.col("id").alias("b")), "band").where("a < b").select("a", "b").distinct()
    verify = lambda found: _verified(found, classes, documents, scratch, width, percent)
    links = verify(scratch.table(pairs, "pairs"))
    if not many.isEmpty():
        rest = lambda groups: _dense(groups, classes, documents, verify, scratch, width, percent)
        links = components.link_large(many.select("band", "id"), links, verify, scratch, rounds=1, rest=rest)
    roots = components.components(links, scratch)
    named = scratch.table(roots.join(classes.select(F.col("id").alias("node"), "doc_id"), "node"), "named")
    least = scratch.table(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    linked = scratch.table(named.join(workspace.small_side(least, 24), "root").select(F.col("node").alias("id"), "component_id"), "linked")
    # copies take their class's component; classes of one row that are in no link keep their doc_id
    moved = classes.select("print", "id", "doc_id", "rows").join(workspace.small_side(linked, 24), "id", "left").where("rows > 1 or component_id is not null")
    moved = scratch.table(moved.select("print", F.coalesce("component_id", "doc_id").alias("component_id")), "moved")
    found = known.join(workspace.small_side(moved, 48), "print", "left").select("doc_id", "th", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return found.unionByName(sets.where("doc_id is null").select("doc_id", "th", "n_shingles", F.lit(None).cast("long").alias("component_id")))


def near_dedup(documents: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (doc_id = component_id)."""
    with workspace.Scratch(documents.sparkSession) as scratch:
        out = _components(documents, width, percent, scratch).drop("th")
        return scratch.keep(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_copies(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """docs, all columns, with one document of each component."""
    with workspace.Scratch(docs.sparkSession) as scratch:
        found = _components(docs, width, percent, scratch)
        gone = scratch.keep(found.where("doc_id != component_id").select(F.col("doc_id").alias("__iw_id"), F.col("th").alias("__iw_th")).distinct())
    tagged = docs.withColumn("__iw_own", text_key())
    return tagged.join(workspace.small_side(gone, 24), (F.col("doc_id") == F.col("__iw_id")) & (F.col("__iw_own") == F.col("__iw_th")), "left_anti").select(*docs.columns)
