"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models with an L1
penalty over the words of a text (a word, and its first four and five letters,
present or not).  Each model also gets the probabilities of the categories before
it; in training these come from out-of-fold models, so that a later model sees
predictions as uncertain as those it will get.  A text is rejected if the last
category's probability reaches a threshold, chosen on out-of-fold predictions.

Models are fitted on at most ``SAMPLE`` labelled documents (those with the least
hash of their doc_id), whose whole texts count; of their words the ``FEATURES``
most associated with each category become features.  Scoring reads every text
whole and has no other limit: a model is a few hundred weights by word hash.

Null texts count as empty.  Of several texts of a labelled doc_id, the one with the
least hash is fitted.  Labels that are null or have no document are left
out; a category whose labels are all alike gets a constant.  Rows keep their
order of columns, repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.llm import workspace, words as W

SAMPLE = 6000
FEATURES = 512
FOLDS = 5
LEAST_DOCUMENTS = 4  # of the sample that a feature occurs in
SIGNS = ".,;:!?\"'()[]{}|*-–—…«»"


def _features(found: list[str]) -> list[tuple[int, ...]]:
    """Signed 64-bit hashes of a word's features."""
    out = []
    for w in found:
        names = {w} | {w[:k] + "*" for k in (4, 5) if len(w) > k}
        out.append(tuple(xxhash.xxh64_intdigest(x) - (1 << 63) for x in sorted(names)) if w else ())
    return out


def _distinct_words(text: pa.Array) -> tuple[W.Words, list[str]]:
    found = W.Words(pc.utf8_lower(text))
    return found, pc.utf8_trim(found.distinct, characters=SIGNS).to_pylist()


@dataclass
class Link:
    """One category: a constant, weights by feature, and weights of the categories before it."""

    category: str
    bias: float
    weights: dict[int, float]
    earlier: list[float]


@dataclass
class Chain:
    links: list[Link]
    threshold: float

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Feature hashes in order, and a row of weights (one for each category) for each."""
        keys = np.array(sorted({k for link in self.links for k in link.weights}), np.int64)
        rows = np.array([[link.weights.get(int(k), 0.0) for link in self.links] for k in keys]).reshape(len(keys), len(self.links))
        return keys, rows

    def logits(self, sums: np.ndarray) -> np.ndarray:
        """Logits of each category from the sums of its feature weights."""
        out = np.empty_like(sums)
        for k, link in enumerate(self.links):
            out[:, k] = np.clip(sums[:, k] + link.bias + sum((w * sigmoid(out[:, j]) for j, w in enumerate(link.earlier)), 0.0), -30, 30)
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


class Sparse:
    """Rows of present features (index[starts[i]:starts[i + 1]] of ``width``), and dense columns beside them; columns are scaled."""

    def __init__(self, starts: np.ndarray, index: np.ndarray, width: int, dense: np.ndarray):
        self.starts, self.index, self.width, self.dense = starts, index, width, dense
        n = max(1, len(dense))
        self.scale = np.concatenate((np.sqrt(np.bincount(index, minlength=width) / n), np.sqrt((dense * dense).mean(0)) if len(dense) else np.ones(dense.shape[1]))) + 1e-3

    def rows(self, kept: np.ndarray) -> Sparse:
        size = np.diff(self.starts)
        return Sparse(np.concatenate(([0], np.cumsum(size[kept]))), self.index[np.repeat(kept, size)], self.width, self.dense[kept])

    def times(self, w: np.ndarray) -> np.ndarray:
        """Products with unscaled weights."""
        return W.sums(w[: self.width][self.index], self.starts) + self.dense @ w[self.width :]

    def back(self, r: np.ndarray) -> np.ndarray:
        each = np.bincount(self.index, weights=np.repeat(r, np.diff(self.starts)), minlength=self.width)
        return np.concatenate((each, self.dense.T @ r))


def fit_logistic(x: Sparse, y: np.ndarray, l1: float = 2e-3, l2: float = 1e-4, steps: int = 150) -> tuple[np.ndarray, float]:
    """(weights, bias) by accelerated proximal gradient; dense columns carry no L1 penalty."""
    n, d = len(y), len(x.scale)
    if y.min() == y.max():
        return np.zeros(d), 8.0 if y[0] else -8.0
    times, back = lambda w: x.times(w / x.scale), lambda r: x.back(r) / x.scale
    penalty = np.full(d, l1)
    penalty[x.width :] = 0
    v = np.ones(d) / np.sqrt(d)
    for _ in range(12):  # largest curvature by power iteration
        v = back(times(v))
        v /= np.linalg.norm(v) + 1e-12
    rate = 1 / (0.25 * (float(np.linalg.norm(times(v))) ** 2 / n + 1) + l2)
    w, b = np.zeros(d), float(np.log(y.mean() / (1 - y.mean())))
    pw, pb, t = w, b, 1.0
    for _ in range(steps):
        r = sigmoid(np.clip(times(pw) + pb, -30, 30)) - y
        u = pw - rate * (back(r) / n + l2 * pw)
        nw, nb = np.sign(u) * np.maximum(np.abs(u) - rate * penalty, 0), pb - rate * float(r.mean())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        pw, pb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w / x.scale, b


def train(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE) -> Chain:
    """A chain over the 0/1 columns ``categories`` of labels (doc_id, ...), in this order."""
    spark = docs.sparkSession
    with workspace.Scratch(spark) as scratch:
        full = labels.where(" and ".join(f"`{c}` is not null" for c in ["doc_id", *categories])).groupBy("doc_id").agg(*(F.max(c).cast("int").alias(c) for c in categories))
        chosen = full.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = scratch.table(chosen, "chosen")

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo = W.Memo(_features)
            for batch in batches:
                text = W.texts(batch.column("text"))
                for at, part in W.slices(text):
                    found, names = _distinct_words(part)
                    of = memo.of(names)
                    lists = [sorted({f for i in set(found.index[a:b].tolist()) for f in of[i]}) for a, b in zip(found.starts[:-1], found.starts[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(at, len(part)) for c in ("doc_id", *categories)), pa.array(lists, pa.list_(pa.int64())), batch.column("th").slice(at, len(part))], names=["doc_id", *categories, "features", "th"])

        # at most ``sample`` small rows are broadcast
        labelled = docs.select("doc_id", "text", F.xxhash64("text").alias("th")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "th", *categories)
        rows = scratch.table(labelled.mapInArrow(W.tidy(read), f"doc_id long, {', '.join(f'`{c}` int' for c in categories)}, features array<long>, th long"), "features")
        rows = scratch.table(rows.groupBy("doc_id", *categories).agg(F.min(F.struct("th", "features")).alias("r")).select("doc_id", *categories, "r.features"), "rows")
        total = rows.agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in categories)).first()
        if not total.n:
            return Chain([Link(c, -8.0, {}, [0.0] * k) for k, c in enumerate(categories)], 0.5)
        stats = rows.select(F.explode("features").alias("f"), *categories).groupBy("f").agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in categories)).where(F.col("n") >= LEAST_DOCUMENTS)
        stats = scratch.table(stats, "stats")
        best: set[int] = set()
        for c in categories:
            p = float(total[c]) / total.n
            if 0 < p < 1:
                chi = (F.col(c) - F.col("n") * p) ** 2 / (F.col("n") * p * (1 - p))
                best |= {r.f for r in stats.orderBy(chi.desc(), "f").limit(FEATURES).select("f").collect()}
        vocabulary = np.array(sorted(best), np.int64)
        wanted = spark.createDataFrame([(int(f), i) for i, f in enumerate(vocabulary)], "f long, i int")
        used = rows.select("doc_id", F.explode("features").alias("f")).join(F.broadcast(wanted), "f").groupBy("doc_id").agg(F.sort_array(F.collect_list("i")).alias("i"))
        # bounded: sample rows of at most FEATURES numbers a category
        gathered = rows.select("doc_id", *categories).join(used, "doc_id", "left").orderBy("doc_id").toArrow()
    own = [i or [] for i in gathered["i"].to_pylist()]
    starts = np.concatenate(([0], np.cumsum([len(i) for i in own])))
    index = np.array([f for i in own for f in i], np.int64)
    y = {c: gathered[c].to_numpy().astype(np.float64) for c in categories}
    fold = np.array([xxhash.xxh64_intdigest(str(i)) % FOLDS for i in gathered["doc_id"].to_pylist()])
    earlier, held, d = np.zeros((len(own), 0)), np.zeros(len(own)), len(vocabulary)
    links = []
    for c in categories:
        x = Sparse(starts, index, d, earlier)
        held = np.zeros(len(own))
        for k in range(FOLDS):
            inside = fold != k
            if inside.any() and not inside.all():
                w, b = fit_logistic(x.rows(inside), y[c][inside])
                held[~inside] = np.clip(x.rows(~inside).times(w) + b, -30, 30)
        w, b = fit_logistic(x, y[c])
        links.append(Link(c, float(b), {int(vocabulary[i]): float(w[i]) for i in np.flatnonzero(w[:d])}, [float(v) for v in w[d:]]))
        earlier = np.hstack((earlier, sigmoid(held)[:, None]))
    return Chain(links, _threshold(sigmoid(held), y[categories[-1]]))


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap between probabilities at which F1 is best."""
    if y.min() == y.max():
        return 0.5
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    f1 = 2 * right / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][p[order][:-1] == p[order][1:]] = -1
    k = int(np.argmax(f1))
    below = p[order][k + 1] if k + 1 < len(y) else 0.0
    return float((p[order][k] + below) / 2)


def _scorer(chain: Chain):
    keys, rows = chain.tables()
    place = {int(k): i for i, k in enumerate(keys)}
    memo = W.Memo(lambda found: [tuple(place[f] for f in own if f in place) for own in _features(found)])

    def score(part: pa.Array) -> np.ndarray:
        """Probabilities (texts, categories) of a slice of texts."""
        found, names = _distinct_words(part)
        of = memo.of(names)
        tells = np.fromiter(map(len, of), np.int64, len(of))
        sums = np.zeros((len(part), len(chain.links)))
        at = np.flatnonzero(tells[found.index]) if len(of) else np.zeros(0, np.int64)
        if at.size:
            doc = np.searchsorted(found.starts, at, side="right") - 1
            pairs = sorted({(d, f) for d, i in zip(doc.tolist(), found.index[at].tolist(), strict=True) for f in of[i]})
            d, f = np.array(pairs).T
            np.add.at(sums, d, rows[f])
        return sigmoid(chain.logits(sums))

    return score


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """One row per document: doc_id, p_<category> for each, and toxic (the last one reaches the threshold)."""
    names = [link.category for link in chain.links]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _scorer(chain)
        for batch in batches:
            text = W.texts(batch.column("text"))
            for at, part in W.slices(text):
                p = of(part)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)).cast(pa.int64()), *(pa.array(np.ascontiguousarray(c)) for c in p.T), pa.array(p[:, -1] >= chain.threshold)], names=["doc_id", *(f"p_{c}" for c in names), "toxic"])

    return workspace.bounded(docs).select("doc_id", "text").mapInArrow(W.tidy(run), f"doc_id long, {', '.join(f'`p_{c}` double' for c in names)}, toxic boolean")


def drop_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """docs, all columns, without the rows that the chain rejects."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _scorer(chain)
        for batch in batches:
            text = W.texts(batch.column("text"))
            for at, part in W.slices(text):
                yield batch.slice(at, len(part)).filter(pa.array(of(part)[:, -1] < chain.threshold))

    return workspace.bounded(docs).mapInArrow(W.tidy(run), docs.schema)


#: Languages that are categories of their own; toxic documents of others count in the last category alone.
LANGUAGES = 8


def by_language(docs: DataFrame, labels: DataFrame, most: int = LANGUAGES) -> tuple[DataFrame, list[str]]:
    """Labels (doc_id, toxic) as categories: toxic in each of the most frequent labelled languages, then toxic at all.

    The language is the document's own; the categories' order is that of their names, with ``toxic`` last.
    """
    of = docs.where("lang is not null").groupBy("doc_id").agg(F.min("lang").alias("_lang"))
    known = labels.where("toxic is not null").select("doc_id", "toxic").join(of, "doc_id", "left")
    top = [r["_lang"] for r in known.where("_lang is not null").groupBy("_lang").agg(F.sum("toxic").alias("n")).where("n > 0").orderBy(F.desc("n"), "_lang").limit(most).collect()]
    names = {x: f"toxic_{k}" for k, x in enumerate(sorted(top))} if any(not x.isidentifier() for x in top) else {x: f"toxic_{x}" for x in sorted(top)}
    return known.select("doc_id", *(((F.col("toxic") == 1) & F.col("_lang").eqNullSafe(F.lit(x))).cast("int").alias(n) for x, n in names.items()), "toxic"), [*names.values(), "toxic"]
