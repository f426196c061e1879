"""License scans: MinHash bands over overlapping windows, then exact containment.

Texts are cut into words (A-Z lowered, signs at the ends dropped) and runs of
``WIDTH`` words.  A template's windows have as many runs as the largest power of
two that it holds, one beginning at each run.  Documents are cut into windows of
the same lengths that begin every eighth of a window (every run, for short
ones), so an unbroken copy of a template has windows equal to the template's
own.  Windows whose MinHash signatures agree in a band retrieve the template; those
without a run of any template can't agree and aren't signed.
Bands are as many as make a window of similarity ``similarity``, or of the lesser
one that ``containment`` implies (``window_similarity``), collide with probability
1 - ``miss`` (``bands_for``).  Texts with fewer runs than a window are looked at whole.  Around each retrieved window the share
of the template's distinct runs that the document holds is then counted exactly;
from ``containment`` on it is a match.

Templates are a fixed, small list, so nothing is shuffled; each has at least
``WIDTH`` words.  Null texts count as empty and
match nothing; repeated rows match alike; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from inkwright.llm import words as W, workspace

WIDTH = 5
ROWS = 2
SIGNS = ".,;:!?\"'()[]{}|*`-–—…«»"
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)

#: Public notices and headers, by SPDX identifier and form.
TEMPLATES = {
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT/notice": "Released under the MIT License.",
    "MIT/header": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "GPL-3.0/notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "CC-BY-NC-4.0/notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0/notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD-2-Clause/header": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "MPL-2.0/header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC/header": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}


def bands_for(similarity: float, rows: int, miss: float) -> int:
    """The fewest bands of so many rows in which windows of this similarity collide with probability 1 - miss."""
    return ceil(log(miss) / log(1 - similarity**rows))


def collision(similarity: float, bands: int, rows: int) -> float:
    return 1 - (1 - similarity**rows) ** bands


def window_similarity(containment: float) -> float:
    """What a document's window has at least, on average over a copy with this share of a template's runs, the others replaced, half a step beside the template's window."""
    shared = containment - 1 / 16
    return shared / (2 - shared)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _hash(found: list[str]) -> list[int]:
    return [xxhash.xxh64_intdigest(w) if w else 0 for w in found]


def runs(text: pa.Array, memo: W.Memo) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, hashes, starts of words, places): the runs of each text, and the place of each word among the text's words."""
    found = W.Words(pc.ascii_lower(text))
    names = pc.utf8_trim(found.distinct, characters=SIGNS).to_pylist()
    value = np.array(memo.of(names), np.uint64)
    own = value[found.index] if len(value) else np.zeros(0, np.uint64)
    kept = own != 0
    place = np.arange(len(own)) - np.repeat(found.starts[:-1], np.diff(found.starts))
    words = np.concatenate(([0], np.cumsum(kept)))[found.starts]
    own, place = own[kept], place[kept]
    n = np.maximum(np.diff(words) - WIDTH + 1, 0)
    starts = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(words[:-1] - starts[:-1], n) + np.arange(starts[-1])
    out = np.full(len(at), np.uint64(WIDTH))
    for k in range(WIDTH):
        out = (out ^ own[at + k]) * MIX[k]
        out ^= out >> np.uint64(32)
    return starts, _finish(out), words, place


class Index:
    """Windows of the templates by band, and their sets of runs."""

    def __init__(self, templates: dict[str, str], similarity: float, miss: float):
        self.bands = bands_for(similarity, ROWS, miss)
        raw = b"".join(hashlib.blake2b(b"window%d" % k, digest_size=8).digest() for k in range(self.bands * ROWS))
        self.multipliers = np.frombuffer(raw, "<u8") | np.uint64(1)
        self.names = sorted(templates)
        starts, hashes, words, _ = runs(pa.array([templates[n] for n in self.names], pa.large_string()), W.Memo(_hash))
        if short := [n for n, a, b in zip(self.names, starts[:-1], starts[1:], strict=True) if a == b]:
            raise ValueError(f"templates need {WIDTH} words: {short}")
        self.sets = [np.unique(hashes[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        self.any = np.unique(hashes)
        self.low = np.zeros(1 << 16, bool)  # by the last 16 bits, for a first look
        self.low[(self.any & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.length = np.diff(starts)
        self.words = np.diff(words)
        self.size = 1 << (np.log2(self.length).astype(int))
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in np.unique(self.size).tolist():
            keys, own = [], []
            for t in np.flatnonzero(self.size == size):
                sig = self.signatures(hashes[starts[t] : starts[t + 1]], np.arange(self.length[t] - size + 1), size)
                keys.append(sig.ravel())
                own.append(np.full(sig.size, t))
            k, t = np.concatenate(keys), np.concatenate(own)
            pairs = np.unique(np.stack((k.view(np.int64), t), 1), axis=0)
            order = np.argsort(pairs[:, 0].view(np.uint64), kind="stable")
            self.levels[size] = pairs[order, 0].view(np.uint64), pairs[order, 1]

    def signatures(self, hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
        """Band keys (windows, bands) of the windows of size runs that begin at first, which are evenly spaced."""
        step = int(first[1] - first[0]) if len(first) > 1 else size
        out = np.empty((len(first), self.bands), np.uint64)
        lows = []
        for m in self.multipliers:
            h = hashes * m
            if step > 1:
                h = np.minimum.reduceat(h, np.arange(0, len(h), step))
            lows.append(_slide(h, size // step)[: len(first)] if step > 1 else _slide(h, size)[first])
        for b in range(self.bands):
            key = np.full(len(first), np.uint64(b + 1))
            for low in lows[b * ROWS : (b + 1) * ROWS]:
                key = (key ^ (low >> np.uint64(20))) * MIX[1]
                key ^= key >> np.uint64(29)
            out[:, b] = key
        return out


def _slide(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n values in a row, n a power of two, by doubling."""
    k = 1
    while k < n:
        h = np.minimum(h[: len(h) - k], h[k:])
        k *= 2
    return h


def _stretches(known: np.ndarray, size: int, step: int, total: int) -> list[tuple[int, int]]:
    """(first, end) of the beginnings of windows, a multiple of step each, that hold one of the known places at least, joined where they meet."""
    last = (total - size) // step * step
    if last < 0 or not known.size:
        return []
    low = np.minimum(np.maximum(known - size + 1, 0) + step - 1, total) // step * step
    high = np.minimum(known // step * step, last)
    fits = low <= high
    low, high = low[fits], high[fits]
    if not low.size:
        return []
    new = np.flatnonzero(np.concatenate(([True], low[1:] > high[:-1] + step)))
    return list(zip(low[new].tolist(), (high[np.append(new[1:] - 1, len(high) - 1)] + 1).tolist(), strict=True))


def _look(index: Index, starts: np.ndarray, hashes: np.ndarray, containment: float) -> list[tuple[int, int, int, int, float]]:
    """(text, template, first run, runs, containment) of the matches in the texts of a slice."""
    found: set[tuple[int, int, int]] = set()
    # a window that holds no run of any template has no minimum in common with theirs, so only stretches around such runs have windows to sign
    known = np.flatnonzero(index.low[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    known = known[np.isin(hashes[known], index.any)]
    for size, (keys, own) in index.levels.items():
        step = max(1, size // 8)
        for low, high in _stretches(known, size, step, len(hashes)):
            first = np.arange(low, high, step)
            sig = index.signatures(hashes[low : int(first[-1]) + size], first - low, size)
            hit = np.flatnonzero(np.isin(sig, keys).any(1))
            for w in hit.tolist():
                for key in sig[w]:
                    for t in own[np.searchsorted(keys, key, "left") : np.searchsorted(keys, key, "right")].tolist():
                        found.add((t, int(first[w]), size))
    # texts with fewer runs than the window are looked at whole
    n = np.diff(starts)
    for t, size in enumerate(index.size.tolist()):
        for doc in np.flatnonzero((n < size) & (n >= containment * len(index.sets[t]))).tolist():
            found.add((t, int(starts[doc]), int(n[doc])))
    out: dict[tuple[int, int], list[tuple[int, int, int, int, float]]] = {}
    for t, at, size in sorted(found):
        length = int(index.length[t])
        # a window may reach over the end of its text: each text that it touches is looked at
        for doc in range(int(np.searchsorted(starts, at, "right")) - 1, int(np.searchsorted(starts, at + size - 1, "right"))):
            lo, hi = max(int(starts[doc]), at - length), min(int(starts[doc + 1]), at + size + length)
            if lo >= hi:
                continue
            inside = np.flatnonzero(np.isin(hashes[lo:hi], index.sets[t]))
            share = len(np.unique(hashes[lo:hi][inside])) / len(index.sets[t])
            if share < containment:
                continue
            match = (doc, t, lo + int(inside[0]) - int(starts[doc]), int(inside[-1] - inside[0]) + 1, share)
            before = out.setdefault((doc, t), [])
            if before and match[2] < before[-1][2] + before[-1][3]:  # the same copy, seen from another window
                if share > before[-1][4]:
                    before[-1] = match
            else:
                before.append(match)
    return sorted(m for ms in out.values() for m in ms)


MATCHES = "doc_id long, license string, first_word long, n_words long, containment double"


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = 0.8, similarity: float = 0.8, miss: float = 1e-4) -> DataFrame:
    """One row per match: doc_id, license, first_word (from 0, among the text's words), n_words, containment."""
    listed = templates or TEMPLATES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(listed, min(similarity, window_similarity(containment)), miss)
        memo = W.Memo(_hash, 150_000)
        for batch in batches:
            text = W.texts(batch.column("text"))
            ids = batch.column("doc_id")
            for at, part in W.slices(text, 2 << 20):
                starts, hashes, words, place = runs(part, memo)
                rows = []
                for doc, t, first, n, share in _look(index, starts, hashes, containment):
                    a = int(place[words[doc] + first])
                    b = int(place[words[doc] + first + n - 1 + WIDTH - 1])
                    rows.append({"doc_id": ids[at + doc].as_py(), "license": index.names[t], "first_word": a, "n_words": b - a + 1, "containment": share})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64())]))

    return workspace.bounded(docs).select("doc_id", "text").mapInArrow(W.tidy(scan), MATCHES)
