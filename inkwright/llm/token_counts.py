"""Token counts by prefix dynamic programming.

A text's count at a prefix is its count at the last word end before it plus the
count of the started word.  Counts at word ends are one addition for each word,
each distinct word being encoded once; within a word, ``tokens.Prefixes`` fills a
table of the counts of all its prefixes, from left to right, each from a shorter
prefix at most one token back.  The table answers how many tokens any prefix has
and how long a prefix a budget allows, without encoding the text again, whatever
the length of its words.

Prefixes are counted in characters of the text in NFC, the form that is encoded.
Null texts count as empty.  Rows pass through as they are: repeated rows and
rows without doc_id each get their own result; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from inkwright.llm import tokens, words as W, workspace

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long, fit_tokens long"
WORD = re.compile("[^\x20\x09-\x0D]+")


class PrefixCounts:
    """Exact token counts of every prefix of one text, by its length in characters of the text in NFC."""

    def __init__(self, text: str, codec: tokens.Codec):
        if not codec.by_word:
            raise ValueError("prefix counts need a tokenizer that never joins across white space")
        text = tokens.normal(text)
        self.counts = np.zeros(len(text) + 1, np.int64)
        before = at = 0
        for m in WORD.finditer(text):
            self.counts[at : m.start()] = before
            self.counts[m.start() : m.end() + 1] = before + codec.prefixes.counts(m.group())
            before, at = int(self.counts[m.end()]), m.end()
        self.counts[at:] = before

    def count(self, chars: int) -> int:
        """Tokens of the first chars characters."""
        return int(self.counts[chars])

    def fit(self, budget: int) -> int:
        """The longest prefix, in characters, that has at most budget tokens."""
        fits = np.flatnonzero(self.counts <= budget)
        return int(fits[-1]) if fits.size else 0


def _fit(text: str, before: np.ndarray, budget: int, codec: tokens.Codec) -> tuple[int, int]:
    """(characters, tokens) of the longest prefix within budget, from the counts before each word and after the last.

    Counts at word ends never fall, so the answer lies in the first word that
    passes the budget, or before it.  Of that word no more characters are looked
    at than the tokens that are left can cover.
    """
    k = int(np.searchsorted(before, budget, side="right")) - 1  # words that fit whole
    raw = text.encode()
    start, end = _span(raw, k)
    room = budget - int(before[k])
    head = raw[start : min(end, start + (room + 1) * codec.prefixes.longest)].decode(errors="ignore")
    counts = codec.prefixes.counts(head)
    j = int(np.flatnonzero(counts <= room)[-1])
    return len(raw[:start].decode()) + j, int(before[k] + counts[j])


def _span(raw: bytes, k: int) -> tuple[int, int]:
    """(start, end) of the k-th word in bytes."""
    b = np.frombuffer(raw, np.uint8)
    word = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    return int(np.flatnonzero(edge == 1)[k]), int(np.flatnonzero(edge == -1)[k])


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = 2048) -> DataFrame:
    """One row per document: n_bytes (UTF-8), n_tokens, whether they pass limit, and the longest prefix within it.

    fit_chars and fit_tokens are that prefix's length in characters (of the text in
    NFC) and its count (null for a long text of a tokenizer that joins across
    white space).
    """
    path = tokenizer or tokens.default_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = tokens.codec(path)
        for batch in batches:
            text = W.texts(batch.column("text"))
            for at, part in W.slices(text):
                size = pc.binary_length(part).to_numpy(zero_copy_only=False)
                if codec.by_word:
                    starts, before = codec.counts(part)
                    total = np.diff(before[starts])
                else:
                    starts, _ = codec.encode(part)
                    total, before = np.diff(starts), None
                chars, fit = pc.utf8_length(pc.utf8_normalize(part, form="NFC")).to_numpy(zero_copy_only=False).astype(np.int64), total.copy()
                for i in np.flatnonzero(total > limit):
                    if before is None:
                        chars[i] = fit[i] = -1
                    else:
                        own = before[starts[i] : starts[i + 1] + 1]
                        chars[i], fit[i] = _fit(tokens.normal(part[int(i)].as_py()), own - own[0], limit, codec)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)).cast(pa.int64()), *(pa.array(x.astype(np.int64)) for x in (size, total)), pa.array(total > limit), *(pa.array(x, mask=x < 0) for x in (chars, fit))],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars", "fit_tokens"],
                )

    return workspace.bounded(docs).select("doc_id", "text").mapInArrow(W.tidy(count, keeps=True), SCHEMA)
