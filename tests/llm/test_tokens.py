"""Token operators against the library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from inkwright.llm import packing, token_counts, token_ids, tokens, workspace
from tests.llm import helpers


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokens.default_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_codec_equals_library(library):
    rng = random.Random(1)
    pool = "abc 'sT\n\t<|é́ß日1٣!. \xa0Σσς<|endoftext|>"
    texts = ["", "it's don't we'll 'street", "ẞ İ ﬁ K", "<|endoftext|>a", "x" * 900] + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    codec = tokens.codec(tokens.default_path())
    assert codec.by_word
    starts, ids = codec.encode(pa.array(texts, pa.large_string()))
    for k, t in enumerate(texts):
        assert ids[starts[k] : starts[k + 1]].tolist() == library(t), repr(t)


def test_other_tokenizers_take_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    codec = tokens.codec(path)
    assert not codec.by_word
    starts, ids = codec.encode(pa.array(["a b", "", " c"], pa.large_string()))
    assert ids[starts[2] : starts[3]].tolist() == Tokenizer.from_file(path).encode(" c", add_special_tokens=False).ids


def test_every_prefix_is_counted(library):
    codec = tokens.codec(tokens.default_path())
    for text in ["", "  a it's <|endoftext|> éx ", "日本 b é́ß'll", "uno  dos\ntres "]:
        table = token_counts.PrefixCounts(text, codec)
        want = [len(library(text[:k])) for k in range(len(text) + 1)]
        assert [table.count(k) for k in range(len(text) + 1)] == want
        for budget in range(6):
            assert table.fit(budget) == max(k for k, n in enumerate(want) if n <= budget)


def test_prefixes_of_many_words(library):
    """Against the library, each prefix of words of all kinds: joined scripts, contractions, signs, special strings, characters that grow when lower-cased."""
    rng = random.Random(4)
    prefixes = tokens.codec(tokens.default_path()).prefixes
    pool = ["the", "er", "ing", "tion", "'re", "'l", "'", "7", "!?", "İ", "Σ", "日本", "é", "ß", "<|", "<|endoftext|>", "|>", "\xa0", "strasse", "UN", "quick", "\u0301", "🙂"]
    words = [tokens.normal("".join(rng.choice(pool) for _ in range(rng.randint(1, 7)))) for _ in range(250)]
    for w in words:
        assert prefixes.counts(w).tolist() == [len(library(w[:k])) for k in range(len(w) + 1)], repr(w)


def test_a_word_of_a_million_characters(spark, library):
    rng = random.Random(5)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1_000_000))
    rows = [(1, "uno dos " + word), (2, "tres " * 300)]
    out = {r.doc_id: r for r in token_counts.token_counts(helpers.documents(spark, rows), limit=500).collect()}
    assert out[1].n_tokens == len(library(rows[0][1]))
    k = out[1].fit_chars
    counts = [len(library(rows[0][1][:j])) for j in range(k, k + 40)]
    assert counts[0] == out[1].fit_tokens <= 500 and min(counts[1:]) > 500
    assert out[2].n_tokens == out[2].fit_tokens == len(library(rows[1][1]))


def test_counts(spark, library):
    rows = helpers.odd_rows()
    out = token_counts.token_counts(helpers.documents(spark, rows), limit=50).collect()
    want = sorted(((r[0], len((r[1] or "").encode()), len(library(r[1] or ""))) for r in rows), key=repr)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in out), key=repr) == want
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for r in out:
        assert r.over_limit == (r.n_tokens > 50)
        if r.over_limit and r.doc_id not in (None, 10):
            counts = [len(library(texts[r.doc_id][:k])) for k in range(len(texts[r.doc_id]) + 1)]
            assert r.fit_chars == max(k for k, n in enumerate(counts) if n <= 50) and r.fit_tokens == counts[r.fit_chars]


def test_elias_fano():
    rng = np.random.default_rng(0)
    for values in ([], [0], [0, 0, 5], [2**63 + 5, 2**63 + 5, 2**64 - 1], np.sort(rng.integers(0, 10**9, 5000)), np.arange(70000) * 7):
        v = np.array(values, np.uint64)
        raw = token_ids.EliasFano.of(v).to_bytes()
        back = token_ids.EliasFano.from_bytes(raw)
        assert (back.all() == v).all()
        assert [back[i] for i in range(0, len(v), 97)] == [int(x) for x in v[::97]]
        for first, to in ((0, len(v)), (len(v) // 3, len(v) // 2), (len(v) // 2, len(v)), (0, min(1, len(v))), (2, 2)):
            assert (back.part(first, to) == v[first:to]).all()
        if len(v) > 1000:
            assert len(raw) * 8 <= len(v) * (3 + np.ceil(np.log2(float(v[-1]) / len(v)))) + 400


def test_files_give_the_ids_back(spark, library):
    rows = helpers.odd_rows()
    with workspace.Scratch(spark) as scratch:
        shards = token_ids.write_token_ids(helpers.documents(spark, rows), scratch.path("ids"))
        out = token_ids.read_token_ids(spark, shards).orderBy("start").collect()
        shard = token_ids.Shard(shards[0][0])
        assert shard.document(0).tolist() == out[0].ids
        with pytest.raises(IndexError):
            shard.bounds[shard.documents + 1]
        digests = token_ids.read_token_ids(spark, shards, digest=True).orderBy("start").collect()
        assert token_ids.write_token_ids(helpers.documents(spark, []), scratch.path("none")) == []
        assert token_ids.read_token_ids(spark, []).count() == 0
    assert [r.doc_id for r in out] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    assert sorted(((r.doc_id, r.ids) for r in out), key=repr) == sorted(((r[0], library(r[1] or "") + [1]) for r in rows), key=repr)
    assert [r.start for r in out] == np.cumsum([0] + [len(r.ids) for r in out])[:-1].tolist()
    assert [r.ids_crc32 for r in digests] == [zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in out]


def bins_of(patterns):
    return [[s for s, m in p.items for _ in range(m)] for p in patterns for _ in range(p.count)]


def test_histogram_packing():
    rng = random.Random(4)
    for capacity in (10, 64, 4096):
        for _ in range(30):
            sizes = [min(capacity, 1 + int(rng.expovariate(3 / capacity))) for _ in range(rng.randint(0, 300))]
            counts = {s: sizes.count(s) for s in sizes}
            bins = bins_of(packing.pack_histogram(counts, capacity))
            assert sorted(s for b in bins for s in b) == sorted(sizes)
            assert all(sum(b) <= capacity and sum(3 * s > capacity for s in b) <= 2 for b in bins)
            plain: list[int] = []  # first-fit decreasing
            for s in sorted(sizes, reverse=True):
                k = next((k for k, free in enumerate(plain) if free >= s), None)
                if k is None:
                    plain.append(capacity - s)
                else:
                    plain[k] -= s
            assert len(bins) <= len(plain) + 1 + len(plain) // 20
    with pytest.raises(ValueError):
        packing.pack_histogram({11: 1}, 10)


def test_packing(spark, library):
    rows = helpers.odd_rows()
    out = packing.best_fit_packing(helpers.documents(spark, rows), capacity=256).collect()
    want = []
    for r in rows:
        ids = library(r[1] or "") + [1]
        want += [(r[0], k, a, len(ids[a : a + 256]), zlib.crc32(np.array(ids[a : a + 256], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 256))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == sorted(want, key=repr)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert len(by) <= -(-sum(r.length for r in out) // 256) + 1
    assert packing.best_fit_packing(helpers.documents(spark, [])).count() == 0
