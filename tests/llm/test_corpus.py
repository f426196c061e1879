"""Toxicity, licenses, media, mixing and the pipeline."""

import hashlib
import random
import re
import zlib
from urllib.parse import urlparse

import numpy as np
import pytest

from inkwright.llm import license_scan, media, mixing, toxicity, workspace
from tests.llm import helpers


def toxic_rows():
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(400):
        words = helpers.prose(rng, 40).split()
        lang, toxic = rng.choice(["en", "de"]), i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["slurword,", "Badword."]) if lang == "en" else "schimpf" + rng.choice("abcdefgh")
        rows.append((i, " ".join(words), lang, "s"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_chain_separates_held_out_documents(spark):
    rows, labels = toxic_rows()
    docs = helpers.documents(spark, [*rows, (900, None, None, None), (901, "", "en", "s"), (None, "x", "en", "s")])
    known = spark.createDataFrame([x for x in labels if x[0] < 250], "doc_id long, quality int, toxic int")
    own, categories = toxicity.by_language(docs, known)
    assert categories == ["toxic_de", "toxic_en", "toxic"]
    chain = toxicity.train(docs, own, categories)
    assert [len(x.earlier) for x in chain.links] == [0, 1, 2]
    out = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    truth = {i: bool(t) for i, _, t in labels}
    wrong = [i for i in range(250, 400) if out[i].toxic != truth[i]]
    assert len(wrong) <= 3
    assert not out[900].toxic and not out[901].toxic and not out[None].toxic
    kept = toxicity.drop_toxic(docs, chain)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if not r.toxic}


def test_scores_equal_a_plain_sum(spark):
    """Each document's probabilities from its words' weights, one by one."""
    rows, labels = toxic_rows()
    docs = helpers.documents(spark, [*rows, (900, None, None, None), (900, "Badword. slurword", None, None)])
    own, categories = toxicity.by_language(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    chain = toxicity.train(docs, own, categories)
    got = sorted([(r.doc_id, *(round(r[f"p_{c}"], 9) for c in categories), r.toxic) for r in toxicity.score(docs, chain).collect()])
    want = []
    for i, text, *_ in [*rows, (900, None), (900, "Badword. slurword")]:
        words = {w.strip(toxicity.SIGNS) for w in (text or "").lower().split()}
        found = {f for w in words for f in toxicity._features([w])[0]}
        p = []
        for link in chain.links:
            z = link.bias + sum(link.weights.get(f, 0.0) for f in found) + sum(w * q for w, q in zip(link.earlier, p, strict=True))
            p.append(1 / (1 + np.exp(-min(30, max(-30, z)))))
        want.append((i, *(round(float(x), 9) for x in p), bool(p[-1] >= chain.threshold)))
    assert got == sorted(want)


def test_fitting_takes_one_text_of_a_doc_id(spark):
    """Whatever the order of rows, the same text of a repeated doc_id is fitted."""
    rows, labels = toxic_rows()
    docs = helpers.documents(spark, [*rows, *((i, f"otro texto {i}", "en", "s") for i in range(0, 400, 3))])
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chains = [toxicity.train(d, *toxicity.by_language(d, known)) for d in (docs, docs.orderBy("text").repartition(7))]
    assert chains[0].threshold == chains[1].threshold and chains[0].links == chains[1].links


def test_chain_without_labels(spark):
    docs = helpers.documents(spark, helpers.odd_rows())
    none = spark.createDataFrame([(1, 1, None), (None, 1, 1), (777, 0, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs, *toxicity.by_language(docs, none))
    assert not any(r.toxic for r in toxicity.score(docs, chain).collect())


def test_license_bands_and_matches(spark):
    bands = license_scan.bands_for(0.8, license_scan.ROWS, 1e-4)
    assert license_scan.collision(0.8, bands, license_scan.ROWS) >= 1 - 1e-4 > license_scan.collision(0.8, bands - 1, license_scan.ROWS)
    rng = random.Random(2)
    apache = license_scan.TEMPLATES["Apache-2.0/header"].split()
    edited = list(apache)
    for k in (20, 60):
        edited[k] = "otra"
    texts = [
        helpers.prose(rng, 30) + " licensed under CC BY-NC 4.0. " + helpers.prose(rng, 30), helpers.prose(rng, 500), " ".join(edited) + " " + helpers.prose(rng, 3), helpers.prose(rng, 80) + "\n# " + "\n# ".join(apache) + "\n" + " ".join(apache),
        "Licensed under the", "", None, "Released under the MIT License. Released under the MIT License.",
    ]
    out = license_scan.license_scan(helpers.documents(spark, list(enumerate(texts)))).orderBy("doc_id", "license", "first_word").collect()
    got = [(r.doc_id, r.license) for r in out]
    assert (0, "CC-BY-NC-4.0/notice") in got and (2, "Apache-2.0/header") in got and (3, "Apache-2.0/header") in got
    assert {d for d, _ in got} == {0, 2, 3, 7}
    by = {(r.doc_id, r.license): r for r in out}
    assert (by[0, "CC-BY-NC-4.0/notice"].first_word, by[0, "CC-BY-NC-4.0/notice"].n_words) == (30, 5)
    shingles = lambda ws: {tuple(re.sub(r"^\W+|\W+$", "", w.lower()) for w in ws[i : i + 5]) for i in range(len(ws) - 4)}
    assert by[2, "Apache-2.0/header"].containment == pytest.approx(len(shingles(edited) & shingles(apache)) / len(shingles(apache)), abs=0.02)
    assert license_scan.license_scan(helpers.documents(spark, [])).count() == 0


def test_media_round_trip(spark):
    rows = helpers.odd_rows()
    docs = helpers.documents(spark, rows)
    with workspace.Scratch(spark) as scratch:
        out = scratch.path("media")
        written = media.write_archives(docs, out)
        assert sum(n for _, n in written) == len(rows)
        read = media.features(media.read_archives(spark, out, [u for u, _ in written], range_bytes=3000)).collect()
        want = []
        for r in rows:
            raw = (r[1] or "").encode()
            padded = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
            png = media.to_png(raw)
            want.append((r[0], len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]), len(png), hashlib.sha256(png).hexdigest()))
            size, samples = media.from_png(png)
            assert size == len(raw) and samples.tobytes() == padded
        assert sorted((tuple(r)[:7] for r in read), key=repr) == sorted(want, key=repr)
        # one damaged member is told, and only that one
        path = urlparse(written[0][0]).path
        with open(path, "r+b") as f:
            f.seek(60)
            byte = f.read(1)
            f.seek(60)
            f.write(bytes([byte[0] ^ 255]))
        bad = media.read_archives(spark, out, [written[0][0]]).collect()
        assert [r.error is not None for r in sorted(bad, key=lambda r: r.offset)] == [True] + [False] * (len(bad) - 1)
        empty = scratch.path("none")
        assert media.write_archives(helpers.documents(spark, []), empty) == []


def fill(sizes, weights=(3, 1, 2)):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    full, left = {}, set(names)
    while left:
        level = (1.5 * sum(sizes.values()) - sum(full.values())) / sum(w[s] for s in left)
        over = [s for s in left if level * w[s] > 2 * sizes[s]]
        if not over:
            return full | {s: level * w[s] for s in left}
        full |= {s: 2.0 * sizes[s] for s in over}
        left -= set(over)
    return full


def test_mixing(spark):
    rng = random.Random(6)
    rows = [(k, helpers.prose(rng, rng.randint(1, 60)), "en", rng.choice(["a", "b", "ñ", "zz", None, "b"])) for k in range(500)] + [r[:4] for r in helpers.odd_rows()]
    docs = helpers.documents(spark, rows)
    weights = spark.createDataFrame([(k, 2.0 if k % 2 else 0.5) for k in range(0, 400)], "doc_id long, weight double")
    out = mixing.mix(docs, weights).collect()
    assert len(out) == len(rows)
    words = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    targets = fill(sizes)
    taken = {}
    by_size = {round(v): s for s, v in sizes.items()}
    for r in out:
        assert 0 <= r.taken <= 2 * r.size
        s = by_size[r.source_size]
        assert r.target == pytest.approx(targets[s])
        taken[s] = taken.get(s, 0) + r.taken
        if sizes[s]:
            assert r.taken >= int(targets[s] / sizes[s]) * r.size
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    again = mixing.mix(docs.repartition(3), weights)
    assert helpers.rows_of(again, "doc_id", "size", "taken") == sorted([(r.doc_id, r.size, r.taken) for r in out], key=repr)
    assert mixing.mix(helpers.documents(spark, [])).count() == 0
    whole = mixing.mixed(docs, weights)
    assert whole.columns == docs.columns
    assert {r.text for r in whole.collect()} <= {r[1] for r in rows}


def test_mixing_prefers_quality(spark):
    rows = [(k, "una dos tres cuatro", "en", f"s{k % 3}") for k in range(3000)]
    weights = spark.createDataFrame([(k, 4.0 if k % 2 else 0.25) for k in range(3000)], "doc_id long, weight double")
    out = mixing.mix(helpers.documents(spark, rows), weights).where("target < source_size").collect()
    share = lambda odd: np.mean([r.taken > 0 for r in out if r.doc_id % 2 == odd])
    # the source between gives five sixths of its words: all of the heavy half, so two thirds of the light one
    assert share(1) > 0.99 and 0.6 < share(0) < 0.7


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows, labels = toxic_rows()
    rng = random.Random(8)
    near = rows[1][1].split()
    rows += [(500, rows[1][1].replace(" ", "  "), "en", "s"), (501, helpers.prose(rng, 300), "en", "t"), (502, None, None, None), (503, "", "en", None)]
    rows.append((504, " ".join([*rows[-3][1].split()[:-1], "fin"]), "en", "t"))
    assert near
    docs = helpers.documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = docs
    counts = []
    with workspace.Scratch(spark) as scratch:
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = scratch.table(stage(spark, at, str(tmp_path)))
            assert at.columns == docs.columns
            counts.append({r.doc_id for r in at.select("doc_id").collect()})
    toxic = {i for i, _, t in labels if t}
    assert len(counts[0] & toxic) <= 2 and len(counts[0]) >= len(rows) - len(toxic) - 2
    assert 500 in counts[0] and 500 not in counts[1] and 1 in counts[1]
    assert {501, 504} <= counts[1] and 501 in counts[2] and 504 not in counts[2]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert {r.doc_id for r in out.select("doc_id").collect()} == counts[3]


def test_license_in_a_text_shorter_than_the_window(spark):
    """Alone in its slice or not, a text with 60 of a template's 70 runs is a match."""
    words = [f"w{k}" for k in range(74)]
    short = " ".join(words[:64])
    for texts in ([short], [short, "a b c " * 100]):
        out = license_scan.license_scan(helpers.documents(spark, list(enumerate(texts))), {"T": " ".join(words)}).collect()
        assert [(r.doc_id, r.first_word, r.n_words, round(r.containment, 3)) for r in out] == [(0, 0, 64, 0.857)]


def test_licenses_equal_brute_force(spark):
    """Every template against every document by exact containment: copies whole, cut, with words replaced, wrapped as comments, twice, beside other notices."""
    rng = random.Random(13)
    texts = []
    for k in range(160):
        name = rng.choice(sorted(license_scan.TEMPLATES))
        words = license_scan.TEMPLATES[name].split()
        if rng.random() < 0.4:
            words = words[rng.randrange(1 + len(words) // 4) :]
        for _ in range(rng.choice([0, 0, 1, len(words) // 25, len(words) // 12])):
            words[rng.randrange(len(words))] = f"otra{rng.randint(0, 9)}"
        body = "\n# ".join(" ".join(words[i : i + 8]) for i in range(0, len(words), 8)) if rng.random() < 0.3 else " ".join(words)
        texts.append(helpers.prose(rng, rng.choice([0, 3, 50, 400])) + "\n" + body.upper() if k % 9 == 0 else helpers.prose(rng, rng.choice([0, 3, 50, 400])) + " " + body + " " + helpers.prose(rng, rng.choice([0, 2, 100])))
    runs = lambda t: {tuple(ws[i : i + 5]) for ws in [[x for x in (w.strip(license_scan.SIGNS) for w in t.lower().split()) if x]] for i in range(len(ws) - 4)}
    templates = {n: runs(t) for n, t in license_scan.TEMPLATES.items()}
    want = {(i, n): len(runs(t) & own) / len(own) for i, t in enumerate(texts) for n, own in templates.items()}
    got = {(r.doc_id, r.license): r.containment for r in license_scan.license_scan(helpers.documents(spark, list(enumerate(texts)))).collect()}
    assert set(got) == {k for k, share in want.items() if share >= 0.8}
    assert all(share == pytest.approx(want[k]) for k, share in got.items())
    assert len(got) > 80 and sum(share < 0.8 for share in want.values() if share) > 20


def test_license_bands_follow_containment():
    s = license_scan.window_similarity(0.8)
    assert 0.58 < s < 0.6
    assert license_scan.collision(s, license_scan.bands_for(s, license_scan.ROWS, 1e-4), license_scan.ROWS) >= 1 - 1e-4
