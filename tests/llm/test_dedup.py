"""Deduplication operators against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from inkwright.llm import components, exact_dedup, line_dedup, near_dedup, workspace
from tests.llm import helpers


def test_binary_fuse_has_no_false_negatives():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 30000):
        keys = rng.integers(0, 2**64, n, dtype=np.uint64)
        f = exact_dedup.BinaryFuse.from_bytes(exact_dedup.BinaryFuse.of(np.concatenate((keys, keys))).to_bytes())
        assert f.has(keys).all()
        assert f.has(rng.integers(0, 2**64, 20000, dtype=np.uint64)).mean() < 0.01
        if n == 30000:
            assert len(f.to_bytes()) * 8 / n < 10.5


def test_exact_dedup(spark):
    rows = helpers.odd_rows()
    out = exact_dedup.exact_dedup(helpers.documents(spark, rows))
    groups = {}
    for r in rows:
        groups.setdefault(helpers.normal(r[1]), []).append(r[0])
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, seen = (min(known) if known else None), False
        for i in ids:
            kept = i == keep and not seen
            seen |= kept
            want.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    assert helpers.rows_of(out, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    left = exact_dedup.drop_exact_copies(helpers.documents(spark, rows))
    assert left.columns == helpers.documents(spark, rows).columns
    assert sorted((r.doc_id, helpers.normal(r.text)) for r in left.where("doc_id is not null").collect()) == sorted((w[0], t) for t, ids in groups.items() for w in want if w[3] and w[0] is not None and w[4] == hashlib.sha256(t.encode()).hexdigest())
    assert left.count() == len(groups)
    assert exact_dedup.exact_dedup(helpers.documents(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)] + [(500, k) for k in range(501, 560)]
    parent = list(range(600))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    with workspace.Scratch(spark) as scratch:
        got = dict(components.components(spark.createDataFrame(links, "a long, b long"), scratch).collect())
        assert components.components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0
    assert got == {i: find(i) for a, b in links if a != b for i in (a, b)}


def test_posterior_bounds():
    need = near_dedup.least_matches(0.85)
    assert need == sorted(need) and need[-1] < near_dedup.HASHES * 0.85
    rng = np.random.default_rng(0)
    like = rng.random((4000, near_dedup.HASHES)) < 0.85
    assert near_dedup.plausible(like.astype(np.uint32), np.ones_like(like, np.uint32), need).mean() > 0.999
    unlike = rng.random((4000, near_dedup.HASHES)) < 0.3
    assert near_dedup.plausible(unlike.astype(np.uint32), np.ones_like(unlike, np.uint32), need).mean() < 0.001


def copies(rng, n, edits, words=60):
    """Texts that differ from one base in so many words each."""
    base = helpers.prose(rng, words).split()
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(edits):
            own[rng.randrange(words)] = f"w{rng.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


def test_near_dedup_with_a_large_group(spark):
    """More near copies than ALL_PAIRS, so that pivots, rounds and the last comparison with all others are at work."""
    rng = random.Random(7)
    texts = copies(rng, 40, 1) + copies(rng, 34, 2) + copies(rng, 12, 1) + [helpers.prose(rng, 50) for _ in range(60)] + ["a b", "A  b", "a", "", None, "a b c"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    out = near_dedup.near_dedup(helpers.documents(spark, rows)).collect()
    want = helpers.near_components(rows, 3, 85)
    assert {r.doc_id: r.component_id for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(helpers.shingle_set(texts[r.doc_id], 3)) for r in out)


def test_near_dedup_with_a_spread_group(spark):
    """Copies too far apart to be all linked: with many edits, few of which are shared, and of several lengths."""
    rng = random.Random(12)
    base = helpers.prose(rng, 90).split()
    texts = []
    for k in range(150):
        own = list(base)
        for _ in range(k % 9):
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice([[f"w{rng.randint(0, 3)}"], [], [own[at], "más"]])
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    out = near_dedup.near_dedup(helpers.documents(spark, rows)).collect()
    want = helpers.near_components(rows, 3, 85)
    assert 5 < len(set(want.values())) < 130
    assert {r.doc_id: r.component_id for r in out} == want


def spread_rows():
    """A group of 400 texts that differ from a base in four places each, with few words there, so that most are just too far apart."""
    rng = random.Random(13)
    base = [f"b{k}" for k in range(90)]
    rows = []
    for i in range(400):
        own = list(base)
        for at in rng.sample(range(0, 90, 3), 4):
            own[at] = f"w{rng.randint(0, 1)}"
        rows.append((i, " ".join(own)))
    return rows


def test_near_dedup_of_a_spread_group_makes_few_pairs(spark, monkeypatch):
    """Rows of pairs don't grow with the square of a group whose members are just too far apart."""
    rows, seen, table = spread_rows(), [], workspace.Scratch.table

    def counted(self, df, name="table", *more):
        out = table(self, df, name, *more)
        seen.append(out.count() if name == "pairs" else 0)
        return out

    monkeypatch.setattr(workspace.Scratch, "table", counted)
    out = near_dedup.near_dedup(helpers.documents(spark, rows)).collect()
    want = helpers.near_components(rows, 3, 85)
    assert 20 < len(set(want.values())) < 380
    assert {r.doc_id: r.component_id for r in out} == want
    assert sum(seen) < 60 * len(rows)


def test_near_dedup_by_rare_runs_before_blocks(spark, monkeypatch):
    """Clusters beyond BLOCKED meet by prefixes of their rare runs first; blocks of a few members, each two in one call."""
    monkeypatch.setattr(near_dedup, "BLOCKED", 8)
    monkeypatch.setattr(near_dedup, "BLOCK", 50)
    rows = spread_rows()
    out = near_dedup.near_dedup(helpers.documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in out} == helpers.near_components(rows, 3, 85)


def test_near_dedup_odd_rows(spark):
    rows = helpers.odd_rows()
    docs = helpers.documents(spark, rows)
    out = near_dedup.near_dedup(docs).collect()
    want = helpers.near_components([r[:2] for r in rows if r[0] is not None], 3, 85)
    assert {r.doc_id: r.component_id for r in out if r.doc_id is not None} == want
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, True)] * 2
    left = near_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {None, *want.values()}
    assert near_dedup.near_dedup(helpers.documents(spark, [])).count() == 0


def test_near_dedup_of_rows_that_share_a_doc_id(spark):
    """Each row goes by its own text; component_id is the smallest doc_id of all rows in the component."""
    rng = random.Random(51)
    a, b, c = (helpers.prose(rng, 40) for _ in range(3))
    rows = [(5, a), (5, b), (5, b), (3, a + " x"), (9, b + " y"), (9, c), (7, c + " z")]
    out = near_dedup.near_dedup(helpers.documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(3, 3), (5, 3), (5, 5), (5, 5), (7, 7), (9, 5), (9, 7)]
    left = near_dedup.drop_near_copies(helpers.documents(spark, rows))
    assert sorted((r.doc_id, r.text) for r in left.collect()) == sorted([(3, a + " x"), (5, b), (5, b), (7, c + " z")])


def normal_line(line):
    for sign in line_dedup.WIDE_SIGNS:
        line = line.replace(sign, ".")
    words = [re.sub("[0-9]", "0", w).strip(line_dedup.SIGNS.decode()) for w in re.split("[\x20\t\x0b\x0c\r]+", line.lower())]
    return " ".join(w for w in words if w)


def line_oracle(rows, similarity=0.9, least=4):
    """Brute force by edit similarity alone: all pairs of distinct normalised lines."""
    memo_rows = []
    for i, t in rows:
        for line, own in enumerate(map(normal_line, (t or "").split("\n"))):
            if len(own.split(" ")) >= least:
                memo_rows.append((own, (i is None, i, line)))
    first = {}
    for own, place in memo_rows:
        first[own] = min(first.get(own, place), place)
    names = list(first)
    parent = {x: x for x in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(names):
        for b in names[:k]:
            most = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
            if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                parent[find(a)] = find(b)
    keep = {}
    for x in names:
        r = find(x)
        keep[r] = min(keep.get(r, first[x]), first[x])
    gone = {}
    for own, place in memo_rows:
        if place != keep[find(own)]:
            gone.setdefault(place[1], set()).add(place[2])
    return gone


def test_lines_are_normalised():
    rng = random.Random(1)
    texts = ["", "\n", "a", "—", " . ", "..a..b.. . c\n\n.x"] + ["".join(rng.choice("aB1 .-\n\t—é(") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    found = line_dedup.Lines(pa.array(texts, pa.large_string()))
    own = found.own.to_pylist()
    for i, t in enumerate(texts):
        want = [normal_line(x) for x in t.split("\n")]
        cut = slice(found.starts[i], found.starts[i + 1])
        assert own[cut] == want, repr(t)
        assert found.words[cut].tolist() == [len(x.split(" ")) if x else 0 for x in want]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def line_rows():
    rng = random.Random(9)
    base = " ".join(f"palabra{k}" for k in range(20))
    lines = [helpers.prose(rng, 12) for _ in range(20)]
    rows = []
    for i in range(45):
        own = base.split()
        own[rng.randrange(20)] = f"cambio{i}"
        rows.append((i, "\n".join([rng.choice(lines), " ".join(own).title(), "", "corta línea", rng.choice(lines).upper() + "!"])))
    return rows + [(100, None), (101, ""), (102, "\n\n"), (103, base)]


def check_lines(spark):
    rows = line_rows()
    out = {r.doc_id: r for r in line_dedup.line_dedup(helpers.documents(spark, rows)).collect()}
    gone = line_oracle(rows)
    assert sum(map(len, gone.values())) > 60
    for i, t in rows:
        lines = (t or "").split("\n")
        assert out[i].text == "\n".join(x for k, x in enumerate(lines) if k not in gone.get(i, ())), i
        assert (out[i].n_lines, out[i].n_dropped) == (len(lines), len(gone.get(i, ())))


def test_line_dedup(spark):
    check_lines(spark)


def test_line_dedup_refines_crowded_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "ALL_PAIRS", 4)
    check_lines(spark)


def test_line_dedup_odd_rows(spark):
    rows = helpers.odd_rows()
    out = line_dedup.line_dedup(helpers.documents(spark, rows)).collect()
    assert len(out) == len(rows)
    assert sorted((r.doc_id for r in out), key=repr) == sorted((r[0] for r in rows), key=repr)
    assert line_dedup.line_dedup(helpers.documents(spark, [])).count() == 0


def altered(rng, line, edits):
    """line after so many edits of one character each, at random places."""
    own = list(line)
    for _ in range(edits):
        at = rng.randrange(len(own))
        own[at : at + 1] = rng.choice([[rng.choice("abcdefghij")], [], [own[at], rng.choice("abcdefghij")]])
    return "".join(own)


def near_lines(rng, n):
    """(line, altered line) of 5 to 20 words with an edit similarity of at least 0.9, with as many edits as that allows, or few."""
    out = []
    while len(out) < n:
        line = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(5, 20)))
        other = altered(rng, line, rng.choice([1, 2, len(line) // 10]))
        if len(other.split()) >= 4 and line != other and distance(line, other) <= line_dedup.edits(max(len(line), len(other)), 0.9):
            out.append((line, other))
    return out


def test_line_keys_of_near_lines():
    """Short lines always share a key; near lines with few edits always, and those with as many as similarity allows in 0.9 of cases at least, for runs of any length."""
    rng = random.Random(21)
    pairs = near_lines(rng, 600)
    short = [p for p in pairs if max(map(len, p)) < line_dedup.SHORT]
    assert len(short) > 100
    assert all(line_dedup.short_keys(a, 0.9) & line_dedup.short_keys(b, 0.9) for a, b in short)
    for n in (8, 13, 16, 20):
        keys = line_dedup.Keys(0.9, n)
        for low, high, edits in ((60, 110, 0.1), (60, 110, 0.02), (130, 300, 0.1), (130, 300, 0.02), (400, 900, 0.1)):
            lines = [" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(200))[: rng.randint(low, high)] for _ in range(300)]
            others = [altered(rng, x, max(1, int(len(x) * edits))) for x in lines]
            (wa, ka), (wb, kb) = (keys.of(pa.array(x, pa.large_string())) for x in (lines, others))
            both = set(zip(wa.tolist(), ka.tolist(), strict=True)) & set(zip(wb.tolist(), kb.tolist(), strict=True))
            assert len({i for i, _ in both}) >= (0.88 if edits == 0.1 else 0.985) * len(lines), (n, low, edits)


def test_count_filter_and_trimming_lose_no_pair():
    rng = random.Random(23)
    pairs = near_lines(rng, 150) + [(a, b) for (a, _), (b, _) in zip(near_lines(rng, 60), near_lines(rng, 60), strict=True)] + [("", ""), ("a", "b"), ("abcd", "abce"), ("日本語のことば", "日本語のことは"), ("xx", "x"), ("aXb", "ab")]
    fits = line_dedup.may_reach([p[0] for p in pairs], [p[1] for p in pairs], 0.9)
    assert fits[:150].all() and not fits[150:210].any()
    for a, b in pairs:
        x, y = line_dedup.trimmed(a, b)
        assert not line_dedup.aligned(a, b, distance(a, b) - 1) and line_dedup.aligned(a, b, 3 * max(len(a), len(b), 1))
        d = distance(a, b)
        assert line_dedup.within(a, b, d) and line_dedup.within(x, y, d) and not line_dedup.within(a, b, d - 1)
        assert all(line_dedup.near(a, b, k) == (d <= k) for k in (0, 1, 3, d - 1, d, d + 1) if k >= 0)
        assert distance(x, y) == d and not (x and y and (x[0] == y[0] or x[-1] == y[-1]))


def test_runs_hash_each_place():
    raw = np.frombuffer(b"hello world this is a test of runs", np.uint8)
    for n in range(1, 20):
        h = line_dedup.runs(raw, n)
        assert len(h) == len(raw) - n + 1
        assert (line_dedup.runs(np.concatenate((raw[:2], raw)), n)[2:] == h).all()
        assert len(set(h.tolist())) == len({bytes(raw[i : i + n]) for i in range(len(h))})


def test_line_dedup_by_edit_similarity_alone(spark):
    """Against edit similarity alone: one line each of 200 near pairs goes."""
    pairs = near_lines(random.Random(22), 200)
    rows = [(i, x) for i, x in enumerate(x for p in pairs for x in p)]
    out = {r.doc_id: r.n_dropped for r in line_dedup.line_dedup(helpers.documents(spark, rows)).collect()}
    assert not any(out[2 * i] for i in range(len(pairs)))
    assert sum(out[2 * i + 1] for i in range(len(pairs))) > 0.95 * len(pairs)


def crowded_rows():
    """Ten pairs of near lines of one template, each pair far from the others; a pair's second differs in every other word behind the template, so that no run of eight is left there."""
    rng = random.Random(51)
    words = lambda n, size, letters: ["".join(rng.choice(letters) for _ in range(size)) for _ in range(n)]
    fixed = words(12, 7, "abcdefghij")
    rows = []
    for k in range(10):
        own = words(20, 2, "klmnopqrstuvw")
        rows += [(2 * k, " ".join(fixed + own)), (2 * k + 1, " ".join(fixed + [w if at % 2 else rng.choice("xyz") + w[1] for at, w in enumerate(own)]))]
    return rows


@pytest.mark.parametrize("whole", [0, 4096])
def test_line_dedup_compares_what_shares_crowded_runs_only(spark, monkeypatch, whole):
    """A pair that shares no run but those of a crowded group, and that no pivot links, is found, after denser samples and at once."""
    monkeypatch.setattr(line_dedup, "ALL_PAIRS", 4)
    monkeypatch.setattr(line_dedup, "GROUP_BLOCK", 7)
    monkeypatch.setattr(line_dedup, "WHOLE", whole)
    rows = crowded_rows()
    gone = line_oracle(rows)
    assert 8 <= sum(map(len, gone.values())) <= 10
    out = {r.doc_id: r.n_dropped for r in line_dedup.line_dedup(helpers.documents(spark, rows)).collect()}
    assert out == {i: len(gone.get(i, ())) for i, _ in rows}


def test_lines_compared_whole_by_brute_force():
    rng = random.Random(52)
    lines = [x for p in near_lines(rng, 40) for x in p] + ["", "a", "ab cd"]
    rng.shuffle(lines)
    roots = [b"%03d" % i for i in range(len(lines))]
    half = len(lines) // 2
    want = {(i, j) for i in range(half) for j in range(half, len(lines)) if distance(lines[i], lines[j]) <= line_dedup.edits(max(len(lines[i]), len(lines[j])), 0.9)}
    assert len(want) > 10
    assert set(line_dedup.close(lines, roots, list(range(half)), list(range(half, len(lines))), 0.9)) == want


def test_lines_of_one_block_by_brute_force(monkeypatch):
    """Lines of few different runs, compared with each other: what is linked is connected, and runs are counted as often as they occur."""
    rng = random.Random(53)
    lines = []
    for _ in range(8):
        own = " ".join(rng.choices("abcdef", [2 ** rng.randint(0, 5) for _ in range(6)], k=60))
        at = rng.randrange(len(own))
        lines += [own, own[:at] + own[at + 9 :]]
    rng.shuffle(lines)
    ids, calls = [b"%03d" % i for i in range(len(lines))], []
    was = line_dedup.near
    monkeypatch.setattr(line_dedup, "near", lambda *x: calls.append(x) or was(*x))

    def groups(pairs):
        root = list(range(len(lines)))
        for i, j in pairs:
            root = [root[i] if r == root[j] else r for r in root]
        return {frozenset(k for k, r in enumerate(root) if r == x) for x in root}

    every = list(range(len(lines)))
    found = line_dedup.close(lines, ids, every, every, 0.9)
    assert groups(found) == groups((i, j) for i in every for j in every[:i] if distance(lines[i], lines[j]) <= line_dedup.edits(max(len(lines[i]), len(lines[j])), 0.9))
    assert len(calls) <= 20  # of 120 pairs


def test_line_dedup_leaves_no_shuffle_files_of_written_tables(spark, monkeypatch):
    files = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")))
    table, left = workspace.Scratch.table, {}

    def write(self, df, name="table", *rest):
        before = files()
        out = table(self, df, name, *rest)
        left.setdefault(name, set()).update(files() - before)
        return out

    monkeypatch.setattr(workspace.Scratch, "table", write)
    rows = crowded_rows()
    assert line_dedup.line_dedup(helpers.documents(spark, rows)).count() == len(rows)
    assert {"nodes", "keys", "pairs", "links", "keep", "gone"} <= set(left)
    assert not any(left.values()), left
    assert spark.conf.get(workspace.CLEANUP, None) is None


def test_near_dedup_links_beyond_the_pivot(spark):
    """In crowded bands, sets linked to the pivot and smaller than it, each with a partner that isn't linked to the pivot and shares no added run."""
    rng = random.Random(31)
    base = [f"b{k}" for k in range(100)]
    sets = [base] + [[*base, f"own{k}"] for k in range(260)]
    for k in range(30):
        x = rng.sample(base, 85)
        sets += [x, [*x, *(f"y{k}x{j}" for j in range(15))]]
    rows = list(enumerate(" ".join(s) for s in sets))
    want = helpers.near_components(rows, 1, 85)
    assert set(want.values()) == {0}
    docs = helpers.documents(spark, rows)
    start = [(1, i, 0 if i <= 260 else i) for i, _ in rows]  # one band of all; base and its supersets are a component
    with workspace.Scratch(spark) as scratch:
        classes = scratch.table(near_dedup._sets(docs, 1).select(near_dedup.F.col("doc_id").alias("id"), "doc_id", "th", "n_shingles", "signature"))
        verify = lambda found: near_dedup._verified(found, classes, docs, scratch, 1, 85)
        links = near_dedup._dense(spark.createDataFrame(start, "band long, id long, root long"), classes, docs, verify, scratch, 1, 85)
        links = links.unionByName(spark.createDataFrame([(i, 0) for i in range(1, 261)], "a long, b long"))
        assert dict(components.components(links, scratch).collect()) == want


def test_bands_follow_the_threshold():
    """Pairs at the threshold of op9 and of the pipeline share no band with probability BAND_MISS at most."""
    assert near_dedup.bands_for(0.85) == near_dedup.BANDS
    for threshold in (0.85, 0.8):
        bands = near_dedup.bands_for(threshold)
        assert bands * near_dedup.ROWS % near_dedup.BATCH == 0
        assert (1 - threshold**near_dedup.ROWS) ** bands <= near_dedup.BAND_MISS


def test_near_dedup_at_the_threshold_of_the_pipeline(spark):
    rng = random.Random(41)
    rows = list(enumerate(t for _ in range(30) for t in copies(rng, 2, 1, 45)))
    out = near_dedup.near_dedup(helpers.documents(spark, rows), width=5, percent=80).collect()
    assert {r.doc_id: r.component_id for r in out} == helpers.near_components(rows, 5, 80)
