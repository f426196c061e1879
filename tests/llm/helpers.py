"""Small tables with every odd case, and brute-force versions of the operators."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, th string, band long, size long, digest string, root long, kept string"
WORDS = "alfa beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def odd_rows():
    """Nulls in all columns, empty and blank texts, repeated rows, equal texts, near copies, a long text, columns with clashing names."""
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "otro"
    texts = [base, base, base.replace(" ", "  \n", 3), " ".join(near), "", "  ", None, "uno", "uno dos", "UNO  dos", prose(rng, 9000), "x" * 5000, "<|endoftext|> fin<|startoftext|>", "日本 語 x ﬁ İ", base + "\n" + prose(rng, 12), "Licensed under CC BY-NC 4.0."]
    rows = [(k, t, "en", f"s{k % 4}") for k, t in enumerate(texts)]
    rows += [(3, rows[3][1], "en", "s3"), (None, "sin id", None, None), (None, None, None, None), (50, base, None, None), (50, base, None, None), (51, prose(rng, 40), "en", "é")]
    return [(i, t, lang, source, None if t is None else len(t), "c", 1, 2, "c", 3, "c") for i, t, lang, source in rows]


def documents(spark, rows):
    return spark.createDataFrame([(*r, *([None] * (11 - len(r)))) for r in rows], SCHEMA)


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def shingle_set(text, width):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near_components(rows, width, percent):
    """doc_id -> smallest doc_id reachable; rows are (doc_id, text)."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


def rows_of(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)
