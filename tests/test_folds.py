"""Window forms against plain sequential folds, and text functions against Python's."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from inkwright.functions import dates, text
from inkwright.operators import publish, sequence


def test_collapse_spacing_equals_a_regex_with_callback(spark):
    rng = random.Random(1)
    strings = ["".join(rng.choice("ab Á1. _-") for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(strings)), "i int, s string").select("i", text.collapse_spacing(F.col("s")).alias("c"))
    got = dict(df.collect())
    for i, s in enumerate(strings):
        joined = re.sub(r"\b\w\b(?: \b\w\b){2,}", lambda m: m.group().replace(" ", ""), s)
        assert got[i] == re.sub(r"[ \t]{2,}", " ", joined).strip(), repr(s)


def test_strip_accents_keeps_what_has_no_marks(spark):
    letters = "".join(chr(c) for c in (*range(0xC0, 0x180), *range(0x1E00, 0x1F00))) + "ñ ß"
    got = spark.createDataFrame([(letters,)], "s string").select(text.strip_accents(F.col("s"))).first()[0]
    assert got == "".join(c for c in unicodedata.normalize("NFD", letters) if unicodedata.category(c) != "Mn")


def test_paragraphs_equal_a_fold(spark):
    rng = random.Random(2)
    pool = ["Uno dos", "sigue", "fin.", "Nuevo:", "otra vez", "«cita»", "Año", "ñandú (x)"]
    docs = {d: [rng.choice(pool) for _ in range(rng.randint(1, 9))] for d in range(300)}
    rows = [(d, p, s) for d, lines in docs.items() for p, s in enumerate(lines)]
    out = sequence.paragraphs(spark.createDataFrame(rows, "d int, pos int, s string"), ["d"], "pos", "s").collect()
    for d, lines in docs.items():
        want = []
        for s in lines:
            if want and not re.search(r'[.!?:»”")]\s*$', want[-1]) and s[0].islower():
                want[-1] += " " + s
            else:
                want.append(s)
        assert [r.text for r in sorted((r for r in out if r.d == d), key=lambda r: r.para)] == want


def test_danglers_equal_a_fold(spark):
    rng = random.Random(3)
    pool = ["LA CARTA DE", "UN", "BARCO", "Y", "EL TREN,", "por"]
    issues = {str(d): [rng.choice(pool) for _ in range(rng.randint(1, 7))] for d in range(300)}
    rows = [(i, k, t, k) for i, ts in issues.items() for k, t in enumerate(ts)]
    out = sequence.merge_danglers(spark.createDataFrame(rows, "issue_id string, ord int, title string, page int")).collect()
    for i, ts in issues.items():
        want, k = [], 0
        while k < len(ts):
            title, page = ts[k], k
            while k + 1 < len(ts) and title.split()[-1].lower().strip(".,;:") in sequence.DANGLING:
                k += 1
                title += " " + ts[k]
            want.append((title, page))
            k += 1
        assert [(r.title, r.page) for r in sorted((r for r in out if r.issue_id == i), key=lambda r: r.ord)] == want


def test_sequence_edges(spark):
    blocks = spark.createDataFrame([("x", 0, "nada", None), ("y", 0, "EDITORIAL", None)], "issue_id string, pos int, text string, pagenum int")
    assert sorted(map(tuple, sequence.toc_bounds(blocks, "FIN").collect())) == [("x", 0, 1), ("y", 0, 1)]
    assert sorted(map(tuple, sequence.body_start(blocks).collect())) == [("x", 0), ("y", 0)]
    empty = blocks.limit(0)
    assert sequence.toc_tokens(empty, sequence.toc_bounds(empty, "FIN")).count() == 0


def test_subtitle_pages_and_secrets(spark):
    df = spark.createDataFrame([(["EL TREN", "x"], "El tren de vapor", 3, 5, "​ a b ")], "p array<string>, t string, a int, b int, s string")
    row = df.select(text.drop_repeated_subtitle(F.col("p"), F.col("t")), publish.page_label(F.col("a"), F.col("b")), publish.page_label(F.col("a"), F.col("a")), text.clean_secret(F.col("s")), text.with_extension(F.lit("a/b.c/img.tar.png"), "webp"), dates.pretty_date(F.lit("x")), text.joined_list(F.col("p"))).first()
    assert tuple(row) == (["x"], "3–5", "3", "a b", "img.tar.webp", "", "EL TREN; x")
