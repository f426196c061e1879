"""Cases of review findings."""

import random
import re
import unicodedata

import duckdb
from pyspark.sql import functions as F

from inkwright.functions import text
from inkwright.operators import matching, sequence
from inkwright.plans import queries


def test_slugs_of_spaced_letters_equal_the_sql(spark, tmp_path):
    titles = ["la la e e e e ee", "c c c c", "Á B C uno", "uno a b", ""]
    pages = spark.createDataFrame([(i, "u", f"<title>{t}</title>") for i, t in enumerate(titles)], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = queries.q12_slug(spark, str(tmp_path)).select("slug", "n").collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(queries.ORACLES["q12_slug"]).fetchall())
    assert spark.range(1).select(text.slugify(F.lit("A R T Í C U L O veinte"))).first()[0] == "articulo-veinte"


def test_a_feature_type_makes_its_key_once(spark):
    assert str(spark.range(1).select(text.feature_type(F.lit("x")))._jdf.queryExecution().logical().expressions().toList()).count("[^a-z0-9]") == 1


def test_keys_and_ends_of_odd_blanks(spark):
    rng = random.Random(5)
    signs = "aBÁñ̃É1 _-.  \t\n  　​\u0085ßİ"
    strings = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(strings)), "i int, s string")
    bare = lambda s: "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")
    blanks = "\t\n\x0b\f\r \x85\xa0 　"
    for i, key, ends, solid, ratio in df.select("i", text.norm_key(F.col("s")), text.strip(F.col("s")), text.no_space(F.col("s")), text.upper_ratio(F.col("s"))).collect():
        s = strings[i]
        letters = [c for c in s if unicodedata.category(c).startswith("L")]
        assert key == re.sub("[^a-z0-9]", "", bare(s).lower()), repr(s)
        assert ends == s.strip(blanks), repr(s)
        assert solid == "".join(c for c in bare(s) if c not in blanks).upper(), repr(s)
        assert ratio == (sum(unicodedata.category(c) == "Lu" for c in letters) / len(letters) if letters else 0.0), repr(s)


def test_captions_and_headers_without_python_for_each_group(spark):
    rng = random.Random(7)
    captions = [(str(a), c) for a in range(120) for c in sorted(rng.sample(range(20), rng.randint(1, 10)))]
    images = [(str(a), rng.randrange(20), o, f"f{rng.randrange(5)}") for a in range(120) for o in range(12)]
    df = matching.match_captions(spark.createDataFrame(captions, "article_id string, cap_pos int"), spark.createDataFrame(images, "article_id string, pos int, ord int, file string"))
    assert "InPandas" not in df._jdf.queryExecution().executedPlan().toString()
    want = []
    for a in map(str, range(120)):
        own, taken = [c for b, c in captions if b == a], set()
        for c in own if len(own) <= 8 else []:
            near = sorted((c - p if p <= c else 3 + p - c, o, f) for b, p, o, f in images if b == a and abs(p - c) <= 3)
            file = next((f for _, _, f in near if f not in taken), None)
            taken.add(file)
            want.append((a, c, file))
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_front_matter_is_read_on_all_cores(spark):
    assert queries.q49_front_matter(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_text_is_worked_out_once_below_filters(spark):
    lines = spark.createDataFrame([("x", 0, 0, "uno dos", None)], "issue_id string, section int, pos int, text string, pagenum int")
    titles = spark.createDataFrame([("x", "Uno")], "issue_id string, title string")
    plan = sequence.clean_body(lines, titles)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[ \\t]{2,}") == 1


def test_the_table_of_contents_needs_few_sorts_and_no_broadcast_hint(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    entries = plan(queries.q36_toc_entries(spark, "/root/testdata/sf0.001"))
    assert entries.count("Window ") <= 1 and entries.count("Aggregate ") <= 6
    assert "leftHint=(strategy=broadcast)" not in plan(queries.q37_toc_corrections(spark, "/root/testdata/sf0.001")).split("Union")[0]


def test_pairs_that_cannot_score_are_not_compared(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("ABC") for _ in range(rng.randint(1, 24)))
    keys, heads = [word().lower() for _ in range(40)], [word() for _ in range(40)]
    entries = spark.createDataFrame([("x", i, k) for i, k in enumerate(keys)], "issue_id string, ord int, key string")
    blocks = spark.createDataFrame([("x", i, h) for i, h in enumerate(heads)], "issue_id string, pos int, text string")
    df = matching.heading_scores(blocks, entries, 0.7)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "least(length(key" in plan[plan.index("ArrowEvalPython") :]
    want = [("x", i, j, s) for i, k in enumerate(keys) for j, h in enumerate(heads) if (s := matching._score(k, h.lower())) >= 0.7]
    assert sorted(map(tuple, df.collect())) == sorted(want)
