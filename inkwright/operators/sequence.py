"""Ordered sequences as window functions.

Inputs carry an explicit order column; windows are partitioned by the keys of a
document or issue, so a group is one document's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwright.functions import text

#: Words that no title ends on.
DANGLING = sorted("a al con de del e el en la las los o para por que sin su sus un una unos unas y".split())
#: Keys of sections that are dropped whole.
SKIPPED = sorted("buzondenovedades nuestronuevosocio nuestrosnuevossocios nuestronuevossocios bienvenidosnuestrosnuevossocios".split())
FEATURES = ["un sello con historia", "buzon de novedades", "credo del filatelista", "el sobresaliente de hoy", "nuestro nuevo socio", "nuestro nuevos socios", "nuestros nuevos socios"]
HEADER_WORDS = ["ARTICULO", "CONTENIDO", "PAGINA"]
SENTENCE_END = r"[.!?:»”\")]\s*$"
STOP_PROPERS = sorted("filatelia filatelica filatelico federacion internacional nacional postal postales republica".split())


def islands(df: DataFrame, keys: list[str], order: str, starts: Column, name: str = "island") -> DataFrame:
    """df with the number of starting rows up to each row; rows before the first have 0."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(upto))


def ordered_concat(df: DataFrame, keys: list[str], order: str, column: str, sign: str = " ") -> Column:
    """Aggregate: column's values in order, joined."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(column).alias("v"))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), sign)


def next_non_null(column: str, keys: list[str], order: str) -> Column:
    after = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    return F.first(column, ignorenulls=True).over(after)


def lead_clamped(column: str, keys: list[str], order: str) -> Column:
    """The next row's value less one, not below the own value; null without a next value."""
    following = F.lead(column).over(Window.partitionBy(*keys).orderBy(order))
    return F.when(following.isNotNull() & (following != 0), F.greatest(following - 1, F.col(column)))


def first_position(condition: Column, order: str = "pos") -> Column:
    """Aggregate: the least position at which the condition holds."""
    return F.min(F.when(condition, F.col(order)))


def toc_bounds(blocks: DataFrame, end_marker: str, within: int = 120) -> DataFrame:
    """issue_id, start, end of the table of contents in blocks (issue_id, pos, text, pagenum).

    It starts at the first of the first blocks whose key begins with
    ``directorio``, else at a header word, else at 0; it ends before the first
    later block that begins with end_marker (capitals, no spaces).
    """
    early = F.col("pos") < within
    solid = blocks.select("issue_id", "pos", text.norm_key(F.col("text")).startswith("directorio").alias("named"), text.no_space(F.col("text")).alias("solid"))
    marks = F.collect_list(F.when(F.col("solid").startswith(end_marker), F.col("pos"))).alias("marks")
    start = solid.groupBy("issue_id").agg(F.coalesce(first_position(early & F.col("named")), first_position(early & F.col("solid").isin(HEADER_WORDS)), F.lit(0)).alias("start"), (F.max("pos") + 1).alias("n"), marks)
    return start.select("issue_id", "start", F.coalesce(F.array_min(F.filter("marks", lambda p: p > F.col("start"))), "n").alias("end"))


def toc_tokens(blocks: DataFrame, bounds: DataFrame) -> DataFrame:
    """issue_id, idx (from 0), kind ('title', 'num'), title, page: the tokens of the table of contents.

    A line that is no title continues the title before it, or is dropped after a number.
    """
    lines = text.once(blocks.select("issue_id", "pos", "text", "pagenum"), s=text.collapse_spacing(F.col("text"))).drop("text").where("s != ''")
    kind = F.when(F.col("pagenum").isNotNull(), "num").when(text.is_title_line(F.col("s")), "title").otherwise("more")
    read = text.once(lines.where(~text.no_space(F.col("s")).isin(HEADER_WORDS)), kind=kind, line=text.strip_leaders(F.col("s"))).drop("s").withColumnRenamed("line", "s")
    inside = read.join(bounds, "issue_id").where("pos >= start and pos < `end`")
    marked = islands(inside, ["issue_id"], "pos", F.col("kind") != "more", "token").where("token > 0")
    first = F.min_by("kind", "pos").alias("kind")
    tokens = marked.groupBy("issue_id", "token").agg(first, ordered_concat(marked, [], "pos", "s").alias("line"), F.min_by("pagenum", "pos").alias("page"))
    return tokens.select("issue_id", (F.col("token") - 1).alias("idx"), "kind", F.when(F.col("kind") == "title", F.col("line")).alias("title"), F.when(F.col("kind") == "num", F.col("page")).alias("page"))


def toc_entries(tokens: DataFrame) -> DataFrame:
    """issue_id, ord, title, page of each issue, by its layout: an issue's tokens as one array.

    The layout is interleaved if the first number comes before the last title.
    """
    rows = tokens.groupBy("issue_id").agg(F.array_sort(F.collect_list(F.struct("idx", "kind", "title", "page"))).alias("items"))
    number, title = (F.transform(F.filter("items", lambda t: t["kind"] == kind), lambda t: t["idx"]) for kind in ("num", "title"))
    found = F.when(F.coalesce(F.array_min(number) < F.array_max(title), F.lit(False)), interleaved_entries(F.col("items"))).otherwise(block_entries(F.col("items")))
    return rows.select("issue_id", F.posexplode(found).alias("ord", "e")).select("issue_id", "ord", "e.title", "e.page").where("title is not null")


def _entry(title: Column, page: Column) -> Column:
    return F.struct(title.alias("title"), page.alias("page"))


def interleaved_entries(items: Column) -> Column:
    """Array of title, page: titles up to each number are joined; later ones have no page each."""
    none = F.lit(None).cast("int")
    ends = F.filter(F.transform(items, lambda t, i: F.when(t["kind"] == "num", i)), lambda i: i.isNotNull())

    def cut(ends: Column) -> Column:
        before = lambda x: F.when(x > 0, F.get(ends, x - 1)).otherwise(-1)
        titles = lambda low, high: F.filter(F.transform(F.slice(items, low + 2, high - low - 1), lambda t: t["title"]), lambda t: t.isNotNull())
        runs = F.transform(ends, lambda end, x: F.struct(titles(before(x), end).alias("titles"), F.get(items, end)["page"].alias("page")))
        closed = F.transform(F.filter(runs, lambda r: F.size(r["titles"]) > 0), lambda r: _entry(F.array_join(r["titles"], " "), r["page"]))
        return F.concat(closed, F.transform(titles(before(F.size(ends)), F.size(items)), lambda t: _entry(t, none)))

    return F.get(F.transform(F.array(ends), cut), F.lit(0))


def block_entries(items: Column) -> Column:
    """Array of title, page: titles meet numbers by position.

    If there is one number more than titles and the first title is not the
    directory, it is put before them.  Titles that outnumber the numbers are to
    be merged first (``matching.merge_to_count``).
    """
    of = lambda kind, field: F.transform(F.filter(items, lambda t: t["kind"] == kind), lambda t: t[field])

    def meet(both: Column) -> Column:
        titles, pages = both["titles"], both["pages"]
        added = (F.size(pages) == F.size(titles) + 1) & (F.size(titles) > 0) & ~text.norm_key(F.get(titles, F.lit(0))).startswith("directorio")
        whole = F.when(F.coalesce(added, F.lit(False)), F.concat(F.array(F.lit("DIRECTORIO")), titles)).otherwise(titles)
        return F.transform(whole, lambda t, i: _entry(t, F.get(pages, i)))

    return F.get(F.transform(F.array(F.struct(of("title", "title").alias("titles"), of("num", "page").alias("pages"))), meet), F.lit(0))


def merge_danglers(entries: DataFrame) -> DataFrame:
    """Entries whose title ends on a dangling word take the next one's title; the first page stays."""
    last = F.regexp_extract(text.strip(F.col("title")), r"(?U)\S+$", 0)
    open_end = F.btrim(F.lower(text.strip_accents(last)), F.lit(".,;:")).isin(DANGLING)
    order = Window.partitionBy("issue_id").orderBy("ord")
    marked = entries.withColumn("_open", F.coalesce(open_end, F.lit(False)))
    joined = islands(marked, ["issue_id"], "ord", ~F.coalesce(F.lag("_open").over(order), F.lit(False)))
    merged = joined.groupBy("issue_id", "island").agg(ordered_concat(joined, [], "ord", "title").alias("title"), F.min_by("page", "ord").alias("page"))
    return merged.select("issue_id", (F.col("island") - 1).alias("ord"), "title", "page")


def toc_corrections(entries: DataFrame, manual: DataFrame | None = None, phrases: list[str] = FEATURES) -> DataFrame:
    """Entries with recurring features as their own, danglers merged, and manual corrections (issue_id, kind, key) made.

    Kinds are ``drop`` and ``merge_prev``, which folds an entry into the one before it.
    """
    parts = text.split_features(F.col("title"), phrases)
    whole = F.array(F.col("title"))
    peeled = F.filter(F.concat(F.array(parts["prefix"]), parts["features"]), lambda t: t != "")
    titles = F.when(text.norm_key(F.col("title")).isin(SKIPPED), whole).otherwise(peeled)
    split = entries.select("issue_id", "ord", "page", F.posexplode(titles).alias("k", "title"))
    order = Window.partitionBy("issue_id").orderBy("ord", "k")
    merged = merge_danglers(split.select("issue_id", (F.row_number().over(order) - 1).alias("ord"), "title", "page"))
    if manual is None:
        return merged
    keyed = merged.withColumn("key", text.norm_key(F.col("title")))
    rules = manual.withColumn("key", text.norm_key(F.col("key")))
    kept = keyed.join(rules.where("kind = 'drop'").select("issue_id", "key"), ["issue_id", "key"], "left_anti")
    fold = rules.where("kind = 'merge_prev'").select("issue_id", "key", F.lit(True).alias("fold")).distinct()
    marked = kept.join(fold, ["issue_id", "key"], "left")
    joined = islands(marked, ["issue_id"], "ord", F.col("fold").isNull() | (F.row_number().over(Window.partitionBy("issue_id").orderBy("ord")) == 1))
    return joined.groupBy("issue_id", "island").agg(ordered_concat(joined, [], "ord", "title").alias("title"), F.min_by("page", "ord").alias("page")).select("issue_id", (F.col("island") - 1).alias("ord"), "title", "page")


def body_start(blocks: DataFrame) -> DataFrame:
    """issue_id, start: the second block that is 'editorial', else the first, else 0."""
    hits = F.array_sort(F.collect_list(F.when(text.norm_key(F.col("text")) == "editorial", F.col("pos"))))
    return blocks.groupBy("issue_id").agg(hits.alias("h")).select("issue_id", F.coalesce(F.get("h", F.lit(1)), F.get("h", F.lit(0)), F.lit(0)).alias("start"))


def section_ranges(entries: DataFrame, ends: DataFrame) -> DataFrame:
    """entries (issue_id, ord, title, page, loc) with lo, hi (blocks of the body) and page_start, page_end.

    ``ends`` has issue_id and n, the number of blocks.  Ranges come from all
    entries, also those that are dropped later.
    """
    keys = ["issue_id"]
    return entries.join(ends, "issue_id").select(
        "issue_id", "ord", "title", "loc", (F.col("loc") + 1).alias("lo"), F.when(F.col("loc").isNotNull(), F.coalesce(next_non_null("loc", keys, "ord"), F.col("n"))).alias("hi"), F.col("page").alias("page_start"), lead_clamped("page", keys, "ord").alias("page_end")
    )


def articles(ranges: DataFrame) -> DataFrame:
    """ranges without the directory and the skipped sections, with feature type and review flags of those without heading."""
    kept = ranges.withColumn("feature_type", text.feature_type(F.col("title"))).where((F.col("feature_type") != "directorio") & ~text.norm_key(F.col("title")).isin(SKIPPED))
    return kept.withColumn("review", F.when(F.col("loc").isNull(), F.array(F.lit("empty-body"), F.lit("heading-image-only"))).otherwise(F.expr("cast(array() as array<string>)")))


RUNNING = r"^(volumen\s+\d+|serie\s+\d+)"


def clean_body(blocks: DataFrame, titles: DataFrame, running: str = RUNNING) -> DataFrame:
    """section, para, text: paragraphs of blocks (issue_id, section, pos, text, pagenum), hard-wrapped lines joined.

    Page markers, empty lines, running headers and repeated titles (titles:
    issue_id, title) go first; then a line that begins in lower case continues
    one without an end sign.
    """
    keys = titles.select("issue_id", text.norm_key(F.col("title")).alias("key")).distinct()
    lines = text.once(blocks.where("pagenum is null"), s=text.collapse_spacing(F.col("text"))).where("s != ''")
    header = F.lower(text.strip_accents(F.col("s"))).rlike(running)
    lines = text.once(lines.where(~((F.length("s") < 40) & header)), key=F.when(F.length("s") < 60, text.norm_key(F.col("s"))))
    # longer lines have no key, so they repeat no title
    kept = lines.join(keys, ["issue_id", "key"], "left_anti").select("issue_id", "section", "pos", "s")
    return paragraphs(kept, ["issue_id", "section"], "pos", "s")


def paragraphs(lines: DataFrame, keys: list[str], order: str, column: str) -> DataFrame:
    """keys, para (from 0), text: hard-wrapped lines joined."""
    before = F.lag(column).over(Window.partitionBy(*keys).orderBy(order))
    lower = F.substring(column, 1, 1).rlike(r"^\p{Ll}")
    joined = islands(lines, keys, order, ~F.coalesce(~before.rlike(SENTENCE_END) & (before != "") & lower, F.lit(False)))
    out = joined.groupBy(*keys, "island").agg(ordered_concat(joined, keys, order, column).alias("text"))
    return out.select(*keys, (F.col("island") - 1).alias("para"), "text")


def section_images(blocks: DataFrame) -> DataFrame:
    """issue_id, section, images: those of all blocks, in order."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "images")))
    return blocks.groupBy("issue_id", "section").agg(F.flatten(F.transform(rows, lambda r: F.coalesce(r["images"], F.expr("cast(array() as array<string>)")))).alias("images"))


def proper_nouns(documents: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """word, cap_mid, lower: words capitalised within sentences more often than not.

    documents have keys and text; a word counts as capitalised within a sentence
    unless the token before it ends one or there is none.  Words of several
    letters all in capitals don't count.
    """
    tokens = documents.select(*keys, F.posexplode(F.regexp_extract_all("text", F.lit(r"[\p{L}]+|[.!?:;¡¿]"), F.lit(0))).alias("i", "tok"))
    before = F.lag("tok").over(Window.partitionBy(*keys).orderBy("i"))
    marked = tokens.withColumn("start", F.coalesce(before.isin(".", "!", "?"), F.lit(True)))
    words = marked.where(F.col("tok").rlike(r"^\p{L}") & ~((F.length("tok") > 1) & (F.col("tok") == F.upper("tok")) & F.col("tok").rlike(r"\p{Lu}")))
    capital = F.col("tok").rlike(r"^\p{Lu}")
    counts = words.groupBy(F.lower("tok").alias("word")).agg(F.sum((capital & ~F.col("start")).cast("long")).alias("cap_mid"), F.sum((~capital).cast("long")).alias("lower"))
    named = counts.where((F.col("cap_mid") >= least) & (F.col("cap_mid") > F.col("lower")) & (F.length("word") > 2))
    return named.where(~text.strip_accents(F.col("word")).isin(STOP_PROPERS))


def ordered_distinct(df: DataFrame, keys: list[str], order: str, column: str) -> DataFrame:
    """keys, column, first: each value once, with its first position."""
    return df.groupBy(*keys, column).agg(F.min(order).alias("first"))
