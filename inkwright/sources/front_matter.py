"""Articles as Markdown with a header, the CSV index, and the publication queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.functions import text

INDEX_COLUMNS = ["series", "volume", "issue_date", "order", "title_es", "author", "feature_type", "themes", "page_start", "page_end", "image_count", "review", "file"]
HEADER = r"(?s)\A---\n(.*?)\n---"
LINE = r"^([a-z_]+):\s*(.*?)\s*(?:#.*)?$"
LISTS = ("themes", "review", "lang_available")


def read_markdown(spark: SparkSession, glob: str) -> DataFrame:
    """path and text of whole files; readers skip names that begin with an underscore."""
    return spark.read.text(glob, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def header(c: Column) -> Column:
    """map of a text's front matter: key to value without quotes and comment; the last of equal keys counts.

    Lists stay in their brackets.  A text that doesn't begin with a closed header has none.
    """
    lines = F.filter(F.split(F.regexp_extract(c, HEADER, 1), r"\r?\n"), lambda x: x.rlike(LINE))
    value = lambda x: text.strip(F.regexp_extract(x, LINE, 2))
    plain = lambda v: F.when(v.rlike('^".*"$') & (F.length(v) > 1), v.substr(F.lit(2), F.length(v) - 2)).otherwise(v)
    found = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, LINE, 1).alias("k"), value(x).alias("v")))
    pairs = F.transform(found, lambda p: F.struct(p["k"].alias("k"), plain(p["v"]).alias("v")))
    last = lambda ps: F.filter(ps, lambda p, i: ~F.exists(F.slice(ps, i + 2, F.size(ps)), lambda q: q["k"] == p["k"]))
    # as a lambda's variable, the pairs are made once
    return F.get(F.transform(F.array(pairs), lambda ps: F.map_from_entries(last(ps))), F.lit(0))


def header_list(value: Column) -> Column:
    """The items of a bracketed list, without quotes; empty for any other value."""
    inner = F.when(value.startswith("["), value.substr(F.lit(2), F.length(value) - 2)).otherwise("")
    items = F.filter(F.split(inner, ","), lambda x: text.strip(x) != "")
    return F.transform(items, lambda x: F.btrim(text.strip(x), F.lit('"')))


def index_rows(files: DataFrame, root: str = "") -> DataFrame:
    """files (path, text) as index rows: 13 string columns, lists joined with '; ', 'null' as it stands."""
    fm = files.withColumn("fm", header(F.col("text")))
    of = lambda k: F.coalesce(F.element_at("fm", k), F.lit(""))
    columns = {k: text.joined_list(header_list(of(k))) if k in LISTS else of(k) for k in INDEX_COLUMNS if k not in ("order", "file")}
    columns |= {"order": F.regexp_extract(text.basename(F.col("path")), r"^(\d+)", 1), "file": F.replace(F.col("path"), F.lit(root), F.lit(""))}
    return fm.select(*(columns[k].alias(k) for k in INDEX_COLUMNS))


def articles(files: DataFrame, root: str = "") -> DataFrame:
    """files (path, text) as typed articles, with id (path without .md) and body."""
    fm = files.withColumn("fm", header(F.col("text")))
    of = lambda k: F.element_at("fm", k)
    whole = lambda k: F.nullif(of(k), F.lit("null")).try_cast("int")
    flag = lambda k: F.coalesce(of(k) == "true", F.lit(False))
    listed = lambda k: header_list(F.coalesce(of(k), F.lit("")))
    return fm.select(
        text.plain_id(F.replace(F.col("path"), F.lit(root), F.lit(""))).alias("id"),
        of("title_es").alias("title_es"), F.coalesce(of("title_en"), F.lit("")).alias("title_en"), of("slug").alias("slug"), whole("series").alias("series"), whole("volume").alias("volume"),
        F.nullif(of("issue_date"), F.lit("")).alias("issue_date"), of("author").alias("author"), listed("themes").alias("themes"), of("feature_type").alias("feature_type"), whole("page_start").alias("page_start"), whole("page_end").alias("page_end"),
        F.coalesce(whole("image_count"), F.lit(0)).alias("image_count"), F.coalesce(of("summary_es"), F.lit("")).alias("summary_es"), flag("is_featured").alias("is_featured"), flag("has_exhibition").alias("has_exhibition"), flag("has_audio").alias("has_audio"),
        F.when(of("lang_available").isNull(), F.array(F.lit("es"))).otherwise(listed("lang_available")).alias("lang_available"), listed("review").alias("review"), F.regexp_replace("text", HEADER + r"\s*", "").alias("body"),
    )


def typed_index(rows: DataFrame) -> DataFrame:
    """Index rows with numbers as numbers; the word null and empty strings are null in them."""
    numbers = ("series", "volume", "order", "page_start", "page_end", "image_count")
    return rows.withColumns({k: F.nullif(k, F.lit("null")).try_cast("int") for k in numbers})


def cover(c: Column) -> Column:
    """struct(title, author, date, image): header values by line over the whole text, and the first image.

    A value with a quote inside doesn't count; missing ones are empty.
    """
    of = lambda k: text.strip(F.regexp_extract(c, rf'(?m)^{k}:\s*"?([^"\n]+)"?\s*$', 1))
    return F.struct(of("title_es").alias("title"), of("author").alias("author"), of("issue_date").alias("date"), F.regexp_extract(c, r"!\[[^\]]*\]\((/img/[^)]+)\)", 1).alias("image"))


def source_files(pages: DataFrame, files: DataFrame) -> DataFrame:
    """Issue pages (path, text) with their source file (files: path): issue, file, skipped.

    The page's header names the file; ``skipped`` tells why there is nothing to
    read: no name, no such file, or an incomplete issue.  An issue is replayed
    only if it is null.
    """
    name = F.element_at(header(F.col("text")), "source_file")
    named = pages.select(F.col("path").alias("issue"), F.nullif(name, F.lit("")).alias("name"), (F.element_at(header(F.col("text")), "incompleta") == "true").alias("partial"))
    known = files.select(F.col("path").alias("file"), text.basename(F.col("path")).alias("name"), file_meta(F.col("path"))["incomplete"].alias("cut"))
    met = named.join(known, "name", "left")
    why = F.when(F.col("name").isNull(), "no-source").when(F.col("file").isNull(), "missing").when(F.coalesce("partial", F.lit(False)) | F.col("cut"), "incomplete")
    return met.select("issue", "file", why.alias("skipped"))


def with_overrides(issues: DataFrame, overrides: DataFrame) -> DataFrame:
    """issues (series, volume, header_date, cover_date) with issue_date: by hand (overrides: series, volume, issue_date) before the header's before the cover's."""
    from inkwright.functions import dates

    told = overrides.select("series", "volume", F.col("issue_date").alias("_told"))
    met = issues.join(told, ["series", "volume"], "left")
    return met.withColumn("issue_date", dates.issue_date(F.col("_told"), F.col("header_date"), F.col("cover_date"))).drop("_told")


def located_files(files: DataFrame, entries: DataFrame) -> DataFrame:
    """files (issue_id, path, ...) with the place (loc) of the entry (issue_id, ord, loc) that their number names; null without one."""
    number = F.regexp_extract(text.basename(F.col("path")), r"^(\d+)-", 1).try_cast("int")
    return files.withColumn("ord", number).join(entries.select("issue_id", "ord", "loc"), ["issue_id", "ord"], "left")


def queue_ids(source: DataFrame, column: str = "text") -> DataFrame:
    """queue_pos, id of every id literal in program text, also of those in comments."""
    return source.select(F.posexplode(F.regexp_extract_all(column, F.lit(r"id:\s*'([^']+)'"), F.lit(1))).alias("queue_pos", "id"))


def file_meta(c: Column) -> Column:
    """struct(volume, series, incomplete) of a file name such as 'Vol. 3 - Serie 7'; zeros without them."""
    name = text.basename(c)
    number = lambda k: F.coalesce(F.regexp_extract(name, r"Vol\.\s*(\d+)\s*-\s*Serie\s*(\d+)", k).try_cast("int"), F.lit(0))
    return F.struct(number(1).alias("volume"), number(2).alias("series"), F.lower(name).contains("incompleta").alias("incomplete"))
