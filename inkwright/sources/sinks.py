"""Written forms of articles, issues and indexes, as columns and as files."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwright.functions import text

NO_BODY = "_(sin cuerpo)_"


def article_markdown(a: dict[str, Column]) -> Column:
    """An article's file: 18 header lines, its title, paragraphs (or a note) and the names of its images.

    ``a`` has title, slug, series, volume, issue_date, author, themes, feature_type,
    page_start, page_end, images, summary, review, paragraphs.  Only quotes are escaped.
    """
    number = lambda c: F.when(c.isNull() | (c == 0), "null").otherwise(c.cast("string"))
    names = F.transform(a["images"], lambda i: F.concat(F.lit("  - "), text.basename(i)))
    lines = [
        ("title_es", text.quoted(a["title"])), ("title_en", F.lit('""')), ("slug", a["slug"]), ("series", a["series"].cast("string")), ("volume", a["volume"].cast("string")),
        ("issue_date", F.coalesce(F.nullif(a["issue_date"], F.lit("")), F.lit('""'))), ("author", text.quoted(a["author"])), ("themes", F.concat(F.lit("["), F.array_join(F.transform(a["themes"], text.quoted), ", "), F.lit("]"))),
        ("feature_type", a["feature_type"]), ("page_start", number(a["page_start"])), ("page_end", number(a["page_end"])), ("image_count", F.size(a["images"]).cast("string")), ("summary_es", text.quoted(a["summary"])),
        ("is_featured", F.lit("false")), ("has_exhibition", F.lit("false")), ("has_audio", F.lit("false")), ("lang_available", F.lit("[es]")), ("review", F.concat(F.lit("["), F.array_join(a["review"], ", "), F.lit("]"))),
    ]
    head = F.concat_ws("\n", F.lit("---"), *(F.concat(F.lit(f"{k}: "), v) for k, v in lines), F.lit("---"), F.lit(""), F.concat(F.lit("# "), a["title"]), F.lit(""))
    body = F.when(F.size(a["paragraphs"]) > 0, F.array_join(a["paragraphs"], "\n\n")).otherwise(NO_BODY)
    tail = F.when(F.size(a["images"]) > 0, F.concat(F.lit("\n\n---\n\n<!-- IMÁGENES "), F.size(a["images"]).cast("string"), F.lit(":\n"), F.array_join(names, "\n"), F.lit("\n-->\n"))).otherwise("")
    return F.concat(head, F.lit("\n"), body, tail, F.lit("\n"))


#: Fixed text above the images that no caption claims.
LOOSE = "<!-- Imágenes sin posición asignada — mueve cada línea al lugar del texto que le corresponda, o bórrala si no aplica. -->"


def with_figures(articles: DataFrame, placed: DataFrame, gallery: DataFrame, root: str = "/img/") -> DataFrame:
    """articles (article_id, text: whole files) with captions replaced by images, loose images at the end and the header's count set, as column edited.

    ``placed`` has article_id, cap_pos, caption, file (a null file leaves its caption
    as it is), ``gallery`` article_id, file, first (the order).  The input is never
    overwritten.
    """
    web = F.concat(F.lit(root), F.col("article_id").cast("string"), F.lit("/"), text.with_extension(F.col("file"), "webp"))
    own = placed.where("file is not null").groupBy("article_id").agg(F.array_sort(F.collect_list(F.struct("cap_pos", "caption", web.alias("path")))).alias("_placed"))
    loose = gallery.groupBy("article_id").agg(F.array_sort(F.collect_list(F.struct("first", web.alias("path")))).alias("_loose"))
    met = articles.join(own, "article_id", "left").join(loose, "article_id", "left")

    def put(state: Column, p: Column) -> Column:
        after = text.place_image(state["text"], p["caption"], p["path"])
        return F.struct(after.alias("text"), (state["n"] + (after != state["text"]).cast("int")).alias("n"))

    begin = F.struct(text.drop_image_comments(F.col("text")).alias("text"), F.lit(0).alias("n"))
    done = met.withColumn("_done", F.when(F.col("_placed").isNull(), begin).otherwise(F.aggregate("_placed", begin, put)))
    n, more, body = F.col("_done")["n"], F.coalesce(F.size("_loose"), F.lit(0)), F.col("_done")["text"]
    more = F.when(more > 0, more).otherwise(0)
    block = F.concat(F.regexp_replace(body, r"\n+\z", ""), F.lit(f"\n\n\n{LOOSE}\n\n"), F.array_join(F.transform("_loose", lambda p: F.concat(F.lit("![]("), p["path"], F.lit(")"))), "\n\n"), F.lit("\n"))
    note = F.concat(F.lit("   # "), n.cast("string"), F.lit(" colocadas en el texto, "), more.cast("string"), F.lit(" sueltas al final"))
    return done.withColumn("edited", text.set_image_count(F.when(more > 0, block).otherwise(body), n + more, note)).drop("_placed", "_loose", "_done")


def webp(content: Column, longest: int = 1400, quality: int = 82) -> Column:
    """Images encoded as WebP, the longer side at most ``longest``; needs Pillow on the workers."""

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            from PIL import Image
        except ImportError as e:
            raise RuntimeError("encoding images needs Pillow") from e
        for column in batches:
            out = []
            for raw in column:
                image = Image.open(io.BytesIO(raw))
                side = max(image.size)
                if side > longest:
                    image = image.resize(tuple(round(v * longest / side) for v in image.size))
                held = io.BytesIO()
                image.save(held, "WEBP", quality=quality)
                out.append(held.getvalue())
            yield pd.Series(out)

    return encode(content)


def contents_table(entries: DataFrame) -> DataFrame:
    """issue_id, contents: the rows of an issue's table of contents, from issue_id, ord, title, page.

    Dropped sections are left out; the directory has a row without a file; a missing page is '?'.
    """
    from inkwright.operators.sequence import SKIPPED

    title, number = F.col("title"), F.lpad(F.col("ord").cast("string"), 2, "0")
    page = F.coalesce(F.col("page").cast("string"), F.lit("?"))
    link = F.concat(F.lit("["), number, F.lit("]("), number, F.lit("-"), text.slugify(title), F.lit(".md)"))
    directory = text.feature_type(title) == "directorio"
    row = F.concat(F.lit("| "), F.when(directory, "Directorio").otherwise(title), F.lit(" | "), page, F.lit(" | "), F.when(directory, "—").otherwise(link), F.lit(" |"))
    kept = entries.where(~text.norm_key(title).isin(SKIPPED)).select("issue_id", F.struct("ord", row.alias("line")).alias("r"))
    return kept.groupBy("issue_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "\n").alias("contents"))


def write_index_csv(rows: DataFrame, path: str) -> None:
    """The index as one CSV file with a header, in the order of its files: an index has a row for each article."""
    rows.orderBy("file").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_documents(df: DataFrame, path: str, by: list[str]) -> None:
    """Texts (column value) below a folder for each value of ``by``."""
    df.select(*by, "value").write.mode("overwrite").partitionBy(*by).option("lineSep", "\n").text(path)


def body_json(html: Column) -> Column:
    return F.to_json(F.struct(html.alias("html")))


def fitted_size(width: Column, height: Column, longest: int = 1400) -> Column:
    """struct(width, height) scaled so that the longer side has at most ``longest`` pixels."""
    side = F.greatest(width, height)
    scaled = lambda v: F.when(side > longest, F.bround(v * longest / side).cast("int")).otherwise(v)
    return F.struct(scaled(width).alias("width"), scaled(height).alias("height"))
