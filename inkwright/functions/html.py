"""Rewriting of rendered article bodies, in single expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwright.functions import text

LABEL = r"(?i)<p>\s*Bibliograf[íi]a(?:\s+consultada)?\s*:?\s*(.*?)</p>"
IMAGE = r'<p><img src="([^"]*)" alt="([^"]*)"[^>]*>\s*</p>'
SEGMENT = r"(?s).*?<p>.*?</p>"


def strip_leading_title(html: Column) -> Column:
    return F.regexp_replace(html, r"(?i)\A\s*<h1[^>]*>.*?</h1>\s*", "")


def _rest(whole: Column, parts: Column) -> Column:
    """whole after the parts that it begins with."""
    return whole.substr(F.length(F.array_join(parts, "")) + 1, F.length(whole))


def _tag(name: str, inner: Column, css: str = "") -> Column:
    return F.concat(F.lit(f"<{name}" + (f' class="{css}"' if css else "") + ">"), inner, F.lit(f"</{name}>"))


def format_bibliography(html: Column) -> Column:
    """The first 'Bibliografía' paragraph as a heading, those that follow as a list.

    The list ends before a short paragraph in capitals or an image.  What lies
    between its paragraphs is dropped.
    """
    label = F.regexp_substr(html, F.lit(LABEL))
    at = F.regexp_instr(html, F.lit(LABEL))
    inline = text.strip(F.regexp_extract(html, LABEL, 1))
    after = html.substr(at + F.length(label), F.length(html))
    segments = F.regexp_extract_all(after, F.lit(SEGMENT), F.lit(0))
    inner = lambda s: text.strip(F.regexp_extract(s, r"(?s)^.*?<p>(.*?)</p>$", 1))

    def ends(segment: Column) -> Column:
        raw = inner(segment)
        plain = F.regexp_replace(raw, "<[^>]+>", "")
        letters = F.regexp_replace(plain, "[^A-Za-zÀ-ÿ]", "")
        short = F.size(F.split(text.strip(plain), r"(?U)\s+")) <= 6
        return (F.length(letters) > 3) & (letters == F.upper(letters)) & short | raw.rlike(r"^<img\b")

    stop = F.array_position(F.transform(segments, ends), F.lit(True))
    taken = F.when(stop > 0, F.slice(segments, F.lit(1), (stop - 1).cast("int"))).otherwise(segments)
    items = F.filter(F.concat(F.array(inline), F.transform(taken, inner)), lambda x: x != "")
    listed = F.when(F.size(items) > 0, _tag("ul", F.array_join(F.transform(items, lambda x: _tag("li", x)), ""), "bibliography")).otherwise("")
    whole = F.concat(html.substr(F.lit(1), at - 1), _tag("h2", F.lit("Bibliografía"), "bib-heading"), listed, _rest(after, taken))
    return F.when(at > 0, whole).otherwise(html)


def wrap_images(html: Column) -> Column:
    """Captioned images as figures; each run of others as one gallery."""
    segments = F.regexp_extract_all(html, F.lit(f"(?s).*?{IMAGE}"), F.lit(0))
    picture = lambda src: F.concat(F.lit('<img src="'), src, F.lit('" alt=""'), F.lit(' loading="lazy" />'))
    flushed = lambda s: F.when(s["run"] == "", s["out"]).otherwise(F.concat(s["out"], _tag("div", s["run"], "article-gallery")))
    state = F.struct(F.lit("").alias("out"), F.lit("").alias("run"))

    def step(s: Column, segment: Column) -> Column:
        between = segment.substr(F.lit(1), F.regexp_instr(segment, F.lit(IMAGE)) - 1)
        src, alt = F.regexp_extract(segment, IMAGE, 1), F.regexp_extract(segment, IMAGE, 2)
        gap = text.strip(between) != ""
        out = F.concat(F.when(gap, flushed(s)).otherwise(s["out"]), between)
        run = F.when(gap, "").otherwise(s["run"])
        figure = _tag("figure", F.concat(picture(src), _tag("figcaption", alt)), "article-figure")
        held = F.struct(out.alias("out"), run.alias("run"))
        return F.when(alt != "", F.struct(F.concat(flushed(held), figure).alias("out"), F.lit("").alias("run"))).otherwise(F.struct(out.alias("out"), F.concat(run, picture(src)).alias("run")))

    return F.when(F.size(segments) == 0, html).otherwise(F.concat(F.aggregate(segments, state, step, flushed), _rest(html, segments)))


def first_image_src(html: Column) -> Column:
    return F.regexp_extract(F.regexp_substr(html, F.lit('<img src="[^"]*"')), '"([^"]*)"', 1)


def article_body(html: Column) -> Column:
    return wrap_images(format_bibliography(strip_leading_title(html)))
