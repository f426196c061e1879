"""Text normalisation and classification, as Spark columns.

Everything is built from JVM-side functions.  Null in, null out, unless a
function says otherwise.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _accents() -> tuple[str, str]:
    """Letters that are a base letter with marks, and the base letters."""
    pairs = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        parts = unicodedata.normalize("NFD", chr(code))
        bare = "".join(c for c in parts if unicodedata.category(c) != "Mn")
        if len(parts) > 1 and len(bare) == 1:
            pairs[chr(code)] = bare
    return "".join(pairs), "".join(pairs.values())


ACCENTED, BARE = _accents()
#: What \s of (?U) stands for.
BLANKS = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
WORD_CUT = r"(?U)(?<=\b\w) (?=\w \w\b)|(?<=\b\w \w) (?=\w\b)"
ROMAN = "^[ivxlcdm]+$"

#: Key prefixes (``^``) and parts that tell a title's type, in order.
FEATURE_RULES = (
    ("editorial", "^editorial"),
    ("sello-con-historia", "^unselloconhistoria"),
    ("novedades", "novedades|nuevasemisiones"),
    ("sobresaliente", "^elsobresaliente"),
    ("credo", "credo"),
    ("directorio", "^directorio"),
)
DEFAULT_FEATURE = "investigacion"


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are worked out once for each row; else each filter and expression on one repeats all of it."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def collapse_spacing(c: Column) -> Column:
    """Joins runs of three or more single letters, squeezes blanks, strips.

    The middle one of three single letters has a blank on each side and a single
    letter after it, so the costlier pattern is tried only on text with such a letter.
    """
    joined = F.when(c.rlike(r" \S (?=\S(?![\p{L}\p{Nd}]))"), F.regexp_replace(c, WORD_CUT, "")).otherwise(c)
    return strip(F.regexp_replace(joined, r"[ \t]{2,}", " "))


def strip_accents(c: Column) -> Column:
    return F.translate(F.regexp_replace(c, r"\p{Mn}", ""), ACCENTED, BARE)


def norm_key(c: Column) -> Column:
    """Letters a to z and digits of c; marks and blanks, joined or not, are among what goes."""
    bare = F.when(F.length(c) == F.octet_length(c), c).otherwise(F.translate(c, ACCENTED, BARE))
    return F.regexp_replace(F.lower(bare), "[^a-z0-9]+", "")


def slugify(c: Column, longest: int = 60, collapse: bool = True) -> Column:
    """c as a slug; spaced single letters are one word, unless ``collapse`` is off."""
    dashed = F.regexp_replace(F.lower(strip_accents(collapse_spacing(c) if collapse else c)), "[^a-z0-9]+", "-")
    return F.btrim(F.substring(F.btrim(dashed, F.lit("-")), 1, longest), F.lit("-"))


def no_space(c: Column) -> Column:
    """Capitals without accents and blanks, so it doesn't matter whether spaced letters were joined."""
    return F.upper(F.translate(strip_accents(c), BLANKS, ""))


def upper_ratio(c: Column) -> Column:
    """Share of capitals among letters; 0 without letters."""
    letters, capitals = (F.length(F.regexp_replace(c, kind, "")) for kind in (r"\P{L}+", r"\P{Lu}+"))
    return capitals / F.greatest(letters, F.lit(1))


def is_title_line(c: Column) -> Column:
    return upper_ratio(c) > 0.7


def strip_leaders(c: Column) -> Column:
    flat = F.regexp_replace(F.regexp_replace(c, "[.…]{2,}", " "), r"(?U)\s{2,}", " ")
    return strip(F.rtrim(strip(flat), F.lit(".")))


def sentence_case(c: Column, propers: Column, canonical: dict[str, str] | None = None) -> Column:
    """First word and proper nouns capitalised, roman numerals of two letters or more upper, the rest lower.

    ``propers`` is an array of lower-case words; ``canonical`` has fixed forms by key.
    """
    low = F.lower(strip(F.rtrim(strip(collapse_spacing(c)), F.lit("."))))
    parts = F.regexp_extract_all(low, F.lit(r"(?U)(\s+|[–—-]|[^\s–—-]+)"), F.lit(1))
    is_word = lambda p: ~p.rlike(r"(?U)^(\s+|[–—-])$")
    first = F.array_position(F.transform(parts, is_word), F.lit(True)) - 1
    cap = lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.expr("''"), p.substr(F.lit(2), F.length(p)))
    case = lambda p, i: F.when(~is_word(p), p).when(p.rlike(ROMAN) & (F.length(p) > 1), F.upper(p)).when((i == first) | F.array_contains(propers, p), cap(p)).otherwise(p)
    cased = F.array_join(F.transform(parts, case), "")
    for key, fixed in (canonical or {}).items():
        cased = F.when(norm_key(c) == key, F.lit(fixed)).otherwise(cased)
    return cased


def canonical_name(c: Column, rules: list[tuple[list[str], str]]) -> Column:
    """The name of the first rule whose parts all occur in c (no accents, lower case), else c without its final dots."""
    bare = F.lower(strip_accents(c))
    out = F.rtrim(collapse_spacing(c), F.lit("."))
    for parts, name in reversed(rules):
        met = F.lit(True)
        for p in parts:
            met = met & bare.contains(p)
        out = F.when(met, F.lit(name)).otherwise(out)
    return F.when(c.isNotNull(), out)


def feature_type(c: Column) -> Column:
    def of(key: Column) -> Column:
        out = F.lit(DEFAULT_FEATURE)
        for name, pattern in reversed(FEATURE_RULES):
            out = F.when(key.rlike(pattern), name).otherwise(out)
        return F.when(key.isNotNull(), out)

    # as a lambda's variable, the key is made once
    return F.get(F.transform(F.array(norm_key(c)), of), F.lit(0))


def occurrences(hay: Column, needle: str) -> Column:
    """Non-overlapping occurrences."""
    return ((F.length(hay) - F.length(F.replace(hay, F.lit(needle), F.lit("")))) / len(needle)).cast("int")


def guess_theme(hay: Column, vocabulary: list[tuple[str, list[str]]], default: str) -> Column:
    """The theme with the most stems in hay; the first of equals; default without any."""
    bare = strip_accents(F.lower(hay))
    scored = [F.struct(sum((occurrences(bare, s) for s in stems), F.lit(0)).alias("score"), F.lit(-k).alias("rank"), F.lit(theme).alias("theme")) for k, (theme, stems) in enumerate(vocabulary)]
    best = F.array_max(F.array(*scored))
    return F.when(best["score"] > 0, best["theme"]).otherwise(default)


def summary(c: Column, words: int = 40) -> Column:
    return F.array_join(F.slice(F.split(strip(c), r"(?U)\s+"), 1, words), " ")


def split_features(c: Column, phrases: list[str]) -> Column:
    """struct(prefix, features): c without the recurring phrases at its end, and these, in order. The prefix keeps a word."""
    chain = "|".join(sorted(phrases, key=len, reverse=True))
    size = lambda p: F.size(F.split(p, " "))
    sizes = lambda ps: F.aggregate(ps, F.lit(0), lambda a, p: a + size(p))
    # as lambdas' variables, the words and the phrases are found once
    let = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))

    def phrased(words: Column) -> Column:
        line = F.array_join(F.transform(words, lambda w: F.btrim(F.lower(strip_accents(w)), F.lit(".,;:¿?¡!"))), " ")
        tail = F.regexp_extract(line, rf"^.+?((?: (?:{chain}))*)$", 1)
        return let(F.regexp_extract_all(tail, F.lit(rf" ({chain})(?= |$)"), F.lit(1)), lambda found: let(F.size(words) - sizes(found), lambda kept: parted(words, found, kept)))

    def parted(words: Column, found: Column, kept: Column) -> Column:
        features = F.transform(found, lambda p, i: F.array_join(F.slice(words, kept + sizes(F.slice(found, F.lit(1), i)) + 1, size(p)), " "))
        return F.struct(F.array_join(F.slice(words, F.lit(1), kept), " ").alias("prefix"), features.alias("features"))

    return let(F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != ""), phrased)


def detect_byline(paragraphs: Column, rules: list[tuple[list[str], str]], default: str, within: int = 6, longest: int = 60) -> Column:
    """struct(author, unconfirmed, position): the first byline of the first paragraphs; position from 1, null without one."""
    pattern = r"(?i)^\s*(?:por|texto de|escrito por)\s*[:\-]?\s*(.+)$"
    fits = lambda p: p.rlike(pattern) & (F.length(F.regexp_extract(p, pattern, 1)) < longest)
    at = F.array_position(F.transform(F.slice(paragraphs, 1, within), fits), F.lit(True))
    name = canonical_name(F.regexp_extract(F.element_at(paragraphs, F.when(at > 0, at).otherwise(1).cast("int")), pattern, 1), rules)
    found = at > 0
    return F.struct(F.when(found, name).otherwise(default).alias("author"), F.coalesce(~found, F.lit(True)).alias("unconfirmed"), F.when(found, at.cast("int")).alias("position"))


def drop_repeated_subtitle(paragraphs: Column, title: Column) -> Column:
    """paragraphs without a first one that is all capitals and part of the title."""
    first = F.try_element_at(paragraphs, F.lit(1))
    repeats = first.rlike(r"\p{L}") & (first == F.upper(first)) & F.contains(norm_key(title), norm_key(first))
    return F.when(F.coalesce(repeats, F.lit(False)), F.slice(paragraphs, F.lit(2), F.size(paragraphs))).otherwise(paragraphs)


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('\\"')), F.lit('"'))


CAPTION = r"^\(\d+\)\.?\s"


def is_caption(c: Column) -> Column:
    return collapse_spacing(c).rlike(CAPTION)


def caption_text(c: Column) -> Column:
    return strip(F.regexp_replace(collapse_spacing(c), r"^\(\d+\)\.?\s*", ""))


def basename(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def with_extension(c: Column, extension: str) -> Column:
    """The file name with another extension; one without gets it."""
    return F.concat(F.regexp_replace(basename(c), r"(?<=.)\.[^.]*$", ""), F.lit("." + extension))


def place_image(body: Column, caption: Column, path: Column, longest: int = 80) -> Column:
    """body with the first numbered line that begins with the caption replaced by an image."""
    key = F.substring(caption, 1, longest)
    literal = F.concat(F.lit(r"\Q"), F.replace(key, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    pattern = F.concat(F.lit(r"\(\d+\)\.?\s*"), literal, F.lit(r"[^\n]*"))
    at = F.regexp_instr(body, pattern)
    old = F.regexp_substr(body, pattern)
    image = F.concat(F.lit("!["), caption, F.lit("]("), path, F.lit(")"))
    return F.when(at > 0, F.concat(body.substr(F.lit(1), at - 1), image, body.substr(at + F.length(old), F.length(body)))).otherwise(body)


def drop_image_comments(body: Column) -> Column:
    return F.regexp_replace(body, r"(?s)\n*<!-- IMÁGENES.*?-->\n*", "\n")


def set_image_count(header: Column, total: Column, note: Column | None = None) -> Column:
    """The first image_count line with another number (and a note behind it), if that is above 0."""
    pattern = F.lit(r"image_count:\s*\d+\s*(#.*)?")
    at, old = F.regexp_instr(header, pattern), F.regexp_substr(header, pattern)
    new = F.concat(header.substr(F.lit(1), at - 1), F.lit("image_count: "), total.cast("string"), F.lit("") if note is None else note, header.substr(at + F.length(old), F.length(header)))
    return F.when((total > 0) & (at > 0), new).otherwise(header)


def route_slug(series: Column, volume: Column, slug: Column) -> Column:
    return F.concat(F.lit("s"), series.cast("string"), F.lit("v"), volume.cast("string"), F.lit("-"), slug)


def plain_id(c: Column) -> Column:
    return F.regexp_replace(c, r"\.md$", "")


def wrap_words(c: Column, width: int) -> Column:
    """Lines of whole words, filled greedily; a longer word has a line of its own. Width counts characters."""
    words = F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")
    state = F.struct(F.expr("cast(array() as array<string>)").alias("lines"), F.lit("").alias("line"))
    trial = lambda s, w: F.ltrim(F.concat(s["line"], F.lit(" "), w))
    closed = lambda s: F.when(s["line"] == "", s["lines"]).otherwise(F.array_append(s["lines"], s["line"]))
    step = lambda s, w: F.when(F.length(trial(s, w)) <= width, F.struct(s["lines"].alias("lines"), trial(s, w).alias("line"))).otherwise(F.struct(closed(s).alias("lines"), w.alias("line")))
    return F.aggregate(words, state, step, closed)


def clean_secret(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, "[​-‍⁠﻿]", ""), " ", " "))


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def md5_prefix(c: Column, length: int = 10) -> Column:
    return F.substring(F.md5(c.cast("binary")), 1, length)


def url_component(c: Column) -> Column:
    """Percent-encoding that keeps A-Z a-z 0-9 - _ . ! ~ * ' ( )."""
    out = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    for code, sign in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(sign))
    return out


def joined_list(c: Column) -> Column:
    return F.array_join(c, "; ")
