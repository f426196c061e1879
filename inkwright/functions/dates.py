"""Dates that stay strings: 'YYYY-MM' of issues, 'YYYY-MM-DD' of publication."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwright.functions import text

MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
FOUND = rf"({'|'.join(MONTHS)}|setiembre)\D{{0,10}}(20\d{{2}})"


def month_date(c: Column) -> Column:
    """'YYYY-MM' of the first month name with a year close after it; null without one."""
    bare = F.lower(text.strip_accents(c))
    name = F.replace(F.regexp_extract(bare, FOUND, 1), F.lit("setiembre"), F.lit("septiembre"))
    month = F.array_position(F.array(*(F.lit(m) for m in MONTHS)), name)
    return F.when(month > 0, F.concat(F.regexp_extract(bare, FOUND, 2), F.lit("-"), F.lpad(month.cast("string"), 2, "0")))


def issue_date(override: Column, header: Column, cover: Column) -> Column:
    return F.coalesce(override, month_date(header), month_date(cover))


def pretty_date(c: Column) -> Column:
    """'mes de YYYY'; empty if c doesn't begin with YYYY-MM."""
    month = F.regexp_extract(c, r"^(\d{4})-(\d{2})", 2)
    name = F.get(F.array(*(F.lit(m) for m in MONTHS)), F.expr("0") + month.try_cast("int") - 1)
    return F.coalesce(F.concat(name, F.lit(" de "), F.substring(c, 1, 4)), F.lit(""))


def is_published(date: Column, as_of: str) -> Column:
    return date <= F.lit(as_of)
