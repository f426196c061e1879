"""Index and data-quality aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.functions import text


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(*columns)


def tally(df: DataFrame, column: str, sign: str = "; ") -> DataFrame:
    """Values of a multi-valued column with their counts, the most frequent first, then by value."""
    each = df.select(F.explode(F.split(column, sign)).alias("value")).where("value != ''")
    return each.groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def issue_anomalies(issues: DataFrame, articles: DataFrame, few: int = 3) -> DataFrame:
    """issues (series, volume, issue_date, incompleta) with n and warnings."""
    counts = articles.groupBy("series", "volume").agg(F.count("*").alias("n"))
    found = issues.join(counts, ["series", "volume"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    missing = F.coalesce(F.col("issue_date"), F.lit("")) == ""
    warnings = F.array_compact(F.array(F.when(missing, "NO-DATE"), F.when(F.col("n") <= few, "FEW-ARTICLES"), F.when(F.col("incompleta"), "INCOMPLETA")))
    return found.withColumn("warnings", warnings)


def totals(articles: DataFrame, images: DataFrame) -> DataFrame:
    """One row: issues, articles, placed and loose images, articles with figures. images: article_id, caption, file."""
    own = articles.agg(F.count_distinct("series", "volume").alias("issues"), F.count("*").alias("articles"))
    placed = (F.coalesce(F.col("caption"), F.lit("")) != "").cast("int")
    return own.join(images.agg(F.sum(placed).alias("placed"), F.sum(1 - placed).alias("loose"), F.count_distinct("article_id").alias("with_figures")), F.lit(True))


def repeated_routes(articles: DataFrame) -> DataFrame:
    """Public keys that several articles share."""
    keyed = articles.withColumn("route", text.route_slug(F.col("series"), F.col("volume"), F.col("slug")))
    return keyed.groupBy("route").agg(F.count("*").alias("n")).where("n > 1")


def review_flags(articles: DataFrame) -> DataFrame:
    """articles (author_unconfirmed, paragraphs, themes, issue_date, loc) with their review flags."""
    flags = F.array(
        F.when(F.col("author_unconfirmed"), "author-unconfirmed"), F.when(F.coalesce(F.size("paragraphs"), F.lit(0)) <= 0, "empty-body"), F.when(F.size("themes") > 0, "theme-guessed"), F.when(F.col("issue_date").isNull(), "date-missing"), F.when(F.col("loc").isNull(), "heading-image-only")
    )
    return articles.withColumn("review", F.array_compact(flags))
