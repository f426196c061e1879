"""Publication queries over a queue (queue_pos, id, publish_date, locked, teaser, type, cover_align, featured)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwright.functions import dates, text


def published(queue: DataFrame, as_of: str) -> DataFrame:
    return queue.where(dates.is_published(F.col("publish_date"), as_of)).withColumn("id", text.plain_id(F.col("id")))


def home_feed(queue: DataFrame, articles: DataFrame, as_of: str, most: int = 5) -> DataFrame:
    """The first entries by pin, then newest, then queue order, with their articles; entries without one leave gaps.

    The limit comes before the lookup, so a missing article makes the feed
    shorter.  The limited side has ``most`` rows and is broadcast.
    """
    top = published(queue, as_of).orderBy(F.col("featured").asc_nulls_last(), F.desc("publish_date"), "queue_pos").limit(most)
    return _with_defaults(articles.join(F.broadcast(top), "id"))


def archive_feed(queue: DataFrame, articles: DataFrame, as_of: str) -> DataFrame:
    """All published entries that have an article, newest first, then in queue order."""
    return _with_defaults(published(queue, as_of).join(articles, "id")).orderBy(F.desc("publish_date"), "queue_pos")


def locked(queue: DataFrame, articles: DataFrame, as_of: str) -> DataFrame:
    """Articles whose published entry is locked."""
    return articles.join(published(queue, as_of).where("locked"), "id", "left_semi")


def _with_defaults(feed: DataFrame) -> DataFrame:
    """An empty teaser counts as one; only a missing one falls back to the summary."""
    return feed.withColumns({"summary": F.coalesce("teaser", "summary_es"), "type": F.coalesce("type", F.lit("articulo")), "cover_align": F.coalesce("cover_align", F.lit("center"))})


def page_label(first: Column, last: Column) -> Column:
    """'3' or '3–5'; the second page only if it is another one."""
    return F.when(last.isNotNull() & (last != first), F.concat(first.cast("string"), F.lit("–"), last.cast("string"))).otherwise(first.cast("string"))
