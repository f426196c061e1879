"""A folder of articles as a stream: files are indexed as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkwright.sources import front_matter


def watch_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Index rows of Markdown files below a folder, as a streaming DataFrame."""
    files = spark.readStream.text(folder, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=True)
    return front_matter.index_rows(files.select(F.input_file_name().alias("path"), F.col("value").alias("text")))


def keep_index(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends index rows to a Parquet table; each file is indexed exactly once, also over restarts."""
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
