"""Feed files -> feed_entries table (O-S1, O-S2).

``feed_files`` reads the files; here entries get their number over all files, the feed's name (the file's base name) and
page text from an optional ``pages`` table joined on the link (the download itself is not rebuilt).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notesmith.functions.html import html_to_text
from notesmith.operators.ranking import balanced_row_number
from notesmith.sources.feed_files import read_feed_files


def read_rss(spark: SparkSession, path: str, pages: DataFrame | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Columns: ord, feed, link, title, page_text, content, description, summary, author, published.

    ``ord`` counts entries by file and place. Pass ``rows`` (of ``read_feed_files``, written) to use its errors as well."""
    found = (rows if rows is not None else read_feed_files(spark, path)).where("error is null")
    text = lambda *names: F.coalesce(*names, F.lit(""))
    entries = found.select(
        "file", "place", F.regexp_extract("file", r"([^/]+?)(\.[^./]*)?$", 1).alias("feed"), text("link").alias("link"), "title",
        text("content").alias("content"), text("description").alias("description"), text("description").alias("summary"),
        text("author", "creator").alias("author"), F.coalesce("published", "updated").alias("published"))
    entries = balanced_row_number(entries, [], ["file", "place"], "ord").withColumn("ord", F.col("ord") - 1).drop("file", "place")
    cols = ["ord", "feed", "link", "title", "page_text", "content", "description", "summary", "author", "published"]
    if pages is None:
        return entries.withColumn("page_text", F.lit("")).select(cols)
    # A URL held twice is one page, the smaller text; entries without a link have none.
    one = pages.where(F.length("url") > 0).groupBy(F.col("url").alias("link")).agg(F.min("html").alias("html"))
    page_text = one.select("link", html_to_text("html").alias("page_text"))
    return entries.join(page_text, "link", "left").withColumn("page_text", text("page_text")).select(cols)
