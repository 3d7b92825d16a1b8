"""Article schema and enum values."""

from __future__ import annotations

from pyspark.sql import types as T

# Article sources, processing levels and content tiers.
SOURCES = ("rss", "web_url", "github", "email", "manual", "feishu")
LEVELS = ("raw", "l1", "l2", "l3", "archived")
TIERS = ("", "discard", "compressed", "detailed")

CONCEPT = T.StructType([T.StructField("name", T.StringType()), T.StructField("definition", T.StringType())])

# Columns every source builder emits, in this order.
ARTICLE = T.StructType([
    T.StructField("ord", T.LongType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("content_raw", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("content_hash", T.StringType()),
])

ARTICLE_COLUMNS = [f.name for f in ARTICLE.fields]

# Order in which sources are ranked when several are read in one run: ord = rank * 2^40 + natural order.
SOURCE_RANK = {"rss": 0, "web_url": 1, "feishu": 2, "github": 3, "email": 4}
ORD_STRIDE = 1 << 40
