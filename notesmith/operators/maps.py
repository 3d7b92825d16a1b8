"""Topic-map pages (O-G3, O-G4, O-A5, O-A6, O-W6, O-O3, O-K3).

Pages are emitted as ordered text chunks — (page, sec, k1, k2, line) — and a page is
its chunks joined by newlines in key order. No topic's member list is ever gathered
into one row, so a topic holding a third of all notes renders like any other; the
sink range-partitions on the keys and writes each page folder in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notesmith.functions.text import topic_slug, wikilink
from notesmith.operators.notes import resolve_collisions, yaml_quoted
from notesmith.operators.publication import publish, published

# Page headings and labels of the topic pages and the index.
INDEX_TITLE = "知识地图总览"
TOPIC_TAGS_HEADING = "## 主题标签\n"
TOPIC_LIST_HEADING = "## 文章列表\n"
INDEX_OVERVIEW_HEADING = "## 主题概览\n"
INDEX_TABLE_HEAD = "| 主题 | 文章数 | 核心标签 |"
INDEX_TABLE_RULE = "|------|--------|----------|"
INDEX_PAGE = "MOC-Index.md"
TOP_PER_TOPIC = 5


def _chunk(page, sec: int, k1, k2, line) -> Column:
    return F.struct(page.alias("page") if isinstance(page, Column) else F.lit(page).alias("page"),
                    F.lit(sec).alias("sec"), F.lit(k1).cast("long").alias("k1") if not isinstance(k1, Column)
                    else k1.cast("long").alias("k1"),
                    F.lit(k2).cast("long").alias("k2") if not isinstance(k2, Column) else k2.cast("long").alias("k2"),
                    line.alias("line"))


def _tags_yaml(tags: Column) -> Column:
    return F.when(F.size(tags) > 0, F.concat(F.lit("tags:\n"), F.array_join(
        F.transform(tags, lambda t: F.concat(F.lit("- "), yaml_quoted(t))), "\n"))).otherwise(F.lit("tags: []"))


def moc_link(name, page) -> Column:
    return F.concat(F.lit("[["), F.regexp_replace(page, r"\.md$", ""), F.lit("|"), name, F.lit("]]"))


def member_line(m: DataFrame) -> Column:
    """'- [[stem|title]]' + ' — *source*' + up to three '#tag'."""
    src = F.coalesce(F.col("source_name"), F.lit(""))
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>"))
    return F.concat(F.lit("- "), wikilink("path", "title"),
                    F.when(F.length(src) > 0, F.concat(F.lit(" — *"), src, F.lit("*"))).otherwise(F.lit("")),
                    F.when(F.size(tags) > 0, F.concat(F.lit(" "), F.array_join(
                        F.transform(F.slice(tags, 1, 3), lambda t: F.concat(F.lit("#"), t)), " "))).otherwise(F.lit("")))


def with_pages(topics: DataFrame) -> DataFrame:
    """``topics`` with ``page``, its file name: 'MOC-slug.md', and by the rule of note names (O-W4) 'MOC-slug-1.md' ... where
    topics share a slug, in the order of their ids."""
    if "page" in topics.columns:
        return topics
    named = topics.select("topic_id", F.lit("").alias("dir"), F.concat(F.lit("MOC-"), topic_slug("name"), F.lit(".md")).alias("filename"))
    pages = resolve_collisions(named, key="topic_id").select("topic_id", F.col("filename").alias("page"))
    return topics.join(pages, "topic_id")


def topic_pages(topics: DataFrame, members: DataFrame, as_of: str) -> DataFrame:
    """O-G3: one page per topic: frontmatter (sorted keys), heading, counts, core tags, members by
    relevance (desc, stable in note order) with source and three tags."""
    topics = with_pages(topics)
    page = F.col("page")
    core = F.coalesce(F.col("core_tags"), F.array().cast("array<string>"))
    fm = F.concat_ws("\n", F.concat(F.lit("article_count: "), F.col("size").cast("string")),
                     F.lit("auto_generated: true"), F.concat(F.lit("generated: "), yaml_quoted(F.lit(as_of))),
                     _tags_yaml(core), F.concat(F.lit("title: "), yaml_quoted(F.concat(F.lit("MOC: "), F.col("name")))),
                     F.lit('type: "moc"'))
    header = F.array(
        _chunk(page, 0, 0, 0, F.concat(F.lit("---\n"), fm, F.lit("\n---\n"))),
        _chunk(page, 0, 1, 0, F.concat(F.lit("# MOC: "), F.col("name"), F.lit("\n"))),
        _chunk(page, 0, 2, 0, F.concat(F.lit("> "), F.col("size").cast("string"), F.lit(" 篇文章 | 生成于 "),
                                       F.lit(as_of), F.lit("\n"))),
    )
    tag_part = F.when(F.size(core) > 0, F.array(
        _chunk(page, 0, 3, 0, F.lit(TOPIC_TAGS_HEADING)),
        _chunk(page, 0, 4, 0, F.array_join(F.transform(core, lambda t: F.concat(F.lit("#"), t)), " ")),
        _chunk(page, 0, 5, 0, F.lit("")))).otherwise(F.array())
    tail = F.array(_chunk(page, 0, 6, 0, F.lit(TOPIC_LIST_HEADING)), _chunk(page, 2, 0, 0, F.lit("")))
    fixed = topics.select(F.explode(F.concat(header, tag_part, tail)).alias("c")).select("c.*")
    names = topics.select("topic_id", page.alias("page"))
    rows = members.join(names, "topic_id", "inner").select(
        "page", F.lit(1).alias("sec"), (-F.col("relevance")).cast("long").alias("k1"), F.col("ord").cast("long").alias("k2"),
        member_line(members).alias("line"))
    return fixed.unionByName(rows)


def topic_index(topics: DataFrame, members: DataFrame, as_of: str) -> DataFrame:
    """O-G4 (+O-A5, O-W6): totals, a table row per topic (three tags), then per topic its five most
    relevant notes and an 'n more' line. Rows are (sec, k1, k2, line) of the single index page."""
    topics = with_pages(topics)
    totals = topics.agg(F.count(F.lit(1)).cast("long").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).cast("long")
                        .alias("total"))
    fm = F.concat_ws("\n", F.lit("auto_generated: true"), F.concat(F.lit("generated: "), yaml_quoted(F.lit(as_of))),
                     F.concat(F.lit("title: "), yaml_quoted(F.lit(INDEX_TITLE))),
                     F.concat(F.lit("topic_count: "), F.col("n").cast("string")),
                     F.concat(F.lit("total_articles: "), F.col("total").cast("string")), F.lit('type: "moc-index"'))
    head_lines = [
        F.concat(F.lit("---\n"), fm, F.lit("\n---\n")),
        F.lit(f"# {INDEX_TITLE}\n"),
        F.concat(F.lit("> "), F.col("n").cast("string"), F.lit(" 个主题 | "), F.col("total").cast("string"),
                 F.lit(" 篇文章 | 更新于 "), F.lit(as_of), F.lit("\n")),
        F.lit(INDEX_OVERVIEW_HEADING), F.lit(INDEX_TABLE_HEAD), F.lit(INDEX_TABLE_RULE),
    ]
    head = totals.select(F.explode(F.array(*[_chunk("", 0, i, 0, ln) for i, ln in enumerate(head_lines)])).alias("c"))
    core = F.coalesce(F.col("core_tags"), F.array().cast("array<string>"))
    table = topics.select(_chunk("", 1, F.col("topic_order"), 0, F.concat(
        F.lit("| "), moc_link(F.col("name"), F.col("page")), F.lit(" | "), F.col("size").cast("string"), F.lit(" | "),
        F.array_join(F.transform(F.slice(core, 1, 3), lambda t: F.concat(F.lit("#"), t)), ", "), F.lit(" |"))).alias("c"))
    gap = totals.select(_chunk("", 2, 0, 0, F.lit("")).alias("c"))
    sections = topics.select(F.explode(F.concat(
        F.array(_chunk("", 3, F.col("topic_order"), 0, F.concat(F.lit("## "), moc_link(F.col("name"), F.col("page")), F.lit("\n")))),
        F.when(F.col("size") > TOP_PER_TOPIC, F.array(_chunk(
            "", 3, F.col("topic_order"), TOP_PER_TOPIC + 1,
            F.concat(F.lit("- *...还有 "), (F.col("size") - TOP_PER_TOPIC).cast("string"), F.lit(" 篇文章*")))))
         .otherwise(F.array()),
        F.array(_chunk("", 3, F.col("topic_order"), TOP_PER_TOPIC + 2, F.lit(""))))).alias("c"))
    from pyspark.sql import Window
    w = Window.partitionBy("topic_id").orderBy(F.desc("relevance"), "ord")
    top = (members.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= TOP_PER_TOPIC)
           .join(topics.select("topic_id", "topic_order"), "topic_id", "inner")
           .select(_chunk("", 3, F.col("topic_order"), F.col("_rk"),
                          F.concat(F.lit("- "), wikilink("path", "title"))).alias("c")))
    out = head.unionByName(table).unionByName(gap).unionByName(sections).unionByName(top)
    return out.select("c.sec", "c.k1", "c.k2", "c.line")


def index_page(index: DataFrame) -> DataFrame:
    """The index rows as chunks of its page, ready for ``write_pages``."""
    return index.withColumn("page", F.lit(INDEX_PAGE))


#: Name of the run under which a map's pages are published: a new map replaces the old one.
MAP = "map"


def write_pages(chunks: DataFrame, path: str, run: str = MAP) -> None:
    """O-K3: chunks range-partitioned by (page, keys) so a big page spans several ordered part files, all pages published at once."""
    ordered = chunks.repartitionByRange("page", "sec", "k1", "k2").sortWithinPartitions("page", "sec", "k1", "k2")
    publish(ordered.select("page", F.col("line").alias("value")), path, run, ["page"], "text")


def published_pages(spark, path: str, run: str = MAP) -> DataFrame | None:
    """page, file, place, line of the pages in force: by (file, place) the lines of a page are in order. None before the first map."""
    t = published(spark, path, [run])
    if t is None:
        return None
    at = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                  F.monotonically_increasing_id().alias("row"))
    return t.select("page", at["file"].alias("file"), F.struct(at["block"], at["row"]).alias("place"), F.col("value").alias("line"))
