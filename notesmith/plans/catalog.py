"""Registered queries: one Spark job per operator group, each with a DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs over whole supplied tables (or
tables Spark derives from them); ``ORACLE[name]`` is independent DuckDB SQL over
the same parquet views. Computed columns carry the same aliases on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notesmith.functions import dates as DT
from notesmith.functions import html as H
from notesmith.functions import text as T
from notesmith.functions import urls as U
from notesmith.operators import dedup
from notesmith.operators import density as DN
from notesmith.operators import inference as INF
from notesmith.operators import levels as L
from notesmith.operators import maps as MP
from notesmith.operators import notes as NT
from notesmith.operators import publication as PB
from notesmith.operators import topics as TP
from notesmith.plans import duck as D
from notesmith.plans import ingest as IG
from notesmith.session import checkpoint_dir, cut_lineage, load_table
from notesmith.sources import articles as A
from notesmith.sources.derived import derived

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _pages(spark, sf):
    return load_table(spark, sf, "pages")


def _docs(spark, sf):
    return load_table(spark, sf, "documents")


# ---- URL normalisation and first-seen dedup (F1 F2 W1 J1 A1) ---------------

@register("url_normalize", f"""
SELECT page_id, url, {D.normalize_url('url')} AS norm_url, {D.url_hash('url')} AS url_hash FROM pages
""")
def q_url_normalize(spark, sf):
    return _pages(spark, sf).select("page_id", "url", U.normalize_url("url").alias("norm_url"),
                                    U.url_hash("url").alias("url_hash"))


@register("url_dedup_first", f"""
SELECT url_hash, min(page_id) AS page_id, arg_min(url, page_id) AS url, count(*) AS n_copies
FROM (SELECT page_id, url, {D.url_hash('url')} AS url_hash FROM pages) GROUP BY url_hash
""")
def q_url_dedup_first(spark, sf):
    p = _pages(spark, sf).select(F.col("page_id").alias("ord"), "url").withColumn("url_hash", U.url_hash("url"))
    return dedup.first_per_key(p, "url_hash", count_as="n_copies").select(
        "url_hash", F.col("ord").alias("page_id"), "url", F.col("n_copies").cast("bigint"))


@register("url_dedup_seen", D.with_ctes("seen_pages") + f"""
SELECT b.url_hash, b.page_id, b.url FROM (
  SELECT url_hash, min(page_id) AS page_id, arg_min(url, page_id) AS url
  FROM (SELECT page_id, url, {D.url_hash('url')} AS url_hash FROM pages) GROUP BY url_hash) b
WHERE b.url_hash NOT IN (SELECT {D.url_hash('url')} FROM seen_pages)
""")
def q_url_dedup_seen(spark, sf):
    p = _pages(spark, sf).select(F.col("page_id").alias("ord"), "url").withColumn("url_hash", U.url_hash("url"))
    seen = derived(spark, sf, "seen_pages").select(U.url_hash("url").alias("url_hash"))
    return dedup.filter_new(p, seen).select("url_hash", F.col("ord").alias("page_id"), "url")


def _scratch(spark, name: str) -> str:
    """A new folder for a store that a query builds, beside the lineage cuts."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("seen_store", D.with_ctes("seen_pages") + f"""
SELECT b.url_hash, b.page_id, b.url FROM (
  SELECT url_hash, min(page_id) AS page_id, arg_min(url, page_id) AS url
  FROM (SELECT page_id, url, {D.url_hash('url')} AS url_hash FROM pages) GROUP BY url_hash) b
WHERE b.url_hash NOT IN (SELECT {D.url_hash('url')} FROM seen_pages)
""")
def q_seen_store(spark, sf):
    """O-K2, then O-J1 against the stored keys: Bloom filters first, then only the parts that may hold a key."""
    path = _scratch(spark, "seen")
    seen = derived(spark, sf, "seen_pages").select(
        F.col("page_id").alias("ord"), "url", F.lit("").alias("title"), F.lit("").alias("content_hash"), F.lit("web_url").alias("source"),
        U.url_hash("url").alias("url_hash"))
    dedup.append_seen(dedup.first_per_key(seen, "url_hash"), path, AS_OF)
    p = _pages(spark, sf).select(F.col("page_id").alias("ord"), "url").withColumn("url_hash", U.url_hash("url"))
    return dedup.unseen(dedup.first_per_key(p, "url_hash"), path).select("url_hash", F.col("ord").alias("page_id"), "url")


def _seen_store(spark, sf) -> DataFrame:
    """A store from two sources: earlier pages (web_url) and feed links (rss), first wins."""
    pages = derived(spark, sf, "seen_pages").select(
        F.col("page_id").alias("ord"), "url", F.lit("web_url").alias("source"))
    feed = derived(spark, sf, "feed_entries").where(F.length("link") > 0).select(
        (F.col("ord") + F.lit(1 << 40)).alias("ord"), F.col("link").alias("url"), F.lit("rss").alias("source"))
    both = pages.unionByName(feed).withColumn("url_hash", U.url_hash("url"))
    return dedup.first_per_key(both, "url_hash")


@register("seen_stats", D.with_ctes("seen_pages", "feed_entries") + f"""
, s AS (
  SELECT page_id AS ord, url, 'web_url' AS source FROM seen_pages
  UNION ALL SELECT ord + 1099511627776, link, 'rss' FROM feed_entries WHERE length(link) > 0),
store AS (SELECT {D.url_hash('url')} AS url_hash, arg_min(source, ord) AS source FROM s GROUP BY 1)
SELECT source, CAST(count(*) AS BIGINT) AS n FROM store GROUP BY source
UNION ALL SELECT '*', CAST(count(*) AS BIGINT) FROM store
""")
def q_seen_stats(spark, sf):
    return dedup.seen_stats(_seen_store(spark, sf))


# ---- pages: title, text, Markdown, slug (S3 F4 F5 F6 F7 F11 F12 F8) ----------

@register("page_title", f"""
SELECT page_id, {D.html_title('html')} AS html_title, {D.title_chain("''", 'html', 'url')} AS title FROM pages
""")
def q_page_title(spark, sf):
    return _pages(spark, sf).select("page_id", H.html_title("html").alias("html_title"),
                                    H.title_chain(F.lit(""), "html", "url").alias("title"))


@register("page_text", f"""
SELECT page_id, {D.html_to_text('html')} AS text, CAST(length({D.html_to_text('html')}) AS BIGINT) AS n_chars FROM pages
""")
def q_page_text(spark, sf):
    t = H.html_to_text("html")
    return _pages(spark, sf).select("page_id", t.alias("text"), F.length(t).cast("bigint").alias("n_chars"))


@register("page_markdown", f"""
SELECT page_id, {D.html_to_markdown('html')} AS markdown FROM pages
""")
def q_page_markdown(spark, sf):
    return _pages(spark, sf).select("page_id", H.html_to_markdown("html").alias("markdown"))


@register("page_slug", f"""
SELECT page_id, {D.note_slug(D.title_chain("''", 'html', 'url'))} AS slug FROM pages
""")
def q_page_slug(spark, sf):
    return _pages(spark, sf).select("page_id", T.note_slug(H.title_chain(F.lit(""), "html", "url")).alias("slug"))


@register("html_entities", f"""
SELECT page_id, {D.decode_numeric_entities('html')} AS decoded FROM pages
""")
def q_html_entities(spark, sf):
    return _pages(spark, sf).select("page_id", H.decode_numeric_entities("html").alias("decoded"))


@register("topic_slug", f"""
SELECT page_id, {D.topic_slug(D.html_title('html'))} AS topic_slug FROM pages
""")
def q_topic_slug(spark, sf):
    return _pages(spark, sf).select("page_id", T.topic_slug(H.html_title("html")).alias("topic_slug"))


@register("title_chain", f"""
SELECT page_id, {D.title_chain("CASE WHEN page_id % 4 = 0 THEN 'Meta ' || CAST(page_id AS VARCHAR) ELSE '' END",
                                "CASE WHEN page_id % 3 = 0 THEN '' ELSE html END", 'url')} AS title FROM pages
""")
def q_title_chain(spark, sf):
    meta = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("Meta "), F.col("page_id").cast("string"))).otherwise("")
    html = F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(F.col("html"))
    return _pages(spark, sf).select("page_id", H.title_chain(meta, html, "url").alias("title"))


# ---- documents: hash, words, truncation, slug (P1 F17 F18 F11) ----------------

_DOC_URL = "'https://' || source || '.example.com/d/' || CAST(doc_id AS VARCHAR)"
_DOC_TITLE = "lang || ' ' || source"


def _doc_url():
    return F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/d/"), F.col("doc_id").cast("string"))


def _doc_title():
    return F.concat(F.col("lang"), F.lit(" "), F.col("source"))


@register("content_hash", f"""
SELECT doc_id, {D.content_hash(_DOC_URL, _DOC_TITLE, 'text')} AS content_hash FROM documents
""")
def q_content_hash(spark, sf):
    return _docs(spark, sf).select("doc_id", T.content_hash(_doc_url(), _doc_title(), "text").alias("content_hash"))


@register("word_count", f"""
SELECT doc_id, {D.word_count('text')} AS word_count FROM documents
""")
def q_word_count(spark, sf):
    return _docs(spark, sf).select("doc_id", T.word_count("text").alias("word_count"))


@register("truncate", f"""
SELECT doc_id, {D.truncate_with_marker('text', 4000)} AS l2_text,
       {D.truncate_with_marker('text', 2000, chr(10) + '[...truncated for analysis]')} AS l3_text FROM documents
""")
def q_truncate(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", T.truncate_with_marker("text", 4000).alias("l2_text"),
        T.truncate_with_marker("text", 2000, "\n[...truncated for analysis]").alias("l3_text"))


@register("note_slug", f"""
SELECT doc_id, {D.note_slug('text')} AS slug FROM documents
""")
def q_note_slug(spark, sf):
    return _docs(spark, sf).select("doc_id", T.note_slug("text").alias("slug"))


# ---- doc export (S4 F3 F13) -----------------------------------------------

@register("doc_id", D.with_ctes("docs_export") + f"""
SELECT ord, url, {D.doc_id_from_url('url')} AS doc_id FROM docs_export
""")
def q_doc_id(spark, sf):
    return derived(spark, sf, "docs_export").select("ord", "url", U.doc_id_from_url("url").alias("doc_id"))


@register("heading_title", D.with_ctes("docs_export") + f"""
SELECT ord, {D.heading_title('content')} AS heading FROM docs_export
""")
def q_heading_title(spark, sf):
    return derived(spark, sf, "docs_export").select("ord", T.heading_title("content").alias("heading"))


# ---- flagship ---------------------------------------------------------------

FLAGSHIP_SQL = D.with_ctes("seen_pages") + f"""
SELECT b.url_hash, b.page_id, b.url, {D.title_chain("''", 'p.html', 'p.url')} AS title FROM (
  SELECT url_hash, min(page_id) AS page_id, arg_min(url, page_id) AS url
  FROM (SELECT page_id, url, {D.url_hash('url')} AS url_hash FROM pages) GROUP BY url_hash) b
JOIN pages p ON p.page_id = b.page_id
WHERE b.url_hash NOT IN (SELECT {D.url_hash('url')} FROM seen_pages)
"""


@register("page_dedup_titles", FLAGSHIP_SQL)
def flagship(spark, sf):
    """New pages (first per normalised URL, not in the store) with their resolved title.

    The title is a narrow projection computed before the shuffle, so only (url_hash, ord, url, title)
    moves and the HTML is read once, instead of joining the pages back after dedup."""
    p = _pages(spark, sf).select(F.col("page_id").alias("ord"), "url",
                                 H.title_chain(F.lit(""), "html", "url").alias("title"))
    p = p.withColumn("url_hash", U.url_hash("url"))
    seen = derived(spark, sf, "seen_pages").select(U.url_hash("url").alias("url_hash"))
    return dedup.filter_new(p, seen).select("url_hash", F.col("ord").alias("page_id"), "url", "title")


# ---- sources (S1..S6 S8 U1 J2 J3 W2 W3 P2 P3 P7 P8 R1 R2 F9 F10 F19 F20 F21 O1 O5) ----

AS_OF = "2026-05-10"
WHITELIST = ("src1.example.com", "News@src2.example.com", "SRC5", "c7.example.com")
#: Only the queries about the caps themselves cut their tables (the newest messages, the first repos of a list).
MAX_EMAILS = 100
MAX_REPOS = 500
RUN_LIMIT = 50


def _flat(df: DataFrame) -> DataFrame:
    """Article rows in a hash-comparable shape (epoch seconds, comma-joined tags)."""
    return df.select("ord", "url", "title", "source", "content_raw", "author",
                     DT.epoch_seconds("published_at").alias("published_epoch"), "source_name",
                     F.array_join("tags", ",").alias("tags"), "content_hash")


def _duck_flat(builder_sql: str) -> str:
    return (f"SELECT ord, url, title, source, content_raw, author, published_epoch, source_name, "
            f"array_to_string(tags, ',') AS tags, content_hash FROM ({builder_sql})")


def build_sources(spark, sf, as_of: str = AS_OF) -> dict:
    return {
        "rss": lambda: A.feed_articles(derived(spark, sf, "feed_entries"), derived(spark, sf, "feeds")),
        "url": lambda: A.page_articles(_pages(spark, sf)),
        "feishu": lambda: A.doc_articles(derived(spark, sf, "docs_export")),
        "github": lambda: A.repo_articles(derived(spark, sf, "repos"), as_of),
        "email": lambda: A.message_articles(A.messages_from_flat(derived(spark, sf, "messages_flat")),
                                            WHITELIST),
    }


_ALL_SOURCES = ("rss", "url", "feishu", "github", "email")


def _duck_all_sources() -> str:
    return " UNION ALL ".join(f"({q})" for q in (
        D.feed_articles(), D.page_articles(), D.doc_articles(), D.repo_articles(AS_OF),
        D.message_articles(WHITELIST)))


_SRC_CTES = D.with_ctes("feeds", "feed_entries", "docs_export", "repos", "messages_flat")


@register("feed_enabled", D.with_ctes("feeds", "feed_entries") + """
SELECT f.name AS feed, CAST(count(*) AS BIGINT) AS n_entries
FROM feed_entries e JOIN feeds f ON f.name = e.feed WHERE coalesce(f.enabled, true) GROUP BY f.name
""")
def q_feed_enabled(spark, sf):
    reg = A.enabled_feeds(derived(spark, sf, "feeds")).select(F.col("name").alias("feed"))
    e = derived(spark, sf, "feed_entries").join(reg, "feed")
    return e.groupBy("feed").agg(F.count(F.lit(1)).cast("bigint").alias("n_entries"))


@register("feed_cap", D.with_ctes("feeds", "feed_entries") + f"""
SELECT feed, ord, link FROM ({D.feed_cap_sql()}) WHERE length(link) > 0
""")
def q_feed_cap(spark, sf):
    capped = A.cap_per_feed(derived(spark, sf, "feed_entries"), derived(spark, sf, "feeds"))
    return capped.where(F.length("link") > 0).select("feed", "ord", "link")


@register("feed_cascade", D.with_ctes("feed_entries") + f"""
SELECT ord, {D.feed_cascade('page_text', 'content', 'description', 'summary')} AS content_raw FROM feed_entries
""")
def q_feed_cascade(spark, sf):
    return derived(spark, sf, "feed_entries").select(
        "ord", T.feed_cascade("page_text", "content", "description", "summary").alias("content_raw"))


@register("feed_articles", D.with_ctes("feeds", "feed_entries") + _duck_flat(D.feed_articles()))
def q_feed_articles(spark, sf):
    return _flat(build_sources(spark, sf)["rss"]())


@register("newsletter_articles", D.with_ctes("messages_flat") + _duck_flat(D.message_articles(WHITELIST)))
def q_newsletter_articles(spark, sf):
    return _flat(build_sources(spark, sf)["email"]())


@register("newsletter_footer", D.with_ctes("messages_flat") + f"""
SELECT ord, {D.remove_footer('plain')} AS cleaned, {D.remove_footer('plain', greedy=True)} AS cleaned_greedy
FROM messages_flat
""")
def q_newsletter_footer(spark, sf):
    return derived(spark, sf, "messages_flat").select(
        "ord", T.remove_footer("plain").alias("cleaned"), T.remove_footer("plain", greedy=True).alias("cleaned_greedy"))


@register("sender_allowed", D.with_ctes("messages_flat") + f"""
SELECT ord, {D.sender_name('from_header')} AS sender_name, {D.sender_address('from_header')} AS sender_addr,
       {D.sender_allowed(D.sender_address('from_header'), WHITELIST)} AS allowed,
       {D.sender_allowed(D.sender_address('from_header'), WHITELIST, exact=True)} AS allowed_exact,
       {D.message_id_hash('message_id', 'subject', 'date_header', 'from_header')} AS msg_id
FROM messages_flat
""")
def q_sender_allowed(spark, sf):
    m = derived(spark, sf, "messages_flat")
    addr = T.sender_address("from_header")
    return m.select("ord", T.sender_name("from_header").alias("sender_name"), addr.alias("sender_addr"),
                    A.sender_allowed(addr, WHITELIST).alias("allowed"),
                    A.sender_allowed(addr, WHITELIST, exact=True).alias("allowed_exact"),
                    T.message_id_hash("message_id", "subject", "date_header", "from_header").alias("msg_id"))


@register("sender_list", D.with_ctes("messages_flat") + f"""
SELECT ord, {D.sender_address('from_header')} AS sender_addr,
       {D.sender_allowed(D.sender_address('from_header'), WHITELIST, exact=True)} AS allowed_exact
FROM messages_flat WHERE {D.sender_allowed(D.sender_address('from_header'), WHITELIST)}
""")
def q_sender_list(spark, sf):
    """O-J2 with the list as a table of any length."""
    m = derived(spark, sf, "messages_flat").select("ord", T.sender_address("from_header").alias("sender_addr"))
    entries = spark.createDataFrame([(e,) for e in WHITELIST], "entry string")
    exact = A.allowed_senders(m, "sender_addr", entries, exact=True).select("ord", F.lit(True).alias("_x"))
    return A.allowed_senders(m, "sender_addr", entries).join(exact, "ord", "left").select(
        "ord", "sender_addr", F.coalesce("_x", F.lit(False)).alias("allowed_exact"))


@register("newest_messages", D.with_ctes("messages_flat") + f"""
SELECT ord, subject FROM messages_flat ORDER BY ord DESC LIMIT {MAX_EMAILS}
""")
def q_newest_messages(spark, sf):
    return A.newest(derived(spark, sf, "messages_flat"), MAX_EMAILS).select("ord", "subject")


@register("newest_repos", D.with_ctes("repos") + _duck_flat(D.repo_articles(AS_OF, MAX_REPOS)))
def q_newest_repos(spark, sf):
    """O-O5: the listing cap, in list order and before any filter."""
    return _flat(A.repo_articles(derived(spark, sf, "repos"), AS_OF, MAX_REPOS))


@register("repo_articles", D.with_ctes("repos") + _duck_flat(D.repo_articles(AS_OF)))
def q_repo_articles(spark, sf):
    return _flat(build_sources(spark, sf)["github"]())


@register("repo_tags", D.with_ctes("repos") + f"""
SELECT ord, array_to_string({D.repo_tags("CASE WHEN length(topics_csv) > 0 THEN string_split(topics_csv, ',') "
                                         "ELSE CAST([] AS VARCHAR[]) END", 'language')}, ',') AS tags FROM repos
""")
def q_repo_tags(spark, sf):
    r = derived(spark, sf, "repos")
    topics = F.when(F.length("topics_csv") > 0, F.split("topics_csv", ",")).otherwise(F.array().cast("array<string>"))
    return r.select("ord", F.array_join(A.repo_tags(topics, "language"), ",").alias("tags"))


@register("doc_articles", D.with_ctes("docs_export") + _duck_flat(D.doc_articles()))
def q_doc_articles(spark, sf):
    return _flat(build_sources(spark, sf)["feishu"]())


@register("page_articles", _duck_flat(D.page_articles()))
def q_page_articles(spark, sf):
    return _flat(build_sources(spark, sf)["url"]())


@register("source_union", _SRC_CTES + f"""
SELECT source, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT content_hash) AS BIGINT) AS n_hash
FROM ({_duck_all_sources()}) GROUP BY source
""")
def q_source_union(spark, sf):
    u = A.route(build_sources(spark, sf), _ALL_SOURCES)
    return u.groupBy("source").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                   F.countDistinct("content_hash").cast("bigint").alias("n_hash"))


@register("run_limit", _SRC_CTES + f"""
SELECT ord, source, url FROM ({_duck_all_sources()}) ORDER BY ord LIMIT {RUN_LIMIT}
""")
def q_run_limit(spark, sf):
    """O-O1: the first N articles of the run (source rank, then natural order), before dedup."""
    u = A.route(build_sources(spark, sf), _ALL_SOURCES)
    return u.orderBy("ord").limit(RUN_LIMIT).select("ord", "source", "url")


# ---- dates (D1 D2 D3 D4) ----------------------------------------------------

@register("date_parse", D.with_ctes("date_strings") + f"""
SELECT event_id, {D.rfc_epoch('rfc_date')} AS rfc_epoch, {D.iso_epoch('iso_date')} AS iso_epoch FROM date_strings
""")
def q_date_parse(spark, sf):
    d = derived(spark, sf, "date_strings")
    return d.select("event_id", DT.epoch_seconds(DT.rfc2822_to_timestamp("rfc_date")).alias("rfc_epoch"),
                    DT.epoch_seconds(DT.iso_to_timestamp("iso_date")).alias("iso_epoch"))


@register("date_labels", D.with_ctes("date_strings") + f"""
SELECT event_id, {D.epoch_date_label(D.rfc_epoch('rfc_date'))} AS published_label,
       {D.epoch_date_label('CAST(epoch(ts) AS BIGINT)')} AS event_label, '{AS_OF}' AS processed_label
FROM date_strings
""")
def q_date_labels(spark, sf):
    d = derived(spark, sf, "date_strings")
    return d.select("event_id", DT.utc_date_label(DT.rfc2822_to_timestamp("rfc_date")).alias("published_label"),
                    DT.utc_date_label("ts").alias("event_label"), DT.as_of_label(AS_OF).alias("processed_label"))


# ---- model levels over stored replies (N1..N6 P4 P5 P6 J4 J7 C8) -------------


def _level_base(spark, sf) -> DataFrame:
    return _docs(spark, sf).select(
        "doc_id", _doc_url().alias("url"), _doc_title().alias("title"), F.col("text").alias("content_raw"),
        F.col("source").alias("source_name"), F.array().cast("array<string>").alias("tags"), F.lit("").alias("language"))


def _l1(spark, sf) -> DataFrame:
    return L.assign_tiers(L.apply_l1(_level_base(spark, sf), derived(spark, sf, "responses_l1"), key="doc_id"))


def _l2(spark, sf) -> DataFrame:
    return L.apply_l2(L.tier_filter(_l1(spark, sf)), derived(spark, sf, "responses_l2"), key="doc_id")


def _l3(spark, sf) -> DataFrame:
    return L.overlay_l3(_l2(spark, sf), derived(spark, sf, "responses_l3"), key="doc_id")


_D_L1 = D.l1_select("SELECT d.doc_id, r.raw, r.error FROM documents d LEFT JOIN responses_l1 r USING (doc_id)")
_D_TIERED = f"SELECT *, {D.assign_tier('relevance_score')} AS content_tier FROM ({_D_L1})"
_D_KEPT = f"SELECT doc_id, relevance_score, content_tier FROM ({_D_TIERED}) WHERE relevance_score > 0 AND content_tier <> 'discard'"
_D_L2 = D.l2_select(f"SELECT k.*, r.raw, r.error FROM ({_D_KEPT}) k LEFT JOIN responses_l2 r USING (doc_id)")
_D_GATE = f"SELECT doc_id FROM ({_D_L2}) WHERE relevance_score >= 7 AND content_tier = 'detailed'"
_D_L3 = D.l3_select(f"SELECT g.doc_id, r.raw, r.error FROM ({_D_GATE}) g LEFT JOIN responses_l3 r USING (doc_id)")


@register("relevance_parse", D.with_ctes("responses_l1") + f"""
SELECT doc_id, relevance_score, array_to_string(CASE WHEN parsed_ok THEN reply_tags ELSE CAST([] AS VARCHAR[]) END, ',') AS tags,
       CASE WHEN parsed_ok THEN reply_language ELSE '' END AS language, 'l1' AS processing_level FROM ({_D_L1})
""")
def q_relevance_parse(spark, sf):
    return L.apply_l1(_level_base(spark, sf), derived(spark, sf, "responses_l1"), key="doc_id").select(
        "doc_id", "relevance_score", F.array_join("tags", ",").alias("tags"), "language", "processing_level")


@register("tier_assign", D.with_ctes("responses_l1") + f"""
SELECT doc_id, relevance_score, content_tier FROM ({_D_TIERED})
""")
def q_tier_assign(spark, sf):
    return _l1(spark, sf).select("doc_id", "relevance_score", "content_tier")


@register("tier_filter", D.with_ctes("responses_l1") + _D_KEPT)
def q_tier_filter(spark, sf):
    return L.tier_filter(_l1(spark, sf)).select("doc_id", "relevance_score", "content_tier")


@register("summary_parse", D.with_ctes("responses_l1", "responses_l2") + f"""
SELECT doc_id, content_summary, array_to_string(key_points, '|') AS key_points,
       array_to_string(related_topics, '|') AS related_topics, 'l2' AS processing_level FROM ({_D_L2})
""")
def q_summary_parse(spark, sf):
    return _l2(spark, sf).select("doc_id", "content_summary", F.array_join("key_points", "|").alias("key_points"),
                                 F.array_join("related_topics", "|").alias("related_topics"), "processing_level")


@register("analysis_parse", D.with_ctes("responses_l1", "responses_l2", "responses_l3") + f"""
SELECT doc_id, ok, st AS structure_type, ki AS key_insight, content_deep,
       CAST(coalesce(len(concepts), 0) AS INTEGER) AS n_concepts FROM ({_D_L3})
""")
def q_analysis_parse(spark, sf):
    a = L.analyze_l3(L.deep_gate(_l2(spark, sf)), derived(spark, sf, "responses_l3"), key="doc_id")
    return a.select("doc_id", F.col("_a.ok").alias("ok"), F.col("_a.structure_type").alias("structure_type"),
                    F.col("_a.key_insight").alias("key_insight"), F.col("_a.content_deep").alias("content_deep"),
                    F.coalesce(F.size("_a.concepts"), F.lit(0)).cast("int").alias("n_concepts"))


@register("concepts", D.with_ctes("responses_l1", "responses_l2", "responses_l3") + f"""
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, c.name AS name, coalesce(c.definition, '') AS definition FROM (
  SELECT doc_id, unnest(concepts) AS c, generate_subscripts(concepts, 1) AS pos FROM ({_D_L3}) WHERE ok)
""")
def q_concepts(spark, sf):
    return L.concept_rows(_l3(spark, sf), key="doc_id")


@register("deep_gate", D.with_ctes("responses_l1", "responses_l2", "responses_l3") + f"""
SELECT l2.doc_id, CASE WHEN l3.ok THEN 'l3' ELSE 'l2' END AS processing_level,
       CASE WHEN l3.ok THEN l3.st ELSE '' END AS l3_structure_type,
       CASE WHEN l3.ok THEN l3.content_deep ELSE '' END AS content_deep
FROM ({_D_L2}) l2 LEFT JOIN ({_D_L3}) l3 ON l3.doc_id = l2.doc_id
""")
def q_deep_gate(spark, sf):
    return _l3(spark, sf).select("doc_id", "processing_level", "l3_structure_type", "content_deep")


# ---- note rendering, routing, collisions, funnel (G1 G2 P12 F15 W4 K1 A2 A7) ----


_LANG_SOURCE = "CASE lang WHEN 'en' THEN 'rss' WHEN 'fr' THEN 'email' WHEN 'de' THEN 'web_url' ELSE 'github' END"
_AUTHOR = "CASE WHEN lang = 'en' THEN '' ELSE 'Writer \"' || lang || '\"' END"


def _render_base(spark, sf) -> DataFrame:
    d = _docs(spark, sf)
    return d.select(
        "doc_id", _doc_url().alias("url"), _doc_title().alias("title"), F.col("text").alias("content_raw"),
        F.expr(_LANG_SOURCE).alias("source"), F.col("source").alias("source_name"), F.expr(_AUTHOR).alias("author"),
        F.lit(None).cast("timestamp").alias("published_at"),
        T.content_hash(_doc_url(), _doc_title(), "text").alias("content_hash"),
        F.array().cast("array<string>").alias("tags"), F.lit("").alias("language"))


def _final_articles(spark, sf) -> DataFrame:
    """Documents through L1, tier filter, L2 and the L3 overlay."""
    l1 = L.assign_tiers(L.apply_l1(_render_base(spark, sf), derived(spark, sf, "responses_l1"), key="doc_id"))
    l2 = L.apply_l2(L.tier_filter(l1), derived(spark, sf, "responses_l2"), key="doc_id")
    return L.overlay_l3(l2, derived(spark, sf, "responses_l3"), key="doc_id")


def _existing_notes(spark, sf) -> DataFrame:
    """Notes an earlier run wrote: every English document of the render base, unnumbered names."""
    b = _render_base(spark, sf).where("source = 'rss'")
    return b.select(NT.target_dir(AS_OF).alias("dir"),
                    T.note_filename(F.lit(5), "title").alias("filename")).distinct()


_D_RBASE = (f"SELECT doc_id, {_DOC_URL} AS url, {_DOC_TITLE} AS title, text AS content_raw, {_LANG_SOURCE} AS source, "
            f"source AS source_name, {_AUTHOR} AS author, CAST(NULL AS BIGINT) AS published_epoch, "
            f"{D.content_hash(_DOC_URL, _DOC_TITLE, 'text')} AS content_hash FROM documents")
_D_RL1 = D.l1_select(f"SELECT b.*, r.raw, r.error FROM ({_D_RBASE}) b LEFT JOIN responses_l1 r USING (doc_id)")
_D_RKEPT = (f"SELECT * EXCLUDE (raw, error, js, jv, parsed_ok, reply_tags, reply_language), "
            f"CASE WHEN parsed_ok THEN reply_tags ELSE CAST([] AS VARCHAR[]) END AS tags, "
            f"{D.assign_tier('relevance_score')} AS content_tier FROM ({_D_RL1}) WHERE relevance_score > 3")
_D_RL2 = D.l2_select(f"SELECT k.*, r.raw, r.error FROM ({_D_RKEPT}) k LEFT JOIN responses_l2 r USING (doc_id)")
_D_RL3 = D.l3_select(f"SELECT g.doc_id, r.raw, r.error FROM ({_D_RKEPT}) g LEFT JOIN responses_l3 r USING (doc_id) "
                     f"WHERE g.relevance_score >= 7")
_D_FINAL = (f"SELECT l2.* EXCLUDE (raw, error, js, jv), CASE WHEN l3.ok THEN 'l3' ELSE 'l2' END AS processing_level, "
            f"CASE WHEN l3.ok THEN l3.content_deep ELSE '' END AS content_deep "
            f"FROM ({_D_RL2}) l2 LEFT JOIN (SELECT * FROM ({_D_RL3}) WHERE ok) l3 ON l3.doc_id = l2.doc_id")
_D_EXISTING = (f"SELECT DISTINCT {D.target_dir(AS_OF)} AS dir, {D.note_filename('5', 'title')} AS filename "
               f"FROM ({_D_RBASE}) WHERE source = 'rss'")
_D_NAMED = (f"SELECT *, {D.target_dir(AS_OF)} AS dir, {D.note_filename('relevance_score', 'title')} AS filename "
            f"FROM ({_D_FINAL})")
_D_RENDERED = (f"SELECT *, dir || '/' || filename AS note_path, {D.note_content(AS_OF)} AS content "
               f"FROM ({D.resolve_collisions(_D_NAMED, _D_EXISTING, 'doc_id')})")
_RENDER_CTES = D.with_ctes("responses_l1", "responses_l2", "responses_l3")


def _rendered(spark, sf) -> DataFrame:
    return NT.render_notes(_final_articles(spark, sf), AS_OF, _existing_notes(spark, sf), key="doc_id")


@register("note_routing", _SRC_CTES + f"""
SELECT ord, {D.target_dir(AS_OF)} AS dir, {D.note_filename('0', 'title')} AS filename FROM ({_duck_all_sources()})
""")
def q_note_routing(spark, sf):
    u = A.route(build_sources(spark, sf), _ALL_SOURCES)
    return u.select("ord", NT.target_dir(AS_OF).alias("dir"), T.note_filename(F.lit(0), "title").alias("filename"))


@register("note_collisions", _RENDER_CTES + f"""
SELECT doc_id, dir, filename FROM ({D.resolve_collisions(_D_NAMED, _D_EXISTING, 'doc_id')})
""")
def q_note_collisions(spark, sf):
    named = _final_articles(spark, sf).withColumn("dir", NT.target_dir(AS_OF)).withColumn(
        "filename", T.note_filename("relevance_score", "title"))
    return NT.resolve_collisions(named, _existing_notes(spark, sf), key="doc_id").select("doc_id", "dir", "filename")


@register("name_registry", _RENDER_CTES + f"""
SELECT doc_id, dir, filename FROM ({D.resolve_collisions(_D_NAMED, _D_EXISTING, 'doc_id')})
""")
def q_name_registry(spark, sf):
    """O-W4 with the taken names in a registry: only the families of the new notes are looked up."""
    path = _scratch(spark, "names")
    NT.register_names(_existing_notes(spark, sf), path, "earlier")
    named = _final_articles(spark, sf).withColumn("dir", NT.target_dir(AS_OF)).withColumn(
        "filename", T.note_filename("relevance_score", "title"))
    return NT.resolve_collisions(named, NT.registered_names(spark, path), key="doc_id").select("doc_id", "dir", "filename")


@register("note_render", _RENDER_CTES + f"""
SELECT doc_id, note_path, content FROM ({_D_RENDERED})
""")
def q_note_render(spark, sf):
    return _rendered(spark, sf).select("doc_id", "note_path", "content")


@register("published_notes", _RENDER_CTES + f"""
SELECT CASE WHEN relevance_score >= 7 THEN 'second' ELSE 'first' END AS run, note_path, CAST(length(content) AS BIGINT) AS n_chars
FROM ({_D_RENDERED})
""")
def q_published_notes(spark, sf):
    """O-K1 as readers see it: two runs, one of them published again with fewer notes, and one that died before its manifest."""
    path = _scratch(spark, "notes")
    rendered = cut_lineage(_rendered(spark, sf))
    high = F.col("relevance_score") >= 7
    NT.write_notes(rendered.where(~high), path, "first")
    NT.write_notes(rendered, path, "second")
    NT.write_notes(rendered.where(high), path, "second")
    PB.write_attempt(rendered.select("note_path", "content"), path, "third")
    return NT.published_notes(spark, path).select("run", "note_path", F.length("content").cast("bigint").alias("n_chars"))


@register("note_filename", _RENDER_CTES + f"""
SELECT doc_id, {D.note_filename('relevance_score', 'title')} AS filename,
       {D.note_filename('0', 'title')} AS unscored_filename FROM ({_D_FINAL})
""")
def q_note_filename(spark, sf):
    return _final_articles(spark, sf).select("doc_id", T.note_filename("relevance_score", "title").alias("filename"),
                                             T.note_filename(F.lit(0), "title").alias("unscored_filename"))


@register("note_summary", _RENDER_CTES + f"""
SELECT doc_id, {D.note_summary('content')} AS summary FROM ({_D_RENDERED})
""")
def q_note_summary(spark, sf):
    return _rendered(spark, sf).select("doc_id", T.note_summary("content").alias("summary"))


@register("wikilink", _RENDER_CTES + f"""
SELECT doc_id, {D.wikilink('note_path', 'title')} AS link, {D.wikilink("''", 'title')} AS bare_link FROM ({_D_RENDERED})
""")
def q_wikilink(spark, sf):
    return _rendered(spark, sf).select("doc_id", T.wikilink("note_path", "title").alias("link"),
                                       T.wikilink(F.lit(""), "title").alias("bare_link"))


def _ingest_stages(spark, sf, dry_run: bool = False, limit: int | None = None):
    base = _render_base(spark, sf)
    seen = base.where("source = 'rss'").select(U.url_hash("url").alias("url_hash"))  # an earlier run took 'en'
    replies = {lv: derived(spark, sf, f"responses_{lv}") for lv in ("l1", "l2", "l3")}
    return IG.plan_ingest(base, replies, AS_OF, seen=seen, key="doc_id", dry_run=dry_run, limit=limit,
                          existing_notes=_existing_notes(spark, sf))


_D_NEW = (f"SELECT * FROM ({_D_RBASE}) WHERE {D.url_hash('url')} NOT IN "
          f"(SELECT {D.url_hash('url')} FROM ({_D_RBASE}) WHERE source = 'rss')")
_D_NEW_L1 = D.l1_select(f"SELECT b.*, r.raw, r.error FROM ({_D_NEW}) b LEFT JOIN responses_l1 r USING (doc_id)")


def _d_errors(columns: str) -> str:
    """Replies with an error, of the articles that each level is asked for."""
    return " UNION ALL ".join(f"SELECT {columns.format(level=lv)} FROM ({_D_NEW_L1}) s JOIN responses_{lv} r ON r.doc_id = s.doc_id "
                              f"WHERE r.error IS NOT NULL AND s.relevance_score >= {least}" for lv, least in (("l1", -1), ("l2", 4), ("l3", 7)))


@register("ingest_funnel", _RENDER_CTES + f"""
SELECT 'fetched' AS stage, CAST(count(*) AS BIGINT) AS n FROM documents
UNION ALL SELECT 'new', CAST(count(*) AS BIGINT) FROM ({_D_NEW})
UNION ALL SELECT 'l1_passed', CAST(count(*) AS BIGINT) FROM ({_D_NEW_L1}) WHERE relevance_score > 3
UNION ALL SELECT 'l2_summarized', CAST(count(*) AS BIGINT) FROM ({_D_NEW_L1}) WHERE relevance_score > 3
UNION ALL SELECT 'written', CAST(count(*) AS BIGINT) FROM ({_D_NEW_L1}) WHERE relevance_score > 3
UNION ALL SELECT 'errors', CAST(count(*) AS BIGINT) FROM ({_d_errors("1")})
""")
def q_ingest_funnel(spark, sf):
    """Q1 stage counts: fetched -> new (URL dedup + seen-store) -> L1 passed -> L2 -> written, and the failed replies."""
    return IG.funnel_counts(_ingest_stages(spark, sf))


@register("ingest_errors", _RENDER_CTES + _d_errors("'{level}' AS stage, s.doc_id, r.error"))
def q_ingest_errors(spark, sf):
    """Every failed reply of a run with its level."""
    return _ingest_stages(spark, sf).errors.select("stage", "doc_id", "error")


# ---- topics and topic maps (C4..C8 A3..A6 W5 W6 O2..O4 P10 P11 J5 J8 J9 R3 R4 G3 G4 K3) ----


def _tag_notes(spark, sf) -> DataFrame:
    return TP.notes_from_csv(derived(spark, sf, "doc_tags"))


def _labelled(spark, sf):
    """Notes with a vector get the supplied cluster label (vec_id = note order)."""
    lab = load_table(spark, sf, "embeddings").select(F.col("vec_id").alias("ord"), "label")
    return _tag_notes(spark, sf), lab


def _tag_topic_result(spark, sf):
    return TP.greedy_tag_topics(_tag_notes(spark, sf), min_size=3)


_D_NOTES = "SELECT ord, path, title, relevance, source_name, string_split(tags_csv, ',') AS tags FROM doc_tags"
_D_TOPIC_CTES = D.with_ctes("doc_tags", extra=[("notes", _D_NOTES)])
_D_EDGES = "SELECT ord, unnest(tags) AS tag, generate_subscripts(tags, 1) AS pos FROM notes"


def _d_greedy() -> str:
    """Sequential greedy rule as a recursive CTE (the oracle runs it literally, tag by tag)."""
    free = ("(SELECT {agg} FROM edges e JOIN ranked r ON e.tag = r.tag "
            "WHERE r.rk = g.k + 1 AND NOT list_contains(g.used, e.ord))")
    cnt, ids = free.format(agg="count(*)"), free.format(agg="list(e.ord)")
    return f"""
, edges AS ({_D_EDGES}),
ts AS (SELECT tag, count(*) AS cnt, min(ord * 1000000 + pos) AS first FROM edges GROUP BY tag),
ranked AS (SELECT tag, row_number() OVER (ORDER BY cnt DESC, first) AS rk FROM ts WHERE cnt >= 3),
greedy(k, used, acc) AS (
  SELECT 0, CAST([] AS BIGINT[]), CAST([] AS VARCHAR[])
  UNION ALL
  SELECT g.k + 1,
    CASE WHEN {cnt} >= 3 THEN list_concat(g.used, {ids}) ELSE g.used END,
    CASE WHEN {cnt} >= 3 THEN list_append(g.acc, (SELECT tag FROM ranked WHERE rk = g.k + 1)) ELSE g.acc END
  FROM greedy g WHERE g.k < (SELECT count(*) FROM ranked)),
accepted AS (SELECT acc FROM greedy ORDER BY k DESC LIMIT 1),
assign AS (SELECT e.ord, min(list_position(a.acc, e.tag)) AS topic_order
           FROM edges e, accepted a WHERE list_contains(a.acc, e.tag) GROUP BY e.ord),
tmembers AS (SELECT n.*, s.topic_order FROM notes n JOIN assign s USING (ord)),
ttopics AS (SELECT topic_order, (SELECT acc FROM accepted)[topic_order] AS name, count(*) AS size
            FROM tmembers GROUP BY topic_order)
"""


@register("tag_topics", D.with_ctes("doc_tags", extra=[("notes", _D_NOTES)]).replace("WITH ", "WITH RECURSIVE ", 1)
          + _d_greedy() + """
SELECT name, CAST(size AS BIGINT) AS size, CAST(topic_order AS INTEGER) AS topic_order FROM ttopics
""")
def q_tag_topics(spark, sf):
    topics, _ = _tag_topic_result(spark, sf)
    return topics.select("name", "size", "topic_order")


_D_LABELLED = ("SELECT n.*, e.label AS topic_id FROM notes n JOIN embeddings e ON e.vec_id = n.ord "
               "WHERE e.label <> -1")
_D_TAGCOUNTS = (f"SELECT topic_id, tag, count(*) AS cnt, min(ord * 1000000 + pos) AS first FROM "
                f"(SELECT topic_id, ord, unnest(tags) AS tag, generate_subscripts(tags, 1) AS pos FROM ({_D_LABELLED})) "
                f"GROUP BY topic_id, tag")
_D_CORE = (f"SELECT topic_id, list(tag ORDER BY rk) AS core_tags FROM (SELECT *, row_number() OVER "
           f"(PARTITION BY topic_id ORDER BY cnt DESC, first) AS rk FROM ({_D_TAGCOUNTS})) WHERE rk <= 5 GROUP BY topic_id")
_D_ETOPICS = (f"SELECT s.topic_id, s.size, s.first_ord, coalesce(c.core_tags, CAST([] AS VARCHAR[])) AS core_tags, "
              f"CASE WHEN len(coalesce(c.core_tags, CAST([] AS VARCHAR[]))) = 0 THEN 'Topic (' || CAST(s.size AS VARCHAR) || ' articles)' "
              f"ELSE array_to_string(list_slice(c.core_tags, 1, 3), ' / ') END AS name, "
              f"row_number() OVER (ORDER BY s.size DESC, s.first_ord) AS topic_order "
              f"FROM (SELECT topic_id, count(*) AS size, min(ord) AS first_ord FROM ({_D_LABELLED}) GROUP BY topic_id) s "
              f"LEFT JOIN ({_D_CORE}) c USING (topic_id)")


@register("tag_counts", _D_TOPIC_CTES + f"""
SELECT topic_id AS label, tag, CAST(cnt AS BIGINT) AS cnt, CAST(first // 1000000 AS BIGINT) AS first_ord,
       CAST(first % 1000000 - 1 AS INTEGER) AS first_pos FROM ({_D_TAGCOUNTS})
""")
def q_tag_counts(spark, sf):
    notes, lab = _labelled(spark, sf)
    m = notes.join(lab, "ord").withColumnRenamed("label", "topic_id")
    c = TP.tag_counts(m, "topic_id")
    return c.select(F.col("topic_id").alias("label"), "tag", "cnt", F.col("first.ord").alias("first_ord"),
                    F.col("first.pos").alias("first_pos"))


@register("topic_names", _D_TOPIC_CTES + f"""
SELECT topic_id AS label, name, array_to_string(core_tags, ',') AS core_tags, CAST(size AS BIGINT) AS size FROM ({_D_ETOPICS})
""")
def q_topic_names(spark, sf):
    notes, lab = _labelled(spark, sf)
    topics, _ = TP.assemble_topics(notes, lab)
    return topics.select(F.col("topic_id").alias("label"), "name", F.array_join("core_tags", ",").alias("core_tags"),
                         "size")


@register("topics_by_size", _D_TOPIC_CTES + f"""
SELECT name, CAST(size AS BIGINT) AS size, CAST(topic_order AS INTEGER) AS topic_order FROM ({_D_ETOPICS})
""")
def q_topics_by_size(spark, sf):
    notes, lab = _labelled(spark, sf)
    topics, _ = TP.assemble_topics(notes, lab)
    return topics.select("name", "size", "topic_order")


@register("trivial_cluster", """
SELECT vec_id, CASE WHEN (SELECT count(*) FROM embeddings) >= 3 THEN 0 ELSE -1 END AS label FROM embeddings
""")
def q_trivial_cluster(spark, sf):
    return TP.trivial_labels(load_table(spark, sf, "embeddings").select("vec_id")).select("vec_id", "label")


def _d_member_line() -> str:
    src = "coalesce(source_name, '')"
    tags = "coalesce(tags, CAST([] AS VARCHAR[]))"
    return (f"'- ' || {D.wikilink('path', 'title')} || CASE WHEN length({src}) > 0 THEN ' — *' || {src} || '*' ELSE '' END "
            f"|| CASE WHEN len({tags}) > 0 THEN ' ' || array_to_string(list_transform(list_slice({tags}, 1, 3), "
            f"lambda t: '#' || t), ' ') ELSE '' END")


@register("member_lists", D.with_ctes("doc_tags", extra=[("notes", _D_NOTES)]).replace("WITH ", "WITH RECURSIVE ", 1)
          + _d_greedy() + f"""
SELECT t.name AS topic, CAST(-m.relevance AS BIGINT) AS k1, CAST(m.ord AS BIGINT) AS k2, {_d_member_line()} AS line
FROM tmembers m JOIN ttopics t USING (topic_order)
""")
def q_member_lists(spark, sf):
    topics, members = _tag_topic_result(spark, sf)
    return members.join(topics.select("topic_id", F.col("name").alias("topic")), "topic_id").select(
        "topic", (-F.col("relevance")).cast("long").alias("k1"), F.col("ord").cast("long").alias("k2"),
        MP.member_line(members).alias("line"))


def _d_pages(as_of: str) -> str:
    page = f"'MOC-' || {D.topic_slug('name')} || '.md'"
    core = "[name]"
    fm = (f"concat_ws(chr(10), 'article_count: ' || CAST(size AS VARCHAR), 'auto_generated: true', "
          f"'generated: ' || {D.yaml_quoted(D.lit(as_of))}, 'tags:' || chr(10) || '- ' || {D.yaml_quoted('name')}, "
          f"'title: ' || {D.yaml_quoted(chr(39) + 'MOC: ' + chr(39) + ' || name')}, 'type: \"moc\"')")
    nl = "chr(10)"
    fixed = (f"SELECT {page} AS page, c.sec, c.k1, 0 AS k2, c.line FROM ttopics, LATERAL (SELECT unnest(["
             f"{{'sec': 0, 'k1': 0, 'line': '---' || {nl} || {fm} || {nl} || '---' || {nl}}}, "
             f"{{'sec': 0, 'k1': 1, 'line': '# MOC: ' || name || {nl}}}, "
             f"{{'sec': 0, 'k1': 2, 'line': '> ' || CAST(size AS VARCHAR) || ' 篇文章 | 生成于 {as_of}' || {nl}}}, "
             f"{{'sec': 0, 'k1': 3, 'line': '## 主题标签' || {nl}}}, "
             f"{{'sec': 0, 'k1': 4, 'line': array_to_string(list_transform({core}, lambda t: '#' || t), ' ')}}, "
             f"{{'sec': 0, 'k1': 5, 'line': ''}}, "
             f"{{'sec': 0, 'k1': 6, 'line': '## 文章列表' || {nl}}}, "
             f"{{'sec': 2, 'k1': 0, 'line': ''}}]) AS c)")
    rows = (f"SELECT 'MOC-' || {D.topic_slug('t.name')} || '.md' AS page, 1 AS sec, -m.relevance AS k1, m.ord AS k2, "
            f"{_d_member_line()} AS line FROM tmembers m JOIN ttopics t USING (topic_order)")
    return (f"SELECT page, CAST(sec AS INTEGER) AS sec, CAST(k1 AS BIGINT) AS k1, CAST(k2 AS BIGINT) AS k2, line "
            f"FROM ({fixed} UNION ALL {rows})")


@register("topic_page", D.with_ctes("doc_tags", extra=[("notes", _D_NOTES)]).replace("WITH ", "WITH RECURSIVE ", 1)
          + _d_greedy() + _d_pages(AS_OF))
def q_topic_page(spark, sf):
    topics, members = _tag_topic_result(spark, sf)
    return MP.topic_pages(topics, members, AS_OF).select(
        "page", F.col("sec").cast("int").alias("sec"), "k1", "k2", "line")


def _d_index(as_of: str) -> str:
    nl = "chr(10)"
    link = f"'[[MOC-' || {D.topic_slug('name')} || '|' || name || ']]'"
    fm = (f"concat_ws(chr(10), 'auto_generated: true', 'generated: ' || {D.yaml_quoted(D.lit(as_of))}, "
          f"'title: \"知识地图总览\"', 'topic_count: ' || CAST(n AS VARCHAR), 'total_articles: ' || CAST(total AS VARCHAR), "
          f"'type: \"moc-index\"')")
    totals = "SELECT count(*) AS n, coalesce(sum(size), 0) AS total FROM ttopics"
    head = (f"SELECT 0 AS sec, c.k1, 0 AS k2, c.line FROM ({totals}), LATERAL (SELECT unnest(["
            f"{{'k1': 0, 'line': '---' || {nl} || {fm} || {nl} || '---' || {nl}}}, "
            f"{{'k1': 1, 'line': '# 知识地图总览' || {nl}}}, "
            f"{{'k1': 2, 'line': '> ' || CAST(n AS VARCHAR) || ' 个主题 | ' || CAST(total AS VARCHAR) || ' 篇文章 | 更新于 {as_of}' || {nl}}}, "
            f"{{'k1': 3, 'line': '## 主题概览' || {nl}}}, {{'k1': 4, 'line': '| 主题 | 文章数 | 核心标签 |'}}, "
            f"{{'k1': 5, 'line': '|------|--------|----------|'}}]) AS c)")
    table = (f"SELECT 1, topic_order, 0, '| ' || {link} || ' | ' || CAST(size AS VARCHAR) || ' | ' || "
             f"array_to_string(list_transform(list_slice([name], 1, 3), lambda t: '#' || t), ', ') || ' |' FROM ttopics")
    gap = "SELECT 2, 0, 0, ''"
    sec_head = f"SELECT 3, topic_order, 0, '## ' || {link} || {nl} FROM ttopics"
    more = (f"SELECT 3, topic_order, 6, '- *...还有 ' || CAST(size - 5 AS VARCHAR) || ' 篇文章*' FROM ttopics "
            f"WHERE size > 5")
    blank = "SELECT 3, topic_order, 7, '' FROM ttopics"
    top = (f"SELECT 3, topic_order, rk, '- ' || {D.wikilink('path', 'title')} FROM (SELECT *, row_number() OVER "
           f"(PARTITION BY topic_order ORDER BY relevance DESC, ord) AS rk FROM tmembers) WHERE rk <= 5")
    return (f"SELECT CAST(sec AS INTEGER) AS sec, CAST(k1 AS BIGINT) AS k1, CAST(k2 AS BIGINT) AS k2, line FROM ("
            f"{head} UNION ALL {table} UNION ALL {gap} UNION ALL {sec_head} UNION ALL {more} UNION ALL {blank} "
            f"UNION ALL {top})")


@register("topic_index", D.with_ctes("doc_tags", extra=[("notes", _D_NOTES)]).replace("WITH ", "WITH RECURSIVE ", 1)
          + _d_greedy() + _d_index(AS_OF))
def q_topic_index(spark, sf):
    topics, members = _tag_topic_result(spark, sf)
    return MP.topic_index(topics, members, AS_OF).select(F.col("sec").cast("int").alias("sec"), "k1", "k2", "line")


@register("embedding_text", D.with_ctes("doc_tags", extra=[("notes", _D_NOTES)]) + """
SELECT n.ord, CASE WHEN length(concat_ws(' | ', CASE WHEN len(n.tags) > 0 THEN 'Tags: ' || array_to_string(n.tags, ', ') END,
         CASE WHEN length(d.text) > 0 THEN substr(d.text, 1, 300) END)) > 0
       THEN concat_ws(' | ', CASE WHEN len(n.tags) > 0 THEN 'Tags: ' || array_to_string(n.tags, ', ') END,
         CASE WHEN length(d.text) > 0 THEN substr(d.text, 1, 300) END) ELSE n.title END AS text
FROM notes n JOIN documents d ON d.doc_id = n.ord
""")
def q_embedding_text(spark, sf):
    notes = _tag_notes(spark, sf).join(_docs(spark, sf).select(F.col("doc_id").alias("ord"), "text"), "ord")
    return notes.select("ord", TP.embedding_text("tags", "text", "title").alias("text"))


# ---- density clustering (J6 X1 C1 C2 C3 M4) -----------------------------------


MIN_SAMPLES = 2
MIN_CLUSTER = 3
CUT_QUANTILE = 0.5

_D_VEC = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings"
_D_PAIRS = (f"SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.e, b.e) AS dist "
            f"FROM ({_D_VEC}) a JOIN ({_D_VEC}) b ON a.vec_id <> b.vec_id")
_D_CORE = (f"SELECT a AS vec_id, dist AS core FROM (SELECT a, dist, row_number() OVER (PARTITION BY a ORDER BY dist) AS rn "
           f"FROM ({_D_PAIRS})) WHERE rn = {MIN_SAMPLES}")
_D_CUT = f"SELECT quantile_disc(core, {CUT_QUANTILE}) AS cut FROM ({_D_CORE})"
_D_REACH = (f"SELECT p.a, p.b, greatest(p.dist, ca.core, cb.core) AS weight FROM ({_D_PAIRS}) p "
            f"JOIN ({_D_CORE}) ca ON ca.vec_id = p.a JOIN ({_D_CORE}) cb ON cb.vec_id = p.b "
            f"WHERE p.a < p.b AND greatest(p.dist, ca.core, cb.core) <= (SELECT cut FROM ({_D_CUT}))")


def _vectors(spark, sf) -> DataFrame:
    return load_table(spark, sf, "embeddings").select("vec_id", "embedding")


@register("core_distance", f"""
SELECT vec_id, round(core, 6) AS core_distance FROM ({_D_CORE})
""")
def q_core_distance(spark, sf):
    c = DN.core_distances(_vectors(spark, sf), MIN_SAMPLES)
    return c.select("vec_id", F.round("core", 6).alias("core_distance"))


@register("reach_edges", f"""
SELECT a, b, round(weight, 6) AS weight FROM ({_D_REACH})
""")
def q_reach_edges(spark, sf):
    pts = _vectors(spark, sf)
    core = cut_lineage(DN.core_distances(pts, MIN_SAMPLES))  # read three times
    cut = DN.exact_quantile(core, "core", CUT_QUANTILE)
    return DN.reach_edges(pts, core, cut).select("a", "b", F.round("weight", 6).alias("weight"))


@register("density_components", f"""
WITH RECURSIVE edges AS ({_D_REACH}),
und AS (SELECT a AS s, b AS d FROM edges UNION SELECT b, a FROM edges),
reach(s, d) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.s, u.d FROM reach r JOIN und u ON u.s = r.d),
comp AS (SELECT s AS vec_id, min(d) AS comp FROM reach GROUP BY s),
sizes AS (SELECT comp, count(*) AS size FROM comp GROUP BY comp)
SELECT c.vec_id, CASE WHEN s.size >= {MIN_CLUSTER} THEN c.comp ELSE -1 END AS label
FROM comp c JOIN sizes s USING (comp)
""")
def q_density_components(spark, sf):
    lab, _ = DN.fixed_cut_labels(_vectors(spark, sf), MIN_SAMPLES, MIN_CLUSTER, CUT_QUANTILE)
    return lab.select("vec_id", "label")


#: Single linkage by growing one tree from the smallest id: in the order in which points join, every component under a distance is
#: a stretch of points that joined at that distance or less. Clusters are chosen bottom-up, one height in each step.
_D_HIERARCHY = f"""
WITH RECURSIVE pairs AS MATERIALIZED ({_D_PAIRS}),
core AS MATERIALIZED (SELECT a AS vec_id, dist AS core FROM (
  SELECT a, dist, row_number() OVER (PARTITION BY a ORDER BY dist) AS rn FROM pairs) WHERE rn = {MIN_SAMPLES}),
w AS MATERIALIZED (SELECT p.a, p.b, round(greatest(p.dist, ca.core, cb.core), 9) AS w
                   FROM pairs p JOIN core ca ON ca.vec_id = p.a JOIN core cb ON cb.vec_id = p.b),
grow(step, v, best) AS (
  SELECT 1, b, w FROM w WHERE a = (SELECT min(vec_id) FROM embeddings)
  UNION ALL
  SELECT g.step + 1, g.v, least(g.best, w.w)
  FROM (SELECT step, v, best, first_value(v) OVER (ORDER BY best, v) AS pick FROM grow) g JOIN w ON w.a = g.pick AND w.b = g.v
  WHERE g.v <> g.pick),
seq AS MATERIALIZED (
  SELECT 0 AS i, min(vec_id) AS vec_id, 'Infinity'::DOUBLE AS c FROM embeddings
  UNION ALL
  SELECT step, v, best FROM (SELECT *, row_number() OVER (PARTITION BY step ORDER BY best, v) AS rn FROM grow) WHERE rn = 1),
lefts AS (SELECT s.i, s.c, max(l.i) AS l FROM seq s JOIN seq l ON l.i < s.i AND l.c > s.c GROUP BY s.i, s.c),
rights AS (SELECT s.i, min(r.i) - 1 AS r FROM seq s JOIN seq r ON r.i > s.i AND r.c > s.c GROUP BY s.i),
nodes AS MATERIALIZED (
  SELECT DISTINCT l, coalesce(r, (SELECT max(i) FROM seq)) AS r, c AS w FROM lefts LEFT JOIN rights USING (i)),
big AS MATERIALIZED (SELECT row_number() OVER (ORDER BY l, r) AS n, l, r, w, r - l + 1 AS size FROM nodes WHERE r - l + 1 >= {MIN_CLUSTER}),
inside AS MATERIALIZED (SELECT s.n, t.n AS outer_n, t.size FROM big s JOIN big t ON t.l <= s.l AND t.r >= s.r AND t.n <> s.n),
par AS (SELECT n, arg_min(outer_n, size) AS up FROM inside GROUP BY n),
kids AS (SELECT up, count(*) AS kids FROM par GROUP BY up),
starts AS MATERIALIZED (
  SELECT b.n, b.l, b.r, b.size, CASE WHEN u.w IS NULL THEN 0.0 ELSE 1 / greatest(u.w, 1e-12) END AS birth
  FROM big b LEFT JOIN par p ON p.n = b.n LEFT JOIN kids k ON k.up = p.up LEFT JOIN big u ON u.n = p.up
  WHERE p.up IS NULL OR k.kids >= 2),
homes AS (SELECT s.i, arg_min(1 / greatest(b.w, 1e-12), b.size) AS leaves FROM seq s JOIN big b ON s.i BETWEEN b.l AND b.r GROUP BY s.i),
own AS (SELECT s.i, arg_min(c.n, c.size) AS n FROM seq s JOIN starts c ON s.i BETWEEN c.l AND c.r GROUP BY s.i),
outer_start AS (SELECT s.n, arg_min(t.n, t.size) AS up FROM starts s JOIN starts t ON t.l <= s.l AND t.r >= s.r AND t.n <> s.n GROUP BY s.n),
stab AS (
  SELECT n, sum(x) AS s FROM (
    SELECT own.n, homes.leaves AS x FROM own JOIN homes USING (i)
    UNION ALL SELECT o.up, c.size * c.birth FROM starts c JOIN outer_start o ON o.n = c.n
    UNION ALL SELECT n, -size * birth FROM starts) GROUP BY n),
climb(step, n, up, s, best) AS (
  SELECT 0, c.n, o.up, t.s, NULL::DOUBLE FROM starts c JOIN stab t ON t.n = c.n LEFT JOIN outer_start o ON o.n = c.n
  UNION ALL
  SELECT step + 1, n, up, s, CASE WHEN best IS NULL AND open = 0 THEN greatest(s, total) ELSE best END
  FROM (SELECT *, sum(CASE WHEN kind = 1 THEN best END) OVER (PARTITION BY node) AS total,
               sum(CASE WHEN kind = 1 AND best IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY node) AS open,
               sum(CASE WHEN best IS NULL THEN 1 ELSE 0 END) OVER () AS undone
        FROM (SELECT c.*, k.kind, CASE WHEN k.kind = 0 THEN c.n ELSE c.up END AS node FROM climb c, (VALUES (0), (1)) k(kind)))
  WHERE kind = 0 AND undone > 0),
best AS (SELECT n, any_value(up) AS up, any_value(s) AS s, max(best) AS best FROM climb GROUP BY n),
total AS (SELECT up AS n, sum(best) AS total FROM best GROUP BY up),
picked AS (SELECT c.n, c.l, c.r FROM best b JOIN starts c ON c.n = b.n LEFT JOIN total t ON t.n = b.n
           WHERE b.up IS NOT NULL AND (t.total IS NULL OR b.s >= t.total)),
final AS (SELECT * FROM picked p WHERE NOT EXISTS (SELECT 1 FROM picked q WHERE q.l <= p.l AND q.r >= p.r AND q.n <> p.n)),
labels AS (SELECT f.n, f.l, f.r, min(s.vec_id) AS label FROM final f JOIN seq s ON s.i BETWEEN f.l AND f.r GROUP BY f.n, f.l, f.r)
SELECT s.vec_id, coalesce(f.label, -1) AS label FROM seq s LEFT JOIN labels f ON s.i BETWEEN f.l AND f.r
"""


@register("density_hierarchy", _D_HIERARCHY)
def q_density_hierarchy(spark, sf):
    """O-C3 over the whole embeddings table."""
    return DN.hierarchy_labels(_vectors(spark, sf), MIN_SAMPLES, MIN_CLUSTER)


# ---- prompts, row filters, batch inference (M1 M2 P7 P8 P9) -------------------


MAX_TOKENS = 1000


def _d_tag_text(tags: str) -> str:
    return f"CASE WHEN len(coalesce({tags}, CAST([] AS VARCHAR[]))) > 0 THEN array_to_string({tags}, ', ') ELSE 'none' END"


def _d_filled(template: str, **fields: str) -> str:
    """SQL of a prompt template: literal pieces and field expressions in turn."""
    out, rest = [], template
    while rest:
        head, brace, rest = rest.partition("{")
        if head:
            out.append("'" + head.replace("'", "''") + "'")
        if brace:
            name, _, rest = rest.partition("}")
            out.append(f"({fields[name]})")
    return " || ".join(out)


def _d_prompts() -> str:
    c = "coalesce(content_raw, '')"
    l1 = _d_filled(INF.PROMPTS["l1"], title="title", source="coalesce(source_name, '')",
                   content=f"CASE WHEN length({c}) > 0 THEN substr({c}, 1, 2000) ELSE title END")
    tags = _d_tag_text("tags")
    long = _d_filled(INF.PROMPTS["l2_detailed"], title="title", tags=tags, content=D.truncate_with_marker(c, 2 * MAX_TOKENS))
    short = _d_filled(INF.PROMPTS["l2"], title="title", tags=tags, content=D.truncate_with_marker(c, 3 * MAX_TOKENS))
    l2 = f"CASE WHEN content_tier = 'detailed' THEN {long} ELSE {short} END"
    s = "coalesce(content_summary, '')"
    l3 = _d_filled(INF.PROMPTS["l3"], title="title", tags=tags,
                   summary=f"CASE WHEN length({s}) > 0 THEN substr({s}, 1, 500) ELSE 'N/A' END",
                   content=D.truncate_with_marker(c, 2 * MAX_TOKENS, chr(10) + "[...truncated for analysis]"))
    return f"SELECT doc_id, {l1} AS l1_prompt, {l2} AS l2_prompt, {l3} AS l3_prompt FROM ({_D_RL2})"


@register("prompt_build", _RENDER_CTES + _d_prompts())
def q_prompt_build(spark, sf):
    l1 = L.assign_tiers(L.apply_l1(_render_base(spark, sf), derived(spark, sf, "responses_l1"), key="doc_id"))
    l2 = L.apply_l2(L.tier_filter(l1), derived(spark, sf, "responses_l2"), key="doc_id")
    return l2.select("doc_id", INF.l1_prompt().alias("l1_prompt"), INF.l2_prompt(MAX_TOKENS).alias("l2_prompt"),
                     INF.l3_prompt(MAX_TOKENS).alias("l3_prompt"))


@register("row_filters", D.with_ctes("repos", "messages_flat", "docs_export") + f"""
SELECT 'repo_not_fork' AS filter, CAST(count(*) AS BIGINT) AS n_in,
       CAST(count(*) FILTER (WHERE NOT coalesce(fork, false)) AS BIGINT) AS n_kept FROM repos
UNION ALL SELECT 'repo_has_content', CAST(count(*) FILTER (WHERE NOT coalesce(fork, false)) AS BIGINT),
       CAST(count(*) FILTER (WHERE NOT coalesce(fork, false) AND (length(coalesce(readme, '')) > 0
            OR length(coalesce(description, '')) > 0)) AS BIGINT) FROM repos
UNION ALL SELECT 'message_has_body', CAST(count(*) AS BIGINT),
       CAST(count(*) FILTER (WHERE length({D.strip(D.message_body())}) > 0) AS BIGINT) FROM messages_flat
UNION ALL SELECT 'doc_has_id_and_content', CAST(count(*) AS BIGINT),
       CAST(count(*) FILTER (WHERE {D.doc_id_from_url('url')} IS NOT NULL AND length(content) > 0) AS BIGINT) FROM docs_export
UNION ALL SELECT 'page_has_text', CAST(count(*) AS BIGINT),
       CAST(count(*) FILTER (WHERE length({D.html_to_text('html')}) > 0) AS BIGINT) FROM pages
""")
def q_row_filters(spark, sf):
    """O-P7/P8/P9 kept counts: one pass per input table, counts as conditional sums."""
    from notesmith.functions.common import py_strip
    r = derived(spark, sf, "repos")
    not_fork = ~F.coalesce(F.col("fork"), F.lit(False))
    has = (F.length(F.coalesce("readme", F.lit(""))) > 0) | (F.length(F.coalesce("description", F.lit(""))) > 0)

    def cnt(c):
        return F.sum(c.cast("long")).cast("bigint")

    repos = r.agg(cnt(F.lit(True)).alias("a"), cnt(not_fork).alias("b"), cnt(not_fork & has).alias("c"))
    out = repos.select(F.lit("repo_not_fork").alias("filter"), F.col("a").alias("n_in"), F.col("b").alias("n_kept")) \
        .unionByName(repos.select(F.lit("repo_has_content").alias("filter"), F.col("b").alias("n_in"),
                                  F.col("c").alias("n_kept")))
    m = A.messages_from_flat(derived(spark, sf, "messages_flat"))
    out = out.unionByName(m.agg(cnt(F.lit(True)).alias("n_in"), cnt(F.length(py_strip(T.body_choice("parts"))) > 0)
                                .alias("n_kept")).select(F.lit("message_has_body").alias("filter"), "n_in", "n_kept"))
    d = derived(spark, sf, "docs_export")
    out = out.unionByName(d.agg(cnt(F.lit(True)).alias("n_in"), cnt(U.doc_id_from_url("url").isNotNull()
                                                                  & (F.length("content") > 0)).alias("n_kept"))
                          .select(F.lit("doc_has_id_and_content").alias("filter"), "n_in", "n_kept"))
    p = _pages(spark, sf)
    out = out.unionByName(p.agg(cnt(F.lit(True)).alias("n_in"), cnt(F.length(H.html_to_text("html")) > 0)
                                .alias("n_kept")).select(F.lit("page_has_text").alias("filter"), "n_in", "n_kept"))
    return out


def offline_scorer(prompts: list[str]) -> list[str]:
    """A deterministic stand-in for the L1 model (no network): scores by prompt length."""
    out = []
    for p in prompts:
        words = len(p.split())
        out.append('{"relevance_score": %d, "tags": ["w%d"], "language": "xx"}' % (1 + words % 10, words % 3))
    return out


def _d_batch_inference() -> str:
    """The offline scorer in SQL: words of the prompt, then the score, tier and tag they give."""
    prompt = _d_filled(INF.PROMPTS["l1"], title="title", source="coalesce(source_name, '')", content=
                       "CASE WHEN length(coalesce(content_raw, '')) > 0 THEN substr(coalesce(content_raw, ''), 1, 2000) ELSE title END")
    words = rf"len(regexp_extract_all({prompt}, '[^{D.WS_CHARS}]+'))"
    return f"""
SELECT doc_id, CAST(score AS INTEGER) AS relevance_score,
       CASE WHEN score <= 3 THEN 'discard' WHEN score <= 6 THEN 'compressed' ELSE 'detailed' END AS content_tier,
       'w' || CAST(n % 3 AS VARCHAR) AS tags
FROM (SELECT doc_id, n, 1 + n % 10 AS score FROM (SELECT doc_id, {words} AS n FROM ({_D_RBASE})))"""


@register("batch_inference", _RENDER_CTES + _d_batch_inference())
def q_batch_inference(spark, sf):
    """O-M1 end to end over all documents: prompt columns -> Arrow batches -> callable -> native parse."""
    base = _render_base(spark, sf)
    prompts = base.select("doc_id", INF.l1_prompt().alias("prompt"))
    replies = INF.call_model(prompts, offline_scorer, key="doc_id", level="l1")
    scored = L.assign_tiers(L.apply_l1(base, replies, key="doc_id"))
    return scored.select("doc_id", "relevance_score", "content_tier", F.array_join("tags", ",").alias("tags"))


@register("reply_ledger", _RENDER_CTES + _d_batch_inference())
def q_reply_ledger(spark, sf):
    """O-M1 with a ledger: English documents are asked in a first run, the second run asks only what the ledger lacks."""
    base = _render_base(spark, sf)
    prompts = base.select("doc_id", "source", INF.l1_prompt().alias("prompt"))
    ledger = _scratch(spark, "replies")
    INF.call_with_ledger(prompts.where("source = 'rss'"), offline_scorer, ledger, "offline", key="doc_id")
    replies = INF.call_with_ledger(prompts, offline_scorer, ledger, "offline", key="doc_id", batch=5000)
    scored = L.assign_tiers(L.apply_l1(base, replies, key="doc_id"))
    return scored.select("doc_id", "relevance_score", "content_tier", F.array_join("tags", ",").alias("tags"))


@register("nearest_neighbor", f"""
SELECT a AS vec_id, b AS nn_id, round(dist, 6) AS dist FROM (
  SELECT a, b, dist, row_number() OVER (PARTITION BY a ORDER BY dist, b) AS rn FROM ({_D_PAIRS})) WHERE rn = 1
""")
def q_nearest_neighbor(spark, sf):
    """O-J6 + O-X1: nearest other vector per vector (blocked search), distance recomputed with the
    native column expression on the joined pair."""
    v = _vectors(spark, sf)
    nn = DN.nearest_neighbor(v)
    pair = nn.join(v, "vec_id").join(v.select(F.col("vec_id").alias("nn"), F.col("embedding").alias("e2")), "nn")
    return pair.select("vec_id", F.col("nn").alias("nn_id"),
                       F.round(DN.euclidean(F.col("embedding").cast("array<double>"), F.col("e2").cast("array<double>")),
                               6).alias("dist"))
