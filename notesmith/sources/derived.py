"""Input tables the supplied data lacks, derived from the supplied tables.

Each derived table is a projection (plus an optional filter / DISTINCT) whose
expressions are plain SQL valid in both Spark and DuckDB. Spark builds it with
``selectExpr`` over the parquet table, so scans stay pruned and the work grows
with the supplied tables; the oracle gets the same text as a CTE. Only
arithmetic on ids is used to vary the cases, never hash functions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from notesmith.session import load_table


@dataclass(frozen=True)
class Derived:
    source: str
    exprs: tuple[str, ...]
    where: str | None = None
    distinct: bool = False
    deps: tuple[str, ...] = field(default=())
    stored: bool = False  # stands for a stored table: materialized once, read back as plain columns

    def sql(self) -> str:
        sel = "SELECT DISTINCT " if self.distinct else "SELECT "
        q = sel + ",\n  ".join(self.exprs) + f"\nFROM {self.source}"
        if self.where:
            q += f"\nWHERE {self.where}"
        return q


_L1_SCORE = "CAST(1 + doc_id % 10 AS STRING)"

DERIVED: dict[str, Derived] = {
    # A previous run's seen-store: every fifth page was ingested before.
    "seen_pages": Derived("pages", ("page_id", "url"), where="page_id % 5 = 0"),
    "feeds": Derived("documents", (
        "source AS name",
        "'http://' || source || '.example.com/rss' AS url",
        "'general' AS category",
        "5 AS max_articles",
        "source <> 'src3' AS enabled",
    ), distinct=True),
    "feed_entries": Derived("documents", (
        "doc_id AS ord",
        "source AS feed",
        "CASE WHEN doc_id % 11 = 0 THEN '' "
        "ELSE 'https://' || source || '.example.com/a/' || CAST(doc_id % 400 AS STRING) END AS link",
        "substr(text, 1, 60) AS title",
        "CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS page_text",
        "CASE WHEN doc_id % 2 = 0 THEN '<p>' || text || '</p>' ELSE '' END AS content",
        "'<b>' || substr(text, 1, 250) || '</b>' AS description",
        "substr(text, 1, 80) AS summary",
        "CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'Writer ' || lang END AS author",
        "CASE WHEN doc_id % 6 = 0 THEN 'not a date' "
        "ELSE 'Tue, ' || CAST(1 + doc_id % 28 AS STRING) || ' May 2026 0' || CAST(doc_id % 10 AS STRING) "
        "|| ':15:00 +0000' END AS published",
    )),
    # Newsletter messages, one row per message with flat part columns.
    "messages_flat": Derived("documents", (
        "doc_id AS ord",
        "CASE WHEN doc_id % 3 = 0 THEN 'News@' || source || '.example.com' "
        "ELSE 'News ' || source || ' <News@' || source || '.example.com>' END AS from_header",
        "substr(text, 1, 40) AS subject",
        "CASE WHEN doc_id % 9 = 0 THEN '' ELSE '<m' || CAST(doc_id AS STRING) || '@x>' END AS message_id",
        "'10 May 2026 08:00:00 +0000' AS date_header",
        "CASE WHEN doc_id % 20 = 0 THEN '  ' "
        "WHEN doc_id % 4 = 0 THEN text || chr(10) || chr(10) || 'To unsubscribe click here.' || chr(10) || 'http://u' "
        "WHEN doc_id % 4 = 1 THEN text || chr(10) || 'You received this email because you subscribed.' "
        "ELSE text END AS plain",
        "doc_id % 5 <> 2 AS has_plain",
        "'<h2>' || substr(text, 1, 30) || '</h2><p>' || substr(text, 31, 200) || '</p>' AS html",
        "'attachment; filename=a' || CAST(doc_id AS STRING) || '.txt' AS attachment_disposition",
    )),
    "repos": Derived("part", (
        "p_partkey AS ord",
        "'owner' || CAST(p_partkey % 10 AS STRING) || '/' || replace(p_name, ' ', '-') || '-' "
        "|| CAST(p_partkey AS STRING) AS repo",
        "CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END AS description",
        "lower(p_type) || ',' || lower(p_name) AS topics_csv",
        "p_brand AS language",
        "p_size AS stars",
        "p_size % 7 = 0 AS fork",
        "CASE WHEN p_partkey % 8 = 0 THEN '' ELSE '# ' || p_name END AS readme",
    )),
    "docs_export": Derived("pages", (
        "page_id AS ord",
        "'https://t' || CAST(page_id % 5 AS STRING) || '.feishu.cn/' || "
        "CASE page_id % 4 WHEN 0 THEN 'wiki' WHEN 1 THEN 'docx' WHEN 2 THEN 'docs' ELSE 'x' END || "
        "'/D' || CAST(page_id AS STRING) || '?from=c' AS url",
        "CASE WHEN page_id % 3 = 0 THEN 'Api ' || CAST(page_id AS STRING) ELSE '' END AS api_title",
        "CASE WHEN page_id % 10 = 0 THEN '' "
        "WHEN page_id % 2 = 0 THEN '# Head ' || CAST(page_id AS STRING) || chr(10) || 'body' "
        "ELSE 'body only' END AS content",
    )),
    # Stored model replies, level L1: eight reply shapes.
    "responses_l1": Derived("documents", (
        "doc_id",
        "CASE doc_id % 8 "
        f"WHEN 0 THEN '{{\"relevance_score\": ' || {_L1_SCORE} || ', \"tags\": [\"' || lang || '\", \"' || source "
        "|| '\"], \"language\": \"' || lang || '\", \"reason\": \"r\"}' "
        f"WHEN 1 THEN 'Sure: {{\"relevance_score\": ' || {_L1_SCORE} || ', \"tags\": [\"' || lang || '\"]}} done' "
        f"WHEN 2 THEN '{{\"relevance_score\": \"' || {_L1_SCORE} || '\"}}' "
        "WHEN 3 THEN '{\"relevance_score\": null, \"tags\": []}' "
        "WHEN 4 THEN 'no object here' "
        "WHEN 5 THEN '' "
        "WHEN 6 THEN '{\"relevance_score\": 7.9, \"tags\": null}' "
        "ELSE '{\"tags\": [\"x\"' || '}' END AS raw",
        "CASE WHEN doc_id % 50 = 49 THEN 'API down' END AS error",
    ), stored=True),
    # Level L2: summary replies, incl. a <think> prefix, nested braces and a malformed think tag.
    "responses_l2": Derived("documents", (
        "doc_id",
        "CASE doc_id % 8 "
        "WHEN 0 THEN '{\"tldr\": \"T' || CAST(doc_id AS STRING) || '\", \"summary\": \"S ' || lang || '\", "
        "\"key_points\": [\"k1 ' || lang || '\", \"k2 ' || source || '\"], \"related_topics\": [\"' || source || '\"]}' "
        "WHEN 1 THEN '<think>plan {draft}</think>' || chr(10) || '{\"tldr\": \"T' || CAST(doc_id AS STRING) || "
        "'\", \"summary\": \"S\", \"key_points\": [\"p\"]}' "
        "WHEN 2 THEN 'Here: {\"summary\": \"S' || CAST(doc_id AS STRING) || '\", \"key_points\": [\"a\", \"b\"], "
        "\"meta\": {\"n\": 1}} end' "
        "WHEN 3 THEN '{\"summary\": \"only ' || source || '\"}' "
        "WHEN 4 THEN 'plain words ' || CAST(doc_id AS STRING) "
        "WHEN 5 THEN '' "
        "WHEN 6 THEN '{\"tldr\": \"x\", \"summary\": }' "
        "ELSE '<think' || chr(10) || 'malformed</think' || chr(10) || '{\"tldr\": \"T' || CAST(doc_id AS STRING) "
        "|| '\"}' END AS raw",
        "CASE WHEN doc_id % 50 = 49 THEN 'API down' END AS error",
    ), stored=True),
    # Level L3: analysis replies.
    "responses_l3": Derived("documents", (
        "doc_id",
        "CASE doc_id % 8 "
        "WHEN 0 THEN '{\"concepts\": [{\"name\": \"c' || CAST(doc_id AS STRING) || '\", \"definition\": \"d1\"}, "
        "{\"name\": \"' || lang || '\", \"definition\": \"d2\"}], \"structure_type\": \"analysis\", "
        "\"key_insight\": \"K' || CAST(doc_id AS STRING) || '\", \"assumptions\": [\"a1\", \"a2\"], "
        "\"position\": \"neutral\"}' "
        "WHEN 1 THEN '<think>x</think>{\"concepts\": [], \"structure_type\": \"news\", \"key_insight\": \"\"}' "
        "WHEN 2 THEN 'Result: {\"concepts\": [{\"name\": \"' || source || '\"}], \"key_insight\": \"K\"} ok' "
        "WHEN 3 THEN '{\"concepts\": [{\"definition\": \"d\"}], \"structure_type\": \"x\"}' "
        "WHEN 4 THEN 'nothing' "
        "WHEN 5 THEN '' "
        "WHEN 6 THEN '{\"structure_type\": \"tutorial\", \"assumptions\": [], \"position\": \"skeptic\"}' "
        "ELSE '{\"concepts\": [}' END AS raw",
        "CASE WHEN doc_id % 50 = 49 THEN 'API down' END AS error",
    ), stored=True),
    # Notes for topic maps: tags distinct inside a note.
    "doc_tags": Derived("documents", (
        "doc_id AS ord",
        "'n' || CAST(doc_id AS STRING) || '.md' AS path",
        "lang || ',' || source || CASE WHEN doc_id % 2 = 0 THEN ',even' ELSE '' END AS tags_csv",
        "1 + doc_id % 10 AS relevance",
        "'Note ' || CAST(doc_id AS STRING) AS title",
        "source AS source_name",
    )),
    # Date strings in three formats, one row per event.
    "date_strings": Derived("events", (
        "event_id",
        "ts",
        "CASE event_id % 4 "
        "WHEN 0 THEN 'Mon, ' || CAST(1 + event_id % 28 AS STRING) || ' Jan 2024 1' || CAST(event_id % 10 AS STRING) "
        "|| ':0' || CAST(event_id % 6 AS STRING) || ':00 +0100' "
        "WHEN 1 THEN CAST(1 + event_id % 28 AS STRING) || ' Feb 2024 0' || CAST(event_id % 10 AS STRING) "
        "|| ':30:00 -0500' "
        "WHEN 2 THEN 'garbage ' || event_type "
        "ELSE '' END AS rfc_date",
        "CASE event_id % 3 "
        "WHEN 0 THEN '2024-03-' || CAST(10 + event_id % 18 AS STRING) || 'T12:00:00Z' "
        "WHEN 1 THEN '2024-04-0' || CAST(1 + event_id % 9 AS STRING) || 'T08:15:30+02:00' "
        "ELSE 'bad-' || event_type END AS iso_date",
    )),
}


def derived_sql(name: str) -> str:
    return DERIVED[name].sql()


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    d = DERIVED[name]
    df = load_table(spark, sf_dir, d.source)
    if d.where:
        df = df.where(d.where)
    df = df.selectExpr(*d.exprs)
    df = df.distinct() if d.distinct else df
    if d.stored:
        from notesmith.session import cut_lineage
        df = cut_lineage(df)
    return df
