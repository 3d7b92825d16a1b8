"""The three model levels over stored replies (O-J4, O-N3..N6, O-P4..P6, O-J7, O-C8).

Each level is a left join of the articles with that level's reply table on the
article key (a missing reply behaves like an empty one), then native parsing.
Filters run before each join so no reply is looked up for a dropped article.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notesmith.functions import replies as R


def _join_replies(articles: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    r = replies.select(key, F.col("raw").alias("_raw"), F.col("error").alias("_error"))
    return articles.join(r, key, "left")


def apply_l1(articles: DataFrame, replies: DataFrame, key: str = "ord", merge_tags: bool = False) -> DataFrame:
    """Score, tags and language from the L1 reply; level becomes 'l1'.

    Tags from the reply replace the article's own unless ``merge_tags`` (then union, in order).
    """
    j = _join_replies(articles, replies, key)
    # Staged so each intermediate is computed once (and each projection stays small enough for codegen).
    j = j.withColumn("_js", R.extract_flat_json("_raw"))
    j = j.withColumn("_v", F.try_parse_json("_js"))
    j = j.withColumn("_sv", F.variant_get("_v", "$.relevance_score", "variant"))
    j = j.withColumn("_num", R.score_number("_sv"))
    parts = ("_raw", "_error", "_js", "_v", "_sv", "_num")
    j = j.withColumn("_ok", R.l1_ok_from(*parts)).withColumn("_score", R.score_from(*parts))
    prior = F.coalesce(F.col("tags"), F.array().cast("array<string>"))
    new_tags = F.when(F.col("_ok"), R.reply_tags("_v")).otherwise(prior)
    if merge_tags:
        new_tags = F.array_distinct(F.concat(prior, new_tags))
    return (j.withColumn("relevance_score", F.col("_score"))
             .withColumn("tags", new_tags)
             .withColumn("language", F.when(F.col("_ok"), R.reply_language("_v"))
                         .otherwise(F.coalesce(F.col("language"), F.lit(""))))
             .withColumn("processing_level", F.lit("l1"))
             .drop(*parts, "_ok", "_score"))


def assign_tiers(scored: DataFrame, discard_max: int = 3, compressed_max: int = 6) -> DataFrame:
    """O-P4 on scored rows."""
    return scored.withColumn("content_tier", R.assign_tier("relevance_score", discard_max, compressed_max))


def tier_filter(tiered: DataFrame, discard_max: int = 3) -> DataFrame:
    """O-P5: keep score > 0 and tier other than discard, i.e. score > max(0, discard_max).

    Written on the score alone: the predicate is pushed below the projection and inlined, so one
    reference to the score keeps the filter small. The push also reaches the reply side of the join
    (left join becomes inner over filtered replies), which measured faster than evaluating the score
    once inside a generator (``common.select_where``)."""
    return tiered.where(F.col("relevance_score") > max(0, discard_max))


def apply_l2(articles: DataFrame, replies: DataFrame, key: str = "ord") -> DataFrame:
    """Summary, key points and related topics from the L2 reply; level becomes 'l2'."""
    j = _join_replies(articles, replies, key).withColumn("_js", R.extract_greedy_json("_raw"))
    j = j.withColumn("_v", F.try_parse_json("_js"))
    j = j.withColumn("_s", R.summary_fields("_raw", "_error", "_js", "_v")).drop("_js", "_v")
    return (j.withColumn("content_summary", F.col("_s.summary"))
             .withColumn("key_points", F.col("_s.key_points"))
             .withColumn("related_topics", F.col("_s.related_topics"))
             .withColumn("processing_level", F.lit("l2"))
             .drop("_raw", "_error", "_s"))


def deep_condition(min_score: int = 7, enabled: bool = True, compressed_max: int = 6):
    """O-P6: score >= min_score and tier detailed (score > compressed_max), written as one bound on the score."""
    return F.col("relevance_score") >= max(min_score, compressed_max + 1) if enabled else F.lit(False)


def deep_gate(df: DataFrame, min_score: int = 7, enabled: bool = True, compressed_max: int = 6) -> DataFrame:
    """Rows that get the deep analysis."""
    return df.where(deep_condition(min_score, enabled, compressed_max))


def analyze_l3(gated: DataFrame, replies: DataFrame, key: str = "ord") -> DataFrame:
    """L3 result per gated row: key + parsed analysis struct (``ok`` false -> row stays unchanged)."""
    j = gated.select(key).join(replies.select(key, F.col("raw").alias("_raw"), F.col("error").alias("_error")),
                               key, "left")
    j = j.withColumn("_js", R.extract_greedy_json("_raw")).withColumn("_v", F.try_parse_json("_js"))
    return j.select(key, R.analysis_fields("_raw", "_error", "_js", "_v").alias("_a"))


def overlay_l3(articles: DataFrame, replies: DataFrame, key: str = "ord", min_score: int = 7,
               enabled: bool = True) -> DataFrame:
    """O-J7: left join of the L3 results; rows outside the gate or with a failed reply keep their values."""
    # Replies are parsed by themselves and joined once; the gate is part of the condition, so articles are read once.
    parsed = replies.select(key, F.col("raw").alias("_raw"), F.col("error").alias("_error"))
    parsed = parsed.withColumn("_js", R.extract_greedy_json("_raw")).withColumn("_v", F.try_parse_json("_js"))
    res = parsed.select(key, R.analysis_fields("_raw", "_error", "_js", "_v").alias("_a")).where("_a.ok")
    base = articles
    for c, default in (("l3_concepts", F.array().cast(R.CONCEPTS_TYPE)), ("l3_structure_type", F.lit("")),
                       ("l3_key_insight", F.lit("")), ("content_deep", F.lit(""))):
        if c not in base.columns:
            base = base.withColumn(c, default)
    j = base.join(res, key, "left")
    hit = F.col("_a").isNotNull() & deep_condition(min_score, enabled)
    return (j.withColumn("l3_concepts", F.when(hit, F.col("_a.concepts")).otherwise(F.col("l3_concepts")))
             .withColumn("l3_structure_type", F.when(hit, F.col("_a.structure_type")).otherwise(F.col("l3_structure_type")))
             .withColumn("l3_key_insight", F.when(hit, F.col("_a.key_insight")).otherwise(F.col("l3_key_insight")))
             .withColumn("content_deep", F.when(hit, F.col("_a.content_deep")).otherwise(F.col("content_deep")))
             .withColumn("processing_level", F.when(hit, F.lit("l3")).otherwise(F.col("processing_level")))
             .drop("_a"))


def concept_rows(df: DataFrame, key: str = "ord") -> DataFrame:
    """O-C8: one row per concept, position kept."""
    return df.select(key, F.posexplode("l3_concepts").alias("pos", "c")).select(
        key, F.col("pos").cast("int").alias("pos"), F.col("c.name").alias("name"),
        F.coalesce(F.col("c.definition"), F.lit("")).alias("definition"))
