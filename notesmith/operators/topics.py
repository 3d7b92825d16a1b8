"""Topics over notes (O-C4..C7, O-A3..A6, O-W5, O-W6, O-O2..O4, O-P10, O-P11, O-R4, O-J5, O-J8, O-J9).

Notes table: ord (note order), path, title, tags (distinct, in note order), relevance, source_name.
Topics are normalised: ``topics`` (topic_id, name, size, core_tags, topic_order) and
``members`` (topic_id + note columns), never a nested list of notes in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notesmith.functions.common import col
from notesmith.operators.joins import sized_broadcast
from notesmith.operators.ranking import balanced_row_number
from notesmith.session import cut_lineage


def notes_from_csv(df: DataFrame, tags_csv: str = "tags_csv") -> DataFrame:
    """Split comma-separated tags; duplicates inside a note are dropped (first kept)."""
    tags = F.when(F.length(tags_csv) > 0, F.array_distinct(F.split(tags_csv, ","))).otherwise(
        F.array().cast("array<string>"))
    return df.withColumn("tags", tags).drop(tags_csv)


def embedding_text(tags, summary, title) -> Column:
    """O-R4: 'Tags: a, b | <summary, 300 chars>'; title when both are empty."""
    t = F.coalesce(col(tags), F.array().cast("array<string>"))
    s = F.coalesce(col(summary), F.lit(""))
    parts = F.concat_ws(" | ", F.when(F.size(t) > 0, F.concat(F.lit("Tags: "), F.array_join(t, ", "))),
                        F.when(F.length(s) > 0, F.substring(s, 1, 300)))
    return F.when(F.length(parts) > 0, parts).otherwise(col(title))


def tag_edges(notes: DataFrame, label_col: str | None = None) -> DataFrame:
    """O-J5: one row per (note, tag) with the tag's position inside the note."""
    cols = ["ord"] + ([label_col] if label_col else [])
    return notes.select(*cols, F.posexplode("tags").alias("pos", "tag"))


def tag_counts(notes: DataFrame, label_col: str) -> DataFrame:
    """O-A3: tag frequency per cluster with first appearance (note order, then position in the note).
    Map-side partial aggregation keeps a hot (label, tag) cheap."""
    e = tag_edges(notes, label_col)
    return e.groupBy(label_col, "tag").agg(F.count(F.lit(1)).cast("bigint").alias("cnt"),
                                          F.min(F.struct("ord", "pos")).alias("first"))


def top_tags(counts: DataFrame, label_col: str, k: int) -> DataFrame:
    """O-W5/O-O4: the k most frequent tags per cluster, ties by first appearance, as an ordered array."""
    w = Window.partitionBy(label_col).orderBy(F.desc("cnt"), "first")
    ranked = counts.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k)
    return ranked.groupBy(label_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rk", "tag"))), lambda x: x["tag"]).alias("top"))


def topic_name(top3, size) -> Column:
    """O-C6: top three tags joined ' / ' (one tag alone); no tags -> 'Topic (n articles)'."""
    t = F.coalesce(col(top3), F.array().cast("array<string>"))
    return F.when(F.size(t) == 0, F.concat(F.lit("Topic ("), col(size).cast("string"), F.lit(" articles)"))).otherwise(
        F.array_join(t, " / "))


def trivial_labels(points: DataFrame, min_points: int = 3) -> DataFrame:
    """O-C5: all points label 0 when there are at least ``min_points``, else -1 (one count action)."""
    n = points.count()
    return points.withColumn("label", F.lit(0 if n >= min_points else -1))


def assemble_topics(notes: DataFrame, labels: DataFrame, min_notes: int = 2) -> tuple[DataFrame, DataFrame]:
    """O-C7: topics from cluster labels (noise -1 dropped), named by tag frequency, sorted by size
    desc then first member (stable). Returns (topics, members)."""
    if notes.limit(min_notes).count() < min_notes:  # O-P11
        empty = notes.sparkSession.createDataFrame([], "topic_id int, name string, size bigint, "
                                                       "core_tags array<string>, topic_order int")
        return empty, notes.limit(0).withColumn("topic_id", F.lit(0))
    lab = labels.where(F.col("label") != -1).select("ord", F.col("label").alias("topic_id"))  # O-P10
    members = notes.join(lab, "ord", "inner")  # O-J8
    sizes = members.groupBy("topic_id").agg(F.count(F.lit(1)).cast("bigint").alias("size"),
                                            F.min("ord").alias("first_ord"))  # O-A4
    counts = tag_counts(members, "topic_id")
    top5 = top_tags(counts, "topic_id", 5)
    t = sizes.join(top5, "topic_id", "left")
    t = t.withColumn("core_tags", F.coalesce("top", F.array().cast("array<string>")))
    t = t.withColumn("name", topic_name(F.slice("core_tags", 1, 3), "size"))
    t = t.withColumn("_neg", -F.col("size"))
    t = balanced_row_number(t, [], ["_neg", "first_ord"], "topic_order")  # O-O2, stable
    t = t.withColumn("topic_order", F.col("topic_order").cast("int"))
    return t.select("topic_id", "name", "size", "core_tags", "topic_order"), members


def greedy_tag_topics(notes: DataFrame, min_size: int = 3, max_rounds: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """O-C4, exact: tags by (count desc, first appearance); each, in turn, takes its still-free notes if
    at least ``min_size`` remain.

    Parallel form: every round decides tags from one snapshot. For an undecided tag t, ``hi`` counts
    its notes with no better accepted tag (an upper bound on t's free notes) and ``lo`` those whose
    better tags are all decided and rejected (a lower bound). lo >= min accepts, hi < min rejects;
    the best undecided tag always has lo == hi, so each round decides at least one tag. Each note
    finally belongs to its best accepted tag. Returns (topics, members).
    """
    edges = tag_edges(notes).select("ord", "tag", "pos")
    stats = edges.groupBy("tag").agg(F.count(F.lit(1)).alias("cnt"), F.min(F.struct("ord", "pos")).alias("first"))
    stats = stats.where(F.col("cnt") >= min_size)
    # Tags are ranked once (one row per tag; a range-partitioned global rank, not a one-task window).
    stats = stats.select("tag", (-F.col("cnt")).alias("_neg"), F.col("first.ord").alias("_fo"), F.col("first.pos").alias("_fp"))
    ranked = cut_lineage(balanced_row_number(stats, [], ["_neg", "_fo", "_fp"], "rank").select("tag", "rank"))
    e = cut_lineage(edges.join(sized_broadcast(ranked), "tag", "inner").select("ord", "tag", "rank"))
    state = ranked.withColumn("state", F.lit("und"))
    for i in range(max_rounds):
        st = sized_broadcast(state.select("tag", "state"))
        es = e.join(st, "tag", "inner")
        per_note = es.groupBy("ord").agg(
            F.min(F.when(F.col("state") == "acc", F.col("rank"))).alias("best_acc"),
            F.min(F.when(F.col("state") == "und", F.col("rank"))).alias("best_und"))
        und = es.where("state = 'und'").join(per_note, "ord", "inner")
        free_hi = F.col("best_acc").isNull() | (F.col("best_acc") > F.col("rank"))
        free_lo = free_hi & (F.col("best_und") == F.col("rank"))
        bounds = und.groupBy("tag").agg(F.sum(free_hi.cast("long")).alias("hi"),
                                        F.sum(free_lo.cast("long")).alias("lo"))
        state = (state.join(bounds, "tag", "left")
                 .withColumn("state", F.when(F.col("state") != "und", F.col("state"))
                             .when(F.col("lo") >= min_size, F.lit("acc"))
                             .when(F.coalesce(F.col("hi"), F.lit(0)) < min_size, F.lit("rej"))
                             .otherwise(F.lit("und")))
                 .select("tag", "rank", "state"))
        state = cut_lineage(state)  # one row per tag: a cheap cut that keeps every round's plan small
        if state.where("state = 'und'").limit(1).count() == 0:
            break
    else:
        raise RuntimeError(f"tags are undecided after {max_rounds} rounds")
    acc = sized_broadcast(state.where("state = 'acc'").select("tag", "rank"))
    best = e.join(acc, ["tag", "rank"], "inner").groupBy("ord").agg(F.min("rank").alias("rank"))  # O-J9
    members = best.join(acc, "rank", "inner").join(notes, "ord", "inner")
    sizes = members.groupBy("rank", "tag").agg(F.count(F.lit(1)).cast("bigint").alias("size"))
    topics = balanced_row_number(sizes, [], ["rank"], "topic_order").select(
        F.col("rank").alias("topic_id"), F.col("tag").alias("name"), "size", F.array("tag").alias("core_tags"),
        F.col("topic_order").cast("int").alias("topic_order"))
    return topics, members.withColumnRenamed("rank", "topic_id").drop("tag")
