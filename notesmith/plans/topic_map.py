"""Q2 topic map: notes -> embedding text -> vectors -> clusters (or tag topics) -> pages + index.

The embedding callable is optional; without usable vectors (none, or any empty) the run
uses greedy tag topics (O-M4). Pages are written as ordered chunks (O-K3).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notesmith.operators import density, inference, maps, topics


@dataclass
class TopicMap:
    topics: DataFrame
    members: DataFrame
    pages: DataFrame
    index: DataFrame
    used_vectors: bool


def plan_topic_map(notes: DataFrame, as_of: str, embed_fn: Callable | None = None, vectors: DataFrame | None = None,
                   min_cluster_size: int = 3, min_samples: int = 2, hierarchical: bool = True) -> TopicMap:
    """``notes``: ord, path, title, tags, summary, relevance, source_name (e.g. from read_notes).
    ``vectors``: an already computed (ord, embedding) table, used instead of ``embed_fn``."""
    if notes.limit(2).count() < 2:  # O-P11: fewer than two notes -> no topics
        empty_t = notes.sparkSession.createDataFrame([], "topic_id long, name string, size bigint, "
                                                         "core_tags array<string>, topic_order int")
        m = notes.limit(0).withColumn("topic_id", F.lit(0).cast("long"))
        return TopicMap(empty_t, m, maps.topic_pages(empty_t, m, as_of), maps.topic_index(empty_t, m, as_of), False)
    if vectors is None and embed_fn is not None:
        text = notes.select("ord", topics.embedding_text("tags", "summary", "title").alias("text"))
        vectors = inference.embed(text, embed_fn, key="ord", text="text")
    use_vectors = vectors is not None and inference.vectors_usable(vectors)
    if use_vectors:
        pts = vectors.select(F.col("ord").alias("vec_id"), "embedding")
        if hierarchical:
            labels = density.hierarchy_labels(pts, min_samples, min_cluster_size)
        else:
            labels, _ = density.fixed_cut_labels(pts, min_samples, min_cluster_size)
        labels = labels.select(F.col("vec_id").alias("ord"), "label")
        t, m = topics.assemble_topics(notes, labels)
    else:
        t, m = topics.greedy_tag_topics(notes, min_cluster_size)
    t = maps.with_pages(t)
    return TopicMap(t, m, maps.topic_pages(t, m, as_of), maps.topic_index(t, m, as_of), use_vectors)
