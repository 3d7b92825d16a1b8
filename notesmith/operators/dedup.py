"""First-seen deduplication (O-W1, O-J1, O-K2, O-A1, O-A7).

First-wins is an aggregation, not a window: ``min(struct(ord, ...))`` per key
is combined map-side, so a key that holds a third of all rows still shrinks to
one row per map task before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notesmith.functions.urls import url_hash
from notesmith.operators.key_store import seen_store


def with_url_hash(df: DataFrame, url_col: str = "url", out: str = "url_hash") -> DataFrame:
    return df.withColumn(out, url_hash(url_col))


def first_per_key(df: DataFrame, key: str | list[str], order_col: str = "ord", count_as: str | None = None) -> DataFrame:
    """O-W1: the row with the smallest ``order_col`` per key (ties broken by the remaining columns)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != order_col]
    aggs: list[Column] = [F.min(F.struct(order_col, *rest)).alias("_first")]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [*keys, F.col("_first.*")]
    if count_as:
        cols.append(count_as)
    return out.select(*cols)


def drop_seen(batch: DataFrame, seen: DataFrame, key: str = "url_hash") -> DataFrame:
    """O-J1: rows whose key is not in the seen-store (left anti-join; AQE picks broadcast
    only when the store turns out small at run time)."""
    return batch.join(seen.select(key), on=key, how="left_anti")


def filter_new(batch: DataFrame, seen: DataFrame, key: str = "url_hash", order_col: str = "ord") -> DataFrame:
    """Dedup inside the batch (first wins) and against the store."""
    return drop_seen(first_per_key(batch, key, order_col), seen, key)


def seen_records(new: DataFrame, as_of: str, source_col: str = "source") -> DataFrame:
    """Rows for the seen-store, one per new url_hash (O-K2 schema)."""
    return new.select(
        "url_hash", "url",
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("content_hash"), F.lit("")).alias("content_hash"),
        F.lit(as_of).alias("first_seen"),
        F.col(source_col).alias("source"),
    )


def unseen(batch: DataFrame, store_path: str) -> DataFrame:
    """O-J1 against a stored seen-store: only the parts in which a key of the batch may be are read (``key_store``)."""
    return seen_store(batch.sparkSession, store_path).unseen(batch)


def append_seen(new: DataFrame, store_path: str, as_of: str) -> int:
    """O-K2 insert-or-ignore: the keys that are not stored yet, in one append per run; returns how many."""
    return seen_store(new.sparkSession, store_path).insert(seen_records(new, as_of))


def seen_stats(seen: DataFrame, source_col: str = "source", total_label: str = "*") -> DataFrame:
    """O-A1: count per source plus the total, in one rollup pass."""
    return (seen.rollup(source_col).agg(F.count(F.lit(1)).alias("n"))
            .select(F.coalesce(F.col(source_col), F.lit(total_label)).alias("source"), F.col("n").cast("bigint")))
