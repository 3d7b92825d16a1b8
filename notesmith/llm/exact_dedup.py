"""Exact deduplication with a heavy-hitter split.

1. One pass over the texts writes a narrow table of row fingerprints (SHA-256 of the normalised text). Every
   later step reads that table only; texts are never shuffled.
2. A frequent-items sketch of the Misra-Gries family (``approx_top_k``: mergeable counters per task, one bounded
   sketch in the end) names at most ``max_heavy`` candidate digests.
3. The candidates are verified: their exact counts and winners come from an aggregate that combines on the map
   side. At most ``max_heavy`` winner rows are broadcast and settle their rows on the map side, without a shuffle.
4. The remaining digests, none of which is frequent, go through an ordinary aggregate and join.

A digest that the sketch misses is merely shuffled; results never depend on the sketch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notesmith.llm.common import ascii_lower, documents, packed, text_of
from notesmith.session import cut_lineage

#: Most digests that are treated as frequent (also the most rows broadcast), and counters of the sketch.
MAX_HEAVY = 512
COUNTERS = 4096


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, digest (binary SHA-256 of the text with A-Z lower-cased) and a row number that tells equal rows apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(F.sha2(ascii_lower(text_of()).cast("binary"), 256)).alias("digest"),
                       F.monotonically_increasing_id().alias("row"))
    return cut_lineage(rows)


def frequent_digests(rows: DataFrame, max_heavy: int = MAX_HEAVY, counters: int = COUNTERS) -> DataFrame:
    """At most ``max_heavy`` digests that a sketch of ``counters`` counters finds frequent, seen twice at least."""
    top = rows.select(F.hex("digest").alias("digest")).agg(
        F.expr(f"approx_top_k(digest, {max_heavy}, {counters})").alias("top"))
    item = top.select(F.explode("top").alias("t")).where("t.count > 1")
    return item.select(F.unhex("t.item").alias("digest"))


def exact_dedup(docs: DataFrame, max_heavy: int = MAX_HEAVY, counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, digest, keep_id, group_size, kept, row.

    Null texts count as empty and equal empty texts. Of equal texts the row with the largest doc_id stays (null ids
    rank lowest); of repeated rows with that id exactly one is kept. An empty table gives no rows. Further columns of
    the input, whatever their names, are not read.
    """
    rows = fingerprints(docs)
    best = F.max(F.struct("doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")
    candidates = F.broadcast(frequent_digests(rows, max_heavy, counters))
    heavy = cut_lineage(rows.join(candidates, "digest").groupBy("digest").agg(*best))
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    settled = marked.where("best is not null")
    rest = marked.where("best is null").drop("best", "group_size")
    others = rest.join(rest.groupBy("digest").agg(*best), "digest")
    cols = ["doc_id", "digest", "best", "group_size", "row"]
    both = settled.select(cols).unionByName(others.select(cols))
    return both.select("doc_id", "digest", F.col("best.doc_id").alias("keep_id"), "group_size",
                       (F.col("best.row") == F.col("row")).alias("kept"), "row")


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    d = exact_dedup(documents(spark, sf_dir))
    return d.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that stay, one row per text, with all columns.

    Rows are matched to decisions by doc_id and digest. Rows that repeat both are numbered after the join on the
    columns it is already sorted by, so that one of them stays.
    """
    from pyspark.sql import Window

    keep = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("id"), "digest")
    keyed = docs.select(packed(docs), F.col("doc_id").cast("long").alias("id"),
                        F.unhex(F.sha2(ascii_lower(text_of()).cast("binary"), 256)).alias("digest"))
    a, b = keyed.alias("a"), keep.alias("b")
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.digest") == F.col("b.digest"))
    stays = a.join(b, same, "left_semi")
    w = Window.partitionBy("id", "digest").orderBy("id")
    return stays.withColumn("n", F.row_number().over(w)).where("n = 1").select("doc.*")


#: DuckDB: ``translate`` maps A-Z only.
ORACLE = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t
"""
