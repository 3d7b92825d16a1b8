"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns the documents the next one works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from notesmith.llm import byte_bpe, exact_dedup, minhash_hamming, quality_rules, source_mix
from notesmith.llm.common import documents
from notesmith.session import cut_lineage

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_dedup", minhash_hamming.stage),
    ("source_mix", source_mix.stage),
    ("byte_bpe", byte_bpe.stage),
]

#: Near-duplicates and the mix have no SQL; tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again by the next one."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else cut_lineage(docs), sf_dir)
    return docs
