"""Incremental ingest as Structured Streaming (O-T1, O-T2).

O-T1: each micro-batch of newly dropped article files is deduplicated first-wins inside
the batch, looked up in the seen-store, and the new rows are appended to the output
and then to the store (``foreachBatch``; the checkpoint makes a restarted query resume
after the last committed batch, and the lookup makes a replayed batch a no-op).
O-T2: the same dedup with bounded state, ``dropDuplicatesWithinWatermark`` on url_hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from notesmith.functions.urls import url_hash
from notesmith.operators import dedup
from notesmith.session import cut_lineage, scratch_cuts

def ingest_new(batch: DataFrame, store_path: str, out_path: str, as_of: str, batch_id: int = 0) -> None:
    """One micro-batch: first per url_hash (by ord), minus the store; write the new rows, then the store.

    Of the store only the parts are read in which a URL of the batch may be (``key_store``). The output partition of the batch is overwritten (dynamic), so a replayed batch replaces its own
    rows; the store takes only keys that it does not hold, so replaying it adds nothing."""
    from pyspark.sql import functions as F

    spark = batch.sparkSession
    hashed = batch.withColumn("url_hash", url_hash("url"))
    with scratch_cuts(spark):
        new = cut_lineage(dedup.unseen(dedup.first_per_key(hashed, "url_hash", "ord"), store_path))
        (new.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))
        dedup.append_seen(new, store_path, as_of)


def start_incremental(spark: SparkSession, input_dir: str, schema: T.StructType, store_path: str, out_path: str,
                      checkpoint: str, as_of: str, available_now: bool = True):
    """O-T1: file source -> foreachBatch(ingest_new). Returns the StreamingQuery."""
    stream = spark.readStream.schema(schema).parquet(input_dir)
    w = stream.writeStream.foreachBatch(lambda df, epoch: ingest_new(df, store_path, out_path, as_of, epoch)).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def bounded_dedup(stream: DataFrame, event_time: str = "fetched_at", delay: str = "7 days") -> DataFrame:
    """O-T2: drop repeats of a url_hash seen within the watermark delay; state is bounded by it."""
    return (stream.withColumn("url_hash", url_hash("url")).withWatermark(event_time, delay)
            .dropDuplicatesWithinWatermark(["url_hash"]))


def with_fetched_at(df: DataFrame, as_of: str) -> DataFrame:
    from notesmith.sources.articles import utc_midnight
    return df.withColumn("fetched_at", utc_midnight(as_of))
