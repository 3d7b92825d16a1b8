"""End-to-end jobs (Q1 ingest, Q2 topic map) and the incremental stream (O-T1, O-T2)."""

import time

import pytest
from pyspark.sql import functions as F

from notesmith.operators import dedup, notes
from notesmith.plans import catalog as C
from notesmith.plans import ingest, topic_map
from notesmith.streaming import incremental
from tests.conftest import SF001

ARTICLE_SCHEMA = "ord long, url string, title string, content_raw string, source string, content_hash string"


def _articles(spark, rows):
    return spark.createDataFrame(rows, ARTICLE_SCHEMA)


def _whole_articles(spark, rows):
    """With the columns that prompts and notes read."""
    return _articles(spark, rows).withColumns({
        "source_name": F.lit("feed"), "author": F.lit("a"), "published_at": F.lit(None).cast("timestamp"),
        "language": F.lit(""), "tags": F.array().cast("array<string>")})


def test_ingest_dry_run_and_limit(spark):
    rows = [(i, f"https://e.com/{i}", f"T{i}", "text", "rss", f"h{i}") for i in range(3)]
    st = ingest.plan_ingest(_articles(spark, rows), None, "2026-05-10", dry_run=True)
    assert st.new.count() == 3 and st.rendered is None
    st = ingest.plan_ingest(_articles(spark, rows), None, "2026-05-10", limit=2, dry_run=True)
    assert st.new.count() == 2


def test_ingest_funnel_and_write(spark, tmp_path):
    st = C._ingest_stages(spark, SF001)
    funnel = {r["stage"]: r["n"] for r in ingest.funnel_counts(st).collect()}
    assert funnel["fetched"] >= funnel["new"] >= funnel["l1_passed"] == funnel["l2_summarized"] == funnel["written"]
    st = C._ingest_stages(spark, SF001)  # fresh observations for the write job
    stats = ingest.write(st, str(tmp_path / "notes"), str(tmp_path / "seen"), "2026-05-10")
    assert stats["written"] == funnel["written"]
    assert stats["new"] == funnel["new"] and stats["l1_passed"] == funnel["l1_passed"]
    assert stats["l1_in"] == stats["l1_passed"] + stats["l1_discarded"]
    failed = spark.read.parquet(str(tmp_path / "notes-errors"))
    assert stats["errors"] == funnel["errors"] == failed.where(F.col("run") == stats["run"]).count() > 0
    assert {r["stage"] for r in failed.select("stage").distinct().collect()} <= {"l1", "l2", "l3"}
    assert spark.read.parquet(str(tmp_path / "seen")).count() == funnel["new"]
    # A second run over the same input finds nothing new.
    seen = spark.read.parquet(str(tmp_path / "seen")).select("url_hash")
    base = C._render_base(spark, SF001)
    again = ingest.plan_ingest(base, None, "2026-05-10", seen=seen, key="doc_id", dry_run=True)
    assert again.new.join(base.where("source = 'rss'").select("doc_id"), "doc_id", "left_anti").count() == 0


def test_topic_map_tag_fallback_and_vectors(spark):
    notes = C._tag_notes(spark, SF001).join(
        spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id").alias("ord"),
                                                                  F.col("text").alias("summary")), "ord")

    def broken(texts):
        raise RuntimeError("no key")

    tm = topic_map.plan_topic_map(notes, "2026-05-10", embed_fn=broken)
    assert not tm.used_vectors and tm.topics.count() > 0 and tm.index.count() > 0

    def lang_vectors(texts):  # vectors that separate the notes by their first tag
        out = []
        for t in texts:
            first = t.split("Tags: ")[1].split(",")[0] if t.startswith("Tags: ") else ""
            out.append([10.0 * (hash(first) % 7), float(len(t) % 3) * 0.01, 0.0])
        return out

    tm = topic_map.plan_topic_map(notes, "2026-05-10", embed_fn=lang_vectors, hierarchical=False)
    assert tm.used_vectors and tm.topics.count() >= 1


def test_incremental_two_drops(spark, tmp_path):
    inp, store, out, ckpt = (str(tmp_path / x) for x in ("in", "seen", "out", "ckpt"))
    schema = spark.createDataFrame([], ARTICLE_SCHEMA).schema
    _articles(spark, [(1, "https://a.com/1", "A", "x", "rss", "h"), (2, "https://a.com/2/", "B", "x", "rss", "h"),
                      (3, "https://a.com/2", "B2", "x", "rss", "h")]).write.mode("append").parquet(inp)
    q = incremental.start_incremental(spark, inp, schema, store, out, ckpt, "2026-05-10")
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    time.sleep(1)
    _articles(spark, [(4, "https://a.com/1?utm_source=x", "A again", "x", "rss", "h"),
                      (5, "https://a.com/3", "C", "x", "rss", "h")]).write.mode("append").parquet(inp)
    q = incremental.start_incremental(spark, inp, schema, store, out, ckpt, "2026-05-10")
    q.awaitTermination(120)
    assert sorted(r["ord"] for r in spark.read.parquet(out).collect()) == [1, 2, 5]
    assert spark.read.parquet(store).count() == 3


def test_bounded_dedup_stream(spark, tmp_path):
    inp = str(tmp_path / "in")
    _articles(spark, [(1, "https://a.com/1", "A", "x", "rss", "h"), (2, "https://a.com/1/", "A", "x", "rss", "h"),
                      (3, "https://a.com/9", "Z", "x", "rss", "h")]).write.parquet(inp)
    schema = spark.createDataFrame([], ARTICLE_SCHEMA).schema
    stream = incremental.with_fetched_at(spark.readStream.schema(schema).parquet(inp), "2026-05-10")
    q = (incremental.bounded_dedup(stream).writeStream.format("memory").queryName("bounded_dedup_out")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.sql("SELECT count(*) FROM bounded_dedup_out").first()[0] == 2


def test_replayed_batch_and_rerun_write_are_idempotent(spark, tmp_path):
    store, out = str(tmp_path / "seen"), str(tmp_path / "out")
    batch = _articles(spark, [(1, "https://a.com/1", "A", "x", "rss", "h"), (2, "https://a.com/2", "B", "x", "rss", "h")])
    incremental.ingest_new(batch, store, out, "2026-05-10", batch_id=7)
    incremental.ingest_new(batch, store, out, "2026-05-10", batch_id=7)  # replay after a failure
    assert spark.read.parquet(out).count() == 2 and spark.read.parquet(store).count() == 2
    st = C._ingest_stages(spark, SF001)
    notes_path = str(tmp_path / "notes")
    ingest.write(st, notes_path, str(tmp_path / "seen2"), "2026-05-10", run="r1")
    first = notes.published_notes(spark, notes_path).count()
    ingest.write(C._ingest_stages(spark, SF001), notes_path, str(tmp_path / "seen2"), "2026-05-10", run="r1")
    assert notes.published_notes(spark, notes_path).count() == first


def _scored(spark, rows):
    df = _whole_articles(spark, rows)
    replies = df.select("ord", F.lit('{"relevance_score": 5}').alias("raw"), F.lit(None).cast("string").alias("error"))
    return df, {"l1": replies, "l2": replies.withColumn("raw", F.lit("short")), "l3": replies}


def test_two_runs_of_a_day_keep_both_and_names_go_on(spark, tmp_path):
    path, seen = str(tmp_path / "notes"), str(tmp_path / "seen")
    for k in (1, 2):
        df, replies = _scored(spark, [(k, f"https://a.com/{k}", "Same title", "x", "rss", f"h{k}")])
        st = ingest.plan_ingest(df, replies, "2026-05-10", existing_notes=notes.stored_names(spark, path))
        assert ingest.write(st, path, seen, "2026-05-10")["written"] == 1
    names = sorted(r["filename"] for r in notes.published_notes(spark, path).collect())
    assert len(names) == 2 and names[0][:-3].rstrip("-1") == names[1][:-3].rstrip("-1") and sum("-1.md" in n for n in names) == 1


def test_an_unreadable_store_is_an_error(spark, tmp_path):
    store = tmp_path / "seen"
    store.mkdir()
    (store / "part-0.parquet").write_text("not parquet")
    df, replies = _scored(spark, [(1, "https://a.com/1", "T", "x", "rss", "h")])
    new = ingest.plan_ingest(df, replies, "2026-05-10").new
    with pytest.raises(Exception):
        dedup.append_seen(new, str(store), "2026-05-10")


def test_models_are_asked_once_per_kept_article(spark):
    asked = {k: spark.sparkContext.accumulator(0) for k in ("l1", "l2", "l3")}

    def model(level, reply):
        def fn(prompts):
            asked[level].add(len(prompts))
            return [reply(p) for p in prompts]
        return fn

    df = _whole_articles(spark, [(i, f"https://a.com/{i}", f"T{i % 4}", "text", "rss", f"h{i}") for i in range(20)])
    score = lambda p: '{"relevance_score": %d}' % {"T0": 2, "T1": 5, "T2": 8, "T3": 9}[p.split("Article: ")[1][:2]]
    st = ingest.plan_ingest(df, None, "2026-05-10", models={"l1": model("l1", score), "l2": model("l2", lambda p: "short"),
                                                            "l3": model("l3", lambda p: "{}")})
    assert st.rendered.count() == 15 and st.final.count() == 15
    assert {k: a.value for k, a in asked.items()} == {"l1": 20, "l2": 15, "l3": 10}
