"""Q1 ingest: raw articles -> new articles -> three model levels -> rendered notes (+ seen-store).

The stages are lazy DataFrames; nothing is collected. ``write`` runs one job that
writes the notes and then appends the new URLs to the seen-store (after the notes and errors,
so a failed write never marks URLs as seen), with stage counts gathered by
``DataFrame.observe`` on the way instead of extra passes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from notesmith.functions.urls import url_hash
from notesmith.operators import dedup, inference, levels, notes
from notesmith.session import cut_lineage


@dataclass
class IngestStages:
    fetched: DataFrame
    limited: DataFrame
    new: DataFrame
    l1: DataFrame | None = None
    l1_passed: DataFrame | None = None
    l2: DataFrame | None = None
    final: DataFrame | None = None
    rendered: DataFrame | None = None
    errors: DataFrame | None = None  # (stage, key, error): what failed, one row per article and level
    counters: list | None = None  # O-A7 observations, filled when the plan runs


def plan_ingest(articles: DataFrame, replies: dict[str, DataFrame] | None, as_of: str, seen: DataFrame | str | None = None,
                key: str = "ord", limit: int | None = None, dry_run: bool = False,
                existing_notes: DataFrame | Callable[[DataFrame], DataFrame] | None = None, l3_enabled: bool = True, l3_min_score: int = 7,
                discard_max: int = 3, compressed_max: int = 6, models: dict[str, Callable] | None = None,
                max_tokens: int = 4000, ledger: str | None = None, model_names: dict[str, str] | None = None) -> IngestStages:
    """Build the stage DataFrames. ``replies`` maps 'l1'/'l2'/'l3' to reply tables (key, raw, error), e.g. the output of
    ``notesmith.operators.inference.call_model``. With ``models`` (a callable per level) instead, each level is
    asked in turn, once per article, and only for the articles that its filter has kept; these calls run at once. With a
    ``ledger`` (path) replies are kept over runs, under the names in ``model_names``. ``seen`` may be the path of a seen-store."""
    limited = articles.orderBy(key).limit(limit) if limit else articles  # O-O1, before dedup
    hashed = limited.withColumn("url_hash", url_hash("url"))
    obs_in, obs_new, obs_l1 = Observation("dedup_in"), Observation("dedup_new"), Observation("l1")
    hashed = hashed.observe(obs_in, F.count(F.lit(1)).alias("in"))  # O-A7 counters ride along the job
    new = dedup.first_per_key(hashed, "url_hash", key)  # O-W1
    if seen is not None:  # O-J1
        new = dedup.unseen(new, seen) if isinstance(seen, str) else dedup.drop_seen(new, seen)
    new = new.observe(obs_new, F.count(F.lit(1)).alias("new"))
    st = IngestStages(fetched=articles, limited=limited, new=new, counters=[obs_in, obs_new])
    if dry_run or (replies is None and models is None):
        return st
    st.new = new = cut_lineage(new)  # read by every level, by the counts and by the seen-store

    def replied(level: str, rows: DataFrame, prompt) -> DataFrame:
        if models is None:
            return replies[level]
        asked = rows.select(key, prompt.alias("prompt"))
        if ledger is not None:
            return inference.call_with_ledger(asked, models[level], ledger, (model_names or {}).get(level, level), key, level=level)
        return inference.call_model(asked, models[level], key, level=level)

    answers = {"l1": replied("l1", new, inference.l1_prompt())}
    l1 = levels.assign_tiers(levels.apply_l1(new, answers["l1"], key), discard_max, compressed_max)
    passed = F.col("relevance_score") > max(0, discard_max)
    l1 = l1.observe(obs_l1, F.count(F.lit(1)).alias("l1_in"), F.sum(passed.cast("long")).alias("l1_passed"),
                    F.sum((~passed).cast("long")).alias("l1_discarded"))
    st.counters.append(obs_l1)
    st.l1_passed = levels.tier_filter(l1, discard_max)
    answers["l2"] = replied("l2", st.l1_passed, inference.l2_prompt(max_tokens))
    st.l2 = levels.apply_l2(st.l1_passed, answers["l2"], key)
    deep = levels.deep_gate(st.l2, l3_min_score, l3_enabled)
    answers["l3"] = replied("l3", deep, inference.l3_prompt(max_tokens))
    st.final = levels.overlay_l3(st.l2, answers["l3"], key, l3_min_score, l3_enabled)
    asked = {"l1": F.lit(True), "l2": passed, "l3": passed & levels.deep_condition(l3_min_score, l3_enabled, compressed_max)}
    st.l1 = l1.withColumn("_passed", passed).join(_failed(answers, key), key, "left").withColumn("_errors", F.filter(F.array(*[
        F.when(asked[lv], F.struct(F.lit(lv).alias("stage"), F.col(f"_{lv}").alias("error"))) for lv in answers]), lambda e: e["error"].isNotNull()))
    st.errors = st.l1.select(key, F.explode("_errors").alias("e")).select("e.stage", key, "e.error")
    st.rendered = notes.render_notes(st.final, as_of, existing_notes, key)
    return st


def _failed(answers: dict[str, DataFrame], key: str) -> DataFrame:
    """key, _l1, _l2, _l3: the errors of an article's replies; only articles with an error have a row."""
    rows = None
    for level, table in answers.items():
        own = table.where("error is not null").select(key, F.lit(level).alias("level"), "error")
        rows = own if rows is None else rows.unionByName(own)
    return rows.groupBy(key).agg(*[F.min(F.when(F.col("level") == level, F.col("error"))).alias(f"_{level}") for level in answers])


def funnel_counts(st: IngestStages) -> DataFrame:
    """O-A2 as rows (stage, n): one aggregate over the fetched and one over the scored articles (no cross join)."""
    fetched = st.fetched.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit("fetched").alias("stage"), "n")
    if st.l1 is None:
        new = st.new.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit("new").alias("stage"), "n")
        return fetched.unionByName(new)
    # The second and third level and the rendering keep every article that passed the first, so one pass counts them all.
    passed = F.sum(F.col("_passed").cast("long")).cast("bigint")
    one = st.l1.agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.coalesce(passed, F.lit(0)).cast("bigint").alias("p"),
                    F.coalesce(F.sum(F.size("_errors")), F.lit(0)).cast("bigint").alias("e"))
    stages = [("new", "n"), ("l1_passed", "p"), ("l2_summarized", "p"), ("written", "p"), ("errors", "e")]
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("stage"), F.col(c).alias("n")) for k, c in stages])).alias("r")
    return fetched.unionByName(one.select(rows).select("r.*"))


def write(st: IngestStages, notes_path: str, seen_path: str, as_of: str, run: str | None = None, names_path: str | None = None,
          errors_path: str | None = None) -> dict:
    """Write notes (O-K1) and what failed, then append the new URLs to the seen-store (O-K2); returns run stats, with the run's name.

    Errors go to ``errors_path`` (beside the notes, ``<notes_path>-errors``, unless given), one part per run. Plan with
    ``existing_notes=notes.registered_names(spark, names_path, run)`` and pass ``names_path`` so that names go on from those of
    earlier runs (``notes.stored_names(spark, notes_path, run)`` reads them from the notes instead). To repeat a run that failed between the
    writes, pass its name."""
    run = run or f"{as_of}-{uuid.uuid4().hex[:12]}"
    obs, failed = Observation("ingest"), Observation("errors")
    rendered = st.rendered.observe(obs, F.count(F.lit(1)).alias("written"))
    notes.write_notes(rendered, notes_path, run)
    stats = {"written": int(obs.get.get("written", 0)), "run": run}
    (st.errors.observe(failed, F.count(F.lit(1)).alias("errors")).withColumn("run", F.lit(run)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(errors_path or f"{notes_path.rstrip('/')}-errors"))
    stats["errors"] = int(failed.get.get("errors", 0))
    for o in st.counters or []:
        stats.update({k: int(v or 0) for k, v in o.get.items()})
    stats["duplicates"] = stats.get("in", 0) - stats.get("new", 0)
    if names_path is not None:
        notes.register_names(notes.written_names(st.rendered.sparkSession, notes_path, run), names_path, run)
    dedup.append_seen(st.new, seen_path, as_of)
    return stats
