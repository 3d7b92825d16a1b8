"""Model and embedding calls in Arrow batches (O-M1, O-M2, O-M3, O-M4).

The caller supplies the model: ``fn(prompts: list[str]) -> list[str]`` for replies and
``fn(texts: list[str]) -> list[list[float]]`` for embeddings. Calls run inside
``mapInPandas`` on the executors; prompts are built as native columns before the
boundary and replies are parsed as native columns after it (notesmith.functions.replies),
so only the prompt text crosses into Python. Callables should be idempotent: a lost
executor re-runs its task.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notesmith.functions.common import col
from notesmith.functions.text import truncate_with_marker
from notesmith.operators.key_store import reply_store
from notesmith.session import cut_lineage, ship_package

# Seconds to wait before the second and the third attempt; texts per embedding request.
WAITS = (2.0, 4.0)
EMBED_BATCH = 16
#: Prompts per model request, and prompts whose replies are stored together when a ledger is kept.
REQUEST, LEDGER_BATCH = 32, 20_000


def with_retry(call: Callable[[], object], waits=WAITS, sleep=time.sleep):
    """The result of ``call``, tried once more after each of ``waits``; the failure that follows the last one is raised."""
    pauses = iter(waits)
    while True:
        try:
            return call()
        except Exception:  # noqa: BLE001 - any failure of a remote call may pass
            if (pause := next(pauses, None)) is None:
                raise
        sleep(pause)


# ---- prompts (O-M2): native columns ---------------------------------------

#: Prompt per level; the detailed tier has its own second-level prompt. Pass others as ``template``.
PROMPTS = {
    "l1": "Judge how useful this article is to a reader who keeps notes on technology. Answer with one JSON object: "
          "\"relevance_score\" (0 to 10), \"tags\" (up to five short words), \"language\" (two letters).\n"
          "Article: {title}\nPublished by: {source}\nText:\n{content}\n",
    "l2": "Sum this article up in two or three sentences. Answer with the summary alone.\n"
          "Article: {title}\nAbout: {tags}\nText:\n{content}\n",
    "l2_detailed": "Sum this article up section by section, with its main points as a list. Answer with the summary alone.\n"
                   "Article: {title}\nAbout: {tags}\nText:\n{content}\n",
    "l3": "Analyse this article: its central insight, its kind, its assumptions, its author's position and its key concepts. "
          "Answer with one JSON object.\nArticle: {title}\nAbout: {tags}\nSummary: {summary}\nText:\n{content}\n",
}


def filled(template: str, **fields: Column) -> Column:
    """The template with its {fields} replaced by columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[fields[x] if k % 2 else F.lit(x) for k, x in enumerate(parts) if k % 2 or x])


def l1_prompt(title="title", source_name="source_name", content="content_raw", preview: int = 2000,
              template: str = PROMPTS["l1"]) -> Column:
    c = F.coalesce(col(content), F.lit(""))
    body = F.when(F.length(c) > 0, F.substring(c, 1, preview)).otherwise(col(title))
    return filled(template, title=col(title), source=F.coalesce(col(source_name), F.lit("")), content=body)


def _tag_text(tags) -> Column:
    t = F.coalesce(col(tags), F.array().cast("array<string>"))
    return F.when(F.size(t) > 0, F.array_join(t, ", ")).otherwise(F.lit("none"))


def l2_prompt(max_tokens: int, title="title", tags="tags", content="content_raw", tier="content_tier",
              template: str = PROMPTS["l2"], detailed: str = PROMPTS["l2_detailed"]) -> Column:
    """The detailed tier has its own prompt and twice ``max_tokens`` characters, other tiers three times."""
    c = F.coalesce(col(content), F.lit(""))
    given = {"title": col(title), "tags": _tag_text(tags)}
    return F.when(col(tier) == "detailed", filled(detailed, content=truncate_with_marker(c, max_tokens * 2), **given)).otherwise(
        filled(template, content=truncate_with_marker(c, max_tokens * 3), **given))


def l3_prompt(max_tokens: int, title="title", tags="tags", summary="content_summary", content="content_raw",
              template: str = PROMPTS["l3"]) -> Column:
    c = F.coalesce(col(content), F.lit(""))
    s = F.coalesce(col(summary), F.lit(""))
    body = truncate_with_marker(c, max_tokens * 2, "\n[...truncated for analysis]")
    return filled(template, title=col(title), tags=_tag_text(tags), content=body,
                  summary=F.when(F.length(s) > 0, F.substring(s, 1, 500)).otherwise(F.lit("N/A")))


# ---- replies (O-M1) ------------------------------------------------------------

def call_model(df: DataFrame, fn: Callable[[list[str]], list[str]], key: str = "ord", prompt: str = "prompt",
               level: str = "l1", request: int = REQUEST, waits=WAITS, sleep=time.sleep) -> DataFrame:
    """(key, level, raw, error) per row, as a written table: reading it again calls nothing.

    Requests hold at most ``request`` prompts. The prompts of a request that keeps failing are asked one by one, so one
    bad article gets its own error (and its level's fallback) without failing its neighbours."""
    key_type = df.schema[key].dataType.simpleString()
    ship_package(df.sparkSession)

    def asked(prompts: list[str]) -> list[str | None]:
        out = with_retry(lambda: list(fn(prompts)), waits, sleep)
        if len(out) != len(prompts):
            raise ValueError(f"model returned {len(out)} replies for {len(prompts)} prompts")
        return [None if r is None else str(r) for r in out]

    def one(prompt_text: str) -> tuple[str | None, str | None]:
        try:
            return asked([prompt_text])[0], None
        except Exception as e:  # noqa: BLE001
            return None, str(e) or e.__class__.__name__

    def replies(prompts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            return [(r, None) for r in asked(prompts)]
        except Exception:  # noqa: BLE001
            return [one(p) for p in prompts]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            prompts = pdf[prompt].fillna("").tolist()
            got = [r for at in range(0, len(prompts), request) for r in replies(prompts[at:at + request])]
            yield pd.DataFrame({key: pdf[key], "level": level, "raw": [r for r, _ in got], "error": [e for _, e in got]})

    return cut_lineage(df.select(key, prompt).mapInPandas(run, f"{key} {key_type}, level string, raw string, error string"))


def call_with_ledger(df: DataFrame, fn: Callable[[list[str]], list[str]], ledger: str, model: str, key: str = "ord", prompt: str = "prompt",
                     level: str = "l1", batch: int = LEDGER_BATCH, **how) -> DataFrame:
    """``call_model`` that asks each prompt once for all runs: (key, level, raw, error) per row, as a written table.

    Replies are stored under the SHA-256 of model, level and prompt. Equal prompts of a run are asked once. What the ledger lacks is
    asked in batches of about ``batch`` prompts, each stored before the next is asked, so a job that dies repeats at most one batch.
    Errors are not stored: the next run asks again."""
    spark = df.sparkSession
    store = reply_store(spark, ledger)
    digest = F.sha2(F.concat_ws("\x00", F.lit(model), F.lit(level), F.coalesce(F.col(prompt), F.lit(""))), 256)
    rows = cut_lineage(df.select(key, F.col(prompt).alias("prompt"), digest.alias("digest")))
    each = rows.groupBy("digest").agg(F.min("prompt").alias("prompt"))
    known = cut_lineage(store.known(each).select("digest", "raw", F.lit(None).cast("string").alias("error")).dropDuplicates(["digest"]))
    lacking = cut_lineage(each.join(known, "digest", "left_anti"))
    parts = max(1, -(-lacking.count() // batch))
    replies = known
    for part in range(parts):
        some = lacking.where(F.pmod(F.xxhash64("digest"), F.lit(parts)) == part)
        got = call_model(some, fn, "digest", "prompt", level, **how)
        store.append(got.where("error is null").select("digest", F.lit(model).alias("model"), "level", "raw"))
        replies = replies.unionByName(got.select("digest", "raw", "error"))
    return cut_lineage(rows.select(key, "digest").join(replies, "digest", "left").select(key, F.lit(level).alias("level"), "raw", "error"))


# ---- embeddings (O-M3, O-M4) ---------------------------------------------------

def embed(df: DataFrame, fn: Callable[[list[str]], list[list[float]]], key: str = "ord", text: str = "text",
          batch_size: int = EMBED_BATCH, waits=(), sleep=time.sleep) -> DataFrame:
    """(key, embedding), as a written table, with requests of ``batch_size`` texts whatever the Arrow batch size; a
    failing request gives empty vectors for its texts (the run then falls back to tag topics, O-M4)."""
    key_type = df.schema[key].dataType.simpleString()
    ship_package(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[text].fillna("").tolist()
            vecs: list[list[float]] = []
            for i in range(0, len(texts), batch_size):
                chunk = texts[i:i + batch_size]
                try:
                    got = with_retry(lambda c=chunk: list(fn(c)), waits, sleep)
                    if len(got) != len(chunk):
                        raise ValueError("embedding count mismatch")
                    vecs.extend([list(map(float, v)) for v in got])
                except Exception:  # noqa: BLE001
                    vecs.extend([[] for _ in chunk])
            yield pd.DataFrame({key: pdf[key], "embedding": vecs})

    return cut_lineage(df.select(key, text).mapInPandas(run, f"{key} {key_type}, embedding array<float>"))


def vectors_usable(emb: DataFrame) -> bool:
    """O-M4: true when there is at least one vector and none is empty (one aggregate)."""
    r = emb.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.size("embedding") > 0).alias("ok")).first()
    return bool(r["n"]) and bool(r["ok"])
