"""Strict parsing of stored model replies with defined fallbacks (O-N1..N6, O-P4).

Replies are parsed with ``try_parse_json`` into a variant, never ``from_json``:
``from_json`` accepts single quotes and trailing text and cannot tell the number
7 from the string "7" or from a missing key, and each of those has its own
fallback. Every function returns native expressions (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notesmith.functions.common import WS, col, py_strip

# Fallback texts and the labels of the deep-analysis blocks.
L2_EMPTY = "[Summary generation returned empty]"
L2_FAILED_PREFIX = "[Summary generation failed: "
TLDR_PREFIX = "**TL;DR:** "
DEEP_INSIGHT = "**核心洞见:** "
DEEP_TYPE = "**文章类型:** "
DEEP_ASSUMPTIONS = "**前提假设:**\n"
DEEP_POSITION = "**作者立场:** "
DEEP_CONCEPTS = "**核心概念:**\n"
L1_ERROR_SCORE = 5
#: Scores beyond an int are held at its ends (they rank and tier as the largest and smallest do).
MAX_SCORE = (1 << 31) - 1
THINK_BLOCK = f"(?s)<think\\b[^>]*>.*?</think{WS}*>"


def _first_object(s: Column, fallback_pattern: str) -> Column:
    """The text itself when it is one whole JSON object (starts '{', ends '}', parses — the end
    check rejects the trailing text the variant parser would accept); else the first match of
    ``fallback_pattern``; else null. ``s`` is referenced twice only, to keep plans small."""
    whole = F.regexp_extract(s, r"(?s)^\{.*\}$", 0)
    return F.coalesce(F.when(F.try_parse_json(whole).isNotNull(), whole),
                      F.nullif(F.regexp_extract(s, fallback_pattern, 0), F.lit("")))


def extract_flat_json(raw) -> Column:
    """O-N1: whole text if it starts '{' and parses; else first '{...}' without nested braces; else null."""
    return _first_object(py_strip(col(raw)), r"(?s)\{[^{}]*\}")


def strip_think(raw) -> Column:
    return py_strip(F.regexp_replace(col(raw), THINK_BLOCK, ""))


def extract_greedy_json(raw) -> Column:
    """O-N2: drop <think>..</think> blocks; whole text if it parses; else outermost '{.*}'; else null."""
    return _first_object(strip_think(raw), r"(?s)\{.*\}")


def _field(v: Column, name: str) -> Column:
    return F.variant_get(v, f"$.{name}", "variant")


def score_number(sv) -> Column:
    """int() of the score field, or null where int() would fail (null, array, object, non-integer string)."""
    sv = col(sv)
    t = F.schema_of_variant(sv)
    as_str = F.try_variant_get(sv, "$", "string")
    from_str = F.when(as_str.rlike(f"^{WS}*[+-]?[0-9]+{WS}*$"), py_strip(as_str).try_cast("bigint"))
    return (F.when(t == "STRING", from_str)
            .when((t == "VOID") | t.startswith("ARRAY") | t.startswith("OBJECT"), F.lit(None))
            .otherwise(F.try_variant_get(sv, "$", "bigint")))


def _has_reply(raw, error) -> Column:
    return col(error).isNull() & (F.coalesce(F.length(col(raw)), F.lit(0)) > 0)


def score_from(raw, error, js, v, sv, num) -> Column:
    """O-N3 score with the fallbacks: error -> 5; no reply / no object -> 0; object that does not
    parse -> 5; key missing -> 0; number -> int() (truncates); integer string -> its value;
    null or any other string -> 5."""
    return (F.when(col(error).isNotNull(), F.lit(L1_ERROR_SCORE))
            .when(F.coalesce(F.length(col(raw)), F.lit(0)) == 0, F.lit(0))
            .when(col(js).isNull(), F.lit(0))
            .when(col(v).isNull(), F.lit(L1_ERROR_SCORE))
            .when(col(sv).isNull(), F.lit(0))
            .otherwise(F.greatest(F.lit(-MAX_SCORE), F.least(F.lit(MAX_SCORE), F.coalesce(col(num), F.lit(L1_ERROR_SCORE)))))
            ).cast("int")


def l1_ok_from(raw, error, js, v, sv, num) -> Column:
    """True when the reply's tags and language are taken over (score converted or absent)."""
    return _has_reply(raw, error) & col(js).isNotNull() & col(v).isNotNull() & (col(sv).isNull() | col(num).isNotNull())


def relevance_score(raw, error) -> Column:
    """Single-expression form of ``score_from`` (re-derives the intermediates)."""
    js = extract_flat_json(raw)
    v = F.try_parse_json(js)
    sv = _field(v, "relevance_score")
    return score_from(raw, error, js, v, sv, score_number(sv))


def reply_tags(v) -> Column:
    return F.coalesce(F.try_variant_get(col(v), "$.tags", "array<string>"), F.array().cast("array<string>"))


def reply_language(v) -> Column:
    return F.coalesce(F.try_variant_get(col(v), "$.language", "string"), F.lit(""))


def assign_tier(score, discard_max: int = 3, compressed_max: int = 6) -> Column:
    """O-P4: <= discard_max discard; <= compressed_max compressed; else detailed ('' when not scored > 0)."""
    s = col(score)
    return (F.when(s <= 0, F.lit(""))
            .when(s <= discard_max, F.lit("discard"))
            .when(s <= compressed_max, F.lit("compressed"))
            .otherwise(F.lit("detailed")))


def _empty_arr() -> Column:
    return F.array().cast("array<string>")


def summary_fields(raw, error, js=None, v=None) -> Column:
    """O-N4: struct(summary, key_points, related_topics) with the L2 fallbacks.

    ``js``/``v`` may name precomputed columns (object text, parsed variant)."""
    r = col(raw)
    js = extract_greedy_json(r) if js is None else col(js)
    v = F.try_parse_json(js) if v is None else col(v)
    summ = F.coalesce(F.try_variant_get(v, "$.summary", "string"), F.lit(""))
    tldr = F.coalesce(F.try_variant_get(v, "$.tldr", "string"), F.lit(""))
    summ = F.when(F.length(tldr) > 0, F.concat(F.lit(TLDR_PREFIX), tldr, F.lit("\n\n"), summ)).otherwise(summ)
    kp = F.coalesce(F.try_variant_get(v, "$.key_points", "array<string>"), _empty_arr())
    rt = F.coalesce(F.try_variant_get(v, "$.related_topics", "array<string>"), _empty_arr())
    ok = F.struct(summ.alias("summary"), kp.alias("key_points"), rt.alias("related_topics"))

    def only(text: Column) -> Column:
        return F.struct(text.alias("summary"), _empty_arr().alias("key_points"), _empty_arr().alias("related_topics"))

    failed = F.concat(F.lit(L2_FAILED_PREFIX), F.substring(col(error), 1, 100), F.lit("]"))
    return (F.when(col(error).isNotNull(), only(failed))
            .when(F.coalesce(F.length(r), F.lit(0)) == 0, only(F.lit(L2_EMPTY)))
            .when(js.isNull() | v.isNull(), only(F.substring(r, 1, 500)))
            .otherwise(ok))


CONCEPTS_TYPE = "array<struct<name:string,definition:string>>"


def analysis_fields(raw, error, js=None, v=None) -> Column:
    """O-N5 + O-N6: struct(ok, concepts, structure_type, key_insight, content_deep).

    ``ok`` is false for an error, an empty reply, no object, an object that does not parse,
    or a concept without a name; the caller then keeps the row unchanged (O-J7).
    """
    r = col(raw)
    js = extract_greedy_json(r) if js is None else col(js)
    v = F.try_parse_json(js) if v is None else col(v)
    cv = _field(v, "concepts")
    concepts_absent = cv.isNull() | F.is_variant_null(cv)
    concepts = F.try_variant_get(cv, "$", CONCEPTS_TYPE)
    concepts_ok = concepts_absent | (concepts.isNotNull() & F.forall(concepts, lambda c: c["name"].isNotNull()))
    concepts = F.when(concepts_absent, F.array().cast(CONCEPTS_TYPE)).otherwise(concepts)
    st = F.coalesce(F.try_variant_get(v, "$.structure_type", "string"), F.lit(""))
    ki = F.coalesce(F.try_variant_get(v, "$.key_insight", "string"), F.lit(""))
    assumptions = F.coalesce(F.try_variant_get(v, "$.assumptions", "array<string>"), _empty_arr())
    position = F.coalesce(F.try_variant_get(v, "$.position", "string"), F.lit(""))
    deep = F.concat_ws(
        "\n\n",
        F.when(F.length(ki) > 0, F.concat(F.lit(DEEP_INSIGHT), ki)),
        F.when(F.length(st) > 0, F.concat(F.lit(DEEP_TYPE), st)),
        F.when(F.size(assumptions) > 0, F.concat(F.lit(DEEP_ASSUMPTIONS),
                                                 F.array_join(F.transform(assumptions, lambda a: F.concat(F.lit("- "), a)), "\n"))),
        F.when(F.length(position) > 0, F.concat(F.lit(DEEP_POSITION), position)),
        F.when(F.size(concepts) > 0, F.concat(F.lit(DEEP_CONCEPTS), F.array_join(F.transform(
            concepts, lambda c: F.concat(F.lit("- **"), c["name"], F.lit("**: "), F.coalesce(c["definition"], F.lit("")))),
            "\n"))),
    )
    ok = (col(error).isNull() & (F.coalesce(F.length(r), F.lit(0)) > 0) & js.isNotNull() & v.isNotNull()
          & concepts_ok)
    return F.struct(ok.alias("ok"), concepts.alias("concepts"), st.alias("structure_type"), ki.alias("key_insight"),
                    deep.alias("content_deep"))
