"""Quality rules: a threshold table compiled into one projection of native expressions.

``measures`` names the columns a rule can test, ``RULES`` is the table of thresholds, ``compile_rules`` turns the
table into one boolean expression per rule plus the verdict. Nothing is shuffled and no user function runs.

Repeated 3-word windows are counted inside the row: the windows are sorted with their positions, equal neighbours
mark their positions, and the words that marked windows cover are summed as the union of intervals [i, i + 3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notesmith.llm.common import documents, packed, text_of, words_of

SYMBOLS = "[#*$%&|<>]"
WINDOW = 3

#: Stop words of the four languages (fixed values).
STOP_WORDS = ("the a an of to and in is was that for on with as at by it he be are this from or have not "
              "der die das und ist in den von zu mit auf für ein eine einer nicht im des dem sich "
              "le la les de des et est un une en que qui dans pour pas sur au du par il elle "
              "el la los las de y en que un una es por con para se del al lo no su").split()

#: name, measure, numerator scale, comparison, limit: a row fails the rule when ``scale * measure  <op>  limit * per``.
RULES = (
    # name, scale, measure, op, limit, per
    ("too_few_words", 1, "n_words", "<", 50, "one"),
    ("repeated_windows", 100, "n_repeat_words", ">", 50, "n_words"),
    ("symbol_ratio", 100, "n_symbols", ">", 30, "n_words"),
    ("long_words", 1, "word_chars", ">", 14, "n_words"),
    ("short_words", 1, "word_chars", "<", 2, "n_words"),
    ("repeated_lines", 100, "n_dup_lines", ">", 40, "n_lines"),
    ("few_stop_words", 1000, "n_stop_words", "<", 20, "n_words"),
)
#: Rules of the fixed base; the others are the verdict.
BASE = ("too_few_words", "repeated_windows")




def measured(docs: DataFrame, prefix: str = "_q_") -> DataFrame:
    """The input with the measures as columns named ``prefix`` + measure."""
    p = prefix
    t = docs.withColumn(p + "text", text_of())
    t = t.withColumn(p + "words", words_of(F.col(p + "text")))
    t = t.withColumn(p + "lines", F.filter(F.split(F.col(p + "text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size(p + "words")
    w = F.col(p + "words")
    windows = F.when(n > WINDOW, F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.struct(
        F.concat_ws(" ", F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)).alias("k"), i.alias("i"))))
    t = t.withColumn(p + "sorted", F.sort_array(windows))
    s = F.col(p + "sorted")
    m = F.size(s)
    # Positions whose window equals its neighbour before or after in the sorted order, ascending.
    hit = F.filter(s, lambda x, j: (F.when(j > 0, F.get(s, j - 1)["k"] == x["k"]).otherwise(F.lit(False)))
                   | (F.when(j + 1 < m, F.get(s, j + 1)["k"] == x["k"]).otherwise(F.lit(False))))
    t = t.withColumn(p + "at", F.sort_array(F.transform(hit, lambda x: x["i"])))
    at = F.col(p + "at")
    gaps = F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW))))
    measures = {
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join(p + "words", "")).cast("long"),
        "n_symbols": F.regexp_count(F.col(p + "text"), F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size(p + "lines").cast("long"),
        "n_dup_lines": (F.size(p + "lines") - F.size(F.array_distinct(p + "lines"))).cast("long"),
        "n_repeat_words": F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"),
        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(*dict.fromkeys(STOP_WORDS)))).cast("long"),
    }
    t = t.withColumns({p + k: v for k, v in measures.items()})
    return t.drop(p + "text", p + "words", p + "lines", p + "sorted", p + "at")


def compile_rules(rules=RULES, prefix: str = "_q_") -> dict[str, Column]:
    """Per rule an expression that is true where a row fails it."""
    out = {}
    for name, scale, measure, op, limit, per in rules:
        left = F.lit(scale) * F.col(prefix + measure)
        right = F.lit(limit) * (F.lit(1) if per == "one" else F.col(prefix + per))
        out[name] = left > right if op == ">" else left < right
    return out


def quality_rules(docs: DataFrame, rules=RULES, base=BASE) -> DataFrame:
    """One row per input row: doc_id, the measures, base_failed, failed (names of all failed rules) and kept.

    Null and empty texts have no words and fail the base. Repeated rows are judged each by itself. Texts of any length
    are read whole. Further columns, also with clashing names, are not read. An empty table gives no rows.
    """
    t = measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")))
    fails = compile_rules(rules)
    failed = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in fails.items()]), lambda x: x.isNotNull())
    t = t.withColumn("failed", failed)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")
    return t.select("doc_id", *[F.col(f"_q_{k}").alias(k) for k in names],
                    F.arrays_overlap("failed", F.array(*map(F.lit, base))).alias("base_failed"),
                    (F.size("failed") == 0).alias("kept"), "failed")


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed", ",").alias("failed"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass every rule, with all columns."""
    t = measured(docs.select(packed(docs), "text"))
    bad = F.lit(False)
    for c in compile_rules().values():
        bad = bad | c
    # A plain filter would be pushed below the measures and take a copy of each measure's whole expression with it.
    kept = F.explode(F.when(~bad, F.array(F.lit(1)))).alias("kept")
    return t.select("doc", kept).select("doc.*")


def _oracle() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS k
      FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM t)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM w) WHERE c > 1),
v AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM r, (VALUES (0), (1), (2)) AS x(o) GROUP BY doc_id),
l AS (SELECT doc_id, len(x) AS n, len(x) - len(list_distinct(x)) AS d
      FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS x FROM t)),
m AS (SELECT t.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, l.d AS n_dup_lines, l.n AS n_lines,
             coalesce(v.n, 0) AS n_repeat_words, len(list_filter(words, lambda s: lower(s) IN ({stop}))) AS n_stop_words
      FROM t JOIN l USING (doc_id) LEFT JOIN v USING (doc_id)),
f AS (SELECT *, concat_ws(',', CASE WHEN n_words < 50 THEN 'too_few_words' END,
             CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeated_windows' END,
             CASE WHEN 100 * n_symbols > 30 * n_words THEN 'symbol_ratio' END,
             CASE WHEN word_chars > 14 * n_words THEN 'long_words' END,
             CASE WHEN word_chars < 2 * n_words THEN 'short_words' END,
             CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 'repeated_lines' END,
             CASE WHEN 1000 * n_stop_words < 20 * n_words THEN 'few_stop_words' END) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, failed = '' AS kept, failed FROM f
"""


ORACLE = _oracle()
