"""Secret scans over an incremental ledger of content-addressed versions.

Every version of every path is addressed by the SHA-256 of its text. The ledger holds, per blob, the rule versions
that have been run on it and the spans they found. A scan looks up its blobs in the ledger, reads the text of one
representative of each blob that still has an unseen (blob, rule version) pair, runs just those rules, and joins the
findings back to all paths. Native expressions only.

Regular expressions give strings, not positions. A rule is therefore matched as ``\\G(gap)(match)``: each match starts
where the one before ended, the gap is as short as possible, so matches are the leftmost non-overlapping ones, and
running sums of the lengths give code-point positions. ``\\G`` also keeps the scan linear: without it the rest of a
text behind its last match would be tried again from each of its characters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notesmith.llm.common import documents, text_of
from notesmith.session import cut_lineage


@dataclass(frozen=True)
class Rule:
    """``pattern`` has exactly one group; a match is kept when that group has ``least`` characters or more. ``before``, if
    given, ends the gap in front of a match: it leads to the only place near it where a match can start."""

    kind: str
    version: int
    pattern: str
    least: int
    base: bool = False
    before: str = ""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: In the order that ranks kinds at the same start. The first three are the fixed base.
RULES = (
    Rule("assign", 1, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, True),
    Rule("access", 1, r"(AKIA[A-Z0-9]+)", 16, True),
    Rule("hex", 1, r"([0-9a-f]{32,})", 32, True),  # runs are maximal, so shorter ones can be left out of the pattern
    Rule("pem", 1, r"(-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----)", 1),
    # The first part reaches to the end of its run of characters, so where the first eyJ of a run fails, later ones fail too.
    Rule("jwt", 1, r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1,
         before=r"(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?(?=eyJ))"),
    Rule("hosted", 1, r"(gh[pousr]_[A-Za-z0-9]{36,})", 1),
)

LEDGER_SCANS = "blob binary, rules array<string>"
LEDGER_FINDINGS = "blob binary, rule string, start long, end long"


def empty_ledger(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Tables of a new ledger: rule versions run per blob, and the spans found."""
    return spark.createDataFrame([], LEDGER_SCANS), spark.createDataFrame([], LEDGER_FINDINGS)


def versions_of(docs: DataFrame, path: str = "doc_id") -> DataFrame:
    """path, blob of every row: the only table that later steps join on."""
    return cut_lineage(docs.select(F.col(f"`{path}`").alias("path"),
                                   F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("blob")))


def unseen(versions: DataFrame, scans: DataFrame, rules=RULES) -> DataFrame:
    """blob, path of one representative, todo: keys of the rules not yet run on the blob."""
    seen = scans.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("_seen"))
    blobs = versions.groupBy("blob").agg(F.min("path").alias("path"))
    todo = F.array_except(F.array(*[F.lit(r.key) for r in rules]), F.coalesce("_seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "path", todo.alias("todo")).where(F.size("todo") > 0)


def _hit(rule: str):
    return lambda z, i: F.struct(F.lit(rule).alias("rule"), i.alias("i"), z["0"].alias("gap"), z["1"].alias("n"),
                                 z["2"].alias("v"))


def spans_in(texts: DataFrame, rules=RULES) -> DataFrame:
    """blob, rule, start, end of every kept match; ``texts`` has blob, text, todo, and may repeat a blob."""
    hits = []
    for r in rules:
        at = r"\G((?s:.*?)" + r.before + ")(" + r.pattern + ")"
        part = [F.transform(F.regexp_extract_all("text", F.lit(at), F.lit(i)), lambda s: F.length(s)) for i in (1, 2, 3)]
        found = F.transform(F.arrays_zip(*part), _hit(r.key))
        hits.append(F.when(F.array_contains("todo", r.key) & F.col("text").rlike(r.before + r.pattern), found))
    none = F.array().cast("array<struct<rule:string,i:int,gap:int,n:int,v:int>>")
    rows = texts.select("blob", F.explode(F.concat(*[F.coalesce(h, none) for h in hits])).alias("h")).select("blob", "h.*")
    # Copies of a blob give the same matches under the same numbers; positions are running sums, so one of each is kept.
    rows = rows.dropDuplicates(["blob", "rule", "i"])
    upto = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum((F.col("gap") + F.col("n")).cast("long")).over(upto))
    least = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.least))])
    return rows.where(F.col("v") >= F.element_at(least, F.col("rule"))).select(
        "blob", "rule", (F.col("end") - F.col("n")).alias("start"), "end")


def scan(docs: DataFrame, ledger: tuple[DataFrame, DataFrame] | None = None, rules=RULES, path: str = "doc_id"
         ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(versions, new scans, new findings) of one incremental run; append the last two to the ledger.

    Null texts are the empty blob. Rows that repeat a path with another text are further versions of it; rows that
    repeat both add nothing. A null path is a path. An empty table gives empty tables.
    """
    spark = docs.sparkSession
    scans, _ = ledger or empty_ledger(spark)
    versions = versions_of(docs, path)
    todo = cut_lineage(unseen(versions, scans, rules))
    a = docs.select(F.col(f"`{path}`").alias("path"), text_of().alias("text")).alias("a")
    b = todo.withColumnRenamed("path", "first").alias("b")
    texts = a.join(b, F.col("a.path").eqNullSafe(F.col("b.first"))
                   & (F.unhex(F.sha2(F.col("a.text").cast("binary"), 256)) == F.col("b.blob")))
    # Rows that repeat path and text all meet the representative.
    found = spans_in(texts.select("blob", "text", "todo"), rules)
    return versions, todo.select("blob", F.col("todo").alias("rules")), cut_lineage(found)


def per_path(versions: DataFrame, findings: DataFrame, rules=RULES) -> DataFrame:
    """path, blob, one count per kind, base (kind:start:end of the base rules) and spans (of all rules) of every version."""
    rank = {r.key: i for i, r in enumerate(rules)}
    kinds = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.kind))])
    order = F.create_map(*[x for k, i in rank.items() for x in (F.lit(k), F.lit(i))])
    current = findings.where(F.col("rule").isin(*rank))
    one = F.struct("start", F.element_at(order, F.col("rule")).alias("rank"), "end",
                   F.concat_ws(":", F.element_at(kinds, F.col("rule")), "start", "end").alias("s"))
    n_base = sum(r.base for r in rules)
    per = current.groupBy("blob").agg(
        F.sort_array(F.collect_list(one)).alias("all"),
        *[F.count(F.when(F.col("rule") == r.key, 1)).alias(f"n_{r.kind}") for r in rules])
    base = F.filter("all", lambda x: x["rank"] < n_base)
    per = per.select("blob", *[f"n_{r.kind}" for r in rules],
                     F.array_join(F.transform(base, lambda x: x["s"]), ",").alias("base"),
                     F.array_join(F.transform("all", lambda x: x["s"]), ",").alias("spans"))
    out = versions.join(per, "blob", "left")
    return out.select("path", "blob", *[F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in rules],
                      F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans"))


class Ledger:
    """The two ledger tables in a shared folder; every run appends, nothing is rewritten."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def tables(self) -> tuple[DataFrame, DataFrame]:
        out = []
        for name, empty in zip(("scans", "findings"), empty_ledger(self.spark)):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
            out.append(self.spark.read.schema(empty.schema).parquet(f"{self.folder}/{name}") if there else empty)
        return out[0], out[1]

    def run(self, docs: DataFrame, rules=RULES, path: str = "doc_id") -> DataFrame:
        """Scan what is unseen, append it, and return ``per_path`` over all of ``docs``.

        Findings are written before the scans that vouch for them: after a lost run they are found again, and the
        distinct read keeps one of each."""
        versions, scans, found = scan(docs, self.tables(), rules, path)
        found.write.mode("append").parquet(f"{self.folder}/findings")
        scans.write.mode("append").parquet(f"{self.folder}/scans")
        return per_path(versions, self.tables()[1].distinct(), rules)


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    versions, _, found = scan(documents(spark, sf_dir))
    t = per_path(versions, found)
    return t.select(F.col("path").alias("doc_id"), "n_assign", "n_access", "n_hex",
                    F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def _oracle() -> str:
    word = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                    for w in ("password", "passwd", "secret", "token", "api_?key"))
    parts = []
    for i, r in enumerate(RULES):
        p = r.pattern.replace("(?i:password|passwd|secret|token|api_?key)", f"(?:{word})").replace("'", "''")
        at = f"'(?s)(.*?)({p})'"
        parts.append(f"SELECT doc_id, {i} AS rank, '{r.kind}' AS kind, {r.least} AS least, {str(r.base).lower()} AS base, "
                     f"unnest(regexp_extract_all(text, {at}, 1)) AS g, unnest(regexp_extract_all(text, {at}, 2)) AS m, "
                     f"unnest(regexp_extract_all(text, {at}, 3)) AS v, "
                     f"unnest(generate_series(1, len(regexp_extract_all(text, {at}, 1)))) AS i FROM t")
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
h AS ({" UNION ALL ".join(parts)}),
p AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS e FROM h),
s AS (SELECT doc_id, rank, kind, base, CAST(e - length(m) AS BIGINT) AS b, CAST(e AS BIGINT) AS e,
             kind || ':' || CAST(e - length(m) AS BIGINT) || ':' || CAST(e AS BIGINT) AS s FROM p WHERE length(v) >= least),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex, string_agg(s, ',' ORDER BY b, rank) FILTER (base) AS base,
             string_agg(s, ',' ORDER BY b, rank) AS spans FROM s GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN a USING (doc_id)
"""


ORACLE = _oracle()
