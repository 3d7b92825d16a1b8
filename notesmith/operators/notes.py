"""Note rendering and the note sink (O-G1, O-G2, O-P12, O-F15, O-W4, O-K1, O-K5).

Rendering is column expressions over the article table. File-name collisions
(O-W4) are resolved without pairing rows: the k-th free name of a name family
is the position of the new note in one ordering of existing slots and new
notes (see ``resolve_collisions``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notesmith.functions.common import col
from notesmith.functions.dates import utc_date_label
from notesmith.functions.text import note_filename, word_count
from notesmith.operators.key_store import name_store
from notesmith.operators.publication import publish, published
from notesmith.operators.ranking import balanced_row_number
from notesmith.session import cut_lineage

# Vault folder per source, section headings of a note.
SOURCE_DIRS = {"rss": "2-Articles", "web_url": "2-Articles", "feishu": "2-Articles", "github": "3-GitHub",
               "email": "4-Newsletters", "manual": "0-Inbox"}
DEFAULT_DIR = "0-Inbox"
RAW_HEADING = "## 原文内容\n"
RAW_WORDS = "*原文: "


def yaml_quoted(c) -> Column:
    """A YAML double-quoted scalar (backslash, quote and control characters escaped)."""
    e = F.replace(col(c), F.lit("\\"), F.lit("\\\\"))
    for a, b in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        e = F.replace(e, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), e, F.lit('"'))


def frontmatter(as_of: str) -> Column:
    """O-G1: fixed key order, optional keys omitted, strings always double-quoted."""
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>"))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("title: "), yaml_quoted("title")),
        F.concat(F.lit("source: "), yaml_quoted("url")),
        F.concat(F.lit("source_name: "), yaml_quoted(F.coalesce(F.col("source_name"), F.lit("")))),
        F.when(F.length("author") > 0, F.concat(F.lit("author: "), yaml_quoted("author"))),
        F.concat(F.lit("date_processed: "), yaml_quoted(F.lit(as_of))),
        F.when(F.col("published_at").isNotNull(),
               F.concat(F.lit("date_published: "), yaml_quoted(utc_date_label("published_at")))),
        F.when(F.size(tags) > 0, F.concat(F.lit("tags:\n"), F.array_join(
            F.transform(tags, lambda t: F.concat(F.lit("- "), yaml_quoted(t))), "\n"))).otherwise(F.lit("tags: []")),
        F.concat(F.lit("relevance: "), F.col("relevance_score").cast("string")),
        F.concat(F.lit("level: "), yaml_quoted("processing_level")),
        F.concat(F.lit("hash: "), yaml_quoted("content_hash")),
    )


def _opt(cond: Column, arr: Column) -> Column:
    return F.when(cond, arr).otherwise(F.array().cast("array<string>"))


def body() -> Column:
    """O-G2: heading, meta line, optional sections, raw text (detailed) or its word count, notes stub."""
    s = lambda v: F.lit(v)
    author = F.coalesce(F.col("author"), F.lit(""))
    meta = F.concat(s("> Source: ["), F.coalesce(F.col("source_name"), s("")), s("]("), F.col("url"), s(")"),
                    F.when(F.length(author) > 0, F.concat(s(" | Author: "), author)).otherwise(s("")), s("\n"))
    summary = F.coalesce(F.col("content_summary"), s(""))
    kp = F.coalesce(F.col("key_points"), F.array().cast("array<string>"))
    deep = F.coalesce(F.col("content_deep"), s(""))
    rel = F.coalesce(F.col("related_topics"), F.array().cast("array<string>"))
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>"))
    raw = F.coalesce(F.col("content_raw"), s(""))
    parts = F.concat(
        F.array(F.concat(s("# "), F.col("title"), s("\n")), meta),
        _opt(F.length(summary) > 0, F.array(s("## Summary\n"), F.concat(summary, s("\n")))),
        _opt(F.size(kp) > 0, F.concat(F.array(s("## Key Points\n")),
                                      F.transform(kp, lambda p: F.concat(s("- "), p)), F.array(s("")))),
        _opt(F.length(deep) > 0, F.array(s("## Deep Analysis\n"), F.concat(deep, s("\n")))),
        _opt(F.size(rel) > 0, F.array(s("## Related\n"), F.concat(F.array_join(
            F.transform(rel, lambda t: F.concat(s("[["), t, s("]]"))), " "), s("\n")))),
        _opt(F.size(tags) > 0, F.array(s("## Tags\n"), F.concat(F.array_join(
            F.transform(tags, lambda t: F.concat(s("#"), t)), " "), s("\n")))),
        F.when((F.col("content_tier") == "detailed") & (F.length(raw) > 0),
               F.array(s(RAW_HEADING), F.concat(raw, s("\n"))))
         .when(F.length(raw) > 0, F.array(F.concat(s("\n---\n" + RAW_WORDS), word_count(raw).cast("string"),
                                                   s(" words*\n"))))
         .otherwise(F.array().cast("array<string>")),
        F.array(s("\n## Personal Notes\n")),
    )
    return F.array_join(parts, "\n")


def note_content(as_of: str) -> Column:
    return F.concat(F.lit("---\n"), frontmatter(as_of), F.lit("\n---\n"), body())


def target_dir(as_of: str) -> Column:
    """O-P12: source folder, then the repo's short name (repos) or the run date (others)."""
    sub = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in SOURCE_DIRS.items() for x in kv]),
                                  F.col("source")), F.lit(DEFAULT_DIR))
    repo = F.when(F.length("source_name") > 0, F.element_at(F.split("source_name", "/"), -1)).otherwise(F.lit("unknown"))
    leaf = F.when(F.col("source") == "github", repo).otherwise(F.date_format(F.to_date(F.lit(as_of)), "yyyy-MM-dd"))
    return F.concat(sub, F.lit("/"), leaf)


def _family(name: Column):
    """(stem, slot) read from an existing file name: 'x.md' -> (x, 0); 'x-3.md' also -> (x, 3)."""
    stem = F.regexp_extract(name, r"^(.*)\.md$", 1)
    base = F.regexp_extract(stem, r"^(.*)-([1-9][0-9]*)$", 1)
    k = F.regexp_extract(stem, r"^(.*)-([1-9][0-9]*)$", 2)
    own = F.struct(stem.alias("stem"), F.lit(0).cast("long").alias("slot"))
    other = F.struct(base.alias("stem"), k.try_cast("long").alias("slot"))
    return F.when(F.length(k) > 0, F.array(own, other)).otherwise(F.array(own))


def resolve_collisions(notes: DataFrame, existing: DataFrame | Callable[[DataFrame], DataFrame] | None = None, key: str = "ord") -> DataFrame:
    """O-W4: final file name per note: 'x.md', 'x-1.md', ... per folder, skipping names already present.

    ``existing`` are (dir, filename) rows, or a function that gives those of the families (dir, stem) it is asked for.

    The r-th new note of a family (0-based, by ``key``) takes the r-th free slot. With the existing
    slots e_1 < e_2 < ... given the value g_i = e_i - i + 1, the r-th free slot is r plus the number of
    i with g_i <= r, which is exactly the new note's position when existing slots (value g) and new
    notes (value r) are ordered together, existing first on ties. Only row numbers per family (balanced
    when one family, e.g. 'untitled', holds most notes), never pairs.
    """
    # Only the names are numbered; they are written once, so the (wide) notes are not evaluated per number.
    names = cut_lineage(notes.select(key, "dir", "filename"))
    n = names.withColumn("_stem", F.regexp_extract("filename", r"^(.*)\.md$", 1))
    fam = ["dir", "_stem"]
    n = balanced_row_number(n, fam, [key], "_val").withColumn("_val", F.col("_val") - 1)
    parts = [n.select("dir", "_stem", "_val", F.lit(1).alias("_new"), F.col(key).alias("_k"))]
    # Slots already taken: every reading of an existing file name, plus the base name of each new note read
    # as a suffixed name of another family ('x-1.md' is slot 1 of family 'x'), so a generated name never
    # lands on another note's own name (base names win over generated suffixes).
    taken = n.select("dir", F.explode(F.slice(_family(F.col("filename")), 2, 1)).alias("f"))
    if callable(existing):
        existing = existing(n.select("dir", F.col("_stem").alias("stem")).distinct())
    if existing is not None:
        taken = taken.unionByName(existing.select("dir", F.explode(_family(F.col("filename"))).alias("f")))
    ex = taken.select("dir", F.col("f.stem").alias("_stem"), F.col("f.slot").alias("slot")).distinct()
    ex = balanced_row_number(ex, fam, ["slot"], "_i")
    parts.append(ex.select("dir", "_stem", (F.col("slot") - F.col("_i") + 1).alias("_val"),
                           F.lit(0).alias("_new"), F.lit(None).cast(n.schema[key].dataType).alias("_k")))
    u = parts[0].unionByName(parts[1])
    u = balanced_row_number(u, fam, ["_val", "_new", "_k"], "_slot").withColumn("_slot", F.col("_slot") - 1)
    u = u.where("_new = 1")
    out = n.join(u.select(F.col("_k").alias(key), "dir", "_slot"), [key, "dir"], "inner")
    name = F.when(F.col("_slot") == 0, F.col("filename")).otherwise(
        F.concat(F.col("_stem"), F.lit("-"), F.col("_slot").cast("string"), F.lit(".md")))
    found = out.select(F.col(key), "dir", name.alias("filename"))
    return notes.drop("filename").join(found, [key, "dir"], "inner").select(*notes.columns)


def render_notes(articles: DataFrame, as_of: str, existing: DataFrame | Callable[[DataFrame], DataFrame] | None = None, key: str = "ord") -> DataFrame:
    """Rendered note rows: key, dir, filename, note_path, content (+ the article columns)."""
    r = articles.withColumn("dir", target_dir(as_of)).withColumn("filename", note_filename("relevance_score", "title"))
    r = resolve_collisions(r, existing, key)
    r = r.withColumn("note_path", F.concat(F.col("dir"), F.lit("/"), F.col("filename")))
    return r.withColumn("content", note_content(as_of))


def stored_names(spark, path: str, run: str | None = None) -> DataFrame | None:
    """dir, filename of the notes that runs other than ``run`` have written; None where nothing is stored yet."""
    t = published(spark, path, but=run)
    return None if t is None else t.select(F.concat(F.col("sub").cast("string"), F.lit("/"), F.col("leaf").cast("string")).alias("dir"), "filename")


def written_names(spark, path: str, run: str) -> DataFrame:
    """dir, filename of the notes of one run."""
    return published(spark, path, [run]).select(F.concat(F.col("sub").cast("string"), F.lit("/"), F.col("leaf").cast("string")).alias("dir"), "filename")


def _family_key(dir_: Column, stem: Column) -> Column:
    return F.concat(dir_, F.lit("/"), stem)


def registered_names(spark, registry: str, run: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """Names taken by runs other than ``run``, for ``existing`` of ``resolve_collisions``: only the asked families are looked up in
    the registry; the notes themselves are not read."""
    def of(families: DataFrame) -> DataFrame:
        known = name_store(spark, registry).known(families.select(_family_key(F.col("dir"), F.col("stem")).alias("family")))
        return known.where(F.col("run") != F.lit(run or "")).select("dir", "filename").distinct()

    return of


def register_names(rendered: DataFrame, registry: str, run: str) -> int:
    """Adds the notes' names to the registry, under every family that a name reads as."""
    rows = rendered.select("dir", "filename", F.explode(_family(F.col("filename"))).alias("f"))
    return name_store(rendered.sparkSession, registry).append(
        rows.select(_family_key(F.col("dir"), F.col("f.stem")).alias("family"), "dir", "filename", F.lit(run).alias("run")))


def write_notes(rendered: DataFrame, path: str, run: str) -> None:
    """O-K1: one parquet dataset, published run by run and partitioned by folder (folder pruning on read).

    ``run`` names one ingest, not a day: two runs of a day keep both their notes. A rerun under the same name replaces the
    run's notes in one step, also in folders that it no longer writes to; a run that dies has no notes (``published_notes``)."""
    rows = (rendered.withColumn("run", F.lit(run))
     .withColumn("sub", F.split("dir", "/").getItem(0)).withColumn("leaf", F.split("dir", "/").getItem(1))
     .select("run", "sub", "leaf", "filename", "note_path", "content", "title", "tags", "relevance_score",
             "source_name"))
    publish(rows, path, run, ["sub", "leaf"])


def published_notes(spark, path: str, runs: Sequence[str] | None = None) -> DataFrame | None:
    """The notes of all published runs, or of some; None where there are none."""
    return published(spark, path, runs)


def article_json(df: DataFrame) -> DataFrame:
    """O-K5: one JSON document per article, ISO timestamps, nulls kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                                                        "ignoreNullFields": "false"}).alias("json"))
