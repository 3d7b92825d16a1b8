"""Note scan (O-S7) and frontmatter fields (O-N7).

Reads every ``*.md`` under the three note folders as one row per file (whole text),
keeps files with a frontmatter block and extracts the fields written by the note
renderer: scalars (double-quoted, single-quoted or plain), tag lists in flow
(``[a, b]``) or block (``- a``) form. Not a general YAML reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notesmith.functions.common import col, py_strip
from notesmith.functions.text import note_summary, path_stem

NOTE_DIRS = ("2-Articles", "3-GitHub", "4-Newsletters")


def frontmatter_block(content) -> Column:
    """Text between the opening '---' line and the next line starting '---'; null when absent."""
    c = col(content)
    end = F.locate("\n---", c, 4)
    return F.when(c.startswith("---") & (end > 0), c.substr(F.lit(4), end - 4))


def _scalar(block: Column, key: str) -> Column:
    raw = py_strip(F.regexp_extract(block, f"(?m)^{key}:[ \\t]*(.*)$", 1))
    dq = F.regexp_extract(raw, r'^"((?:[^"\\]|\\.)*)"$', 1)
    dq = F.replace(dq, F.lit("\\\\"), F.lit("\u0000"))  # escaped backslashes out of the way first
    for esc, ch in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"'), ("\u0000", "\\")):
        dq = F.replace(dq, F.lit(esc), F.lit(ch))
    sq = F.replace(F.regexp_extract(raw, r"^'((?:[^']|'')*)'$", 1), F.lit("''"), F.lit("'"))
    present = F.regexp_extract(block, f"(?m)^({key}):", 1) != ""
    return (F.when(~present, F.lit(None))
            .when(raw.startswith('"'), dq).when(raw.startswith("'"), sq).otherwise(raw))


def _unquote(c: Column) -> Column:
    s = py_strip(c)
    return F.when(s.rlike(r'^".*"$') | s.rlike(r"^'.*'$"), s.substr(F.lit(2), F.length(s) - 2)).otherwise(s)


def _tags(block: Column) -> Column:
    flow = F.regexp_extract(block, r"(?m)^tags:[ \t]*\[(.*)\][ \t]*$", 1)
    has_flow = F.regexp_extract(block, r"(?m)^tags:[ \t]*(\[)", 1) != ""
    flow_list = F.filter(F.transform(F.split(flow, ","), _unquote), lambda t: t != "")
    block_items = F.regexp_extract(block, r"(?ms)^tags:[ \t]*\n((?:- [^\n]*(?:\n|$))+)", 1)
    block_list = F.filter(F.transform(F.split(block_items, "\n"), lambda ln: _unquote(F.regexp_replace(ln, "^- ", ""))),
                          lambda t: t != "")
    return F.when(has_flow, flow_list).otherwise(block_list)


def parse_note(content="content", path="path") -> Column:
    """O-N7 fields + O-F14 summary as one struct (null when the file has no frontmatter)."""
    fm = frontmatter_block(content)
    title = _scalar(fm, "title")
    rel = _scalar(fm, "relevance")
    return F.when(fm.isNotNull(), F.struct(
        F.coalesce(title, path_stem(path)).alias("title"),
        _tags(fm).alias("tags"),
        note_summary(content).alias("summary"),
        F.coalesce(rel.try_cast("int"), F.lit(0)).alias("relevance"),
        F.coalesce(_scalar(fm, "source_name"), F.lit("")).alias("source_name"),
    ))


def read_notes(spark: SparkSession, vault: str) -> DataFrame:
    """O-S7: notes under the three folders -> (ord, path, title, tags, summary, relevance, source_name).
    ``ord`` follows the path order (stable across runs)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    frames = []
    for sub in NOTE_DIRS:
        p = jvm.org.apache.hadoop.fs.Path(f"{vault.rstrip('/')}/{sub}")
        if not p.getFileSystem(conf).exists(p):
            continue
        frames.append(spark.read.text(f"{vault.rstrip('/')}/{sub}", wholetext=True, recursiveFileLookup=True,
                                      pathGlobFilter="*.md")
                      .select(F.col("value").alias("content"), F.col("_metadata.file_path").alias("file_path")))
    if not frames:
        return spark.createDataFrame([], "ord long, path string, title string, tags array<string>, summary string, "
                                         "relevance int, source_name string")
    raw = frames[0]
    for f in frames[1:]:
        raw = raw.unionByName(f)
    # Path relative to the vault, whatever the file system scheme (file:, hdfs:, s3a:, ...).
    rel_path = F.regexp_extract("file_path", "/((?:" + "|".join(NOTE_DIRS) + ")/.*)$", 1)
    rows = raw.select(rel_path.alias("path"), "content").withColumn("n", parse_note("content", "path"))
    rows = rows.where(F.col("n").isNotNull()).select("path", "n.*")
    from notesmith.operators.ranking import balanced_row_number
    return balanced_row_number(rows, [], ["path"], "ord").select(
        "ord", "path", "title", "tags", "summary", "relevance", "source_name")

