"""Datasets published run by run: a run's files are seen by readers all at once or not at all (O-K1, O-K3).

Every write of a run is an attempt with a folder of its own, ``rk=<digest of the run>/attempt=<id>``, which nothing else writes to.
When the write is over, its files are listed and one manifest is put under ``_manifests``: a file of JSON written under a hidden name and
renamed, so it is there whole or not at all. The manifest names the attempt's folder, its files and bytes, its schema and a number that
rises with every publication of the run; the highest one holds. Readers take the folders from the manifests and never list the rest,
so a write that dies before its manifest is invisible, a repeated run replaces its files in one step, and a reader that has begun
keeps the files it began with. What no manifest in force names is removed by ``vacuum``.

Manifests are one small row per run; rows and files never pass through the driver.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notesmith.session import holds_files, path_exists

MANIFESTS = "_manifests"
MANIFEST = "run string, number long, attempt string, format string, schema string, files long, bytes long, published long"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _run_key(run: str) -> str:
    return hashlib.md5(run.encode()).hexdigest()


def _folder(path: str, run: str, attempt: str) -> str:
    return f"{path.rstrip('/')}/rk={_run_key(run)}/attempt={attempt}"


def write_attempt(df: DataFrame, path: str, run: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> str:
    """The rows in a new folder that no reader sees yet; returns the attempt's name for ``commit``."""
    attempt = uuid.uuid4().hex
    df.write.format(fmt).mode("errorifexists").partitionBy(*partition_by).save(_folder(path, run, attempt))
    return attempt


def commit(spark: SparkSession, path: str, run: str, attempt: str, schema: T.StructType, fmt: str = "parquet") -> dict:
    """Makes a finished attempt the content of its run. Returns the manifest."""
    folder, fs = _fs(spark, _folder(path, run, attempt))
    summary = fs.getContentSummary(folder)
    earlier = [r["number"] for r in manifests(spark, path).where(F.col("run") == run).select("number").collect()]
    entry = {"run": run, "number": max(earlier, default=0) + 1, "attempt": attempt, "format": fmt, "schema": schema.json(),
             "files": summary.getFileCount(), "bytes": summary.getLength(), "published": int(time.time() * 1000)}
    name = f"{_run_key(run)}-{entry['number']:012d}-{attempt}.json"
    hidden, _ = _fs(spark, f"{path.rstrip('/')}/{MANIFESTS}/.{name}")
    final, _ = _fs(spark, f"{path.rstrip('/')}/{MANIFESTS}/{name}")
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(json.dumps(entry).encode()))
    finally:
        out.close()
    if not fs.rename(hidden, final):
        raise OSError(f"manifest {final} could not be published")
    return entry


def publish(df: DataFrame, path: str, run: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> dict:
    """Writes the rows and then shows them to readers as the content of ``run``."""
    return commit(df.sparkSession, path, run, write_attempt(df, path, run, partition_by, fmt), df.schema, fmt)


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """All manifests, also those that later ones of their run replace."""
    folder = f"{path.rstrip('/')}/{MANIFESTS}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(folder)


def current(spark: SparkSession, path: str) -> DataFrame:
    """One manifest per run, the one in force: the highest number, of equal numbers (two writers at once) the larger attempt."""
    names = T._parse_datatype_string(MANIFEST).names
    one = manifests(spark, path).groupBy("run").agg(F.max_by(F.struct(*names), F.struct("number", "attempt")).alias("m"))
    return one.select("m.*")


def published(spark: SparkSession, path: str, runs: Sequence[str] | None = None, but: str | None = None) -> DataFrame | None:
    """Rows of all published runs, of the named ones, or of all but one; None where none is published.

    Only the folders of these runs are listed. Runs may differ in columns: one that a run lacks is null there. A folder that holds
    files but no manifests is an error, not an empty dataset."""
    if holds_files(spark, path) and not _own_folder(spark, path):
        raise ValueError(f"{path} holds files that were not published")
    entries = current(spark, path)
    if runs is not None:
        entries = entries.where(F.col("run").isin(list(runs)))
    if but is not None:
        entries = entries.where(F.col("run") != but)
    rows = entries.orderBy("published", "run").collect()  # one per run
    if not rows:
        return None
    if len({r["format"] for r in rows}) > 1:
        raise ValueError(f"{path} holds runs of several formats")
    fields: dict[str, T.StructField] = {}
    for r in rows:
        for f in T.StructType.fromJson(json.loads(r["schema"])).fields:
            if fields.setdefault(f.name, f).dataType != f.dataType:
                raise ValueError(f"{path}: runs hold column {f.name} in different types")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])
    folders = [_folder(path, r["run"], r["attempt"]) for r in rows]
    return spark.read.format(rows[0]["format"]).schema(schema).option("basePath", path).load(folders).select(*schema.names)


def _own_folder(spark: SparkSession, path: str) -> bool:
    """Whether a folder is one of this module's: it has manifests, or attempts of which none is published yet."""
    p, fs = _fs(spark, path)
    return all(s.getPath().getName() == MANIFESTS or s.getPath().getName().startswith("rk=") for s in fs.listStatus(p))


def vacuum(spark: SparkSession, path: str, older_than_seconds: float = 86_400) -> int:
    """Removes attempts and manifests that are not in force; returns how many attempts. Younger attempts may still be written
    or read and stay."""
    if not path_exists(spark, path):
        return 0
    root, fs = _fs(spark, path)
    held = {(_run_key(r["run"]), r["attempt"]) for r in current(spark, path).select("run", "attempt").collect()}
    limit = (time.time() - older_than_seconds) * 1000
    gone = 0
    for run in fs.listStatus(root):
        if not run.getPath().getName().startswith("rk="):
            continue
        key = run.getPath().getName()[3:]
        for attempt in fs.listStatus(run.getPath()):
            name = attempt.getPath().getName().removeprefix("attempt=")
            if (key, name) not in held and attempt.getModificationTime() <= limit:
                fs.delete(attempt.getPath(), True)
                gone += 1
    folder, _ = _fs(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    for entry in fs.listStatus(folder) if fs.exists(folder) else ():
        parts = entry.getPath().getName().removeprefix(".").removesuffix(".json").split("-")
        if (parts[0], parts[-1]) not in held and entry.getModificationTime() <= limit:
            fs.delete(entry.getPath(), True)
    return gone
