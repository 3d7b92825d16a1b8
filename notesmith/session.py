"""Session helpers: a local session for tests/bench, table loading, lineage cuts."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "notesmith") -> SparkSession:
    """Local session with the settings the library expects.

    On a cluster the session comes from the launcher; this is for tests and bench.
    """
    builder = (
        SparkSession.builder.master(master or "local[8]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Uses the cluster's ``spark.checkpoint.dir`` when set; only a local test
    session without one gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for iterative operators")
    local = tempfile.mkdtemp(prefix="notesmith-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any file system Spark reads; other failures are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there and not empty."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.listStatusIterator(p).hasNext()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut lineage with a table written to the shared checkpoint folder and read back.

    Survives executor loss like ``checkpoint()`` (never a local checkpoint), and the planner sees the
    written files' real size. A ``checkpoint()`` keeps the estimate of the plan it replaced, and in
    iterative self-joins (pointer jumping) that estimate is squared every round until planning stalls."""
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    if _COLLECTED:
        _COLLECTED[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders of the cuts made inside each open ``scratch_cuts``.
_COLLECTED: list[list[str]] = []


@contextmanager
def scratch_cuts(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Cuts made inside the block are removed at its end, also after a failure; the yielded function writes a result that stays."""
    _COLLECTED.append([])

    def keep(df: DataFrame) -> DataFrame:
        out = cut_lineage(df)
        path = _COLLECTED[-1].pop()
        if len(_COLLECTED) > 1:
            _COLLECTED[-2].append(path)
        return out

    try:
        yield keep
    finally:
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in _COLLECTED.pop():
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def drop_cut(df: DataFrame) -> None:
    """Remove the files behind a table made by ``cut_lineage`` once its successor is written.

    Only files inside the checkpoint folder are touched; the table must not be read afterwards."""
    spark = df.sparkSession
    root = checkpoint_dir(spark).rstrip("/")
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.rsplit("/", 1)[-1].startswith("cut-") and folder.rsplit("/", 2)[-2] == root.rsplit("/", 1)[-1]:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``notesmith`` importable in Python workers (what ``--py-files`` does), once per app.

    Operators that run pandas functions call this first; the zip is distributed by Spark's
    own file server to every executor."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="notesmith-pkg-"), "notesmith.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("notesmith", os.path.relpath(full, pkg)))
    del shutil
    sc.addPyFile(out)
    _SHIPPED.add(app)
