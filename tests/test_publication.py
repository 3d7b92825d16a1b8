"""Runs are seen whole or not at all (O-K1, O-K3)."""

import os

import pytest
from pyspark.sql import functions as F

from notesmith.operators import maps, notes
from notesmith.operators import publication as P


def _rows(spark, k, n=4):
    return spark.range(n).select(F.col("id"), F.lit(f"v{k}").alias("v"), (F.col("id") % 2).cast("string").alias("part"))


def _seen(spark, path, **kw):
    t = P.published(spark, path, **kw)
    return None if t is None else sorted((r["id"], r["v"], r["part"]) for r in t.collect())


def test_a_write_without_its_manifest_is_invisible(spark, tmp_path):
    path = str(tmp_path / "d")
    assert P.published(spark, path) is None
    attempt = P.write_attempt(_rows(spark, 1), path, "a", ["part"])
    assert P.published(spark, path) is None
    P.commit(spark, path, "a", attempt, _rows(spark, 1).schema)
    assert _seen(spark, path) == [(0, "v1", "0"), (1, "v1", "1"), (2, "v1", "0"), (3, "v1", "1")]
    P.write_attempt(_rows(spark, 2, 1), path, "a", ["part"])  # dies before its manifest
    hidden = tmp_path / "d" / P.MANIFESTS / ".half.json"
    hidden.write_text('{"run": "a", "number": 99')  # and one that dies while it writes the manifest
    assert len(_seen(spark, path)) == 4 and P.current(spark, path).count() == 1


def test_a_failing_job_leaves_the_run_as_it_was(spark, tmp_path):
    path = str(tmp_path / "d")
    P.publish(_rows(spark, 1), path, "a", ["part"])
    bad = _rows(spark, 2, 1000).repartition(8).withColumn("v", F.when(F.col("id") == 777, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        P.publish(bad, path, "a", ["part"])
    assert [v for _, v, _ in _seen(spark, path)] == ["v1"] * 4


def test_a_repeated_run_replaces_its_rows_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "d")
    odd = "2026-05-10 / ü=%41"  # any string names a run
    P.publish(_rows(spark, 1), path, odd, ["part"])
    P.publish(_rows(spark, 2, 2), path, "b", ["part"])
    begun = P.published(spark, path, [odd])
    entry = P.publish(_rows(spark, 3, 1), path, odd, ["part"])  # one partition less
    assert entry["number"] == 2 and entry["files"] >= 1
    assert _seen(spark, path, runs=[odd]) == [(0, "v3", "0")]
    assert _seen(spark, path, but=odd) == [(0, "v2", "0"), (1, "v2", "1")] and len(_seen(spark, path)) == 3
    assert begun.count() == 4  # a reader keeps the files it began with
    assert P.vacuum(spark, path) == 0  # too young
    assert P.vacuum(spark, path, older_than_seconds=-5) == 1
    assert len(_seen(spark, path)) == 3 and P.manifests(spark, path).count() == 2
    assert len(list((tmp_path / "d").glob("rk=*/attempt=*"))) == 2


def test_empty_runs_new_columns_and_foreign_folders(spark, tmp_path):
    path = str(tmp_path / "d")
    P.publish(_rows(spark, 1, 0), path, "none")
    assert _seen(spark, path) == [] and P.published(spark, path, ["other"]) is None
    P.publish(_rows(spark, 1, 1), path, "a")
    P.publish(_rows(spark, 2, 1).withColumn("more", F.lit(None).cast("int")), path, "b")
    assert P.published(spark, path).columns == ["id", "v", "part", "more"] and len(_seen(spark, path)) == 2
    P.publish(_rows(spark, 2, 1).withColumn("v", F.lit(1)), path, "c")
    with pytest.raises(ValueError, match="column v"):
        P.published(spark, path)
    foreign = tmp_path / "f"
    _rows(spark, 1).write.parquet(str(foreign))
    with pytest.raises(ValueError, match="not published"):
        P.published(spark, str(foreign))
    assert P.vacuum(spark, str(tmp_path / "absent")) == 0


def test_only_the_folders_of_the_asked_runs_are_read(spark, tmp_path):
    path = str(tmp_path / "d")
    for k in range(3):
        P.publish(_rows(spark, k), path, f"r{k}", ["part"])
    files = P.published(spark, path, ["r1"]).where("part = '0'").inputFiles()
    own = next(r["attempt"] for r in P.current(spark, path).collect() if r["run"] == "r1")
    assert files and all(own in f for f in files)


def test_note_and_page_readers_before_anything_is_published(spark, tmp_path):
    path = os.path.join(tmp_path, "n")
    assert notes.published_notes(spark, path) is None and notes.stored_names(spark, path) is None
    assert maps.published_pages(spark, path) is None
