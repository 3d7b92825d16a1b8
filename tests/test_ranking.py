"""Row numbers inside groups: whole and gapless at sizes where the range exchange has to sample."""

import pytest
from pyspark.sql import functions as F

from notesmith.operators.ranking import balanced_row_number


@pytest.mark.parametrize("hot", [False, True])
def test_numbers_are_gapless_at_200k_rows(spark, hot):
    n = 200_000
    g = F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id") % 7) if hot else F.col("id") % 7
    df = spark.range(n).withColumn("g", g).withColumn("o", F.hash("id") % 1000)
    r = balanced_row_number(df, ["g"], ["o", "id"])
    per = r.groupBy("g").agg(F.count("*").alias("c"), F.countDistinct("rn").alias("d"), F.max("rn").alias("m"),
                             F.min("rn").alias("lo")).collect()
    assert sum(p["c"] for p in per) == n
    assert all(p["c"] == p["d"] == p["m"] and p["lo"] == 1 for p in per)


def test_order_holds_and_null_groups_count(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", None)], "g string, o int")
    got = {(r["g"], r["o"]): r["rn"] for r in balanced_row_number(df, ["g"], ["o"]).collect()}
    assert got == {(None, 1): 1, (None, 3): 2, ("a", None): 1, ("a", 2): 2}


def test_empty_and_global(spark):
    assert balanced_row_number(spark.range(0), [], ["id"]).count() == 0
    got = balanced_row_number(spark.range(30_000), [], ["id"]).where("rn != id + 1").count()
    assert got == 0
