"""Row numbers inside groups that stay balanced when one group holds most rows.

``row_number().over(partitionBy(g))`` sends each group whole to one task. Here the
rows are range-partitioned on (group, order), sorted inside each slice and written
once with their slice number and place; a hot group is split over many slices. The
offsets (rows of the group in earlier slices) come from one small row per
(group, slice) of that same table, so both sides always see the same slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notesmith.session import cut_lineage


def balanced_row_number(df: DataFrame, group: Sequence[str | Column], order: Sequence[str | Column], out: str = "rn",
                        num_partitions: int | None = None) -> DataFrame:
    """1-based row number of each row within ``group`` by ``order`` (any rows equal in both are numbered in some order).

    The range exchange samples its input, so two evaluations may cut the rows differently. The sliced
    rows are therefore written to the checkpoint folder before anything is counted. Pass narrow rows.
    """
    cols = df.columns
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df
    gs: list[str] = []
    for i, g in enumerate(group):
        gs.append(f"_g{i}")
        keyed = keyed.withColumn(f"_g{i}", F.col(f"`{g}`") if isinstance(g, str) else g)
    os_: list[str] = []
    for i, o in enumerate(order):
        os_.append(f"_o{i}")
        keyed = keyed.withColumn(f"_o{i}", F.col(f"`{o}`") if isinstance(o, str) else o)
    sliced = (keyed.repartitionByRange(n, *gs, *os_) if gs or os_ else keyed.repartition(n)).sortWithinPartitions(*gs, *os_)
    place = F.monotonically_increasing_id()
    sliced = cut_lineage(sliced.withColumn("_place", place).drop(*os_)
                         .withColumn("_slice", F.shiftright("_place", 33)))
    per = sliced.groupBy(*gs, "_slice").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_place").alias("_from"))
    before = Window.partitionBy(*gs).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)) - F.col("_from"))
    a, b = sliced.alias("a"), per.alias("b")
    same = F.col("a._slice") == F.col("b._slice")
    for g in gs:
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    return a.join(b, same, "inner").select(
        *[F.col(f"a.`{c}`") for c in cols], (F.col("a._place") + F.col("b._off") + 1).cast("long").alias(out))
