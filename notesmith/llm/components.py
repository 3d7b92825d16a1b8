"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notesmith.session import cut_lineage, drop_cut


def components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """id, comp (the smallest id reachable) for every id in ``links`` (a long, b long; nulls and self links are ignored).

    Each round every node points to its smallest neighbour or itself, pointers are doubled until they lead to roots, and
    the links are rewritten between roots. Pointers never rise, so the last root of a component is its smallest id. A
    star of any size shrinks in one round; minima combine on the map side. A root with a link left is at most every
    second of them, so nodes halve per round and ``most_rounds`` is out of reach; past it the function raises.
    """
    links = cut_lineage(links.select("a", "b").where("a <> b"))
    roots: DataFrame | None = None
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("p")))
        while True:
            q = up.select(F.col("u").alias("q"), F.col("p").alias("pp"))
            old = up
            up = cut_lineage(up.join(q, up["p"] == q["q"]).select("u", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("on")))
            drop_cut(old)
            if up.where("on").isEmpty():
                break
        up = up.select("u", "p")
        if roots is None:
            roots = up.select(F.col("u").alias("id"), F.col("p").alias("comp"))
        else:
            old = roots
            step = up.select(F.col("u").alias("comp"), "p")
            roots = cut_lineage(roots.join(step, "comp", "left").select("id", F.coalesce("p", "comp").alias("comp")))
            drop_cut(old)
        a, b = up.select(F.col("u").alias("a"), F.col("p").alias("pa")), up.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        old = links
        links = cut_lineage(links.join(a, "a").join(b, "b").where("pa <> pb").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        drop_cut(old)
        if links.isEmpty():
            return roots
    raise RuntimeError("components did not converge")
