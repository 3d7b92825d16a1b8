"""Density clustering of embeddings at one cut (O-X1, O-J6, O-C1, O-C2). The hierarchy (O-C3) is in ``linkage``.

Exact, without pair rows: points stand in blocks by pivots (``vector_blocks``), each block first answers out of its own rows,
and only rows whose bound still allows a better answer meet other blocks. What leaves a pair of blocks is at most
``k`` candidates per row (nearest neighbours) or a spanning forest of its links (components), never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notesmith.operators.vector_blocks import (Blocks, blocked, close_pairs, distances, measured, per_pair, routed, spanning, stacked,
                                               summaries)
from notesmith.session import cut_lineage


def euclidean(a, b) -> Column:
    """O-X1 as a column expression (for pairs that are already joined)."""
    sq = F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0).cast("double"),
                     lambda acc, v: acc + v)
    return F.sqrt(sq)


# ---- O-J6 / O-C1: nearest rows ------------------------------------------------------

#: Candidates that a search gathers before it keeps the best of each row.
GATHERED = 1 << 20


def _first(row: np.ndarray, dist: np.ndarray, who: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` smallest (distance, id) entries of each row, in order."""
    order = np.lexsort((who, dist, row))
    row, dist, who = row[order], dist[order], who[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], dist[keep], who[keep]


class _Best:
    """The ``k`` nearest columns of each row within its reach; a column counts ``mult`` times, ties go to the smaller id."""

    def __init__(self, others: np.ndarray, mult: np.ndarray, k: int, reach: np.ndarray):
        self.others, self.mult, self.k, self.reach = others, mult, k, reach
        self.parts, self.size = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))], 0

    def offer(self, row: np.ndarray, col: np.ndarray, dist: np.ndarray) -> None:
        ok = (dist <= self.reach[row]) & np.isfinite(dist)
        row, col, dist = row[ok], col[ok], dist[ok]
        times = np.minimum(self.mult[col], self.k)
        self.parts.append((np.repeat(row, times), np.repeat(dist, times), np.repeat(self.others[col], times)))
        self.size += len(self.parts[-1][0])
        if self.size > GATHERED:
            self.parts, self.size = [self.found()], 0

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _first(*(np.concatenate(c) for c in zip(*self.parts)), self.k)


def _own_limits(x: np.ndarray, k: int) -> np.ndarray:
    """For each row, a distance within which ``k`` other rows are: its k-th least distance to some of them."""
    n = len(x)
    some = np.unique(np.linspace(0, n - 1, min(n, k + 1 + math.isqrt(k * n))).astype(np.int64))
    out = np.full(n, np.inf)
    for s in range(0, n, 1024):
        d = distances(x[s:s + 1024], x[some])
        d[some[None, :] == np.arange(s, s + len(d))[:, None]] = np.inf
        if len(some) > k:
            out[s:s + 1024] = np.partition(d, k - 1, axis=1)[:, k - 1]
    return np.where(np.isnan(out), np.inf, out * (1 + 1e-12))


def _within_blocks(b: Blocks, k: int) -> DataFrame:
    """The columns of the rows, core (null), reach (distance of the k-th nearest in the own block) and near/who: those k. Written."""
    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep").reset_index(drop=True)
        x, ids, mult = stacked(pdf["vec"]), pdf["rep"].to_numpy(), pdf["mult"].to_numpy()
        limits = _own_limits(x, k)
        best = _Best(ids, mult, k, limits)
        for i, j in close_pairs(x, x, limits, np.full(len(x), -1.0)):
            i, j = i[i != j], j[i != j]
            best.offer(i, j, measured(x, x, i, j))
        near = [[0.0] * min(k, int(c) - 1) for c in mult]
        whose = [[int(i)] * len(z) for i, z in zip(ids, near)]
        for r, d, w in zip(*(c.tolist() for c in best.found())):
            if len(near[r]) < k:
                near[r].append(d)
                whose[r].append(w)
        return pdf.assign(core=np.inf, reach=[z[-1] if len(z) == k else math.inf for z in near], near=near, who=whose)

    row = ", ".join(f"{n} {t}" for n, t in b.rows.dtypes)
    return cut_lineage(b.rows.groupBy("blk").applyInPandas(own, row + ", core double, reach double, near array<double>, who array<long>"))


def _nearest(b: Blocks, k: int) -> tuple[DataFrame, DataFrame]:
    """(rep, rank, dist, who) of the ``k`` nearest other points of each vector, exact, and the rows sent between blocks."""
    state = _within_blocks(b, k)
    sent = routed(state.select(*state.columns[:7]), summaries(state, b.count, b.pivots),
                  lambda bounds, rows, s: bounds <= np.maximum(rows["reach"][:, None], s.reach[None, :]), own_pair=False)

    def across(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        x, y = stacked(left["vec"]), stacked(right["vec"])
        ids, reach = [p["rep"].to_numpy() for p in (left, right)], [p["reach"].to_numpy() for p in (left, right)]
        one, two = _Best(ids[1], right["mult"].to_numpy(), k, reach[0]), _Best(ids[0], left["mult"].to_numpy(), k, reach[1])
        for i, j in close_pairs(x, y, *reach):
            d = measured(x, y, i, j)
            one.offer(i, j, d)
            two.offer(j, i, d)
        return pd.concat([pd.DataFrame({"rep": of[row], "dist": dist, "who": who})
                          for of, (row, dist, who) in zip(ids, (one.found(), two.found()))])

    found = per_pair(sent, across, "rep long, dist double, who long")
    own = state.select("rep", F.explode(F.arrays_zip("near", "who")).alias("z")).select("rep", "z.near", "z.who").toDF("rep", "dist", "who")
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("dist", "who"))
    return own.unionByName(found).withColumn("rank", rank).where(F.col("rank") <= k), sent


def nearest_distances(points: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
                      block_size: int | None = None) -> DataFrame:
    """(id, rank, dist): the k smallest distances from each point to other points (exact; equal vectors are other points at 0)."""
    b = blocked(points, id_col, vec_col, block_size)
    if not b.count:
        return points.sparkSession.createDataFrame([], f"{id_col} long, rank int, dist double")
    near, _ = _nearest(b, k)
    return b.ids.join(near, "rep").select(F.col("id").alias(id_col), "rank", "dist")


def nearest_neighbor(points: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                     block_size: int | None = None) -> DataFrame:
    """(id, nn): each point's nearest other point (ties by smaller id). Of equal vectors the one with the smallest other id."""
    b = blocked(points, id_col, vec_col, block_size)
    if not b.count:
        return points.sparkSession.createDataFrame([], f"{id_col} long, nn long")
    near, _ = _nearest(b, 1)
    second = b.ids.where("id <> rep").groupBy("rep").agg(F.min("id").alias("second"))
    found = b.ids.join(near.select("rep", "who"), "rep", "left").join(second, "rep", "left")
    nn = F.when(F.col("second").isNull(), F.col("who")).when(F.col("id") == F.col("rep"), F.col("second")).otherwise(F.col("rep"))
    return found.select(F.col("id").alias(id_col), nn.alias("nn")).where("nn is not null")


def near_and_cores(b: Blocks, min_samples: int) -> tuple[DataFrame, DataFrame]:
    """(rep, rank, dist, who) of the ``min_samples`` nearest other points, written, and the cores that follow from them."""
    near = cut_lineage(_nearest(b, min_samples)[0])
    return near, near.where(F.col("rank") == min_samples).select("rep", F.col("dist").alias("core"))


def rep_cores(b: Blocks, min_samples: int) -> DataFrame:
    """rep, core: distance to the ``min_samples``-th nearest other point; vectors with fewer others are left out. Written."""
    near, _ = _nearest(b, min_samples)
    return cut_lineage(near.where(F.col("rank") == min_samples).select("rep", F.col("dist").alias("core")))


def core_distances(points: DataFrame, min_samples: int = 2, id_col: str = "vec_id", vec_col: str = "embedding",
                   block_size: int | None = None) -> DataFrame:
    """O-C1: distance to the ``min_samples``-th nearest other point (the point itself not counted)."""
    nd = nearest_distances(points, min_samples, id_col, vec_col, block_size)
    return nd.where(F.col("rank") == min_samples).select(id_col, F.col("dist").alias("core"))


def exact_quantile(df: DataFrame, value_col: str, q: float) -> float:
    """percentile_disc(q): the value at rank ceil(q * n) of a global (range-partitioned) sort."""
    from notesmith.operators.ranking import balanced_row_number
    n = df.count()
    if n == 0:
        return float("nan")
    r = max(1, math.ceil(q * n))
    ranked = balanced_row_number(df.select(value_col), [], [value_col], "_r")
    return float(ranked.where(F.col("_r") == r).select(value_col).first()[0])


# ---- O-C2: components under one cut ---------------------------------------------------

def _reaching(b: Blocks, core: DataFrame, cut: float) -> DataFrame:
    """Rows with core <= cut, sent to every pair of blocks in which they may have a link of at most ``cut``."""
    rows = cut_lineage(b.rows.join(core.where(F.col("core") <= cut), "rep").withColumn("reach", F.lit(float(cut))))
    return routed(rows, summaries(rows, b.count, b.pivots), lambda bounds, rows, s: bounds <= cut, own_pair=True)


def _within_cut(left: pd.DataFrame, right: pd.DataFrame, cut: float, open_=None):
    """Tiles (i, j, weight) of the pairs with mutual reachability max(core a, core b, distance) <= cut. In a block against itself
    each unordered pair comes once. ``open_(i, j)`` may leave out pairs before they are measured."""
    x, y, ia, ib = stacked(left["vec"]), stacked(right["vec"]), left["rep"].to_numpy(), right["rep"].to_numpy()
    ca, cb = left["core"].to_numpy(), right["core"].to_numpy()
    same = left["blk"].iat[0] == right["blk"].iat[0]
    for i, j in close_pairs(x, y, np.full(len(x), float(cut)), np.full(len(y), -1.0)):
        ok = np.maximum(ca[i], cb[j]) <= cut
        if same:
            ok &= ia[i] < ib[j]
        if open_ is not None:
            ok &= open_(i, j)
        i, j = i[ok], j[ok]
        w = np.maximum(measured(x, y, i, j), np.maximum(ca[i], cb[j]))
        ok = w <= cut
        yield i[ok], j[ok], w[ok]


def reach_edges(points: DataFrame, core: DataFrame, cut: float, id_col: str = "vec_id", vec_col: str = "embedding",
                block_size: int | None = None) -> DataFrame:
    """(a, b, weight) with a < b for mutual-reachability weight max(core a, core b, d) <= cut.

    Pairs are those of different vectors, each by its smallest id; copies of a vector are linked to that id."""
    b = blocked(points, id_col, vec_col, block_size)
    cores = core.select(F.col(id_col).alias("rep"), "core")
    if not b.count:
        return points.sparkSession.createDataFrame([], "a long, b long, weight double")

    def pairs(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ia, ib = left["rep"].to_numpy(), right["rep"].to_numpy()
        out = [(np.minimum(ia[i], ib[j]), np.maximum(ia[i], ib[j]), w) for i, j, w in _within_cut(left, right, cut)]
        a, b_, w = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pd.DataFrame({"a": a, "b": b_, "weight": w})

    copies = b.ids.where("id <> rep").join(cores.where(F.col("core") <= cut), "rep").select(F.col("rep").alias("a"), F.col("id").alias("b"),
                                                                                            F.col("core").alias("weight"))
    return per_pair(_reaching(b, cores, cut), pairs, "a long, b long, weight double").unionByName(copies)


def forest_links(adjacent: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of links that span the components of a bipartite graph (``same``: rows and columns are one set)."""
    i, j = np.nonzero(adjacent)
    n, m = adjacent.shape
    kept, _ = spanning(m if same else n + m, i, j if same else j + n)
    return i[kept], j[kept]


def reach_forest(b: Blocks, core: DataFrame, cut: float) -> DataFrame:
    """(a, b): a spanning forest of the links of at most ``cut`` for each pair of blocks; fewer links than rows sent."""
    def links(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        same = left["blk"].iat[0] == right["blk"].iat[0]
        after = 0 if same else len(left)
        n = after + len(right)
        comp = np.arange(n)
        i = j = np.zeros(0, np.int64)
        new: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for a, c, _ in _within_cut(left, right, cut, lambda a, c: comp[a] != comp[c + after]):
            new.append((a, c))
            size += len(a)
            if size > n:  # links between rows that are united by now are not measured any more
                i, j = (np.concatenate([old, *more]) for old, more in zip((i, j), zip(*new)))
                kept, comp = spanning(n, i, j + after)
                i, j, new, size = i[kept], j[kept], [], 0
        if new:
            i, j = (np.concatenate([old, *more]) for old, more in zip((i, j), zip(*new)))
            kept, _ = spanning(n, i, j + after)
            i, j = i[kept], j[kept]
        return pd.DataFrame({"a": left["rep"].to_numpy()[i], "b": right["rep"].to_numpy()[j]})

    return per_pair(_reaching(b, core, cut), links, "a long, b long")


def components(nodes: DataFrame, edges: DataFrame, id_col: str = "vec_id", max_rounds: int = 1000,
               jumps: int = 2) -> DataFrame:
    """Connected components: (id, comp) with comp = smallest id in the component.

    Each round: every node takes the smallest label among its neighbours, the node its old label
    names is hooked onto that label too (so whole trees move at once), then ``jumps`` pointer jumps
    (comp <- comp[comp]). Labels only fall and stay inside the component, so the fixed point is the
    component minimum, reached in far fewer rounds than plain propagation on long paths. Hub nodes
    are handled by map-side partial min aggregation; state is cut every round."""
    und = edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
        edges.select(F.col("b").alias("src"), F.col("a").alias("dst")))
    und = cut_lineage(und)
    lab = nodes.select(F.col(id_col).alias("v"), F.col(id_col).alias("comp"))
    for _ in range(max_rounds):
        nbr = und.join(lab.withColumnRenamed("v", "dst"), "dst").groupBy("src").agg(F.min("comp").alias("m"))
        nbr = nbr.withColumnRenamed("src", "v")
        new = lab.join(nbr, "v", "left").select("v", F.least("comp", F.coalesce("m", "comp")).alias("comp"))
        hook = lab.join(nbr, "v").groupBy(F.col("comp").alias("v")).agg(F.min("m").alias("h"))
        new = new.join(hook, "v", "left").select("v", F.least("comp", F.coalesce("h", "comp")).alias("comp"))
        for _ in range(jumps):
            jump = new.select(F.col("v").alias("comp"), F.col("comp").alias("c2"))
            new = new.join(jump, "comp", "left").select("v", F.least("comp", F.coalesce("c2", "comp")).alias("comp"))
        new = cut_lineage(new)  # reliable cut every round: bounded plans, no replay after executor loss
        changed = new.join(lab, ["v", "comp"], "left_anti").limit(1).count()
        lab = new
        if changed == 0:
            return lab.select(F.col("v").alias(id_col), "comp")
    raise RuntimeError(f"components did not converge in {max_rounds} rounds")


def fixed_cut_labels(points: DataFrame, min_samples: int = 2, min_cluster_size: int = 3, quantile: float = 0.5,
                     cut: float | None = None, id_col: str = "vec_id", vec_col: str = "embedding",
                     block_size: int | None = None) -> tuple[DataFrame, float]:
    """O-C2 at one cut (DBSCAN*-equivalent): components of the mutual-reachability graph with
    weights <= cut; components smaller than ``min_cluster_size`` are noise (-1). The cut defaults to
    a quantile of the core distances (never a constant: the supplied vectors are near-orthogonal)."""
    b = blocked(points, id_col, vec_col, block_size)
    if not b.count:
        return b.ids.select(F.col("id").alias(id_col), F.lit(-1).cast("long").alias("label")), float("nan")
    core = rep_cores(b, min_samples)
    if cut is None:
        cut = exact_quantile(b.ids.join(core, "rep"), "core", quantile)
    comp = components(b.reps, reach_forest(b, core, cut), "rep")
    # copies of a vector are linked by its core distance
    own = F.when(F.col("core") <= cut, F.col("comp")).otherwise(F.col("id"))
    lab = cut_lineage(b.ids.join(comp.join(core, "rep", "left"), "rep").select("id", own.alias("comp")))
    sizes = lab.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    return lab.join(sizes, "comp").select(
        F.col("id").alias(id_col), F.when(F.col("size") >= min_cluster_size, F.col("comp")).otherwise(F.lit(-1)).alias("label")), cut


def hierarchy_labels(points: DataFrame, min_samples: int = 2, min_cluster_size: int = 3, id_col: str = "vec_id",
                     vec_col: str = "embedding", block_size: int | None = None) -> DataFrame:
    """O-C3, see ``linkage.hierarchy_labels``."""
    from notesmith.operators import linkage

    return linkage.hierarchy_labels(points, min_samples, min_cluster_size, id_col, vec_col, block_size)
