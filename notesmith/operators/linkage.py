"""Hierarchical density clustering (O-C3), exact at any number of distances.

1. Spanning tree. Trees of short slices of the blocks, links between slices and the nearest rows under mutual reachability give a
   first tree of all rows. Where a row meets the half of the rows that the tree joins first is the row's limit: no path of the first
   tree between two rows has a weight above the larger limit of the two, so only pairs below it can be in the minimum spanning tree.
   Every pair of blocks (``vector_blocks``) gives a minimum spanning forest of those pairs, and the tree of all rows is among these
   edges and the first tree's. Borůvka rounds then thin the edges: each component takes its lightest edge, components are merged,
   inner and parallel edges leave.
2. Merge tree. The rounds also order the tree's edges: an edge chosen in round t climbs from the component it
   was merged into until that component's lightest edge is heavier than itself. Edges that stop at the same place form a chain, in weight order,
   below that heavier edge. So each edge knows its parent (the next merge above) after as many joins as there were rounds, and
   sizes are prefix sums along chains. Merges of equal weight count as one.
3. Clusters. A merge whose parent has two or more children of ``min_cluster_size`` points starts a cluster, others continue their parent's. A
   cluster's stability is the sum over its points of the growth of 1 / distance while they stay in it. Clusters are chosen bottom-up
   when their stability is at least their children's best total: in every round clusters whose children are all settled are settled, and
   clusters that wait for one child are composed with what that child waits for, so long chains settle in logarithmically many rounds.

Every table has at most a few rows per point and is hashed on ids; nothing is gathered by weight, level or cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notesmith.operators.density import near_and_cores
from notesmith.operators.ranking import balanced_row_number
from notesmith.operators.vector_blocks import Blocks, blocked, close_pairs, measured, per_pair, routed, spanning, stacked, summaries
from notesmith.session import cut_lineage, drop_cut, scratch_cuts

#: Decimals of a weight: distances that agree to them are equal, whatever engine added them up.
DIGITS = 9
#: Least distance that 1 / distance is taken of.
LEAST = 1e-12
#: Consecutive rows that one task adds up in a prefix sum.
SLICE = 1 << 16
#: Rows of one of the first tree's slices, rows up to which one limit serves all, and pairs that a forest is made of at once.
TREE_ROWS, FEW_ROWS, FOREST_PAIRS = 1024, 8192, 1 << 21


# ---- spanning tree -------------------------------------------------------------------

def tree_of(x: np.ndarray, core: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, row, weight) of the minimum spanning tree of the rows under mutual reachability; one row of distances at a time."""
    n = len(x)
    best, by, inside = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n, bool)
    a, b, w = np.zeros(n - 1, np.int64), np.zeros(n - 1, np.int64), np.zeros(n - 1)
    at = 0
    for k in range(n - 1):
        inside[at] = True
        best[at] = np.inf
        d = x - x[at]
        weight = np.round(np.maximum(np.sqrt(np.einsum("ij,ij->i", d, d)), np.maximum(core, core[at])), DIGITS)
        nearer = ~inside & (weight < best)
        best[nearer], by[nearer] = weight[nearer], at
        at = int(best.argmin())
        a[k], b[k], w[k] = by[at], at, best[at]
    return a, b, w


def _edges(ids: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"w": w, "a": np.minimum(ids[a], ids[b]), "b": np.maximum(ids[a], ids[b])})


def _link(x: np.ndarray, y: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> tuple[int, int, float]:
    """A light link between two slices: the lightest as far as a matrix product tells, and its weight."""
    centre = x.mean(axis=0)
    p, q = x - centre, y - centre
    d = np.sqrt(np.maximum((p * p).sum(axis=1)[:, None] + (q * q).sum(axis=1)[None, :] - 2 * (p @ q.T), 0))
    i, j = np.unravel_index(int(np.maximum(d, np.maximum(cx[:, None], cy[None, :])).argmin()), d.shape)
    d = measured(x, y, np.array([i]), np.array([j]))[0]
    return int(i), int(j), round(float(max(d, cx[i], cy[j])), DIGITS)


def _slice_trees(rows: DataFrame) -> DataFrame:
    """w, a, b: the trees of each block's slices, and a light link from every slice to the next and every block to the next."""
    size = TREE_ROWS
    sent = rows.withColumn("at", F.explode(F.array_compact(F.array(F.col("blk"), F.when(F.col("blk") > 0, F.col("blk") - 1)))))

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        at, gaps = int(pdf["at"].iat[0]), stacked(pdf["gaps"])
        ring = gaps.argmin(axis=1)
        order = np.lexsort((pdf["rep"].to_numpy(), gaps[np.arange(len(gaps)), ring], ring, pdf["blk"].to_numpy()))
        inside = int((pdf["blk"] == at).sum())
        pdf = pdf.iloc[order[:inside + size]]
        ids, x, core = pdf["rep"].to_numpy(), stacked(pdf["vec"]), pdf["core"].to_numpy()
        cuts = [*range(0, inside, size), *([inside] if len(pdf) > inside else []), len(pdf)]
        out = [pd.DataFrame({"w": [], "a": [], "b": []})]
        for s, e, after in zip(cuts, cuts[1:], [*cuts[2:], None]):
            if s < inside:
                out.append(_edges(ids[s:e], *tree_of(x[s:e], core[s:e])))
                if after is not None:
                    i, j, w = _link(x[s:e], x[e:after], core[s:e], core[e:after])
                    out.append(_edges(ids, np.array([s + i]), np.array([e + j]), np.array([w])))
        return pd.concat(out[1:] or out)

    return sent.groupBy("at").applyInPandas(own, "w double, a long, b long")


def _limits(first: DataFrame, reps: DataFrame, count: int) -> DataFrame:
    """rep, limit: the weight at which each row meets the part of the first tree that holds most rows (none: infinite).

    Merges of more than half the rows lie on one path to the top; two rows meet at the higher of those that they reach, or below."""
    lightest, merged = contracted(first)
    merges, leaves = merge_tree(reps.select(F.col("rep").alias("v"), F.lit(1).cast("long").alias("weight")), lightest, merged)
    large = F.col("size") * 2 > count
    top = follow(merges.select(F.col("e").alias("node"), F.when(large, F.col("e")).otherwise(F.coalesce("up", "e")).alias("to")))
    reached = merges.where(large).select(F.col("e").alias("to"), F.col("w").alias("limit"))
    return leaves.join(top.withColumnRenamed("node", "e"), "e").join(reached, "to").select(F.col("v").alias("rep"), "limit")


def candidate_edges(b: Blocks, core: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """w, a, b: edges among which the minimum spanning tree of the vectors is; at most (rows - 1) for each pair of blocks, and the
    first tree's. ``near`` (rep, dist, who), if known, makes the first tree lighter."""
    rows = b.rows.join(core, "rep")
    first = _slice_trees(rows)
    if near is not None:
        other = core.select(F.col("rep").alias("who"), F.col("core").alias("c2"))
        links = near.where("rep <> who").join(core, "rep").join(other, "who")
        first = first.unionByName(links.select(F.round(F.greatest("dist", "core", "c2"), DIGITS).alias("w"), F.col("rep").alias("a"), F.col("who").alias("b")))
    first = cut_lineage(first)
    count = b.reps.count()
    if first.isEmpty() or (b.count == 1 and count <= TREE_ROWS):
        return first
    if count <= FEW_ROWS:
        limits = core.select("rep").distinct().crossJoin(first.agg(F.max("w").alias("limit")))
    else:
        limits = _limits(first, b.reps, count)
    rows = cut_lineage(rows.join(limits, "rep", "left").withColumn("reach", F.coalesce("limit", F.lit(float("inf")))).drop("limit"))

    def wanted(bounds, have, s):
        least = np.maximum(bounds, np.maximum(have["core"][:, None], s.core[None, :]))
        return least - 10.0 ** -DIGITS < np.maximum(have["reach"][:, None], s.reach[None, :])

    gathered = FOREST_PAIRS

    def forest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        x, y, ia, ib = stacked(left["vec"]), stacked(right["vec"]), left["rep"].to_numpy(), right["rep"].to_numpy()
        ca, cb, la, lb = (p[c].to_numpy() for c in ("core", "reach") for p in (left, right))
        same = left["blk"].iat[0] == right["blk"].iat[0]
        after = 0 if same else len(left)
        parts, size = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0

        def thinned():
            i, j, w = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(w, kind="stable")
            kept = order[spanning(after + len(right), i[order], j[order] + after)[0]]
            return i[kept], j[kept], w[kept]

        for i, j in close_pairs(x, y, la + 10.0 ** -DIGITS, lb + 10.0 ** -DIGITS):
            c, most = np.maximum(ca[i], cb[j]), np.maximum(la[i], lb[j])
            ok = c - 10.0 ** -DIGITS < most
            if same:
                ok &= i < j
            i, j, c, most = i[ok], j[ok], c[ok], most[ok]
            w = np.round(np.maximum(measured(x, y, i, j), c), DIGITS)
            ok = w < most
            parts.append((i[ok], j[ok], w[ok]))
            size += len(parts[-1][0])
            if size > gathered:
                parts, size = [thinned()], 0
        i, j, w = thinned()
        return pd.DataFrame({"w": w, "a": np.minimum(ia[i], ib[j]), "b": np.maximum(ia[i], ib[j])})

    sent = routed(rows, summaries(rows, b.count, b.pivots), wanted, own_pair=True)
    return first.unionByName(per_pair(sent, forest, "w double, a long, b long"))


def follow(links: DataFrame) -> DataFrame:
    """(node, to): where the pointers of (node, to) end. Ends point to themselves. Written."""
    now = cut_lineage(links.select("node", "to"))
    while True:
        step = now.select(F.col("node").alias("to"), F.col("to").alias("t2"))
        for _ in range(3):
            now = now.join(step, "to").select("node", F.col("t2").alias("to"))
        new = cut_lineage(now.join(step, "to").select("node", "to", (F.col("t2") != F.col("to")).alias("goes_on")))
        drop_cut(step)
        now = new.select("node", "to")
        if new.where("goes_on").isEmpty():
            return now


def contracted(edges: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per Borůvka round: (c, w, a, b), the lightest edge of every component; and (c, sup), the component it is merged into."""
    now = cut_lineage(edges.select("w", "a", "b", F.col("a").alias("ca"), F.col("b").alias("cb")))
    lightest, merged = [], []
    while True:
        ends = now.select(F.col("ca").alias("c"), F.struct("w", "a", "b", F.col("cb").alias("o")).alias("m")).unionByName(
            now.select(F.col("cb").alias("c"), F.struct("w", "a", "b", F.col("ca").alias("o")).alias("m")))
        best = cut_lineage(ends.groupBy("c").agg(F.min("m").alias("m")).select("c", "m.w", "m.a", "m.b", "m.o"))
        if best.isEmpty():
            return lightest, merged
        other = best.select(F.col("c").alias("o"), F.col("a").alias("a2"), F.col("b").alias("b2"))
        first = (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2")) & (F.col("c") < F.col("o"))
        root = follow(best.join(other, "o").select(F.col("c").alias("node"), F.when(first, F.col("c")).otherwise(F.col("o")).alias("to")))
        lightest.append(best.drop("o"))
        merged.append(root.toDF("c", "sup"))
        left = (now.join(root.toDF("ca", "ra"), "ca").join(root.toDF("cb", "rb"), "cb").where("ra <> rb")
                .groupBy(F.least("ra", "rb").alias("ca"), F.greatest("ra", "rb").alias("cb")).agg(F.min(F.struct("w", "a", "b")).alias("m")))
        new = cut_lineage(left.select("m.w", "m.a", "m.b", "ca", "cb"))
        drop_cut(now)
        now = new


def mutual_reachability_mst(points: DataFrame, core: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                            block_size: int | None = None) -> DataFrame:
    """Minimum spanning tree (a, b, weight) of the mutual-reachability graph. Copies of a vector hang on its smallest id."""
    b = blocked(points, id_col, vec_col, block_size)
    cores = core.select(F.col(id_col).alias("rep"), "core").join(b.reps.select("rep"), "rep")
    lightest, _ = contracted(candidate_edges(b, cores))
    out = b.ids.where("id <> rep").join(cores, "rep").select(F.col("rep").alias("a"), F.col("id").alias("b"), F.round("core", DIGITS).alias("weight"))
    for best in lightest:
        out = out.unionByName(best.select("a", "b", F.col("w").alias("weight")).distinct())
    return out


# ---- merge tree ----------------------------------------------------------------------

def running(df: DataFrame, place: str, value: str, how, none) -> DataFrame:
    """place, out: ``how`` (sum or max) of ``value`` over the rows up to each place; places are numbered without gaps."""
    rows = df.select(F.col(place).alias("place"), F.col(value).alias("v"), (F.col(place) / SLICE).cast("long").alias("slice"))
    upto = Window.partitionBy("slice").orderBy("place")
    per = rows.groupBy("slice").agg(how("v").alias("v"))
    before = per.select("slice", how("v").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    inside = rows.withColumn("own", how("v").over(upto)).join(before, "slice")
    both = F.coalesce("own", F.lit(none)) + F.coalesce("before", F.lit(none)) if how is F.sum else F.greatest("own", "before")
    return inside.select(F.col("place").alias(place), both.alias("out"))


def merge_tree(weights: DataFrame, lightest: list[DataFrame], merged: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Merges (e, w, size, up) and leaves (v, weight, e) of the tree whose rounds are given.

    ``weights`` (v, weight) are the points a vertex stands for. Merges are numbered from 1, ``up`` is the merge above (null at
    the top), a leaf's ``e`` the merge that it first takes part in. Both written."""
    rounds = len(lightest)
    stopped, climbing = None, None
    for t in range(1, rounds + 1):
        chosen = lightest[t - 1].join(merged[t - 1], "c").select("w", "a", "b", F.col("sup").alias("at")).distinct()
        climbing = chosen if climbing is None else climbing.unionByName(chosen)
        if t == rounds:
            done = climbing.select("w", "a", "b", F.lit(t).alias("kt"), F.col("at").alias("ks"), F.lit(None).cast("long").alias("fa"),
                                   F.lit(None).cast("long").alias("fb"))
        else:
            step = lightest[t].join(merged[t], "c").select(F.col("c").alias("at"), F.struct("w", "a", "b").alias("f"), "sup")
            moved = cut_lineage(climbing.join(step, "at").withColumn("stops", F.struct("w", "a", "b") < F.col("f")))
            done = moved.where("stops").select("w", "a", "b", F.lit(t).alias("kt"), F.col("at").alias("ks"), F.col("f.a").alias("fa"),
                                               F.col("f.b").alias("fb"))
            climbing = moved.where("not stops").select("w", "a", "b", F.col("sup").alias("at"))
        stopped = done if stopped is None else stopped.unionByName(done)
    nodes = cut_lineage(balanced_row_number(stopped, [], ["kt", "ks", "w", "a", "b"], "e"))
    place = nodes.select(F.col("a").alias("fa"), F.col("b").alias("fb"), F.col("e").alias("pe"), F.col("kt").alias("pt"), F.col("ks").alias("pk"))
    leaves = cut_lineage(weights.join(lightest[0].select(F.col("c").alias("v"), F.col("a").alias("fa"), F.col("b").alias("fb")), "v")
                         .join(place, ["fa", "fb"]).select("v", "weight", F.col("pe").alias("e"), "pt", "pk"))
    chains = nodes.groupBy("kt", "ks").agg(F.min("e").alias("first"), F.max("e").alias("last"), F.first("fa").alias("fa"), F.first("fb").alias("fb"))
    held = leaves.groupBy(F.col("pt").alias("kt"), F.col("pk").alias("ks")).agg(F.sum("weight").alias("held"))
    chains = cut_lineage(chains.join(place, ["fa", "fb"], "left").join(held, ["kt", "ks"], "left"))
    totals = None
    for t in range(1, rounds + 1):  # chains hang on chains of later rounds only
        own = chains.where(F.col("kt") == t).withColumn("total", F.coalesce("held", F.lit(0)))
        if totals is not None:
            below = totals.groupBy(F.col("pt").alias("kt"), F.col("pk").alias("ks")).agg(F.sum("total").alias("below"))
            own = own.join(below, ["kt", "ks"], "left").withColumn("total", F.col("total") + F.coalesce("below", F.lit(0)))
        own = cut_lineage(own.select("pe", "pt", "pk", "total"))
        totals = own if totals is None else totals.unionByName(own)
    hangs = leaves.select("e", F.col("weight").alias("n")).unionByName(totals.where("pe is not null").select(F.col("pe").alias("e"), F.col("total").alias("n")))
    nodes = nodes.select("e", "w").join(hangs.groupBy("e").agg(F.sum("n").alias("n")), "e").join(
        chains.select(F.col("first").alias("e"), F.lit(True).alias("is_first")), "e", "left").join(
        chains.select(F.col("last").alias("e"), F.lit(True).alias("is_last"), "pe"), "e", "left")
    nodes = cut_lineage(nodes)
    summed = cut_lineage(nodes.join(running(nodes, "e", "n", F.sum, 0).withColumnRenamed("out", "upto"), "e")
                         .withColumn("base", F.when(F.col("is_first"), F.col("upto") - F.col("n"))))
    sized = summed.join(running(summed, "e", "base", F.max, 0), "e")
    up = F.when(F.col("is_last"), F.col("pe")).otherwise(F.col("e") + 1)
    return cut_lineage(sized.select("e", "w", (F.col("upto") - F.col("out")).alias("size"), up.alias("up"))), leaves.select("v", "weight", "e")


def joined_merges(merges: DataFrame, leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same with merges of equal weight that touch taken as one."""
    above = merges.select(F.col("e").alias("up"), F.col("w").alias("wu"))
    linked = merges.join(above, "up", "left")
    top = follow(linked.select(F.col("e").alias("node"), F.when(F.col("wu") == F.col("w"), F.col("up")).otherwise(F.col("e")).alias("to")))
    tops = merges.join(top.where("node = to").select(F.col("node").alias("e")), "e")
    out = tops.join(top.toDF("up", "to"), "up", "left").select("e", "w", "size", F.col("to").alias("up"))
    return cut_lineage(out), leaves.join(top.toDF("e", "to"), "e").select("v", "weight", F.col("to").alias("e"))


# ---- clusters ------------------------------------------------------------------------

def cluster_tree(merges: DataFrame, leaves: DataFrame, min_cluster_size: int) -> tuple[DataFrame, DataFrame]:
    """Clusters (c, parent, stability) and (v, c): the smallest cluster around each leaf. Both written."""
    inverse = lambda w: F.lit(1.0) / F.greatest(w, F.lit(LEAST))
    big = merges.where(F.col("size") >= min_cluster_size)
    kids = big.groupBy("up").agg(F.count(F.lit(1)).alias("kids"))
    starts = F.col("up").isNull() | (F.col("kids") >= 2)
    own = cut_lineage(big.join(kids, "up", "left").select("e", "w", "size", "up", starts.alias("starts")))
    cluster = follow(own.select(F.col("e").alias("node"), F.when(F.col("starts"), F.col("e")).otherwise(F.col("up")).alias("to"))).toDF("e", "c")
    home = follow(merges.select(F.col("e").alias("node"), F.when(F.col("size") >= min_cluster_size, F.col("e")).otherwise(F.col("up")).alias("to")))
    where = leaves.join(home.toDF("e", "big"), "e").select("v", "weight", F.col("big").alias("e"))
    where = cut_lineage(where.join(cluster, "e").join(own.select("e", "w"), "e").select("v", "weight", "c", inverse(F.col("w")).alias("leaves")))
    above = own.select(F.col("e").alias("up"), F.col("w").alias("wu")).join(cluster.toDF("up", "parent"), "up")
    born = cut_lineage(own.where("starts").join(above, "up", "left")
                       .select(F.col("e").alias("c"), "size", "parent", F.coalesce(inverse(F.col("wu")), F.lit(0.0)).alias("birth")))
    parts = (where.select("c", (F.col("weight") * F.col("leaves")).alias("s"))
             .unionByName(born.where("parent is not null").select(F.col("parent").alias("c"), (F.col("size") * F.col("birth")).alias("s")))
             .unionByName(born.select("c", (-F.col("size") * F.col("birth")).alias("s"))))
    # sums in exact decimals would need bounds on 1 / distance; doubles are added in any order
    stable = parts.groupBy("c").agg(F.sum("s").alias("stability"))
    return cut_lineage(born.join(stable, "c").select("c", "parent", "stability")), where.select("v", "c")


def chosen_clusters(tree: DataFrame) -> DataFrame:
    """(c, chosen): the chosen cluster that each cluster lies in (null: none), by excess of mass; the root is never chosen."""
    null = F.lit(None)
    now = cut_lineage(tree.select("c", "parent", F.col("stability").alias("s"), null.cast("double").alias("best"), null.cast("double").alias("fa"),
                                  null.cast("double").alias("fb"), null.cast("long").alias("next")))
    while True:
        kids = now.where("parent is not null").groupBy(F.col("parent").alias("c")).agg(
            F.sum("best").alias("sum"), F.count(F.when(F.col("best").isNull(), 1)).alias("open"), F.max(F.when(F.col("best").isNull(), F.col("c"))).alias("one"))
        n = now.join(kids, "c", "left")
        total = F.coalesce("sum", F.lit(0.0))
        settled = F.when(F.coalesce("open", F.lit(0)) == 0, F.when(F.col("open").isNull(), F.col("s")).otherwise(F.greatest("s", total)))
        waits = (F.col("open") == 1) & F.col("next").isNull()
        n = n.select("c", "parent", "s", F.coalesce("best", settled).alias("best"), F.when(waits, F.col("s")).otherwise(F.col("fa")).alias("fa"),
                     F.when(waits, total).otherwise(F.col("fb")).alias("fb"), F.when(waits, F.col("one")).otherwise(F.col("next")).alias("next"))
        o = n.select(F.col("c").alias("next"), F.col("best").alias("ob"), F.col("fa").alias("oa"), F.col("fb").alias("of"), F.col("next").alias("on"))
        idle, busy = n.where("best is not null or next is null"), n.where("best is null and next is not null").join(o, "next")
        busy = busy.select("c", "parent", "s", F.greatest("fa", F.col("fb") + F.col("ob")).alias("_b"), "fa", "fb", "next", "ob", "oa", "of", "on")
        busy = busy.select("c", "parent", "s", F.when(F.col("ob").isNotNull(), F.col("_b")).alias("best"),
                           F.when(F.col("on").isNull(), F.col("fa")).otherwise(F.greatest("fa", F.col("fb") + F.col("oa"))).alias("fa"),
                           F.when(F.col("on").isNull(), F.col("fb")).otherwise(F.col("fb") + F.col("of")).alias("fb"), F.coalesce("on", "next").alias("next"))
        new = cut_lineage(idle.unionByName(busy))
        drop_cut(now)
        now = new
        if now.where("best is null").isEmpty():
            break
    total = now.groupBy(F.col("parent").alias("c")).agg(F.sum("best").alias("sum"))
    picked = F.col("parent").isNotNull() & (F.col("sum").isNull() | (F.col("s") >= F.col("sum")))
    # the highest picked cluster on the way up, by pointer doubling
    up = cut_lineage(now.join(total, "c", "left").select("c", F.when(picked, F.col("c")).alias("chosen"), F.col("parent").alias("up")))
    while not up.where("up is not null").isEmpty():
        o = up.select(F.col("c").alias("up"), F.col("chosen").alias("higher"), F.col("up").alias("up2"))
        two = up.join(o, "up", "left").select("c", F.coalesce("higher", "chosen").alias("chosen"), F.col("up2").alias("up"))
        new = cut_lineage(two.join(o, "up", "left").select("c", F.coalesce("higher", "chosen").alias("chosen"), F.col("up2").alias("up")))
        drop_cut(up)
        up = new
    return up.select("c", "chosen")


def hierarchy_labels(points: DataFrame, min_samples: int = 2, min_cluster_size: int = 3, id_col: str = "vec_id",
                     vec_col: str = "embedding", block_size: int | None = None) -> DataFrame:
    """O-C3: (id, label) of the most stable non-overlapping clusters; noise -1. A label is the smallest id of its cluster.

    Points with a null id or vector take no part; with fewer than ``min_cluster_size`` (or ``min_samples`` + 1, or 2) points all are
    noise. Equal vectors are points at distance 0; distances under 1e-12 count as 1e-12 where they are inverted."""
    spark = points.sparkSession
    with scratch_cuts(spark) as keep:
        b = blocked(points, id_col, vec_col, block_size)
        all_noise = b.ids.select(F.col("id").alias(id_col), F.lit(-1).cast("long").alias("label"))
        if b.ids.limit(max(min_cluster_size, min_samples + 1, 2)).count() < max(min_cluster_size, min_samples + 1, 2):
            return keep(all_noise)
        near, core = near_and_cores(b, min_samples)
        # the second id of a vector stands for all its copies: they meet at the core distance
        second = cut_lineage(b.ids.where("id <> rep").groupBy("rep").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("weight")))
        copies = second.join(core, "rep").select(F.round("core", DIGITS).alias("w"), F.col("rep").alias("a"), "b")
        weights = b.reps.select(F.col("rep").alias("v"), F.lit(1).cast("long").alias("weight")).unionByName(second.select(F.col("b").alias("v"), "weight"))
        lightest, merged = contracted(candidate_edges(b, core, near).unionByName(copies))
        merges, leaves = joined_merges(*merge_tree(weights, lightest, merged))
        tree, where = cluster_tree(merges, leaves, min_cluster_size)
        chosen = chosen_clusters(tree)
        vertex = b.ids.join(second.select("rep", "b"), "rep", "left").select("id", F.when(F.col("id") == F.col("rep"), F.col("rep")).otherwise(F.col("b")).alias("v"))
        found = cut_lineage(vertex.join(where, "v").join(chosen, "c", "left").select("id", "chosen"))
        names = found.where("chosen is not null").groupBy("chosen").agg(F.min("id").alias("label"))
        return keep(found.join(names, "chosen", "left").select(F.col("id").alias(id_col), F.coalesce("label", F.lit(-1).cast("long")).alias("label")))
