"""Vectors dealt into blocks by pivots, and exact block-against-block work that skips what the bounds rule out.

Equal vectors are one row (``rep``, the smallest id, and their number). A bounded sample gives the pivots; every row keeps its
distances to all of them (``gaps``). Rows are ordered by nearest pivot and distance to it and cut into blocks of equal size, so
no block depends on how dense a region is. A block's summary is the range of its gaps: by the triangle inequality a row at gap g from a pivot
is at least ``max(lo - g, g - hi)`` away from every row of a block with gaps in [lo, hi]. ``routed`` sends a row to a pair of blocks
only if that bound lets it matter there; a pair of blocks is one group of at most two blocks' rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notesmith.operators.ranking import balanced_row_number
from notesmith.session import cut_lineage, ship_package

#: Most rows of a block, fewest that are worth a block of their own, pivots, and rows of the sample they are picked from.
MOST_ROWS, FEWEST_ROWS, PIVOTS, SAMPLE = 16384, 64, 16, 1024
#: Summaries that one pass of ``routed`` holds, and bounds that it computes at once.
SUMMARIES, BOUNDS = 1 << 16, 1 << 21
#: Bytes of the difference array that one step of a distance matrix may hold.
STEP_BYTES = 64 << 20
#: Rows and columns of one tile of estimated distances, and pairs that are measured at once.
TILE_ROWS, TILE_COLS, MEASURED = 512, 2048, 4096


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of x and y, sqrt(sum((a - b)^2)) in float64, in steps of bounded size."""
    chunk = max(1, STEP_BYTES // max(1, 8 * y.size))
    out = np.empty((x.shape[0], y.shape[0]), dtype=np.float64)
    for s in range(0, x.shape[0], chunk):
        d = x[s:s + chunk, None, :] - y[None, :, :]
        out[s:s + chunk] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
    return out


def measured(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """What ``distances`` gives for the pairs (i, j) of rows of x and y."""
    out = np.empty(len(i), np.float64)
    for s in range(0, len(i), MEASURED):
        d = x[i[s:s + MEASURED]] - y[j[s:s + MEASURED]]
        out[s:s + MEASURED] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return out


def close_pairs(x: np.ndarray, y: np.ndarray, most_x: np.ndarray, most_y: np.ndarray):
    """Tiles (i, j) with every pair of rows of x and y at most ``max(most_x[i], most_y[j])`` apart, and a few that are little farther.

    Squared distances of a tile are one product of float32 matrices, of rows taken from their common centre and scaled into
    [-1, 1]; limits are raised by more than rounding can add, so no pair is lost. The pairs are to be ``measured``. Rows with
    components that are not finite are near nothing. A limit below 0 asks for nothing."""
    fx, fy = np.nonzero(np.isfinite(x).all(axis=1))[0], np.nonzero(np.isfinite(y).all(axis=1))[0]
    if not len(fx) or not len(fy) or not x.shape[1]:
        if len(fx) and len(fy):  # vectors without components are all equal
            i, j = np.nonzero(np.maximum(most_x[:, None], most_y[None, :]) >= 0)
            yield i, j
        return
    top = max(float(np.abs(x[fx]).max()), float(np.abs(y[fy]).max())) or 1.0
    centre = (y[fy] / top).mean(axis=0)

    def shifted(rows: np.ndarray, most: np.ndarray):
        a = rows / top - centre
        norm = np.einsum("ij,ij->i", a, a)
        # rounding of the sum of dim + 2 products in float32, and of shifted components in float64
        slack = (a.shape[1] + 8) * 2.0 ** -21 * norm + 1e-14 * np.sqrt(a.shape[1] * norm) + 1e-29 * a.shape[1]
        with np.errstate(over="ignore"):
            limit = np.where(most < 0, -np.inf, (np.maximum(most, 0) / top) ** 2 * (1 + 1e-6))
        return a, norm, slack, limit

    ax, nx, sx, lx = shifted(x[fx], most_x[fx])
    ay, ny, sy, ly = shifted(y[fy], most_y[fy])
    # estimates are lowered by the slack of both rows: (|a|^2 - slack) + (|b|^2 - slack) - 2 ab
    left = np.column_stack([ax, nx - sx, np.ones(len(ax))]).astype(np.float32)
    right = np.ascontiguousarray(np.column_stack([-2 * ay, np.ones(len(ay)), ny - sy]).astype(np.float32).T)
    with np.errstate(over="ignore"):
        lx, ly = lx.astype(np.float32), ly.astype(np.float32)
    for r in range(0, len(fx), TILE_ROWS):
        for c in range(0, len(fy), TILE_COLS):
            est = left[r:r + TILE_ROWS] @ right[:, c:c + TILE_COLS]
            near = est <= lx[r:r + TILE_ROWS, None]
            near |= est <= ly[None, c:c + TILE_COLS]
            at = np.flatnonzero(near)
            if len(at):
                i, j = np.divmod(at, near.shape[1])
                yield fx[i + r], fy[j + c]


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, component of each vertex): the links (i, j) of vertices 0 .. n - 1 that make up a spanning forest, earlier ones
    preferred; of links in order of weight, the minimum spanning forest. Each component takes its first link in every round."""
    comp, left, kept = np.arange(n), np.nonzero(i != j)[0], []
    while len(left):
        a, b = comp[i[left]], comp[j[left]]
        differ = a != b
        left, a, b = left[differ], a[differ], b[differ]
        if not len(left):
            break
        first = np.full(n, len(left))
        np.minimum.at(first, a, np.arange(len(left)))
        np.minimum.at(first, b, np.arange(len(left)))
        c = np.nonzero(first < len(left))[0]
        pick = first[c]
        up = np.arange(n)
        up[c] = np.where(a[pick] == c, b[pick], a[pick])
        both = (up[up[c]] == c) & (c < up[c])
        up[c[both]] = c[both]
        while True:
            higher = up[up]
            if (higher == up).all():
                break
            up = higher
        comp = up[comp]
        kept.append(left[np.unique(pick)])
    return (np.sort(np.concatenate(kept)) if kept else np.zeros(0, np.int64)), comp


def stacked(col: pd.Series) -> np.ndarray:
    return np.array(col.to_list(), dtype=np.float64).reshape(len(col), -1)


@dataclass
class Blocks:
    """``ids``: id, rep of every point; ``reps``: rep, mult; ``rows``: rep, mult, vec, gaps, blk; ``count`` blocks, ``pivots`` gaps a
    row. ``vec`` is of floats if the points' vectors are, else of doubles."""

    ids: DataFrame
    reps: DataFrame
    rows: DataFrame
    count: int
    pivots: int = 0


def _pivots(points: DataFrame, k: int, sample: int) -> np.ndarray:
    """Pivots picked far from each other out of a bounded sample, in an order that keeps near ones together."""
    few = points.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").collect()
    x = np.array([r["vec"] for r in few], np.float64).reshape(len(few), -1)
    picked, far = [0], distances(x, x[:1])[:, 0]
    while len(picked) < k and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, distances(x, x[picked[-1:]])[:, 0])
    chain, left = [picked[0]], picked[1:]
    while left:
        nxt = min(left, key=lambda p: float(((x[p] - x[chain[-1]]) ** 2).sum()))
        chain.append(nxt)
        left.remove(nxt)
    return x[chain]


def blocked(points: DataFrame, id_col: str, vec_col: str, block_size: int | None = None, pivots: int = PIVOTS, sample: int = SAMPLE) -> Blocks:
    """The points in blocks. Rows with a null id or vector take no part. Vectors are equally long.

    Equal vectors are told by 96 bits of two hashes. ``block_size`` is set by the number of rows if not given: as many blocks
    as give every core some pairs, none above ``MOST_ROWS``."""
    spark = points.sparkSession
    ship_package(spark)
    vec = dict(points.dtypes).get(vec_col)
    vec = vec if vec == "array<float>" else "array<double>"
    pts = points.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(vec).alias("vec")).dropna()
    keyed = pts.select("id", "vec", F.xxhash64("vec").alias("k1"), F.hash("vec").alias("k2"))
    classes = cut_lineage(keyed.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult")))
    n = classes.count()
    ids = keyed.drop("vec").join(classes, ["k1", "k2"]).select("id", "rep")
    if not n:
        return Blocks(ids, classes.select("rep", "mult"), spark.createDataFrame([], f"rep long, mult long, vec {vec}, gaps array<double>, blk long"), 0)
    chosen = _pivots(pts, pivots, sample)
    at = spark.sparkContext.broadcast(chosen)

    def measure(batches):
        p = at.value
        for b in batches:
            if b.num_rows:
                gaps = distances(np.asarray(b.column("vec").flatten(), np.float64).reshape(b.num_rows, -1), p)
                ring = gaps.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("rep"), b.column("mult"), b.column("vec"),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(gaps) + 1) * len(p), pa.int32()), pa.array(gaps.ravel())),
                     pa.array(ring, pa.int32()), pa.array(gaps[np.arange(len(gaps)), ring])],
                    ["rep", "mult", "vec", "gaps", "ring", "radius"])

    own = pts.withColumnRenamed("id", "rep").join(classes.select("rep", "mult"), "rep").select("rep", "mult", "vec")
    measured = own.mapInArrow(measure, f"rep long, mult long, vec {vec}, gaps array<double>, ring int, radius double")
    if block_size is None:
        wanted = math.ceil(math.sqrt(8 * spark.sparkContext.defaultParallelism))
        block_size = max(1, min(MOST_ROWS, max(FEWEST_ROWS, math.ceil(n / wanted))))
    ranked = balanced_row_number(measured, [], ["ring", "radius", "rep"], "rn")
    rows = ranked.select("rep", "mult", "vec", "gaps", F.expr(f"(rn - 1) div {block_size}").alias("blk"))
    return Blocks(ids, classes.select("rep", "mult"), rows, math.ceil(n / block_size), len(chosen))


@dataclass
class Summary:
    """Ranges of the gaps of blocks ``first`` .. ``first + len(lo) - 1``, and the largest ``reach`` and least ``core`` of their rows."""

    first: int
    lo: np.ndarray
    hi: np.ndarray
    reach: np.ndarray
    core: np.ndarray


def summaries(rows: DataFrame, count: int, pivots: int) -> list[Summary]:
    """Summaries of all blocks, ``SUMMARIES`` at a time (one small row per block). Rows have ``reach`` and ``core``."""
    own = rows.groupBy("blk").agg(F.max("reach").alias("reach"), F.min("core").alias("core"),
                                  F.array(*[F.min(F.col("gaps")[g]) for g in range(pivots)]).alias("lo"),
                                  F.array(*[F.max(F.col("gaps")[g]) for g in range(pivots)]).alias("hi"))
    own = cut_lineage(own) if count > SUMMARIES else own  # read once per part
    out = []
    for first in range(0, count, SUMMARIES):
        some = {r["blk"]: r for r in own.where(F.col("blk").between(first, first + SUMMARIES - 1)).collect()}
        size = min(SUMMARIES, count - first)
        s = Summary(first, np.full((size, pivots), np.inf), np.full((size, pivots), -np.inf), np.full(size, -np.inf), np.full(size, np.inf))
        for b, r in some.items():  # a block without rows is infinitely far
            s.lo[b - first], s.hi[b - first], s.reach[b - first], s.core[b - first] = r["lo"], r["hi"], r["reach"], r["core"]
        out.append(s)
    return out


def lower_bounds(gaps: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least distance of rows with these gaps to blocks with these ranges, less what rounding may add."""
    out = np.zeros((len(gaps), len(lo)))
    for g in range(gaps.shape[1]):
        np.maximum(out, lo[None, :, g] - gaps[:, None, g], out=out)
        np.maximum(out, gaps[:, None, g] - hi[None, :, g], out=out)
    return out - 1e-12 * (1 + gaps.max(axis=1, initial=0.0))[:, None]


def routed(rows: DataFrame, parts: list[Summary], wanted: Callable, own_pair: bool) -> DataFrame:
    """Each row once for every pair of blocks (b1 <= b2) that it matters in; ``own_pair``: also its block with itself.

    ``wanted(bounds, rows, blocks)`` says which (row, block) entries matter, from the bounds, the rows' ``blk``, ``reach`` and ``core``
    (as a dict of arrays) and a ``Summary``. Rows have the columns of ``Blocks.rows``, reach and core, and keep all but their gaps."""
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c != "gaps"]  # of no use in a pair
    out = None
    for k, part in enumerate(parts):
        shared = spark.sparkContext.broadcast(part)

        def send(batches, own=own_pair and k == 0, shared=shared):
            s = shared.value
            step = max(1, BOUNDS // len(s.lo))
            for whole in batches:
                for at in range(0, whole.num_rows, step):
                    b = whole.slice(at, step)
                    blk = b.column("blk").to_numpy()
                    gaps = np.asarray(b.column("gaps").flatten()).reshape(b.num_rows, -1)
                    have = {"blk": blk, "reach": b.column("reach").to_numpy(), "core": b.column("core").to_numpy()}
                    need = wanted(lower_bounds(gaps, s.lo, s.hi), have, s)
                    inside = (blk >= s.first) & (blk < s.first + len(s.lo))
                    need[np.nonzero(inside)[0], blk[inside] - s.first] = False
                    i, j = np.nonzero(need)
                    other = j + s.first
                    if own:
                        i, other = np.concatenate([i, np.arange(len(blk))]), np.concatenate([other, blk])
                    mine = blk[i]
                    picked = b.select(kept).take(pa.array(i))
                    yield pa.RecordBatch.from_arrays(
                        [*picked.columns, pa.array(np.minimum(mine, other)), pa.array(np.maximum(mine, other))], [*kept, "b1", "b2"])

        schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n in kept) + ", b1 long, b2 long"
        sent = rows.mapInArrow(send, schema)
        out = sent if out is None else out.unionByName(sent)
    return out


def per_pair(sent: DataFrame, kernel: Callable, schema: str) -> DataFrame:
    """``kernel(left, right)`` for every pair of blocks with rows on both sides (the same rows twice for a block with itself)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        b1, b2 = int(pdf["b1"].iat[0]), int(pdf["b2"].iat[0])
        pdf = pdf.sort_values("rep")
        left, right = pdf[pdf["blk"] == b1], pdf[pdf["blk"] == b2]
        found = kernel(left, right) if len(left) and len(right) else None
        return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")}) if found is None else found

    return sent.groupBy("b1", "b2").applyInPandas(run, schema)
