"""Hard negatives by angular triangle filtering.

Vectors are integer after quantisation. Every row stores its norm and its angles to a few reference directions. The angle
between an anchor a and a row x lies between the largest |angle(a, r) - angle(x, r)| and the smallest
min(angle(a, r) + angle(x, r), 2 pi - the sum) over the references r, so the cosines of those two bounds, times both norms
and widened by more than any rounding, enclose the integer score. Only pairs whose interval can still matter get it exactly:

1. ``vectors`` writes the rows that take part with norm and angles, dealt by their nearest reference and sorted by the angle to
   it, so that neighbouring rows share tight angle ranges. Whole chunks of rows are ruled out by those ranges before single rows are.
2. Positives: anchors are broadcast in blocks of ``ANCHORS``; every task keeps a heap of the best rows of the anchor's label and
   scores a row only if its upper bound reaches the heap's worst score. Heaps of tasks are merged.
3. Negatives: every positive's score opens a window below it. A row of another label is scored only if its interval overlaps a
   window, whose lower end rises with the heap it fills. Heaps are merged again.

No pair is left out by the filter, so the results are those of scoring every pair.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notesmith.llm.common import only, ship
from notesmith.llm.reversed_search import first_per_key, merged
from notesmith.session import cut_lineage, load_table

#: Every how many ids an anchor stands, positives of an anchor, negatives of a positive, least score in percent of the positive's.
EVERY, POSITIVES, NEGATIVES, LEAST = 100, 5, 5, 80
#: Reference directions, rows of the bounded sample that they are picked from, and anchors of a block (what is broadcast).
DIRECTIONS, SAMPLE, ANCHORS = 8, 4096, 2048
#: Rows whose angle ranges are tested together, and numbers that a task multiplies at once.
CHUNK, STEP = 256, 1 << 21
#: Angles are exact to far less than this (radians), and products to far less than this share of the norms.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
#: Squared norms stay below this, so that every score fits in 64 bits.
MAX_SQUARE = float(1 << 62)


def relabelled(vec_id: Column, label: Column) -> Column:
    """Labels that stand one too high on every seventh row (a stand-in for label noise)."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def quantised(table: DataFrame) -> DataFrame:
    """vec_id, label, q (array<long>: floor(256 x) of each component as double) of the rows that take part."""
    t = only(table, "vec_id", "embedding", "label")
    x = F.col("embedding")
    whole = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == F.lit(math.inf)))
    label = relabelled(F.col("vec_id"), F.col("label").cast("long"))
    square = F.aggregate(x, F.lit(0.0), lambda a, v: a + F.pow(F.floor(F.lit(256.0) * v.cast("double")).cast("double"), F.lit(2.0)))
    t = t.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).where(whole).where(square < MAX_SQUARE)
    return t.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.transform(x, lambda v: F.floor(F.lit(256.0) * v.cast("double")).cast("long")).alias("q"))


def reference_directions(rows: DataFrame, k: int = DIRECTIONS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Unit vectors per dimension: picked from ``sample`` rows with the least hashes, each the row that is farthest in angle
    from those before it. They only decide how tight the intervals are."""
    few = rows.where(F.size("q") > 0).orderBy(F.xxhash64("q", "vec_id"), "vec_id").limit(sample).select("q").collect()
    out = {}
    for d in sorted({len(r["q"]) for r in few}):
        x = np.array([r["q"] for r in few if len(r["q"]) == d], np.float64)
        norm = np.linalg.norm(x, axis=1)
        x = x[norm > 0] / norm[norm > 0, None]
        picked: list[int] = []
        nearest = np.full(len(x), -1.0)
        while len(picked) < min(k, len(x)):
            at = int(np.argmin(nearest)) if picked else 0
            picked.append(at)
            nearest = np.maximum(nearest, np.abs(x @ x[at]))
            if nearest.min() > 1 - 1e-9:
                break
        out[d] = x[picked]
    return out


def angles_to(q: np.ndarray, norm: np.ndarray, directions: np.ndarray | None) -> np.ndarray:
    """Angles of rows to the directions (a right angle for a zero vector, whose score is 0 whatever the angle)."""
    if directions is None or not len(directions):
        return np.zeros((len(q), 0))
    cos = (q @ directions.T) / np.where(norm > 0, norm, 1.0)[:, None]
    return np.arccos(np.clip(cos, -1.0, 1.0))


def vectors(table: DataFrame, k: int = DIRECTIONS, sample: int = SAMPLE) -> DataFrame:
    """vec_id, label, q, norm, angles (array<double>), written; rows near each other in angle stand near each other."""
    spark = table.sparkSession
    ship(spark)
    rows = cut_lineage(quantised(table))
    shared = spark.sparkContext.broadcast(reference_directions(rows, k, sample))

    def measure(batches):
        for b in batches:
            for part in _by_dimension(b):
                q = _matrix(part.column("q")).astype(np.float64)
                norm = np.sqrt(np.einsum("ij,ij->i", q, q))
                a = angles_to(q, norm, shared.value.get(q.shape[1]))
                near = a.argmin(axis=1) if a.shape[1] else np.zeros(len(q), np.int64)
                least = a.min(axis=1) if a.shape[1] else np.zeros(len(q))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), part.column("q"), pa.array(norm),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(q) + 1) * a.shape[1], pa.int32()), pa.array(a.ravel())),
                     pa.array(near, pa.int32()), pa.array(least)],
                    ["vec_id", "label", "q", "norm", "angles", "near", "least"])

    out = rows.mapInArrow(measure, "vec_id long, label long, q array<long>, norm double, angles array<double>, near int, least double")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(rows.inputFiles()))
    spread = out.repartitionByRange(n, F.size("q"), "near", "least", F.xxhash64("vec_id")).sortWithinPartitions(F.size("q"), "near", "least", "vec_id")
    return cut_lineage(spread.drop("near", "least"))


def _matrix(col) -> np.ndarray:
    return np.asarray(col.flatten()).reshape(len(col), -1)


def _by_dimension(b: pa.RecordBatch):
    """Parts of a batch whose vectors are equally long (rows keep their order)."""
    sizes = np.diff(np.asarray(b.column("q").offsets))
    for d in np.unique(sizes):
        yield b if (sizes == d).all() else b.filter(pa.array(sizes == d))


class _Anchors:
    """Anchors of a block with equally long vectors."""

    def __init__(self, rows: list, keys: list):
        self.keys = np.array(keys, np.int64)  # number within the block
        self.ids = np.array([r["vec_id"] for r in rows], np.int64)
        self.label = np.array([r["label"] for r in rows], np.int64)
        self.q = np.array([r["q"] for r in rows], np.int64).reshape(len(rows), -1)
        self.norm = np.array([r["norm"] for r in rows])
        self.angles = np.array([r["angles"] for r in rows]).reshape(len(rows), -1)


def anchor_blocks(rows: DataFrame, every: int = EVERY, size: int = ANCHORS) -> list[DataFrame]:
    """Anchors in blocks by a hash of the id. Of rows that repeat an anchor's id the one with the least label and vector counts."""
    own = cut_lineage(rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "q", "norm", "angles")).alias("a"))
                      .select("vec_id", "a.*"))
    n = max(1, math.ceil(own.count() / size))
    return [own.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == k) for k in range(n)]


def _collected(block: DataFrame) -> tuple[np.ndarray, dict[int, _Anchors]]:
    """Ids of a block's anchors in order, and the anchors by dimension (bounded by ``ANCHORS``)."""
    rows = sorted(block.collect(), key=lambda r: r["vec_id"])
    by = {}
    for d in sorted({len(r["q"]) for r in rows}):
        keys = [k for k, r in enumerate(rows) if len(r["q"]) == d]
        by[d] = _Anchors([rows[k] for k in keys], keys)
    return np.array([r["vec_id"] for r in rows], np.int64), by


def bounds(a_norm, a_low, a_high, x_norm_low, x_norm_high, x_low, x_high) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible score of anchors (rows) with rows (columns) whose norms and angles lie in the given ranges."""
    shape = (len(a_norm), len(x_norm_low))
    near, far = np.zeros(shape), np.full(shape, math.pi)
    for r in range(a_low.shape[1]):
        lo, hi = x_low[None, :, r], x_high[None, :, r]
        al, ah = a_low[:, None, r], a_high[:, None, r]
        np.maximum(near, np.maximum(al - hi, lo - ah), out=near)
        np.minimum(far, np.minimum(ah + hi, 2 * math.pi - al - lo), out=far)
    top, low = np.cos(np.maximum(near - ANGLE_SLACK, 0.0)), np.cos(np.minimum(far + ANGLE_SLACK, math.pi))
    big, small = a_norm[:, None] * x_norm_high[None, :], a_norm[:, None] * x_norm_low[None, :]
    slack = big * SCORE_SLACK + 1.0
    return np.where(low < 0, big, small) * low - slack, np.where(top > 0, big, small) * top + slack


def _survivors(a: _Anchors, norm: np.ndarray, angles: np.ndarray, wanted) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, row) that ``wanted(anchor numbers, least scores, largest scores)`` lets pass, chunks first, then rows."""
    at = np.arange(0, len(norm), CHUNK)
    reduce = lambda f, x: f.reduceat(x, at, axis=0)
    low, high = bounds(a.norm, a.angles, a.angles, reduce(np.minimum, norm), reduce(np.maximum, norm),
                       reduce(np.minimum, angles), reduce(np.maximum, angles))
    open_ = wanted(np.arange(len(a.ids)), low, high)
    ai, xi = [], []
    for c, start in enumerate(at):
        who = np.nonzero(open_[:, c])[0]
        if not len(who):
            continue
        some = slice(start, start + CHUNK)
        low, high = bounds(a.norm[who], a.angles[who], a.angles[who], norm[some], norm[some], angles[some], angles[some])
        i, j = np.nonzero(wanted(who, low, high))
        ai.append(who[i])
        xi.append(j + start)
    none = np.zeros(0, np.int64)
    return (np.concatenate(ai), np.concatenate(xi)) if ai else (none, none)


def scores_of(a: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of a[i] with x[j]."""
    out = np.empty(len(i), np.int64)
    step = max(1, STEP // max(1, a.shape[1]))
    for s in range(0, len(i), step):
        out[s:s + step] = np.einsum("ij,ij->i", a[i[s:s + step]], x[j[s:s + step]])
    return out


class _Best:
    """Heaps of the ``k`` highest (score, smaller id first) entries, each entry once; ``worst`` is the score to reach."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.heaps, self.worst = k, [[] for _ in floors], floors.copy()

    def offer(self, keys, scores, ids) -> None:
        at = first_per_key(keys, scores, ids, self.k, once=True)
        for h, s, x in zip(keys[at].tolist(), scores[at].tolist(), ids[at].tolist()):
            heap, entry = self.heaps[h], (s, -x)
            if len(heap) < self.k:
                if entry not in heap:
                    heapq.heappush(heap, entry)
            elif entry > heap[0] and entry not in heap:
                heapq.heapreplace(heap, entry)
            else:
                continue
            if len(heap) == self.k:
                self.worst[h] = max(self.worst[h], heap[0][0])

    def batches(self, names: list[str], columns):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        rows = [(*columns(h), -x, s, task) for h, heap in enumerate(self.heaps) for s, x in heap]
        for s in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[s:s + 10_000])], names)


LOWEST = np.iinfo(np.int64).min


def _positives(rows: DataFrame, shared, k: int) -> DataFrame:
    """anchor, vec_id, score, part: the heaps of each task with the best rows of the anchor's label."""
    def stream(batches):
        ids, by = shared.value
        best = _Best(np.full(len(ids), LOWEST), k)
        for b in batches:
            for part in _by_dimension(b):
                a = by.get(len(part.column("q")[0]))
                if a is None:
                    continue
                x, label, q = part.column("vec_id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("q"))
                norm, angles = part.column("norm").to_numpy(), _matrix(part.column("angles"))
                for value in np.intersect1d(label, a.label):
                    mine, theirs = np.nonzero(label == value)[0], np.nonzero(a.label == value)[0]
                    own = _subset(a, theirs)
                    for s in range(0, len(mine), 4 * CHUNK):
                        at = mine[s:s + 4 * CHUNK]
                        i, j = _survivors(own, norm[at], angles[at], lambda who, lo, hi: hi >= best.worst[own.keys[who]][:, None])
                        other = own.ids[i] != x[at][j]
                        i, j = i[other], at[j[other]]
                        score = scores_of(own.q, q, i, j)
                        reach = score >= best.worst[own.keys[i]]
                        best.offer(own.keys[i[reach]], score[reach], x[j[reach]])
        yield from best.batches(["anchor_id", "vec_id", "score", "part"], lambda h: (int(ids[h]),))

    return rows.mapInArrow(stream, "anchor_id long, vec_id long, score long, part long")


def _subset(a: _Anchors, at: np.ndarray) -> _Anchors:
    out = object.__new__(_Anchors)
    for name in ("keys", "ids", "label", "q", "norm", "angles"):
        setattr(out, name, getattr(a, name)[at])
    return out


def _negatives(rows: DataFrame, shared, k: int) -> DataFrame:
    """anchor_id, positive_id, positive_score, vec_id, score, part: per window the best rows of other labels inside it."""
    def stream(batches):
        ids, by, windows = shared.value  # windows: (anchor number, positive, its score, least, most) by anchor
        owner, positive, positive_score, least, most = windows
        best = _Best(least, k)
        first = np.searchsorted(owner, np.arange(len(ids) + 1))
        widest = int(np.diff(first).max()) if len(ids) else 0
        slots = np.minimum(first[:-1, None] + np.arange(max(widest, 1)), max(len(owner) - 1, 0))
        valid = first[:-1, None] + np.arange(max(widest, 1)) < first[1:, None]
        for b in batches if len(owner) else ():
            for part in _by_dimension(b):
                a = by.get(len(part.column("q")[0]))
                if a is None:
                    continue
                x, label, q = part.column("vec_id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("q"))
                norm, angles = part.column("norm").to_numpy(), _matrix(part.column("angles"))

                def overlaps(who, low, high):
                    mine = a.keys[who]
                    out = np.zeros(low.shape, bool)
                    for w in range(widest):
                        at, there = slots[mine, w], valid[mine, w]
                        out |= there[:, None] & (high >= best.worst[at][:, None]) & (low <= most[at][:, None])
                    return out

                for s in range(0, len(x), 4 * CHUNK):
                    some = slice(s, s + 4 * CHUNK)
                    i, j = _survivors(a, norm[some], angles[some], overlaps)
                    j = j + s
                    other = (a.label[i] != label[j]) & (a.ids[i] != x[j])
                    i, j = i[other], j[other]
                    score = scores_of(a.q, q, i, j)
                    for w in range(widest):
                        at, there = slots[a.keys[i], w], valid[a.keys[i], w]
                        hit = there & (score >= best.worst[at]) & (score <= most[at])
                        best.offer(at[hit], score[hit], x[j[hit]])
        yield from best.batches(["anchor_id", "positive_id", "positive_score", "vec_id", "score", "part"],
                                lambda h: (int(ids[owner[h]]), int(positive[h]), int(positive_score[h])))

    return rows.mapInArrow(stream, "anchor_id long, positive_id long, positive_score long, vec_id long, score long, part long")


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(table: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST,
                   directions: int = DIRECTIONS, sample: int = SAMPLE, anchors: int = ANCHORS) -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of other labels that score between ``least`` percent of the
    positive's score and that score: columns of ``RESULT``.

    Rows take part with an id, a label and a vector of finite components (an empty vector scores 0 with other empty ones). Vectors
    of different lengths have no score. A row with the anchor's own id is not its partner; rows that repeat id and score count
    once. Ties go to the smaller id. A row whose squared quantised norm reaches 2^62 has no score in 64 bits and takes no part.
    A negative positive score has an empty window. An empty table and a table without anchors give no rows. Other columns,
    whatever their names, are not read.
    """
    spark = table.sparkSession
    rows = vectors(table, directions, sample)
    out = None
    for block in anchor_blocks(rows, every, anchors):
        ids, by = _collected(block)
        if not len(ids):
            continue
        own = spark.sparkContext.broadcast((ids, by))
        found = merged(cut_lineage(_positives(rows, own, positives)), ["anchor_id"], [F.desc("score"), F.asc("vec_id")], positives)
        number = {int(i): k for k, i in enumerate(ids)}
        best = sorted((number[r["anchor_id"]], r["vec_id"], r["score"]) for r in found.collect())  # at most positives x anchors rows
        if not best:
            continue
        windows = tuple(np.array(c, np.int64) for c in zip(*((a, p, s, -(-least * s // 100), s) for a, p, s in best)))
        heaps = cut_lineage(_negatives(rows, spark.sparkContext.broadcast((ids, by, windows)), negatives))
        mine = merged(heaps, ["anchor_id", "positive_id", "positive_score"], [F.desc("score"), F.asc("vec_id")], negatives)
        mine = mine.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = mine if out is None else out.unionByName(mine)
    return spark.createDataFrame([], RESULT) if out is None else out


def op13_angle_negatives(spark, sf_dir: str) -> DataFrame:
    return hard_negatives(load_table(spark, sf_dir, "embeddings"))


#: DuckDB.
ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_dot_product(a.q, x.q)::BIGINT AS score
  FROM v a JOIN v x ON a.vec_id <> x.vec_id AND len(a.q) = len(x.q) WHERE a.vec_id % 100 = 0),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM pairs WHERE same) WHERE n <= 5),
neg AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM pos p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5
"""
