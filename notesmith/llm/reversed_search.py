"""Ranked lexical search in reverse: items wait in an inverted index, documents stream through it.

1. The terms of the items become an inverted index (term -> items that ask for it, and how often). Items are taken in blocks
   of at most about ``BLOCK_BYTES`` of text and ``BLOCK_ITEMS`` items, so the index that is broadcast has a size bound.
2. One pass over the texts writes a narrow table: per document its id, its number of terms and the counts of the terms that
   any item of the block asks for. Texts are never shuffled. The corpus statistics (N, L and the document frequencies) are
   aggregates of that table, combined on the map side.
3. The table streams through the index: each document's counts are added into the scores of the items that ask for its terms,
   and every item keeps a heap of its ``k`` best documents. A task holds ``k`` entries per item whatever it reads.
4. The heaps of all tasks are merged, first in about the square root of their number of groups per item, then per item.

Everything but the weight's logarithm is integer arithmetic, so scores do not depend on how documents are split over tasks.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notesmith.llm.common import documents, only, ship, text_of
from notesmith.session import cut_lineage, load_table

#: Documents an item returns.
TOP = 10
#: Text bytes and items of one block of items (an index of a few times the bytes is broadcast).
BLOCK_BYTES, BLOCK_ITEMS = 8 << 20, 4096
#: Scores that a task adds up at once, postings that it expands at once, and bytes of a text that are split at once.
SCORES, POSTINGS, PIECE = 1 << 20, 1 << 21, 1 << 20

#: Bytes of a UTF-8 text as they count for terms: digits, small letters and everything beyond ASCII stand for themselves,
#: A-Z become small, all other ASCII characters end a term.
_FOLD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))


def pieces(text: bytes):
    """Lists of the terms of a UTF-8 text, in order; a very long text comes in several lists."""
    text = text.translate(_FOLD)
    at = 0
    while len(text) - at > PIECE:
        end = text.find(b" ", at + PIECE)
        if end < 0:
            break
        yield text[at:end].split()
        at = end
    yield (text[at:] if at else text).split()


def term_counts(text: bytes) -> tuple[int, Counter]:
    """Number of terms with repeats, and how often each occurs."""
    n, found = 0, Counter()
    for words in pieces(text):
        n += len(words)
        found.update(words)
    return n, found


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term (binary), q: how often an item asks for a term. Rows repeated with id and text count once; different
    texts under one id (also under none) are one item."""
    ship(items.sparkSession)
    rows = only(items, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), text_of().cast("binary").alias("text")).distinct()

    def split(batches):
        for b in batches:
            for i, text in zip(b.column("item_id").to_pylist(), b.column("text")):
                _, found = term_counts(text.as_py())
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(found), pa.int64()), pa.array(list(found), pa.binary()),
                                                      pa.array(list(found.values()), pa.int64())], ["item_id", "term", "q"])

    return rows.mapInArrow(split, "item_id long, term binary, q long").groupBy("item_id", "term").agg(F.sum("q").alias("q"))


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES, block_items: int = BLOCK_ITEMS) -> list[DataFrame]:
    """The items in blocks by a hash of the id, as many as the sizes ask for."""
    size = items.select(F.sum(F.octet_length(text_of())).alias("bytes"), F.count(F.lit(1)).alias("items")).first()
    n = max(1, math.ceil((size["bytes"] or 0) / block_bytes), math.ceil(size["items"] / block_items))
    return [items] if n == 1 else [items.where(F.pmod(F.xxhash64(F.col("item_id").cast("long")), F.lit(n)) == k) for k in range(n)]


def _index(items: DataFrame) -> tuple[list, dict[bytes, int], np.ndarray, np.ndarray, np.ndarray]:
    """Item ids, number of each term, and the postings: starts per term, item numbers, counts."""
    rows = item_terms(items).collect()  # one block: bounded by BLOCK_BYTES
    ids = sorted({r["item_id"] for r in rows}, key=lambda i: (i is None, i))
    number = {i: k for k, i in enumerate(ids)}
    terms = {t: k for k, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    at = np.fromiter((terms[bytes(r["term"])] for r in rows), np.int64, len(rows))
    item = np.fromiter((number[r["item_id"]] for r in rows), np.int64, len(rows))
    q = np.fromiter((r["q"] for r in rows), np.int64, len(rows))
    order = np.lexsort((item, at))
    starts = np.searchsorted(at[order], np.arange(len(terms) + 1))
    return ids, terms, starts, item[order], q[order]


def counted(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the whole text, with repeats), terms and tfs (those in ``terms``), one row per document. Written."""
    spark = docs.sparkSession
    ship(spark)
    known = spark.sparkContext.broadcast(terms)

    def count(batches):
        index = known.value
        for b in batches:
            n, ends, at, tf = [], [0], [], []
            for text in b.column("text"):
                size, found = term_counts(text.as_py())
                own = sorted((index[w], found[w]) for w in found.keys() & index.keys())
                at += [t for t, _ in own]
                tf += [c for _, c in own]
                n.append(size)
                ends.append(len(at))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    return cut_lineage(rows.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<int>"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def first_per_key(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int, once: bool = False) -> np.ndarray:
    """Places of the ``k`` entries with the highest scores (ties: smaller id) of every key; equal entries count ``once`` if asked."""
    order = np.lexsort((ids, -scores, keys))
    key, score, one = keys[order], scores[order], ids[order]
    if once and len(order):
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (score[1:] != score[:-1]) | (one[1:] != one[:-1])])
        order, key = order[new], key[new]
    return order[np.arange(len(order)) - np.searchsorted(key, key) < k]


class Heaps:
    """The ``k`` best (score, doc) of each of ``size`` items, the smaller doc first among equal scores. ``least`` and ``last``
    are the score and doc that a new entry has to beat."""

    def __init__(self, size: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(size)]
        self.least, self.last = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).min)

    def offer(self, docs: np.ndarray, scores: np.ndarray) -> None:
        """``scores[d, i]`` of ``docs[d]`` for item i; scores of 0 or less never enter."""
        better = (scores > self.least) | ((scores == self.least) & (docs[:, None] < self.last))
        d, i = np.nonzero(better)
        at = first_per_key(i, scores[d, i], docs[d], self.k)
        for i, s, d in zip(i[at].tolist(), scores[d[at], i[at]].tolist(), docs[d[at]].tolist()):
            heap, entry = self.heaps[i], (s, -d)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[i], self.last[i] = heap[0][0], -heap[0][1]

    def rows(self):
        return ((i, -d, s) for i, heap in enumerate(self.heaps) for s, d in heap)


def _heaps_of_tasks(table: DataFrame, ids: list, postings, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item_id, doc_id, score, part: the heaps of each task."""
    spark = table.sparkSession
    shared = spark.sparkContext.broadcast((ids, *postings, weights))

    def stream(batches):
        from pyspark import TaskContext

        ids, starts, items, q, w = shared.value
        lengths = np.diff(starts)
        heaps = Heaps(len(ids), k)
        step = max(1, SCORES // max(1, len(ids)))
        for b in batches:
            docs, n = b.column("doc_id").to_numpy(), b.column("n").to_numpy()
            ends, at = np.asarray(b.column("terms").offsets), np.asarray(b.column("terms").values, dtype=np.int64)
            tf = np.asarray(b.column("tfs").values, dtype=np.int64)
            m = np.array([25 + 75 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
            cost = np.concatenate([[0], np.cumsum(lengths[at])])[ends]
            lo = 0
            while lo < len(docs):
                hi = min(len(docs), lo + step, max(lo + 1, int(np.searchsorted(cost, cost[lo] + POSTINGS, "right")) - 1))
                t, f = at[ends[lo]:ends[hi]], tf[ends[lo]:ends[hi]]
                row = np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi + 1]))
                part = w[t] * (1_000_000_000 * f // (1000 * f + 8 * m[lo:hi][row]))
                size = lengths[t]
                first = np.cumsum(size) - size
                post = np.repeat(starts[t] - first, size) + np.arange(int(size.sum()))
                scores = np.zeros((hi - lo) * len(ids), np.int64)
                np.add.at(scores, np.repeat(row * len(ids), size) + items[post], np.repeat(part, size) * q[post])
                heaps.offer(docs[lo:hi], scores.reshape(hi - lo, len(ids)))
                lo = hi
        task = TaskContext.get().partitionId()
        rows = list(heaps.rows())
        for s in range(0, len(rows), 10_000):
            some = rows[s:s + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i, _, _ in some], pa.int64()), pa.array([d for _, d, _ in some], pa.int64()),
                 pa.array([x for _, _, x in some], pa.int64()), pa.array([task] * len(some), pa.int32())],
                ["item_id", "doc_id", "score", "part"])

    return table.where("doc_id is not null and size(terms) > 0").mapInArrow(stream, "item_id long, doc_id long, score long, part int")


def merged(heaps: DataFrame, by: list[str], order: list, k: int, out: str = "rank") -> DataFrame:
    """The first ``k`` rows per ``by`` of the heaps of many tasks, numbered from 1; ``part`` is the task that made a row.

    A first round per key and group of tasks keeps what reaches one task near the square root of what all tasks hold."""
    groups = max(1, math.isqrt(heaps.select(F.max("part")).first()[0] or 0))
    some = F.row_number().over(Window.partitionBy(*by, "_group").orderBy(*order))
    few = heaps.withColumn("_group", F.pmod("part", F.lit(groups))).withColumn("_n", some).where(F.col("_n") <= k).drop("_n", "_group", "part")
    every = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return few.withColumn(out, every).where(F.col(out) <= k)


def reversed_search(items: DataFrame, docs: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES,
                    block_items: int = BLOCK_ITEMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` best documents with a score above 0.

    Null and empty texts have no terms: such an item returns nothing, such a document is never returned. Equal scores go by
    doc_id. Repeated rows of ``docs`` are documents each; rows without doc_id count in the statistics and are not returned.
    Repeated rows of ``items`` count once, different texts under one item_id are one item. Without items, documents or common
    terms there are no rows. Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    out = None
    for block in item_blocks(items, block_bytes, block_items):
        ids, terms, *postings = _index(block)
        if not terms:
            continue
        table = counted(only(docs, "doc_id", "text"), terms)
        n_docs, n_terms = table.select(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        df = np.zeros(len(terms), np.int64)
        for t, c in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most one row per term of the block
            df[t] = c
        weights = np.array([weight(n_docs, int(c)) for c in df], dtype=np.int64)
        heaps = cut_lineage(_heaps_of_tasks(table, ids, postings, weights, n_docs, n_terms, k))
        best = merged(heaps, ["item_id"], [F.desc("score"), F.asc("doc_id")], k)
        out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.select("item_id", "rank", "doc_id", "score")


def op11_reversed_search(spark, sf_dir: str) -> DataFrame:
    return reversed_search(load_table(spark, sf_dir, "benchmark"), documents(spark, sf_dir))


#: DuckDB. Terms are split at the ASCII characters that end one, after A-Z are lower-cased.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM documents),
sizes AS (SELECT row, doc_id, len(ws) AS n FROM words WHERE len(ws) > 0),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
asked AS (
  SELECT item_id, term, count(*) AS q
  FROM (SELECT item_id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark))
  WHERE term <> '' GROUP BY 1, 2),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ws) AS term FROM words)
       WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, corpus GROUP BY term),
part AS (
  SELECT s.row, s.doc_id, t.term, w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * s.n * c.n_docs) // c.n_terms))) AS p
  FROM tf t JOIN sizes s ON s.row = t.row JOIN w ON w.term = t.term, corpus c),
scored AS (SELECT a.item_id, p.row, p.doc_id, sum(a.q * p.p)::BIGINT AS score FROM asked a JOIN part p ON p.term = a.term
           WHERE p.doc_id IS NOT NULL GROUP BY 1, 2, 3),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
