"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text becomes a sparse vector x of three blocks: its distinct words hashed into ``2 ** BITS`` places (logarithmic counts,
block of length 1), structure statistics in bins (length, word length, shares of capitals, digits, symbols, blanks, repeated
words and lines ...) and bins of the metadata columns. The score is the logistic function of

    b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

and the pairwise sum is taken in time linear in the non-zero places, by the sum-of-squares identity
``1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``. Words, statistics and metadata thus meet in all pairs without a pair
being written down, and a word that was never seen with a statistic still has their factors.

Learning: at most ``max_rows`` labelled rows (those with the least hashes of the id) are turned into features and written. They are
split into shards of about ``SHARD`` rows by a hash of the id; in every round each shard makes ``PASSES`` passes or more of adaptive gradient
steps from the shared parameters in its own task, and the driver averages the shards' parameters (their size does not depend
on the data). Scoring: one pass over all texts, features and score in one kernel; nothing is shuffled or written.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notesmith.llm.common import documents, ship, text_of
from notesmith.session import cut_lineage, load_table

#: Places of hashed words (power of two), bins of a statistic, factors.
BITS, BINS, FACTORS = 15, 16, 8
#: Most labelled rows that the model is fitted on, rows of a shard, rounds of averaging, least passes and gradient steps of a shard
#: in a round (few rows are passed over more often).
MAX_ROWS, SHARD, ROUNDS, PASSES, STEPS = 32_768, 4096, 4, 2, 150
#: Rows of a gradient step, its size, decay of the parameters.
BATCH, RATE, DECAY = 32, 0.15, 1e-4
#: Non-zero places that are scored at once, and bytes of a text that are split into words at once.
PLACES, PIECE = 1 << 19, 1 << 20

UPPER, DIGITS, SYMBOLS, MARKS, ENDS = (bytes(range(0x41, 0x5B)), b"0123456789", b"#*$%&|<>{}[]\\^~_=+@/", b".,;:!?'\"()-", b".!?")
STATISTICS = ("length", "words", "word_length", "upper", "digits", "symbols", "marks", "ends", "blanks", "wide", "distinct", "top_word",
              "lines", "line_repeats", "longest_word")


def log_bin(value: float) -> int:
    """Bin of a size: two per doubling, from 0."""
    return min(BINS * 2 - 1, int(2 * math.log2(value + 1))) // 2 if value < 1 << 15 else BINS - 1


def share_bin(part: float, whole: float) -> int:
    """Bin of a share: finer near 0."""
    return min(BINS - 1, math.ceil(math.sqrt(part / whole) * (BINS - 1) - 1e-9)) if whole > 0 and part > 0 else 0


def _without(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def word_counts(text: bytes) -> tuple[Counter, int]:
    """Lower-cased (A-Z) words between blanks with counts, and the bytes in them; very long texts in pieces."""
    found, size, at, text = Counter(), 0, 0, text.lower()
    while True:
        end = -1 if len(text) - at <= PIECE else text.find(b" ", at + PIECE)
        words = (text[at:] if end < 0 else text[at:end]).split()
        found.update(words)
        size += sum(map(len, words))
        if end < 0:
            return found, size
        at = end


def statistics(text: bytes, words: Counter, in_words: int) -> list[int]:
    """Bins in the order of ``STATISTICS``."""
    n, size = sum(words.values()), len(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    wide = size - len(text.translate(None, bytes(range(0x80, 0x100))))
    return [log_bin(size), log_bin(n), log_bin(in_words / n if n else 0), share_bin(_without(text, UPPER), size),
            share_bin(_without(text, DIGITS), size), share_bin(_without(text, SYMBOLS), size), share_bin(_without(text, MARKS), size),
            share_bin(_without(text, ENDS), n), share_bin(size - in_words, size), share_bin(wide, size), share_bin(len(words), n),
            share_bin(max(words.values(), default=0), n), log_bin(len(lines)), share_bin(len(lines) - len(set(lines)), len(lines)),
            log_bin(max(map(len, words), default=0))]


def places(text: bytes, metadata: Sequence) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a row; ``metadata`` are numbers or None."""
    words, in_words = word_counts(text)
    mask = (1 << BITS) - 1
    at = np.fromiter((crc32(w) & mask for w in words), np.int64, len(words))
    tf = np.fromiter(words.values(), np.float64, len(words))
    at, back = np.unique(at, return_inverse=True)
    value = np.log1p(np.bincount(back, tf, len(at))) if len(at) else np.zeros(0)
    value /= max(1e-12, math.sqrt(float(value @ value)))
    bins = statistics(text, words, in_words)
    bins += [BINS - 1 if m is None or m != m or m < 0 else min(log_bin(m), BINS - 2) for m in metadata]
    own = (1 << BITS) + np.arange(len(bins)) * BINS + np.array(bins)
    return np.concatenate([at, own]), np.concatenate([value, np.full(len(bins), 1 / math.sqrt(len(STATISTICS)))])


@dataclass
class Machine:
    """Parameters: bias, w per place, v (places x factors), and the metadata columns in order."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    metadata: tuple[str, ...] = ()

    @classmethod
    def new(cls, metadata: Sequence[str] = (), factors: int = FACTORS, seed: int = 7) -> Machine:
        size = (1 << BITS) + (len(STATISTICS) + len(metadata)) * BINS
        v = np.random.default_rng(seed).normal(0, 0.05, (size, factors)).astype(np.float32)
        return cls(0.0, np.zeros(size, np.float32), v, tuple(metadata))

    def logits(self, at: np.ndarray, value: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function of rows whose places end at ``ends[1:]``, and the sums s_f of every row."""
        v = self.v[at] * value[:, None]
        rows = ends[:-1]  # no row is empty: every one has its statistics
        s = np.add.reduceat(v, rows, axis=0, dtype=np.float64)
        square = np.add.reduceat(v * v, rows, axis=0, dtype=np.float64)
        return self.bias + np.add.reduceat(self.w[at] * value, rows, dtype=np.float64) + 0.5 * (s * s - square).sum(axis=1), s

    def scores(self, at: np.ndarray, value: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(at, value, ends)[0], -30, 30)))

    def learn(self, at: np.ndarray, value: np.ndarray, ends: np.ndarray, y: np.ndarray, passes: int, seed: int) -> None:
        """Adaptive gradient steps over the rows in random batches, in place."""
        rnd = np.random.default_rng(seed)
        gw, gv, gb = np.full(len(self.w), 1e-2, np.float32), np.full(self.v.shape, 1e-2, np.float32), 1e-2
        for _ in range(passes):
            order = rnd.permutation(len(y))
            for k in range(0, len(y), BATCH):
                rows = order[k:k + BATCH]
                sizes = ends[rows + 1] - ends[rows]
                own = np.concatenate([[0], np.cumsum(sizes)])
                pick = np.repeat(ends[rows] - own[:-1], sizes) + np.arange(own[-1])
                i, x = at[pick], value[pick]
                logit, s = self.logits(i, x, own)
                error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]
                e = np.repeat(error, sizes)
                spots, back = np.unique(i, return_inverse=True)
                n = len(rows)
                dw = np.bincount(back, e * x, len(spots)) / n + DECAY * self.w[spots]
                per = (e * x)[:, None] * (np.repeat(s, sizes, axis=0) - self.v[i] * x[:, None])
                dv = np.zeros((len(spots), self.v.shape[1]))
                np.add.at(dv, back, per)
                dv = dv / n + DECAY * self.v[spots]
                gw[spots] += dw * dw
                gv[spots] += dv * dv
                self.w[spots] -= RATE * dw / np.sqrt(gw[spots])
                self.v[spots] -= RATE / 2 * dv / np.sqrt(gv[spots])
                db = float(error.mean())
                gb += db * db
                self.bias -= RATE * db / math.sqrt(gb)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, y of the rows to learn from: labels 0 and 1 outside the held-out rows; ids with both labels are left out; at most
    ``max_rows``, those with the least hashes."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
    own = own.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("_y")).where("y = _y").drop("_y")
    return own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def _rows(docs: DataFrame, metadata: Sequence[str]) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"),
                       F.array(*[F.col(f"`{m}`").cast("double") for m in metadata]).cast("array<double>").alias("meta"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: Sequence[str] = ("n_chars",), max_rows: int = MAX_ROWS,
          rounds: int = ROUNDS, factors: int = FACTORS) -> Machine:
    """The machine learned from the labelled rows of ``docs``; without any, one that scores near 0.5 whatever the text."""
    spark = docs.sparkSession
    ship(spark)
    sample = F.broadcast(labelled(labels, label, max_rows))  # at most max_rows narrow rows
    rows = _rows(docs, metadata).join(sample, "doc_id")

    def features(batches):
        for b in batches:
            at, value, ends = [], [], [0]
            for text, meta in zip(b.column("text"), b.column("meta").to_pylist()):
                i, x = places(text.as_py(), meta)
                at.append(i)
                value.append(x)
                ends.append(ends[-1] + len(i))
            if at:
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("y"), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(at), pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(value), pa.float32()))], ["doc_id", "y", "at", "value"])

    table = cut_lineage(rows.mapInArrow(features, "doc_id long, y int, at array<int>, value array<float>"))
    n = table.count()
    machine = Machine.new(metadata, factors)
    if not n:
        return machine
    sharded = table.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(max(1, math.ceil(n / SHARD)))).cast("int"))
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(machine)

        def learn(part: pd.DataFrame) -> pd.DataFrame:
            m = shared.value
            own = Machine(m.bias, m.w.copy(), m.v.copy(), m.metadata)
            part = part.assign(n=part["at"].map(len), first=part["at"].map(lambda a: a[0])).sort_values(["doc_id", "n", "first", "y"])
            ends = np.concatenate([[0], np.cumsum(part["n"].to_numpy())])
            at, value = np.concatenate(part["at"].to_list()), np.concatenate(part["value"].to_list())
            passes = max(PASSES, math.ceil(STEPS / math.ceil(len(part) / BATCH)))
            own.learn(at, value, ends, part["y"].to_numpy(), passes, 1000 * r + int(part["shard"].iat[0]))
            return pd.DataFrame({"shard": [int(part["shard"].iat[0])], "rows": [len(part)], "bias": [float(own.bias)],
                                 "w": [own.w.tobytes()], "v": [own.v.tobytes()]})

        done = sharded.groupBy("shard").applyInPandas(learn, "shard int, rows long, bias double, w binary, v binary").collect()
        done.sort(key=lambda x: x["shard"])  # as many rows as shards: bounded by max_rows, each of the machine's size
        share = np.array([x["rows"] for x in done]) / n
        machine.bias = float(sum(s * x["bias"] for s, x in zip(share, done)))
        machine.w = sum(s * np.frombuffer(x["w"], np.float32) for s, x in zip(share, done)).astype(np.float32)
        machine.v = sum(s * np.frombuffer(x["v"], np.float32) for s, x in zip(share, done)).astype(np.float32).reshape(machine.v.shape)
        shared.unpersist()
    return machine


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score (0 to 1) of every row.

    Null texts count as empty; empty texts are scored by their statistics and metadata. Texts are read whole. Repeated rows are
    scored each, null ids are passed on; an empty table gives no rows. Besides doc_id, text and the machine's metadata columns
    nothing is read, whatever its name.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(machine)

    def judge(batches):
        m = shared.value
        for b in batches:
            out, at, value, ends = [], [], [], [0]

            def flush():
                if at:
                    out.append(m.scores(np.concatenate(at), np.concatenate(value), np.array(ends)))
                    at.clear()
                    value.clear()
                    ends[:] = [0]

            for text, meta in zip(b.column("text"), b.column("meta").to_pylist()):
                i, x = places(text.as_py(), meta)
                at.append(i)
                value.append(x.astype(np.float32))
                ends.append(ends[-1] + len(i))
                if ends[-1] >= PLACES:
                    flush()
            flush()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.concatenate(out) if out else np.zeros(0))], ["doc_id", "score"])

    return _rows(docs, machine.metadata).mapInArrow(judge, "doc_id long, score double")


def op12_factor_machine(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    s = score(docs, train(docs, load_table(spark, sf_dir, "labels")))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
