"""Substring deduplication over sliding spans of sentences.

A text is cut into sentences (behind . ! ? and at line ends). Sentences of more than ``MAX_WORDS`` words are cut on where the content says so:
before a word whose two-word gram has the least hash of the ``NEAR`` places on either side (the first of equal ones), so a text without punctuation has
pieces too, and a passage inside longer sentences has the same pieces wherever it stands in them. For every sentence the shortest run of ``RUN`` sentences or
more with ``MIN_WORDS`` words or more that starts there, and the shortest that ends there, is hashed to 128 bits. Both
are functions of the run's own words, so equal passages give equal runs wherever they stand, and the two directions
cover a repeated passage to both of its ends.

Runs are first collapsed inside each batch of documents: what is not first there is not first anywhere, so a run that a
third of all documents share sends one row per batch. What is left meets globally by hash in one shuffle. The smallest
(doc_id, start) is the first; the sentences of all others are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notesmith.llm.common import documents, only, ship, text_of

RUN, MIN_WORDS, MAX_WORDS = 2, 16, 20
#: Places on either side that a cut's hash is compared with (cuts are more than that apart), and most words between two cuts.
NEAR, MOST_WORDS = 5, 60
#: A run's two ends in one number.
SPAN = 1 << 31
#: Documents whose runs are collapsed together.
DOCS_AT_ONCE = 2000

_END = re.compile(rb"(?:[.!?]+[\x20\x09-\x0D]|\n)[\x20\x09-\x0D]*")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
#: Odd multipliers of the two rolling sums (any odd numbers do) and their inverses modulo 2**64.
_B = tuple(np.uint64(b) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_INV = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _B)


def _hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            if len(known) > 500_000:
                known.clear()
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        out.append(h)
    return np.array(out, dtype=np.uint64)


def cuts(sentences: list[list[bytes]], known: dict[bytes, int], near: int = NEAR, most: int = MOST_WORDS) -> list[list[int]]:
    """Places (the first is 0) at which pieces of each sentence start; all sentences of a text are looked at together.

    A stretch without a place of least hash, such as a word repeated over and over, is cut every ``most`` words from its start."""
    gap = [b""] * near  # between two sentences nothing is less
    h = _hashes([w for words in sentences for w in (*words, *gap)], known)
    with np.errstate(over="ignore"):
        gram = h * _B[0]
        gram[:-1] += h[1:]
    sizes = np.array([len(words) for words in sentences])
    first = np.cumsum(sizes + near) - sizes - near
    for d in range(near + 1):  # the last word has no gram
        gram[first + sizes - 1 + d] = np.iinfo(np.uint64).max
    least = np.ones(len(gram), dtype=bool)
    for d in range(1, near + 1):
        least[d:] &= gram[d:] < gram[:-d]
        least[:-d] &= gram[:-d] <= gram[d:]
    least[first] = False
    spots = np.flatnonzero(least)
    out = []
    for a, b, own in zip(first.tolist(), (first + sizes).tolist(), np.split(spots, np.searchsorted(spots, first[1:]))):
        at = [0, *(own - a).tolist(), b - a]
        out.append([k for x, y in zip(at, at[1:]) for k in range(x, y, most)])
    return out


def pieces(data: bytes, max_words: int = MAX_WORDS, known: dict[bytes, int] | None = None) -> tuple[list[int], list[bytes], list[int]]:
    """Starts of the pieces (the first is 0 and piece i ends where i + 1 starts), their normalised words, word counts. ``known``
    keeps hashes of words from text to text."""
    starts, norm, counts = [], [], []
    ends = [m.end() for m in _END.finditer(data)]
    if not ends or ends[-1] < len(data):
        ends.append(len(data))
    low = data.lower()
    sentences = [low[a:b].split() for a, b in zip([0, *ends], ends)]
    long = [words for words in sentences if len(words) > max_words]
    places = iter(cuts(long, {} if known is None else known) if long else ())
    at = 0
    for end, words in zip(ends, sentences):
        if len(words) <= max_words:
            starts.append(at)
            norm.append(b" ".join(words))
            counts.append(len(words))
        else:
            spots = [m.start() for m in _WORD.finditer(data, at, end)]
            own = next(places)
            for k, to in zip(own, [*own[1:], len(words)]):
                starts.append(spots[k] if k else at)
                norm.append(b" ".join(words[k:to]))
                counts.append(to - k)
        at = end
    return starts, norm, counts


def runs(norm: list[bytes], counts: list[int], run: int = RUN, min_words: int = MIN_WORDS):
    """Arrays start, end (exclusive), k1, k2 of the shortest runs that start or end at each piece with words.

    Pieces without words are no sentences: they are skipped in counting and lie inside the runs around them."""
    have = np.flatnonzero(np.asarray(counts) > 0)
    n = len(have)
    if n < run:
        return None
    c = np.concatenate([[0], np.cumsum(np.asarray(counts)[have])])
    i = np.arange(n)
    fwd = np.maximum(i + run, np.searchsorted(c, c[:-1] + min_words, "left"))
    back = np.minimum(i + 1 - run, np.searchsorted(c, c[1:] - min_words, "right") - 1)
    s = np.concatenate([i[fwd <= n], back[back >= 0]])
    e = np.concatenate([fwd[fwd <= n], i[back >= 0] + 1])
    if not len(s):
        return None
    s, e = np.divmod(np.unique(s * (n + 1) + e), n + 1)
    h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(norm[j]) for j in have), dtype=">u8").astype(np.uint64).reshape(-1, 2)
    keys = []
    with np.errstate(over="ignore"):
        for d in (0, 1):
            up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _B[d])]), dtype=np.uint64)
            down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _INV[d])]), dtype=np.uint64)
            total = np.concatenate([[np.uint64(0)], np.cumsum(h[:, d] * up, dtype=np.uint64)])
            key = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
            keys.append(key.view(np.int64))
    return have[s], have[e - 1] + 1, keys[0], keys[1]


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[bytes, int] = {}
    for pdf in batches:
        for lo in range(0, len(pdf), DOCS_AT_ONCE):
            out = []
            part = pdf.iloc[lo:lo + DOCS_AT_ONCE].sort_values(["doc_id", "th"])
            for doc_id, th, text in zip(part["doc_id"], part["th"], part["text"]):
                _, norm, counts = pieces(text.encode("utf-8", "surrogatepass"), known=known)
                r = runs(norm, counts)
                if r is not None:
                    s, e, k1, k2 = r
                    m = len(s)
                    out.append((np.full(m, doc_id), np.full(m, th), s, e, k1, k2))
            if not out:
                continue
            doc, th, s, e, k1, k2 = (np.concatenate(x) for x in zip(*out))
            order = np.lexsort((k2, k1))  # stable: rows of a hash stay in the order of their places
            doc, th, s, e, k1, k2 = (x[order] for x in (doc, th, s, e, k1, k2))
            head = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
            again = np.concatenate([[False], (doc[1:] == doc[:-1]) & (th[1:] == th[:-1]) & (s[1:] == s[:-1])]) & ~head
            first = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
            # Rows that are gone already travel under a key of their own, spread evenly.
            k1 = np.where(head, k1, _scatter(doc, s))
            keep = ~again
            before = pd.array(doc[first][keep], dtype="Int64")
            before[head[keep]] = pd.NA
            yield pd.DataFrame({"k1": k1[keep], "k2": k2[keep], "th": th[keep], "doc_id": doc[keep], "span": s[keep] * SPAN + e[keep], "before": before})


def _scatter(doc: np.ndarray, s: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((doc.astype(np.uint64) * _B[0] + s.astype(np.uint64)) * _B[1]).view(np.int64)


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id (null: the smallest long), th (hash of the text), text. Rows that repeat id and text count once."""
    t = only(docs, "doc_id", "text")
    return t.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
                    F.xxhash64(text_of()).alias("th"), text_of().alias("text"))


def spans_of(docs: DataFrame) -> DataFrame:
    """k1, k2, th, doc_id, span (pieces s to e - 1 as s * SPAN + e) of every run, and before, a document that has it earlier in its batch
    (null: none). Few narrow columns, random ones side by side: this is what is shuffled."""
    ship(docs.sparkSession)
    return texts_of(docs).mapInPandas(_spans, "k1 long, k2 long, th long, doc_id long, span long, before long")


def repeats(spans: DataFrame) -> DataFrame:
    """doc_id, th, s, e of every run that is not the first of its hash, and first_id, a document that has it earlier."""
    gone = F.col("before").isNotNull()
    w = Window.partitionBy("k1", "k2", gone).orderBy("doc_id", "th", "span")
    place = F.struct("doc_id", "th", "span")
    t = spans.withColumn("head", F.first(place).over(w)).where(gone | (place != F.col("head")))
    first = F.when(gone, F.col("before")).otherwise(F.col("head.doc_id"))
    return t.select("doc_id", "th", F.expr(f"cast(span div {SPAN} as int)").alias("s"), (F.col("span") % SPAN).cast("int").alias("e"), first.alias("first_id"))


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    known: dict[bytes, int] = {}
    for pdf in batches:
        rows = []
        for doc_id, th, text, cuts, firsts in zip(pdf["doc_id"], pdf["th"], pdf["text"], pdf["cuts"], pdf["firsts"]):
            data = text.encode("utf-8", "surrogatepass")
            starts, _, counts = pieces(data, known=known)
            gone = np.zeros(len(starts) + 1, dtype=np.int64)
            for c in cuts:
                gone[c["s"]] += 1
                gone[c["e"]] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            ends = starts[1:] + [len(data)]
            kept = b"".join(data[a:b] for a, b, g in zip(starts, ends, gone) if not g)
            has = np.asarray(counts) > 0
            rows.append((doc_id, th, int(has.sum()), int((has & gone).sum()), sorted({int(x) for x in firsts}),
                         kept.decode("utf-8", "surrogatepass"), hashlib.sha256(kept).hexdigest()))
        yield pd.DataFrame(rows, columns=["doc_id", "th", "n_sentences", "n_removed", "first_ids", "kept_text", "kept_sha256"])


def sentence_dedup(docs: DataFrame) -> DataFrame:
    """Documents that lose sentences: doc_id, th, n_sentences, n_removed, first_ids (documents that hold a removed run earlier),
    kept_text, kept_sha256.

    All other documents stay as they are and have no row. Null and empty texts have no sentences. Runs inside one document
    repeat too. Rows that repeat id and text are one document. A null id counts as the smallest long. Other columns,
    whatever their names, are not read; an empty table gives no rows.
    """
    hits = repeats(spans_of(docs)).groupBy("doc_id", "th").agg(
        F.collect_set(F.struct("s", "e")).alias("cuts"), F.collect_set("first_id").alias("firsts"))
    t = texts_of(docs).join(hits, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"])
    return t.mapInPandas(_removed, "doc_id long, th long, n_sentences long, n_removed long, first_ids array<long>, "
                                   "kept_text string, kept_sha256 string")


def op3_sentence_spans(spark, sf_dir: str) -> DataFrame:
    return sentence_dedup(documents(spark, sf_dir)).select("doc_id", "n_sentences", "n_removed", "first_ids", "kept_sha256")
