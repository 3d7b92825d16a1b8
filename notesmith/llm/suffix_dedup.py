"""Substring deduplication of bytes by suffix order.

A byte is removed when a string of ``LENGTH`` bytes (a window) that covers it also starts earlier: in a smaller doc_id, or
earlier in the same document. Windows never cross documents.

1. Every window has an anchor: the smallest hash among its ``GRAM``-byte grams. Equal windows have equal anchors, so
   windows can only repeat under a common anchor. Maximal runs of windows with one anchor form a block; a block is sent
   as its place, its anchor and a hash of its bytes, not as bytes.
2. Blocks equal in bytes are collapsed, first inside each batch of documents and then globally by anchor: all but the
   first repeat whole. An anchor that has one distinct block, whose anchor gram stands in it once, has no repeats.
3. The distinct blocks of every other anchor meet in one task, in the order of their places. Each is trimmed to the
   longest stretches around the anchor that any other block has too, and the common suffix order (``lyndon_order``)
   of what is left brings equal windows together: all but the one that starts first are removed.
4. Removed windows return to their documents, where their union is cut out.

An anchor can be too frequent for one task. A bounded sketch names the most frequent anchors over all documents before
step 2; their windows are sent one by one under their own 128-bit hashes, spread evenly and collapsed alike. Anchors
that reach step 3 with more than ``MOST_BLOCKS`` blocks or ``MOST_BYTES`` bytes take that way too. In large groups equal
trimmed blocks are collapsed before the order is made, and more than ``MOST_ORDERED`` bytes are matched by hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notesmith.llm.common import documents, only, ship, text_of
from notesmith.llm.lyndon_order import suffix_order
from notesmith.session import cut_lineage

LENGTH, GRAM = 100, 24
MOST_BLOCKS, MOST_BYTES = 1 << 16, 1 << 24
#: Groups of more blocks collapse equal trimmed blocks first; the order is made of this many bytes at most.
LARGE, MOST_ORDERED = 64, 1 << 20
HOT_ANCHORS, COUNTERS, HOT_ROWS = 512, 8192, 20_000
#: Windows of a text hashed at once, and documents whose blocks are collapsed together: bounds of a task's arrays.
CHUNK, DOCS_AT_ONCE = 1 << 20, 2000

U = np.uint64
_B1, _B2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_TOP = U(2**64 - 1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: Kinds of rows between the steps.
GONE, BLOCK, SPREAD = 0, 1, 2
_ROW = "kind int, k1 long, k2 long, doc_id long, th int, s int, n int"
_NAMES = ["kind", "k1", "k2", "doc_id", "th", "s", "n"]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _upto(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for exponents below ``n``."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        m = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(m, U(b))
            p[0] = U(1)
            both.append(np.cumprod(p, dtype=np.uint64))
        _powers[base] = have = (both[0], both[1])
    return have


class _Hashes:
    """Hashes of any slices of some bytes, from sums of powers."""

    def __init__(self, a: np.ndarray, base: int = _B1):
        up, self.down = _upto(base, len(a) + 1)
        with np.errstate(over="ignore"):
            self.sum = np.concatenate([[U(0)], np.cumsum((a.astype(np.uint64) + U(1)) * up[:len(a)], dtype=np.uint64)])

    def at(self, start, end) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix((self.sum[end] - self.sum[start]) * self.down[start])


def _window_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours: running minima from both ends of tiles of ``w``."""
    m = len(h) - w + 1
    x = np.concatenate([h, np.full(-len(h) % w, _TOP)]).reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:m], ahead[w - 1:w - 1 + m])


def _grams(a: np.ndarray, gram: int) -> tuple[_Hashes, np.ndarray]:
    """Sums of some bytes and the hashes of all their grams."""
    hs = _Hashes(a)
    with np.errstate(over="ignore"):
        return hs, _mix((hs.sum[gram:] - hs.sum[:-gram]) * hs.down[:len(a) - gram + 1])


def blocks_of(data: bytes, length: int = LENGTH, gram: int = GRAM):
    """Arrays start, n (windows), anchor, digest, twice (the anchor's gram may stand in the block twice) of a text's blocks."""
    a = np.frombuffer(data, dtype=np.uint8)
    w = length - gram + 1
    out = []
    for lo in range(0, len(a) - length + 1, CHUNK):
        part = a[lo:lo + CHUNK + length - 1]
        hs, h = _grams(part, gram)
        low = _window_min(h, w)
        s = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
        n = np.diff(np.concatenate([s, [len(low)]]))
        anchor = low[s]
        digest = hs.at(s, s + n + length - 1) ^ _mix(n.astype(np.uint64))
        out.append((s + lo, n, anchor, digest, (n > w) | _twice(h, low, s, anchor, w)))
    return [np.concatenate(x) for x in zip(*out)] if out else None


def _twice(h, low, s, anchor, w) -> np.ndarray:
    """Blocks in which one window holds two grams with the anchor's hash."""
    flag = np.zeros(len(s), dtype=bool)
    at = np.flatnonzero(np.isin(h, anchor))
    order = np.lexsort((at, h[at]))
    i, j = at[order[:-1]], at[order[1:]]
    near = (h[i] == h[j]) & (j - i < w)
    i, j = i[near], j[near]
    first = np.searchsorted(s, np.minimum(np.maximum(j - w + 1, 0), len(low) - 1), "right") - 1
    last = np.searchsorted(s, np.minimum(i, len(low) - 1), "right") - 1
    while len(i):
        hit = anchor[first] == h[i]
        flag[first[hit]] = True
        more = first < last
        i, first, last = i[more], first[more] + 1, last[more]
    return flag


def _rows(kind, k1, k2, doc_id, th, s, n) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(_NAMES, (np.asarray(kind, np.int32), k1.view(np.int64), k2.view(np.int64), doc_id,
                                          th.astype(np.int32), s.astype(np.int32), n.astype(np.int32)))))


def _starts_windows(data: bytes, s: np.ndarray, n: np.ndarray, length: int):
    """Starts and the two hashes of all windows of the blocks (s, n)."""
    a = np.frombuffer(data, dtype=np.uint8)
    at = np.repeat(s - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return at, _Hashes(a, _B1).at(at, at + length), _Hashes(a, _B2).at(at, at + length)


def _collapse(r: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by k1, k2, doc_id, th, s: (not a repetition of the row before, first of its k1, first of its k1 and k2)."""
    v = [r[c].to_numpy() for c in ("k1", "k2", "doc_id", "th", "s")]
    new = [np.concatenate([[True], x[1:] != x[:-1]]) for x in v]
    key = new[0]
    both = key | new[1]
    return both | new[2] | new[3] | new[4], key, both


def _anchors(batches: Iterator[pd.DataFrame], length: int, gram: int) -> Iterator[pd.DataFrame]:
    """Anchors of blocks that occur twice or more in the same batch of documents, once per occurrence."""
    for pdf in batches:
        for lo in range(0, len(pdf), DOCS_AT_ONCE):
            out = []
            for text in pdf["text"].iloc[lo:lo + DOCS_AT_ONCE]:
                a = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                for at in range(0, len(a) - length + 1, CHUNK):
                    low = _window_min(_grams(a[at:at + CHUNK + length - 1], gram)[1], length - gram + 1)
                    out.append(low[np.concatenate([[True], low[1:] != low[:-1]])])
            if out:
                k, n = np.unique(np.concatenate(out), return_counts=True)
                yield pd.DataFrame({"k1": np.repeat(k[n > 1], n[n > 1]).view(np.int64)})


def _spans(batches: Iterator[pd.DataFrame], hot: np.ndarray, length: int, gram: int) -> Iterator[pd.DataFrame]:
    """Blocks (and windows of hot anchors) of a batch, collapsed: what is not first here is not first anywhere."""
    for pdf in batches:
        for lo in range(0, len(pdf), DOCS_AT_ONCE):
            part = pdf.iloc[lo:lo + DOCS_AT_ONCE].sort_values(["doc_id", "th"])
            out = []
            for doc_id, th, text in zip(part["doc_id"], part["th"], part["text"]):
                data = text.encode("utf-8", "surrogatepass")
                b = blocks_of(data, length, gram)
                if b is None:
                    continue
                s, n, anchor, digest, twice = b
                if len(hot) and (spread := np.isin(anchor, hot)).any():
                    at, w1, w2 = _starts_windows(data, s[spread], n[spread], length)
                    m = len(at)
                    out.append((np.full(m, SPREAD), w1, w2, np.full(m, doc_id), np.full(m, th), at, np.ones(m, np.int64)))
                    s, n, anchor, digest, twice = (x[~spread] for x in b)
                m = len(s)
                out.append((np.full(m, BLOCK), anchor, digest, np.full(m, doc_id), np.full(m, th), s, np.where(twice, -n, n)))
            if not out:
                continue
            cols = [np.concatenate(x) for x in zip(*out)]
            # Rows stand in the order of their places; the sort by hashes is stable and keeps it.
            order = np.lexsort((cols[2].view(np.int64), cols[1].view(np.int64)))
            r = _rows(*[c[order] for c in cols])
            fresh, _, first = _collapse(r)
            r["kind"] = np.where(first, r["kind"], GONE).astype(np.int32)
            yield r[fresh]


def _by_key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches cut where k1 changes: every k1 is whole in one of them (its rows are few, or it is bounded by steps before)."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        k = pdf["k1"].to_numpy()
        last = int(np.searchsorted(k, k[-1], "left"))
        if last == 0 and (not held or held[-1]["k1"].iloc[-1] == k[0]):
            held.append(pdf)
            continue
        yield pd.concat([*held, pdf.iloc[:last]]) if held else pdf.iloc[:last]
        held = [pdf.iloc[last:]]
    if held:
        yield pd.concat(held)


def _judge(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Blocks equal to an earlier one are gone; distinct blocks that can still repeat go on, per anchor (BLOCK) or spread."""
    for r in _by_key(batches):
        fresh, key, first = _collapse(r)
        kind, n = r["kind"].to_numpy(), r["n"].to_numpy()
        old = kind == GONE
        # A row gone already still stands in front of nobody: its own batch has an earlier one with the same bytes.
        which = np.cumsum(key) - 1
        live = first & ~old
        blocks = np.bincount(which, weights=live)[which]
        size = np.bincount(which, weights=np.where(live, np.abs(n) + length - 1, 0))[which]
        more = live & (kind == BLOCK) & ((blocks > 1) | (n < 0))
        large = (blocks > MOST_BLOCKS) | (size > MOST_BYTES)
        out = r.assign(kind=np.where(more, np.where(large, SPREAD, BLOCK), GONE), n=np.abs(n))
        yield out[fresh & (more | ~first | old)]


def _cut(batches: Iterator[pd.DataFrame], length: int, gram: int) -> Iterator[pd.DataFrame]:
    """Bytes of the blocks that go on and where their anchor stands (-1: more than once); windows of the spread ones."""
    w = length - gram + 1
    for pdf in batches:
        out, data_of, off_of = [], [], []
        for doc_id, th, text, todo in zip(pdf["doc_id"], pdf["th"], pdf["text"], pdf["todo"]):
            data = text.encode("utf-8", "surrogatepass")
            whole = [b for b in todo if b["kind"] == BLOCK]
            if whole:
                _, h = _grams(np.frombuffer(data, dtype=np.uint8), gram)
                for b in whole:
                    s, n = b["s"], b["n"]
                    own = h[s:s + n + w - 1]
                    at = int(own.argmin())
                    off_of.append(at if (own == own[at]).sum() == 1 else -1)
                    data_of.append(data[s:s + n + length - 1])
                m = len(whole)
                out.append((np.full(m, BLOCK), np.array([b["k1"] for b in whole], np.int64), np.zeros(m, np.int64),
                            np.full(m, doc_id), np.full(m, th), np.array([b["s"] for b in whole]), np.array([b["n"] for b in whole])))
            wide = [b for b in todo if b["kind"] == SPREAD]
            if wide:
                at, w1, w2 = _starts_windows(data, np.array([b["s"] for b in wide]), np.array([b["n"] for b in wide]), length)
                m = len(at)
                out.append((np.full(m, SPREAD), w1.view(np.int64), w2.view(np.int64), np.full(m, doc_id), np.full(m, th), at, np.ones(m, np.int64)))
                data_of += [None] * m
                off_of += [-1] * m
        if out:
            yield _rows(*[np.concatenate(x) for x in zip(*out)]).assign(off=np.array(off_of, np.int32), data=data_of)


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _reach(parts: list[bytes]) -> list[int]:
    """For every part the longest beginning that any other part has too: its neighbours in sorted order have it."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for x, y in zip(order[:-1], order[1:]):
        n = _shared(parts[x], parts[y])
        out[x], out[y] = max(out[x], n), max(out[y], n)
    return out


def _by_hashes(parts: list[bytes], length: int) -> list[tuple[int, int]]:
    """What ``repeated_windows`` finds, by the 128-bit hashes of all windows."""
    cols = []
    for k, p in enumerate(parts):
        m = len(p) - length + 1
        if m > 0:
            at, w1, w2 = _starts_windows(p, np.array([0]), np.array([m]), length)
            cols.append((np.full(m, k), at, w1, w2))
    k, at, w1, w2 = (np.concatenate(c) for c in zip(*cols))
    order = np.lexsort((w2, w1))
    again = (w1[order][1:] == w1[order][:-1]) & (w2[order][1:] == w2[order][:-1])
    gone = np.sort(order[1:][again])
    return list(zip(k[gone].tolist(), at[gone].tolist()))


def gone_runs(blocks: list[bytes], offs: list[int], length: int) -> list[tuple[int, int, int]]:
    """(block, start, windows) of the repeated windows of one anchor's distinct blocks, given in the order of their places."""
    cut = [(0, len(b)) for b in blocks]
    if len(blocks) > 1 and min(offs) >= 0:
        right = _reach([b[o:] for b, o in zip(blocks, offs)])
        left = _reach([b[:o][::-1] for b, o in zip(blocks, offs)])
        cut = [(o - x, o + y) for o, x, y in zip(offs, left, right)]
    live = [k for k, (a, b) in enumerate(cut) if b - a >= length]
    runs: list[list[int]] = []
    if len(live) > LARGE:
        seen: set[bytes] = set()
        some = []
        for k in live:
            a, b = cut[k]
            part = blocks[k][a:b]
            if part in seen:
                runs.append([k, a, b - a - length + 1])
            else:
                seen.add(part)
                some.append(k)
        live = some
    if live:
        parts = [blocks[k][cut[k][0]:cut[k][1]] for k in live]
        find = repeated_windows if sum(map(len, parts)) <= MOST_ORDERED else _by_hashes
        for i, at in find(parts, length):
            k = live[i]
            at += cut[k][0]
            if runs and runs[-1][0] == k and runs[-1][1] + runs[-1][2] == at:
                runs[-1][2] += 1
            else:
                runs.append([k, at, 1])
    return [(k, a, n) for k, a, n in runs]


def repeated_windows(parts: list[bytes], length: int) -> list[tuple[int, int]]:
    """(part, start) of every window of ``parts`` that also starts in an earlier part, or earlier in its own part."""
    text: list[int] = []
    base, owner = [], {}
    for k, p in enumerate(parts):
        base.append(len(text))
        text += [c + 2 for c in p]
        text.append(1)
    text[-1] = 0  # the end, smaller than the marks between parts
    joined = b"\n".join(parts)
    valid = bytearray(len(text))
    for k, p in enumerate(parts):
        m = len(p) - length + 1
        if m > 0:
            valid[base[k]:base[k] + m] = b"\x01" * m
    gone = []
    last, run = None, []
    for p in suffix_order(text):
        if not valid[p]:
            continue
        w = joined[p:p + length]
        if w == last:
            run.append(p)
        else:
            if len(run) > 1:
                run.remove(min(run))
                gone += run
            last, run = w, [p]
    if len(run) > 1:
        run.remove(min(run))
        gone += run
    gone.sort()
    out, k = [], 0
    for p in gone:
        while k + 1 < len(base) and base[k + 1] <= p:
            k += 1
        out.append((k, p - base[k]))
    return out


def _ordered(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Windows that are not the first: by the suffix order of an anchor's blocks, or by equal hashes where spread."""
    for r in _by_key(batches):
        fresh, key, first = _collapse(r)
        kind = r["kind"].to_numpy()
        spread = r[(kind == SPREAD) & fresh & ~first]
        if len(spread):
            yield spread[["doc_id", "th", "s", "n"]]
        g = r[(kind == BLOCK) & fresh]
        if not len(g):
            continue
        ids, ths, ss, datas, offs, ks = (g[c].tolist() for c in ("doc_id", "th", "s", "data", "off", "k1"))
        rows = []
        lo = 0
        for hi in range(1, len(ks) + 1):
            if hi == len(ks) or ks[hi] != ks[lo]:
                rows += [(lo + k, at, n) for k, at, n in gone_runs(datas[lo:hi], offs[lo:hi], length)]
                lo = hi
        yield pd.DataFrame({"doc_id": np.array([ids[k] for k, _, _ in rows], np.int64), "th": np.array([ths[k] for k, _, _ in rows], np.int32),
                            "s": np.array([ss[k] + at for k, at, _ in rows], np.int32), "n": np.array([m for _, _, m in rows], np.int32)})


def _kept(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for doc_id, text, gone in zip(pdf["doc_id"], pdf["text"], pdf["gone"]):
            data = text.encode("utf-8", "surrogatepass")
            n_removed = n_spans = 0
            kept = data
            if gone is not None and len(gone):
                edge = np.zeros(len(data) + 1, dtype=np.int64)
                s = np.array([g["s"] for g in gone])
                e = s + np.array([g["n"] for g in gone]) + length - 1
                np.add.at(edge, s, 1)
                np.add.at(edge, e, -1)
                off = np.cumsum(edge)[:-1] > 0
                n_removed = int(off.sum())
                n_spans = int(off[0]) + int((off[1:] & ~off[:-1]).sum())
                kept = np.frombuffer(data, dtype=np.uint8)[~off].tobytes()
            rows.append((doc_id, len(data), n_removed, n_spans, hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id (null: the smallest long), th (hash of the text, tells texts under a repeated id apart), text."""
    t = only(docs, "doc_id", "text")
    return t.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
                    F.hash(text_of()).alias("th"), text_of().alias("text"))


def hot_anchors(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, least: int = HOT_ROWS) -> list[int]:
    """At most ``HOT_ANCHORS`` anchors that a sketch over the blocks of all documents finds ``least`` times or more."""
    rows = texts_of(docs).mapInPandas(lambda it: _anchors(it, length, gram), "k1 long")
    top = rows.agg(F.expr(f"approx_top_k(k1, {HOT_ANCHORS}, {COUNTERS})").alias("top"))
    return [r["k"] for r in top.select(F.explode("top").alias("t")).where(f"t.count >= {least}").select(
        F.col("t.item").alias("k")).collect()]


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    Null texts are empty. Rows that repeat id and text count as one document and get the same result. Texts under one
    repeated id are ordered by their hash. A null id counts as the smallest long. Texts shorter than ``length`` bytes lose
    nothing. Other columns, whatever their names, are not read. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    hot = np.array(hot_anchors(docs, length, gram, hot_rows), dtype=np.int64).view(np.uint64)
    t = texts_of(docs)
    spans = t.mapInPandas(lambda it: _spans(it, hot, length, gram), _ROW)
    order = ["k1", "k2", "doc_id", "th", "s"]
    judged = cut_lineage(spans.repartition("k1").sortWithinPartitions(*order).mapInPandas(lambda it: _judge(it, length), _ROW))
    todo = judged.where(F.col("kind") != GONE).groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("kind", "k1", "s", "n")).alias("todo"))
    pieces = t.join(todo, ["doc_id", "th"]).mapInPandas(lambda it: _cut(it, length, gram), _ROW + ", off int, data binary")
    later = pieces.repartition("k1").sortWithinPartitions(*order).mapInPandas(
        lambda it: _ordered(it, length), "doc_id long, th int, s int, n int")
    gone = judged.where(F.col("kind") == GONE).select("doc_id", "th", "s", "n").unionByName(later)
    per = gone.groupBy("doc_id", "th").agg(F.collect_list(F.struct("s", "n")).alias("gone"))
    return t.join(per, ["doc_id", "th"], "left").mapInPandas(
        lambda it: _kept(it, length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir)).drop("kept")
