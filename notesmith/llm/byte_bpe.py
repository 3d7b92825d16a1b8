"""Byte-level BPE with Spark higher-order functions.

The ranks of a vocabulary become a literal rank map: pair of ids -> rank of the merged token, for every way to cut a token
into two tokens. Spark looks maps up by scanning, so the literal is a hash table laid out in three arrays without
collisions (``_table``); keys are compared in full.

Encoding: a native regular expression splits the text into words, and every distinct word is folded once: its bytes start
as ids with the ranks of neighbouring pairs, and every step merges the leftmost pair of lowest rank. A merged token's id
is its rank. The ids of the distinct words then go back into the places of the words. Decoding looks up the bytes of
every id and concatenates them with higher-order functions. Nothing is shuffled.

The fold has two kernels with equal results. ``fold`` is made of higher-order functions alone: the distinct words of
windows of ``WINDOW`` words, and an ``aggregate`` per word; its interpreted steps cost too much for a whole corpus
(figures in README.md). ``arrow``, the default, takes the words of many texts as one Arrow batch, finds the distinct ones
there and does each merge step for all of them at once.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notesmith.llm.common import documents, let, ship, text_of

NO_RANK = (1 << 31) - 1
#: Words of a text that share one list of distinct words: bounds the search for a word's place in it.
WINDOW = 512
_BUCKETS, _SLOTS = 1 << 16, 1 << 18


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """token bytes -> rank from a rank file. The driver reads it once; tasks get it inside the plan."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """(left id << 17 | right id) -> rank, for every cut of a token into two tokens."""
    out = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                out[a << 17 | b] = rank
    return out


def _table(pairs: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Displacements per bucket, keys and ranks per slot: a hash table in which every key has a slot of its own.

    A key's bucket is ``h & (buckets - 1)``, its slot ``((h >>> 16) + d * ((h >>> 44) | 1)) & (slots - 1)`` with the bucket's d."""
    keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
    h = np.array([xxhash.xxh64_intdigest(int(k).to_bytes(8, "little", signed=True), seed=42) for k in keys],
                 dtype=np.uint64)
    bucket = (h & np.uint64(_BUCKETS - 1)).astype(np.int64)
    base, step = (h >> np.uint64(16)).astype(np.int64), (h >> np.uint64(44)).astype(np.int64) | 1
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=_BUCKETS)
    starts = np.concatenate([[0], np.cumsum(counts)])
    shift, slot_key, slot_rank = np.zeros(_BUCKETS, np.int64), np.full(_SLOTS, -1, np.int64), np.full(_SLOTS, NO_RANK, np.int64)
    for b in np.argsort(-counts, kind="stable"):
        own = order[starts[b]:starts[b + 1]]
        if not len(own):
            break
        for d in range(1 << 15):
            s = (base[own] + d * step[own]) & (_SLOTS - 1)
            if (slot_key[s] < 0).all() and len(set(s.tolist())) == len(own):
                break
        else:
            raise ValueError("the table is too full")
        shift[b], slot_key[s] = d, keys[own]
        slot_rank[s] = [pairs[int(k)] for k in keys[own]]
    return shift, slot_key, slot_rank


def _array(values, kind: str) -> Column:
    """A literal array: Spark folds the constant split once while it plans."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


@lru_cache(maxsize=4)
def _literals(items: tuple) -> dict[str, list]:
    ranks = dict(items)
    shift, slot_key, slot_rank = _table(pair_ranks(ranks))
    return {"shift": shift.tolist(), "key": slot_key.tolist(), "rank": slot_rank.tolist()} | _singles(ranks)


def _merge_all(data: np.ndarray, starts: np.ndarray, single: np.ndarray, first: np.ndarray, keys: np.ndarray,
               ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids of all words and their starts; ``data`` holds the words' bytes end to end, ``starts`` (n + 1) where they begin.

    Every round merges the leftmost pair of lowest rank of every word that still has one; finished words leave."""
    n = len(starts) - 1
    ids, word = single[data], np.repeat(np.arange(n), np.diff(starts))
    out_ids, out_word = [], []
    codes = data.astype(np.int64)
    rank = None
    while len(ids):
        pair = np.flatnonzero(word[1:] == word[:-1])
        if rank is None:
            got = first[codes[pair] << 8 | codes[pair + 1]]
        else:
            want = ids[pair] << 17 | ids[pair + 1]
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            got = np.where(keys[at] == want, ranks[at], NO_RANK)
        rank = np.full(len(ids), NO_RANK, dtype=np.int64)
        rank[pair] = got
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.concatenate([heads, [len(ids)]])))
        done = best == NO_RANK
        out_ids.append(ids[done])
        out_word.append(word[done])
        hit = np.flatnonzero((rank == best) & ~done)
        hit = hit[np.concatenate([[True], word[hit][1:] != word[hit][:-1]])] if len(hit) else hit
        ids[hit] = best[hit]
        stay = ~done
        stay[hit + 1] = False
        ids, word = ids[stay], word[stay]
    if not out_ids:
        return ids, np.zeros(n + 1, dtype=np.int64)
    ids, word = np.concatenate(out_ids), np.concatenate(out_word)
    order = np.argsort(word, kind="stable")
    return ids[order], np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n))])


#: Bytes from which a word is merged by itself: every round of ``_merge_all`` costs the lengths of all words that are left.
LONG = 256


def _merge_long(data: np.ndarray, single: np.ndarray, first: np.ndarray, pairs: dict[int, int]) -> np.ndarray:
    """ids of one word: a linked list of its pieces and a heap of (rank, place), so n bytes cost n log n steps."""
    n = len(data)
    codes = data.astype(np.int64)
    rank = [*first[codes[:-1] << 8 | codes[1:]].tolist(), NO_RANK]
    ids, after, before = single[data].tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, at) for at, r in enumerate(rank) if r != NO_RANK]
    heapq.heapify(heap)
    while heap:
        r, at = heapq.heappop(heap)
        if rank[at] != r:  # the pair has changed since
            continue
        gone = after[at]
        ids[at], rank[gone] = r, NO_RANK
        after[at] = nxt = after[gone]
        rank[at] = NO_RANK
        if nxt < n:
            before[nxt] = at
            rank[at] = pairs.get(r << 17 | ids[nxt], NO_RANK)
            if rank[at] != NO_RANK:
                heapq.heappush(heap, (rank[at], at))
        prev = before[at]
        if prev >= 0:
            rank[prev] = pairs.get(ids[prev] << 17 | r, NO_RANK)
            if rank[prev] != NO_RANK:
                heapq.heappush(heap, (rank[prev], prev))
    out, at = [], 0
    while at < n:
        out.append(ids[at])
        at = after[at]
    return np.array(out, dtype=np.int64)


def _merge_words(data: np.ndarray, starts: np.ndarray, single: np.ndarray, first: np.ndarray, pairs: dict[int, int],
                 keys: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids of all words and their starts; long words one by one, the others in common rounds."""
    size = np.diff(starts)
    long = np.flatnonzero(size >= LONG)
    if not len(long):
        return _merge_all(data, starts, single, first, keys, ranks)
    rest = np.where(size >= LONG, 0, size)
    ids, at = _merge_all(data[np.repeat(size < LONG, size)], np.concatenate([[0], np.cumsum(rest)]), single, first, keys, ranks)
    parts, upto = [], 0
    for k in long.tolist():
        parts += [ids[upto:at[k]], _merge_long(data[starts[k]:starts[k + 1]], single, first, pairs)]
        upto = at[k]
    parts.append(ids[upto:])
    n_ids = np.diff(at)
    n_ids[long] = [len(p) for p in parts[1::2]]
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(n_ids)])


#: Distinct words merged at once: bounds the arrays of a task.
AT_ONCE = 200_000
#: Texts of an Arrow batch whose words are coded together: bounds the copies of their words.
TEXTS_AT_ONCE = 2000


def _arrow_kernel(ranks: dict[bytes, int]):
    """Arrow function: the words of texts -> the ids of texts. Each distinct word of a batch is merged once."""
    import pyarrow as pa

    pairs = pair_ranks(ranks)
    keys = np.sort(np.fromiter(pairs, dtype=np.int64, count=len(pairs)))
    values = np.array([pairs[int(k)] for k in keys], dtype=np.int64)
    lit = _singles(ranks)
    single, first = np.array(lit["single"], np.int64), np.array(lit["first"], np.int64)

    def ids_of(words: pa.Array) -> pa.Array:
        """int lists of distinct words."""
        raw = words.cast(pa.large_binary())
        parts = []
        for at in range(0, len(raw), AT_ONCE):
            part = pa.concat_arrays([raw.slice(at, AT_ONCE)])
            offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset:part.offset + len(part) + 1]
            data = np.frombuffer(part.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
            ids, starts = _merge_words(data, offsets - offsets[0], single, first, pairs, keys, values)
            parts.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def some(lists: pa.Array) -> pa.Array:
        coded = lists.flatten().dictionary_encode()
        words = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        per_word = ids_of(coded.dictionary).take(coded.indices)
        upto = np.concatenate([[0], np.cumsum(per_word.value_lengths().to_numpy(zero_copy_only=False))])
        return pa.ListArray.from_arrays(pa.array(upto[words], pa.int32()), per_word.flatten())

    def kernel(lists):
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        parts = [some(lists.slice(at, TEXTS_AT_ONCE)) for at in range(0, len(lists), TEXTS_AT_ONCE)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    kernel.__annotations__ = {"lists": pa.Array, "return": pa.Array}  # how Spark knows the kind of function
    return kernel


def _singles(ranks: dict[bytes, int]) -> dict[str, list]:
    single = [ranks.get(bytes([b])) for b in range(256)]
    if None in single:
        raise ValueError("a byte-level vocabulary has all 256 bytes as tokens")
    return {"single": single, "first": [ranks.get(bytes([a, b]), NO_RANK) for a in range(256) for b in range(256)]}


def encoded(texts: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``texts`` with ids (array<int>) in place of text, by the ``arrow`` kernel."""
    kernel = F.arrow_udf(_arrow_kernel(ranks), "array<int>")
    rest = [F.col(f"`{c}`") for c in texts.columns if c != "text"]
    words = F.regexp_extract_all("text", F.lit("(?U)" + pattern), F.lit(0))
    return texts.select(*rest, kernel(words).alias("ids"))


def encode(text: Column, ranks: dict[bytes, int], pattern: str) -> Column:
    """ids (array<int>) of a text by the ``fold`` kernel; a null text counts as empty."""
    lit = _literals(tuple(ranks.items()))
    tables = F.struct(*[_array(lit[k], "bigint" if k == "key" else "int").alias(k) for k in ("shift", "key", "rank", "single", "first")])
    none = F.lit(NO_RANK)

    def lookup(t, left, right):
        def at(key, h):
            slot = (F.shiftrightunsigned(h, 16) + F.get(t["shift"], h.bitwiseAND(F.lit(_BUCKETS - 1))).cast("long")
                    * F.shiftrightunsigned(h, 44).bitwiseOR(F.lit(1))).bitwiseAND(F.lit(_SLOTS - 1))
            return let(slot.cast("int"), lambda s: F.when(F.get(t["key"], s) == key, F.get(t["rank"], s)).otherwise(none))
        return let(left.cast("long") * F.lit(1 << 17) + right, lambda key: let(F.xxhash64(key), lambda h: at(key, h)))

    nothing = F.array().cast("array<int>")

    def merged(t, a, m, k):
        ids, rk = a["ids"], a["ranks"]
        n = F.size(ids)
        left = F.when(k > 1, F.array(lookup(t, F.get(ids, k - 2), m))).otherwise(nothing)
        right = F.when(k + 1 < n, F.array(lookup(t, m, F.get(ids, k + 1)))).otherwise(nothing)
        return F.struct(
            F.concat(F.slice(ids, F.lit(1), k - 1), F.array(m), F.slice(ids, k + 2, n)).alias("ids"),
            F.concat(F.slice(rk, F.lit(1), F.greatest(k - 2, F.lit(0))), left, right, F.slice(rk, k + 2, n)).alias("ranks"))

    def step(t):
        return lambda a, _: let(F.array_min(a["ranks"]), lambda m: F.when(
            m < none, let(F.array_position(a["ranks"], m).cast("int"), lambda k: merged(t, a, m, k))).otherwise(a))

    def fold(t, word):
        codes = F.transform(F.split(F.decode(word.cast("binary"), "ISO-8859-1"), ""), lambda c: F.ascii(c))
        return let(codes, lambda c: F.when(F.size(c) == 1, F.transform(c, lambda x: F.get(t["single"], x))).otherwise(
            F.aggregate(
                F.sequence(F.lit(2), F.size(c)),
                F.struct(F.transform(c, lambda x: F.get(t["single"], x)).alias("ids"),
                         F.transform(F.slice(c, F.lit(2), F.size(c)), lambda x, i: F.get(
                             t["first"], F.get(c, i) * 256 + x)).alias("ranks")),
                step(t), lambda a: a["ids"])))

    def window(t, words):
        return let(F.array_distinct(words), lambda own: let(F.transform(own, lambda w: fold(t, w)), lambda ids: F.flatten(
            F.transform(words, lambda w: F.get(ids, F.array_position(own, w).cast("int") - 1)))))

    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))

    def whole(t):
        return let(words, lambda ws: F.when(F.size(ws) == 0, nothing).otherwise(F.flatten(F.transform(
            F.sequence(F.lit(1), F.size(ws), F.lit(WINDOW)), lambda at: window(t, F.slice(ws, at, F.lit(WINDOW)))))))

    return let(tables, whole)


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of ids: pieces are looked up in hexadecimal form and concatenated. An id outside the vocabulary adds nothing."""
    pieces = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.hex().upper()
    table = F.split(F.lit(",".join(pieces)), ",")
    return F.unhex(let(table, lambda t: F.array_join(F.transform(ids, lambda i: F.get(t, i)), "")))


def id_bytes(ids: Column, ranks: dict[bytes, int]) -> Column:
    """ids as little-endian unsigned 32-bit integers."""
    table = F.split(F.lit(",".join(i.to_bytes(4, "little").hex().upper() for i in range(max(ranks.values()) + 1))), ",")
    return F.unhex(let(table, lambda t: F.array_join(F.transform(ids, lambda i: F.get(t, i)), "")))


def vocabulary(spark: SparkSession, path: str | None = None, pattern: str | None = None) -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public vocabulary, or of the given ones."""
    import public_tokenizers as P

    return read_ranks(spark, path or P.path("byte_bpe_50k.tiktoken")), pattern or P.PATTERN


def tokenize(docs: DataFrame, ranks: dict[bytes, int], pattern: str, kernel: str = "arrow") -> DataFrame:
    """doc_id, ids, n_tokens, decoded per input row.

    Null and empty texts have no ids. Repeated rows are encoded each by itself; ids and nulls in doc_id are passed on. Other
    columns, whatever their names, are not read. An empty table gives no rows.
    """
    t = docs.select("doc_id", text_of().alias("text"))
    if kernel == "fold":
        t = t.select("doc_id", encode(F.col("text"), ranks, pattern).alias("ids"))
    else:
        ship(docs.sparkSession)
        t = encoded(t, ranks, pattern)
    return t.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), decode(F.col("ids"), ranks).alias("decoded"))


def _digests(docs: DataFrame, ranks, pattern) -> DataFrame:
    t = tokenize(docs, ranks, pattern)
    return t.select("doc_id", "n_tokens", F.sha2(id_bytes(F.col("ids"), ranks), 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return _digests(documents(spark, sf_dir), *vocabulary(spark))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row; the last stage."""
    return _digests(docs, *vocabulary(spark))
