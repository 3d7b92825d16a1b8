"""MinHash near-duplicates by a multi-index Hamming join.

1. Every text becomes the set of its shingles of ``words`` words (64-bit hashes; five, unless the query's contract says two) and a signature of ``SLOTS`` minima, ``BITS`` bits
   each. Texts with equal sets form one class, represented by the smallest doc_id.
2. Pigeonhole: the signature is split into ``CHUNKS`` chunks. Two signatures that differ in at most ``RADIUS`` slots
   differ in at most one slot of some chunk, so they agree on one of that chunk's keys with one slot left out. All those
   keys are enumerated; classes meet by key. ``2 * CHUNKS > RADIUS`` makes this a guarantee, not a chance.
3. Inside a key's bucket the distances are computed and only a spanning forest of the pairs within ``RADIUS`` leaves the
   task, so rows grow with members, not pairs. A bucket of more than ``BUCKET`` members is compared in pairs of blocks.
   Connected components of the forests are loose groups: every pair within the radius is inside one of them.
4. The exact test on the full sets decides every link: a search outward from each member over those not yet reached. A
   loose group of at most ``GROUP`` members meets once with its texts. A larger one is first divided by sketches, the
   ``SKETCH`` smallest hashes of every set: pairs whose sketches cannot come from linked sets are let go, so texts that share
   a frame but no link never meet. Where more than ``GROUP`` members stay together, each block of them is tested with the
   group's smallest member beside it; what one component then holds is settled, and only blocks with other members
   meet the rest in pairs. Components of the confirmed links are the result.

A pair at a similarity of exactly 0.8 differs in 12.8 slots on average and in more than ``RADIUS`` with a probability
of about 1e-6; nearer pairs are rarer to miss still. Inside large loose groups the sketches' estimate of such a pair is five
standard deviations above ``SKETCH_LEAST``; sets that fit into a sketch are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notesmith.llm.common import documents, only, packed, ship, text_of
from notesmith.llm.components import components
from notesmith.operators.ranking import balanced_row_number
from notesmith.session import cut_lineage

SLOTS, BITS, CHUNKS, RADIUS = 64, 16, 15, 29
#: Bits per slot that travel with the keys for the distance: fewer bits never make a distance larger.
NIBBLE = 4
BUCKET, GROUP = 4096, 256
#: Hashes of a sketch, rows of a block of sketches, and the least estimate (per mille) that is tested on the full sets.
SKETCH, SKETCHES, SKETCH_LEAST = 512, 1024, 711
SIMILAR = 80  # per cent
#: Words of a shingle: of the operator and the pipeline stage, and of the query by its contract.
WORDS, QUERY_WORDS = 5, 2

assert 2 * CHUNKS > RADIUS
_rng = np.random.default_rng(20_240_611)
_XOR = _rng.integers(0, 1 << 64, SLOTS, dtype=np.uint64, endpoint=False)
_MUL = _rng.integers(0, 1 << 64, SLOTS, dtype=np.uint64, endpoint=False) | np.uint64(1)
_PARTS = [p.tolist() for p in np.array_split(np.arange(SLOTS), CHUNKS)]
#: Slots of every key: each chunk with one slot left out.
_KEYS = [[s for s in part if s != out] for part in _PARTS for out in part]


class _Words(dict):
    """64-bit hashes of words, kept for the words of a worker; emptied when large."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


_words = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of n words; of the whole sequence where there are fewer words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    short = len(h) < n
    n = min(n, len(h))
    run = h[:len(h) - n + 1]
    with np.errstate(over="ignore"):
        for k in range(1, n):
            more = h[k:len(h) - n + 1 + k]
            run = _mix(run) * np.uint64(3) + ((more << np.uint64(29)) | (more >> np.uint64(35)))
        # A shorter sequence never equals a shingle of n words.
        return np.unique(_mix(run + np.uint64(n) if short else run))


def signature(s: np.ndarray) -> np.ndarray:
    """``SLOTS`` minima of keyed permutations of the set, mixed and cut to ``BITS`` bits."""
    low = np.full(SLOTS, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 2048):
            np.minimum(low, ((s[at:at + 2048, None] ^ _XOR) * _MUL).min(axis=0), out=low)
    return (_mix(low + np.arange(SLOTS, dtype=np.uint64)) >> np.uint64(64 - BITS)).astype(np.uint16)


def keys_of(sig: np.ndarray) -> np.ndarray:
    """The 64-bit keys of signatures (rows): one per chunk and slot left out."""
    out = np.empty((len(sig), len(_KEYS)), dtype=np.uint64)
    wide = sig.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j, slots in enumerate(_KEYS):
            k = np.full(len(sig), j + 1, dtype=np.uint64)
            for s in slots:
                k = _mix((k << np.uint64(16)) + wide[:, s] + np.uint64(0x9E3779B97F4A7C15))
            out[:, j] = k
    return out.view(np.int64)


def small_of(sig: np.ndarray) -> bytes:
    """The low ``NIBBLE`` bits of every slot, two slots to a byte."""
    low = (sig & np.uint16((1 << NIBBLE) - 1)).astype(np.uint8)
    return ((low[0::2] << NIBBLE) | low[1::2]).tobytes()


def _signed(batches: Iterator[pd.DataFrame], words: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            s = shingles(text, words)
            if len(s):
                sig = signature(s)
                rows.append((doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), sig.tobytes(), small_of(sig)))
            else:
                rows.append((doc_id, 0, None, None, None))
        yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_hash", "sig", "small"])


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 1000):
            part = pdf.iloc[at:at + 1000]
            k = keys_of(np.frombuffer(b"".join(part["sig"]), dtype=np.uint16).reshape(-1, SLOTS))
            yield pd.DataFrame({"key": k.ravel(), "rep": np.repeat(part["rep"].to_numpy(), k.shape[1])})


def _groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of equal ``by`` in rows sorted by it, also where a run goes on in the next batch."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        k = pdf[by].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), len(pdf)]
        if held and (held[-1][by].iloc[-1].to_numpy() != k[0]).any():
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        for a, b in zip(edges[:-1], edges[1:]):
            if b < len(pdf):
                yield pd.concat([*held, pdf.iloc[a:b]]) if held else pdf.iloc[a:b]
                held = []
            else:
                held.append(pdf.iloc[a:b])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _forest(n: int, near) -> list[tuple[int, int]]:
    """Spanning forest of a graph on 0 .. n - 1; ``near(i, rest)`` says which of the indices ``rest`` are next to i."""
    rest = np.arange(n)
    out = []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            found = rest[hit]
            out += [(i, int(j)) for j in found]
            queue += found.tolist()
            rest = rest[~hit]
    return out


_ONES = np.array([(b >> 4 != 0) + (b & 15 != 0) for b in range(256)], dtype=np.uint8)


def _bucket_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    a: list[int] = []
    b: list[int] = []
    for g in _groups(batches, ["key", "i", "j"]):
        if len(g) < 2:
            continue
        reps = g["rep"].to_numpy()
        small = np.frombuffer(b"".join(g["small"]), dtype=np.uint8).reshape(len(g), -1)
        if len(g) == 2:
            if int(_ONES[small[0] ^ small[1]].sum()) <= RADIUS:
                a.append(reps[0])
                b.append(reps[1])
        else:
            for i, j in _forest(len(g), lambda i, rest: _ONES[small[rest] ^ small[i]].sum(axis=1, dtype=np.int64) <= RADIUS):
                a.append(reps[i])
                b.append(reps[j])
        if len(a) > 50_000:
            yield pd.DataFrame({"a": a, "b": b})
            a, b = [], []
    yield pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})


def _overlap(sets: list[np.ndarray]):
    """``common(i, some)``: sizes of the intersections of set i with the sets ``some``; with the flat layout of all sets."""
    sizes = np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(len(values), dtype=np.int32)

    def places(some):
        spots = np.concatenate([[0], np.cumsum(sizes[some])])
        return flat[np.repeat(starts[some] - spots[:-1], sizes[some]) + np.arange(spots[-1])], spots[:-1]

    def common(i, some):
        own = flat[starts[i]:starts[i + 1]]
        mark[own] = 1
        at, spots = places(some)
        n = np.add.reduceat(mark[at], spots)
        mark[own] = 0
        return n

    return common, places


def _linkable(size: int, sizes: np.ndarray) -> np.ndarray:
    """Which sizes a set linked with one of ``size`` can have."""
    return (sizes > 0) & (SIMILAR * sizes <= 100 * size) & (SIMILAR * size <= 100 * sizes)


def _confirmed(batches: Iterator[pd.DataFrame], words: int) -> Iterator[pd.DataFrame]:
    """Spanning forest of the exact links in every group of texts."""
    a: list[int] = []
    b: list[int] = []
    for g in _groups(batches, ["grp", "i", "j"]):
        ids = g["rep"].to_numpy()
        sets = [shingles(t, words) for t in g["text"]]
        sizes = np.array([len(s) for s in sets])
        if len(sets) == 2:
            common = len(np.intersect1d(*sets, assume_unique=True))
            pairs = [(0, 1)] if 100 * common >= SIMILAR * (sizes.sum() - common) else []
        else:
            overlap, _ = _overlap(sets)

            def near(i, rest):
                hit = _linkable(sizes[i], sizes[rest])
                some = rest[hit]
                if len(some):
                    common = overlap(i, some)
                    hit[hit] = 100 * common >= SIMILAR * (sizes[i] + sizes[some] - common)
                return hit
            pairs = _forest(len(sets), near)
        for i, j in pairs:
            a.append(ids[i])
            b.append(ids[j])
    yield pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})


def sketch(s: np.ndarray) -> np.ndarray:
    """The ``SKETCH`` smallest of a set's hashes, cut to 32 bits."""
    return np.unique((s[:2 * SKETCH] >> np.uint64(32)).astype(np.uint32))[:SKETCH]


def _sketched(batches: Iterator[pd.DataFrame], words: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sets = [shingles(t, words) for t in pdf["text"]]
        yield pd.DataFrame({"grp": pdf["grp"], "rep": pdf["rep"], "n": [len(s) for s in sets], "sketch": [sketch(s).tobytes() for s in sets]})


def _sketch_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spanning forest of the pairs whose sketches may come from linked sets.

    The hashes up to the lesser of two sketches' ends are a sample of the union of both sets: the whole of it where
    both sketches are whole sets."""
    a: list[int] = []
    b: list[int] = []
    for g in _groups(batches, ["grp", "i", "j"]):
        ids, sizes = g["rep"].to_numpy(), g["n"].to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint32) for x in g["sketch"]]
        overlap, places = _overlap(sets)
        whole = np.iinfo(np.int64).max
        end = np.array([whole if n <= SKETCH else places(np.array([k]))[0][-1] for k, n in enumerate(sizes)])

        def near(i, rest):
            hit = _linkable(sizes[i], sizes[rest])
            some = rest[hit]
            if len(some):
                upto = np.minimum(end[i], end[some])
                at, spots = places(some)
                theirs = np.add.reduceat((at <= np.repeat(upto, np.diff(np.append(spots, len(at))))).astype(np.int64), spots)
                common = overlap(i, some)
                union = np.searchsorted(places(np.array([i]))[0], upto, side="right") + theirs - common
                # Two hashes cut to 32 bits may fall together, so a whole set may lack one.
                hit[hit] = np.where(upto == whole, 100 * (common + 1) >= SIMILAR * union, 1000 * common >= SKETCH_LEAST * union)
            return hit
        for i, j in _forest(len(sets), near):
            a.append(ids[i])
            b.append(ids[j])
    yield pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})


def _in_blocks(df: DataFrame, group: str, order: list[str], size: DataFrame, most: int) -> DataFrame:
    """df with columns i, j: groups of at most ``most`` rows once (0, 0); larger ones once per pair of blocks.

    A row of a large group is repeated once per block of its group; no task sees more than ``2 * most`` rows of it. Where
    ``size`` has a column ``settled``, so many first rows of the group need not meet each other, and blocks of
    such rows alone do not."""
    t = df.join(size, group)
    settled = F.col("settled") if "settled" in size.columns else F.lit(0)
    small = t.where(F.col("members") <= most).withColumn("at", F.lit(None).cast("struct<i:int,j:int>"))
    large = t.where(F.col("members") > most)
    large = balanced_row_number(large, [group], order, "rn")
    own = F.floor((F.col("rn") - 1) / most).cast("int")
    n = F.ceil(F.col("members") / most).cast("int")
    first = F.floor(settled / most).cast("int")
    others = F.filter(F.sequence(F.lit(0), n - 1), lambda x: (x != own) & (F.greatest(x, own) >= first))
    at = F.transform(others, lambda x: F.struct(F.least(x, own).cast("int").alias("i"), F.greatest(x, own).cast("int").alias("j")))
    large = large.withColumn("at", F.explode(at)).drop("rn")
    both = small.unionByName(large).drop("members", "settled")
    return both.withColumns({"i": F.coalesce("at.i", F.lit(0)), "j": F.coalesce("at.j", F.lit(0))}).drop("at")


def _sizes(df: DataFrame, by: str = "grp") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("members"))


def _meet(df: DataFrame, *by: str) -> DataFrame:
    return df.repartition(*by).sortWithinPartitions(*by)


def _texts(t: DataFrame, members: DataFrame) -> DataFrame:
    """The members (rep) with their texts. Members grow with the documents, so they are never broadcast, also where
    their files happen to be small."""
    return t.join(cut_lineage(members).withColumnRenamed("rep", "doc_id").hint("merge"), "doc_id").withColumnRenamed("doc_id", "rep")


def _exact_links(t: DataFrame, loose: DataFrame, group: int, sketches: int, words: int) -> DataFrame:
    """Links (a, b) that hold together the components of the exact links inside loose groups (grp, its smallest rep; rep).

    All texts are shuffled once, to find those of the members; what follows moves texts of members only, and a second
    time only those of large groups."""
    pairs = "a long, b long"
    confirm = partial(_confirmed, words=words)

    def tested(rows: DataFrame) -> DataFrame:
        return _meet(rows, "grp", "i", "j").mapInPandas(confirm, pairs)

    loose = cut_lineage(loose)
    sizes = _sizes(loose)
    held = cut_lineage(_texts(t, loose.join(sizes, "grp")))
    alone = {"i": F.lit(0), "j": F.lit(0)}
    once = held.where(F.col("members") <= group).select("grp", "rep", "text").withColumns(alone)
    large = sizes.where(F.col("members") > group)
    if large.isEmpty():
        return tested(once)
    # Large groups are divided by sketches.
    held = held.where(F.col("members") > group)
    made = cut_lineage(held.mapInPandas(partial(_sketched, words=words), "grp long, rep long, n long, sketch binary"))
    held = held.select(F.col("rep").alias("doc_id"), "text")
    met = _in_blocks(loose.join(large.select("grp"), "grp"), "grp", ["rep"], large, sketches)
    met = _meet(met.join(made.drop("grp").hint("merge"), "rep"), "grp", "i", "j")
    near = components(met.mapInPandas(_sketch_forest, pairs)).select(F.col("comp").alias("grp"), F.col("id").alias("rep"))
    sizes = cut_lineage(_sizes(near))
    divided = near.join(sizes.where(F.col("members") <= group).select("grp"), "grp").withColumns(alone)
    large = sizes.where(F.col("members") > group)
    # Every block of a group that is still large beside the group's smallest member.
    many = cut_lineage(balanced_row_number(near.join(large, "grp"), ["grp"], ["rep"], "rn"))
    block = F.floor((F.col("rn") - 1) / group).cast("int")
    hubs = many.where("rep = grp").withColumn("i", F.explode(F.sequence(F.lit(1), F.ceil(F.col("members") / group).cast("int") - 1)))
    blocks = many.withColumn("i", block).unionByName(hubs).select("grp", "rep", "i", F.col("i").alias("j"))
    links = cut_lineage(tested(once.unionByName(_texts(held, divided.unionByName(blocks)))))
    found = components(links.join(many.select(F.col("rep").alias("a")), "a", "left_semi").select("a", "b"))
    parts = cut_lineage(many.select("grp", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "grp", "rep", F.coalesce("comp", "rep").alias("part")))
    counted = parts.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("grp").agg(F.sum("n").alias("members"), F.max(F.struct(F.col("n"), F.col("part"))).alias("best"))
    best = cut_lineage(best.select("grp", "members", F.col("best.n").alias("settled"), F.col("best.part").alias("main")).where("members > settled"))
    open_ = parts.join(best.select("grp", "main"), "grp").select("grp", "rep", (F.col("part") != F.col("main")).alias("late"))
    left = _in_blocks(open_, "grp", ["late", "rep"], best.select("grp", "members", "settled"), group).drop("late")
    return links.unionByName(tested(_texts(held, left)))


def _ids(docs: DataFrame) -> DataFrame:
    """doc_id (null: the smallest long), text (null: empty)."""
    t = only(docs, "doc_id", "text")
    return t.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), text_of().alias("text"))


def near_duplicates(docs: DataFrame, bucket: int = BUCKET, group: int = GROUP, words: int = WORDS, sketches: int = SKETCHES) -> DataFrame:
    """One row per input row: doc_id, n_shingles (of ``words`` words), class_id (smallest doc_id with an equal set), component_id, kept.

    Texts without words, also null ones, are linked with nothing. A null id counts as the smallest long. Every row takes the
    component of its own text, also where its id repeats with another text; two texts of which the same id is the smallest are
    one component. Texts are read whole at any length. ``bucket``, ``group`` and ``sketches`` bound the rows that meet at once
    (of keys, texts and sketches) and change no result. Other columns, whatever their
    names, are not read. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    t = _ids(docs)
    signed = cut_lineage(t.mapInPandas(partial(_signed, words=words), "doc_id long, n_shingles long, set_hash binary, sig binary, small binary"))
    classes = cut_lineage(signed.where("set_hash is not null").groupBy("set_hash").agg(
        F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("small").alias("small")))
    keyed = classes.select("rep", "sig").mapInPandas(_keyed, "key long, rep long")
    # Keys travel without signatures; only the members of buckets of two or more classes fetch theirs.
    met = _in_blocks(keyed, "key", ["rep"], _sizes(keyed, "key").where("members > 1"), bucket)
    met = _meet(met.join(classes.select("rep", "small"), "rep"), "key", "i", "j")
    loose = components(met.mapInPandas(_bucket_forest, "a long, b long").distinct())
    links = components(_exact_links(t, loose.select(F.col("comp").alias("grp"), F.col("id").alias("rep")), group, sketches, words))
    reps = classes.select("set_hash", "rep").join(links.withColumnRenamed("id", "rep"), "rep", "left").select(
        "set_hash", F.col("rep").alias("class_id"), F.coalesce("comp", "rep").alias("comp"))
    out = signed.select("doc_id", "n_shingles", "set_hash").join(reps, "set_hash", "left")
    comp = F.coalesce("comp", "doc_id")
    return out.select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"),
                      comp.alias("component_id"), (F.col("doc_id") == comp).alias("kept"))


def op5_minhash_hamming(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=QUERY_WORDS).select("doc_id", "n_shingles", "component_id", "kept", "class_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component (the one with the smallest doc_id), with all columns."""
    keep = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("id")).distinct()
    keyed = docs.select(packed(docs), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"))
    return keyed.join(keep, "id", "left_semi").select("doc.*")
