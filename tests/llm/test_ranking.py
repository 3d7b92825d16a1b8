"""Operators 11 to 13 against brute force, held-out accuracy and the awkward tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from notesmith.llm import angle_negatives, factor_machine, reversed_search
from tests.conftest import SF01
from tests.llm.conftest import LONG, UP, corpus, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ---- 11 ranked lexical search ----------------------------------------------------------------------------------------
def ranked_by_brute_force(items, docs, k=10):
    """{(item_id, rank): (doc_id, score)} from (item_id, text) and (doc_id, text) rows."""
    def terms(t):
        return Counter(TERM.findall((t or "").translate(UP)))

    bags = [(i, terms(t)) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, n_all = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(w for _, b in bags for w in b)
    asked = {}
    for i, t in set(items):
        asked[i] = asked.get(i, Counter()) + terms(t)
    out = {}
    for i, want in asked.items():
        got = []
        for (d, b), n in zip(bags, sizes):
            if d is None or not n:
                continue
            m = 25 + 75 * n * n_docs // n_all
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * b[w] // (1000 * b[w] + 8 * m))
                    for w, q in want.items() if b[w])
            if s > 0:
                got.append((-s, d))
        out |= {(i, r + 1): (d, -s) for r, (s, d) in enumerate(sorted(got)[:k])}
    return out


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "item_id long, text string, doc_id string, score string")


def got_ranks(df):
    rows = df.collect()
    out = {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("block", [dict(), dict(block_items=7), dict(block_bytes=150)])
def test_search_equals_scoring_everything(spark, block):
    docs = corpus(11, 90)
    rnd = random.Random(4)
    items = [(k, " ".join(rnd.choices(rnd.choice(docs)[1].split(), k=rnd.randint(1, 30)))) for k in range(25)]
    items += [(3, "another text of item three"), items[5], (40, "nowhere to be found zzzz"), (41, None), (42, "., !")]
    want = ranked_by_brute_force(items, [(i, t) for i, t, _ in docs])
    got = reversed_search.reversed_search(items_of(spark, items), table(spark, docs).repartition(5), **block)
    assert got_ranks(got) == want and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_search_ties_repeated_rows_and_awkward_rows(spark, edge, nothing, monkeypatch):
    from tests.llm.conftest import EDGE

    docs = EDGE + [(i, "same words in every copy", "a") for i in range(500, 440, -1)] + [(450, "same words in every copy", "a")]
    items = [(1, "SAME words"), (None, "hello world"), (3, "日本語 straße É É"), (4, "w1 w4 end"), (5, LONG)]
    want = ranked_by_brute_force(items, [(i, t) for i, t, _ in docs])
    # few scores, postings and bytes at a time: the same rows
    small = (("SCORES", 7), ("POSTINGS", 50), ("PIECE", 300))
    assert got_ranks(reversed_search.reversed_search(items_of(spark, items), table(spark, docs).repartition(4))) == want
    for name, n in small:
        monkeypatch.setattr(reversed_search, name, n)
    assert sum(len(p) for p in reversed_search.pieces(LONG.encode())) == len(TERM.findall(LONG))
    assert [d for (i, r), (d, _) in sorted(want.items(), key=str) if i == 1 and r < 10][:2] == [441, 442]
    assert reversed_search.reversed_search(items_of(spark, items), nothing).count() == 0
    assert reversed_search.reversed_search(items_of(spark, []), edge).count() == 0
    assert reversed_search.reversed_search(items_of(spark, [(1, None), (2, "")]), edge).columns == ["item_id", "rank", "doc_id", "score"]


def test_heaps_hold_the_first_k_whatever_the_batches():
    rnd = np.random.default_rng(2)
    scores, docs = rnd.integers(0, 6, (300, 4)), rnd.permutation(300)
    for step in (1, 7, 300):
        h = reversed_search.Heaps(4, 10)
        for s in range(0, 300, step):
            h.offer(docs[s:s + step], scores[s:s + step])
        assert sorted(h.rows()) == sorted((i, int(docs[d]), int(scores[d, i])) for i in range(4)
                                          for d in sorted(range(300), key=lambda d: (-scores[d, i], docs[d]))[:10])


# ---- 12 quality classifier -------------------------------------------------------------------------------------------
def test_sum_of_squares_equals_all_pairs():
    rnd = np.random.default_rng(0)
    m = factor_machine.Machine.new(("a",), 5)
    m.w[:] = rnd.normal(size=m.w.shape)
    m.v[:] = rnd.normal(size=m.v.shape)
    m.bias = 0.3
    rows = [factor_machine.places(t.encode(), [3.0]) for t in ("one two three two", "", "Ünïcode text\nand lines\nand lines")]
    ends = np.cumsum([0] + [len(i) for i, _ in rows])
    got, _ = m.logits(np.concatenate([i for i, _ in rows]), np.concatenate([x for _, x in rows]), ends)
    for (i, x), g in zip(rows, got):
        pairs = sum(float(m.v[i[a]].astype(float) @ m.v[i[b]]) * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert g == pytest.approx(0.3 + float(m.w[i] @ x) + pairs, rel=1e-4, abs=1e-4)


def test_gradient_steps_learn_an_interaction():
    """Labels that only a pair decides: y = 1 where both or neither of two places are set."""
    rnd = np.random.default_rng(1)
    a, b = rnd.integers(0, 2, 600), rnd.integers(0, 2, 600)
    at, value = np.stack([a, 2 + b], 1).ravel(), np.ones(1200)
    m = factor_machine.Machine.new()
    m.learn(at, value, np.arange(0, 1201, 2), (a == b).astype(int), 30, 0)
    assert ((m.scores(at, value, np.arange(0, 1201, 2)) >= 0.5) == (a == b)).mean() > 0.99


def test_held_out_quality(spark):
    s = factor_machine.op12_factor_machine(spark, SF01).toPandas()
    y = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "quality").toPandas()
    j = s[s.held_out].merge(y, on="doc_id")
    good, bad = j.score[j.quality == 1].to_numpy(), j.score[j.quality == 0].to_numpy()
    auc = ((good[:, None] > bad[None]) + 0.5 * (good[:, None] == bad[None])).mean()
    assert auc > 0.97 and (j.predicted == j.quality).mean() > 0.95
    import zlib

    assert all((zlib.crc32(str(i).encode()) % 3 == 1) == h for i, h in zip(s.doc_id, s.held_out))


def test_held_out_labels_and_identity_are_not_inputs(spark):
    """Other held-out labels, languages and sources leave every score as it is."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(300).cache()
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    one = factor_machine.train(docs, labels, rounds=1)
    flipped = labels.withColumn("quality", F.when(factor_machine.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    two = factor_machine.train(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string")), flipped, rounds=1)
    assert np.array_equal(one.w, two.w) and np.array_equal(one.v, two.v) and one.bias == two.bias


def test_classifier_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, 1, 0), (4, None, 0), (5, 0, 0), (5, 0, 0), (6, 7, 1), (8, 1, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    used = {r["doc_id"]: r["y"] for r in factor_machine.labelled(labels).collect()}
    import zlib

    assert used == {i: y for i, y in {1: 1, 5: 0, 8: 1}.items() if zlib.crc32(str(i).encode()) % 3 != 1}
    assert factor_machine.labelled(labels, max_rows=1).count() == min(1, len(used))
    m = factor_machine.train(edge, labels, rounds=1)
    rows = factor_machine.score(edge, m).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert factor_machine.score(nothing, m).count() == 0
    blank = factor_machine.train(edge, labels.where("doc_id < 0"))
    assert all(abs(r["score"] - 0.5) < 0.1 for r in factor_machine.score(edge, blank).collect())
    long = LONG.encode() * 3
    words, size = factor_machine.word_counts(long)
    assert sum(words.values()) == len(long.split()) and size == sum(map(len, long.split()))


def test_words_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    whole = factor_machine.word_counts(LONG.encode())
    monkeypatch.setattr(factor_machine, "PIECE", 50)
    assert factor_machine.word_counts(LONG.encode()) == whole


# ---- 13 hard negatives -----------------------------------------------------------------------------------------------
def negatives_by_brute_force(rows, every=100):
    """Set of result rows from (vec_id, vector, label) rows without repeated ids."""
    own = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = set()
    for a, q, label in own:
        if a % every:
            continue
        all_ = sorted((-sum(x * y for x, y in zip(q, p)), i, lab) for i, p, lab in own if i != a and len(p) == len(q))
        for ps, pos, lab in [x for x in all_ if x[2] == label][:5]:
            inside = [(s, i) for s, i, lab in all_ if lab != label and 80 * -ps <= 100 * -s <= 100 * -ps]
            out |= {(a, pos, r + 1, i, -ps, -s) for r, (s, i) in enumerate(inside[:5])}
    return out


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "x", "x") for i, v, lab in rows],
                                 "vec_id long, embedding array<float>, label int, q string, norm string, angles string")


def clouds(seed, n=260, d=6, copies=60):
    """Vectors around a few centres of different lengths, many equal ones, exact in float."""
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 2) for _ in range(d)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rnd.choice(centres)
        rows.append((i, [round(64 * (x + rnd.gauss(0, 0.3))) / 64 for x in c], rnd.randrange(4)))
    same = rows[0][1]
    return rows + [(n + k, same, rnd.randrange(4)) for k in range(copies)]


@pytest.mark.parametrize("seed, how", [(1, dict()), (2, dict(anchors=3)), (3, dict(directions=1, sample=5))])
def test_negatives_equal_scoring_every_pair(spark, seed, how):
    rows = clouds(seed)
    got = angle_negatives.hard_negatives(vectors_of(spark, rows).repartition(6), every=20, **how)
    found = [tuple(r) for r in got.collect()]
    assert set(found) == negatives_by_brute_force(rows, 20) and len(found) == len(set(found)) > 100
    assert [f"{n}:{t}" for n, t in got.dtypes] == ["anchor_id:bigint", "positive_id:bigint", "rank:int", "negative_id:bigint",
                                                   "positive_score:bigint", "negative_score:bigint"]


def test_bounds_enclose_every_score_and_rule_pairs_out():
    rnd = np.random.default_rng(5)
    q = np.concatenate([rnd.normal(c, 20, (200, 8)) for c in (rnd.normal(0, 200, 8), rnd.normal(0, 200, 8), np.zeros(8))])
    q = np.concatenate([np.floor(q), -q[:5].round(), np.zeros((2, 8))]).astype(np.int64)
    norm = np.linalg.norm(q.astype(float), axis=1)
    refs = q[[0, 250, 500]] / norm[[0, 250, 500], None]
    a = angle_negatives.angles_to(q.astype(float), norm, refs)
    low, high = angle_negatives.bounds(norm, a, a, norm, norm, a, a)
    score = q @ q.T
    assert (low <= score).all() and (score <= high).all()
    assert (high < 0.8 * norm[:, None] * norm[None]).mean() > 0.2
    at = np.arange(0, len(q), 50)
    low, high = angle_negatives.bounds(norm, a, a, np.minimum.reduceat(norm, at), np.maximum.reduceat(norm, at),
                                       np.minimum.reduceat(a, at), np.maximum.reduceat(a, at))
    for k, s in enumerate(at):
        assert (low[:, k:k + 1] <= score[:, s:s + 50]).all() and (score[:, s:s + 50] <= high[:, k:k + 1]).all()


def test_negatives_on_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 3), (1, [1.0, 2.0], 3), (2, [1.0, 1.9], 4), (3, [nan, 1.0], 3), (4, [inf, 1.0], 4), (5, [1.0, None], 4), (6, None, 4),
            (8, [1.0, 2.0], None), (None, [1.0, 2.0], 4), (9, [], 4), (100, [], 3), (10, [], 3), (11, [1.0], 4), (200, [0.0, 0.0], 4), (12, [0.0, 0.0], 4),
            (13, [1e30, 1.0], 4), (300, [-1.0, -2.0], 4), (14, [-1.0, 0.5], 4), (15, [1.0, 0.0], 5), (700, [1.0, 2.0], 9), (16, [0.5, 1.0], 0), (17, [0.5, 1.0], 1)]
    got = [tuple(r) for r in angle_negatives.hard_negatives(vectors_of(spark, rows)).collect()]
    assert set(got) == negatives_by_brute_force([r for r in rows if r[0] != 13]) and len(got) == len(set(got)) > 3
    again = [tuple(r) for r in angle_negatives.hard_negatives(vectors_of(spark, rows + rows[:3] + rows[19:])).collect()]
    assert sorted(again) == sorted(got)  # repeated rows add nothing
    assert angle_negatives.hard_negatives(vectors_of(spark, [])).count() == 0
    assert angle_negatives.hard_negatives(vectors_of(spark, rows[1:9])).count() == 0
