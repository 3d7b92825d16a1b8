"""Density clustering against plain sequential statements: nearest rows, cuts, merge trees, clusters; and what the bounds save."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from notesmith.operators import density, linkage, vector_blocks


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Many small jobs: fewer tasks each."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def frame(spark, rows):
    return spark.createDataFrame([(int(i), None if x is None else [float(v) for v in x]) for i, x in rows], "vec_id long, embedding array<float>")


def matrix(rows):
    x = np.array([np.asarray(r[1], np.float32) for r in rows]).astype(float)
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


def blobs(seed, n=120, k=6, dim=5, spread=5.0):
    rng = np.random.default_rng(seed)
    c = rng.normal(0, spread, (k, dim))
    return [(i, c[i % k] + rng.normal(0, 1, dim)) for i in range(n)]


def lattice(seed, n=130):
    """Points on a small grid: many copies, many equal distances."""
    rng = np.random.default_rng(seed)
    return [(1000 - i, rng.integers(0, 6, 2)) for i in range(n)]


def cores(d, k):
    e = d.copy()
    np.fill_diagonal(e, np.inf)
    return np.sort(e, axis=1)[:, k - 1]


@pytest.mark.parametrize("rows, size", [(blobs(1), 8), (lattice(2), None)])
def test_nearest_rows_equal_all_pairs(spark, rows, size):
    d, ids = matrix(rows), [r[0] for r in rows]
    df = frame(spark, rows)
    e = d + np.diag([np.inf] * len(rows))
    got = {}
    for r in density.nearest_distances(df, 3, block_size=size).collect():
        got.setdefault(r["vec_id"], {})[r["rank"]] = r["dist"]
    assert all(np.allclose([got[i][k] for k in (1, 2, 3)], sorted(e[n])[:3]) for n, i in enumerate(ids))
    nn = {r["vec_id"]: r["nn"] for r in density.nearest_neighbor(df, block_size=size).collect()}
    for n, i in enumerate(ids):
        least = round(e[n].min(), 9)
        assert nn[i] == min(j for m, j in enumerate(ids) if m != n and round(e[n][m], 9) == least)


def test_nearest_rows_of_awkward_tables(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [3.0, 4.0])]
    df = frame(spark, rows).withColumn("rep", F.lit("x"))
    assert {r["vec_id"]: r["core"] for r in density.core_distances(df, 2).collect()} == {1: 5.0, 2: 5.0, 4: 5.0}
    none = frame(spark, [])
    assert density.core_distances(none, 2).count() == density.nearest_neighbor(none).count() == density.hierarchy_labels(none).count() == 0
    assert density.fixed_cut_labels(none)[0].count() == 0
    assert {r["vec_id"]: r["label"] for r in density.hierarchy_labels(df, 2, 2).collect()} == {1: -1, 2: -1, 4: -1}


def test_bounds_never_exceed_distances_and_spare_most_copies(spark):
    rows = blobs(5, 1600, 32, 8, 40.0)
    b = vector_blocks.blocked(frame(spark, rows), "vec_id", "embedding", 50)
    assert b.count == 32
    near, sent = density._nearest(b, 2)
    copies = sent.count()
    assert copies < 0.2 * 1600 * b.count  # all pairs of blocks: 32 copies of each row
    ranks = {(r["rep"], r["rank"]): r["dist"] for r in near.collect()}
    d = matrix(rows)
    assert np.allclose([ranks[i, 2] for i in range(1600)], cores(d, 2))
    x = np.array([r[1] for r in rows])
    gaps = vector_blocks.distances(x, x[:7])
    lo, hi = np.minimum.reduceat(gaps, np.arange(0, 1600, 50)), np.maximum.reduceat(gaps, np.arange(0, 1600, 50))
    least = np.minimum.reduceat(vector_blocks.distances(x, x), np.arange(0, 1600, 50), axis=1)
    assert (vector_blocks.lower_bounds(gaps, lo, hi) <= least).all()


def test_one_vector_in_most_rows_meets_no_pair_of_blocks(spark):
    rows = blobs(6, 100, 4) + [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(3000)]
    b = vector_blocks.blocked(frame(spark, rows), "vec_id", "embedding", 10)
    assert b.count == 11 and b.rows.count() == 101 and b.ids.count() == 3100
    got = {r["vec_id"]: r["core"] for r in density.core_distances(frame(spark, rows), 2).collect()}
    assert len(got) == 3100 and {got[1000 + i] for i in range(3000)} == {0.0}


def test_forest_spans_the_links_with_fewer_edges_than_rows():
    rng = np.random.default_rng(0)
    for n, m, p in ((9, 7, 0.1), (30, 40, 0.03), (30, 40, 0.5), (1, 5, 1.0)):
        adj = rng.random((n, m)) < p
        i, j = density.forest_links(adj, False)
        assert adj[i, j].all() and len(i) <= n + m - 1

        def parts(pairs):
            of = list(range(n + m))
            for a, b in pairs:
                x, y = of[a], of[n + b]
                of = [min(x, y) if z in (x, y) else z for z in of]
            return of

        assert parts(zip(i.tolist(), j.tolist())) == parts(zip(*(x.tolist() for x in np.nonzero(adj))))
        if n == m or n <= m:
            sq = adj[:, :n] | adj[:, :n].T
            i, j = density.forest_links(sq, True)
            assert len(i) < n and sq[i, j].all()


@pytest.mark.parametrize("rows, q, size", [(blobs(7), 0.5, 8), (lattice(8), 0.3, 10)])
def test_fixed_cut_equals_components_of_all_pairs(spark, rows, q, size):
    d, ids = matrix(rows), [r[0] for r in rows]
    core = cores(d, 2)
    labels, cut = density.fixed_cut_labels(frame(spark, rows), 2, 3, quantile=q, block_size=size)
    assert cut == pytest.approx(np.sort(core)[max(1, int(np.ceil(q * len(rows)))) - 1])
    w = np.maximum(d, np.maximum(core[:, None], core[None])) <= cut + 1e-12
    np.fill_diagonal(w, False)
    comp = list(ids)
    for _ in ids:
        comp = [min([comp[n]] + [comp[m] for m in np.nonzero(w[n])[0]]) for n in range(len(ids))]
    want = {i: c if comp.count(c) >= 3 else -1 for i, c in zip(ids, comp)}
    assert {r["vec_id"]: r["label"] for r in labels.collect()} == want
    b = vector_blocks.blocked(frame(spark, rows), "vec_id", "embedding", size)
    core_df = density.rep_cores(b, 2)
    sent = density._reaching(b, core_df, cut)
    assert density.reach_forest(b, core_df, cut).count() <= sent.count()


def hierarchy(rows, k=2, m=3):
    """{id: label} by growing one tree point by point: components under a distance are stretches of the joining order."""
    ids, n = [r[0] for r in rows], len(rows)
    if n < max(m, k + 1, 2):
        return {i: -1 for i in ids}
    d = matrix(rows)
    core = cores(d, k)
    w = np.round(np.maximum(d, np.maximum(core[:, None], core[None])), linkage.DIGITS)
    order, join, best = [0], [np.inf], w[0].copy()
    while len(order) < n:
        j = min(set(range(n)) - set(order), key=lambda j: (best[j], j))
        order.append(j)
        join.append(best[j])
        best = np.minimum(best, w[j])
    spans = {}
    for i in range(1, n):
        lo, hi = i - 1, i
        while lo > 0 and join[lo] <= join[i]:
            lo -= 1
        while hi + 1 < n and join[hi + 1] <= join[i]:
            hi += 1
        spans[lo, hi] = join[i]
    size = lambda s: s[1] - s[0] + 1
    big = [s for s in spans if size(s) >= m]

    def around(s, among):
        return min((t for t in among if t[0] <= s[0] and t[1] >= s[1] and t != s), key=size, default=None)

    up = {s: around(s, big) for s in big}
    starts = [s for s in big if up[s] is None or sum(up[t] == up[s] for t in big) >= 2]
    cluster = {s: s if s in starts else around(s, starts) for s in big}
    rate = lambda x: 1 / max(x, linkage.LEAST)
    birth = {s: 0.0 if up[s] is None else rate(spans[up[s]]) for s in starts}
    parent = {s: None if up[s] is None else cluster[up[s]] for s in starts}
    mass = {s: -size(s) * birth[s] for s in starts}
    for s in starts:
        if parent[s]:
            mass[parent[s]] += size(s) * birth[s]
    home = []
    for i in range(n):
        s = min((s for s in big if s[0] <= i <= s[1]), key=size)
        mass[cluster[s]] += rate(spans[s])
        home.append(cluster[s])
    total, picked = {}, set()
    for s in sorted(starts, key=size):
        kids = [total[t] for t in starts if parent[t] == s]
        total[s] = max(mass[s], sum(kids)) if kids else mass[s]
        if parent[s] and (not kids or mass[s] >= sum(kids)):
            picked.add(s)
    label = {}
    for i in range(n):
        s, top = home[i], None
        while s:
            top, s = (s if s in picked else top), parent[s]
        label[ids[order[i]]] = -1 if top is None else min(ids[order[j]] for j in range(top[0], top[1] + 1))
    return label


@pytest.mark.parametrize("rows, m, size", [(lattice(1), 3, 16), (blobs(9, 60) + [(500 + i, [0.5] * 5) for i in range(40)], 5, None),
                                           ([(i, [2.0 ** i]) for i in range(40)], 3, 7)])
def test_hierarchy_equals_the_sequential_method(spark, rows, m, size):
    got = {r["vec_id"]: r["label"] for r in density.hierarchy_labels(frame(spark, rows), 2, m, block_size=size).collect()}
    assert got == hierarchy(rows, 2, m)


def test_hierarchy_finds_blobs_and_few_points_are_noise(spark):
    import os

    from notesmith.session import checkpoint_dir

    root = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    rows = [(c * 5 + i, x) for c in range(3) for i, x in enumerate(np.random.default_rng(c).normal(0, 1, (5, 10)) + 10.0 * c)]
    labels = density.hierarchy_labels(frame(spark, rows), 2, 3)
    assert len({r["label"] for r in labels.collect()} - {-1}) >= 2
    assert len(set(os.listdir(root)) - before) == 1  # only the result's table stays
    few = frame(spark, [(0, [0.0, 1.0]), (1, [1.0, 0.0])])
    assert [r["label"] for r in density.hierarchy_labels(few, 2, 5).collect()] == [-1, -1]


def test_spanning_tree_weighs_what_all_pairs_give(spark):
    rows = lattice(3, 70)
    core = density.core_distances(frame(spark, rows), 2)
    tree = linkage.mutual_reachability_mst(frame(spark, rows), core, block_size=9).collect()
    d = matrix(rows)
    c = cores(d, 2)
    _, _, w = linkage.tree_of(np.array([r[1] for r in rows], float), c)
    assert len(tree) == 69 and np.allclose(sorted(t["weight"] for t in tree), sorted(w))


def test_cluster_choice_on_long_and_bushy_trees(spark):
    rng = np.random.default_rng(4)
    for parents in ([None, *range(60)], [None, *(int(rng.integers(0, i)) for i in range(1, 80))]):
        mass = rng.integers(0, 40, len(parents)).astype(float)
        tree = spark.createDataFrame([(i, p, float(s)) for i, (p, s) in enumerate(zip(parents, mass))], "c long, parent long, stability double")
        kids = {i: [j for j, p in enumerate(parents) if p == i] for i in range(len(parents))}
        best, sel = {}, set()
        for i in reversed(range(len(parents))):
            below = sum(best[j] for j in kids[i])
            best[i] = max(mass[i], below) if kids[i] else mass[i]
            if parents[i] is not None and (not kids[i] or mass[i] >= below):
                sel.add(i)
        want = {}
        for i, p in enumerate(parents):
            above = want.get(p) if p is not None else None
            want[i] = above if above is not None else i if i in sel else None
        assert {r["c"]: r["chosen"] for r in linkage.chosen_clusters(tree).collect()} == want


def test_close_pairs_lose_none_and_name_few_others():
    rng = np.random.default_rng(10)
    for scale, off, dim in ((1, 0, 5), (1e-3, 1e6, 64), (1e200, 0, 3), (1, 0, 1)):
        x, y = rng.normal(0, scale, (300, dim)) + off, rng.normal(0, scale, (2500, dim)) + off
        x[7], y[9] = np.nan, np.inf
        with np.errstate(all="ignore"):
            d = vector_blocks.distances(x, y)
        mx, my = np.quantile(rng.permutation(d[np.isfinite(d)]), 0.01) if scale < 1e9 else 1e200, -1.0
        got, many = np.zeros(d.shape, bool), 0
        for i, j in vector_blocks.close_pairs(x, y, np.full(300, mx), np.full(2500, my)):
            with np.errstate(all="ignore"):
                assert np.array_equal(vector_blocks.measured(x, y, i, j), d[i, j])
            got[i, j] = True
            many += len(i)
        want = np.isfinite(d) & (d <= mx)
        assert not (want & ~got).any() and many == got.sum()
        if scale < 1e9:
            assert many <= 1.1 * want.sum() + 10


def test_spanning_keeps_a_lightest_forest():
    rng = np.random.default_rng(11)
    for n, m in ((1, 0), (40, 25), (300, 4000)):
        i, j = rng.integers(0, n, m), rng.integers(0, n, m)
        kept, comp = vector_blocks.spanning(n, i, j)
        of, want = list(range(n)), []
        for e, (a, b) in enumerate(zip(i.tolist(), j.tolist())):  # links stand in order of weight
            if of[a] != of[b]:
                want.append(e)
                of = [of[a] if z == of[b] else z for z in of]
        assert kept.tolist() == want and len(set(comp.tolist())) == len(set(of)) == len(set(zip(comp.tolist(), of)))


def test_links_of_the_query_are_found_with_cores_that_are_made_once(spark, monkeypatch):
    from notesmith.plans import catalog

    seen, quantile = [], density.exact_quantile
    monkeypatch.setattr(catalog, "_vectors", lambda spark, sf: frame(spark, blobs(14, 60)))
    monkeypatch.setattr(density, "exact_quantile", lambda df, *a: seen.append(df.inputFiles()) or quantile(df, *a))
    found = catalog.QUERIES["reach_edges"](spark, "")
    assert seen and all("/cut-" in f for f in seen[0]) and len(seen[0])
    d = matrix(blobs(14, 60))
    c = cores(d, 2)
    w = np.maximum(d, np.maximum(c[:, None], c[None]))
    i, j = np.nonzero(np.triu(w <= np.sort(c)[29], 1))
    assert {(r["a"], r["b"]): r["weight"] for r in found.collect()} == {(int(a), int(b)): pytest.approx(w[a, b], abs=1e-6) for a, b in zip(i, j)}


@pytest.mark.parametrize("rows", [blobs(12, 150, 5), lattice(13, 90)])
def test_limits_of_rows_leave_the_hierarchy_as_it_is(spark, rows, monkeypatch):
    monkeypatch.setattr(linkage, "FEW_ROWS", 0)
    monkeypatch.setattr(linkage, "TREE_ROWS", 8)
    monkeypatch.setattr(linkage, "FOREST_PAIRS", 50)
    got = {r["vec_id"]: r["label"] for r in density.hierarchy_labels(frame(spark, rows), 2, 3, block_size=30).collect()}
    assert got == hierarchy(rows, 2, 3)
