"""Each operator against a brute-force statement of its rule, and on the awkward tables."""

import collections
import hashlib
import random
import struct
import textwrap
import time
import zlib

import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from notesmith.llm import (byte_bpe, exact_dedup, label_shards, license_scan, lyndon_order, minhash_hamming, quality_rules,
                           secret_scan, sentence_spans, source_mix, suffix_dedup)
from notesmith.llm.components import components
from tests.llm.conftest import EDGE, LONG, UP, WORD, corpus, table

LOWEST = -(1 << 63)


# ---- 1 license scans -------------------------------------------------------------------------------------------------
def test_license_ranking_finds_what_comparing_all_templates_finds(spark):
    docs = [(i, f"Some text before.\n{t}\nand after it, words.", "a") for i, (_, t) in enumerate(license_scan.TEMPLATES)]
    docs += [(100, "Licenced to nobody in particular, driving license lost.", "a"), (101, "x " * 500 + "license " + "y " * 500, "a"),
             (102, "Licensed under the Apache License, Version 2.1.", "a")]
    got = license_scan.license_scan(table(spark, docs)).collect()
    for r in got:
        block = docs[[d[0] for d in docs].index(r["doc_id"])][1][r["start"]:r["end"]]
        lic, t, _, _, n, ok = license_scan.judge(block, ranked=None)
        assert (r["confirmed"], r["license"] if ok else None) == (ok, lic if ok else None), (block, r)
    by = collections.defaultdict(set)
    for r in got:
        if r["confirmed"]:
            by[r["doc_id"]].add(r["license"])
    assert all(lic in by[i] for i, (lic, _) in enumerate(license_scan.TEMPLATES))
    assert not by[100] and not by[101]


@pytest.mark.parametrize("prefix", ["", "# ", " * "])
def test_license_templates_are_confirmed_when_wrapped(spark, prefix):
    wrapped = [textwrap.fill(t, 70, initial_indent=prefix, subsequent_indent=prefix) for _, t in license_scan.TEMPLATES]
    docs = [(i, f"int x = 1;\n\n{t}\n\nint y = 2;\n", "a") for i, t in enumerate(wrapped)]
    by = collections.defaultdict(set)
    for r in license_scan.license_scan(table(spark, docs)).collect():
        if r["confirmed"]:
            by[r["doc_id"]].add(r["license"])
    assert all(lic in by[i] for i, (lic, _) in enumerate(license_scan.TEMPLATES))


def test_license_notices_on_lines_without_blank_lines_are_all_found():
    mit = textwrap.fill(license_scan.TEMPLATES[2][1], 70)
    text = f"Licensed under CC BY 4.0\nmade by hand\nReleased under the MIT License\nmore words here\n{mit}\nand\nAll rights reserved"
    got = license_scan.notices(text)
    assert [r[0] for _, _, r in got if r[-1]] == ["CC-BY-4.0", "MIT", "MIT", "proprietary"]
    assert all(got[k][1] <= got[k + 1][0] for k in range(len(got) - 1))
    assert all(license_scan.judge(text[a:b]) == r for a, b, r in got)


def test_license_edges(edge, nothing):
    assert license_scan.license_scan(edge).count() == 0
    assert license_scan.license_scan(nothing).count() == 0


# ---- 2 suffix order --------------------------------------------------------------------------------------------------
def test_suffix_order_is_the_sorted_order():
    rnd = random.Random(3)
    for _ in range(3000):
        t = [rnd.randint(1, rnd.randint(1, 4)) for _ in range(rnd.randint(0, 25))]
        t = (t * 3)[:40] + [0] if rnd.random() < 0.3 else t + [0]
        assert lyndon_order.suffix_order(t) == sorted(range(len(t)), key=lambda i: t[i:])


def test_grouping_costs_as_much_as_its_text_is_long():
    """Pointers that are named very often and very many pointers that are named once: each is handled once."""
    def seconds(n):
        text = [1] + [2] * n + [1, 2] * n + [0]
        start = time.process_time()
        assert lyndon_order.suffix_order(text)[0] == 3 * n + 1
        return time.process_time() - start
    assert seconds(64_000) < 3.5 * seconds(32_000) + 0.5


def removed_by_brute_force(docs, length):
    """(doc_id, text) in order -> (bytes, removed, spans, sha256 of the rest)."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        b = t.encode()
        off = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                off[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, o in zip(b, off) if not o)
        spans = sum(1 for k in range(len(b)) if off[k] and (k == 0 or not off[k - 1]))
        out[i] = (len(b), sum(off), spans, hashlib.sha256(kept).hexdigest())
    return out


def suffix_rows(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("hot", [1, 20_000])
def test_suffix_dedup_matches_brute_force(spark, hot, monkeypatch):
    rows = corpus(11, 50) + [(100, "ab" * 300, "s"), (101, "x" * 700, "s"), (102, "abab" * 90 + "tail", "s"), (103, "y" * 99, "s"),
                             (104, "y" * 100, "s"), (105, "y" * 101, "s")]
    if hot == 1:
        monkeypatch.setattr(suffix_dedup, "MOST_BLOCKS", 2)
        monkeypatch.setattr(suffix_dedup, "LARGE", 1)
    got = suffix_rows(suffix_dedup.suffix_dedup(table(spark, rows), hot_rows=hot))
    assert got == removed_by_brute_force([(i, t) for i, t, _ in rows], 100)


def test_suffix_dedup_in_chunks_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 50)
    monkeypatch.setattr(suffix_dedup, "DOCS_AT_ONCE", 2)
    text = [suffix_dedup.blocks_of(("abcdefgh" * 40).encode())]
    assert sum(text[0][1]) == 320 - 99  # every window in exactly one block
    spans = [r for pdf in suffix_dedup._spans(iter([__import__("pandas").DataFrame(
        {"doc_id": [1, 2], "th": [0, 0], "text": ["q" * 300, "q" * 300]})]), __import__("numpy").empty(0, "uint64"), 100, 24)
        for r in pdf.itertuples()]
    assert spans


def test_large_groups_by_order_and_by_hashes():
    rnd = random.Random(4)
    for _ in range(300):
        parts = [bytes(rnd.choices(b"ab", k=rnd.randint(3, 30))) for _ in range(rnd.randint(1, 6))]
        seen, want = set(), []
        for k, p in enumerate(parts):
            for i in range(len(p) - 4):
                if p[i:i + 5] in seen:
                    want.append((k, i))
                seen.add(p[i:i + 5])
        if any(len(p) > 4 for p in parts):
            assert suffix_dedup.repeated_windows(parts, 5) == want == suffix_dedup._by_hashes(parts, 5)


def test_suffix_edges(edge, nothing):
    got = suffix_dedup.suffix_dedup(edge)
    rows = got.collect()
    assert len(rows) == len(EDGE)
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["n_bytes"] == by[3]["n_bytes"] == 0 and by[3]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by[4]["n_removed"] < by[9]["n_removed"] and by[5]["n_removed"] == 2999 and LOWEST in by
    assert suffix_dedup.suffix_dedup(nothing).count() == 0


# ---- 3 sentence spans ------------------------------------------------------------------------------------------------
def sentences_by_brute_force(docs):
    seen, out = set(), {}
    for i, t in sorted(docs):
        _, norm, counts = sentence_spans.pieces(t.encode())
        have = [j for j in range(len(counts)) if counts[j]]
        spans = set()
        for a in range(len(have)):
            for b in range(a + sentence_spans.RUN, len(have) + 1):
                if sum(counts[j] for j in have[a:b]) >= sentence_spans.MIN_WORDS:
                    spans.add((a, b))
                    break
        for b in range(1, len(have) + 1):
            for a in range(b - sentence_spans.RUN, -1, -1):
                if sum(counts[j] for j in have[a:b]) >= sentence_spans.MIN_WORDS:
                    spans.add((a, b))
                    break
        gone = set()
        for a, b in sorted(spans):
            k = tuple(norm[j] for j in have[a:b])
            if k in seen:
                gone.update(have[a:b])
            seen.add(k)
        if gone:
            out[i] = len(gone)
    return out


@pytest.mark.parametrize("tasks", [1, 7])
def test_sentence_spans_match_brute_force(spark, tasks):
    rows = corpus(5, 60)
    docs = table(spark, rows).repartition(tasks)
    got = {r["doc_id"]: r["n_removed"] for r in sentence_spans.sentence_dedup(docs).collect()}
    assert got == sentences_by_brute_force([(i, t) for i, t, _ in rows]) and got


def test_a_passage_of_one_long_sentence_is_caught_and_clean_text_is_not(spark):
    rnd = random.Random(9)
    w = ["".join(rnd.choices("abcdefg", k=6)) for _ in range(400)]
    long = " ".join(rnd.choices(w, k=55)) + "."
    rows = [(i, " ".join(rnd.choices(w, k=30)) + ".\n" + (long if i < 5 else "Nothing.") + "\n" + " ".join(rnd.choices(w, k=30)), "a")
            for i in range(20)]
    got = {r["doc_id"]: list(r["first_ids"]) for r in sentence_spans.sentence_dedup(table(spark, rows)).collect()}
    assert set(got) == {1, 2, 3, 4} and all(0 <= f < i for i, fs in got.items() for f in fs)


def test_long_sentences_are_cut_where_a_plain_scan_cuts_them():
    rnd = random.Random(12)
    for n in (21, 22, 50, 300, 700):
        for words in ([b"%d" % rnd.randrange(40) for _ in range(n)], [b"same"] * n, [b"a", b"b"] * (n // 2) + [b"c"]):
            h = [xxhash.xxh3_64_intdigest(w) for w in words]
            gram = [(x * 0x9E3779B97F4A7C15 + y) % 2 ** 64 for x, y in zip(h, h[1:])]
            near = sentence_spans.NEAR
            at = [0] + [i for i in range(1, len(gram)) if all(gram[j] > gram[i] for j in range(max(0, i - near), i))
                        and all(gram[j] >= gram[i] for j in range(i + 1, min(len(gram), i + near + 1)))]
            want = []
            for a, b in zip(at, at[1:] + [len(words)]):
                while a < b:
                    want.append(a)
                    a += sentence_spans.MOST_WORDS
            _, norm, counts = sentence_spans.pieces(b" ".join(words))
            assert counts == [b - a for a, b in zip(want, want[1:] + [len(words)])]
            assert b" ".join(norm).split() == words


def test_shifted_passages_inside_long_sentences_are_found(spark):
    """A passage of 61 words at other offsets of longer sentences, in documents that share nothing else."""
    rnd = random.Random(13)
    own = lambda n: " ".join("".join(rnd.choices("bcdfghjk", k=7)) for _ in range(n))
    passages = [own(61) for _ in range(40)]
    rows = [(i, own(30) + ". " + own(rnd.randint(1, 19)) + " " + p + " " + own(rnd.randint(1, 19)) + ". " + own(30), "a")
            for i, p in enumerate(passages + passages)]
    got = {r["doc_id"]: r["kept_text"] for r in sentence_spans.sentence_dedup(table(spark, rows)).collect()}
    assert set(got) == set(range(40, 80))
    for i, kept in got.items():
        left = len(set(passages[i - 40].split()) & set(kept.split()))
        assert left <= 40 and len(set(rows[i][1].split()) - set(passages[i - 40].split()) - set(kept.split())) == 0
    assert sum(len(set(passages[i - 40].split()) & set(k.split())) for i, k in got.items()) / 40 < 20


def test_sentence_edges(edge, nothing):
    got = {r["doc_id"]: r for r in sentence_spans.sentence_dedup(edge).collect()}
    assert set(got) <= {4, 9, 5} and got[9]["n_removed"] > 0
    assert sentence_spans.sentence_dedup(nothing).count() == 0


# ---- 4 byte-level BPE ------------------------------------------------------------------------------------------------
def test_bpe_equals_tiktoken_and_decodes(spark, edge, nothing):
    import tiktoken

    ranks, pattern = byte_bpe.vocabulary(spark)
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    odd = [(20, "don't  stop\n\n  it's 12345 ²³   x\x85y <|endoftext|> \x1c\x1d á \r\n\t", "a"), (21, "ab" * 700, "a")]
    docs = edge.unionByName(table(spark, odd))
    for kernel in ("arrow", "fold"):
        got = byte_bpe.tokenize(docs, ranks, pattern, kernel).collect()
        texts = collections.Counter((i, t or "") for i, t, _ in EDGE + odd)
        back = collections.Counter((r["doc_id"], bytes(r["decoded"]).decode()) for r in got)
        assert back == texts
        assert all(r["ids"] == enc.encode_ordinary(bytes(r["decoded"]).decode()) and r["n_tokens"] == len(r["ids"]) for r in got)
    assert byte_bpe.tokenize(nothing, ranks, pattern).count() == 0


def test_long_words_are_merged_as_tiktoken_does(spark):
    import tiktoken

    ranks, pattern = byte_bpe.vocabulary(spark)
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(4)
    sets = ["ACGT", "ab", "abcdefghijklmnopqrstuvwxyz", "ethnarios", "áé中文字x", "0", "=-_", " "]
    texts = ["".join(rnd.choices(s, k=n)) for s in sets for n in (85, byte_bpe.LONG - 1, byte_bpe.LONG, 3000)]
    texts += [" and ".join(rnd.choices(texts, k=4)) + " end" for _ in range(20)]
    got = byte_bpe.tokenize(table(spark, [(i, t, "a") for i, t in enumerate(texts)]), ranks, pattern).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {i: enc.encode_ordinary(t) for i, t in enumerate(texts)}


def test_a_word_of_a_million_letters(spark):
    ranks, pattern = byte_bpe.vocabulary(spark)
    text = "".join(random.Random(5).choices("ACGT", k=1_000_000))
    start = time.monotonic()
    row = byte_bpe.tokenize(table(spark, [(1, text, "a")]), ranks, pattern).first()
    assert bytes(row["decoded"]).decode() == text and time.monotonic() - start < 120


def test_bpe_digests(spark):
    ranks, pattern = byte_bpe.vocabulary(spark)
    r = byte_bpe._digests(table(spark, [(1, "two words", "a")]), ranks, pattern).first()
    ids = byte_bpe.tokenize(table(spark, [(1, "two words", "a")]), ranks, pattern).first()["ids"]
    assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert r["decoded_sha256"] == hashlib.sha256(b"two words").hexdigest()


# ---- 5 near-duplicates -----------------------------------------------------------------------------------------------
def near_by_brute_force(docs, n=5):
    sets = {}
    for i, t in docs:
        w = WORD.findall(t.translate(UP))
        sets[i] = frozenset(zip(*(w[k:] for k in range(n)))) if len(w) >= n else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("block,words", [(None, 2), (3, 2), (None, 5)])
def test_near_duplicates_match_brute_force(spark, block, words):
    rows = corpus(21, 120) + [(200, "one", "a"), (201, "One", "a"), (202, "", "a"), (203, "one two three", "a"), (204, "One two  three", "a")]
    sizes = {"words": words} if block is None else {"bucket": block, "group": block, "sketches": 4, "words": words}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_hamming.near_duplicates(table(spark, rows), **sizes).collect()}
    assert got == near_by_brute_force([(i, t) for i, t, _ in rows], words)


def test_large_loose_groups_match_brute_force(spark):
    """A hot group of near copies, a chain whose ends are not linked, and texts that share a frame but no link; some longer than a sketch."""
    rnd = random.Random(77)
    base, frame = [f"b{k}" for k in range(900)], [f"f{k}" for k in range(150)]
    texts = []
    for k in range(40):  # near copies, not all linked with the smallest
        w = list(base)
        for at in rnd.sample(range(900), rnd.choice((3, 20, 45))):
            w[at] = f"x{k}_{at}"
        texts.append(w)
    texts += [[f"c{k}" for k in range(at, at + 120)] for at in range(0, 400, 10)]  # neighbours at 110 of 130
    texts += [[*frame, *(f"u{n}_{k}" for k in range(55))] for n in range(40)]
    rnd.shuffle(texts)
    rows = [(i, " ".join(w), "a") for i, w in enumerate(texts)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_hamming.near_duplicates(
        table(spark, rows), group=6, sketches=16, words=2).collect()}
    assert got == near_by_brute_force([r[:2] for r in rows], 2)


def test_a_shared_frame_without_links_meets_no_texts():
    sets = [minhash_hamming.shingles(" ".join([*(f"f{k}" for k in range(1500)), *(f"u{n}_{k}" for k in range(550))]), 2) for n in range(60)]
    same = minhash_hamming.shingles(" ".join([*(f"f{k}" for k in range(1500)), *(f"u0_{k}" for k in range(500))]), 2)
    g = pd.DataFrame({"grp": 0, "i": 0, "j": 0, "rep": range(61), "n": [len(s) for s in [*sets, same]],
                      "sketch": [minhash_hamming.sketch(s).tobytes() for s in [*sets, same]]})
    out = pd.concat(minhash_hamming._sketch_forest([g]))
    assert out.to_numpy().tolist() == [[0, 60]]


def test_an_id_with_two_texts(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    per = lambda rows: sorted((r["doc_id"], r["component_id"]) for r in minhash_hamming.near_duplicates(table(spark, rows)).collect())
    assert per([(5, a, "a"), (5, b, "a"), (2, a, "a"), (3, b + " c", "a")]) == [(2, 2), (3, 3), (5, 2), (5, 3)]
    assert per([(1, a, "a"), (1, b, "a"), (2, a, "a"), (3, b + " c", "a")]) == [(1, 1), (1, 1), (2, 1), (3, 1)]


def test_near_stage_takes_five_words(spark):
    words = [f"w{k}" for k in range(400)]
    edited = [w + "x" if k % 25 == 12 else w for k, w in enumerate(words)]  # over 0.8 on two words, under 0.8 on five
    rows = [(1, " ".join(words), "a"), (2, " ".join(edited), "a"), (3, " ".join(words[:395]), "a")]
    assert near_by_brute_force([r[:2] for r in rows], 2)[2][1] == 1 and near_by_brute_force([r[:2] for r in rows])[2][1] == 2
    assert {r["doc_id"] for r in minhash_hamming.stage(spark, table(spark, rows), "").collect()} == {1, 2}


def test_near_edges(edge, nothing):
    rows = minhash_hamming.near_duplicates(edge).collect()
    assert len(rows) == len(EDGE)
    by = {r["doc_id"]: r for r in rows}
    assert by[6]["component_id"] == 1 and not by[6]["kept"] and by[9]["component_id"] == 4
    assert by[2]["kept"] and by[2]["n_shingles"] == 0 and by[7]["n_shingles"] == 0 and LOWEST in by
    assert minhash_hamming.near_duplicates(nothing).count() == 0


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001 + i) for i in range(500)] + [(rnd.randrange(5000, 5400), rnd.randrange(5000, 5400)) for _ in range(260)]
    got = {r["id"]: r["comp"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    up = {x: x for p in pairs for x in p}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    assert got == {i: root(i) for p in pairs for i in p if p[0] != p[1]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 6 sharding ------------------------------------------------------------------------------------------------------
def sharded(docs):
    nodes = label_shards.nodes_of(docs)
    return label_shards.shard_rows(nodes, label_shards.text_links(nodes)).collect()


def balanced(rows, n):
    per = collections.Counter(r["shard"] for r in rows)
    assert len(rows) == n and max(per.values(), default=0) - min((per[k] for k in range(8)), default=0) <= 1
    for k in per:
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(per[k]))


def test_shards_are_even_and_keep_copies_together(spark):
    rows = [(i, f"text {i % 150 if i < 400 else i}", "a") for i in range(1003)]
    got = sharded(table(spark, rows))
    balanced(got, 1003)
    text = {i: t for i, t, _ in rows}
    where = collections.defaultdict(set)
    for r in got:
        where[text[r["doc_id"]]].add(r["shard"])
        assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) and r["size"] == len(text[r["doc_id"]]) + 1
    assert sum(len(s) > 1 for s in where.values()) == 0


def test_a_group_larger_than_a_shard_fills_whole_shards(spark):
    rows = [(i, "same" if i < 70 else f"t{i}", "a") for i in range(200)]
    got = sharded(table(spark, rows))
    balanced(got, 200)
    per = collections.Counter(r["shard"] for r in got if r["doc_id"] < 70)
    assert sorted(per.values())[-2:] == [25, 25] and len(per) <= 4


def test_links_of_several_hubs(spark):
    links = spark.createDataFrame([(i, f"h{i // 10}") for i in range(80)] + [(i, f"g{i // 20}") for i in range(80)], "row long, hub string")
    got = {r["row"]: r["shard"] for r in label_shards.propagate(links, [10] * 8).collect()}
    assert len(got) == 80 and max(collections.Counter(got.values()).values()) <= 10
    assert all(len({got[i] for i in range(10 * h, 10 * h + 10)}) == 1 for h in range(8))  # tens fill shards of ten


def cut_pairs(groups, shard):
    """Pairs of rows with equal group in different shards."""
    n = 0
    for g in set(groups):
        per = collections.Counter(s for h, s in zip(groups, shard) if h == g)
        n += (sum(per.values()) ** 2 - sum(c * c for c in per.values())) // 2
    return n


@pytest.mark.parametrize("sizes, cut", [([2] * 200, 0), ([3] * 133, 7), ([90, 40] + [2] * 100, 9)])
def test_groups_gather_where_every_text_has_copies(spark, sizes, cut):
    texts = [f"text {g}" for g, c in enumerate(sizes) for _ in range(c)]
    random.Random(3).shuffle(texts)
    got = sharded(table(spark, [(i, t, "a") for i, t in enumerate(texts)]))
    balanced(got, len(texts))
    where = collections.defaultdict(set)
    for r in got:
        where[texts[r["doc_id"]]].add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) <= cut


def test_few_rows_reach_the_least_cut_of_all_deals(spark):
    import itertools

    groups = [0, 0, 0, 1, 1, 1, 2, 2, 3, 3]
    least = min(cut_pairs(groups, s) for s in itertools.product((0, 1), repeat=10) if sum(s) == 5)
    links = spark.createDataFrame(list(enumerate(groups)), "row long, hub long")
    got = {r["row"]: r["shard"] for r in label_shards.propagate(links, [5, 5]).collect()}
    assert sorted(collections.Counter(got.values()).values()) == [5, 5]
    assert cut_pairs(groups, [got[i] for i in range(10)]) == least == 0


def test_exchanges_follow_cycles_and_room():
    rnd = random.Random(6)
    for _ in range(200):
        n = rnd.randint(2, 6)
        asked = [[0 if k == j else rnd.choice((0, 0, rnd.randint(1, 5))) for j in range(n)] for k in range(n)]
        free = [rnd.choice((0, 0, 1, 4)) for _ in range(n)]
        got = label_shards.exchanges(asked, free)
        for k in range(n):
            come, leave = sum(got[i][k] for i in range(n)), sum(got[k])
            assert come - leave <= free[k] and all(0 <= got[k][j] <= asked[k][j] for j in range(n))
        left = [[a - g for a, g in zip(*r)] for r in zip(asked, got)]
        assert not label_shards._shortest_cycle(left)
        room = [free[k] - sum(got[i][k] for i in range(n)) + sum(got[k]) for k in range(n)]
        assert not any(left[k][j] and room[j] for k in range(n) for j in range(n))
    assert label_shards.exchanges([[0, 3], [2, 0]], [0, 0]) == [[0, 2], [2, 0]]


def test_shard_edges(edge, nothing):
    balanced(sharded(edge), len(EDGE))
    assert sharded(nothing) == []


# ---- 7 quality rules: checked against SQL in test_sql.py -------------------------------------------------------------
def test_quality_edges(edge, nothing):
    rows = quality_rules.quality_rules(edge).collect()
    assert len(rows) == len(EDGE) and quality_rules.quality_rules(nothing).count() == 0
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["n_words"] == by[3]["n_words"] == by[7]["n_words"] == 0 and by[2]["base_failed"] and not by[2]["kept"]
    assert by[8]["word_chars"] == len("".join("Ünïcode ÉÀ straße 日本語 \U0001f600 end".split()))
    assert by[4]["n_words"] == len(LONG.split())


def test_quality_stage_keeps_columns_and_agrees(spark, edge):
    rows = corpus(31, 40) + [(900, "### " * 80, "a")]
    docs = table(spark, rows).unionByName(edge)
    kept = quality_rules.stage(spark, docs, "")
    assert kept.columns == docs.columns
    want = collections.Counter(r["doc_id"] for r in quality_rules.quality_rules(docs).collect() if r["kept"])
    assert collections.Counter(r["doc_id"] for r in kept.select("doc_id").collect()) == want


# ---- 8 mixing --------------------------------------------------------------------------------------------------------
def water_by_steps(sizes):
    """Targets by repeated resharing; sources in order of code point, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, held = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in held]
        if not free:
            return held
        level = (total - sum(held.values())) / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level >= 2 * sizes[s]]
        if not over:
            return held | {s: w[s] * level for s in free}
        held |= {s: 2.0 * sizes[s] for s in over}


def test_mix_meets_targets_and_reruns_agree(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * min(3000, int(rnd.paretovariate(1) * 20))), rnd.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(800)]
    docs = table(spark, rows)
    _, per, drawn = source_mix.mix(docs, block_words=500)
    sizes, size = collections.Counter(), {}
    for i, t, s in rows:
        size[i] = len(t.split())
        sizes[s] += size[i]
    want = water_by_steps(sizes)
    got = {r["source"]: r["target"] for r in per.collect()}
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)
    copies = drawn.collect()
    taken = collections.Counter()
    for r in copies:
        taken[r["source"]] += r["size"]
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 5 for s in want)
    assert max(collections.Counter(r["row"] for r in copies).values()) <= 2
    again = source_mix.mix(docs.repartition(3), block_words=500)[2].collect()
    draw = lambda rs: sorted((r["doc_id"], r["copy"], r["shard"], r["place"]) for r in rs)
    assert draw(copies) == draw(again) and len({r["shard"] for r in copies}) == 8


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_meets_targets_with_a_document_of_half_a_source(spark, seed):
    # Both sources hold about 20,000 words, 10,000 of them in one document, for a target of about 12,000.
    long = " ".join(["w"] * 10_000)
    rows = [(i, f"{i} " + " ".join(["w"] * (19 + i % 60)), "ab"[i % 2]) for i in range(400)]
    short = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in "ab"}
    rows += [(1000 + k, long, s) for k, s in enumerate("ab")]
    _, per, drawn = source_mix.mix(table(spark, rows), weights=(1.0,), share=0.6, block_words=500, seed=seed)
    taken = collections.Counter()
    for r in drawn.collect():
        taken[r["source"]] += r["size"]
    for r in per.collect():
        assert r["target"] - short[r["source"]] > 1000 and abs(taken[r["source"]] - r["target"]) <= 0.01 * r["target"], (r, taken)


def test_splitting_tree_is_exact_and_even(spark):
    quotas = spark.createDataFrame([("a", 500), ("b", 37), (None, 3), ("c", 0)] + [(f"x{i}", 5) for i in range(40)], "source string, quota long")
    rows = source_mix.split_quotas(quotas, per_group=8).collect()
    per, shards = collections.Counter(), collections.Counter()
    for r in rows:
        per[r["source"]] += r["quota"]
        shards[r["shard"]] += r["quota"]
        assert r["quota"] >= 0
    assert per == collections.Counter({r["source"]: r["quota"] for r in quotas.collect()})
    assert len(shards) == 8 and max(shards.values()) - min(shards.values()) <= 2


def test_hypergeometric_inversion(spark):
    from math import comb

    n, k, m, runs = 40, 13, 17, 40_000
    c = lambda x: F.lit(x) + F.col("id") * 0
    got = spark.range(runs).select(source_mix.hypergeometric(c(n), c(k), c(m), (F.col("id") + 0.5) / runs).alias("x"))
    per = {r["x"]: r["count"] / runs for r in got.groupBy("x").count().collect()}
    for x in range(k + 1):
        assert abs(per.get(x, 0) - comb(k, x) * comb(n - k, m - x) / comb(n, m)) < 1e-3


def test_mix_stage_and_edges(spark, edge, nothing):
    rows, per, drawn = source_mix.mix(edge)
    assert rows.count() == len(EDGE) and max(r["count"] for r in drawn.groupBy("row").count().collect()) <= 2
    mixed = source_mix.stage(spark, edge, "")
    assert mixed.columns == edge.columns
    per_id = lambda df: collections.Counter(r["doc_id"] for r in df.select("doc_id").collect())
    assert per_id(mixed) == per_id(drawn)
    assert source_mix.mix(nothing)[2].count() == 0 and source_mix.stage(spark, nothing, "").count() == 0


# ---- 9 secret scans: the base is checked against SQL in test_sql.py --------------------------------------------------
def test_ledger_scans_only_what_is_unseen(spark, tmp_path):
    v1 = table(spark, [(1, "password = abcdefghij", "a"), (2, "password = abcdefghij", "a"), (3, "secret: token = abcdefghij", "a"), (4, None, "a")])
    ledger = secret_scan.Ledger(spark, f"file://{tmp_path}/ledger")
    first = {r["path"]: r["spans"] for r in ledger.run(v1).collect()}
    assert first == {1: "assign:0:21", 2: "assign:0:21", 3: "", 4: ""}
    assert ledger.tables()[0].count() == 3  # one row per blob
    v2 = v1.unionByName(table(spark, [(1, "AKIA" + "A1" * 8, "a"), (9, "password = abcdefghij", "a")]))
    _, scans, found = secret_scan.scan(v2, ledger.tables())
    assert scans.count() == 1 and [r["rule"] for r in found.collect()] == ["access@1"]
    bumped = tuple(secret_scan.Rule(r.kind, 2, r.pattern, r.least, r.base) if r.kind == "hex" else r for r in secret_scan.RULES)
    _, scans, _ = secret_scan.scan(v1, ledger.tables(), bumped)
    assert {tuple(r["rules"]) for r in scans.collect()} == {("hex@2",)}


def test_a_repeated_row_adds_no_secrets(spark):
    text = "password = abcdefghij, then AKIA" + "A1" * 8 + " and token = klmnopqrst"
    once = [(1, text, "a"), (2, "no secret", "a"), (None, "passwd: abcdefghij", "a")]
    per = lambda rows: {r["path"]: r for r in secret_scan.per_path(*secret_scan.scan(table(spark, rows))[::2]).collect()}
    want, got = per(once), per(once + once + once[:1])
    assert got == want and want[1]["n_assign"] == 2 and want[1]["spans"].startswith("assign:0:21,access:28:48")


def test_web_tokens_in_long_runs(spark):
    """The rule with its gap finds what the plain pattern finds, also where the run before a match holds more starts."""
    import re

    rule = next(r for r in secret_scan.RULES if r.kind == "jwt")
    rnd = random.Random(6)
    part = lambda: "".join(rnd.choice(["eyJ", "eyJ", "abcdefgh", "abcdefgh-", "A_", ".", ".", rnd.choice(" =é")]) for _ in range(rnd.randint(1, 60)))
    good = "eyJ" + "a" * 9 + "." + "b" * 9 + "." + "c" * 9
    texts = [part() for _ in range(400)] + [good, "x" + good, good + "." + good, good + " " + good, "eyJeyJ" + good, "eyJ.eyJ." + good, good[:-2]]
    want = {i: ",".join(f"jwt:{m.start()}:{m.end()}" for m in re.finditer(rule.pattern, t)) for i, t in enumerate(texts)}
    assert sum(map(bool, want.values())) > 30
    v, _, found = secret_scan.scan(table(spark, [(i, t, "a") for i, t in enumerate(texts)]), rules=(rule,))
    assert {r["path"]: r["spans"] for r in secret_scan.per_path(v, found, (rule,)).collect()} == want
    start = time.monotonic()
    v, _, found = secret_scan.scan(table(spark, [(1, "eyJ" * 300_000 + "! " + good, "a")]))
    assert secret_scan.per_path(v, found).first()["spans"] == f"jwt:900002:{900002 + len(good)}" and time.monotonic() - start < 120


def test_secret_edges(edge, nothing):
    v, _, found = secret_scan.scan(edge)
    rows = secret_scan.per_path(v, found).collect()
    assert len(rows) == len(EDGE) and all(r["spans"] == "" for r in rows)
    v, s, found = secret_scan.scan(nothing)
    assert s.count() == 0 and secret_scan.per_path(v, found).count() == 0


# ---- 10 exact dedup: checked against SQL in test_sql.py --------------------------------------------------------------
@pytest.mark.parametrize("heavy", [512, 1])
def test_exact_dedup_matches_brute_force(spark, heavy):
    rows = corpus(41, 80) + [(i, "Hot Copy" if i % 2 else "hot copy", "a") for i in range(500, 900)]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(table(spark, rows), max_heavy=heavy).collect()}
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[t.translate(UP)].append(i)
    assert got == {i: (max(g), len(g), i == max(g)) for g in groups.values() for i in g}


def test_exact_edges(spark, edge, nothing):
    rows = exact_dedup.exact_dedup(edge).collect()
    assert len(rows) == len(EDGE)
    assert sum(r["kept"] for r in rows) == len({(t or "").translate(UP) for _, t, _ in EDGE})
    assert {r["keep_id"] for r in rows if r["doc_id"] in (2, 3)} == {3} and {r["group_size"] for r in rows if r["doc_id"] == 1} == {3}
    kept = exact_dedup.stage(spark, edge, "")
    assert kept.columns == edge.columns and kept.count() == sum(r["kept"] for r in rows)
    assert exact_dedup.exact_dedup(nothing).count() == 0
