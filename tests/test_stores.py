"""Stores looked up by key, kept replies, taken names, sender lists, feed files and counted errors."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from notesmith.operators import dedup, inference, key_store, notes
from notesmith.plans import ingest
from notesmith.sources import articles, feed_files, feeds_xml
from notesmith.streaming import incremental


@pytest.fixture(autouse=True)
def few_folders(monkeypatch):
    monkeypatch.setattr(key_store, "DIGITS", 1)


def urls(spark, ids):
    h = F.md5(F.concat(F.lit("u"), F.col("id").cast("string")))
    return spark.createDataFrame([(i,) for i in ids], "id long").select(
        h.alias("url_hash"), F.concat(F.lit("https://e.com/"), F.col("id").cast("string")).alias("url"), F.lit("t").alias("title"),
        F.lit("h").alias("content_hash"), F.lit("rss").alias("source"), F.col("id").alias("ord"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_equal_an_anti_join_over_several_appends(spark, tmp_path):
    store = key_store.seen_store(spark, str(tmp_path / "s"))
    rnd, have = random.Random(3), set()
    assert store.unseen(urls(spark, [1, 2])).count() == 2 and store.known(urls(spark, [1])).count() == 0
    for _ in range(2):
        new = rnd.sample(range(600), 60)
        assert dedup.append_seen(urls(spark, new), str(tmp_path / "s"), "2026-05-10") == len(set(new) - have)
        have |= set(new)
    ask = list(range(0, 600, 3))
    assert {r["ord"] for r in store.unseen(urls(spark, ask)).collect()} == set(ask) - have
    rows = spark.read.parquet(str(tmp_path / "s"))
    assert rows.count() == len(have) and rows.select("url_hash").distinct().count() == len(have)
    small = store.compacted(str(tmp_path / "c"))
    assert {r["ord"] for r in small.unseen(urls(spark, ask)).collect()} == set(ask) - have
    merged = key_store.merged_filters(store.filters())
    assert merged.count() <= 16 and small.filters().count() == merged.count()
    assert ({(r["prefix"], bytes(r["bitmap"])) for r in merged.collect()} == {(r["prefix"], bytes(r["bitmap"])) for r in small.filters().collect()})


def test_filters_rule_out_new_keys_of_a_large_store(spark, tmp_path):
    store = key_store.KeyStore(spark, str(tmp_path / "s"), "k", "k string", digits=2)
    keys = spark.range(1_000_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    assert store.append(keys) == 1_000_000
    assert store.filters().count() == 256 * 2  # a million keys: two bitmaps for each prefix
    batch = spark.range(1_000_000, 1_002_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    maybe = store.maybe(batch).count()
    assert maybe < 2000 * 0.05
    found = store.known(batch)
    assert found.count() == 0
    text = plan(found)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text  # stored rows are not shuffled
    one = store.known(spark.createDataFrame([(hashlib.md5(b"7").hexdigest(),)], "k string"))
    assert one.count() == 1 and len(one.inputFiles()) <= 2 < 256 <= len(store.rows().inputFiles())
    some = spark.range(0, 1_000_000, 1000).select(F.md5(F.col("id").cast("string")).alias("k"))
    assert store.known(some).count() == 1000 and store.unseen(some).count() == 0


def test_a_batch_reads_only_the_parts_that_may_hold_its_urls(spark, tmp_path):
    store, out = str(tmp_path / "seen"), str(tmp_path / "out")
    rows = [(i, f"https://a.com/{i}", "T", "x", "rss", "h") for i in range(400)]
    schema = "ord long, url string, title string, content_raw string, source string, content_hash string"
    incremental.ingest_new(spark.createDataFrame(rows, schema), store, out, "2026-05-10", 0)
    batch = spark.createDataFrame(rows[:1] + [(900, "https://a.com/900", "T", "x", "rss", "h")], schema)
    hashed = dedup.with_url_hash(batch)
    known = key_store.seen_store(spark, store).known(hashed)
    assert known.count() == 1 and len(known.inputFiles()) <= 3
    incremental.ingest_new(batch, store, out, "2026-05-10", 1)
    incremental.ingest_new(batch, store, out, "2026-05-10", 1)  # replayed: the store holds its rows already
    assert spark.read.parquet(store).count() == 401


def test_rows_survive_a_failure_between_filter_and_rows(spark, tmp_path, monkeypatch):
    """Filters alone are only more to look up; the next append adds the rows."""
    path = str(tmp_path / "s")
    store = key_store.seen_store(spark, path)
    dedup.append_seen(urls(spark, [1]), path, "d")
    seen = dedup.seen_records(urls(spark, [2, 3]), "d")
    digest = F.md5(F.col("url_hash").cast("binary"))
    bits = seen.select(key_store.prefix_of(digest, 1).alias("prefix"), F.lit(1).alias("slots"), key_store.slot_of(digest, F.lit(1)).alias("slot"),
                       F.explode(key_store.bits_of(digest)).alias("bit"))
    bits.groupBy("prefix", "slots", "slot").agg(F.bitmap_construct_agg("bit").alias("bitmap")).write.mode("append").partitionBy("prefix").parquet(f"{path}/_filters")
    assert store.unseen(urls(spark, [1, 2, 3])).count() == 2
    assert dedup.append_seen(urls(spark, [1, 2, 3]), path, "d") == 2 and store.rows().count() == 3


# ---- reply ledger ----------------------------------------------------------------------
class Killed(BaseException):
    pass


def test_a_job_killed_half_way_asks_only_what_is_left(spark, tmp_path):
    ledger, asked, die = str(tmp_path / "l"), spark.sparkContext.accumulator(0), spark.sparkContext.broadcast([True])
    df = spark.createDataFrame([(i, f"prompt {i % 40}") for i in range(60)], "ord long, prompt string")

    def model(prompts):
        if die.value[0] and any(p == "prompt 7" for p in prompts):
            raise Killed("lost")
        asked.add(len(prompts))
        return [p.upper() for p in prompts]

    with pytest.raises(Exception):
        inference.call_with_ledger(df, model, ledger, "m", batch=5, request=1)
    stored = key_store.reply_store(spark, ledger).rows().count()
    assert 0 < stored < 40
    before, die = asked.value, spark.sparkContext.broadcast([False])
    got = inference.call_with_ledger(df, model, ledger, "m", batch=5)
    assert asked.value - before == 40 - stored
    assert {(r["ord"], r["raw"], r["error"]) for r in got.collect()} == {(i, f"PROMPT {i % 40}", None) for i in range(60)}
    inference.call_with_ledger(df, model, ledger, "m")
    assert asked.value - before == 40 - stored  # nothing is asked twice
    inference.call_with_ledger(df.limit(1), model, ledger, "another model")
    assert asked.value - before == 41 - stored


def test_errors_are_asked_again_and_nulls_are_prompts(spark, tmp_path):
    fail = spark.sparkContext.broadcast([True])
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "ord long, prompt string")

    def model(prompts):
        if fail.value[0] and "b" in prompts:
            raise ValueError("no")
        return [None if p == "a" else f"<{p}>" for p in prompts]

    run = lambda: {r["ord"]: (r["raw"], r["error"]) for r in inference.call_with_ledger(df, model, str(tmp_path / "l"), "m", waits=()).collect()}
    assert run() == {1: (None, None), 2: ("<>", None), 3: (None, "no")}
    fail = spark.sparkContext.broadcast([False])
    assert run() == {1: (None, None), 2: ("<>", None), 3: ("<b>", None)}
    assert inference.call_with_ledger(df.limit(0), model, str(tmp_path / "l"), "m").count() == 0


# ---- name registry ---------------------------------------------------------------------
def test_names_over_runs_equal_a_loop(spark, tmp_path):
    rnd, taken, registry = random.Random(1), set(), str(tmp_path / "names")
    stems = ["a", "a-1", "b", "a-1-2", "untitled"]
    for run in range(2):
        new = [(k, rnd.choice(["d1", "d2"]), f"{rnd.choice(stems)}.md") for k in range(25)]
        df = spark.createDataFrame(new, "ord long, dir string, filename string")
        got = notes.resolve_collisions(df, notes.registered_names(spark, registry, f"r{run}"))
        again = notes.resolve_collisions(df, spark.createDataFrame(sorted(taken), "dir string, filename string"))
        names = {r["ord"]: (r["dir"], r["filename"]) for r in got.collect()}
        assert names == {r["ord"]: (r["dir"], r["filename"]) for r in again.collect()}
        own = set(names.values())
        assert len(own) == 25 and not own & taken
        want = set(taken)
        for k, d, f in sorted(new):  # first free slot of the family; notes' own names are reserved
            stem, base, i = f[:-3], {(d2, f2) for _, d2, f2 in new}, 0
            while (d, name := f if i == 0 else f"{stem}-{i}.md") in want or (i > 0 and (d, name) in base):
                i += 1
            assert names[k] == (d, name)
            want.add((d, name))
        notes.register_names(got, registry, f"r{run}")
        notes.register_names(got, registry, f"r{run}")  # a repeated run
        assert notes.registered_names(spark, registry, f"r{run}")(df.select("dir", F.lit("a").alias("stem"))).join(
            got.select("dir", "filename"), ["dir", "filename"]).count() == 0 or run > 0
        taken |= own


# ---- sender lists ------------------------------------------------------------------------
def test_long_sender_lists_equal_the_predicate(spark):
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choices("abc.", k=n))
    addr = [f"{word(3)}@{word(4)}" for _ in range(120)] + ["x@y@z.c", "plain", "", "A@B.C", None]
    m = spark.createDataFrame(list(enumerate(addr)), "ord long, a string")
    entries = [word(rnd.randint(2, 5)) for _ in range(12)] + ["Z.C", "x@y@z.c", "b.c", "@", "y@z.c"]
    table = spark.createDataFrame([(e,) for e in entries + [None]], "entry string")
    for exact in (False, True):
        want = {r["ord"] for r in m.where(articles.sender_allowed("a", entries, exact)).collect()}
        assert {r["ord"] for r in articles.allowed_senders(m, "a", table, exact).collect()} == want and want
        low = [e.lower() for e in entries]
        assert want == {i for i, x in enumerate(addr) if x is not None and any(
            (("@" in e and x.lower() == e) or x.lower().endswith("@" + e)) if exact else e in x.lower() for e in low)}
    big = spark.range(100_000).select(F.concat(F.lit("host"), F.col("id"), F.lit(".com")).alias("entry"))
    found = articles.allowed_senders(spark.createDataFrame([(1, "a@host77777.com"), (2, "a@none.org")], "ord long, a string"), "a", big, exact=True)
    assert [r["ord"] for r in found.collect()] == [1] and len(plan(found)) < 20_000
    assert articles.allowed_senders(m, "a", table.limit(0)).count() == m.count()


# ---- feed files ----------------------------------------------------------------------------
def feed(n, broken=False):
    items = "".join(f"<item><title>T{i}</title><link>https://e.com/{i}</link><description>a &amp; b</description></item>" for i in range(n))
    return f'<?xml version="1.0"?><rss version="2.0"><channel><title>c</title>{items}' + ("<item><title>cut" if broken else "</channel></rss>")


def test_a_broken_feed_file_is_one_error_row_and_order_is_by_place(spark, tmp_path):
    for name, text in (("a.xml", feed(30)), ("b.xml", feed(5, broken=True)), ("c.xml", "no feed at all"), ("d.xml", ""), ("e.xml", feed(2))):
        (tmp_path / name).write_text(text)
    rows = feed_files.read_feed_files(spark, str(tmp_path)).cache()
    assert sorted(r["file"][-5:] for r in feed_files.feed_errors(rows).collect()) == ["b.xml", "c.xml"]  # Spark passes empty files over
    want = [("a", f"T{i}") for i in range(30)] + [("b", f"T{i}") for i in range(5)] + [("e", "T0"), ("e", "T1")]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "1k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = feeds_xml.read_rss(spark, str(tmp_path)).orderBy("ord").collect()
            assert [(r["feed"], r["title"]) for r in got] == want and [r["ord"] for r in got] == list(range(37))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r["description"] for r in got} == {"a & b"}


def test_feed_parser_reads_nested_markup_and_pieces(monkeypatch):
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="html">A &lt;b&gt;</title><link rel="self" href="s"/><link href="h"/>'
            '<author><name>Ann</name><email>x</email></author><content type="xhtml"><div class="q">one &amp; <i>two</i></div></content></entry></feed>').encode()
    want = [({"title": "A <b>", "link": "h", "author": "Ann", "content": '<div class="q">one &amp; <i>two</i></div>'}, None)]
    assert list(feed_files.parse_feed(atom)) == want
    monkeypatch.setattr(feed_files, "STEP", 7)
    assert list(feed_files.parse_feed(atom)) == want
    got = list(feed_files.parse_feed(b"<rss><channel><item><title>x</title></item><item><ti"))
    assert got[0] == ({"title": "x"}, None) and got[1][0] is None and len(got) == 2
    assert list(feed_files.parse_feed('<?xml version="1.0" encoding="no-such"?><rss/>'.encode()))[0][1]


# ---- errors of a run --------------------------------------------------------------------------
def test_failing_replies_are_counted_at_their_level(spark, tmp_path):
    df = spark.createDataFrame([(i, f"https://a.com/{i}", f"T{i}", "text", "rss", f"h{i}") for i in range(12)],
                               "ord long, url string, title string, content_raw string, source string, content_hash string").withColumns({
        "source_name": F.lit("feed"), "author": F.lit("a"), "published_at": F.lit(None).cast("timestamp"),
        "language": F.lit(""), "tags": F.array().cast("array<string>")})
    reply = lambda bad, text: df.select("ord", F.lit(text).alias("raw"), F.when(F.col("ord").isin(bad), "down").alias("error"))
    scores = df.select("ord", F.concat(F.lit('{"relevance_score": '), (F.col("ord") % 12).cast("string"), F.lit("}")).alias("raw"),
                       F.when(F.col("ord") == 2, "down").alias("error"))
    st = ingest.plan_ingest(df, {"l1": scores, "l2": reply([1, 5, 8], "short"), "l3": reply([5, 8, 9], "{}")}, "2026-05-10")
    got = {(r["stage"], r["ord"]) for r in st.errors.collect()}
    kept = {r["ord"]: r["relevance_score"] for r in st.l1.collect()}
    want = {("l1", 2)} | {("l2", i) for i in (1, 5, 8) if kept[i] > 3} | {("l3", i) for i in (5, 8, 9) if kept[i] >= 7}
    assert got == want and len(want) >= 4
    assert {r["stage"]: r["n"] for r in ingest.funnel_counts(st).collect()}["errors"] == len(want)
    stats = ingest.write(st, str(tmp_path / "n"), str(tmp_path / "s"), "2026-05-10", names_path=str(tmp_path / "r"))
    assert stats["errors"] == len(want) and key_store.name_store(spark, str(tmp_path / "r")).rows().count() >= stats["written"]
    again = ingest.plan_ingest(df, {}, "2026-05-11", seen=str(tmp_path / "s"), dry_run=True)
    assert again.new.count() == 0
