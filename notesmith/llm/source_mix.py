"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree. Native expressions only.

1. ``sized``: one pass over the texts leaves narrow rows (doc_id, source, size in words, key).
2. ``targets``: per source its share of the mix, at most ``most`` times its size, the excess shared out again.
3. Blocks: the documents of a source fall by key into at most ``max_blocks`` blocks of about ``block_words`` words, and
   a keyed permutation orders the blocks. The mix takes whole copies of every block, then in permuted order every block
   that still fits the target, then documents of a few blocks on the border: the exact block quota of the source.
4. ``split_quotas``: a binary tree over the output shards. At every node the quotas of all sources are split between
   the two halves by one multivariate-hypergeometric draw, the law that dealing the node's shuffled blocks would
   give. The draw folds one hypergeometric draw per source over the sources, each by inversion from a keyed uniform.
   Sources are folded in groups, so no task holds more than one group's sources.
5. Each shard owns a disjoint range of every source's permuted blocks, and orders its own rows by a keyed number:
   the shuffle within a shard needs no exchange beyond the one that brings the shard together.

Everything is keyed by ``seed``, so runs agree. Only tables with one row per source or block are ever ranked by
windows; documents meet a window in border blocks alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notesmith.llm.common import documents, let, packed, text_of, words_of
from notesmith.operators.joins import sized_broadcast
from notesmith.session import cut_lineage, drop_cut

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS, MAX_BLOCKS = 4096, 65_536
LEVELS = 3
SOURCES_PER_GROUP = 256
SEED = 20_240_611
#: Blocks behind those taken whole whose documents may fill the rest of a target; each holds more words than that rest.
BORDER_BLOCKS = 8
#: Rounds in which documents of the border blocks fill what is left of the target; each leaves a smaller rest.
FILL_ROUNDS = 6


def _hash(seed: int, *cols) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def _uniform(seed: int, *cols) -> Column:
    """In [0, 1), from 53 bits of a keyed hash."""
    return F.shiftrightunsigned(_hash(seed, *cols), 11).cast("double") / F.lit(float(1 << 53))


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """row (tells equal rows apart), doc_id, source, size, key; written once, later steps read it instead of the texts."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    text_of().alias("text"))
    return cut_lineage(t.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"),
                                _hash(seed, "doc_id", "text").alias("key")))


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target per source (null is a source and comes last).

    Water-filling in closed form: in ascending order of limit per weight, a source is held at its limit when an even
    share of what the sources before it left over would pass it. One row per source meets these windows.
    """
    per = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    one = Window.partitionBy(F.lit(1))
    by_name = one.orderBy(F.col("source").asc_nulls_last())
    ws = F.array(*[F.lit(float(w)) for w in weights])
    t = per.withColumn("w", F.element_at(ws, (F.row_number().over(by_name) - 1) % len(weights) + 1))
    t = t.withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    t = t.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(one))
    up = one.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("w").over(after)
    t = t.withColumn("level", level).withColumn("held", F.col("limit") <= F.col("level") * F.col("w"))
    free = F.when(~F.col("held"), F.col("level"))
    t = t.withColumn("water", F.first(free, ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding,
                                                                                  Window.unboundedFollowing)))
    return t.select("source", "source_size", F.when(F.col("held"), F.col("limit")).otherwise(
        F.least(F.col("limit"), F.col("water") * F.col("w"))).alias("target"))


def hypergeometric(n: Column, k: Column, m: Column, u: Column) -> Column:
    """Inversion of the hypergeometric law: of ``m`` drawn out of ``n`` of which ``k`` are marked, how many are marked.

    Weights are taken relative to the mode and by the ratio of neighbours, outward to nine standard deviations: the
    mode first, then values above it, then below. Two folds with scalar state: the sum of weights, then the value
    at which it reaches ``u`` times the whole.
    """
    def known(a):
        n, k, m = a["n"], a["k"], a["m"]
        lo, hi = F.greatest(F.lit(0.0), m + k - n), F.least(k, m)
        some, others = F.greatest(n, F.lit(1.0)), F.greatest(n - 1, F.lit(1.0))
        var = m * (k / some) * ((n - k) / some) * ((n - m) / others)
        mode = F.least(hi, F.greatest(lo, F.floor((m + 1) * (k + 1) / (n + 2)).cast("double")))
        reach = F.ceil(9 * F.sqrt(F.greatest(var, F.lit(0.0)))).cast("double") + 12
        return F.struct(n.alias("n"), k.alias("k"), m.alias("m"), a["u"].alias("u"), lo.alias("lo"), hi.alias("hi"),
                        mode.alias("mode"), reach.alias("reach"))

    def drawn(a):
        def above(i):  # weight of mode + i over that of mode + i - 1
            x = a["mode"] + i - 1
            return (a["k"] - x) * (a["m"] - x) / ((x + 1) * (a["n"] - a["k"] - a["m"] + x + 1))

        def below(i):
            x = a["mode"] - i + 1
            return x * (a["n"] - a["k"] - a["m"] + x) / ((a["k"] - x + 1) * (a["m"] - x + 1))

        def steps(room):  # 0 stands for the mode
            return F.sequence(F.lit(0), F.least(room, a["reach"]).cast("int"))

        def weight(w, i, ratio):
            return F.when(i == 0, F.lit(1.0)).otherwise(w * ratio(i))

        def total(room, ratio):
            zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))
            return F.aggregate(steps(room), zero, lambda s, i: let(weight(s["w"], i, ratio), lambda w: F.struct(
                w.alias("w"), (s["s"] + w).alias("s"))))["s"]

        def found(room, ratio, sign, base, goal):
            zero = F.struct(F.lit(1.0).alias("w"), base.alias("s"), F.lit(None).cast("double").alias("x"))
            return F.aggregate(steps(room), zero, lambda s, i: let(weight(s["w"], i, ratio), lambda w: F.struct(
                w.alias("w"), (s["s"] + w).alias("s"),
                F.coalesce(s["x"], F.when(s["s"] + w >= goal, a["mode"] + sign * i)).alias("x"))))["x"]

        up, down = a["hi"] - a["mode"], a["mode"] - a["lo"]
        sums = F.struct(total(up, above).alias("up"), (total(down, below) - 1).alias("down"))  # the mode counts once
        x = let(sums, lambda s: let(a["u"] * (s["up"] + s["down"]), lambda goal: F.coalesce(
            found(up, above, 1, F.lit(0.0), goal), found(down, below, -1, s["up"] - 1, goal), a["mode"])))
        return F.when(a["hi"] <= a["lo"], a["lo"]).otherwise(x).cast("long")

    given = F.struct(n.cast("double").alias("n"), k.cast("double").alias("k"), m.cast("double").alias("m"), u.alias("u"))
    return let(given, lambda a: let(known(a), drawn))


def _deal(rows: DataFrame, keys: list[str], item: str, seed: int) -> DataFrame:
    """rows: keys, item, quota, m (capacity of the left half, one value per key) -> left part of every quota."""
    g = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(item, "quota"))).alias("all"),
                                F.sum("quota").alias("n"), F.max("m").alias("m"))
    g = g.withColumn("all", F.transform("all", lambda x: F.struct(
        x[item].alias(item), x["quota"].alias("quota"),
        _uniform(seed, *[F.col(k) for k in keys], F.coalesce(x[item].cast("string"), F.lit("\0null"))).alias("u"))))
    cell = f"array<struct<{item}:{dict(rows.dtypes)[item]},left:bigint>>"
    zero = F.struct(F.col("n").alias("n"), F.col("m").alias("m"), F.array().cast(cell).alias("out"))

    def step(a, x):
        return let(hypergeometric(a["n"], x["quota"], a["m"], x["u"]), lambda left: F.struct(
            (a["n"] - x["quota"]).alias("n"), (a["m"] - left).alias("m"),
            F.concat(a["out"], F.array(F.struct(x[item].alias(item), left.alias("left")))).alias("out")))

    return g.select(*keys, F.explode(F.aggregate("all", zero, step)["out"]).alias("o")).select(*keys, "o.*")


def split_quotas(quotas: DataFrame, levels: int = LEVELS, seed: int = SEED, per_group: int = SOURCES_PER_GROUP) -> DataFrame:
    """source, quota -> source, shard (0 .. 2**levels - 1), quota: every node of the tree splits its quotas in two.

    The left half of a node takes half of its blocks (the odd one goes left or right by key). First the quotas of
    source groups are split, then each group's own sources, both by the same draw."""
    n_groups = F.greatest(F.lit(1), F.ceil(F.sum(F.lit(1)).over(Window.partitionBy(F.lit(1))) / F.lit(per_group)))
    t = quotas.select("source", F.pmod(_hash(seed, F.coalesce("source", F.lit("\0null"))), n_groups).alias("grp"),
                      F.lit(0).alias("shard"), F.col("quota").cast("long").alias("quota"))
    for level in range(levels):
        t = cut_lineage(t)
        sums = t.groupBy("shard", "grp").agg(F.sum("quota").alias("quota"))
        whole = sums.groupBy("shard").agg(F.sum("quota").alias("_n"))
        odd = F.when(_uniform(seed + level, "shard") < 0.5, 1).otherwise(0)
        sums = sums.join(whole, "shard").withColumn("m", F.floor((F.col("_n") + odd) / 2).cast("long")).drop("_n")
        of_group = _deal(sums, ["shard"], "grp", seed + 100 + level).withColumnRenamed("left", "m")
        rows = t.join(of_group, ["shard", "grp"])
        left = _deal(rows, ["shard", "grp"], "source", seed + 200 + level)
        a, b = t.alias("a"), left.alias("b")
        both = a.join(b, (F.col("a.shard") == F.col("b.shard")) & F.col("a.source").eqNullSafe(F.col("b.source")))
        halves = F.array(F.struct((F.col("a.shard") * 2).alias("shard"), F.col("b.left").alias("quota")),
                         F.struct((F.col("a.shard") * 2 + 1).alias("shard"), (F.col("a.quota") - F.col("b.left")).alias("quota")))
        t = both.select("a.source", "a.grp", F.explode(halves).alias("h")).select("source", "grp", "h.*")
    return t.select("source", "shard", "quota")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, levels: int = LEVELS,
        block_words: int = BLOCK_WORDS, max_blocks: int = MAX_BLOCKS, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, targets, drawn): ``rows`` is ``sized``, ``drawn`` one row per taken copy: row, doc_id, source, size, key, copy, shard, place.

    Null texts have size 0. A null source is a source of its own, ranked last. Repeated rows (same id and text) share a key
    and are drawn each by itself. Documents of size 0 add nothing to a target; they come with their block. An
    empty table gives empty tables. Other columns, whatever their names, are not read.
    """
    rows = sized(docs, seed)
    per = cut_lineage(targets(rows, weights, share, most))
    whole = F.least(F.lit(int(most)), F.floor(F.col("target") / F.greatest("source_size", F.lit(1))))
    plan = per.withColumn("copies", F.when(F.col("source_size") == 0, 0).otherwise(whole).cast("int"))
    plan = plan.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    plan = plan.withColumn("n_blocks", F.least(F.lit(max_blocks), F.greatest(
        F.lit(1), F.ceil(F.col("source_size") / block_words))).cast("int"))
    small = sized_broadcast(plan.withColumnRenamed("source", "_source"))
    placed = rows.join(small, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = placed.withColumn("block", F.pmod(_hash(seed + 1, "key"), "n_blocks").cast("int"))
    blocks = placed.groupBy("source", "block", "copies", "rest", "n_blocks").agg(F.sum("size").alias("words"))
    blocks = _whole_blocks(blocks.withColumn("o", _hash(seed + 2, "source", "block")), block_words)
    # The blocks taken come first, then those of the border: a source's draws are numbered without gaps.
    order = Window.partitionBy("source").orderBy(~F.col("full"), ~F.col("full") & F.col("long"), "o", "block")
    blocks = blocks.withColumn("at", F.row_number().over(order) - 1)
    blocks = blocks.withColumn("n_full", F.count(F.when(F.col("full"), 1)).over(Window.partitionBy("source")))
    blocks = blocks.withColumn("border", ~F.col("full") & (F.col("room") > 0) & (F.col("at") < F.col("n_full") + BORDER_BLOCKS))
    # Every taken block is one draw; its number in the source's permuted sequence decides the shard.
    held = F.count(F.lit(1)).over(Window.partitionBy("source"))
    last = F.col("copies") + F.when(F.col("full") | F.col("border"), 1).otherwise(0)
    blocks = cut_lineage(blocks.withColumn("n", last).withColumn("held", held).select(
        "source", "block", "copies", "at", "room", "border", "n", "held"))
    quotas = blocks.groupBy("source").agg(F.sum("n").cast("long").alias("quota"))
    tree = split_quotas(quotas, levels, seed)
    upto = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = tree.withColumn("hi", F.sum("quota").over(upto)).groupBy("source").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("shard", "hi"))), lambda x: x["hi"]).alias("his"))
    a, b = blocks.where("n > 0").alias("a"), sized_broadcast(ranges).alias("b")
    draws = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source"))).select(
        "a.source", "a.block", "a.border", "a.copies", "a.room", "b.his", "a.at", "a.held", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
    number = F.col("copy") * F.col("held") + F.col("at")
    shard = F.size(F.filter("his", lambda h: h <= number))
    draws = draws.withColumn("shard", shard).withColumn("part", F.col("border") & (F.col("copy") == F.col("copies")))
    draws = draws.groupBy("source", "block").agg(
        F.max(F.when(F.col("part"), F.col("room"))).alias("room"), F.max("at").alias("at"),
        F.collect_list(F.struct("copy", "shard", "part")).alias("draws"))
    p, d = placed.alias("p"), draws.alias("d")
    met = p.join(d, F.col("p.source").eqNullSafe(F.col("d.source")) & (F.col("p.block") == F.col("d.block"))).select(
        "p.row", "p.doc_id", "p.source", "p.size", "p.key", "d.room", "d.at", F.explode("d.draws").alias("x")).select("*", "x.*").drop("x")
    met = cut_lineage(met)
    cols = ["row", "doc_id", "source", "size", "key", "copy", "shard"]
    filled = _fill(met.where("part")).select(*cols)
    drawn = met.where(~F.col("part")).select(*cols).unionByName(filled)
    return rows, per, drawn.withColumn("place", _hash(seed + 3, "shard", "key", "copy"))


def _whole_blocks(blocks: DataFrame, block_words: int) -> DataFrame:
    """``blocks`` with long (holds a document far over a block's size), full (taken whole) and room (what is left of ``rest``).

    Blocks are taken in permuted order, each that still fits, until none does. A source that stops more than a block short so,
    because its long blocks came too late, takes its long blocks first. Every round takes the next run of blocks and passes
    one that does not fit; the table has one row per block.
    """
    t = blocks.withColumn("long", F.col("words") > 2 * block_words).withColumn("try", F.explode(F.array(F.lit(0), F.lit(1))))
    t = cut_lineage(t.withColumns({"full": F.lit(False), "new": F.lit(False), "room": F.col("rest").cast("double")}))
    allof = Window.partitionBy("source", "try")
    upto = allof.orderBy(~((F.col("try") == 1) & F.col("long")), "o", "block").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    while True:
        fits = ~F.col("full") & (F.col("room") > 0) & (F.col("words") <= F.col("room"))
        new = t.withColumn("new", fits & (F.sum(F.when(fits, F.col("words")).otherwise(0)).over(upto) <= F.col("room")))
        new = new.withColumn("room", F.col("room") - F.coalesce(F.sum(F.when(F.col("new"), F.col("words"))).over(allof), F.lit(0)))
        old, t = t, cut_lineage(new.withColumn("full", F.col("full") | F.col("new")))
        drop_cut(old)
        if t.where("new").isEmpty():
            break
    room = [F.max(F.when(F.col("try") == k, F.col("room"))).over(Window.partitionBy("source")) for k in (0, 1)]
    pick = F.when(room[0] - room[1] > block_words, 1).otherwise(0)
    return t.withColumn("pick", pick).where(F.col("try") == F.col("pick")).drop("try", "pick", "new")


def _fill(part: DataFrame, rounds: int = FILL_ROUNDS) -> DataFrame:
    """Documents of border blocks that fit into the room left, in keyed order. ``BORDER_BLOCKS`` bounds a window's rows."""
    order = Window.partitionBy("source").orderBy("at", "key", "row")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    allof = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = part.withColumn("in", F.lit(False)).withColumn("left", F.col("room"))
    for _ in range(rounds):
        fits = ~F.col("in") & (F.col("size") <= F.col("left"))
        t = t.withColumn("sum", F.sum(F.when(fits, F.col("size")).otherwise(0)).over(upto))
        t = t.withColumn("new", fits & (F.col("sum") <= F.col("left")))
        t = t.withColumn("left", F.col("left") - F.coalesce(F.sum(F.when(F.col("new"), F.col("size"))).over(allof), F.lit(0)))
        t = t.withColumn("in", F.col("in") | F.col("new"))
    # Nearer than stopping short may be one more document past the target, or the smallest one left for one taken.
    off = F.when(~F.col("in"), F.struct(F.abs(F.col("size") - F.col("left")).alias("off"), "row"))
    spare = F.when(~F.col("in") & (F.col("size") > 0), F.struct("size", "row"))
    t = t.withColumns({"more": F.min(off).over(allof), "spare": F.min(spare).over(allof)})
    back = F.struct(F.abs(F.col("left") - F.col("spare.size") + F.col("size")).alias("off"), "row")
    t = t.withColumn("back", F.min(F.when(F.col("in") & F.col("spare").isNotNull(), back)).over(allof))
    far = F.lit(float("inf"))
    plus, swap = F.coalesce("more.off", far), F.coalesce("back.off", far)
    row = F.col("row")
    return t.where(F.when(swap < F.least("left", plus), (F.col("in") & (row != F.col("back.row"))) | (row == F.col("spare.row")))
                   .otherwise(F.col("in") | (F.coalesce(row == F.col("more.row"), F.lit(False)) & (plus < F.col("left")))))


def write_mix(docs: DataFrame, drawn: DataFrame, path: str, levels: int = LEVELS) -> None:
    """The mixed rows (as struct ``doc``), one folder per output shard, in the shard's shuffled order."""
    rows = _with_copies(docs, drawn)
    n = max(1 << levels, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (rows.repartitionByRange(n, "shard", "place").sortWithinPartitions("shard", "place").select("doc", "shard")
     .write.partitionBy("shard").mode("overwrite").parquet(path))


def _with_copies(docs: DataFrame, drawn: DataFrame, seed: int = SEED) -> DataFrame:
    """doc (the whole row as a struct), shard, place of each drawn copy. Rows equal in id and text share their key's copies."""
    per = drawn.select(F.col("doc_id").alias("id"), "key", F.struct("place", "shard").alias("c"))
    per = per.groupBy("id", "key").agg(F.sort_array(F.collect_list("c")).alias("cs"))
    own_id = F.col("doc_id").cast("long")
    keyed = docs.select(packed(docs), own_id.alias("id"), _hash(seed, own_id, text_of()).alias("key"))
    a, b = keyed.alias("a"), per.alias("b")
    t = a.join(b, F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.key") == F.col("b.key"))).select("a.*", "b.cs")
    w = Window.partitionBy("id", "key")
    t = t.withColumns({"i": F.row_number().over(w.orderBy("id")), "m": F.count(F.lit(1)).over(w)})
    own = F.filter("cs", lambda c, i: F.pmod(i, F.col("m")) == F.col("i") - 1)
    return t.select("doc", F.explode(own).alias("c")).select("doc", "c.shard", "c.place")


def op8_source_mix(spark, sf_dir: str) -> DataFrame:
    rows, per, drawn = mix(documents(spark, sf_dir))
    got = drawn.groupBy("row").agg(F.sum("size").alias("all"), F.count(F.lit(1)).alias("copies"),
                                             F.concat_ws(",", F.sort_array(F.collect_list("shard"))).alias("shards"))
    a, b, s = rows.alias("a"), got.alias("b"), sized_broadcast(per).alias("s")
    out = a.join(b, F.col("a.row") == F.col("b.row"), "left").join(
        s, F.col("a.source").eqNullSafe(F.col("s.source")))
    return out.select("a.doc_id", "a.size", "s.source_size", "s.target", F.coalesce("b.all", F.lit(0)).cast("long").alias("taken"),
                      F.coalesce("b.copies", F.lit(0)).alias("copies"), F.coalesce("b.shards", F.lit("")).alias("shards"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every drawn copy of a document as one row with all columns."""
    _, _, drawn = mix(docs)
    return _with_copies(docs, drawn).select("doc.*")
