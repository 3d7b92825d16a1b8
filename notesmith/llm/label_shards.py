"""Sharding by balanced label propagation.

Rows that share a link key (a hub) are neighbours; a star over hubs stands for all pairs. Linked rows start evenly dealt
over the shards. In every round a join counts, per hub, how many of its rows each shard holds (one small array per
hub); a second join gives each row the sum over its hubs, and the row asks for the fullest shard (ties fall to one shard for a
whole hub, another one each round). The requests are counted per pair of shards, and moves are granted along cycles of requests, the shortest
first, and towards free room (``exchanges``), so full shards swap rows and no quota is ever exceeded. Within a pair of shards large hubs go first.

When a round keeps no more links than the one before, the rows of all hubs that are still cut exchange places: in the order of their hubs they fill
the places that they hold together, which cuts at most one hub per border of two shards. If that keeps more links the
rounds go on from there; propagation ends when neither step keeps more. Rows without links then fill every shard up to its quota, so
counts differ by one at most whatever the links are.

The number of shards bounds every array and everything that reaches the driver (loads and requests per pair of shards). Requests and rows are
numbered by ``balanced_row_number``, so no shard or hub meets one task whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notesmith.llm.common import documents, text_of
from notesmith.operators.ranking import balanced_row_number
from notesmith.session import cut_lineage, drop_cut

SHARDS = 8


def nodes_of(docs: DataFrame) -> DataFrame:
    """row, doc_id, size (UTF-8 bytes + 1), text_crc32, hub (digest of the text): one pass over the texts, written once."""
    b = text_of().cast("binary")
    return cut_lineage(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_of()) + 1).cast("long").alias("size"), F.crc32(b).alias("text_crc32"),
        F.unhex(F.sha2(b, 256)).alias("hub")))


def _loads(df: DataFrame, shards: int) -> list[int]:
    got = {r["shard"]: r["n"] for r in df.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [got.get(k, 0) for k in range(shards)]


def _shortest_cycle(asked: list[list[int]]) -> list[tuple[int, int]]:
    """The moves of a shortest cycle of requests; none if there is no cycle."""
    n, best = len(asked), []
    for start in range(n):
        came, front = {start: start}, [start]
        while front:
            nxt, closing = [], None
            for a in front:
                if asked[a][start]:
                    closing = a
                    break
                for b in range(n):
                    if asked[a][b] and b not in came:
                        came[b] = a
                        nxt.append(b)
            if closing is not None:
                path = [(closing, start)]
                while path[-1][0] != start:
                    path.append((came[path[-1][0]], path[-1][0]))
                best = path if not best or len(path) < len(best) else best
                break
            front = nxt
    return best


def exchanges(asked: list[list[int]], free: list[int]) -> list[list[int]]:
    """How many of the ``asked[k][j]`` requests from shard k to shard j are granted: all along cycles, the shortest first, then those
    that end in free room, which moves on to the shard that was left."""
    asked, free = [list(r) for r in asked], list(free)
    granted = [[0] * len(free) for _ in free]

    def grant(moves: list[tuple[int, int]], n: int) -> None:
        for k, j in moves:
            asked[k][j] -= n
            granted[k][j] += n

    while cycle := _shortest_cycle(asked):
        grant(cycle, min(asked[k][j] for k, j in cycle))
    moved = True
    while moved:
        moved = False
        for j in range(len(free)):
            for k in range(len(free)):
                if n := min(asked[k][j], free[j]):
                    grant([(k, j)], n)
                    free[j], free[k], moved = free[j] - n, free[k] + n, True
    return granted


def _tally(links: DataFrame, state: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """hub, held (rows per shard), members; and the number of linked pairs (each row with itself) that stand together."""
    counts = [F.count(F.when(F.col("shard") == k, 1)) for k in range(shards)]
    tally = cut_lineage(links.join(state, "row").groupBy("hub").agg(F.array(*counts).alias("held"), F.count(F.lit(1)).alias("members")))
    kept = tally.select(F.sum(F.aggregate("held", F.lit(0).cast("long"), lambda a, n: a + n * n))).first()[0]
    return tally, kept or 0


def _moved(links: DataFrame, state: DataFrame, tally: DataFrame, quotas: list[int], loads: list[int], turn: int) -> DataFrame | None:
    """The state after one round of requests and grants; None if nothing moves."""
    shards = len(quotas)
    votes = links.join(tally, "hub").groupBy("row").agg(
        F.array(*[F.sum(F.col("held")[k]) for k in range(shards)]).alias("votes"), F.max(F.struct("members", "hub")).alias("lead"))
    best = F.array_max(F.transform("votes", lambda v, k: F.struct(v.alias("v"), F.xxhash64("lead.hub", k, F.lit(turn)).alias("tie"), k.alias("k"))))
    asks = votes.join(state, "row").withColumn("best", best).where(F.col("best.k") != F.col("shard"))
    asks = cut_lineage(asks.select("row", "shard", F.col("best.k").alias("want"), (-F.col("lead.members")).alias("less"), F.xxhash64("lead.hub").alias("hub")))
    asked = [[0] * shards for _ in quotas]
    for r in asks.groupBy("shard", "want").count().collect():
        asked[r["shard"]][r["want"]] = r["count"]
    granted = exchanges(asked, [q - n for q, n in zip(quotas, loads)])
    if not any(map(any, granted)):
        return None
    room = F.array(*[F.lit(n) for row in granted for n in row])[F.col("shard") * shards + F.col("want")]
    goes = balanced_row_number(asks, ["shard", "want"], ["less", "hub", "row"]).where(F.col("rn") <= room).select("row", "want")
    return cut_lineage(state.join(goes, "row", "left").select("row", F.coalesce("want", "shard").cast("int").alias("shard")))


def _gathered(links: DataFrame, state: DataFrame, tally: DataFrame, quotas: list[int], loads: list[int]) -> DataFrame:
    """The state after the rows of all cut hubs have exchanged places: in the order of their largest hubs, over the places they hold."""
    held_in = F.size(F.filter("held", lambda n: n > 0))
    lead = links.join(tally.select("hub", "members", (held_in > 1).alias("cut")), "hub").groupBy("row").agg(F.max(F.struct("members", "hub", "cut")).alias("lead"))
    rows = cut_lineage(lead.where("lead.cut").join(state, "row").select("row", "shard", (-F.col("lead.members")).alias("less"), F.col("lead.hub").alias("hub")))
    ends, upto = [], 0
    for q, n, own in zip(quotas, loads, _loads(rows, len(quotas))):
        upto += q - n + own
        ends.append(upto)
    to = F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e < F.col("rn"))).cast("int")
    goes = balanced_row_number(rows, [], ["less", "hub", "row"]).select("row", to.alias("want"))
    return cut_lineage(state.join(goes, "row", "left").select("row", F.coalesce("want", "shard").cast("int").alias("shard")))


def propagate(links: DataFrame, quotas: list[int]) -> DataFrame:
    """row, shard for every row of ``links`` (row, hub; a row may have several hubs, a hub any number of rows)."""
    shards = len(quotas)
    order = F.xxhash64(F.lit(7), "row")
    state = balanced_row_number(links.select("row").distinct().withColumn("o", order), [], ["o", "row"], "rn")
    state = cut_lineage(state.select("row", ((F.col("rn") - 1) % shards).cast("int").alias("shard")))
    tally, kept = _tally(links, state, shards)
    turn = 0
    while True:  # every turn keeps more links, or is the last
        loads = _loads(state, shards)
        for step in (lambda: _moved(links, state, tally, quotas, loads, turn), lambda: _gathered(links, state, tally, quotas, loads)):
            new = step()
            if new is None:
                continue
            now, more = _tally(links, new, shards)
            if more > kept:
                break
        else:
            return state
        for old in (state, tally):
            drop_cut(old)
        state, tally, kept, turn = new, now, more, turn + 1


def shard_rows(nodes: DataFrame, links: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``nodes`` (row, ...) with shard (int) and slot (gapless from 0 in every shard).

    Counts of any two shards differ by one at most. An empty table gives no rows. Where rows have no other link than equal text, at most
    shards - 1 groups that fit in a shard are cut. ``row`` is a place in the files: a table written anew may be dealt anew.
    """
    n = nodes.count()
    quotas = [n // shards + (k < n % shards) for k in range(shards)]
    linked = propagate(links, quotas)
    loads = _loads(linked, shards)
    singles = nodes.select("row").join(linked, "row", "left_anti").withColumn("o", F.xxhash64(F.lit(11), "row"))
    upto, ends = 0, []
    for q, have in zip(quotas, loads):
        upto += q - have
        ends.append(upto)
    rest = balanced_row_number(singles, [], ["o", "row"]).select(
        "row", F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e < F.col("rn"))).cast("int").alias("shard"))
    placed = nodes.join(linked.unionByName(rest), "row")
    return balanced_row_number(placed, ["shard"], ["row"], "slot").withColumn("slot", F.col("slot") - 1)


def text_links(nodes: DataFrame) -> DataFrame:
    """row, hub of the rows whose text another row repeats."""
    shared = nodes.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hub")
    return cut_lineage(nodes.join(shared, "hub").select("row", "hub"))


def op6_label_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 under the law ``rows``. Null texts have one byte of size; rows that repeat id and text
    are rows of their own and neighbours; null ids are kept. Other columns of the table are not read."""
    nodes = nodes_of(documents(spark, sf_dir))
    t = shard_rows(nodes, text_links(nodes))
    return t.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))
