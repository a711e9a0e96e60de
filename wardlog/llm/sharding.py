"""Balanced label propagation: linked documents move to their neighbours' shards under quotas.

Links are hyperedges: rows ``(node, hub)`` say which nodes belong together (equal texts share a
hub; an ordinary edge is a hub of two). In every round the members of a hub are counted per
shard, every node adds up the votes of its hubs, and asks to move to the fullest of its
neighbours' shards that still has room; ties fall to the shard a hash of the hub prefers, so
two halves of a group do not swap places. A shard accepts as many movers as it has room for,
the places of those that leave it in the same round included. Once nobody asks for a shard with room, full shards
are open, too, and exchange nodes.
Nodes without links wait, and fill the shards up to exactly even counts at the end.

Column expressions and joins only. Votes are pre-aggregated to one row per hub, so a hub that
holds a third of all nodes is one row on one side of a join whose other side can be split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlog.llm.common import slots
from wardlog.operators.keyed import HEAVY_SHARE
from wardlog.session import materialize

SHARDS = 16
ROUNDS = 8


def unit(*keys: Column | str) -> Column:
    """Reproducible number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / F.lit(float(1 << 30))


def acceptance(room: list[int], wishes: dict[tuple[int, int], int]) -> list[float]:
    """Share of the movers into each shard that can be accepted; ``wishes`` counts them by ``(from, to)``.

    Whoever leaves makes room, so the shares depend on one another: from all accepted downwards until no shard grows beyond its room, and none that is too full
    grows at all.
    """
    shards = range(len(room))
    asked = [sum(n for (_, to), n in wishes.items() if to == s) for s in shards]
    share = [1.0] * len(room)
    for _ in range(1000):
        leaves = [sum(share[to] * n for (at, to), n in wishes.items() if at == s) for s in shards]
        lower = [min(share[s], (max(0, room[s]) + leaves[s]) / asked[s]) if asked[s] else 0.0 for s in shards]
        if max(abs(a - b) for a, b in zip(share, lower)) < 1e-6:
            break
        share = lower
    return lower


def propagate(members: DataFrame, labels: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """Labels ``node, shard`` after propagation; ``capacity`` nodes at most are meant for a shard.

    Movers are drawn by hash, so two standard deviations of the draw are kept free; the caller
    evens out what still exceeds the capacity.
    """
    capacity -= round(2 * capacity ** 0.5)
    labels = materialize(labels, "labels")
    exchange = False
    for turn in range(rounds):
        load = {r.shard: r.n for r in labels.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        room = [capacity - load.get(s, 0) for s in range(shards)]
        placed = members.join(labels, "node")
        votes = placed.groupBy("hub").agg(*[F.count_if(F.col("shard") == s).alias(f"v{s}") for s in range(shards)])
        heard = placed.join(votes, "hub").groupBy("node").agg(
            F.first("shard").alias("shard"), F.min("hub").alias("hub"), *[F.sum(f"v{s}").alias(f"v{s}") for s in range(shards)])
        choices = F.array(*[F.struct(F.col(f"v{s}").alias("votes"), unit(F.lit(s), "hub").alias("tie"), F.lit(s).alias("to"))
                            for s in range(shards)])
        # Only shards with room, and the own one, can be chosen, until that leads no further.
        is_open = F.array(*[F.lit(exchange or r > 0) for r in room])
        best = F.array_max(F.filter(choices, lambda c: (c["to"] == F.col("shard")) | F.get(is_open, c["to"])))
        wishes = materialize(heard.select("node", "shard", best.getField("to").alias("to")), "wishes")
        flows = wishes.where("shard <> to").groupBy("shard", "to").agg(F.count(F.lit(1)).alias("n"))
        asked = {(r.shard, r.to): r.n for r in flows.collect()}  # no more than shards * shards
        if not asked:
            if exchange:
                break
            exchange = True
            continue
        share = F.array(*[F.lit(a) for a in acceptance(room, asked)])
        moves = unit("node", F.lit(turn)) < F.get(share, F.col("to"))
        labels = materialize(wishes.select("node", F.when(moves, F.col("to")).otherwise(F.col("shard")).alias("shard")), "labels")
    return labels


def even_counts(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def interval(position: Column, sizes: list[int]) -> tuple[Column, Column]:
    """Index of the interval of cumulated ``sizes`` that holds a position, and the offset in it."""
    ends = [sum(sizes[:i + 1]) for i in range(len(sizes))]
    index = reduce(lambda c, e: c + (position >= e).cast("int"), ends[:-1], F.lit(0))
    return index, position - F.get(F.array(*[F.lit(e - n).cast("bigint") for e, n in zip(ends, sizes)]), index)


def balanced_shards(nodes: DataFrame, members: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``node, shard, slot``: counts of shards differ by one at most, slots are gapless from 0.

    ``nodes`` has one row per ``node`` (bigint); ``members`` holds ``node, hub`` of linked nodes. Nodes
    of ``members`` must be in ``nodes``. No nodes give no rows.
    """
    members = materialize(members.select("node", "hub").distinct(), "members")
    total = nodes.count()
    wanted = even_counts(total, shards)
    linked = members.select("node").distinct()
    start = linked.select("node", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"))
    labels = propagate(members, start, shards, min(wanted), rounds)
    seated = materialize(slots(labels, "shard", ["node"], "slot"), "seated")
    keeps = F.col("slot") < F.get(F.array(*[F.lit(w) for w in wanted]), F.col("shard"))
    load = {r.shard: r.n for r in seated.where(keeps).groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    gaps = [w - load.get(s, 0) for s, w in enumerate(wanted)]
    # Whoever found no seat fills the gaps together with the nodes without links.
    waiting = nodes.select("node").join(linked, "node", "left_anti").union(seated.where(~keeps).select("node"))
    queue = slots(waiting.withColumn("line", F.lit(0)), "line", ["node"], "position")
    shard, offset = interval(F.col("position"), gaps)
    filled = queue.select("node", shard.alias("shard"), offset.alias("offset"))
    taken = F.array(*[F.lit(load.get(s, 0)) for s in range(shards)])
    filled = filled.select("node", "shard", (F.col("offset") + F.get(taken, F.col("shard"))).cast("bigint").alias("slot"))
    return seated.where(keeps).select("node", "shard", "slot").union(filled)


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Even shards of documents; equal texts belong together (a null text equals the empty one).

    Returns ``doc_id, size`` (bytes plus one), ``text_crc32, law, shard, slot, grown_shard``. Rows are
    numbered for the purpose, so repeated or missing ids are rows of their own.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("digest"))
    rows = materialize(rows.withColumn("node", F.monotonically_increasing_id()), "shard-rows")
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = materialize(counts, "text-groups")
    # No more than 1 / HEAVY_SHARE groups are heavy: those travel to the rows, the rows of others meet theirs in a join.
    heavy = groups.where(F.col("n") >= groups.select(F.sum("n")).scalar() * F.lit(HEAVY_SHARE)).select("digest", F.lit(True).alias("is_heavy"))
    marked = rows.select("node", "digest").join(F.broadcast(heavy), "digest", "left")
    light = marked.where("is_heavy is null").join(groups, "digest", "left_semi")
    members = marked.where("is_heavy").unionByName(light).select("node", F.xxhash64("digest").alias("hub"))
    placed = balanced_shards(rows, members, shards, rounds)
    return rows.join(placed, "node").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
