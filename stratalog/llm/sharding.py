"""Shards of equal size that keep linked documents together: balanced label propagation.

Documents are linked by the groups they are members of. A document without links is at home anywhere, so
only linked ones take part: they begin dealt evenly over the shards, and in each round a document is drawn
to the shard where most members of its groups are. How many may go from one shard to another is bounded:
as many as come the other way, and what room is left up to the shard's quota. Members of a group agree on
where they are drawn to, so groups gather instead of changing places. When nothing moves any more, the
documents without links fill the shards up to their quotas exactly, and of a shard that holds more than its
quota the last go to where room is. A group larger than a quota fills shard after shard.

Places in a shard are found by counting: rows are dealt into bins, bins are added up in order, and a row's
place is the sum before its bin and its place there. No task sees all rows of a shard or of a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalog.llm.common import written
from stratalog.llm.skew import heavy_keys, look_up

# Bins that a heavy group is dealt over.
HEAVY_BINS = 1024


@dataclass(frozen=True)
class Sharding:
    shards: int = 8
    rounds: int = 12  # at most; the rounds end when nothing moves
    bin_rows: int = 20_000  # rows counted by one task at a time


def _bins(rows: int, sharding: Sharding) -> int:
    return max(1, -(-rows // sharding.bin_rows))


def _order(rows: int, sharding: Sharding) -> Column:
    """The bin of a row (node, lead, heavy): a group is in one bin, a heavy one in many."""
    whole = F.pmod(F.xxhash64("lead"), F.lit(_bins(rows, sharding))) * HEAVY_BINS
    inside = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(HEAVY_BINS - 1)) + 1
    return whole + F.when(F.col("heavy"), inside).otherwise(0)


def numbered(rows: DataFrame, of: Sequence[str], bin_: Column, order: Sequence[str],
             name: str) -> DataFrame:
    """``rows`` numbered from 0 within ``of``: bin after bin, and by ``order`` (unique) in a bin."""
    binned = rows.withColumn("_bin", bin_)
    sizes = binned.groupBy(*of, "_bin").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*of).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*of, "_bin").orderBy(*order)
    placed = binned.withColumn("_at", F.row_number().over(inside) - 1)
    return placed.join(sizes, [*of, "_bin"]).withColumn(name, F.col("_before") + F.col("_at")).drop(
        "_bin", "_before", "_at")


def _by_shard(labels: DataFrame, sharding: Sharding) -> list[int]:
    found = {r["shard"]: r["count"] for r in labels.groupBy("shard").count().collect()}
    return [found.get(s, 0) for s in range(sharding.shards)]


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _allowed(flow: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many may go from shard to shard: those that change places, and those there is room for."""
    room = list(room)
    allowed = {}
    for (i, j), wish in sorted(flow.items()):
        swap = min(wish, flow.get((j, i), 0))
        into = min(wish - swap, max(room[j], 0))
        room[j] -= into
        allowed[i, j] = swap + into
    return allowed


def _lookup_by_pair(values: dict[tuple[int, int], int], i: Column, j: Column) -> Column:
    """A number for two shards, written into the plan: there are as many as pairs of shards."""
    found = F.lit(0).cast("bigint")
    for (a, b), value in values.items():
        found = F.when((i == a) & (j == b), F.lit(value).cast("bigint")).otherwise(found)
    return found


def propagated(members: DataFrame, quota: Sequence[int], sharding: Sharding) -> DataFrame:
    """(node, lead, heavy, shard) of all nodes of ``members`` (node, group: each pair once), after the
    rounds.

    ``lead`` is the node's smallest group, ``heavy`` says that it is among the largest. A shard is
    never filled beyond its quota by a move; it may begin beyond it where nearly all documents are linked.
    """
    shards = range(sharding.shards)
    heavy = written(heavy_keys(members, ["group"], members.count()), "heavy_groups")
    labels = members.groupBy("node").agg(F.min("group").alias("lead"))
    named = F.broadcast(heavy.select(F.col("group").alias("lead"), F.lit(True).alias("heavy")))
    labels = written(labels.join(named, "lead", "left").select(
        "node", "lead", F.coalesce("heavy", F.lit(False)).alias("heavy"),
        F.pmod(F.xxhash64("node"), F.lit(sharding.shards)).cast("int").alias("shard")), "labels")
    still = 0
    for turn in range(sharding.rounds):
        room = [q - n for q, n in zip(quota, _by_shard(labels, sharding))]
        # Every other round, shards without room are open to those who change places.
        open_ = [s for s in shards if turn % 2 or room[s] > 0]
        held = members.join(labels.select("node", "shard"), "node")
        counts = held.groupBy("group").agg(*[
            F.count_if(F.col("shard") == s).alias(f"n{s}") for s in shards])
        pulls = look_up(members, ["group"], counts, heavy).groupBy("node").agg(*[
            F.sum(f"n{s}").alias(f"n{s}") for s in shards])
        drawn = pulls.join(labels, "node")
        # All members of a group break ties alike, by a draw of the group.
        choices = F.array(*[
            F.when(F.lit(s in open_) | (F.col("shard") == s), F.struct(
                F.col(f"n{s}").alias("n"), F.xxhash64("lead", F.lit(s)).alias("draw"),
                F.lit(s).alias("to")))
            for s in shards])
        drawn = drawn.select("node", "lead", "heavy", "shard", F.array_max(choices)["to"].alias("to"))
        movers = written(drawn.filter("to <> shard"), "movers")
        flow = {(r["shard"], r["to"]): r["count"]
                for r in movers.groupBy("shard", "to").count().collect()}
        allowed = _allowed(flow, room)
        if sum(allowed.values()):
            ranked = numbered(movers, ["shard", "to"], _order(sum(flow.values()), sharding),
                              ["lead", "node"], "turn")
            limit = _lookup_by_pair(allowed, F.col("shard"), F.col("to"))
            gone = ranked.filter(F.col("turn") < limit).select("node", "to")
            labels = written(labels.join(gone, "node", "left").select(
                "node", "lead", "heavy", F.coalesce("to", "shard").alias("shard")), "labels")
            still = 0
        else:
            still += 1
            if still == 2:
                break
    return labels


def balanced_shards(nodes: DataFrame, members: DataFrame, sharding: Sharding = Sharding()) -> DataFrame:
    """(node, shard, slot) for all of ``nodes`` (node, unique and not NULL): sizes at most one apart, slots
    from 0 without gaps. ``members`` (node, group) says which nodes are linked; pairs given twice count
    once, groups of one link nothing, and nodes without links go wherever room is.
    """
    members = members.select("node", "group").distinct()
    several = members.groupBy("group").count().filter("count > 1").select("group")
    rows = members.count()
    linked = written(look_up(members, ["group"], several, heavy_keys(members, ["group"], rows)), "members")
    total = nodes.count()
    quota = quotas(total, sharding.shards)
    labels = propagated(linked, quota, sharding)

    ordered = written(numbered(labels, ["shard"], _order(total, sharding), ["lead", "node"], "slot"),
                      "linked_places")
    own = F.element_at(F.array(*[F.lit(q).cast("bigint") for q in quota]), F.col("shard") + 1)
    settled = ordered.filter(F.col("slot") < own).select("node", "shard", "slot")
    surplus = ordered.filter(F.col("slot") >= own).select("node")
    held = [min(n, q) for n, q in zip(_by_shard(labels, sharding), quota)]

    # Everyone else in one sequence that is laid over the gaps.
    alone = nodes.select("node").join(labels.select("node"), "node", "left_anti")
    waiting = alone.unionByName(surplus).withColumn("all", F.lit(0))
    bins = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(_bins(total, sharding)))
    waiting = numbered(waiting, ["all"], bins, ["node"], "turn")
    shard = slot = F.lit(None)
    begin = 0
    for s in range(sharding.shards):
        free = quota[s] - held[s]
        here = (F.col("turn") >= begin) & (F.col("turn") < begin + free)
        shard = F.when(here, F.lit(s)).otherwise(shard)
        slot = F.when(here, F.col("turn") - begin + held[s]).otherwise(slot)
        begin += free
    filled = waiting.select("node", shard.cast("int").alias("shard"), slot.cast("bigint").alias("slot"))
    return settled.select("node", "shard", F.col("slot").cast("bigint").alias("slot")).unionByName(filled)


def shard_documents(docs: DataFrame, sharding: Sharding = Sharding()) -> DataFrame:
    """Shards of ``docs`` (doc_id, text) in which equal texts are together: doc_id, size, text_crc32, law,
    shard, slot, grown_shard.

    ``size`` is the text's bytes in UTF-8 plus 1. The law is ``rows``: numbers of rows are at most one
    apart. A group of equal texts is cut only where it is larger than a shard or where the shards' exact
    sizes leave no other place. NULL text is an empty one, and empty texts are equal. Every row has a place,
    rows with the same or a NULL doc_id too. Texts of any length are read where they are; only digests
    travel. Other columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group"), F.monotonically_increasing_id().alias("node"))
    rows = written(rows, "rows")  # from here on the ids hold
    places = balanced_shards(rows.select("node"), rows.select("node", "group"), sharding)
    return rows.join(places, "node").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def cut_edges(members: DataFrame, places: DataFrame) -> DataFrame:
    """One row: how many members (node, group) are outside their group's largest part, and how many
    would be at least, were every group alone in shards of equal size."""
    each = members.distinct().join(places.select("node", "shard"), "node")
    parts = each.groupBy("group", "shard").count().groupBy("group").agg(
        F.sum("count").alias("n"), F.max("count").alias("most"))
    return parts.agg(F.coalesce(F.sum(F.col("n") - F.col("most")), F.lit(0)).alias("outside"),
                     F.count_if(F.col("most") < F.col("n")).alias("cut_groups"),
                     F.count("*").alias("groups"))
