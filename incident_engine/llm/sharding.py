"""Shards of even size that keep linked documents together: balanced label propagation.

Documents with equal texts are linked, through a node for their text, so a group of any size costs
one link per document. Groups of more than 1 / ``PLANNED`` of a shard, a bounded number, are planned
first, largest first: whole in the fullest shard that takes them, or else in as few shards as have
room. Then every round each document of another group looks at how many members of its group each
shard with room holds and asks to move to the one that holds most, or, if none of these holds any, to
one with room. Requests are counted per pair of shards; a shard accepts as many groups as its quota
leaves room for, chosen by hash, so a round is two counts and two joins. A refused group wishes again
among the shards that then have room, until no move is accepted. Then the law ``rows`` is made exact:
each shard keeps documents up to its quota, linked ones first, and what is over goes to the shards
with room. Quotas differ by one at most.

Ranks within shards are taken in buckets of bounded size, whose counts are then added up, so no task
sorts a whole shard. Only built-in functions are used. Null texts count as empty texts; rows that
agree in all values share a shard as far as quotas allow and get slots of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, narrow, prefix_sums

#: Shards, and rounds after which moves end even if some are still accepted.
SHARDS, ROUNDS = 8, 30
#: Groups of more than this part of a shard are planned one by one, at most SHARDS * PLANNED.
PLANNED = 64
#: Rows of a bucket in which ranks are taken.
BUCKET_ROWS = 20_000
#: What linked documents may fill of a shard during the rounds, against an even share.
SLACK = 0.98
#: Range of the hashes that choose groups by shares.
DRAWS = 1 << 30


def _with_rank(rows: DataFrame, buckets: int, order: list[str]) -> DataFrame:
    """Adds ``rank`` within ``shard``: by ``late`` (0 before 1), then bucket, then ``order``."""
    slot = F.col("shard").cast("long") * 2 * buckets + F.col("late") * buckets + F.col("bucket")
    rows = rows.withColumn("__slot", slot)
    counts = rows.groupBy("__slot").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(prefix_sums(counts, "__slot", "n", "ahead"), "shard-counts")
    first = counts.groupBy(F.floor(F.col("__slot") / (2 * buckets)).alias("shard")).agg(
        F.min("ahead").alias("base"))
    ahead = counts.withColumn("shard", F.floor(F.col("__slot") / (2 * buckets))).join(
        F.broadcast(first), "shard").select("__slot", (F.col("ahead") - F.col("base")).alias("ahead"))
    place = F.row_number().over(Window.partitionBy("__slot").orderBy(*order)) - 1
    return rows.withColumn("__place", place).join(ahead, "__slot").withColumn(
        "rank", F.col("ahead") + F.col("__place")).drop("__slot", "__place", "ahead")


def _plan(sizes: list[tuple[str, int]], most: int, quota: int, shards: int
          ) -> list[tuple[str, int, int, int]]:
    """Places (group, low, high, shard) of large groups; low and high are ranks of its rows."""
    room, out = dict.fromkeys(range(shards), most), []
    for group, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        left = size
        while left:
            if not any(room.values()):  # more linked rows than the rounds may fill
                room = dict.fromkeys(room, max(quota - most, left))
            fits = [(r, s) for s, r in room.items() if r >= left]
            to = min(fits)[1] if fits else max(room, key=lambda s: (room[s], -s))
            n = min(left, room[to])
            low, left = size - left, left - n
            room[to] -= n
            out.append((group, low, low + n, to))
    return out


def _round(linked: DataFrame, totals: dict[int, int], rows: int, shards: int, number: int):
    """One round over the documents of groups that are not planned; returns them with their new
    shards, and whether a move was accepted."""
    even, most = rows / shards, int(SLACK * rows / shards) + 1
    free = [s for s in range(shards) if totals[s] < even] or list(range(shards))
    held = linked.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
    # the shard with room that holds most; of equals the one the group's hash names first
    liking = F.pmod(F.xxhash64("group", "shard"), F.lit(DRAWS))
    open_ = F.col("shard").isin(free)
    wish = held.groupBy("group").agg(
        F.max(F.when(open_, F.struct("n", liking.alias("l"), "shard"))).alias("w"),
        F.count(F.lit(1)).alias("parts"), F.max("shard").alias("only"))
    pick = F.element_at(F.array(*[F.lit(s) for s in free]),
                        (F.pmod(F.xxhash64("group", F.lit(number)), F.lit(len(free))) + 1).cast("int"))
    # a group that is whole stays, unless its shard is over its share
    over = F.col("only").isin([s for s in range(shards) if totals[s] > even])
    wish = materialize(wish.select("group", F.when(
        (F.col("parts") == 1) & ~over, F.col("only")).otherwise(
        F.coalesce("w.shard", pick)).alias("to")), "shard-wish")
    asked = materialize(linked.join(wish, "group"), "shard-asked")
    moves = {(r["shard"], r["to"]): r["count"] for r in
             asked.filter("shard != to").groupBy("shard", "to").count().collect()}  # shards squared
    leaving = {s: sum(n for (a, _), n in moves.items() if a == s) for s in range(shards)}
    share = {}
    for to in range(shards):
        wanted = sum(n for (_, b), n in moves.items() if b == to)
        # half of those who want to leave are counted on, as their own wish may fail
        room = max(0, most - totals[to] + leaving[to] // 2)
        share[to] = min(1.0, room / wanted) if wanted else 0.0
    # a group is accepted or refused as a whole
    draw = F.pmod(F.xxhash64("group", F.lit(number)), F.lit(DRAWS)) / float(DRAWS)
    accept = F.lit(False)
    for to, part in share.items():
        accept = accept | ((F.col("to") == to) & (draw < part))
    after = materialize(asked.select(
        "row", "group", F.when(accept, F.col("to")).otherwise(F.col("shard")).alias("shard"),
        (accept & (F.col("shard") != F.col("to"))).alias("moved")), "shard-round")
    return after.select("row", "group", "shard"), not after.filter("moved").isEmpty()


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    base = narrow(docs, id_col, text_col).select(
        "doc_id", F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")).alias("bytes"),
        F.coalesce("text", F.lit("")).alias("text"))
    base = materialize(base.select(
        "doc_id", (F.col("bytes") + 1).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.md5(F.col("text").cast("binary")).alias("group"),
        F.monotonically_increasing_id().alias("row")), "shard-base")
    rows = base.count()
    groups = materialize(base.groupBy("group").agg(F.count(F.lit(1)).alias("members")).filter(
        "members > 1"), "shard-groups")
    most, quota_ = int(SLACK * rows / shards) + 1, -(-rows // shards)
    large = F.col("members") > most // PLANNED
    plan = _plan([tuple(r) for r in groups.filter(large).collect()], most, quota_, shards)
    plan = docs.sparkSession.createDataFrame(plan, "group string, low long, high long, shard int")
    start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    # ranks within a planned group are taken in the partitions that numbered the rows
    named = base.select("row", "group", F.shiftright("row", 33).alias("part")).join(
        F.broadcast(plan.select("group").distinct()), "group")
    ahead = named.groupBy("group", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "group", "part", F.coalesce(F.sum("n").over(Window.partitionBy("group").orderBy("part")
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    place = F.row_number().over(Window.partitionBy("group", "part").orderBy("row")) - 1
    planned = named.withColumn("place", place).join(ahead, ["group", "part"]).join(
        F.broadcast(plan), "group").filter(
        (F.col("place") + F.col("ahead") >= F.col("low"))
        & (F.col("place") + F.col("ahead") < F.col("high")))
    planned = materialize(planned.select("row", "group", "shard"), "shard-planned")
    fixed = {r["shard"]: r["count"] for r in planned.groupBy("shard").count().collect()}
    labelled = base.select("row", "group", start.alias("shard"))
    linked = materialize(labelled.join(groups.filter(~large).select("group"), "group", "left_semi"),
                         "shard-linked")
    for number in range(rounds):
        totals = {s: fixed.get(s, 0) for s in range(shards)}
        for r in linked.groupBy("shard").count().collect():
            totals[r["shard"]] += r["count"]
        linked, moved = _round(linked, totals, rows, shards, number)
        if not moved:
            break
    linked = linked.select("row", "group", "shard").unionByName(planned)

    placed = base.join(linked.select("row", F.col("shard").alias("found")), "row", "left").select(
        *base.columns, F.coalesce("found", start).alias("shard"),
        F.col("found").isNull().cast("int").alias("late"))
    buckets = max(1, rows // (shards * BUCKET_ROWS))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))
    # a large group has buckets of its own rows too
    placed = placed.withColumn("bucket", F.when(F.col("late") == 0, F.pmod(
        F.xxhash64("row"), F.lit(buckets))).otherwise(F.col("bucket")))
    ranked = materialize(_with_rank(placed, buckets, ["group", "row"]), "shard-ranked")
    counts = {r["shard"]: r["count"] for r in ranked.groupBy("shard").count().collect()}
    quota = {s: rows // shards + (s < rows % shards) for s in range(shards)}
    cap = F.element_at(F.create_map(*[F.lit(x) for s, q in quota.items() for x in (s, q)]),
                       F.col("shard"))
    over_of, rooms, at, ahead = {}, [], 0, 0
    for s in range(shards):
        over_of[s] = ahead
        ahead += max(0, counts.get(s, 0) - quota[s])
        if (room := quota[s] - counts.get(s, 0)) > 0:
            rooms.append((s, at, at + room, counts.get(s, 0)))
            at += room
    # a row over the quota has a number among all those; numbers fill the rooms in order
    before = F.element_at(F.create_map(*[F.lit(x) for s, n in over_of.items() for x in (s, n)]),
                          F.col("shard"))
    number = F.col("rank") - cap + before
    to, slot = F.col("shard"), F.col("rank")
    for s, low, high, taken in rooms:
        inside = (F.col("rank") >= cap) & (number >= low) & (number < high)
        to = F.when(inside, F.lit(s)).otherwise(to)
        slot = F.when(inside, number - low + taken).otherwise(slot)
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                         to.cast("int").alias("shard"), slot.cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
