"""Balanced shards by label propagation, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, table

#: Shards; rounds of propagation, which end before when nothing moves or no more edges are kept; bundles a group's rows in a shard are dealt to.
SHARDS, ROUNDS, BUNDLES = 40, 30, 16
#: What every row takes besides its text.
ROW_BYTES = 16


def _state(members: DataFrame) -> tuple[dict[int, int], int]:
    """Linked rows of each shard, and pairs of linked rows that are in one shard; a row a shard comes to the driver."""
    rows = members.groupBy("g", "s").agg(F.sum("n").alias("n")).groupBy("s").agg(F.sum("n").alias("n"), F.sum(F.expr("n * (n - 1) div 2").cast("decimal(38,0)")).alias("kept")).collect()
    return {r.s: r.n for r in rows}, int(sum(r.kept for r in rows))


def _let_in(flow: dict[tuple[int, int], int], load: dict[int, int], shards: int, capacity: int) -> list[float]:
    """The share of those who ask for a shard that it lets in: as many as it has room for and as leave it in turn."""
    into = [sum(n for (_, t), n in flow.items() if t == s) for s in range(shards)]
    share = [1.0] * shards
    for _ in range(50):
        leave = [0.0] * shards
        for (s, t), n in flow.items():
            leave[s] += n * share[t]
        share = [min(share[t], max(0.0, (capacity - load.get(t, 0) + leave[t]) / into[t])) if into[t] else 1.0 for t in range(shards)]
    return share


def propagate(members: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS, history: list | None = None) -> DataFrame:
    """(g, o, b, s): the shard s in which each bundle ends; history gets the number of cut edges before the first round and after each.

    members (g, o, b, s, n): n rows of group g that began in shard o and are in s; rows of a group are all linked with one another. In a round the bundles of a group ask for the shard
    where most of the group is (on ties the smallest) among those that let any in; a group larger than a shard has as many such targets as it fills, and a hash chooses
    among them. A bundle never moves to where fewer are. A shard lets in what its capacity leaves free and what leaves it: if more ask, a hash decides which bundles may come. Rows without
    links take no room, for they can be put anywhere afterwards. The sums of flows between shards come to the driver, shards^2 at most.
    """
    pairs = members.groupBy("g").agg(F.sum("n").alias("n")).agg(F.sum(F.expr("n * (n - 1) div 2").cast("decimal(38,0)"))).first()[0]
    load, kept = _state(members)
    history = [] if history is None else history
    history.append(int(pairs or 0) - kept)
    closed: set[int] = set()
    for k in range(rounds):
        spread = members.groupBy("g", "s").agg(F.sum("n").alias("m"))
        # at most an entry a shard
        seen = spread.groupBy("g").agg(F.sort_array(F.collect_list(F.struct((-F.col("m")).alias("m"), "s"))).alias("seen"), F.ceil(F.sum("m") / capacity).cast("int").alias("k"))
        open_ = (lambda x: ~x["s"].isin(sorted(closed))) if closed else (lambda x: F.lit(True))
        targets = seen.select("g", "seen", F.slice(F.filter("seen", open_), 1, F.col("k")).alias("targets"))
        at = F.pmod(F.xxhash64("g", "o", "b", "s", F.lit(k)), F.greatest(F.size("targets"), F.lit(1))).cast("int")
        asked = members.join(targets, "g").withColumn("t", F.when(~F.exists("targets", lambda x: x["s"] == F.col("s")), F.get("targets", at)))
        asked = asked.withColumn("here", F.get(F.filter("seen", lambda x: x["s"] == F.col("s")), F.lit(0))["m"])
        up = (F.col("t.m") < F.col("here")) | ((F.col("t.m") == F.col("here")) & (F.col("t.s") < F.col("s")))
        asked = checkpoint(asked.select("g", "o", "b", "s", "n", F.when(up, F.col("t.s")).alias("to")))
        flow = {(r.s, r.to): r.n for r in asked.filter("to is not null").groupBy("s", "to").agg(F.sum("n").alias("n")).collect()}
        if not flow:
            break
        share = _let_in(flow, load, shards, capacity)
        closed = {s for s in range(shards) if share[s] < 0.05}
        draw = F.pmod(F.xxhash64("g", "o", "b", "s", F.lit(k), F.lit(1)), F.lit(1 << 20)) / float(1 << 20)
        moved = asked.select("g", "o", "b", F.when(draw < F.get(F.array(*map(F.lit, share)), F.col("to")), F.col("to")).otherwise(F.col("s")).alias("s"), "n")
        load, now = _state(moved)
        if now <= kept:
            break
        members, kept = moved, now
        history.append(int(pairs) - kept)
    return members.select("g", "o", "b", "s")


def _levelled(count: list[int]) -> tuple[list[int], list[int], list[int], list[tuple[int, int, int]]]:
    """Of rows a shard: first ranks, what each keeps, rows over before it, and the gaps (first number, shard, first slot) that rows over fill in order."""
    n, m = sum(count), len(count)
    base, more = divmod(n, m)
    target = [base] * m
    for s in sorted(range(m), key=lambda s: (-count[s], s))[:more]:
        target[s] += 1
    first, over, gaps, total, surplus, filled = [], [], [], 0, 0, 0
    for s in range(m):
        first.append(total)
        over.append(surplus)
        total += count[s]
        surplus += max(0, count[s] - target[s])
        if count[s] < target[s]:
            gaps.append((filled, s, count[s]))
            filled += target[s] - count[s]
    return first, target, over, gaps or [(0, 0, 0)]


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, history: list | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row of docs (doc_id, text).

    The law is rows: row counts of shards are at most one apart, so grown_shard is null. Rows of equal texts are linked and find their shard by propagation; then shards
    are levelled: of one that has more than its share the last rows move, those without links first. Order by range within shards and the offsets of tasks give each row
    its rank, so no task holds a whole shard or group.
    A null text has 0 bytes and no links; rows without doc_id count as rows; repeated rows are rows of their own; an empty table gives no rows; other columns are ignored.
    """
    text = F.col("text")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size")
    base = docs.select("doc_id", size, F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"), F.when(text.isNotNull(), F.xxhash64("text")).alias("g"), F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(shards)).cast("int").alias("o"), F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(BUNDLES)).cast("int").alias("b"))
    base = checkpoint(base.withColumn("g", F.when(F.col("g").isNotNull(), F.xxhash64("g", "size", "text_crc32"))))
    counted = base.filter("g is not null").groupBy("g", "o", "b").agg(F.count("*").alias("n"))
    several = counted.groupBy("g").agg(F.sum("n").alias("all")).filter("all > 1").select("g")
    members = checkpoint(counted.join(several, "g", "left_semi").select("g", "o", "b", F.col("o").alias("s"), "n"))
    n = base.count()
    found = propagate(members, shards, max(1, n // shards), rounds, history)
    placed = base.join(found, ["g", "o", "b"], "left").select("doc_id", "size", "text_crc32", F.coalesce("s", "o").alias("s"), F.col("s").isNull().alias("free"), "g", F.xxhash64("doc_id", "g").alias("h"))
    order = ["s", "free", "g", "h", "doc_id"]
    placed = checkpoint(checkpoint(placed).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "size", "text_crc32", "s", F.monotonically_increasing_id().alias("place")))
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("c"))
    # one row a partition
    offsets = sizes.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("before"))
    counts = {r.s: r.n for r in placed.groupBy("s").agg(F.count("*").alias("n")).collect()}  # a row a shard
    first, target, over, gaps = _levelled([counts.get(s, 0) for s in range(shards)])
    longs = lambda values: F.array(*(F.lit(v).cast("long") for v in values))
    rank = placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("rank", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) - F.get(longs(first), F.col("s")))
    rank = rank.withColumn("extra", F.when(F.col("rank") >= F.get(longs(target), F.col("s")), F.get(longs(over), F.col("s")) + F.col("rank") - F.get(longs(target), F.col("s"))))
    rank = rank.withColumn("gap", F.when(F.col("extra").isNotNull(), F.size(F.filter(longs([g[0] for g in gaps]), lambda x: x <= F.col("extra"))) - 1))
    shard = F.coalesce(F.get(longs([g[1] for g in gaps]), F.col("gap")), F.col("s"))
    slot = F.coalesce(F.get(longs([g[2] - g[0] for g in gaps]), F.col("gap")) + F.col("extra"), F.col("rank"))
    return rank.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents").select("doc_id", "text"))
