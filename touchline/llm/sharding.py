"""Sharding by balanced label propagation (operator 5). DataFrame functions only.

Nodes are linked through hubs (all members of a hub are neighbours), so no pair
is ever written out. A round counts the members of each hub by shard; the
shards that hold most of a hub, as many as its size needs, are where its other
members want to go. Every shard has a quota, equal up to one row. The nodes
that want a shard are ranked, linked ones first and hub by hub; those within
the quota get it, the others fill the places left. Sizes are therefore even
after every round, and few hubs are cut by a quota. Rounds end when no linked
node wants to move, or after ``rounds``.

Ranks come from a range partitioning by (shard, priority, hub, node hash), the
place within a partition and the counts of the partitions before, so a hub with
a third of all nodes is spread over many tasks. Each round is written to the
shared folder.

Cases: null text has size 8, counts as empty and is equal to other empty texts;
repeated rows and null ids are nodes of their own; fewer rows than shards leave
shards empty; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import clean_text, stored, table

PLACE_BITS = 33   # of monotonically_increasing_id: place within the partition


def _pick(values: list[int], at: Column) -> Column:
    """Element of a short list of numbers (one per shard)."""
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), at)


def _ranked(nodes: DataFrame, order: list[str], parts: int) -> DataFrame:
    """``nodes`` with ``rank``: the place in the given order, from 0."""
    placed = stored(nodes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("__place__", F.monotonically_increasing_id()))
    part = F.shiftright("__place__", PLACE_BITS)
    before, starts = 0, []
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):    # one row per partition
        starts.append((r["part"], before))
        before += r["count"]
    spark = nodes.sparkSession
    offsets = spark.createDataFrame(starts, "part long, before long")
    return (placed.withColumn("part", part).join(F.broadcast(offsets), "part")
            .withColumn("rank", F.col("before") + F.col("__place__").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
            .drop("part", "before", "__place__"))


def propagate(nodes: DataFrame, links: DataFrame, shards: int, rounds: int = 4) -> DataFrame:
    """Shards of ``nodes`` (node long, unique) linked by ``links`` (node, hub):
    node, shard, slot (the place in its shard, from 0). Sizes differ by one
    node at most."""
    total = nodes.count()
    if not total:
        return nodes.select("node", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    room = max(quota)
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // 1_000_000)
    linked = stored(links.join(links.groupBy("hub").count().filter("count > 1").select("hub"), "hub").select("node", "hub"))
    state = nodes.select("node", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"))
    for _ in range(rounds):
        here = linked.join(state, "node")
        most = (here.groupBy("hub", "shard").count()
                .groupBy("hub").agg(F.sum("count").alias("size"), F.sort_array(F.collect_list(
                    F.struct("count", F.xxhash64("hub", "shard").alias("tie"), "shard")), asc=False).alias("held"))
                .select("hub", "size", F.transform("held", lambda x: x["shard"]).alias("held"),
                        F.ceil(F.col("size") / room).cast("int").alias("need")))
        good = F.slice("held", 1, F.col("need"))
        away = F.get(good, F.pmod(F.xxhash64("node", "hub"), F.least("need", F.size("held")).cast("long")).cast("int"))
        wish = F.when(F.array_contains(good, F.col("shard")), F.col("shard")).otherwise(away)
        wants = (here.join(most, "hub").select("node", F.struct("size", F.xxhash64("hub").alias("hub"), wish.alias("shard")).alias("w"))
                 .groupBy("node").agg(F.max("w").alias("w")))
        wishes = state.join(wants, "node", "left").select(
            "node", F.col("shard").alias("was"), F.coalesce("w.shard", "shard").alias("want"),
            F.col("w").isNull().cast("int").alias("single"), F.coalesce("w.hub", F.lit(0)).alias("hub"),
            F.xxhash64("node", F.lit(1)).alias("h"))
        ranked = _ranked(wishes, ["want", "single", "hub", "h", "node"], parts)
        asked = [0] * shards
        moves = 0
        for r in ranked.groupBy("want").agg(F.count(F.lit(1)).alias("n"), F.sum(
                ((F.col("want") != F.col("was")) & (F.col("single") == 0)).cast("long")).alias("moves")).collect():
            asked[r["want"]], moves = r["n"], moves + r["moves"]
        first, over_first, free_first, held = [], [], [], []
        a = b = c = 0
        for s in range(shards):
            held.append(min(asked[s], quota[s]))
            first.append(a)
            over_first.append(b)
            c += quota[s] - held[s]
            free_first.append(c)     # places left in the shards up to this one
            a, b = a + asked[s], b + asked[s] - held[s]
        own = F.col("rank") - _pick(first, F.col("want"))
        fits = own < _pick(quota, F.col("want"))
        extra = _pick(over_first, F.col("want")) + own - _pick(quota, F.col("want"))
        filled = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in free_first]), lambda x: x <= F.col("extra")))
        state = (ranked.withColumn("fits", fits).withColumn("own", own).withColumn("extra", extra)
                 .withColumn("shard", F.when(F.col("fits"), F.col("want")).otherwise(filled).cast("int"))
                 .withColumn("slot", F.when(F.col("fits"), F.col("own")).otherwise(
                     _pick(held, F.col("shard")) + F.col("extra") - _pick([0, *free_first[:-1]], F.col("shard"))))
                 .select("node", "shard", "slot"))
        if not moves:
            break
    return state


def cut_links(state: DataFrame, links: DataFrame) -> DataFrame:
    """Per hub: its size and the members outside the shard that holds most."""
    return (links.join(state.select("node", "shard"), "node").groupBy("hub", "shard").count()
            .groupBy("hub").agg(F.sum("count").alias("size"), (F.sum("count") - F.max("count")).alias("outside")))


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in 24 shards by law ``rows``; equal texts are linked:
    doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = clean_text("text").cast("binary")
    nodes = stored(table(spark, sf_dir, "documents").select(
        F.monotonically_increasing_id().alias("node"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("hub")))
    placed = propagate(nodes.select("node"), nodes.select("node", "hub"), 24)
    return nodes.join(placed, "node").select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                             F.lit(None).cast("int").alias("grown_shard"))
