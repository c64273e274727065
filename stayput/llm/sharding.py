"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayput.llm.common import UID, join_checked, staged, text_or_empty, with_uid

#: Places on the ring, and virtual nodes of a shard; both fix the size of the ring table, whatever the data.
CELLS = 1 << 14
NODES = 96
#: Order buckets of a shard's keys; only the bucket in which a shard fills up is put in order.
BUCKETS = 256


def ring(spark, shards: int, open_shards: list[int], seed: int = 11) -> DataFrame:
    """(cell, shard): the first virtual node of an open shard at or clockwise after each cell. CELLS rows."""
    nodes = spark.range(shards * NODES).select(
        (F.col("id") / NODES).cast("int").alias("shard"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(CELLS)).cast("int").alias("cell"))
    nodes = nodes.where(F.col("shard").isin(open_shards)).groupBy("cell").agg(F.min("shard").alias("shard"))
    cells = spark.range(2 * CELLS).select(F.col("id").cast("int").alias("at"), F.pmod("id", F.lit(CELLS)).cast("int").alias("cell"))
    clockwise = Window.orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.join(F.broadcast(nodes), "cell", "left") \
        .withColumn("shard", F.last("shard", ignorenulls=True).over(clockwise)).where(F.col("at") < CELLS).select("cell", "shard")


def assign(docs: DataFrame, shards: int = 24, slack: float = 0.001, seed: int = 11, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: _uid, id, size, text_crc32, shard.

    A key (id and text) goes to the shard of the first virtual node clockwise of its place. A shard takes
    keys, large ones first, until (1 + slack) times the mean size is reached; the keys that
    are over continue clockwise to the next shard with room. A document larger than any room goes, last, to
    the shard that the ring names once all may hold that document too. Null ids and texts are keys like others; repeated
    rows are told apart by row number only where a shard fills up; an empty table gives no rows.

    Every round reads only the keys without a shard. The sums per shard and order bucket are a table of fixed size,
    the driver gets one row per shard, and only the bucket in which a shard fills up is put in order.
    """
    spark = docs.sparkSession
    size = F.octet_length(text_or_empty("t")).cast("long") + 8
    rows = with_uid(docs).select(UID, F.col(id_col).alias("id"), F.col(text).alias("t"))
    rows = staged(rows.select(UID, "id", size.alias("size"), F.crc32(text_or_empty("t")).alias("text_crc32"),
                              F.xxhash64(F.lit(seed), "id", "t").alias("h"))
                  .withColumn("cell", F.pmod("h", F.lit(CELLS)).cast("int"))
                  # large sizes first: half powers of two, then the hash
                  .withColumn("rank", (F.lit(120) - F.least(F.lit(119), F.floor(2 * F.log2(F.col("size"))))).cast("int"))
                  .withColumn("bucket", (F.col("rank") * BUCKETS + F.pmod(F.shiftright("h", 14), F.lit(BUCKETS))).cast("int")), "keys")
    whole = rows.agg(F.sum("size")).first()[0] or 0
    most = -(-whole * (1 + slack) // shards)
    room = {s: int(most) for s in range(shards)}
    left, done, open_shards = rows, [], list(range(shards))
    while True:
        here = left.join(F.broadcast(ring(spark, shards, open_shards, seed)), "cell")
        room_of = F.element_at(F.array(*[F.lit(room[s]).cast("long") for s in range(shards)]), F.col("shard") + 1)
        sums = here.groupBy("shard", "bucket").agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket"))
        over = sums.withColumn("upto", upto).where(F.col("upto") > room_of) \
            .groupBy("shard").agg(F.min(F.struct("bucket", "upto", "n")).alias("x")) \
            .select("shard", F.col("x.bucket").alias("edge"), (F.col("x.upto") - F.col("x.n")).alias("used"))
        over = {r.shard: (r.edge, r.used) for r in over.collect()}
        edges = F.element_at(F.array(*[F.lit(over[s][0] if s in over else 1 << 30) for s in range(shards)]), F.col("shard") + 1)
        used = F.element_at(F.array(*[F.lit(over[s][1] if s in over else 0).cast("long") for s in range(shards)]), F.col("shard") + 1)
        edge = here.where(F.col("bucket") == edges)
        upto = F.sum("size").over(Window.partitionBy("shard").orderBy("bucket", "h", F.col("id").asc_nulls_last(), UID)
                                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        fits = edge.withColumn("upto", upto + used).where(F.col("upto") <= room_of).select(UID).withColumn("fits", F.lit(True))
        placed = join_checked(here, staged(fits, "edge"), UID, "left")
        placed = staged(placed.withColumn("in", (F.col("bucket") < edges) | F.coalesce("fits", F.lit(False))).drop("fits"), "round")
        taken = {r.shard: r.n for r in placed.where("in").groupBy("shard").agg(F.sum("size").alias("n")).collect()}
        room = {s: room[s] - taken.get(s, 0) for s in range(shards)}
        done.append(placed.where("in").select(UID, "id", "size", "text_crc32", "h", "shard"))
        if not over:
            break
        left = placed.where(~F.col("in")).drop("shard", "in")
        open_shards = [s for s in open_shards if s not in over]
        if not open_shards:
            rest = left.agg(F.sum("size").alias("n"), F.max("size").alias("m")).first()
            room = {s: room[s] + rest.m + -(-rest.n // shards) for s in range(shards)}
            open_shards = list(range(shards))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def with_slots(assigned: DataFrame) -> DataFrame:
    """Add slot: 0, 1, 2, ... within each shard. Counts per hash bucket give each bucket's first slot, so no task orders a whole shard.

    Order is the key's hash, ties (equal id and text, or null ids) by row number, so repeated rows have slots of their own.
    """
    rows = assigned.withColumn("part", F.pmod(F.shiftright("h", 30), F.lit(16 * BUCKETS)).cast("int"))
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    first = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("first"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("h", UID)) - 1
    numbered = rows.withColumn("place", place)
    return join_checked(numbered, staged(first, "slots"), ["shard", "part"]) \
        .withColumn("slot", (F.col("first") + F.col("place")).cast("long")).drop("part", "first", "place")


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    out = with_slots(assign(read(spark, sf_dir, "documents")))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                      "slot", F.lit(None).cast("int").alias("grown_shard"))
