"""Conversation prefix trie: whole sequences collapse first, then the weighted prefixes of distinct sequences are counted.

A node is a distinct sequence of first turns. No turn is compared with another and no level is walked: a prefix has a key of 128 bits,
the exclusive or of hashes of (place, turn), so it grows by one running aggregate and two conversations share a node if they share its key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayput.llm.common import join_checked, mapped, staged

#: A conversation's rebuilt turns begin with those of the conversation whose id is the next lower multiple of BASE; at most HEADS - 1 of them.
BASE, HEADS = 100, 6
#: Turns in one range of the sorted rows, about; bytes of a piece of an end list.
RANGE_ROWS, PIECE = 200_000, 1 << 20
#: Nodes with more children than this, and than a hundred-thousandth of all nodes, hand their id down by a broadcast of at most 100,000 rows.
MANY_CHILDREN = 1000
KEY = ["d", "k1", "k2"]
EMPTY = hashlib.sha256(b"").hexdigest()


def _parts(df: DataFrame, rows: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // RANGE_ROWS + 1)


def head_turns(conv_id):
    """Turns that a conversation takes over: the CRC-32 of its decimal id modulo HEADS."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(c, kind, i, turn, role, digest, cp): in this order, a row without a turn for each conversation (kind 0, i 0), its base's first turns
    (kind 0, i from 1) and all its own turns (kind 1), of which the first ``head_turns`` are still to be skipped.

    Turns stand by number, null first; equal numbers by role, then by digest, and repeated rows are turns of their own. A null role or
    text is empty. Rows without a conv_id belong to no conversation and are left out. Other columns are not read.
    """
    c, role, text = F.col("conv_id").cast("long"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = conversations.where(F.col("conv_id").isNotNull()).select(
        c.alias("c"), F.lit(1).alias("kind"), F.lit(0).alias("i"), F.col("turn").alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"), F.length(text).cast("long").alias("cp"))
    own = staged(own, "turns")
    at = F.row_number().over(Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "role", "digest"))
    heads = own.where(F.col("c") % BASE == 0).withColumn("i", at).where(F.col("i") < HEADS) \
        .select(F.col("c").alias("base"), "i", "digest", "cp")
    convs = own.select("c").distinct().withColumn("base", F.col("c") - F.col("c") % BASE)
    taken = join_checked(convs, heads, "base").where(F.col("i") <= head_turns(F.col("c")))
    kind, no_turn, no_role = F.lit(0).alias("kind"), F.lit(None).cast(own.schema["turn"].dataType).alias("turn"), F.lit("").alias("role")
    return own.unionByName(taken.select("c", kind, "i", no_turn, no_role, "digest", "cp")).unionByName(
        convs.select("c", kind, F.lit(0).alias("i"), no_turn, no_role, F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("cp")))


def _carried(rows: DataFrame, ends: DataFrame, sums: dict) -> DataFrame:
    """(c, part, one column each): for conversations that lie in several ranges, the aggregates of their earlier ranges.

    At most two conversations of a range go beyond it, so the result has at most twice as many rows as there are ranges.
    """
    some = rows.join(F.broadcast(ends), "c").groupBy("c", "part").agg(*[f.alias(name) for name, (f, _) in sums.items()])
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return some.select("c", "part", *[F.coalesce(again(F.col(name)).over(before), F.lit(0)).alias(f"{name}0") for name, (_, again) in sums.items()])


def prefixes(conversations: DataFrame) -> DataFrame:
    """(part, c, d, k1, k2, p1, p2, cp, until): each prefix of each rebuilt conversation, its key and its parent's, code points of the last turn and of all.

    Rows are range-sorted, so a conversation of any length is spread over as many ranges as it fills; running aggregates are taken in each range
    (``part``) and what earlier ranges hold is added from a table of at most two rows a range.
    """
    spread = staged(rebuilt(conversations), "rebuilt")
    order = ["kind", "i", F.col("turn").asc_nulls_first(), "role", "digest"]
    ranged = staged(spread.repartitionByRange(_parts(spread, spread.count()), "c", *order)
                    .withColumn("part", F.spark_partition_id()), "ranged")
    # the first and last conversation of each range are few and known by two aggregates
    ends = ranged.groupBy("part").agg(F.min("c").alias("low"), F.max("c").alias("high")) \
        .select(F.explode(F.array_distinct(F.array("low", "high"))).alias("c")).groupBy("c").count().where("count > 1").select("c")
    w = Window.partitionBy("part", "c").orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken, own = (F.col("kind") == 0) & (F.col("i") > 0), F.col("kind") == 1
    count = {"taken": (F.sum(taken.cast("long")), F.sum), "own": (F.sum(own.cast("long")), F.sum)}
    placed = ranged.select("*", F.sum(taken.cast("long")).over(run).alias("taken"), F.sum(own.cast("long")).over(run).alias("own")) \
        .join(F.broadcast(_carried(ranged, ends, count)), ["c", "part"], "left")
    own_before = F.col("own") + F.coalesce("own0", F.lit(0)) - head_turns(F.col("c"))
    placed = placed.where((F.col("kind") == 0) | (own_before > 0)) \
        .withColumn("d", F.col("taken") + F.coalesce("taken0", F.lit(0)) + F.greatest(own_before, F.lit(0)))
    mark = [F.when(F.col("d") == 0, F.lit(0)).otherwise(F.xxhash64("d", "digest", F.lit(side))).cast("long") for side in (1, 2)]
    hashed = placed.withColumns({"z1": mark[0], "z2": mark[1]})
    local = staged(hashed.select("part", "c", "d", "z1", "z2", "cp", *[f(x).over(run).alias(f"{x}_run")
                                                                       for f, x in ((F.bit_xor, "z1"), (F.bit_xor, "z2"), (F.sum, "cp"))]), "prefixes")
    more = {"z1": (F.bit_xor("z1"), F.bit_xor), "z2": (F.bit_xor("z2"), F.bit_xor), "cp": (F.sum("cp"), F.sum)}
    carry = staged(_carried(local, ends, more), "carried")
    full = local.join(F.broadcast(carry), ["c", "part"], "left")
    k1, k2 = (F.col(f"{z}_run").bitwiseXOR(F.coalesce(f"{z}0", F.lit(0))) for z in ("z1", "z2"))
    return full.select("part", "c", "d", k1.alias("k1"), k2.alias("k2"), k1.bitwiseXOR(F.col("z1")).alias("p1"), k2.bitwiseXOR(F.col("z2")).alias("p2"),
                       "cp", (F.col("cp_run") + F.coalesce("cp0", F.lit(0))).alias("until"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(d, k1, k2, sha): SHA-256 of the ascending, comma-joined ids ``c`` that end in each node.

    Lists are never held: the sorted ids are joined into pieces of at most PIECE bytes where they lie, and a node's pieces pass through one hash.
    """
    count = ends.count()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, held, size = None, None, [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (*key, first)] + [pa.array([",".join(held).encode()], pa.binary())],
                                              [*KEY, "first", "piece"])

        for batch in batches:
            for *now, c in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now != key or size > PIECE:
                    if key is not None:
                        yield flush()
                    key, first, held, size = now, c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
        if key is not None:
            yield flush()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None

        def flush(done):
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x, _ in done], pa.int64()) for i in range(3)] + [pa.array([s for _, s in done], pa.string())], [*KEY, "sha"])

        for batch in batches:
            done = []
            for *now, piece in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if now != key:
                    if key is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = now, hashlib.sha256(piece)
                else:
                    sha.update(b"," + piece)
            if done:
                yield flush(done)
        if key is not None:
            yield flush([(key, sha.hexdigest())])

    dealt = ends.select(*KEY, "c").repartitionByRange(_parts(ends, count), *KEY, "c").sortWithinPartitions(*KEY, "c")
    cut = mapped(dealt, pieces, "d long, k1 long, k2 long, first long, piece binary").repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return mapped(cut, digests, "d long, k1 long, k2 long, sha string")


def sequences(all_prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ends, distinct): (d, k1, k2, c, total) of each whole conversation, and (d, k1, k2, c, weight) of each distinct sequence,
    where c is the least conversation and weight the number of conversations that are this sequence."""
    last = F.max(F.struct("d", "k1", "k2", F.col("until").alias("total")))
    ends = all_prefixes.groupBy("c").agg(last.alias("e")).select("c", "e.*")
    return ends, ends.groupBy(*KEY).agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("weight"), F.min("total").alias("total"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: d, k1, k2 (its key), p1, p2 (its parent's, at d - 1), conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved, sha.

    An empty table has no nodes; a conversation without turns is a member of the root alone. See ``rebuilt`` for nulls, ties and repeated rows.

    1. Identical conversations become one weighted sequence, stood for by its least conversation; only these go on.
    2. A sequence whose key is among the proper prefixes is no leaf (anti-join).
    3. Prefixes are aggregated by key, before the shuffle too, so a first turn that all share is a few rows. The code points of a
       subtree's nodes are counted once each: a node belongs to its least sequence, whose own nodes are the end of its path,
       so below any node a sequence adds the code points of the part of its path that it owns.
    4. A node's id reaches its children by a join on the parent's key; nodes with very many children use a broadcast of bounded size.
    """
    rows = prefixes(conversations)
    places = staged(rows.groupBy("c", "part").agg(F.max(F.struct("d", "k1", "k2", "until")).alias("e")).select("c", "part", "e.*"), "places")
    ends, distinct = sequences(places)
    ends, distinct = staged(ends, "ends"), staged(distinct, "sequences")
    # one row per range that a sequence lies in, so that a long conversation is no hot key of the join
    spread = join_checked(places.select("c", "part"), distinct.select("c", "weight", "total", F.col("d").alias("last")), "c")
    path = rows.join(spread, ["c", "part"]).withColumn("below", F.col("total") - F.col("until") + F.col("cp"))
    path = staged(path.select("part", "c", *KEY, "p1", "p2", "weight", "below", "last"), "paths")
    inner = path.where("d < last").select(*KEY).distinct()
    leaves = distinct.join(inner, KEY, "left_anti").select("c", F.lit(1).alias("leaf"))
    nodes = staged(path.groupBy(*KEY).agg(F.min(F.struct("c", "below", "p1", "p2")).alias("least")).select(*KEY, "least.*"), "owners")
    owned = nodes.groupBy("c").agg(F.min(F.struct("d", "below")).alias("own")).select("c", F.col("own.d").alias("from"), F.col("own.below").alias("whole"))
    # the least conversation of every sequence owns its last node, unless that is a node of a lesser one
    owned = staged(distinct.select("c").join(owned, "c", "left").join(leaves, "c", "left"), "owned")
    shares = path.join(join_checked(places.select("c", "part"), owned, "c"), ["c", "part"])
    adds = F.when(F.col("d") >= F.col("from"), F.col("below")).otherwise(F.coalesce("whole", F.lit(0)))
    zero = F.lit(0).cast("long")
    counted = shares.groupBy(*KEY).agg(
        F.min("c").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.sum("weight").alias("n_convs"),
        F.coalesce(F.sum("leaf"), zero).cast("long").alias("n_leaves"), F.sum(F.col("weight") * F.col("below") - adds).alias("saved"))
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    made = counted.join(children, KEY, "left").join(end_digests(ends), KEY, "left") \
        .select("*").withColumns({"n_children": F.coalesce("n_children", zero), "sha": F.coalesce("sha", F.lit(EMPTY))})
    made = staged(made, "nodes")
    many = max(MANY_CHILDREN, made.count() // 100_000)
    parents = made.where("n_children > 0").select((F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                                                  F.col("conv_id").alias("parent_conv_id"), "n_children")
    few, crowded = (parents.where(f"n_children {x} {many}").drop("n_children") for x in ("<=", ">"))
    up = ["d", "p1", "p2"]
    rest = made.where("d > 0").join(F.broadcast(crowded.select(*up)), up, "left_anti").join(few, up)
    below = made.where("d > 0").join(F.broadcast(crowded), up)
    root = made.where("d = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return root.unionByName(rest).unionByName(below)


def op13_conversation_trie(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    return prefix_trie(read(spark, sf_dir, "conversations")).select(
        "conv_id", F.col("d").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))


OP13_SQL = r"""
WITH k AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS tab),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(list_concat([4294967295],
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: ascii(s))),
    lambda x, b: xor(x >> 8, tab[(xor(x, b) & 255) + 1])), 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM t), k),
r AS (SELECT c.conv_id, 0 AS kind, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
    UNION ALL SELECT c.conv_id, 1 AS kind, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
s AS (SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.kind, r.i) FILTER (WHERE r.kind IS NOT NULL), []) AS seq
    FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM s),
n AS (SELECT seq[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(seq) = depth) AS ends FROM p GROUP BY ALL),
u AS (SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(u.n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(prefix[depth].text) END AS saved
    FROM n LEFT JOIN u USING (prefix, depth)),
a AS (SELECT prefix, depth, n_children, saved, unnest(range(0, depth + 1)) AS above FROM v),
b AS (SELECT prefix[1:above] AS prefix, above AS depth, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves,
    CAST(sum(saved) AS BIGINT) AS saved_tokens FROM a GROUP BY ALL)
SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, b.n_leaves, b.saved_tokens,
    sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN b USING (prefix, depth) LEFT JOIN n q ON v.depth > 0 AND q.depth = v.depth - 1 AND q.prefix = v.prefix[1:v.depth - 1]
"""
