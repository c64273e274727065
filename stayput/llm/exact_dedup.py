"""Exact deduplication: group by a 128-bit content hash, compare bytes inside groups, keep one stable row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayput.llm.common import SPACES, UID, join_checked, staged, text_or_empty, unwrapped, with_uid, wrapped


def normalised(text: str = "text") -> Column:
    """The text without space, tab, line feed, vertical tab, form feed and carriage return; null is empty."""
    return F.regexp_replace(text_or_empty(text), f"[{SPACES}]+", "")


def content_hash(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", hash_of=content_hash) -> DataFrame:
    """One row per row of ``docs``: its row number, id, text digest, group size, the id that stays, and whether it stays.

    Texts are equal when equal after white space is deleted; null counts as empty. Of equal texts the
    row with the most code points stays, then the smallest id (null ids last), then the first row.
    Repeated rows are members like any other: exactly one row of a group stays. An empty table gives no rows.
    Other columns are not read, so their names cannot clash.

    Only the hash groups with several members read their texts again. Equal minimum and maximum
    bytes prove a group to be one text; where a hash collides, the text itself joins the key.
    """
    norm = normalised(text)
    rows = staged(
        with_uid(docs).select(UID, F.col(id_col).alias("id"), F.col(text).alias("_t")).select(
            UID, "id", F.length(text_or_empty("_t")).alias("points"), normalised("_t").alias("_n")).select(
            UID, "id", "points", hash_of(F.col("_n")).alias("h"), F.sha2(F.col("_n"), 256).alias("sha")),
        "digests")
    order = F.struct(-F.col("points"), F.col("id").isNull(), F.col("id"), F.col(UID))
    several = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    several = staged(several, "groups")
    members = join_checked(with_uid(docs).select(UID, norm.alias("norm")).withColumn("h", hash_of(F.col("norm"))),
                           several, "h", "left_semi")
    collided = staged(members.groupBy("h").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
                      .where("low != high").select("h"), "collided")
    keyed = rows.withColumn("k", F.lit(None).cast("string"))
    if not collided.isEmpty():
        apart = join_checked(members, collided, "h", "left_semi").select(UID, F.col("norm").alias("k"))
        keyed = rows.join(apart, UID, "left")
    kept = join_checked(keyed, several, "h", "left_semi").groupBy("h", "k").agg(
        F.count(F.lit(1)).alias("size"), F.min(order).alias("first")) \
        .select("h", F.col("k").alias("k2"), "size", F.col("first.id").alias("keep"), F.col(f"first.{UID}").alias("keep_uid"))
    kept = staged(kept, "kept")
    of = keyed.withColumn("k2", F.col("k")).drop("k")
    if kept.limit(200_001).count() <= 200_000:
        kept = F.broadcast(kept)
    out = of.alias("a").join(kept.alias("b"), (F.col("a.h") == F.col("b.h")) & F.col("a.k2").eqNullSafe(F.col("b.k2")), "left")
    alone = F.col("b.size").isNull()
    return out.select(
        F.col(f"a.{UID}"), F.col("a.id").alias("id"),
        F.when(alone, F.col("a.id")).otherwise(F.col("b.keep")).alias("keep_id"),
        F.coalesce(F.col("b.size"), F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("b.keep_uid") == F.col(f"a.{UID}"))).alias("kept"),
        F.col("a.sha").alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` (a stored table) with only the row of each group that stays; all columns, rows unchanged."""
    groups = exact_groups(docs, id_col, text)
    dropped = staged(groups.where(~F.col("kept")).select(UID), "dropped")
    return unwrapped(join_checked(wrapped(docs), dropped, UID, "left_anti"), docs.columns)


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    return exact_groups(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS place,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""
