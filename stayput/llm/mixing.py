"""Mixing sources to target weights: capped water-filling and seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayput.llm.common import ROW, SPACES, UID, join_checked, staged, text_or_empty, wrapped

WEIGHTS = (5.0, 2.0, 1.0)
#: Hash buckets of a source; only the bucket in which the source's last repetition ends is put in order.
BUCKETS = 4096


def word_count(text: str = "text") -> Column:
    """Number of maximal runs of characters that are not white space; null and empty give 0."""
    led = F.regexp_replace(text_or_empty(text), f"^[{SPACES}]+", "")
    return F.length(F.regexp_replace(led, f"[^{SPACES}]+[{SPACES}]*", "x")).cast("long")


def source_table(rows: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight): sources by code point, null last, take the weights in turn.

    The running number of a source is its rank among the distinct sources, a table that holds one
    row per source; its window sees no other rows.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.pmod(place, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    return staged(sizes.withColumn("weight", weight), "sources")


def water_level(sources: DataFrame, share: float, most: float) -> float:
    """The level L at which the sum of min(most * size, L * weight) meets ``share`` of all sizes.

    A source above its cap stops there and its excess is reshared by weight: as the level only rises,
    the sources that stopped are those with cap / weight below it. Each round is one aggregation to
    one row; it ends when no further source stops, so after as many rounds as there are sources at most.
    """
    cap = F.col("source_size") * most
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        full = cap < F.lit(level) * F.col("weight")
        spent, free, n = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
                                     F.count(F.when(full, 1))).first()
        if n == stopped or not free:
            return level if free else float("inf")
        level, stopped = (share * whole - spent) / free, n


def keyed(docs: DataFrame, seed: int, id_col: str, text: str, source: str) -> DataFrame:
    """(_row, _uid, id, source, text, key, h, bucket): whole rows with the key of their source, their seeded hash and the hash's bucket."""
    rows = wrapped(docs).select(ROW, UID, F.col(ROW).getField(id_col).alias("id"), F.col(ROW).getField(source).cast("string").alias("source"),
                                F.col(ROW).getField(text).alias("text"))
    h = F.xxhash64(F.lit(seed), F.col("id"), F.col("text"))
    return rows.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-"))).withColumn("h", h) \
        .withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 7,
         id_col: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, sources, edge): the sizes of all rows; per source its target, whole repetitions and the bucket in which the rest ends;
    of the rows in that bucket, the words that one more repetition takes.

    A source of any size is cut into hash buckets: bucket sums find the bucket in which the target is
    reached, and only that bucket's rows are put in order.
    """
    rows = keyed(docs, seed, id_col, text, source)
    rows = staged(rows.select(UID, "id", "source", "key", "h", "bucket", word_count("text").alias("size")), "sizes")
    sources = source_table(rows, weights)
    level = water_level(sources, share, most)
    target = F.least(F.col("source_size") * float(most), F.lit(level) * F.col("weight"))
    sources = sources.withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(0.0)) \
        .withColumn("whole", F.coalesce(F.floor(F.col("target") / F.col("source_size")), F.lit(0)).cast("long")) \
        .withColumn("rest", F.round(F.col("target")).cast("long") - F.col("whole") * F.col("source_size"))
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-"))
    sources = sources.withColumn("key", key).drop("source", "weight")
    sums = rows.groupBy("key", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = F.sum("in_bucket").over(Window.partitionBy("key").orderBy("bucket")) - F.col("in_bucket")
    cut = staged(join_checked(sums.withColumn("before", before), sources.select("key", "rest"), "key")
                 .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("in_bucket")))
                 .select("key", F.col("bucket").alias("cut"), (F.col("rest") - F.col("before")).alias("left")), "cuts")
    sources = staged(join_checked(sources, cut, "key", "left"), "targets")
    order = Window.partitionBy("key").orderBy("h", F.col("id").asc_nulls_last(), UID)
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    edge = join_checked(rows, sources.select("key", "cut", "left"), "key").where("bucket = cut").withColumn("b", before)
    return rows, sources, staged(edge.where("b < left").select(UID, F.least("size", F.col("left") - F.col("b")).alias("edge")), "edge")


def decided(rows: DataFrame, sources: DataFrame, edge: DataFrame) -> DataFrame:
    """Add to rows with _uid, key, bucket and size their source's table and part: the words of one repetition more."""
    rows = join_checked(join_checked(rows, sources, "key"), edge, UID, "left")
    part = F.when(F.col("cut").isNull(), F.when(F.col("rest") > 0, F.col("size")).otherwise(0)) \
        .when(F.col("bucket") < F.col("cut"), F.col("size")).when(F.col("bucket") == F.col("cut"), F.coalesce("edge", F.lit(0))).otherwise(0)
    return rows.withColumn("part", part.cast("long"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 7,
        id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs`` (a stored table): _uid, id, size, source_size, target, whole (repetitions), part (words of one more), taken.

    Sizes are words of the whole text (null: 0). A source's target is its share of ``share`` times all sizes,
    at most ``most`` times its own size. Every document is repeated floor(target / source_size) times; the
    rest goes to its documents in the order of a seeded hash, whole, and to the last one in part, so a
    source's taken words miss its target by less than a word. Ties and repeated rows are ordered by id and row number.
    Null sources form one source. An empty table gives no rows. Other columns are not read.
    """
    return decided(*plan(docs, weights, share, most, seed, id_col, text, source)).select(
        UID, "id", "size", "source_size", "target", "whole", "part", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


def repeated(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 7,
             id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` (a stored table) as often as it is taken, a last repetition in part cut to its first words.

    Documents without words have nothing to take and go. All columns; ``n_chars``, if there, follows a cut text.
    The decisions are joined to the rows from the small tables, so no text is shuffled while those may be broadcast.
    """
    _, sources, edge = plan(docs, weights, share, most, seed, id_col, text, source)
    small = sources.select("key", "whole", "rest", "cut", "left")
    rows = keyed(docs, seed, id_col, text, source).select(ROW, UID, "key", "bucket", word_count("text").alias("size"))
    rows = decided(rows, small, edge).where("size > 0")
    copies = F.col("whole").cast("int") + (F.col("part") > 0).cast("int")
    rows = rows.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    short = (F.col("copy") > F.col("whole")) & (F.col("part") < F.col("size"))
    cell = F.col(ROW).getField
    led = F.regexp_replace(cell(text), f"^[{SPACES}]+", "")
    head = F.array_join(F.slice(F.split(led, f"(?<=[{SPACES}])(?=[^{SPACES}])"), 1, F.col("part").cast("int")), "")
    out = {text: head, "n_chars": F.length(head)}
    return rows.select(*[(F.when(short, out[c]).otherwise(cell(c)) if c in out else cell(c)).alias(c) for c in docs.columns])


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    return mix(read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
