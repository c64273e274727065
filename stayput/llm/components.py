"""Connected components by alternating large-star and small-star steps, each a grouping and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayput.llm.common import discard, staged


def _starred(links: DataFrame, centers: DataFrame) -> DataFrame:
    return links.join(centers, "u")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Return (node, root) for every node that has an edge; root is the smallest node of its component.

    Null ends and self loops are dropped, repeated edges count once, no edges give no rows.
    Each round writes its edges to the shared folder, so lineage stays short, and deletes those of the round before; a node with very
    many neighbours is one skewed join key, which AQE splits, and its minimum is combined map-side.
    """
    a, b = F.col(src), F.col(dst)
    now = edges.where(a.isNotNull() & b.isNotNull() & (a != b)) \
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = staged(now, "edges")
    state = _state(now)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _starred(both.where("v > u"), low).where("v != m") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _starred(large, low).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        after = staged(small, "edges")
        was, state, before, now = state, _state(after), now, after
        discard(before)
        if was == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
