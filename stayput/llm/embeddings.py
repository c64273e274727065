"""Embedding near-duplicates: exact cosine pairs by dual traversal of cover trees over blocks of vectors."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayput.llm.common import UID, mapped, ship, staged, with_uid
from stayput.llm.components import connected_components
from stayput.llm.links import forest

#: Vectors of a block at most (a block is one row of a table), and centers that blocks are cut by at most.
BLOCK_ROWS, CENTERS = 4096, 4096
#: Vectors that the centers are chosen from at most: those with the smallest hash.
SAMPLE_ROWS = 8192
#: Radii of the nested levels, each half the one before.
RADII = (1.0, 0.5, 0.25, 0.125)
#: Bytes of blocks that a task holds, about: each group of blocks meets each other one in one task. Groups that a table is cut into at least.
GROUP_BYTES, GROUPS = 128 << 20, 8
#: Node pairs whose centers are compared in one matrix.
TILE = 1024
#: Pairs in one list; child pairs of a node pair from which a matrix product takes over.
LISTED, LARGE = 1 << 15, 4096
SLACK = 1e-9


def unit(rows: list, dims: int) -> np.ndarray:
    x = np.array(rows, np.float64).reshape(len(rows), dims)
    x = x / np.abs(x).max(axis=1, keepdims=True)       # so that squares of very large or small numbers stay numbers
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def net(x: np.ndarray, radius: float, start: np.ndarray) -> np.ndarray:
    """Greedy net inside each group of ``start`` (group numbers): for each point the index of the first center within ``radius``."""
    owner = np.full(len(x), -1)
    order = np.argsort(start, kind="stable")
    sizes = np.bincount(start)
    alone = sizes[start] == 1
    owner[alone] = np.flatnonzero(alone)
    order = order[~alone[order]]
    for group in np.split(order, np.flatnonzero(np.diff(start[order])) + 1) if len(order) else []:
        left = group
        while len(left):
            near = np.linalg.norm(x[left] - x[left[0]], axis=1) <= radius
            owner[left[near]] = left[0]
            left = left[~near]
    return owner


class Tree:
    """Nested levels over one block: points are ordered so that each node is a range; a node has a center and its covering radius.

    Level k nodes are greedy nets of radius RADII[k] inside the nodes of level k - 1. A level is (start, stop, radius) of its nodes.
    A tree is built once per block and kept as bytes, so that the traversals of a block's many pairs only read it.
    """

    def __init__(self, x: np.ndarray, weight: np.ndarray, ids: np.ndarray, levels: list):
        self.x, self.weight, self.ids, self.levels = x, weight, ids, levels

    @classmethod
    def build(cls, x: np.ndarray, weight: np.ndarray, ids: np.ndarray) -> Tree:
        group, groups = np.zeros(len(x), np.int64), []
        for r in RADII:
            group = np.unique(net(x, r, group) if groups else first_net(x, r), return_inverse=True)[1]
            groups.append(group)
        order = np.lexsort(groups[::-1])
        tree = cls(x[order], weight[order], ids[order], [])
        for group in groups:
            g = group[order]
            start = np.concatenate([[0], np.flatnonzero(np.diff(g)) + 1])
            stop = np.concatenate([start[1:], [len(g)]])
            far = np.linalg.norm(tree.x - np.repeat(tree.x[start], stop - start, axis=0), axis=1)
            tree.levels.append((start, stop, np.maximum.reduceat(far, start)))
        return tree

    def to_bytes(self) -> bytes:
        arrays = {"x": self.x, "weight": self.weight, "ids": self.ids}
        for k, (start, _, radius) in enumerate(self.levels):
            arrays |= {f"s{k}": start, f"r{k}": radius}
        out = io.BytesIO()
        np.savez(out, **arrays)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Tree:
        z = np.load(io.BytesIO(raw))
        x = z["x"]
        levels = [(z[f"s{k}"], np.concatenate([z[f"s{k}"][1:], [len(x)]]), z[f"r{k}"]) for k in range(len(RADII))]
        return cls(x, z["weight"], z["ids"], levels)


def first_net(x: np.ndarray, radius: float) -> np.ndarray:
    """The net of the whole block; distances come in tiles of one matrix product."""
    owner = np.full(len(x), -1)
    least = 1 - radius * radius / 2  # of the inner product of unit vectors
    for at in range(0, len(x), TILE):
        rows = np.arange(at, min(len(x), at + TILE))
        near = x[rows] @ x.T >= least
        for i in rows:
            if owner[i] < 0:
                hit = np.flatnonzero(near[i - at])
                owner[hit[owner[hit] < 0]] = i
                owner[i] = i
    return owner


def pairs_within(a: Tree, b: Tree, far: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into a, into b) of points at distance ``far`` at most: node pairs go down level by level while
    the distance of their centers is at most ``far`` plus both radii. For one tree with itself, i < j."""
    (sa, ea, ra), (sb, eb, rb) = a.levels[0], b.levels[0]
    ca, cb, least = a.x[sa], b.x[sb], 1 - far * far / 2 - SLACK
    one_a, one_b, all_b = ea - sa == 1, eb - sb == 1, np.arange(len(sb))
    # nodes of one point have radius 0, so one bound holds for all their pairs
    for left, right, bare in ((np.flatnonzero(one_a), np.flatnonzero(one_b), True), (np.flatnonzero(~one_a), all_b, False),
                              (np.flatnonzero(one_a), np.flatnonzero(~one_b), False)):
        for at in range(0, len(left), TILE):
            x = left[at:at + TILE]
            for to in range(0, len(right), TILE):
                y = right[to:to + TILE]
                if same and y[-1] < x[0]:
                    continue
                inner = ca[x] @ cb[y].T
                i, j = np.nonzero(inner >= least if bare else np.sqrt(np.maximum(0, 2 - 2 * inner)) <= far + ra[x, None] + rb[None, y] + SLACK)
                i, j = x[i], y[j]
                if same:
                    keep = i <= j
                    i, j = i[keep], j[keep]
                yield from _down(a, b, 0, i, j, far, same)


def _children(t: Tree, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every node: its first child and the number of its children; of every child: center and radius. Below the last level are the points."""
    start, stop, _ = t.levels[level]
    if level + 1 == len(t.levels):
        return start, stop - start, np.arange(len(t.x)), np.zeros(len(t.x))
    below, _, radius = t.levels[level + 1]
    first = np.searchsorted(below, start)
    return first, np.searchsorted(below, stop) - first, below, radius


def _down(a: Tree, b: Tree, level: int, i: np.ndarray, j: np.ndarray, far: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    (sa, ea, _), (sb, eb, _) = a.levels[level], b.levels[level]
    least = 1 - far * far / 2
    single = (ea[i] - sa[i] == 1) & (eb[j] - sb[j] == 1)
    p, q = sa[i[single]], sb[j[single]]
    if same:
        p, q = p[p != q], q[p != q]
    for at in range(0, len(p), LISTED):
        u, v = p[at:at + LISTED], q[at:at + LISTED]
        good = np.einsum("ij,ij->i", a.x[u], b.x[v]) >= least
        yield u[good], v[good]
    i, j = i[~single], j[~single]
    if not len(i):
        return
    (fa, na, ca, ra), (fb, nb, cb, rb) = _children(a, level), _children(b, level)
    last = level + 1 == len(a.levels)

    def go(x, y, own):
        """Child pairs that may hold links: at the points they are the links, else they go on."""
        if same:
            keep = ~own | (x < y if last else x <= y)
            x, y = x[keep], y[keep]
        if last:
            yield x, y
        elif len(x):
            yield from _down(a, b, level + 1, x, y, far, same)

    large = na[i] * nb[j] >= LARGE
    for k, m in zip(i[large].tolist(), j[large].tolist()):      # by matrix products
        for at in range(fa[k], fa[k] + na[k], TILE):
            x, y = np.arange(at, min(fa[k] + na[k], at + TILE)), np.arange(fb[m], fb[m] + nb[m])
            inner = a.x[ca[x]] @ b.x[cb[y]].T
            u, v = np.nonzero(inner >= least if last else np.sqrt(np.maximum(0, 2 - 2 * inner)) <= far + ra[x, None] + rb[None, y] + SLACK)
            yield from go(x[u], y[v], np.full(len(u), k == m))
    i, j = i[~large], j[~large]
    sizes = na[i] * nb[j]
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // LISTED)) + 1
    for k, m in zip(np.split(i, cuts), np.split(j, cuts)):      # by lists of child pairs
        n = na[k] * nb[m]
        pair = np.repeat(np.arange(len(k)), n)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        x, y = fa[k[pair]] + place // nb[m[pair]], fb[m[pair]] + place % nb[m[pair]]
        inner = np.einsum("ij,ij->i", a.x[ca[x]], b.x[cb[y]])
        ok = inner >= least if last else np.sqrt(np.maximum(0, 2 - 2 * inner)) <= far + ra[x] + rb[y] + SLACK
        yield from go(x[ok], y[ok], (k == m)[pair][ok])


def _blocks(pdf):
    """One row per block: its tree as bytes, its center and radius."""
    import pandas as pd

    dims = int(pdf["dims"].iloc[0])
    pdf = pdf.sort_values("rep")
    x = unit(list(pdf["embedding"]), dims)
    center = x.mean(axis=0)
    norm = np.linalg.norm(center)
    center = center / norm if norm > 0 else x[0]
    tree = Tree.build(x, pdf["n"].to_numpy(np.int64), pdf["rep"].to_numpy(np.int64))
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "tree": [tree.to_bytes()],
                         "center": [center.tobytes()], "radius": [float(np.linalg.norm(x - center, axis=1).max())]})


def _joined(a: Tree, b: Tree, far: float, same: bool) -> Iterator[pa.RecordBatch]:
    """Link counts of both blocks' points, and a spanning forest of the links."""
    counts = [np.zeros(len(a.x), np.int64), np.zeros(len(b.x), np.int64)]
    held: list = [np.empty(0, np.int64), np.empty(0, np.int64)]
    for i, j in pairs_within(a, b, far, same):
        if not len(i):
            continue
        counts[0] += np.bincount(i, b.weight[j], len(a.x)).astype(np.int64)
        counts[1] += np.bincount(j, a.weight[i], len(b.x)).astype(np.int64)
        held = forest(np.concatenate([held[0], a.ids[i]]), np.concatenate([held[1], b.ids[j]]))
    for t, c in zip((a, b), counts):
        some = np.flatnonzero(c)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(t.ids[some]), pa.array(c[some]), pa.array([None] * len(some), pa.int64())], ["rep", "links", "to"])
    if len(held[0]):
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(np.zeros(len(held[0]), np.int64)), pa.array(held[1])], ["rep", "links", "to"])


def _traverse(cosine: float):
    """All pairs of blocks of two groups (or of one): rows come by (first, second) group, those of the first before those of the second.

    A task holds the first group and reads the second block by block. A tree over the centers of the held blocks, built like the trees
    inside them, is walked with each block that comes, so blocks too far apart are never compared.
    """
    far = float(np.sqrt(2 - 2 * cosine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, above = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["first"], row["second"]) != key:
                    key, held, above = (row["first"], row["second"]), [], None
                tree = Tree.from_bytes(row["tree"])
                block, center, radius = row["block"], np.frombuffer(row["center"]), row["radius"]
                if row["side"] == 0:
                    if key[0] == key[1]:        # within a group a block meets itself and those that came before it
                        yield from _joined(tree, tree, far, True)
                        for _, _, _, t in (x for x in held if np.linalg.norm(x[1] - center) <= far + x[2] + radius + SLACK):
                            yield from _joined(t, tree, far, False)
                    held.append((block, center, radius, tree))
                    continue
                above = above or Above([x[1] for x in held], [x[2] for x in held])
                for k in above.near(center, radius + far):
                    yield from _joined(held[k][3], tree, far, False)

    return run


class Above:
    """A tree over blocks: nested nets of their centers, each node with a radius that covers its blocks whole."""

    def __init__(self, centers: list[np.ndarray], radii: list[float]):
        self.x, self.radii = np.array(centers), np.array(radii)
        self.root = self._node(np.arange(len(radii)), 2.0)

    def _node(self, some: np.ndarray, reach: float) -> tuple:
        center = some[0]
        far = np.linalg.norm(self.x[some] - self.x[center], axis=1) + self.radii[some]
        if len(some) == 1 or reach < 1e-3:
            return center, far.max(), some, []
        owner = net(self.x[some], reach / 2, np.zeros(len(some), np.int64))
        return center, far.max(), some, [self._node(some[owner == o], reach / 2) for o in np.unique(owner)]

    def near(self, center: np.ndarray, reach: float) -> Iterator[int]:
        """Blocks that may hold a point within ``reach`` of ``center``."""
        todo = [self.root]
        while todo:
            at, radius, some, below = todo.pop()
            if np.linalg.norm(self.x[at] - center) > reach + radius + SLACK:
                continue
            if below:
                todo += below
            else:
                yield from (int(k) for k in some if np.linalg.norm(self.x[k] - center) <= reach + self.radii[k] + SLACK)


def _assign(centers: np.ndarray, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.empty(batch.num_rows, np.int64)
            for at in range(0, batch.num_rows, 2048):
                x = unit(batch.column(2).slice(at, 2048).to_pylist(), dims)
                cells[at:at + 2048] = (x @ centers.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], ["rep", "n", "embedding", "cell"])
    return run


def choose_centers(sample: np.ndarray, k: int) -> np.ndarray:
    """Farthest-first: each center is the sample's point farthest from those before, so the centers are a net."""
    chosen = [0]
    near = sample @ sample[0]
    while len(chosen) < min(k, len(sample)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, sample @ sample[chosen[-1]])
    return sample[chosen]


def linkable(col):
    """No null, zero, empty or non-finite vector; any finite double will do. NaN is above every number in Spark's order, so it is tested apart."""
    ok = F.forall(col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= F.lit(float(np.finfo(np.float64).max))))
    return F.coalesce(col.isNotNull() & (F.size(col) > 0) & ok & F.exists(col, lambda v: v != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", embedding: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``vectors`` (a stored table): _uid, id, n_links, component_id, kept.

    Links: pairs with cosine >= ``cosine`` in double precision, labels ignored. Null, empty and zero vectors and those with null or
    non-finite components link with nothing, nor do vectors of different length. Repeated rows and equal vectors count as
    different vectors linked to each other. component_id is the smallest id reachable; kept is id = component_id. No rows give no rows.

    Equal vectors are one representative with a count. Representatives are cut into blocks: by the nearest of a few
    centers, and a crowded center's by hash, so a block is bounded and never hot. Blocks form groups of GROUP_BYTES; two groups that may
    hold links are one task, which holds the first and walks its tree of blocks with every block of the second, so a block is sent once
    per group and not once per block. Link counts add up over block pairs, and each sends a spanning forest.
    """
    rows = with_uid(vectors).select(UID, F.col(id_col).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("e"))
    ok = linkable(F.col("e"))
    rows = rows.select(UID, "id", F.when(ok, F.col("e")).alias("e")).withColumn("k", F.sha2(F.array_join("e", ","), 256))
    rows = staged(rows, "vectors")
    reps = rows.where(F.col("e").isNotNull()).groupBy("k").agg(F.first("e").alias("embedding"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    reps = staged(reps.withColumn("rep", F.monotonically_increasing_id()).withColumn("dims", F.size("embedding")), "representatives")
    found = None
    for dims, total in [(r.dims, r.n) for r in reps.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).orderBy("dims").collect()]:
        part = _links_of(reps.where(F.col("dims") == dims), int(dims), int(total), cosine, block_rows)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(UID, "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = staged(found, "links")
    counts = found.where("links > 0").groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("to is not null"), "rep", "to").withColumnRenamed("node", "rep")
    labelled = reps.select("rep", "k", "n", "least").join(roots, "rep", "left").join(counts, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component"))
    labels = labelled.join(least, "root").select("k", "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    out = rows.drop("e").join(labels, "k", "left")
    component = F.coalesce("component", "id")
    return out.select(UID, "id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _links_of(reps: DataFrame, dims: int, total: int, cosine: float, block_rows: int) -> DataFrame:
    """(rep, links, to): link counts, and rows with ``to`` that are a spanning forest."""
    ship(reps.sparkSession)
    cells = min(CENTERS, max(1, total // block_rows))
    sample = reps.orderBy(F.xxhash64("k"), "k").limit(min(SAMPLE_ROWS, 4 * cells)).select("embedding").collect()
    centers = choose_centers(unit([r.embedding for r in sample], dims), cells)
    dealt = mapped(reps.select("rep", "n", "embedding"), _assign(centers, dims), "rep long, n long, embedding array<double>, cell long")
    sizes = staged(dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("m")), "cells")
    # one row per center; two thirds of the bound on average, so that a hashed part stays near it
    chunks = F.greatest(F.lit(1), F.ceil(F.col("m") * 1.5 / block_rows)).cast("int")
    dealt = dealt.join(F.broadcast(sizes.select("cell", chunks.alias("chunks"))), "cell") \
        .withColumn("block", F.col("cell") * (1 << 32) + F.pmod(F.xxhash64("rep"), F.col("chunks"))).withColumn("dims", F.lit(dims))
    packed = dealt.select("block", "dims", "rep", "n", "embedding").groupBy("block").applyInPandas(
        _blocks, "block long, tree binary, center binary, radius double")
    # groups of blocks: cells by the nearest of a few centers, a crowded one's blocks by hash; at most CENTERS numbers on the driver
    held = {r.cell: r.m * (dims + 2) * 8 for r in sizes.collect()}
    whole = sum(held.values())
    tops = choose_centers(centers, min(len(centers), max(GROUPS, -(-whole // GROUP_BYTES))))
    top_of = (centers @ tops.T).argmax(axis=1)
    first, parts = [], []
    for t in range(len(tops)):
        first.append(sum(parts))
        parts.append(max(1, -(-sum(held.get(c, 0) for c in np.flatnonzero(top_of == t)) // GROUP_BYTES)))
    table = F.array(*[F.struct(F.lit(first[t]).alias("first"), F.lit(parts[t]).alias("parts")) for t in top_of.tolist()])
    of = F.element_at(table, (F.floor(F.col("block") / (1 << 32)) + 1).cast("int"))
    packed = staged(packed.withColumn("group", (of["first"] + F.pmod(F.xxhash64("block"), of["parts"])).cast("int")), "blocks")
    groups = first[-1] + parts[-1]
    # a group's ball covers all its blocks; groups too far apart do not meet
    far = float(np.sqrt(2 - 2 * cosine))
    top = np.repeat(np.arange(len(tops)), parts)
    balls = {r.group: r.far for r in mapped(packed.select("group", "center", "radius"), _reach(tops[top]), "group int, far double")
             .groupBy("group").agg(F.max("far").alias("far")).collect()}
    ball = np.array([balls.get(g, -np.inf) for g in range(groups)])
    gap = np.sqrt(np.maximum(0, 2 - 2 * (tops[top] @ tops[top].T))) - ball[:, None] - ball[None]
    meets = [[h for h in range(groups) if gap[g, h] <= far + SLACK or g == h] for g in range(groups)]
    partner = F.explode(F.element_at(F.array(*[F.array(*[F.lit(h) for h in m]) for m in meets]), F.col("group") + 1))
    work = packed.withColumn("other", partner).select(
        F.least("group", "other").alias("first"), F.greatest("group", "other").alias("second"), (F.col("group") > F.col("other")).cast("int").alias("side"),
        "block", "tree", "center", "radius")
    tasks = max(groups * (groups + 1) // 2, int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    work = work.repartition(tasks, "first", "second").sortWithinPartitions("first", "second", "side", "block")
    return mapped(work, _traverse(cosine), "rep long, links long, to long")


def _reach(centers: np.ndarray):
    """(group, far): how far each block reaches from its group's center."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column(0).to_numpy()
            x = np.array([np.frombuffer(c) for c in batch.column(1).to_pylist()]).reshape(len(group), -1)
            far = np.linalg.norm(x - centers[group], axis=1) + batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(far)], ["group", "far"])
    return run


def op3_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    return near_duplicates(read(spark, sf_dir, "embeddings")).drop(UID).withColumnRenamed("id", "vec_id")
