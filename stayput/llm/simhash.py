"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked through anchors of a covering code.

A pair within ``t`` bits differs by at most ``t // b`` bits in one of ``b`` blocks of the fingerprint.
In each block the anchors are the code words of a perfect Hamming code on the leading ``2^m - 1``
bits (covering radius 1) combined with every value of the remaining bits. A fingerprint's home is its
nearest anchor, at most 1 bit away, so a partner within ``e`` bits of it lies within ``1 + e`` bits of that
home: each fingerprint is sent to all anchors that near, and compared per anchor with the ones at home.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayput.llm.common import UID, join_checked, mapped, staged, unwrapped, with_uid, wrapped
from stayput.llm.components import connected_components
from stayput.llm.links import forest

BITS = 64
#: (blocks, parity bits of the block's Hamming code) by the most distinct fingerprints it serves; every choice finds all pairs.
LAYOUTS = ((1 << 27, 3, 4), (1 << 62, 2, 5))
#: Fingerprints at home in one anchor beyond which the anchor's work is split over several tasks.
HOME_ROWS = 4096


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """The fingerprint of one text as an unsigned 64-bit integer; no words give zero."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        to = min(n, at + 65536)
        h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[at:to].tolist(), ends[at + k - 1:to + k - 1].tolist())),
                        np.uint64, to - at)
        counts += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words_per_shingle: int = 4) -> DataFrame:
    """(_uid, id, fp long): the fingerprint of every row's whole text as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words_per_shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], [UID, "id", "fp"])

    cols = with_uid(docs).select(UID, F.col(id_col).cast("long").alias("id"), F.col(text).alias("t"))
    return mapped(cols, run, f"{UID} long, id long, fp long")


@lru_cache(maxsize=None)
def _codewords(m: int) -> tuple[np.ndarray, np.ndarray]:
    """For the Hamming code of length 2^m - 1: syndrome of each byte position, as parity-check columns 1..2^m - 1."""
    n = (1 << m) - 1
    return np.arange(1, n + 1, dtype=np.int64), np.left_shift(np.int64(1), np.arange(n, dtype=np.int64))


def _syndrome(x: np.ndarray, m: int) -> np.ndarray:
    columns, bits = _codewords(m)
    s = np.zeros(len(x), np.int64)
    for c, b in zip(columns, bits):
        s ^= np.where(x & b, c, 0)
    return s


@lru_cache(maxsize=None)
def _reach(m: int, free: int, e: int) -> tuple[tuple[int, ...], tuple[tuple[int, int], ...]]:
    """Flip masks on a block. Coded bits: for every syndrome, all masks of weight at most 1 + e that lead to a code word;
    free bits: masks of weight at most e. A pair of masks is used when the excess over the home's radius fits e."""
    n = (1 << m) - 1
    by: list[list[tuple[int, int]]] = [[] for _ in range(1 << m)]
    for w in range(0, e + 2):
        for where in combinations(range(n), w):
            s = 0
            mask = 0
            for i in where:
                s ^= i + 1
                mask |= 1 << i
            by[s].append((w, mask))
    loose = [(w, sum(1 << (n + i) for i in where)) for w in range(e + 1) for where in combinations(range(free), w)]
    # the excess over the home's largest distance (1) plus the flipped free bits may not pass e
    masks = [[a | b for wa, a in rows for wb, b in loose if max(0, wa - 1) + wb <= e] for rows in by]
    return tuple(len(x) for x in masks), tuple((s, x) for s, rows in enumerate(masks) for x in rows)


def blocks(b: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each block."""
    edges = [round(i * BITS / b) for i in range(b + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(b)]


def anchors(fps: np.ndarray, threshold: int, b: int, m: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: (anchor key, index into fps, whether the anchor is the fingerprint's home)."""
    u = fps.view(np.uint64)
    for k, (first, width) in enumerate(blocks(b)):
        x = ((u >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
        sizes, flat = _reach(m, width - ((1 << m) - 1), threshold // b)
        sizes = np.array(sizes)
        start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mask = np.array([v for _, v in flat], np.int64)
        s = _syndrome(x, m)
        n = sizes[s]
        row = np.repeat(np.arange(len(x)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + start[s[row]]
        flips = mask[at]
        home = flips == np.where(s > 0, np.left_shift(np.int64(1), np.maximum(s - 1, 0)), 0)[row]
        yield (np.int64(k) << np.int64(56)) | (x[row] ^ flips), row, home


def _replicate(threshold: int, b: int, m: int):
    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 2048):
                part = np.ascontiguousarray(fps[at:at + 2048])
                for key, row, home in anchors(part, threshold, b, m):
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row]), pa.array(home)], ["anchor", "fp", "home"])
    return run


def near(home: np.ndarray, guests: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (home, guest) within the bit distance, in blocks of bounded size."""
    left, right = [], []
    step = max(1, (1 << 20) // max(1, len(guests)))
    for at in range(0, len(home), step):
        i, j = np.nonzero(np.bitwise_count(home[at:at + step, None] ^ guests[None, :]) <= threshold)
        left.append(i + at)
        right.append(j)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, int), np.empty(0, int))


def _compare(threshold: int):
    """Rows come sorted by (anchor, part, guests after those at home); yields a spanning forest of the links of each anchor."""

    def links(home: np.ndarray, guests: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(guests), 1 << 16):
            some = guests[at:at + (1 << 16)]
            step = 1 << 12
            for to in range(0, len(home), step):
                i, j = near(home[to:to + step], some, threshold)
                a, b = home[to:to + step][i], some[j]
                yield forest(a[a != b].view(np.int64), b[a != b].view(np.int64))

    def run(batches):
        tail: list[np.ndarray] = []
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def flush(keys, fps, home):
            cut = np.flatnonzero(np.diff(keys)) + 1
            for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(keys)]])):
                if b - a > 1:
                    h = home[a:b]
                    if h.any():
                        out.extend(x for x in links(fps[a:b][h], fps[a:b]) if len(x[0]))

        held = None
        for batch in batches:
            key = np.stack([batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)])
            fps = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            home = batch.column(3).to_numpy(zero_copy_only=False)
            if held is not None:
                key, fps, home = np.concatenate([held[0], key], axis=1), np.concatenate([held[1], fps]), np.concatenate([held[2], home])
            new = np.flatnonzero((np.diff(key, axis=1) != 0).any(axis=0))
            last = new[-1] + 1 if len(new) else 0
            if last:
                ids = np.concatenate([[0], np.cumsum((np.diff(key[:, :last], axis=1) != 0).any(axis=0))])
                flush(ids, fps[:last], home[:last])
            held = (key[:, last:], fps[last:], home[last:])
            if out:
                a, b = forest(np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out]))
                out.clear()
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])
        if held is not None and len(held[1]):
            flush(np.zeros(len(held[1]), int), held[1], held[2])
            for a, b in out:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])
        tail.clear()

    return run


def fingerprint_links(distinct: DataFrame, threshold: int = 4, layout: tuple[int, int] | None = None) -> DataFrame:
    """Edges (src, dst) between distinct fingerprints that span exactly the components of the bit-distance graph."""
    spark = distinct.sparkSession
    n = distinct.count()
    b, m = layout or next((b, m) for most, b, m in LAYOUTS if n <= most)
    spread = mapped(distinct.select("fp"), _replicate(threshold, b, m), "anchor long, fp long, home boolean")
    spread = staged(spread, "anchors")
    crowded = spread.where("home").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOME_ROWS) \
        .select("anchor", F.ceil(F.col("n") / HOME_ROWS).cast("int").alias("parts"))
    dealt = join_checked(spread, crowded, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = dealt.select("anchor", "fp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "home", own.alias("own")) \
        .select("anchor", "part", "fp", (F.col("home") & (F.col("part") == F.col("own"))).alias("home"))
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return mapped(dealt.repartition(width, "anchor", "part").sortWithinPartitions("anchor", "part"), _compare(threshold), "src long, dst long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words_per_shingle: int = 4,
                    threshold: int = 4, layout: tuple[int, int] | None = None) -> DataFrame:
    """One row per row of ``docs`` (a stored table): _uid, id, fp, component_id (the smallest id reachable), kept.

    Null and empty texts have fingerprint zero and link like any other; repeated rows share a fingerprint.
    Of each component the row with the smallest id stays (null ids last, then the first row), so exactly
    one row does. Whole texts are read whatever their length; other columns are not read. No rows give no rows.
    """
    rows = staged(fingerprints(docs, id_col, text, words_per_shingle), "fingerprints")
    by_fp = rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col(UID))).alias("first"))
    by_fp = staged(by_fp, "distinct")
    roots = connected_components(fingerprint_links(by_fp, threshold, layout)).withColumnRenamed("node", "fp")
    labelled = by_fp.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = labelled.groupBy("root").agg(F.min("first").alias("best"))
    labels = labelled.join(best, "root").select("fp", F.col("best.id").alias("component_id"), F.col(f"best.{UID}").alias("best_uid"))
    return rows.join(labels, "fp").select(UID, "id", "fp", "component_id", (F.col(UID) == F.col("best_uid")).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words_per_shingle: int = 4, threshold: int = 4) -> DataFrame:
    """``docs`` (a stored table) with one row of each component; all columns, rows unchanged."""
    found = near_duplicates(docs, id_col, text, words_per_shingle, threshold)
    dropped = staged(found.where(~F.col("kept")).select(UID), "dropped")
    return unwrapped(join_checked(wrapped(docs), dropped, UID, "left_anti"), docs.columns)


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
