"""Benchmark decontamination: an exact containment join of item windows with documents, driven by each window's rarest shingle.

A window is a set of shingles that a document holds entirely or not at all, so of its shingles, ordered by rarity, a prefix of one is
necessary and enough: a document that holds the window holds its rarest shingle at the same distance from the window's start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayput.llm.common import UID, join_checked, mapped, staged
from stayput.llm.words import Words, slices

#: Words of a window, and of a shingle in it. Items of fewer words are one window; windows of fewer words one shingle.
WINDOW, SHINGLE = 10, 5
#: Bits of a sketch for each key, and the least and most bits as powers of two: 16 MB at most, whatever the table's size.
BITS_A_KEY, LEAST_BITS, MOST_BITS = 64, 16, 27
#: Windows, of up to some hundred bytes each, that a broadcast may hold.
BROADCAST_WINDOWS = 100_000
EMPTY = hashlib.sha256(b"").hexdigest()


def windows(items: DataFrame, id_col: str = "item_id", text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item, m, body, size, tokens): each window of each whole item text: its words, their number, and the hashes of its shingles by offset.

    Null texts and texts without words have no window. A null id counts as an item with an empty name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets)
                h = words.hashes()
                out = {"item": [], "m": [], "body": [], "size": [], "tokens": []}
                keys = {}
                for k in range(len(words.count)):
                    n, at = int(words.count[k]), int(words.first[k])
                    m = min(n, window)
                    size = min(m, shingle)
                    if n and size not in keys:
                        place, key = words.shingles(h, size)
                        keys[size] = np.zeros(len(h), np.uint64)
                        keys[size][place] = key
                    for a in range(at, at + n - m + 1) if n else ():
                        out["item"].append(batch.column(0)[first + k].as_py())
                        out["m"].append(m)
                        out["body"].append(words.joined(a, a + m))
                        out["size"].append(size)
                        out["tokens"].append(keys[size][a:a + m - size + 1].view(np.int64).tolist())
                        if len(out["m"]) >= 4096:
                            yield pa.RecordBatch.from_pydict(out, schema=schema)
                            out = {c: [] for c in out}
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("item", pa.string()), ("m", pa.int32()), ("body", pa.string()), ("size", pa.int32()), ("tokens", pa.list_(pa.int64()))])
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return mapped(rows, run, "item string, m int, body string, size int, tokens array<long>")


def sketch(tokens: DataFrame) -> tuple[int, np.ndarray]:
    """(bits as a power of two, bit array) of the leading bits of all ``token``s; at most 2^(MOST_BITS - 6) numbers reach the driver.

    It only leaves out what cannot be a token: beyond some ten million tokens it leaves out less, and the joins behind it do more.
    """
    n = tokens.select("token").distinct().count()
    bits = min(max((max(n, 1) * BITS_A_KEY - 1).bit_length(), LEAST_BITS), MOST_BITS)
    cells = tokens.select(F.shiftrightunsigned("token", 64 - bits).alias("at")) \
        .select(F.shiftright("at", 6).cast("int").alias("cell"), F.expr("shiftleft(1L, CAST(at % 64 AS INT))").alias("bit")) \
        .groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return bits, out


def _met(bits: int, sketched: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key >> np.uint64(64 - bits)
    return np.flatnonzero(sketched[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1))


def token_counts(docs: DataFrame, tokens: DataFrame, sizes: list[int], text: str = "text") -> DataFrame:
    """(token, n): occurrences in all documents of the shingles that may be ``tokens``, counted in each batch before the shuffle."""
    bits, some = sketch(tokens)
    seen = docs.sparkSession.sparkContext.broadcast(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                words = Words(data, offsets)
                h = words.hashes()
                for size in sizes:
                    key = words.shingles(h, size)[1]
                    key, n = np.unique(key[_met(bits, seen.value, key)], return_counts=True)
                    if len(key):
                        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])

    return mapped(docs.select(F.coalesce(F.col(text), F.lit("")).alias("t")), run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def rarest(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(w, m, body, size, token, offset): the distinct windows, each with the rarest of its shingles (then the least hash, then the first)."""
    distinct = found.groupBy("body").agg(*[F.first(c).alias(c) for c in ("m", "size", "tokens")])
    each = distinct.select("body", "m", "size", F.posexplode("tokens").alias("offset", "token"))
    each = join_checked(each, counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    least = F.min(F.struct("n", "token", "offset", "m", "size")).alias("p")
    return each.groupBy("body").agg(least).select(
        F.unhex(F.sha2("body", 256)).alias("w"), "body", *[F.col(f"p.{c}").alias(c) for c in ("m", "size", "token", "offset")])


def _scanned(docs: DataFrame, prefix: DataFrame, sizes: list[int], id_col: str, text: str, window: int) -> DataFrame:
    """One row per document (_uid, id, n_words), and one for each of its shingles that may be a prefix token:
    (_uid, n_words, place, token, since, context), the context being the words from ``since`` on that a window around it may cover."""
    bits, some = sketch(prefix)
    seen = docs.sparkSession.sparkContext.broadcast(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in slices(batch.column(2)):
                words = Words(data, offsets)
                h = words.hashes()
                k = len(words.count)
                none = pa.nulls(k, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, k), batch.column(1).slice(first, k), pa.array(words.count.astype(np.int64)),
                                                  none, none, none, pa.nulls(k, pa.string())], names)
                for size in sizes:
                    at, key = words.shingles(h, size)
                    met = _met(bits, seen.value, key)
                    for some_met in np.array_split(met, len(met) // 8192 + 1):
                        i = at[some_met]
                        doc = words.text[i]
                        low = np.maximum(words.first[doc], i - (window - size))
                        high = np.minimum(words.first[doc] + words.count[doc], i + window)
                        yield pa.RecordBatch.from_arrays([
                            batch.column(0).slice(first, k).take(pa.array(doc)), pa.nulls(len(i), pa.int64()), pa.array(words.count[doc].astype(np.int64)),
                            pa.array(words.place[i]), pa.array(key[some_met].view(np.int64)), pa.array(words.place[low] if len(i) else low),
                            pa.array([words.joined(a, b) for a, b in zip(low.tolist(), high.tolist())], pa.string())], names)

    names = [UID, "id", "n_words", "place", "token", "since", "context"]
    cols = docs.select(F.monotonically_increasing_id().alias(UID), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return mapped(cols, run, f"{UID} long, id long, n_words long, place long, token long, since long, context string")


def occurrences(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text: str = "text",
                window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, hits, members): (_uid, id, n_words) of every row of ``docs``; (_uid, start, m, w, body) of every place where a window
    stands in one; (w, item) of every window's items. All are tables in the shared folder.

    1. Both texts are cut into words (a-z after lower-casing, 0-9, anything beyond ASCII); null is a text without words.
    2. All documents' shingles that occur in windows are counted; each distinct window takes the rarest of its own as its prefix.
    3. Documents emit the places of prefix tokens only, known by a sketch of fixed size, with the words that a window there may cover.
    4. Places join windows on the token (broadcast if few, else by a shuffle); the offset and the lengths bound the window inside the
       document, and its words must equal the document's.

    Empty tables give empty results; repeated rows are rows of their own; columns other than the named ones are not read.
    """
    found = staged(windows(items, item_col, text, window, shingle), "windows")
    sizes = sorted(r[0] for r in found.select("size").distinct().collect())  # at most ``shingle`` numbers
    tokens = found.select(F.explode("tokens").alias("token"))
    counts = staged(token_counts(docs, tokens, sizes, text), "counts")
    prefix = staged(rarest(found, counts), "prefixes")
    scanned = staged(_scanned(docs, prefix, sizes, id_col, text, window), "scanned")
    places = scanned.where(F.col("token").isNotNull()).drop("id")
    start = F.col("place") - F.col("offset")
    met = join_checked(places, prefix, "token", limit=BROADCAST_WINDOWS).withColumn("start", start) \
        .where((F.col("start") >= 0) & (F.col("start") + F.col("m") <= F.col("n_words")))
    here = F.array_join(F.slice(F.split("context", " "), (F.col("start") - F.col("since") + 1).cast("int"), F.col("m")), " ")
    hits = staged(met.where(here == F.col("body")).select(UID, "start", F.col("m").cast("long").alias("m"), "w", "body"), "hits")
    members = staged(found.select(F.unhex(F.sha2("body", 256)).alias("w"), "item").distinct(), "members")
    return scanned.where(F.col("token").isNull()).select(UID, "id", "n_words"), hits, members


def contamination(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """One row per row of ``docs``: _uid, id, n_words, n_hit (words inside any window that stands there), n_items, items_sha256 (of the sorted,
    comma-joined item ids). See ``occurrences`` for the join and its edge cases.

    Documents with the same set of windows are one set: its items are listed once, so a passage that a third of all documents
    share costs one list, however many items it stands in.
    """
    documents, hits, members = occurrences(docs, items, **how)
    by_start = Window.partitionBy(UID).orderBy("start", "m")
    reached = F.max(F.col("start") + F.col("m")).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("m") - F.greatest("start", F.coalesce(reached, F.lit(0))))
    # the windows of one document are at most as many as its words, for each length of a window
    of_doc = hits.withColumn("fresh", fresh).groupBy(UID).agg(F.sum("fresh").alias("n_hit"), F.array_sort(F.collect_set("w")).alias("ws"))
    of_doc = staged(of_doc.withColumn("set", F.unhex(F.sha2(F.array_join(F.transform("ws", lambda w: F.hex(w)), ","), 256))), "sets")
    sets = of_doc.groupBy("set").agg(F.first("ws").alias("ws")).select("set", F.explode("ws").alias("w"))
    listed = join_checked(sets, members, "w").groupBy("set").agg(F.array_sort(F.collect_set("item")).alias("items"))
    listed = staged(listed.select("set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "items")
    marked = join_checked(of_doc.select(UID, "n_hit", "set"), listed, "set")
    zero = F.lit(0).cast("long")
    return join_checked(documents, staged(marked, "marked"), UID, "left").select(
        UID, "id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.lit(EMPTY)).alias("items_sha256"))


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


OP11_SQL = r"""
WITH lowered AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, words, len(words) AS n FROM lowered),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
j AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, words, least(len(words), 10) AS m FROM i WHERE len(words) > 0),
k AS (SELECT item, words, m, unnest(range(1, len(words) - m + 2)) AS a FROM j),
w AS (SELECT DISTINCT item, m, array_to_string(words[a:a + m - 1], ' ') AS body FROM k),
s AS (SELECT DISTINCT m FROM w),
p AS (SELECT r, words, m, unnest(range(1, n - m + 2)) AS a FROM d, s WHERE n >= m),
h AS (SELECT r, a, m, array_to_string(words[a:a + m - 1], ' ') AS body FROM p),
x AS (SELECT r, a, m, item FROM h JOIN w USING (m, body)),
y AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM x GROUP BY r),
z AS (SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(a, a + m)) AS spot FROM x) GROUP BY r)
SELECT doc_id, n AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN y USING (r) LEFT JOIN z USING (r)
"""
