"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened into arrays."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayput.llm.common import UID, join_checked, mapped, staged, with_uid

#: Labelled rows that the trees are fitted on at most: those with the smallest seeded hash.
SAMPLE_ROWS = 20_000
FEATURES = ("length", "words", "word_length", "distinct_words", "top_word", "lines", "line_words", "distinct_lines", "upper", "digits",
            "spaces", "marks", "other_marks", "high_bytes", "end_marks", "repeat_next", "long_words", "byte_entropy", "distinct_bytes")

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_COMMON = np.isin(_BYTES, [ord(c) for c in ".,;:'\"!?-()"])
_HIGH = _BYTES >= 128
_OTHER = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _COMMON | _HIGH)
_END = np.isin(_BYTES, [ord(c) for c in ".!?"])
_CLASSES = np.stack([_UPPER, _DIGIT, _SPACE, _COMMON, _OTHER, _HIGH, _END], axis=1).astype(float)


def statistics(text: str | None) -> np.ndarray:
    """The features of one whole text; null and empty texts give zeros."""
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return np.zeros(len(FEATURES))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / len(raw)
    upper, digits, spaces, marks, other, high, ends = share @ _CLASSES
    present = share[share > 0]
    words = raw.split()
    lines = raw.split(b"\n")
    n = len(words)
    distinct = Counter(words)
    same = sum(map(bytes.__eq__, words, words[1:]))
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1, np.int64)
    most = max(distinct.values(), default=0)
    return np.array([np.log1p(len(raw)), np.log1p(n), lengths.mean(), len(distinct) / max(n, 1) ** 0.8, most / max(n, 1), np.log1p(len(lines)),
                     np.log1p(n / len(lines)), len(set(lines)) / len(lines), upper, digits, spaces, marks, other, high, ends, same / max(n, 1),
                     (lengths > 15).mean(), -(present * np.log2(present)).sum(), len(present) / min(256, len(raw))])


@dataclass
class Trees:
    """All trees in flat arrays: node i tests feature[i] <= cut[i] and goes to left[i], or left[i] + 1; a leaf leads to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            step = x[rows, self.feature[at]] > self.cut[at]
            at = self.left[at] + step
        return self.base + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0,
        least: int = 10) -> Trees:
    """Second-order boosting on binned features: each level adds gradients into (node, feature, bin) histograms and splits at the best gain.

    One class only, or no rows, gives no splits: the score is then the smoothed share of label 1 (0.5 without rows).
    """
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.empty(0) for j in range(d)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j]) for j in range(d)], axis=1) if n else np.empty((0, d), int)
    flat = binned + np.arange(d) * bins
    p = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(p / (1 - p)))
    f = np.full(n, base)
    feature, cut, left, value, roots = [], [], [], [], []
    for _ in range(trees if 0 < y.sum() < n else 0):
        q = 1 / (1 + np.exp(-f))
        g, h = y - q, q * (1 - q)
        node = np.zeros(n, np.int64)
        ids = [len(feature)]
        roots.append(ids[0])
        feature.append(0), cut.append(np.inf), left.append(ids[0]), value.append(0.0)
        for level in range(depth + 1):
            k = len(ids)
            live = node >= 0
            sums = [np.bincount(node[live], w[live], k) for w in (g, h)]
            for i, at in enumerate(ids):
                value[at] = rate * sums[0][i] / (sums[1][i] + ridge)
            if level == depth:
                break
            where = (node[live, None] * (d * bins) + flat[live]).ravel()
            hist = [np.bincount(where, np.repeat(w[live], d), k * d * bins).reshape(k, d, bins).cumsum(axis=2) for w in (g, h, np.ones(n))]
            part = lambda a, b: a * a / (b + ridge)
            total = [s[:, :, -1:] for s in hist]
            gain = part(hist[0], hist[1]) + part(total[0] - hist[0], total[1] - hist[1]) - part(total[0], total[1])
            gain[(hist[2] < least) | (total[2] - hist[2] < least)] = -1
            best = gain.reshape(k, -1).argmax(axis=1)
            new, renumber, test = [], np.full(k, -1), []
            for i, at in enumerate(ids):
                j, b = divmod(int(best[i]), bins)
                test.append((j, b))
                if gain[i, j, b] <= 1e-9 or b >= len(edges[j]):
                    continue
                renumber[i] = len(new)
                feature[at], cut[at], left[at] = j, edges[j][b], len(feature)
                for _ in range(2):
                    new.append(len(feature))
                    feature.append(0), cut.append(np.inf), left.append(len(feature) - 1), value.append(0.0)
            if not new:
                break
            tj, tb = np.array(test).T
            goes = binned[np.arange(n), tj[node]] > tb[node]
            node = np.where(live & (renumber[node] >= 0), renumber[node] + goes, -1)
            ids = new
        tree = Trees(np.array(feature), np.array(cut), np.array(left), np.array(value), np.array(roots[-1:]), 0.0, depth)
        f += tree.margin(x)
    if not roots:
        feature, cut, left, value, roots = [0], [np.inf], [0], [0.0], [0]
    return Trees(np.array(feature), np.array(cut), np.array(left), np.array(value), np.array(roots), base, depth)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def with_statistics(df: DataFrame, text: str, keep: list[str], schema: str) -> DataFrame:
    """``keep`` and ``x``, the features of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([statistics(t.as_py()) for t in batch.column(len(keep))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], x], [*keep, "x"])

    return mapped(df.select(*keep, F.col(text).alias("t")), run, f"{schema}, x array<double>")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on the labelled rows that are not held out, at most ``sample_rows`` of them by the smallest hash of the id.

    Null ids and labels teach nothing; of several labels for one id each counts; of several documents with one id each
    counts, up to twice ``sample_rows`` rows in all, in the order of the hash, so a fit can be repeated. Without any row the score is 0.5.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    chosen = known.select(F.col(id_col).alias("_id"), F.col(label).cast("double").alias("y")) \
        .orderBy(F.xxhash64("_id"), "_id", "y").limit(sample_rows)
    rows = join_checked(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_t")), staged(chosen, "chosen"), "_id")
    rows = with_statistics(rows, "_t", ["_id", "y"], f"_id {chosen.schema['_id'].dataType.simpleString()}, y double") \
        .orderBy(F.xxhash64("_id"), "_id", "y", "x").limit(2 * sample_rows).collect()
    x = np.array([r.x for r in rows]) if rows else np.empty((0, len(FEATURES)))
    y = np.array([r.y for r in rows])
    order = np.lexsort([*x.T, y]) if len(y) else np.empty(0, int)  # the same fit whatever order the rows came in
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """_uid, id, held_out, score (0 to 1) and predicted for every row of ``docs``; null and empty texts are scored by their zero statistics.

    Whole texts count, however long; equal texts and repeated rows score the same; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            s = np.concatenate([model.score(np.stack([statistics(t) for t in batch.column(3).slice(at, 512).to_pylist()]))
                                for at in range(0, batch.num_rows, 512)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             [UID, "id", "held_out", "score", "predicted"])

    cols = with_uid(docs).select(UID, F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), F.col(text).alias("t"))
    return mapped(cols, run, f"{UID} long, id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Trees, id_col: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without the rows scored under ``least``; all columns, rows unchanged."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                s = model.score(np.stack([statistics(t) for t in part.column(schema.names.index(text)).to_pylist()]))
                yield part.filter(pa.array(s >= least))

    return mapped(docs, run, schema)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    docs = read(spark, sf_dir, "documents")
    return score(docs, train(docs, read(spark, sf_dir, "labels"))).select(
        F.col("id").alias("doc_id"), "held_out", "score", "predicted")
