"""Language identification by string kernels: blended-spectrum n-gram presence, Nyström landmarks, kernel ridge regression."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayput.llm.common import UID, join_checked, mapped, staged, with_uid
from stayput.llm.quality import held_out

#: n-grams of 1 to GRAMS characters, hashed to BUCKETS presence flags.
GRAMS, BUCKETS = 3, 1 << 15
#: Training documents of each language, and landmarks of each, at most.
PER_LANGUAGE, LANDMARKS = 400, 48
#: Training documents of all languages together; many languages have fewer each, but one at least.
ALL_DOCUMENTS = 80_000
#: Landmarks of all languages together, and numbers in the matrix of weights (landmarks times languages): both bound the model, whatever
#: the number of languages. Very many languages share LEAST landmarks.
ALL_LANDMARKS, WEIGHTS, LEAST = 1_024, 16_000_000, 16
#: Tasks that sum the training documents; each sends the driver one square matrix.
SUMS = 16
#: Documents in one matrix product.
ROWS = 128
UNKNOWN = "und"
_LATIN = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_LATIN.search(text)) or any(map(str.isalpha, text))


def presence(text: str, out: np.ndarray) -> None:
    """Set the flags of the n-grams in a whole text, lower-cased, with white space as one blank at either end of it and between words."""
    c = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "replace"), np.uint32)
    h = np.zeros(len(c), np.uint32)
    for n in range(1, GRAMS + 1):
        if len(c) < n:
            break
        h = (h[:len(c) - n + 1] if n > 1 else h) * np.uint32(0x01000193) + c[n - 1:] * np.uint32(0x9E3779B1)
        x = h ^ (h >> np.uint32(15))
        out[(x * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 15)] = 1


def presences(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for t, row in zip(texts, out):
        presence(t, row)
    return out


@dataclass
class Kernel:
    """Landmark presences as bits, and the ridge weights that act on a document's kernel values with them."""

    names: list[str]
    flags: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    @cached_property
    def landmarks(self) -> np.ndarray:
        """Presences scaled to kernel norm 1, unpacked where they are used."""
        return scaled(self.flags)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "landmarks"}

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Name and score of each text: one batched product gives the normalised kernel with all landmarks, one more all classes' values."""
        if not self.names or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        x = presences(texts)
        kernel = (x @ self.landmarks.T) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
        value = kernel @ self.weights + self.bias
        e = np.exp(4 * (value - value.max(axis=1, keepdims=True)))
        best = value.argmax(axis=1)
        return [self.names[i] for i in best], (e / e.sum(axis=1, keepdims=True)).max(axis=1).astype(float)


def scaled(flags: np.ndarray) -> np.ndarray:
    """Rows of packed presence flags as numbers of norm 1."""
    x = np.unpackbits(flags, axis=1).astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def nystrom(marks: np.ndarray) -> np.ndarray:
    """The inverse square root of the landmarks' kernel: Nyström features are kernel values with the landmarks times this."""
    s, v = np.linalg.eigh((marks @ marks.T).astype(float))
    return v @ np.diag(1 / np.sqrt(np.maximum(s, 1e-6))) @ v.T


def solve(names: list[str], count: np.ndarray, gram: np.ndarray, sums: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of the one-versus-rest ridge regression in which each language counts the same.

    ``gram`` is the sum over documents of weight times the outer product of their features, ``sums`` (languages, features) the plain
    sums of each language's features, ``count`` its documents. Targets are 1 and -1.
    """
    k, n = len(names), count.sum()
    weight = n / (k * count)
    mean = (weight[:, None] * sums).sum(0) / n
    left = gram - n * np.outer(mean, mean) + ridge * np.eye(len(mean))
    right = 2 * weight[:, None] * (sums - count[:, None] * mean)
    w = np.linalg.solve(left, right.T)
    return w, (2 / k - 1) - mean @ w


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, h, flags): the packed presence flags of texts with a letter."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            texts = part.column(2).to_pylist()
            good = pa.array([i for i, t in enumerate(texts) if has_letter(t)], pa.int64())
            packed = np.packbits(presences([texts[i] for i in good.to_pylist()]).astype(np.uint8), axis=1)
            yield pa.RecordBatch.from_arrays([part.column(0).take(good), part.column(1).take(good), pa.array([x.tobytes() for x in packed], pa.binary())],
                                             ["lang", "h", "flags"])


def _unpacked(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BUCKETS // 8)


def _summed(frame: DataFrame, flags: np.ndarray, root: np.ndarray, weight: dict[str, float]) -> DataFrame:
    """(lang, sums): for each task the weighted Gram matrix of its documents' features (lang null), and the sum of each language's features."""
    shared = frame.sparkSession.sparkContext.broadcast((flags, root, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, root, weight = shared.value
        marks = scaled(flags)
        gram, sums = np.zeros(root.shape), {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                phi = (scaled(_unpacked(part.column(1))) @ marks.T).astype(float) @ root
                langs = part.column(0).to_pylist()
                gram += (phi * np.array([weight[x] for x in langs])[:, None]).T @ phi
                for x, row in zip(langs, phi):
                    sums[x] = sums[x] + row if x in sums else row
        held = list(sums.items())
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([gram.tobytes()], pa.binary())], ["lang", "sums"])
        for at in range(0, len(held), 4096):
            some = held[at:at + 4096]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in some], pa.string()), pa.array([v.tobytes() for _, v in some], pa.binary())], ["lang", "sums"])

    return mapped(frame, run, "lang string, sums binary")


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Kernel:
    """Learn from documents that are not held out and have a language and a letter.

    Every language is learned. Bounded sample: PER_LANGUAGE documents of each, or its share of ALL_DOCUMENTS, those with the smallest
    hash of the id. Hashes are counted into a cut per language first, so no task orders a language's rows. Texts stay on the executors:
    they become 4 KB of flags each, the landmarks' flags and sums of features reach the driver (at most SUMS square matrices of
    ALL_LANDMARKS and one row of features per language and task). Null ids, null languages and texts without a letter teach nothing; equal
    hashes are told apart by id and text; repeated rows count each; without any document the model knows no language.
    """
    rows = docs.where(F.col(lang).isNotNull() & ~held_out(id_col) & F.col(id_col).isNotNull() & (F.length(F.coalesce(F.col(text), F.lit(""))) > 0)) \
        .select(F.col(id_col).alias("id"), F.col(lang).cast("string").alias("lang"), F.pmod(F.xxhash64(id_col), F.lit(1 << 30)).alias("h"), F.col(text).alias("t"))
    counts = staged(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    languages = counts.count()
    nothing = Kernel([], np.empty((0, BUCKETS // 8), np.uint8), np.empty((0, 0)), np.empty(0))
    if not languages:
        return nothing
    each = max(min(PER_LANGUAGE, ALL_DOCUMENTS // languages), 1)
    # three times the rows wanted are expected under the cut, and 30 at least: fewer is all but impossible, and no error if it happens
    wanted = float(max(3 * each, 30))
    cuts = counts.select("lang", F.when(F.col("n") <= wanted, F.lit(float(1 << 30))).otherwise(wanted / F.col("n") * float(1 << 30)).alias("cut"))
    few = staged(join_checked(rows, cuts, "lang").where(F.col("h") < F.col("cut")).drop("cut"), "sample")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "t"))
    sample = few.withColumn("k", first).where(F.col("k") <= each)
    flags = staged(mapped(sample.select("lang", F.col("k").cast("long"), "t"), _flags, "lang string, h long, flags binary"), "flags")
    known = {r.lang: r.n for r in flags.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()}   # a number per language
    if not known:
        return nothing
    names = sorted(known)
    most = min(ALL_LANDMARKS, max(WEIGHTS // len(names), LEAST))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = flags.withColumn("k", place).where(F.col("k") <= max(min(LANDMARKS, most // len(names)), 1)) \
        .orderBy("k", F.xxhash64("lang"), "lang").limit(most).orderBy("lang", "k").select("flags").collect()
    marks = np.frombuffer(b"".join(r.flags for r in chosen), np.uint8).reshape(-1, BUCKETS // 8)
    root = nystrom(scaled(marks))
    count = np.array([known[x] for x in names], float)
    weight = dict(zip(names, count.sum() / (len(names) * count)))
    gram, sums, at = np.zeros(root.shape), np.zeros((len(names), len(root))), {x: i for i, x in enumerate(names)}
    for r in _summed(flags.select("lang", "flags").coalesce(SUMS), marks, root, weight).toLocalIterator():
        if r.lang is None:
            gram += np.frombuffer(r.sums).reshape(root.shape)
        else:
            sums[at[r.lang]] += np.frombuffer(r.sums)
    w, bias = solve(names, count, gram, sums)
    return Kernel(names, marks, (root @ w).astype(np.float32), bias.astype(np.float32))


def identify(docs: DataFrame, model: Kernel, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """_uid, id, held_out, lang_pred and score (0 to 1) of every row; null texts and texts without a letter are ``und`` with score 0.

    Whole texts are read, however long; a batch holds a bounded number of presence rows. Other columns are not read. Repeated rows are
    rows of their own; of languages with equal values the first by name is taken; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [t or "" for t in part.column(3).to_pylist()]
                some = [i for i, t in enumerate(texts) if has_letter(t)]
                names, values = model.decide([texts[i] for i in some])
                pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                for i, name, value in zip(some, names, values):
                    pred[i], score[i] = name, value
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(pred, pa.string()), pa.array(score)],
                                                 [UID, "id", "held_out", "lang_pred", "score"])

    cols = with_uid(docs).select(UID, F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), F.col(text).alias("t"))
    return mapped(cols, run, f"{UID} long, id long, held_out boolean, lang_pred string, score double")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    docs = read(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")
