"""Packing along a space-filling curve: documents ordered by the Hilbert key of a projected hashed vector, cut into sequences."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayput.llm.common import UID, mapped, staged, with_uid
from stayput.llm.words import BYTES, hash_spans, mixed

LENGTH = 2048
END_ID = 1
#: Hashed document vector, dimensions after projection, bits of each on the curve.
HASHED, DIMS, DEPTH = 1024, 3, 10
#: White-space-free strings, and pieces of such, whose ids a Python worker remembers at most, those used last; others are encoded again.
REMEMBERED, PIECES = 3_000_000, 600_000
#: Newly learned strings that are kept apart before they are merged, and bytes of text that are handled at a time.
RECENT, CHUNK = 100_000, 2 << 20
#: Letters whose lower case is one letter and that never compose, then punctuation that is one piece.
LATIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?*#$%&|]*)")
#: White space of one byte; the tokenizer also drops that of two and three.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Recent:
    """A mapping that keeps the entries used last: when the younger half is full it becomes the older one, and what the older half
    held and nothing asked for since is forgotten. At most ``most`` entries, and those of one call, are held."""

    def __init__(self, most: int):
        self.half, self.young, self.old = most // 2, {}, {}

    def find(self, keys: list[str]) -> list[bytes | None]:
        found = list(map(self.young.get, keys))
        if None in found and self.old:
            young, old = self.young, self.old
            for k, b in enumerate(found):
                if b is None and (b := old.get(keys[k])) is not None:
                    found[k] = young[keys[k]] = b
            self.turn()
        return found

    def turn(self) -> None:
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}


def spaces(raw: np.ndarray) -> np.ndarray:
    """Which bytes of a UTF-8 text are white space: in one byte, U+0085, U+00A0, U+1680, U+2000 to 200A, U+2028, 2029, 202F, 205F, U+3000."""
    out = SPACE[raw]
    for lead, second, third in ((0xC2, (0x85, 0xA0), None), (0xE1, (0x9A,), (0x80,)), (0xE2, (0x80,), (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)),
                                (0xE2, (0x81,), (0x9F,)), (0xE3, (0x80,), (0x80,))):
        at = np.flatnonzero(raw[:-2] == lead)
        at = at[np.isin(raw[at + 1], second)]
        if third is not None:
            at = at[np.isin(raw[at + 2], third)]
        for k in range(2 if third is None else 3):
            out[at + k] = True
    return out


class Strings:
    """Ids of strings by two hashes of theirs, in sorted arrays: 30 bytes a string. At most ``most`` strings stay, those used last.

    New ones are kept in a small array of their own and merged when that is full.
    """

    def __init__(self, most: int):
        self.most, self.now = most, 0
        self.flat, self.end = np.zeros(1 << 20, np.uint16), 0
        self.main, self.recent = self._none(), self._none()

    @staticmethod
    def _none() -> dict[str, np.ndarray]:
        return {"key": np.zeros(0, np.uint64), "check": np.zeros(0, np.uint64), "at": np.zeros(0, np.int64), "n": np.zeros(0, np.int32), "used": np.zeros(0, np.int32)}

    def find(self, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the ids, their number, whether known) of each string."""
        at, n, known = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        for table in (self.main, self.recent):
            if not len(table["key"]):
                continue
            k = np.minimum(np.searchsorted(table["key"], key), len(table["key"]) - 1)
            hit = (table["key"][k] == key) & (table["check"][k] == check) & ~known
            k = k[hit]
            at[hit], n[hit], known[hit] = table["at"][k], table["n"][k], True
            table["used"][k] = self.now
        return at, n, known

    def add(self, key: np.ndarray, check: np.ndarray, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Remember strings that are not known; returns the place and number of their ids."""
        held = np.frombuffer(b"".join(ids), "<u2")
        n = np.array([len(x) // 2 for x in ids], np.int64)
        if self.end + len(held) > len(self.flat):
            self.flat = np.concatenate([self.flat[:self.end], np.zeros(max(len(self.flat), len(held)), np.uint16)])
        at = self.end + np.cumsum(n) - n
        self.flat[self.end:self.end + len(held)] = held
        self.end += len(held)
        self.recent = self._merged(self.recent, {"key": key, "check": check, "at": at, "n": n.astype(np.int32), "used": np.full(len(key), self.now, np.int32)})
        return at, n

    @staticmethod
    def _merged(a: dict, b: dict) -> dict:
        both = {c: np.concatenate([a[c], b[c]]) for c in a}
        order = np.argsort(both["key"], kind="stable")
        return {c: v[order] for c, v in both.items()}

    def tidy(self) -> None:
        """Between two calls: merge the new strings, and forget those used longest ago when there are too many."""
        self.now += 1
        if len(self.recent["key"]) <= RECENT:
            return
        self.main, self.recent = self._merged(self.main, self.recent), self._none()
        if len(self.main["key"]) > self.most:
            keep = np.sort(np.argsort(self.main["used"], kind="stable")[-(self.most // 2):])
            self.main = {c: v[keep] for c, v in self.main.items()}
            at, n = self.main["at"], self.main["n"].astype(np.int64)
            first = np.cumsum(n) - n
            self.flat = np.concatenate([self.flat[spread(at, n)], np.zeros(1 << 20, np.uint16)])
            self.main["at"], self.end = first, int(n.sum())


def spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers at, at + 1, ... of each range of ``n``, one range after the other."""
    return np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Encoder:
    """Ids of whole texts as little-endian 16-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    white-space-free strings in turn. Strings are found by hashes in arrays; the ids of a bounded number are remembered, new ones are
    learned together. A string of Latin letters and closing punctuation is two pieces to the tokenizer. The letters of many such
    strings are encoded in one call and told apart by the ids that end a piece; all other strings are encoded one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.pieces = Strings(REMEMBERED), Recent(PIECES)
        self.ends = np.zeros(1 << 16, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")

    def _one_by_one(self, strings: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, "<u2").tobytes() for e in found]

    def _together(self, words: list[str]) -> list[bytes]:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u2")
        at = (2 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(at) != len(words):  # no such case is known; the plain way is always right
            return self._one_by_one(words)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *at], at)]

    def learn(self, strings: list[str]) -> list[bytes]:
        """The ids of strings."""
        plain, split, needed = [], [], {}
        for s in strings:
            if m := LATIN.fullmatch(s):
                core, close = m.groups()
                core = core.lower()
                split.append((s, core, close))
                needed[core] = None
                if close:
                    needed[close] = None
            else:
                plain.append(s)
        self.pieces.turn()
        wanted = list(needed)
        pieces = dict(zip(wanted, self.pieces.find(wanted)))
        cores = [w for w, b in pieces.items() if b is None and w[0].isalpha()]
        closing = [w for w, b in pieces.items() if b is None and not w[0].isalpha()]
        out: dict[str, bytes] = {}
        for some, encode, into in ((cores, self._together, pieces), (closing, self._one_by_one, pieces), (plain, self._one_by_one, out)):
            for at in range(0, len(some), 512):
                into.update(zip(some[at:at + 512], encode(some[at:at + 512])))
        self.pieces.young.update((w, pieces[w]) for w in (*cores, *closing))
        for s, core, close in split:
            out[s] = pieces[core] + pieces[close] if close else pieces[core]
        return [out[s] for s in strings]

    def _chunk(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first byte of each string, its number of ids, all ids) of some text."""
        data = np.frombuffer(raw + bytes(8), np.uint8)
        gap = spaces(data)
        gap[len(raw):] = True
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate([[0], edge])
        start, stop = edge[::2], edge[1::2]
        key = hash_spans(data, start, stop)
        eight = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
        with np.errstate(over="ignore"):  # another hash, of the first and last eight bytes and the length
            size = stop - start
            head, tail = eight[start] & BYTES[np.minimum(size, 8)], np.where(size > 8, eight[np.maximum(stop - 8, 0)], np.uint64(0))
            check = mixed(head * np.uint64(0x9E3779B97F4A7C15) + tail + size.astype(np.uint64))
        _, one, inverse = np.unique(key ^ (check << np.uint64(1)), return_index=True, return_inverse=True)
        at, n, known = self.known.find(key[one], check[one])
        new = np.flatnonzero(~known)
        if len(new):
            strings = [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(start[one[new]].tolist(), stop[one[new]].tolist())]
            at[new], n[new] = self.known.add(key[one[new]], check[one[new]], self.learn(strings))
        count = n[inverse]
        ids = self.known.flat[spread(at[inverse], count)]
        self.known.tidy()
        return start, count, ids

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text. All texts are handled together, CHUNK bytes at a time, cut at white space."""
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        raw = b"\n".join(parts)
        first = np.cumsum([0] + [len(p) + 1 for p in parts])
        total, held, at = np.zeros(len(parts), np.int64), [], 0
        while at < len(raw):
            to = len(raw)
            if to - at > CHUNK:
                to = max(raw.rfind(b" ", at, at + CHUNK), raw.rfind(b"\n", at, at + CHUNK)) + 1
                if not to:      # a string of more than CHUNK bytes
                    to = min((x for x in (raw.find(b" ", at + CHUNK), raw.find(b"\n", at + CHUNK)) if x >= 0), default=len(raw) - 1) + 1
            start, count, ids = self._chunk(raw[at:to])
            total += np.bincount(np.searchsorted(first, start + at, "right") - 1, count, len(parts)).astype(np.int64)
            held.append(ids.astype("<u2").tobytes())
            at = to
        ids, ends = b"".join(held), (2 * np.cumsum(total)).tolist()
        return [ids[i:j] for i, j in zip([0, *ends], ends)]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder for all tasks that a Python worker runs."""
    return _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))


@lru_cache(maxsize=None)
def projection(seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """(hash bucket of every 16-bit id, fixed random matrix from a hashed document vector to the curve's dimensions)."""
    ids = np.arange(1 << 16, dtype=np.uint64)
    bucket = ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(HASHED)
    return bucket.astype(np.int64), np.random.default_rng(seed).standard_normal((HASHED, DIMS))


def hilbert_key(cells: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Place on the Hilbert curve of points with ``depth``-bit coordinates, one row each (the transpose form: undo
    the rotations from the highest bit down, Gray-code across dimensions, then interleave the bits)."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for level in range(depth - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(n):
            set_ = (x[:, d] & bit) != 0
            swap = (x[:, 0] ^ x[:, d]) & low
            x[:, 0] ^= np.where(set_, low, swap)
            if d:
                x[:, d] ^= np.where(set_, 0, swap)
    for d in range(1, n):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.int64)
    for level in range(depth - 1, 0, -1):
        turn ^= np.where(x[:, n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(depth - 1, -1, -1):
        for d in range(n):
            key = (key << 1) | ((x[:, d] >> level) & 1)
    return key


def curve_place(ids: np.ndarray) -> np.ndarray:
    """Cell of one document: its hashed vector, scaled by its length, projected and squashed to 0..2^DEPTH - 1."""
    bucket, project = projection()
    vector = np.bincount(bucket[ids], minlength=HASHED) if len(ids) < 1 << 16 else \
        sum(np.bincount(bucket[ids[at:at + (1 << 16)]], minlength=HASHED) for at in range(0, len(ids), 1 << 16))
    v = vector @ project / max(1.0, np.sqrt(len(ids)))
    return np.clip((np.arctan(v / 4) / np.pi + 0.5) * (1 << DEPTH), 0, (1 << DEPTH) - 1).astype(np.int64)


def tokenized(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(_uid, id, n, place, ids): every row's ids with the end id, as 16-bit bytes, and its place on the curve."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        end = np.array([END_ID], "<u2").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [x + end for x in encoder.encode_all(part.column(2).to_pylist())]
                cells = np.stack([curve_place(np.frombuffer(x, "<u2")) for x in ids])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(hilbert_key(cells)), pa.array(ids, pa.binary())],
                    [UID, "id", "n", "place", "ids"])

    cols = with_uid(docs).select(UID, F.col(id_col).cast("long").alias("id"), F.col(text).alias("t"))
    return mapped(cols, run, f"{UID} long, id long, n long, place long, ids binary")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for batch in batches:
        cols = [[] for _ in names]
        for doc, n, first, ids in zip(*(batch.column(i) for i in range(4))):
            doc, n, first, ids = doc.as_py(), n.as_py(), first.as_py(), np.frombuffer(ids.as_py(), "<u2")
            start = 0
            while start < n:
                at = first + start
                length = min(n - start, LENGTH - at % LENGTH)
                crc = zlib.crc32(ids[start:start + length].astype("<u4").tobytes())
                for c, v in zip(cols, (doc, start, length, crc, n, at // LENGTH, at % LENGTH)):
                    c.append(v)
                start += length
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def pack(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents follow the curve (ties by id, nulls last, then row number) and fill sequences of LENGTH ids one after
    the other, so a document is cut only where a sequence ends and only the last sequence is padded.
    Null and empty texts are one end id; repeated rows are packed each; no rows give no rows; other columns are not read.

    The order is a range sort of small rows in three steps: the rows are written range-partitioned, each part sums
    its lengths, and the sums before a part shift it. The driver sees one row per part at most.
    """
    spark = docs.sparkSession
    rows = staged(tokenized(docs, tokenizer, id_col, text), "tokens")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = ["place", "id", UID]
    ranged = rows.select(UID, "id", "n", "place").repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    ranged = staged(ranged, "order")
    sums = ranged.groupBy("part").agg(F.sum("n").alias("m"))
    before = sums.select("part", (F.sum("m").over(Window.orderBy("part")) - F.col("m")).alias("before"))
    upto = F.sum("n").over(Window.partitionBy("part").orderBy(F.col("place"), F.col("id").asc_nulls_last(), UID)
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # one row per range part
    places = ranged.withColumn("upto", upto).join(F.broadcast(before), "part") \
        .select(UID, (F.col("before") + F.col("upto") - F.col("n")).alias("first"))
    return mapped(
        rows.join(places, UID).select("id", "n", "first", "ids"), _cut, "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op10_packing(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    return pack(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
