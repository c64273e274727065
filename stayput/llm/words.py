"""Words of many texts at once, as places in their bytes and 64-bit hashes; no object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once, about; a longer text is handled alone.
SLICE = 2 << 20
#: Words are runs of a-z, 0-9 and all bytes from 0x80, after A-Z are lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[0x30:0x3A] = IN_WORD[0x61:0x7B] = IN_WORD[0x80:] = True
#: Bytes of a word that are hashed eight at a time; what lies beyond is hashed as a whole.
NEAR_BYTES = 64
#: What the first so many of eight bytes keep.
BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, n + 1 offsets) of consecutive texts with at most about SLICE bytes, or of one text. No text may be null."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1, at + 1)
        yield at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def hash_spans(low: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``low``, which has eight bytes more than the spans need."""
    size = stop - start
    h = size.astype(np.uint64)
    eight = np.ndarray((len(low) - 7,), "<u8", buffer=low, strides=(1,))
    for done in range(0, NEAR_BYTES, 8):
        at = np.flatnonzero(size > done) if done else slice(None)
        left = np.minimum(size[at] - done, 8)
        if not left.size:
            break
        h[at] = mixed(h[at] ^ (eight[start[at] + done] & BYTES[left]))
    for k in np.flatnonzero(size > NEAR_BYTES):
        import xxhash

        h[k] ^= np.uint64(xxhash.xxh64_intdigest(low[start[k] + NEAR_BYTES:stop[k]].tobytes()))
    return h


class Words:
    """The words of some texts: ``low`` bytes, ``start`` and ``stop`` of each word in them, its ``text`` and ``place``; ``count`` and ``first`` word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.low = np.concatenate([LOWER[data], np.zeros(8, np.uint8)])
        inside = IN_WORD[self.low[:-8]]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[1:-1]
        before[edges[edges < len(inside)]] = False
        after[edges[edges > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.stop = np.flatnonzero(inside & ~after) + 1
        self.text = np.searchsorted(offsets[1:], self.start, "right")
        self.count = np.bincount(self.text, minlength=len(offsets) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.count)[:-1]]) if len(self.count) else np.zeros(0, np.int64)
        self.place = np.arange(len(self.start)) - self.first[self.text]

    def joined(self, a: int, b: int) -> str:
        """Words a to b, separated by one blank."""
        return b" ".join([self.low[i:j].tobytes() for i, j in zip(self.start[a:b], self.stop[a:b])]).decode("utf-8", "replace")

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return hash_spans(self.low, self.start, self.stop)

    def shingles(self, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of the runs of ``size`` words inside one text, from the hashes of the words."""
        n = len(h) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[:n] == self.text[size - 1:])
        with np.errstate(over="ignore"):
            out = np.full(len(at), np.uint64(size) * np.uint64(0x9E3779B97F4A7C15), np.uint64)
            for k in range(size):
                out = (out + h[at + k]) * np.uint64(0xFF51AFD7ED558CCD)
                out ^= out >> np.uint64(29)
        return at, mixed(out)
