"""Words of many texts at once: spans and 64-bit hashes, straight from the bytes of an Arrow string column.

Everything here works on a chunk of rows (about `CHUNK` bytes, or one longer text), so memory follows the chunk and the longest
text, not the Arrow batch. Hashes are polynomials modulo 2^64 with a final mix: two given different words share one with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

#: Bytes that belong to words: all but the blanks \x20 and \x09-\x0D; or digits, a-z and whatever is not ASCII (lower-case first).
NOT_BLANK = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
LETTERS = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all the others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for ascending spans that don't overlap."""
    out, at = np.empty(len(start), np.uint64), 0
    while at < len(start):
        base = int(start[at])
        to = max(at + 1, int(np.searchsorted(end, base + CHUNK, "right")))
        s, e = start[at:to] - base, end[at:to] - base
        n = int(e[-1])
        up, down = _powers(max(CHUNK + 1, 1 << n.bit_length()))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data[base : base + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        out[at:to] = mixed((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _STEP)
        at = to
    return out


class Words:
    """Words of a chunk of texts: byte spans, `first` (word offsets of the texts, one more at the end) and `off` (their byte offsets)."""

    def __init__(self, data: np.ndarray, off: np.ndarray, belongs: np.ndarray = NOT_BLANK):
        self.data, self.off = data, off
        inside = belongs[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        full = off[1:] > off[:-1]
        begins[off[:-1][full]] = inside[off[:-1][full]]
        ends[off[1:][full] - 1] = inside[off[1:][full] - 1]
        self.inside = inside
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    @property
    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.count) - np.arange(len(self.start))

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def per_row(self, of_bytes: np.ndarray) -> np.ndarray:
        """Sum over the bytes of each row."""
        total = np.concatenate(([0], np.cumsum(of_bytes, dtype=np.int64)))
        return total[self.off[1:]] - total[self.off[:-1]]

    def texts(self, a: int, b: int) -> list[bytes]:
        """Words a to b (exclusive) of the chunk."""
        raw = self.data[self.start[a] : self.end[b - 1]].tobytes() if b > a else b""
        base = int(self.start[a]) if b > a else 0
        return [raw[s:e] for s, e in zip((self.start[a:b] - base).tolist(), (self.end[a:b] - base).tolist(), strict=True)]


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n hashes; runs are not cut at the ends of texts, so look at `Words.left` too."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = np.full(size, np.uint64(n))
    for i in range(n):
        out *= _BASE
        out ^= out >> np.uint64(29)
        out += hashes[i : size + i]
    return mixed(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x, have = np.minimum(x[:-have], x[have:]), have * 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    c = pc.fill_null(column.cast(pa.large_string()), "")
    if len(c) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(c.buffers()[1], np.int64)[c.offset : c.offset + len(c) + 1]
    body = c.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows with about `limit` bytes."""
    data, off = raw(column)
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, b, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b

