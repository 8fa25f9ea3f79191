"""Words, word hashes and shingles of many texts at once, on their UTF-8 bytes.

All separators of the word rules used here are ASCII, so bytes decide where words
begin and end. A word's hash is a chain of mixing steps over its bytes, eight at a time; each
step is a bijection of 64 bits, so words of one length up to eight bytes never
collide and others do with the chance of a 64-bit hash (about n * n / 3.7e19 for n
different words). Where a collision would change a result beyond that, callers compare bytes
(``Words.same``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M64 = (1 << 64) - 1
_P = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20240607)
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
#: One odd multiplier for each place in a shingle.
_PLACE = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
#: Masks that keep the first 0..8 bytes of a little-endian 64-bit value.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Words of more bytes are hashed one by one, so that the number of steps stays small.
_LONG_WORD = 256


def _separators(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Words are runs of anything but ASCII white space.
BLANK = _separators((0x20, 0x20), (0x09, 0x0D))
#: Words are runs of a-z (after lower-casing), 0-9 and everything beyond ASCII.
ALNUM = _separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row begins (n + 1 offsets); null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offs = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, kind)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return buf, offs.astype(np.int64) - int(offs[0])


def slices(col: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text each (or of one longer row)."""
    _, offs = raw(col)
    a = 0
    while a < len(col):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        yield a, min(b, len(col))
        a = b


def same_bytes(x: np.ndarray, x_at: np.ndarray, x_size: np.ndarray, y: np.ndarray, y_at: np.ndarray, y_size: np.ndarray) -> np.ndarray:
    """Whether stretches of x equal those of y, pairwise; eight bytes must follow the last stretch of each."""
    out = x_size == y_size
    for i in np.flatnonzero(out & (x_size > _LONG_WORD)).tolist():
        out[i] = np.array_equal(x[x_at[i] : x_at[i] + x_size[i]], y[y_at[i] : y_at[i] + y_size[i]])
    eights = [np.ndarray((max(len(v) - 7, 0),), "<u8", v.data, 0, (1,)) for v in (x, y)]
    live, step = np.flatnonzero(out & (x_size <= _LONG_WORD) & (x_size > 0)), 0
    while len(live):
        equal = ((eights[0][x_at[live] + step] ^ eights[1][y_at[live] + step]) & _FIRST[np.minimum(x_size[live] - step, 8)]) == 0
        out[live[~equal]] = False
        step += 8
        live = live[equal & (x_size[live] > step)]
    return out


def gathered(buf: np.ndarray, begin: np.ndarray, size: np.ndarray, gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of a byte array one after another, ``gap`` spaces after each, and where each begins."""
    at = np.cumsum(size + gap) - size - gap
    out = np.full(int(at[-1] + size[-1]) + gap if len(at) else 0, 32, np.uint8)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at, size) + inside] = buf[np.repeat(begin, size) + inside]
    return out, at


class Words:
    """Words of a text column: row, start and end byte, hash; all in order. Hashes ignore the case of A-Z, unless ``exact``."""

    def __init__(self, col: pa.Array, separators: np.ndarray, exact: bool = False) -> None:
        self.buf, self.offs = raw(col)
        n, rows = len(self.buf), len(self.offs) - 1
        word = ~separators[_LOW[self.buf]]
        before = np.zeros(n, bool)
        before[1:] = word[:-1]
        firsts = self.offs[:-1][self.offs[:-1] < n]
        before[firsts] = False
        after = np.zeros(n, bool)
        after[:-1] = word[1:]
        after[firsts[firsts > 0] - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.row = np.searchsorted(self.offs, self.start, "right") - 1
        self.count = np.bincount(self.row, minlength=rows).astype(np.int64)
        self.first = np.zeros(rows + 1, np.int64)
        np.cumsum(self.count, out=self.first[1:])
        self.bytes = np.zeros(n + 8, np.uint8)  # what counts of the texts, with room to read past the end
        self.bytes[:n] = self.buf if exact else _LOW[self.buf]
        self._eight = np.ndarray((n + 1,), "<u8", self.bytes.data, 0, (1,))
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        length = self.end - self.start
        out = mix(length.astype(np.uint64) * _P + np.uint64(1))
        live = np.flatnonzero(length <= _LONG_WORD)
        for step in range(-(-_LONG_WORD // 8)):
            if not len(live):
                break
            part = self._eight[self.start[live] + 8 * step] & _FIRST[np.minimum(length[live] - 8 * step, 8)]
            out[live] = mix((out[live] ^ part) * _P + np.uint64(step))
            live = live[length[live] > 8 * (step + 1)]
        for i in np.flatnonzero(length > _LONG_WORD).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(self.bytes[self.start[i] : self.end[i]].tobytes(), digest_size=8).digest(), "little")
        return out

    def head(self, k: int, at: np.ndarray | None = None) -> np.ndarray:
        """The first k bytes (at most 8) of the words as one number, shorter words as a whole; of the words at places ``at``, else of all."""
        start, end = (self.start, self.end) if at is None else (self.start[at], self.end[at])
        return self._eight[start] & _FIRST[np.minimum(end - start, k)]

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words at places ``a`` have the bytes of those at places ``b``."""
        return same_bytes(self.bytes, self.start[a], self.end[a] - self.start[a], self.bytes, self.start[b], self.end[b] - self.start[b])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each place on; only where a row has k words from there."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.uint64)
        out = self.hash[: n - k + 1] * _PLACE[0]
        for j in range(1, k):
            out = out + self.hash[j : n - k + 1 + j] * _PLACE[j]
        return mix(out)

    def whole(self, k: int) -> np.ndarray:
        """Places from which on a row has k words."""
        n = len(self.row)
        return np.flatnonzero(self.row[: n - k + 1] == self.row[k - 1 :]) if n >= k else np.zeros(0, np.int64)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Each row's sorted distinct k-word shingles; of fewer words, all as one. Values and n + 1 offsets."""
        rows = len(self.count)
        short = np.flatnonzero((self.count > 0) & (self.count < k))
        per = np.maximum(self.count - (k - 1), 0)
        per[short] = 1
        at = np.zeros(rows + 1, np.int64)
        np.cumsum(per, out=at[1:])
        values = np.zeros(at[-1], np.uint64)
        is_short = np.zeros(at[-1], bool)
        is_short[at[short]] = True
        places = self.whole(k)
        values[~is_short] = self.grams(k)[places] if len(places) else 0
        for n in range(1, k):
            rows_n = short[self.count[short] == n]
            if len(rows_n):
                total = np.full(len(rows_n), n * 0x9FB21C651E98DF25 & _M64, np.uint64)
                for j in range(n):
                    total = total + self.hash[self.first[rows_n] + j] * _PLACE[j]
                values[at[rows_n]] = mix(total)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a > 1:
                values[a:b].sort()
        if not len(values):
            return values, at
        fresh = np.ones(len(values), bool)
        fresh[1:] = values[1:] != values[:-1]
        fresh[at[:-1][at[:-1] < len(values)]] = True
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(fresh, out=total[1:])
        return values[fresh], total[at]


class Hashes:
    """The word hashes of many texts without their bytes: what stays of ``Words`` over slices."""

    def __init__(self, texts: list[str], separators: np.ndarray) -> None:
        col = pa.array(texts, pa.string())
        hashes, counts = [], []
        for a, b in slices(col):
            w = Words(col.slice(a, b - a), separators)
            hashes.append(w.hash)
            counts.append(w.count)
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(self.count)), self.count)
        self.first = np.zeros(len(self.count) + 1, np.int64)
        np.cumsum(self.count, out=self.first[1:])

    grams, whole = Words.grams, Words.whole
