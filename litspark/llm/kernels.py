"""Array kernels over the bytes of whole Arrow text columns.

Hashes are polynomials modulo the prime 2^61 - 1, taken from prefix sums and mixed, so that every
word, gram or span of a slice is hashed at a constant cost per symbol. Two different spans of n symbols
collide with a chance of n / 2^61, however regular they are: a polynomial of degree n has at most n
zeros there. Where equal hashes alone would decide, :func:`digests` compares the bytes themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes worked on at once; a longer document is a slice of its own.
SLICE = 1 << 18

U = np.uint64
PRIME = (1 << 61) - 1
P, LOW31, LOW30 = U(PRIME), U((1 << 31) - 1), U((1 << 30) - 1)
_fold = np.arange(256)
_fold[65:91] += 32
FOLD = _fold.astype(np.uint8)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_alpha = np.zeros(256, bool)
_alpha[65:91] = _alpha[97:123] = _alpha[128:] = True
NOT_LETTER = ~_alpha
_alnum = _alpha.copy()
_alnum[48:58] = True
NOT_ALNUM = ~_alnum


def reduce(x: np.ndarray) -> np.ndarray:
    """Modulo the prime, for any 64-bit numbers."""
    x = (x & P) + (x >> U(61))
    return np.where(x >= P, x - P, x)


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it, from halves of 31 bits."""
    ah, al, bh, bl = a >> U(31), a & LOW31, b >> U(31), b & LOW31
    mid = ah * bl + al * bh
    return reduce((ah * bh << U(1)) + (mid >> U(30)) + ((mid & LOW30) << U(31)) + al * bl)


class Powers:
    """Powers of a number and of its inverse modulo the prime, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, PRIME)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = getattr(self, name)
                setattr(self, name, np.concatenate([x, mulmod(x, np.full(m, pow(b, m, PRIME), np.uint64))]))
        return self.up[:n], self.down[:n]


P_BYTE = Powers(0x9E3779B97F4A7C1 % PRIME)
P_WORD = Powers(0x1342543DE82EF95 % PRIME)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows i to j of a string column: their bytes and the offsets of each. Nulls are empty."""
    column = column.fill_null("") if column.null_count else column
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    off = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1))
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def words(buf: np.ndarray, off: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each document's words begin among them."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~gap[buf]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    at = off[(off > 0) & (off < n)]
    first[at] = word[at]
    last[at - 1] = word[at - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def byte_sums(buf: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over at most 2^23 bytes: those of its high and of its low halves."""
    up = P_BYTE.get(len(buf))[0]
    v = buf.astype(np.uint64) + U(1)
    c = np.zeros((2, len(buf) + 1), np.uint64)
    np.cumsum(v * (up >> U(31)), out=c[0, 1:])
    np.cumsum(v * (up & LOW31), out=c[1, 1:])
    return c


def prefix(values: np.ndarray) -> np.ndarray:
    """The same over word hashes."""
    terms = mulmod(reduce(values), P_WORD.get(len(values))[0])
    c = np.zeros((2, len(values) + 1), np.uint64)
    np.cumsum(terms >> U(31), out=c[0, 1:])
    np.cumsum(terms & LOW31, out=c[1, 1:])
    return c


def span_hash(c: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    high, low = reduce(c[0][ends] - c[0][starts]), reduce(c[1][ends] - c[1][starts])
    whole = reduce((high >> U(30)) + ((high & LOW30) << U(31)) + low)
    return mix(mulmod(whole, powers.get(c.shape[1])[1][starts]))


def digests(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """BLAKE2 of each span's bytes, 128 bits: equal only for equal bytes, by any known means."""
    view = memoryview(np.ascontiguousarray(buf))
    make = hashlib.blake2b
    return [make(view[x:y], digest_size=16).digest() for x, y in zip(starts.tolist(), ends.tolist(), strict=True)]


#: Bytes that are hashed at once where a single document is longer; a longer word has a digest instead.
PIECE = 1 << 20


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hashes of spans that follow one another; of a long document, a piece of it at a time."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = len(starts) if len(buf) <= PIECE else max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        lo, hi = starts[i], ends[j - 1]
        part = FOLD[buf[lo:hi]] if fold else buf[lo:hi]
        if hi - lo > PIECE:
            out[i] = U(int.from_bytes(hashlib.blake2b(np.ascontiguousarray(part), digest_size=8).digest(), "little"))
        else:
            out[i:j] = span_hash(byte_sums(part), starts[i:j] - lo, ends[i:j] - lo, P_BYTE)
        i = j
    return out


def shingles(wh: np.ndarray, wo: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k-word shingle and each document's place among them. A document of fewer
    words has its whole sequence as its one shingle; without words it has none."""
    n = len(wh)
    c = prefix(wh)
    count = np.diff(wo)
    per = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    so = np.concatenate([[0], np.cumsum(per)])
    doc = np.repeat(np.arange(len(per)), per)
    start = wo[:-1][doc] + (np.arange(so[-1]) - so[:-1][doc])
    end = np.minimum(start + k, wo[1:][doc])
    return span_hash(c, start, np.minimum(end, n), P_WORD), so


def window_min(key: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbouring keys, at a constant cost per key."""
    n = len(key)
    if n < w:
        return np.zeros(0, key.dtype)
    padded = np.full(-(-n // w) * w, np.iinfo(key.dtype).max, key.dtype)
    padded[:n] = key
    rows = padded.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


_rng = np.random.Generator(np.random.PCG64(20240817))
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_ODD = 0x9E3779B97F4A7C15
_up = _down = np.zeros(0, np.uint64)


def byte_order(buf: np.ndarray, k: int) -> np.ndarray:
    """A number for each k-gram by which anchors are chosen: any function of its bytes serves, so this
    is a plain polynomial modulo 2^64. It decides no equality."""
    global _up, _down
    if len(_up) < len(buf):
        x = [np.full(max(len(buf), PIECE), b, np.uint64) for b in (_ODD, pow(_ODD, -1, 1 << 64))]
        for y in x:
            y[0] = 1
        _up, _down = (np.cumprod(y) for y in x)
    c = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_TABLE[buf] * _up[: len(buf)], out=c[1:])
    n = max(0, len(buf) - k + 1)
    return (c[k:] - c[:n]) * _down[:n]


def anchors(c: np.ndarray, off: np.ndarray, powers: Powers, window: int, k: int, order: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Winnowing: the k-gram that is the least of each window, and which windows choose it.

    ``c`` is the prefix sum over a slice of symbols, ``off`` the documents' offsets in it. A window of
    ``window`` symbols inside one document chooses the leftmost least of its k-grams by ``order``
    (by hash, without one), so equal windows choose the same at the same place. Windows that choose one follow one another. Returns
    the positions and hashes of the chosen, the first and the last window's start, and the document.
    """
    n = c.shape[1] - 1
    none = np.zeros(0, np.int64)
    if n < window:
        return none, np.zeros(0, np.uint64), none, none, none
    start = np.arange(n - k + 1)
    h = span_hash(c, start, start + k, powers) if order is None else order
    bits = U(max(26, int(n).bit_length()))  # alike in all slices: ties in the rest go to the leftmost
    least = window_min((h >> bits << bits) | start.astype(np.uint64), window - k + 1)
    at = (least & ((U(1) << bits) - U(1))).astype(np.int64)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(at)]
    inside = np.flatnonzero(np.arange(len(at)) + window <= off[doc + 1])
    at = at[inside]
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else none
    pos = at[new]
    return pos, span_hash(c, pos, pos + k, powers), inside[new], inside[np.append(new[1:], len(at)) - 1], doc[inside[new]]
