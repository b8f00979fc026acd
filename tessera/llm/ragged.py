"""Ragged arrays over Arrow string columns, and the hashing that the operators share.

A column becomes one uint8 array and an int64 offsets array; nulls are empty
strings. Work is done on slices of a few megabytes of text, so that a task's
memory depends on the slice and the longest single text, not on its partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Text bytes that are worked on at a time.
SLICE_BYTES = 1 << 20
#: The hashes' modulus, a prime, and their base. The base is fixed, as some hashes are
#: compared between tasks; who takes equal hashes for equal strings compares bytes too.
PRIME = (1 << 61) - 1
_BASE = 0x1B873593CC9E2D51 % PRIME
_P, _LOW31, _LOW30 = U64(PRIME), U64((1 << 31) - 1), U64((1 << 30) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit over all others."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: A pseudo-random number of 31 bits for each byte value.
BYTE_CODE = (mix((np.arange(256, dtype=U64) + U64(1)) * U64(0xD1342543DE82EF95)) >> U64(33)) | U64(1)


def _folded(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for any x below 2**64."""
    x = (x & _P) + (x >> U64(61))
    return np.where(x >= _P, x - _P, x)


#: Numbers that are multiplied at a time, so that they stay in a processor's cache.
_STEP = 1 << 14


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it, by halves of 31 bits."""
    a, b = np.broadcast_arrays(np.asarray(a, U64), np.asarray(b, U64))
    out = np.empty(a.shape, U64)
    for lo in range(0, len(a), _STEP):
        x, y = a[lo : lo + _STEP], b[lo : lo + _STEP]
        x1, x0, y1, y0 = x >> U64(31), x & _LOW31, y >> U64(31), y & _LOW31
        mid = x1 * y0
        mid += x0 * y1
        x1 *= y1
        x1 <<= U64(1)
        x1 += mid >> U64(30)
        mid &= _LOW30
        mid <<= U64(31)
        x1 += mid
        x0 *= y0
        # Each part is below 2**63; folded once, their sum is below 2**63 too.
        out[lo : lo + _STEP] = _folded(((x1 & _P) + (x1 >> U64(61))) + ((x0 & _P) + (x0 >> U64(61))))
    return out


_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U64), np.ones(1, U64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 (at least) of the base and of its inverse modulo the prime."""
    global _powers
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, pow(_BASE, -1, PRIME)):
            a, have = np.ones(max(n, 1 << 16), U64), 1
            while have < len(a):
                more = min(have, len(a) - have)
                a[have : have + more] = times(a[:more], U64(pow(base, have, PRIME)))
                have += more
            made.append(a)
        _powers = (made[0], made[1])
    return _powers


def prefix_of(codes: np.ndarray) -> np.ndarray:
    """Prefix sums, modulo the prime, of a polynomial hash of codes below it."""
    out = np.zeros(len(codes) + 1, U64)
    power, before = powers(len(codes))[0], U64(0)
    for lo in range(0, len(codes), _STEP):
        terms = times(codes[lo : lo + _STEP], power[lo : lo + min(_STEP, len(codes) - lo)])
        low = np.cumsum(terms & _LOW31)
        terms >>= U64(31)
        high = np.cumsum(terms)
        low += high >> U64(30)
        high &= _LOW30
        high <<= U64(31)
        low += high
        low += before
        part = out[lo + 1 : lo + 1 + len(low)]
        part[:] = _folded(low)
        before = part[-1]
    return out


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the hash of bytes; ``span_hash`` takes differences of them."""
    return prefix_of(np.take(BYTE_CODE, data))


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], the same wherever the span stands; never 0."""
    out, inverse = np.empty(len(start), U64), powers(len(prefix))[1]
    for lo in range(0, len(start), _STEP):
        a, b = start[lo : lo + _STEP], end[lo : lo + _STEP]
        h = prefix[b]
        h += _P - prefix[a]
        h = times(_folded(h), inverse[a])
        h += (b - a).astype(U64) * U64(0xA0761D6478BD642F)
        out[lo : lo + _STEP] = mix(h)
    out[out == 0] = 1
    return out


def numbered(data: np.ndarray, start: np.ndarray, end: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """A number for each span, the same for equal bytes only: grouped by hash, compared by bytes."""
    if not len(start):
        return np.zeros(0, np.int64)
    _, one, number = np.unique(span_hash(prefix, start, end), return_index=True, return_inverse=True)
    odd = differing(data, start, end - start, data, start[one][number], (end - start)[one][number])
    if len(odd):
        named: dict[tuple[int, bytes], int] = {}
        for i in odd.tolist():
            number[i] = named.setdefault((int(number[i]), data[start[i] : end[i]].tobytes()), len(one) + len(named))
    return number


def differing(a: np.ndarray, a_start: np.ndarray, a_length: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_length: np.ndarray) -> np.ndarray:
    """Which spans of a and b are not equal, byte by byte."""
    out = a_length != b_length
    same = np.flatnonzero(~out & (a_length > 0))
    step = 1 << 14
    for lo in range(0, len(same), step):
        part = same[lo : lo + step]
        ours, off = take_ragged(a, a_start[part], a_length[part])
        theirs, _ = take_ragged(b, b_start[part], b_length[part])
        unlike = ours != theirs
        if unlike.any():
            out[part[np.logical_or.reduceat(unlike, off[:-1])]] = True
    return np.flatnonzero(out)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type not in (pa.large_string(), pa.large_binary()):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_large_binary(column.type) else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return flat, off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) with at most ``limit`` bytes, or a single row."""
    for batch in batches:
        data, off = utf8(batch.column(batch.schema.get_field_index(column)))
        i, n = 0, batch.num_rows
        while i < n:
            j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
            j = min(n, max(i + 1, j), i + 20_000)
            yield batch.slice(i, j - i), data[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: a worker outlives its task, and waits beside those of other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def spread(lengths: np.ndarray) -> np.ndarray:
    """Offsets of runs with these lengths."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def per_run(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values over the runs that start at first[:-1] and end at first[1:]."""
    total = spread(values)
    return total[first[1:]] - total[first[:-1]]


def take_ragged(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs data[start:start+length] one after the other, and their offsets."""
    off = spread(length)
    idx = np.arange(off[-1], dtype=np.int64)
    idx += np.repeat(np.asarray(start, np.int64) - off[:-1], length)
    return data[idx], off


class HashIndex:
    """Vectorised open addressing from non-zero 64-bit keys to int32 values."""

    def __init__(self, bits: int = 12) -> None:
        self.bits, self.n = bits, 0
        self.keys, self.vals = np.zeros(1 << bits, U64), np.full(1 << bits, -1, np.int32)

    def _slots(self, h: np.ndarray) -> np.ndarray:
        return (h >> U64(64 - self.bits)).astype(np.int64)

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """The value of each key; -1 if there is none."""
        slot, mask = self._slots(h), (1 << self.bits) - 1
        key = self.keys[slot]
        out = np.where(key == h, self.vals[slot], np.int32(-1))
        left = np.flatnonzero((key != h) & (key != 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & mask
            key, want = self.keys[slot], h[left]
            hit = key == want
            out[left[hit]] = self.vals[slot[hit]]
            go = ~hit & (key != 0)
            left, slot = left[go], slot[go]
        return out

    def insert(self, h: np.ndarray, vals: np.ndarray) -> None:
        """Adds keys that differ from each other and from those held."""
        while (self.n + len(h)) * 2 > 1 << self.bits:
            held = self.keys != 0
            keys, old = self.keys[held], self.vals[held]
            self.__init__(self.bits + 1)
            self._place(keys, old)
        self._place(h, vals)

    def _place(self, h: np.ndarray, vals: np.ndarray) -> None:
        self.n += len(h)
        slot, mask, vals = self._slots(h), (1 << self.bits) - 1, np.asarray(vals, np.int32)
        while len(h):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = h[free]
            done = free & (self.keys[slot] == h)
            self.vals[slot[done]] = vals[done]
            h, vals, slot = h[~done], vals[~done], (slot[~done] + 1) & mask
