"""Whole Arrow batches of texts as NumPy arrays: words, their hashes, word shingles and rolling hashes.

Words are told apart by two lanes of 64 bits and their length: the bytes themselves for words of up to 16 bytes, and the
128 bits of XXH3 for longer ones. A word's hash mixes both lanes. Rolling hashes are a polynomial modulo 2**64, which some regular strings
share; they only choose where something is cut, and decide nothing about equality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 2**64 - 1, 64, dtype=np.uint64) | np.uint64(1)
_R = int(_rng.integers(1, 2**63 - 1)) | 5
_R_INVERSE = pow(_R, -1, 2**64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(texts: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows) of pieces of about `most` bytes; null
    counts as empty. A text is never cut."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if n else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def rolling(data: np.ndarray) -> np.ndarray:
    """Sums s, one longer than data, such that (s[e] - s[b]) * inverse_power(b) is the hash of data[b:e]."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_R, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = _power(_R_INVERSE, len(sums))
    return mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * _PLACE[63])


#: Keeps the lowest n bytes of a lane.
_LOW = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def word_lanes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two lanes of each span of bytes."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    at = np.ndarray(len(data) + 9, "<u8", padded, 0, (1,))  # eight bytes from each place
    size = end - begin
    one = at[begin] & _LOW[np.minimum(size, 8)]
    two = at[np.minimum(begin + 8, len(data))] & _LOW[np.clip(size - 8, 0, 8)]
    long = np.flatnonzero(size > 16)
    if len(long):
        view, half = memoryview(padded), (1 << 64) - 1
        digests = [xxhash.xxh3_128_intdigest(view[b:e]) for b, e in zip(begin[long].tolist(), end[long].tolist(), strict=True)]
        one[long] = np.array([d & half for d in digests], np.uint64)
        two[long] = np.array([d >> 64 for d in digests], np.uint64)
    return one, two


def word_hash(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of each span of bytes; those of up to 8 bytes never meet one another."""
    one, two = word_lanes(data, begin, end)
    size = (end - begin).astype(np.uint64)
    return mix(mix(one + size * _PLACE[62]) + mix(two * _PLACE[61] + np.where(size > np.uint64(8), size, np.uint64(0))))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the words, and for each row (and after the last) its first word's number."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~_IS_BLANK[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    begins = np.flatnonzero(begin)
    return begins, np.flatnonzero(end) + 1, np.searchsorted(begins, offsets)


def word_shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its runs of `width` words; of fewer words, one hash of
    them all; of none, nothing."""
    data = LOWER[data]
    begins, ends, first = words(data, offsets)
    hashes = word_hash(data, begins, ends)
    n = len(hashes)
    runs = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width):
        runs += hashes[j : n - width + 1 + j] * _PLACE[j] if n >= width else runs
    runs = mix(runs)
    out = []
    for i in range(len(offsets) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            found = np.sort(runs[a : b - width + 1])
            keep = np.ones(len(found), bool)
            keep[1:] = found[1:] != found[:-1]
            out.append(found[keep])
        elif b > a:
            out.append(mix((hashes[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
