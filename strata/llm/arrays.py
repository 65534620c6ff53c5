"""Words and shingles of Arrow text batches as flat numpy arrays.

Texts are read as UTF-8 bytes. A word is a run of bytes other than space and
0x09-0x0D; ``A``-``Z`` count as ``a``-``z`` unless asked otherwise. Null texts
have no words. Work goes in slices of a few MB so that the memory of a task
does not depend on the size of its partition; one text is never cut.

Word and shingle identities are 64-bit hashes, equal for equal byte strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_SEP = np.zeros(256, dtype=bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (xor-shift-multiply)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    def run(b: int) -> np.ndarray:
        p = np.full(size, _U(b))
        p[0] = _U(1)
        return np.cumprod(p, dtype=_U)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def _sized(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(SLICE_BYTES, 1 << (size - 1).bit_length() if size else 1))


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array, and its ``len + 1`` offsets; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not (pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type)):
        arr = arr.cast(pa.binary()).cast(pa.large_binary())
    if arr.null_count:
        arr = arr.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


@dataclass
class Words:
    """Words of a few texts: byte range and hash of each, and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True, kinds: np.ndarray | None = None) -> Words:
    """Words of texts given as bytes and offsets (see :func:`text_bytes`).

    With ``kinds`` (a number for each byte value) words are also cut between a
    byte of kind 1 and one of kind 2, in either order.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64), none.astype(_U))
    sep = _SEP[data]
    cut = np.zeros(n - 1, dtype=bool)
    if kinds is not None:
        kind = kinds[data]
        cut = kind[:-1] + kind[1:] == 3
    full = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    edge = np.empty(n, dtype=bool)
    edge[0], edge[1:] = True, sep[:-1] | cut
    edge[first] = True
    starts = np.flatnonzero(edge & ~sep)
    edge[-1], edge[:-1] = True, sep[1:] | cut
    edge[last] = True
    ends = np.flatnonzero(edge & ~sep) + 1
    up, down = _sized(n)
    sums = np.empty(n + 1, dtype=_U)
    sums[0] = 0
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * up[:n], dtype=_U, out=sums[1:])
    return Words(data, starts, ends, np.searchsorted(starts, offsets), mix((sums[ends] - sums[starts]) * down[starts]))


def batches_of_words(arr: pa.Array, lower: bool = True) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of slices of an Arrow text column."""
    data, offsets = text_bytes(arr)
    for a, b in row_slices(offsets):
        o = offsets[a:b + 1]
        yield a, b, words_of(data[o[0]:o[-1]], o - o[0], lower)


def _length_seed(n: int) -> np.uint64:
    return _U(n * 0xA0761D6478BD642F & _MASK)


def _chained(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive entries."""
    size = len(h) - n + 1
    out = np.full(size, _length_seed(n))
    for j in range(n):
        out = mix(out + h[j:j + size])
    return out


def runs_of(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of ``n`` words inside one text."""
    h, o = words.hashes, words.offsets
    if len(h) < n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    ok = np.ones(len(h) - n + 1, dtype=bool)
    for j in range(1, n):
        cut = o[1:-1] - j
        ok[cut[(cut >= 0) & (cut < len(ok)) & (o[1:-1] > 0)]] = False
    at = np.flatnonzero(ok)
    return _chained(h, n)[at], at


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of each text, sorted, flat, and their offsets.

    A text of fewer words has its whole sequence as the one shingle; a text
    without words has none.
    """
    h, at = runs_of(words, n)
    row = np.searchsorted(words.offsets, at, side="right") - 1
    count = np.diff(words.offsets)
    for size in range(1, n):
        few = np.flatnonzero(count == size)
        if len(few):
            short = np.full(len(few), _length_seed(size))
            for j in range(size):
                short = mix(short + words.hashes[words.offsets[few] + j])
            h, row = np.concatenate([h, short]), np.concatenate([row, few])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(count) + 1))


def sums_by_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's values (modulo 2**64 for unsigned ones); 0 for empty rows."""
    total = np.zeros(len(values) + 1, dtype=values.dtype)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark longs, bit for bit."""
    return x.view(np.int64)


def shared_counts(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Size of the intersection of row ``i`` of two lists of sorted sets."""
    (a, ao), (b, bo) = left, right
    n = len(ao) - 1
    row = np.concatenate([np.repeat(np.arange(n), np.diff(ao)), np.repeat(np.arange(n), np.diff(bo))])
    both = np.concatenate([a, b])
    order = np.lexsort((both, row))
    both, row = both[order], row[order]
    twice = (both[1:] == both[:-1]) & (row[1:] == row[:-1])
    return np.bincount(row[1:][twice], minlength=n)
