"""Vectorised text primitives on Arrow string buffers (used inside tasks, one batch at a time).

A batch of texts is one UTF-8 byte array plus row offsets; words, word hashes and word shingles are
computed for the whole batch with numpy, without a Python string per text. A word is a maximal run of
bytes other than space, tab, LF, VT, FF and CR.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 18        # numpy works on about this much text at a time (a longer text stands alone)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, np.ndarray] = {}


def utf8_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type)
    _, off, data = arr.buffers()
    if len(arr) == 0 or off is None:
        return np.empty(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(arr: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past-last row, bytes, offsets) in pieces of about ``limit`` bytes."""
    data, off = utf8_buffers(arr)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def lower(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and the two-byte Latin-1 capitals."""
    out = _LOWER[data]
    if len(out) > 1:
        up = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[1:][up] += 0x20
    return out


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
        return h ^ (h >> U(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept and grown per process)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            have = np.concatenate([np.ones(1, U), np.cumprod(np.full(size - 1, base, U), dtype=U)])
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word starts, word ends, per-row word offsets)."""
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    if len(data):
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        inner = off[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        first[inner] = solid[inner]
        last[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each byte range (equal bytes, equal hash)."""
    n = len(data)
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, U)
        np.cumsum((data.astype(U) + U(1)) * powers(n), out=prefix[1:])
        return mix64((prefix[ends] - prefix[starts]) * powers(n + 1, inverse)[starts])


def shingle_hashes(data: np.ndarray, off: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, per-row offsets) of every run of ``width`` lower-cased words; a text of fewer (but some)
    words has one shingle of all of them, a text without words has none."""
    data = lower(data)
    starts, ends, woff = word_bounds(data, off)
    words = range_hashes(data, starts, ends)
    count = np.diff(woff)
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    soff = np.concatenate([[0], np.cumsum(n)])
    if not soff[-1]:
        return np.empty(0, U), soff
    row = np.repeat(np.arange(len(n)), n)
    at = woff[:-1][row] + np.arange(soff[-1]) - soff[:-1][row]
    size = np.minimum(count, width)[row]
    with np.errstate(over="ignore"):
        h = size.astype(U)
        for j in range(width):
            more = j < size
            h = np.where(more, h * U(0xD6E8FEB86659FD93) + words[np.minimum(at + j, len(words) - 1)], h)
    return mix64(h), soff


def unique_per_row(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values of each row: (values, row offsets, multiplicities)."""
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(v)))
    return v[at], np.searchsorted(r[at], np.arange(len(off))), times
