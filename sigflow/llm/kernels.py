"""Vectorised text kernels (numpy) used inside Arrow tasks.

A batch of texts is one byte buffer with row offsets; all kernels work on the
whole buffer, so small texts cost no Python loop. Hashes are 64-bit and
depend on content only, never on the process, the batch or the platform.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
LONG_WORD = 64  # bytes; longer words are hashed one by one
_M1, _M2 = U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(32))
    x *= _M1
    x ^= x >> U(29)
    x *= _M2
    x ^= x >> U(32)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U) * U(_BASE)) | U(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64; grows with the longest buffer seen."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=U)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial hash: entry i covers the first i bytes."""
    out = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum(_BYTE[buf] * powers(_BASE, len(buf)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range ``[start, end)``, equal for equal content."""
    return mix((prefix[end] - prefix[start]) * powers(_INVERSE, len(prefix))[start] + (end - start).astype(U))


def word_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word, the byte range ``[start, end)``, equal for equal words.

    Eight bytes at a time go through a scrambling that no arithmetic on the bytes
    undoes, so regular words don't collide as they do under :func:`range_hash`,
    whose polynomial modulo a power of two has known collisions from 1,024 bytes
    on. Up to eight bytes, words of one length never collide.
    """
    n = ends - starts
    out = mix((n + 1).astype(U) * U(_BASE))
    padded = np.concatenate((buf, np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray(len(buf) + 1, dtype="<u8", buffer=padded.data, strides=(1,))
    kept = (U(1) << (U(8) * np.arange(8, dtype=U))) - U(1)
    live, done = np.flatnonzero(n <= LONG_WORD), 0
    while len(live):
        left = n[live] - done
        part = eight[starts[live] + done]
        tail = left < 8
        part[tail] &= kept[left[tail]]
        out[live] = mix(out[live] ^ part)
        live, done = live[left > 8], done + 8
    for i in np.flatnonzero(n > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(buf[starts[i] : ends[i]].tobytes())
    return out


def gram_hash(prefix: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` bytes."""
    n = len(prefix) - k
    return mix((prefix[k:] - prefix[:-k]) * powers(_INVERSE, len(prefix))[:n]) if n > 0 else np.zeros(0, dtype=U)


def sequence_hash(units: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive unit hashes."""
    n = len(units) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    acc = units[:n].copy()
    for t in range(1, k):
        acc *= U(_BASE)
        acc += units[t : t + n]
    return mix(acc)


def word_bounds(buf: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of every word; a word never crosses into the next row."""
    solid = ~IS_SPACE[buf]
    before = np.concatenate(([False], solid[:-1])) if len(solid) else solid
    after = np.concatenate((solid[1:], [False])) if len(solid) else solid.copy()
    cut = row_starts[(row_starts > 0) & (row_starts < len(buf))]
    before[cut] = False
    after[cut - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(row_starts, starts, side="right") - 1


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes unchanged."""
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` consecutive grams, the position of the
    selected one: the smallest hash, leftmost on ties. A function of the
    window's content alone, so equal windows select the same gram."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    low = (grams & U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U)
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    return (low & U(0xFFFFFFFF)).astype(np.int64)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string or binary column (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give memory that is no longer used back to the machine: a worker lives on with
    its next tasks, and what its allocators keep would count against the executor."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``start .. start+count-1`` for each pair."""
    counts = counts.astype(np.int64)
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - counts), counts)


def binary_column(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Arrow binary column of the byte ranges ``[start, end)``."""
    lengths = ends - starts
    data = buf[ranges(starts, lengths)] if len(starts) else np.zeros(0, dtype=np.uint8)
    offs = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    out = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(data.tobytes())]
    )
    return out.cast(pa.binary())
