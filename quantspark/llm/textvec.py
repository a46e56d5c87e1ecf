"""Whole-column text work in numpy on Arrow string buffers: word spans and 64-bit hashes.

No Python object is made per word.  Words are maximal runs of bytes that are
not ASCII white space, so spans never cut a UTF-8 sequence.  A word's hash is
a polynomial over 2^64 of random byte values, taken from prefix sums; long
inputs are cut at word borders so that working memory stays bounded.
"""

from __future__ import annotations

import numpy as np

CHUNK_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
U64 = np.uint64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finalising bijection on 64-bit values (multiply, xor-shift)."""
    x = np.atleast_1d(np.asarray(x, dtype=U64)) + U64(seed * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(256, dtype=U64), 7) | U64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def arrow_text(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; nulls are empty texts."""
    import pyarrow as pa
    column = column.cast(pa.large_string()).fill_null("")
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = 1 << 20):
    """Runs of rows [a, b) with about ``limit`` bytes each (one row at least)."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + limit, "right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words."""
    n = len(buf)
    if n == 0:
        e = np.zeros(0, dtype=np.int64)
        return e, e, e
    word = ~_SPACE[buf]
    head = np.zeros(n, dtype=bool)
    head[offs[:-1][offs[:-1] < n]] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | head[1:]
    stop = word
    stop[:-1] &= ~word[1:] | head[1:]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


class _Cache(dict):
    """Per-process memo: it travels empty when a task's function is pickled."""

    def __reduce__(self):
        return _Cache, ()


_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = _Cache()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse.  A worker keeps one table, the longest so far."""
    kept = _POWERS.get("longest")
    if kept is not None and len(kept[0]) >= n:
        return kept
    size = 1 << max(16, (n - 1).bit_length())
    inverse = pow(BASE, -1, 1 << 64)
    made = []
    for b in (BASE, inverse):
        p = np.full(size, b, dtype=U64)
        p[0] = 1
        made.append(np.cumprod(p, dtype=U64))
    if size <= 8 * CHUNK_BYTES:  # a giant word's is not kept
        _POWERS["longest"] = (made[0], made[1])
    return made[0], made[1]


def released(run):
    """``run`` (batches -> batches), after which the worker gives the memory it has freed back to the system:
    Spark hands the process on to the tasks of later stages, each of which would add its own peak."""
    def task(batches):
        yield from run(batches)
        release()

    return task


def release() -> None:
    """Freed memory that the Arrow pool and the C library hold goes back to the system."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span; spans ascend by start.  A-Z count as a-z if ``lower``."""
    out = np.empty(len(starts), dtype=U64)
    values = _LOWER if lower else _BYTE
    a, n = 0, len(starts)
    while a < n:
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + CHUNK_BYTES, "left")))
        lo, hi = int(starts[a]), int(ends[a:b].max())
        pw, inv = _powers(hi - lo + 1)
        acc = np.empty(hi - lo + 1, dtype=U64)
        acc[0] = 0
        np.cumsum(values[buf[lo:hi]] * pw[:hi - lo], out=acc[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = mix((acc[e] - acc[s]) * inv[s] + (e - s).astype(U64))
        a = b
    return out
