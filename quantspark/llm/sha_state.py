"""SHA-256 with its state in the open, over many messages at once.

``hashlib`` can copy a running hash but not store it.  Here a state is eight
32-bit words, so it fits a table column.  A digest as hex text is 64 bytes,
exactly one block: after whole digests a state has no pending bytes, and what
follows is one ``absorb`` per digest and one ``finish``.
"""

from __future__ import annotations

import math

import numpy as np


def _root_bits(x: int, power: int) -> int:
    """The first 32 bits of the fraction of the square (2) or cube (3) root of x."""
    scaled = x << (32 * power)
    root = math.isqrt(scaled) if power == 2 else round(scaled ** (1 / 3))
    while root**power > scaled:
        root -= 1
    while (root + 1)**power <= scaled:
        root += 1
    return root & 0xFFFFFFFF


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, math.isqrt(p) + 1))]
_ROUND = [np.uint32(_root_bits(p, 3)) for p in _PRIMES[:64]]
START = np.array([_root_bits(p, 2) for p in _PRIMES[:8]], dtype=np.uint32)
_HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def _block(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    """States (n x 8) after one more block of 16 words each (16 x n)."""
    w = list(words)
    a, b, c, d, e, f, g, h = (state[:, i] for i in range(8))
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[i - 7]
                     + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        t = (h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g)))) + (w[i] + _ROUND[i])
        u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h], axis=1)


def absorb(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """States (n x 8 words) after the hex text of one digest (n x 32 bytes) each."""
    text = np.empty((len(digests), 64), dtype=np.uint8)
    text[:, 0::2] = _HEX[digests >> 4]
    text[:, 1::2] = _HEX[digests & 15]
    return _block(state, np.ascontiguousarray(text.view(">u4").astype(np.uint32).T))


def finish(state: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Digests (n x 32 bytes) of messages that were ``count`` hex digests long."""
    words = np.zeros((16, len(state)), dtype=np.uint32)
    words[0] = 0x80000000
    bits = count.astype(np.uint64) * np.uint64(512)
    words[14], words[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return np.ascontiguousarray(_block(state, words).astype(">u4")).view(np.uint8)


def start(n: int) -> np.ndarray:
    return np.tile(START, (n, 1))
