"""Words and word shingles of whole texts as 64-bit hashes, in numpy."""

from __future__ import annotations

from functools import cache

import numpy as np

_RNG = np.random.default_rng(20)
_LETTERS = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(1, 2**62)) * 4 + 1
_PLACES = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LEAST = 1 << 19


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, pow(_BASE, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and where each text's words begin (one more at the end)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    buffer = np.frombuffer(b"\n".join([b"", *raw, b""]).lower(), np.uint8)
    size = _LEAST
    while size < len(buffer) + 1:
        size *= 2
    up, down = _powers(size)
    gap = _SPACE[buffer]
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    total = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_LETTERS[buffer] * up[: len(buffer)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    begins = np.cumsum([1, *(len(r) + 1 for r in raw)])
    return hashes, np.searchsorted(starts, begins)


def shingles(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each text, in order and with repeats, and their bounds.

    A text of fewer words, but not none, has one shingle: all of them.
    """
    words, bounds = word_hashes(texts)
    count = np.diff(bounds)
    sizes = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    out_bounds = np.concatenate([[0], np.cumsum(sizes)])
    first = np.repeat(bounds[:-1], sizes) + np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], sizes)
    length = np.repeat(np.minimum(count, k), sizes)
    out = length.astype(np.uint64) * _PLACES[-1]
    for j in range(k):
        inside = length > j
        out[inside] += words[first[inside] + j] * _PLACES[j]
    return mix(out), out_bounds
