"""Hashes of the words or chunks of many texts at once, in numpy.

A word's hash is a polynomial of its bytes modulo 2**64, taken from running sums over the whole
buffer; long words, for which such sums say less, get XXH3.
"""

from __future__ import annotations

import numpy as np
import xxhash

# Bytes hashed at once, and the length from which a word has a hash of another kind.
_CHUNK = 1 << 19
_LONG = 64
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_U = np.uint64
_MIX = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))
_BASES = (0x5851F42D4C957F2D, 0x14057B7EF767814F)


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    def run(b: int) -> np.ndarray:
        steps = np.full(_CHUNK + 1, b, _U)
        steps[0] = 1
        return np.cumprod(steps)

    return run(base), run(pow(base, -1, 1 << 64))


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def mixed(x: np.ndarray, lane: int) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _MIX[lane]
    return x ^ (x >> _U(29))


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end in UTF-8 bytes; the blanks are the six ASCII ones."""
    seen = np.zeros(len(data) + 2, np.int8)
    seen[1:-1] = ~_BLANK[data]
    steps = np.diff(seen)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lanes: int = 2) -> np.ndarray:
    """64 bits for each word in each lane: polynomials of its bytes, or XXH3 of a long word."""
    if not _tables:
        _tables.extend(map(_powers, _BASES))
    out = np.zeros((lanes, len(starts)), _U)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + _CHUNK, side="right")))
        if ends[to - 1] - low <= _CHUNK:
            part = data[low : ends[to - 1]].astype(_U) + _U(1)
            first, last = starts[at:to] - low, ends[at:to] - low
            sums = np.zeros(len(part) + 1, _U)
            for lane, (powers, inverses) in enumerate(_tables[:lanes]):
                np.cumsum(part * powers[: len(part)], out=sums[1:])
                out[lane, at:to] = (sums[last] - sums[first]) * inverses[first]
        at = to
    lengths = ends - starts
    for lane in range(lanes):
        out[lane] = mixed(out[lane] + lengths.astype(_U) * _MIX[1 - lane], lane)
    for k in np.flatnonzero(lengths > _LONG).tolist():
        digest = xxhash.xxh3_128_intdigest(data[starts[k] : ends[k]].tobytes())
        out[:, k] = [digest >> 64, digest & (1 << 64) - 1][:lanes]
    return out
