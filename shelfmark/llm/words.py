"""Words of whole texts and their hashes, computed on the bytes of a batch at once.

A word is a run of bytes other than the space and the bytes 9 to 13; texts are UTF-8, so no character is cut. Hashes
have 64 bits. Arithmetic is modulo 2**64 throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from shelfmark.llm.tables import raw

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = U(0x9DDFEA08EB382D69)
_STEP = 0xC2B2AE3D27D4EB4F


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64 finaliser), one for each seed."""
    with np.errstate(over="ignore"):
        x = x.astype(U, copy=True)
        x += U((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x ^= x >> U(30)
        x *= U(0xBF58476D1CE4E5B9)
        x ^= x >> U(27)
        x *= U(0x94D049BB133111EB)
        x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(256), 7)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... (n values)."""
    out = np.full(n, base, U)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


@dataclass
class Words:
    """Words of several texts: byte ranges, hashes, and for each text the index of its first word (one more at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of each text; ``lower`` folds A-Z before hashing."""
    data, offsets = raw(texts)
    n = len(data)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(data, starts, ends, np.zeros(0, U), first)
    folded = _LOWER[data] if lower else data
    values = np.where(inside, _BYTE[folded], U(0))
    span = np.diff(np.append(starts, n))
    place = np.arange(starts[0], n) - np.repeat(starts, span)
    longest = int((ends - starts).max())
    with np.errstate(over="ignore"):
        values = values[starts[0] :] * powers(int(_BASE), longest + 1)[np.minimum(place, longest)]
        hashes = np.add.reduceat(values, starts - starts[0])
    return Words(data, starts, ends, mix(hashes + (ends - starts).astype(U)), first)


def window_hashes(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words (texts not yet told apart); empty when there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        if width <= 8:
            out = np.zeros(n, U)
            for j in range(width):
                out = out * U(_STEP) + hashes[j : j + n]
        else:
            total = np.zeros(len(hashes) + 1, U)
            np.cumsum(mix(hashes, seed) * powers(_STEP, len(hashes)), out=total[1:])
            out = (total[width:] - total[:-width]) * powers(pow(_STEP, -1, 2**64), n)
    return mix(out, seed + width)
