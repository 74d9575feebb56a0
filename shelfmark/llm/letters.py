"""Letters of whole texts, lower-cased, computed on a batch at once."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa

from shelfmark.llm.tables import raw
from shelfmark.llm.words import U, mix, powers

_BASE = U(0x9DDFEA08EB382D6B)


@cache
def _folded() -> np.ndarray:
    """Lower-case code point of each letter (if it is one character), 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letters_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letters, first): code points of all texts with 0 for other characters, and where each text begins (one more)."""
    data, offsets = raw(texts)
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    begins = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each character
    return _folded()[points], np.searchsorted(begins, offsets)


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of letters, text number of each)."""
    letters, first = letters_of(texts)
    n = len(letters)
    inside = letters > 0
    opens = np.zeros(n + 1, bool)
    opens[first] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | opens[:n]))
    if not len(starts):
        return np.zeros(0, U), np.zeros(0, np.int64)
    text = np.searchsorted(first, starts, side="right") - 1
    # a run that ends where a text ends is cut there by the next start or by a 0
    span = np.diff(np.append(starts, n))
    place = np.arange(starts[0], n) - np.repeat(starts, span)
    tail = letters[starts[0] :].astype(U)
    longest = int(span.max())
    with np.errstate(over="ignore"):
        values = np.where(inside[starts[0] :], mix(tail, 5), U(0)) * powers(int(_BASE), longest + 1)[place]
        return mix(np.add.reduceat(values, starts - starts[0])), text
