"""Cutting texts at the matches of the public byte-level pattern, computed on a batch of texts at once.

The pattern has the alternatives: an apostrophe with s, t, re, ve, m, ll or d; letters, digits or other signs, each with
one leading space at most; white space that another white space or the end follows; white space. Letters, digits and
white space are Unicode classes. A match therefore ends where the class of the next character differs, with two
exceptions that are applied to those ends: the last white space before a sign, and the apostrophe endings.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa

from shelfmark.llm.tables import raw

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


# White_Space of Unicode (fixed values)
_SPACES = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@cache
def _classes() -> np.ndarray:
    """Class of each code point, by its general category."""
    kinds = {"L": _LETTER, "N": _DIGIT}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[list(_SPACES)] = _SPACE
    return out


def cut_pieces(texts: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """(pieces of all texts in order, for each text the index of its first piece and one more at the end)."""
    data, offsets = raw(texts)
    if not len(data):
        return [], np.zeros(len(texts) + 1, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    n = len(points)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    place = np.zeros(n + 1, np.int64)
    np.cumsum(width, out=place[1:])
    opens = np.zeros(n + 1, bool)  # a text begins here
    opens[np.searchsorted(place, offsets)] = True
    kind = _classes()[points]
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    start |= opens[:n]
    # the last white space before a sign of the same text
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~opens[1:n])
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    # apostrophe endings: a lone apostrophe at a start, then letters
    at = np.flatnonzero((points[:-1] == 0x27) & start[:-1] & (kind[1:] == _LETTER) & ~opens[1:n])
    if len(at):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[at + 1], padded[at + 2]
        same = ~opens[np.minimum(at + 2, n)]
        length = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
        for pair in ("re", "ve", "ll"):
            length[(one == ord(pair[0])) & (two == ord(pair[1])) & same] = 2
        at, length = at[length > 0], length[length > 0]
        start[at + 1] = False
        rest = at + 1 + length
        rest = rest[rest < n]
        rest = rest[(kind[rest] == _LETTER) & ~opens[rest]]
        start[rest] = True
    places = place[np.flatnonzero(start)]
    # the byte 255 is in no UTF-8 text
    return np.insert(data, places[1:], 255).tobytes().split(b"\xff"), np.searchsorted(places, offsets)
