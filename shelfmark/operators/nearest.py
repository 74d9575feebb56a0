"""The best partner by a weighted sum of three text similarities, complete, without a row for each pair.

So low a sum is enough that a partner's name may share no run of characters with the asked one: no key of a join finds all
partners, and a key as short as a character joins everything with everything. The asked rows are therefore compared with the
offered ones in tiles of bounded size, and each tile settles its pairs by bounds that get tighter and dearer: bags of
characters (a matrix product), common subsequences (bit vectors), and the exact ratio, in falling order of the bound and only
while it can still beat the best pair found. A tile returns one row for each asked row at most, so what is shuffled are the
two tables, once for each block of the other, and never pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import common
from shelfmark.session import cut_lineage

# Most rows of a tile on either side, and least number of blocks of a side; rows of the left side and pairs handled at once.
TILE = 16384
BLOCKS = 8
STRIP = 512
PAIRS = 500_000


class Side:
    """The three texts of the rows of a tile: name, titles (some for each row), author."""

    def __init__(self, names: list[str], titles: list[list[str]], authors: list[str], alphabet: dict[str, int]):
        self.fields = [common.Texts(x, alphabet) for x in (names, *map(list, zip(*titles)), authors)]
        self.counts = [x.counts() for x in self.fields]


def _survivors(left: Side, right: Side, strip: slice, weights: Sequence[float], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of the strip, right row) whose bags of characters allow the sum."""
    a, b = common.unary(left.counts[0][strip], right.counts[0])
    names = common.bound(a @ b.T, left.fields[0].lengths[strip], right.fields[0].lengths)
    near = names >= (least - weights[1] - weights[2]) / weights[0] - 1e-4
    # only rows and columns with a name that is near enough go on
    i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if not len(i):
        return i, j
    total, title, last = names[np.ix_(i, j)] * np.float32(weights[0]), None, len(right.fields) - 1
    for k in range(1, last + 1):
        own = 2 if k == last else 1
        a, b = common.unary(left.counts[own][strip][i], right.counts[k][j])
        part = common.bound(a @ b.T, left.fields[own].lengths[strip][i], right.fields[k].lengths[j])
        if k < last:
            title = part if title is None else np.maximum(title, part, out=title)
    total += title * np.float32(weights[1])
    total += part * np.float32(weights[2])
    rows, columns = np.nonzero(total >= least - 1e-4)
    return i[rows], j[columns]


def best_in_tile(left: Side, right: Side, order: list, weights: Sequence[float], least: float) -> tuple[list[tuple[int, float, int]], int]:
    """((left row, best sum, right row), number of pairs that the exact ratio decided); ties go to the first in ``order``.

    ``left`` has one title per row.
    """
    out, decided = [], 0
    codes = [x.codes() for x in right.fields]
    last = len(right.fields) - 1
    for begin in range(0, len(left.fields[0].texts), STRIP):
        strip = slice(begin, begin + STRIP)
        i, j = _survivors(left, right, strip, weights, least)
        if not len(i):
            continue
        matches = [common.Texts(x.texts[strip], x.alphabet).matches() for x in left.fields]
        sums = []
        for at in range(0, len(i), PAIRS):
            x, y = i[at : at + PAIRS], j[at : at + PAIRS]
            title = np.zeros(len(x))
            for k, field in enumerate(right.fields):
                own = 0 if k == 0 else 2 if k == last else 1
                n, m = left.fields[own].lengths[strip][x], field.lengths[y]
                short = (n <= common.WORD) & (m <= common.WORD)
                shared = np.minimum(n, m)
                shared[short] = common.subsequences(matches[own], codes[k], left.fields[own].lengths[strip], x[short], y[short])
                part = common.bound(shared, n, m)
                if k == 0:
                    total = weights[0] * part
                elif k == last:
                    total = total + weights[1] * title + weights[2] * part
                else:
                    title = np.maximum(title, part)
            sums.append(total)
        sums = np.concatenate(sums)
        keep = np.flatnonzero(sums >= least - 1e-9)
        keep = keep[np.lexsort((-sums[keep], i[keep]))]
        best: dict[int, tuple[float, object, int]] = {}
        for row, other, most in zip(i[keep].tolist(), j[keep].tolist(), sums[keep].tolist()):
            if row in best and most < -best[row][0] - 1e-9:
                continue
            decided += 1
            mine, theirs = [x.texts[begin + row] for x in left.fields], [x.texts[other] for x in right.fields]
            points = (
                weights[0] * common.exact(theirs[0], mine[0])
                + weights[1] * max(common.exact(t, mine[1]) for t in theirs[1:-1])
                + weights[2] * common.exact(theirs[-1], mine[2])
            )
            found = (-points, order[other], other)
            if points >= least and (row not in best or found < best[row]):
                best[row] = found
        out += [(begin + row, -neg, other) for row, (neg, _, other) in best.items()]
    return out, decided


def best_by_points(asked: DataFrame, offered: DataFrame, weights: Sequence[float], least: float) -> DataFrame:
    """(a, s, f, points, book_order, name): for each asked (a, s, f) the offered row with the largest sum from ``least`` on.

    ``asked``: distinct texts a (author), s (name), f (title). ``offered``: ba, bs, ts (array of titles), book_order, name.
    The sum is weights[0] * similarity of the names + weights[1] * best similarity of a title + weights[2] * similarity of the
    authors; equal sums go to the smaller book_order, then name. Asked rows without a partner are left out. Runs jobs.
    """
    left = cut_lineage(asked.select("a", "s", "f"))
    right = cut_lineage(offered.select("ba", "bs", "ts", "book_order", "name"))
    n, m, slots = left.count(), *right.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("ts")), F.lit(1))).first()
    x, y = (max(-(-size // TILE), min(BLOCKS, size), 1) for size in (n, m))

    def block(columns: list[str], blocks: int) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(blocks))

    others = F.explode(F.sequence(F.lit(0), F.lit(y - 1)))
    asked_tiles = left.withColumn("other", others).withColumn("left_tile", block(["a", "s", "f"], x) * y + F.col("other")).drop("other")
    others = F.explode(F.sequence(F.lit(0), F.lit(x - 1)))
    offered_tiles = right.withColumn("other", others).withColumn("right_tile", F.col("other") * y + block(["ba", "bs"], y)).drop("other")
    schema = "a string, s string, f string, points double, book_order long, name string"

    def tile(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(asked) and len(offered):
            asked = asked.sort_values("s", key=lambda x: x.str.len(), kind="stable")  # strips of like lengths
            titles = [[*(t or "" for t in ts), *[""] * (slots - len(ts))] for ts in offered["ts"]]
            alphabet = common.alphabet_of(asked["a"], asked["s"], asked["f"], offered["ba"], offered["bs"], *titles)
            mine = Side(asked["s"].tolist(), [[t] for t in asked["f"]], asked["a"].tolist(), alphabet)
            theirs = Side(offered["bs"].tolist(), titles, offered["ba"].tolist(), alphabet)
            order = list(zip(offered["book_order"].tolist(), offered["name"].tolist()))
            for i, points, j in best_in_tile(mine, theirs, order, weights, least)[0]:
                rows.append((asked["a"].iat[i], asked["s"].iat[i], asked["f"].iat[i], points, *order[j]))
        return pd.DataFrame(rows, columns=["a", "s", "f", "points", "book_order", "name"])

    found = asked_tiles.groupBy("left_tile").cogroup(offered_tiles.groupBy("right_tile")).applyInPandas(tile, schema)
    best = found.groupBy("a", "s", "f").agg(F.min(F.struct((-F.col("points")).alias("neg"), "book_order", "name")).alias("b"))
    return best.select("a", "s", "f", (-F.col("b.neg")).alias("points"), "b.book_order", "b.name")
