"""Edit-distance candidates without comparing all pairs, and without losing one.

If two texts are at most d edits apart and one is cut into d + 1 segments, at least one segment occurs in
the other text near its own position. So the right texts are cut into segments, the left texts emit the
substrings that could equal a segment, and the two sides meet in an ordinary equi-join. The allowed distance
is a share of the longer text; segments are cut for the largest distance a partner may have. For a pair with at
most e edits only its first e + 1 segments are looked up: one of them, the i-th, follows exactly i - 1 edits,
which bounds its shift from the left by i - 1 and from the right by e + 1 - i.

Many like texts in one block share so many segments that each pair meets several times. Short texts of such a block are
compared in tiles instead: bags of characters rule most pairs out, bit vectors give the distance of the rest, and every pair
is looked at once. A tile has a bounded number of right texts, so blocks with more of them go by segments as well.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import common

# Most left and right texts of a tile, least pairs of a block that is compared in tiles, pairs of a tile handled at once.
LEFT_TILE = 512
RIGHT_TILE = 16384
LEAST_PAIRS = 65536
STRIP = 64
PAIRS = 250_000


def _limit(length: Column, share: float) -> Column:
    """Largest edit distance between a text of this length and any partner within the share."""
    return F.floor(length * share / (1.0 - share) + 1e-9).cast("int")


def _segment_start(length: Column, segments: Column, i: Column) -> Column:
    """First position (from 1) of segment i (from 1): the last ``length % segments`` segments are longer."""
    short = F.floor(length / segments).cast("int")
    longer = F.pmod(length, segments)
    return (i - 1) * short + F.greatest(i - 1 - (segments - longer), F.lit(0)) + 1


def _segment_size(length: Column, segments: Column, i: Column) -> Column:
    short = F.floor(length / segments).cast("int")
    return short + F.when(i > segments - F.pmod(length, segments), 1).otherwise(0)


def _distinct(rows: DataFrame, block: Sequence[str], text: str, name: str) -> DataFrame:
    """Different (block, text), dealt out over all shuffle partitions: few bytes here become many rows in the next step."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = rows.select(*block, F.col(text).alias(name)).filter(F.length(name) > 0)
    return some.repartition(partitions, *block, name).distinct()


def near_in_tile(left: list[str], right: list[str], share: float) -> tuple[np.ndarray, np.ndarray]:
    """(left row, right row) of all pairs within the share; texts of 1 to ``common.WORD`` characters."""
    alphabet = common.alphabet_of(left, right)
    a, b = common.Texts(left, alphabet), common.Texts(right, alphabet)
    matches, codes = a.matches(), b.codes()
    bags = common.unary(a.counts(), b.counts())
    rows, columns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for begin in range(0, len(left), STRIP):
        strip = slice(begin, begin + STRIP)
        longest = np.maximum(a.lengths[strip][:, None], b.lengths[None, :])
        most = np.floor(longest * share + 1e-9).astype(np.int32)
        i, j = np.nonzero(bags[0][strip] @ bags[1].T >= longest - most - 0.5)
        for at in range(0, len(i), PAIRS):
            x, y = i[at : at + PAIRS], j[at : at + PAIRS]
            near = common.distances(matches[strip], codes, a.lengths[strip], b.lengths, x, y) <= most[x, y]
            rows.append(x[near] + begin)
            columns.append(y[near])
    return np.concatenate(rows), np.concatenate(columns)


def _tiled_pairs(a: DataFrame, b: DataFrame, tiles: DataFrame, block: Sequence[str], share: float) -> DataFrame:
    """(block, left_text, right_text) of the short texts of the blocks in ``tiles`` (block, tiles)."""
    tile = F.pmod(F.xxhash64("left_text"), F.col("tiles"))
    asked = a.filter(F.length("left_text") <= common.WORD).join(tiles, block).select(*block, "left_text", tile.alias("tile"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    offered = b.filter(F.length("right_text") <= common.WORD).join(tiles, block).select(*[F.col(c).alias(f"__{c}") for c in block], "right_text", copies.alias("__tile"))
    schema = T.StructType([*(a.schema[c] for c in block), a.schema["left_text"], b.schema["right_text"]])

    def compare(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(offered):
            return pd.DataFrame({f.name: [] for f in schema.fields}, dtype=object)
        i, j = near_in_tile(asked["left_text"].tolist(), offered["right_text"].tolist(), share)
        texts = {"left_text": asked["left_text"].to_numpy(object)[i], "right_text": offered["right_text"].to_numpy(object)[j]}
        return pd.DataFrame({**{c: [asked[c].iloc[0]] * len(i) for c in block}, **texts}, dtype=object)

    keys = [*block, "tile"]
    others = [f"__{k}" for k in keys]
    # few bytes, much work: a number of partitions that is not made smaller
    partitions = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked, offered = asked.repartition(partitions, *keys), offered.repartition(partitions, *others)
    return asked.groupBy(*keys).cogroup(offered.groupBy(*others)).applyInPandas(compare, schema)


def edit_candidates(left: DataFrame, left_text: str, right: DataFrame, right_text: str, share: float, block: Sequence[str] = ()) -> DataFrame:
    """Distinct (block, left_text, right_text) within the edit-distance share; equal texts included.

    ``share`` is the allowed edit distance divided by the longer length, up to 0.45. ``block`` columns must
    be equal.
    """
    if not 0 < share <= 0.45:
        raise ValueError("share must be in (0, 0.45]")
    named = list(block)
    a, b = _distinct(left, named, left_text, "left_text"), _distinct(right, named, right_text, "right_text")
    block = named or ["__block"]
    if not named:  # one block, by a column that is no literal, since equal literals would make a join without a key
        a, b = (x.withColumn("__block", F.length(t) * 0) for x, t in ((a, "left_text"), (b, "right_text")))

    def counted(texts: DataFrame, text: str, name: str) -> DataFrame:
        return texts.filter(F.length(text) <= common.WORD).groupBy(*block).agg(F.count(F.lit(1)).alias(name))

    tiles = (
        counted(a, "left_text", "n").join(counted(b, "right_text", "m"), block)
        .filter((F.col("m") <= RIGHT_TILE) & (F.col("n") * F.col("m") >= LEAST_PAIRS))
        .select(*block, F.ceil(F.col("n") / LEFT_TILE).alias("tiles"))
    )
    tiled = _tiled_pairs(a, b, tiles, block, share)
    a = a.join(tiles, block, "left").withColumn("tiled", F.col("tiles").isNotNull() & (F.length("left_text") <= common.WORD)).drop("tiles")

    size, count = F.col("size"), F.col("count")
    segments = (
        b.withColumn("size", F.length("right_text"))
        .withColumn("count", _limit(size, share) + 1)
        .withColumn("i", F.explode(F.sequence(F.lit(1), count)))
        .withColumn("part", F.substr("right_text", _segment_start(size, count, F.col("i")), _segment_size(size, count, F.col("i"))))
        .select(*block, "right_text", "size", "i", "part")
    )

    length, i = F.length("left_text"), F.col("i")
    shift = length - size
    probes = (
        a.withColumn("size", F.explode(F.sequence(F.ceil(length * (1.0 - share) - 1e-9).cast("int"), F.floor(length / (1.0 - share) + 1e-9).cast("int"))))
        .filter(~F.col("tiled") | (F.col("size") > common.WORD))
        .withColumn("count", _limit(size, share) + 1)
        .withColumn("edits", F.floor(F.greatest(length, size) * share + 1e-9).cast("int"))
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.least(count, F.col("edits") + 1))))
        .withColumn("start", _segment_start(size, count, i))
        .withColumn("width", _segment_size(size, count, i))
        .withColumn("low", F.greatest(F.lit(1), F.col("start") - (i - 1), F.col("start") + shift - (F.col("edits") + 1 - i)))
        .withColumn("high", F.least(length - F.col("width") + 1, F.col("start") + (i - 1), F.col("start") + shift + (F.col("edits") + 1 - i)))
        .filter("low <= high")
        .withColumn("at", F.explode(F.sequence(F.col("low"), F.col("high"))))
        .withColumn("part", F.substr("left_text", F.col("at"), F.col("width")))
        .select(*block, "left_text", "size", "i", "part")
    )
    longest = F.greatest(F.length("left_text"), F.length("right_text"))
    most = F.floor(longest * share + 1e-9).cast("int")
    # the distance is computed in a band of that width only, -1 beyond it
    within = F.call_function("levenshtein", F.col("left_text"), F.col("right_text"), most) >= 0
    # the sizes Spark knows are those before the rows multiplied, so it must not broadcast either side
    keyed = probes.hint("merge").join(segments, [*block, "size", "i", "part"]).filter(within).select(*block, "left_text", "right_text").distinct()
    return keyed.union(tiled).select(*named, "left_text", "right_text")


def one_edit_pairs(left: DataFrame, left_text: str, right: DataFrame, right_text: str, block: Sequence[str] = ()) -> DataFrame:
    """Distinct (block, left_text, right_text) at most one edit apart.

    Such texts agree once a character is deleted on one or both sides, so they meet on the text without one
    character. Unlike a segment, this key is never shared by a long common start alone.
    """
    block = list(block)

    def variants(frame: DataFrame, text: str, name: str) -> DataFrame:
        value = F.col(name)
        places = F.sequence(F.lit(1), F.length(value))
        shorter = F.transform(places, lambda i: F.concat(F.substr(value, F.lit(1), i - 1), F.substr(value, i + 1)))
        rows = _distinct(frame, block, text, name)
        return rows.select(*block, name, F.explode(F.array_distinct(F.concat(F.array(value), shorter))).alias("variant"))

    joined = variants(left, left_text, "left_text").hint("merge").join(variants(right, right_text, "right_text"), [*block, "variant"])
    return joined.filter(F.levenshtein("left_text", "right_text") <= 1).select(*block, "left_text", "right_text").distinct()
