"""Join of documents whose sets of word n-grams have a Jaccard similarity at or above a threshold.

Candidates come from one order of all grams, the rarely counted first. Two linked sets share so many grams that the first
one they share stands early in both, so a set is indexed by its first grams only: grams that hardly any other set holds
before those of common passages. The place of a gram also bounds the sizes of the sets that can be linked by it. Sets
that share a key are then compared exactly, but not in all pairs: in
each group all sets are compared with one pivot. Two of them that are not both linked to it can only be linked if their
differences from the pivot share grams, so the rarely shared part of the differences are the keys of the next level,
whose groups no longer hold the pivot. No link between different sets is lost, and a group of n costs n comparisons at a
level. Before that a group of bounded size is separated into sets that short counts of their grams connect, so that sets
that only hold one common passage need no pivot.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.components import connected_components
from shelfmark.llm.places import Places, ranges_for, repeated_keys
from shelfmark.llm.tables import free_name, removed, row_keys, slices, written
from shelfmark.llm.words import U, Words, mix, split_words, window_hashes

# Groups of index keys up to this size are compared in all pairs, larger ones with a pivot.
PAIRED = 16
# Larger groups are separated by the sketches first, up to this product of members and their grams, and this sum of grams.
SEPARATED, SEPARATED_GRAMS = 1 << 33, 1 << 25
# Lines (the sets of one pivot) of more members are settled whole, up to this sum of the grams of members and pivot.
LONG, LONG_GRAMS = 16, 3 << 23
# Groups that share a differing gram up to this size are joined in pairs that positions allow, larger ones have a new pivot.
JOINED = 1024
# Differing grams, and bytes of compressed texts, that are shuffled at once, for each range of hashes (of 4 MB of text).
PART_KEYS, PART_BYTES = 1 << 17, 1 << 20
# Words of 64 bits that mark the documents whose sets are compared.
MARK_WORDS = 1 << 18
# Counters of grams (a power of two), whatever the input, and how many of them make a row.
COUNTERS, COUNTERS_ROW = 1 << 18, 1 << 12


@dataclass(frozen=True)
class Similarity:
    """Grams of ``words`` words; a link needs ``den`` * intersection >= ``num`` * union."""

    words: int = 5
    num: int = 8
    den: int = 10
    lower: bool = True

    def difference(self, sizes: int) -> int:
        """Most grams in which two linked sets with that sum of sizes differ."""
        return (self.den - self.num) * sizes // (self.den + self.num)

    def linked(self, both: int, left: int, right: int) -> bool:
        return self.den * both >= self.num * (left + right - both)

    def partner(self, size: Column, at: Column) -> Column:
        """Size of the largest set that can be linked to one of ``size`` grams if the first gram they share is its gram ``at``."""
        return (F.floor((size - at) * (self.den + self.num) / self.num) - size).cast("long")

    def widest(self, size: int) -> int:
        """Most grams in which a set of that size differs from any linked one."""
        return self.difference(size + size * self.den // self.num)


def counter_of(grams: np.ndarray) -> np.ndarray:
    """The counter of each gram."""
    return (grams >> U(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def keys_of(grams: np.ndarray, kind: Similarity, counts: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Index keys of a set of grams (sorted hashes), in the order of their counts, equal ones by hash.

    The first gram that two linked sets share is preceded in either of them by grams that the other lacks, of which there are
    at most the (1 - num / den)-th part. Any order that is the same for all sets will do; only how many sets meet depends on it.
    """
    ordered = grams if counts is None else grams[np.argsort(counts[counter_of(grams)], kind="stable")]
    yield ordered[: len(grams) * (kind.den - kind.num) // kind.den + 1]


def grams_of(words: Words, size: int) -> Iterator[np.ndarray]:
    """For each text its distinct grams as sorted hashes; a shorter text with words is one gram."""
    every = window_hashes(words.hashes, size)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            yield np.unique(every[a : b - size + 1])
        else:
            yield window_hashes(words.hashes[a:b], b - a) if b > a else np.zeros(0, U)


def _sets(batches: Iterable[pa.RecordBatch], kind: Similarity) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for part, texts in slices(batch):
                yield part, list(grams_of(split_words(texts, kind.lower), kind.words))


def _fingerprints(grams: np.ndarray) -> tuple[int, int]:
    return tuple(int(mix(grams, seed).sum(dtype=U).view(np.int64)) for seed in (21, 22)) if len(grams) else (0, 0)


def sketch_of(grams: np.ndarray) -> bytes:
    """Grams counted by their leading bits: a power of two of counts, for 4 to 8 grams each; empty if a count exceeds a byte."""
    bits = max(4, (len(grams) // 4).bit_length() - 1)
    counts = np.bincount((grams >> U(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() <= 255 else b""


def most_common(left: bytes, right: bytes) -> int | None:
    """Most grams that two sets can share by their sketches, None if these don't tell."""
    if not left or not right:
        return None
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (left, right))
    while len(a) != len(b):  # the finer counts are added up to the coarser ones
        if len(a) > len(b):
            a = a.reshape(-1, 2).sum(axis=1)
        else:
            b = b.reshape(-1, 2).sum(axis=1)
    return int(np.minimum(a, b).sum())


def _folded(counts: np.ndarray, width: int) -> np.ndarray:
    """Counts of each row added up to ``width`` coarser ones."""
    return counts if counts.shape[-1] == width else counts.reshape(*counts.shape[:-1], width, -1).sum(axis=-1, dtype=np.uint16)


def separated(sizes: np.ndarray, sketches: list[bytes], kind: Similarity) -> np.ndarray:
    """For each set the number of its part: sets whose sizes and sketches allow a link are in the same one, directly or by others.

    Each set is compared only with those that no part has yet, so sets that are alike cost one comparison each.
    """
    by_width = {w: np.flatnonzero([len(x) == w for x in sketches]) for w in {len(x) for x in sketches}}
    counts = {w: np.frombuffer(b"".join(sketches[i] for i in at), np.uint8).reshape(len(at), w) for w, at in by_width.items() if w}
    coarser: dict[tuple[int, int], np.ndarray] = {}
    out, number = np.full(len(sizes), -1), 0
    for first in range(len(sizes)):
        if out[first] >= 0:
            continue
        out[first], todo = number, [first]
        while todo:
            x = todo.pop()
            own, n = np.frombuffer(sketches[x], np.uint8), sizes[x]
            for w, at in by_width.items():
                m = sizes[at]
                fits = (out[at] < 0) & (kind.den * np.minimum(n, m) >= kind.num * np.maximum(n, m))
                if w and len(own) and fits.any():
                    width = min(w, len(own))
                    if (w, width) not in coarser:
                        coarser[w, width] = _folded(counts[w], width)
                    rows = np.flatnonzero(fits)
                    both = np.minimum(coarser[w, width][rows], _folded(own, width)).sum(axis=1, dtype=np.int64)
                    both = np.minimum(both, np.minimum(n, m[rows]))
                    fits[rows] = kind.den * both >= kind.num * (n + m[rows] - both)
                found = at[fits]
                out[found] = number
                todo += found.tolist()
        number += 1
    return out


def set_classes(rows: DataFrame, kind: Similarity) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """((doc, n, rep): size of the set, and the smallest document with the same set (itself if the set is empty); (doc, n, sketch);
    how often grams of each counter occur in the documents)."""
    names = ["doc", "n", "f1", "f2", "sketch", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for part, sets in _sets(batches, kind):
            prints = [_fingerprints(x) for x in sets]
            counts += np.bincount(counter_of(np.concatenate([*sets, np.zeros(0, U)])), minlength=COUNTERS)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    *(pa.array([p[k] for p in prints], pa.int64()) for k in (0, 1)),
                    pa.array([sketch_of(x) for x in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int64()),
                    pa.nulls(len(sets), pa.binary()),
                ],
                names,
            )
        # one row more for each stretch of counters
        tool, stretches = zstandard.ZstdCompressor(level=1), counts.reshape(-1, COUNTERS_ROW)
        none = [pa.nulls(len(stretches), kind) for kind in (*[pa.int64()] * 4, pa.binary())]
        packed = [tool.compress(x.tobytes()) for x in stretches]
        yield pa.RecordBatch.from_arrays([*none, pa.array(range(len(stretches)), pa.int64()), pa.array(packed, pa.binary())], names)

    every = written(rows.mapInArrow(run, "doc long, n long, f1 long, f2 long, sketch binary, part long, counts binary"))
    first = every.filter("n > 0").groupBy("n", "f1", "f2").agg(F.min("doc").alias("rep"))
    texts = every.filter("part IS NULL")
    classes = written(texts.join(first, ["n", "f1", "f2"], "left").select("doc", "n", F.coalesce("rep", "doc").alias("rep")))
    return classes, texts.select("doc", "n", "sketch"), _summed(every.filter("part IS NOT NULL").select("part", "counts"))


def _summed(stretches: DataFrame) -> np.ndarray:
    """The counters of all tasks added up."""

    def run(group: pa.Table) -> pa.Table:
        tool, total = zstandard.ZstdDecompressor(), np.zeros(COUNTERS_ROW, np.int64)
        for packed in group.column("counts").to_pylist():
            total += np.frombuffer(tool.decompress(packed), np.int64)
        return pa.table({"part": group.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((COUNTERS // COUNTERS_ROW, COUNTERS_ROW), np.int64)
    for r in stretches.groupBy("part").applyInArrow(run, "part long, counts binary").collect():
        out[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return out.ravel()


def _possible(pairs: DataFrame, sketches: DataFrame, kind: Similarity) -> DataFrame:
    """The pairs whose sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, n, m in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "x_n", "y_n"))):
                both = most_common(x, y)
                keep.append(both is None or kind.linked(min(both, n, m), n, m))
            yield batch.select(["pivot", "member"]).filter(pa.array(keep, pa.bool_()))

    def of(column: str, name: str) -> DataFrame:
        return sketches.select(F.col("doc").alias(column), F.col("sketch").alias(name), F.col("n").alias(f"{name}_n"))

    return pairs.join(of("member", "y"), "member").join(of("pivot", "x"), "pivot").mapInArrow(run, "pivot long, member long")


def _index(kind: Similarity, counts: Broadcast) -> Callable[[pa.RecordBatch], Iterator[Places]]:
    """Index keys of a batch of texts with their places in the order; copies within the batch are indexed once."""

    def of(batch: pa.RecordBatch) -> Iterator[Places]:
        seen = set()
        for part, sets in _sets([batch], kind):
            docs, keys = [], []
            for doc, grams in zip(part.column("doc").to_pylist(), sets):
                mark = _fingerprints(grams)
                if mark not in seen and len(grams) and doc is not None:
                    seen.add(mark)
                    keys += keys_of(grams, kind, counts.value)
                    docs.append(np.full(len(keys[-1]), doc, np.int64))
            if keys:
                at = np.concatenate([np.arange(len(x), dtype=np.int32) for x in keys])
                yield np.concatenate(keys), np.zeros(len(at), U), np.concatenate(docs), at

    return of


def _marks(wanted: DataFrame) -> np.ndarray:
    """A bit for the hash of each document; a fixed number of words, so that few texts but the wanted ones are sent on."""
    mark = F.xxhash64("doc")
    bit = F.shiftrightunsigned(mark, 58).cast("int")
    words = wanted.select(F.pmod(mark, F.lit(MARK_WORDS)).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits"))
    out = np.zeros(MARK_WORDS, U)
    for r in words.groupBy("w").agg(F.bit_or("bits").alias("bits")).collect():
        out[r["w"]] = r["bits"] % 2**64
    return out


def _bodies(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, body): compressed texts of the wanted documents (doc), a third of their sets; only texts that a mark lets through travel."""
    shared = rows.sparkSession.sparkContext.broadcast(_marks(wanted))

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, marks = zstandard.ZstdCompressor(level=3), shared.value
        for batch in batches:
            mark = batch.column("mark").to_numpy()
            keep = (marks[mark % MARK_WORDS] >> (mark.view(U) >> U(58))) & U(1) == 1
            batch = batch.filter(pa.array(keep))
            bodies = [tool.compress((x or "").encode()) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(bodies, pa.binary())], ["doc", "body"])

    packed = rows.withColumn("mark", F.xxhash64("doc")).mapInArrow(press, "doc long, body binary")
    return written(packed.join(wanted, "doc", "left_semi").select(F.col("doc").alias("rep"), "body"))


def _opened(bodies: Iterable[bytes], kind: Similarity) -> dict[bytes, np.ndarray]:
    """The sets of different compressed texts."""
    tool, different = zstandard.ZstdDecompressor(), list(dict.fromkeys(bodies))
    texts = pa.array([tool.decompress(x) for x in different], pa.binary()).cast(pa.string())
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    return dict(zip(different, (x for _, sets in _sets([batch], kind) for x in sets)))


def compare(pivot: np.ndarray, member: np.ndarray, kind: Similarity) -> tuple[bool, np.ndarray, int, int]:
    """(linked, all differing grams, how many of them index the pair class a, class b).

    The differing grams are those that the member has more, then those that it lacks, in the order of their hashes: one
    order for all members of a pivot. If x is not linked to the pivot and y is linked to x, their differences share
    at least o grams, so each has one of them among its first (size - o + 1). Class a holds pairs with y linked to the
    pivot, class b pairs with neither linked.
    """
    at = np.minimum(np.searchsorted(pivot, member), max(0, len(pivot) - 1))
    hit = pivot[at] == member if len(pivot) else np.zeros(len(member), bool)
    lacks = np.ones(len(pivot), bool)
    lacks[at[hit]] = False
    differ = np.concatenate([member[~hit], pivot[lacks]])
    n, p, size = len(differ), len(pivot), len(member)
    share, of = kind.den - kind.num, kind.den + kind.num
    # a partner on the other side differs from the pivot by more than share / of * (its size + p), and from this member by
    # at most share / of * (its size + this size); its own size cancels out
    least = (n * of + share * (p - size)) // of + 1
    half = max(1, (least + 1) // 2)
    if kind.linked(int(hit.sum()), p, size):
        return True, differ, n - half + 1, 0
    far = max(1, n - kind.widest(size))
    both, apart = int(hit.sum()), 2 * kind.num - kind.den
    # distances add up: what is more than twice as far from the pivot as a link allows is linked to nothing that is linked to it
    lone = kind.den * both < apart * (p + size - both)
    return False, differ, 0 if lone else n - far + 1, n - max(half, far) + 1


def _verified(pairs: DataFrame, bodies: DataFrame, kind: Similarity) -> DataFrame:
    """(pivot, member, linked, size, differ, a, b, every): outcome of each comparison, the member's size, the number of differing
    grams, of the pairs of a star (``star``) those that index them, and of those of a long line (``whole``) all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, sizes, counts, a, b, every = [], [], [], [], [], []
            pivots, members = batch.column("of_pivot").to_pylist(), batch.column("of_member").to_pylist()
            sets = _opened([*pivots, *members], kind)
            for x, y, star, whole in zip(pivots, members, batch.column("star").to_pylist(), batch.column("whole").to_pylist()):
                yes, differ, to_a, to_b = compare(sets[x], sets[y], kind)
                linked.append(yes)
                sizes.append(len(sets[y]))
                counts.append(len(differ))
                a.append(differ[: max(0, to_a) if star else 0].view(np.int64))
                b.append(differ[: max(0, to_b) if star else 0].view(np.int64))
                every.append(differ[: len(differ) if whole else 0].view(np.int64))
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("pivot"),
                    batch.column("member"),
                    pa.array(linked, pa.bool_()),
                    pa.array(sizes, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(a, lists),
                    pa.array(b, lists),
                    pa.array(every, lists),
                ],
                ["pivot", "member", "linked", "size", "differ", "a", "b", "every"],
            )

    both = pairs.join(bodies.select(F.col("rep").alias("member"), F.col("body").alias("of_member")), "member")
    both = both.join(bodies.select(F.col("rep").alias("pivot"), F.col("body").alias("of_pivot")), "pivot")
    columns = "pivot long, member long, linked boolean, size long, differ long, a array<long>, b array<long>, every array<long>"
    return both.select("pivot", "member", "star", "whole", "of_pivot", "of_member").mapInArrow(run, columns)


def tied(linked: np.ndarray, sizes: np.ndarray, differ: list[np.ndarray], kind: Similarity) -> list[tuple[int, int]]:
    """Links between the members of a pivot that, with the links to the pivot (``linked``), connect all that are linked.

    ``differ`` are the grams in which a member differs from the pivot. Two members differ in the grams that only one of
    these holds, so all that must be counted are the members that hold the same differing gram. Members linked to the pivot
    need no link among themselves: only the others are compared, with all.
    """
    counts = np.array([len(x) for x in differ], np.int64)
    owner = np.repeat(np.arange(len(differ)), counts)
    _, gram = np.unique(np.concatenate([*differ, np.zeros(0, np.int64)]), return_inverse=True)
    order = np.argsort(gram, kind="stable")
    holders, bounds = owner[order], np.concatenate([[0], np.cumsum(np.bincount(gram))])
    starts = np.concatenate([[0], np.cumsum(counts)])
    part = np.where(linked, -1, np.arange(len(differ)))
    out = []
    for x in np.flatnonzero(~linked).tolist():
        own = gram[starts[x] : starts[x + 1]]
        meet = [holders[a:b] for a, b in zip(bounds[own].tolist(), bounds[own + 1].tolist()) if b - a > 1]
        shared = np.bincount(np.concatenate([*meet, np.zeros(0, np.int64)]), minlength=len(differ))
        size = sizes + sizes[x]
        both = size - counts - counts[x] + 2 * shared  # twice the grams that both hold
        hits = np.flatnonzero(((kind.den + kind.num) * both >= 2 * kind.num * size) & (part != part[x]))
        for number, first in zip(*np.unique(part[hits], return_index=True)):
            out.append((x, int(hits[first])))
            part[part == number] = part[x]
    return out


def _settled(stars: DataFrame, done: DataFrame, kind: Similarity) -> DataFrame:
    """(a, b): links that connect the members of each line, besides those to its pivot."""

    def run(line: pa.Table) -> pa.Table:
        members, lists = line.column("member").to_numpy(), line.column("every").combine_chunks()
        differ = np.split(lists.values.to_numpy(), lists.offsets.to_numpy()[1:-1])
        found = tied(line.column("linked").to_numpy(), line.column("size").to_numpy(), differ, kind)
        return pa.table({name: pa.array([members[x[k]] for x in found], pa.int64()) for k, name in enumerate(("a", "b"))})

    every = stars.join(done.select("pivot", "member", "linked", "size", "every"), ["pivot", "member"])
    return every.select("line", "member", "linked", "size", "every").groupBy("line").applyInArrow(run, "a long, b long")


def _long(stars: DataFrame, classes: DataFrame) -> DataFrame:
    """(line, pivot, member, whole): whether the line has more than ``LONG`` members, and not more grams than a task takes."""
    of = [classes.select(F.col("doc").alias(c), F.col("n").alias(f"{c}_n")) for c in ("member", "pivot")]
    lines = stars.join(of[0], "member").join(of[1], "pivot").groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("member_n") + F.col("pivot_n")).alias("grams"))
    return stars.join(lines.select("line", ((F.col("n") > LONG) & (F.col("grams") <= LONG_GRAMS)).alias("whole")), "line").select("line", "pivot", "member", "whole")


def _early(members: DataFrame) -> DataFrame:
    """The members of groups of index keys whose key stands early enough for a link with any other size in the group."""
    bounds = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("low"), F.max("wide").alias("high"))
    kept = members.join(bounds.filter("n > 1"), "key").filter("wide >= low AND size <= high")
    return kept.select("key", "member", "size", "wide")


def _live(groups: DataFrame) -> DataFrame:
    """Members of the groups of index keys that hold a pair, with the group's size; groups of the same members once.

    Of such groups a member has the largest ``wide``: a pair may be early enough in one of them only.
    """
    size = groups.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("member")).alias("mark"), F.min("member").alias("low"), F.max("member").alias("high"),
        F.sum("size").alias("grams"),
    )
    same = size.filter("n > 1").select("key", F.xxhash64("n", "mark", "low", "high").alias("same"), "n", "grams")
    once = groups.join(same, "key").groupBy(F.col("same").alias("key"), "member").agg(*[F.max(c).alias(c) for c in ("size", "wide", "n", "grams")])
    return once.withColumn("line", F.lit(0).cast("long"))


def _parted(live: DataFrame, sketches: DataFrame, kind: Similarity) -> DataFrame:
    """The groups, those of middle size separated into the parts that sketches connect; a set that is a part alone has no link there."""

    def run(group: pa.Table) -> pa.Table:
        part = separated(group.column("size").to_numpy(), group.column("sketch").to_pylist(), kind)
        kept = group.select(["key", "member", "size", "wide"]).append_column("part", pa.array(part, pa.int64()))
        return kept.filter(pa.array(np.bincount(part)[part] > 1))

    middle = (F.col("n") > PAIRED) & (F.col("n") * F.col("grams") <= SEPARATED) & (F.col("grams") <= SEPARATED_GRAMS)
    of = sketches.select(F.col("doc").alias("member"), "sketch")
    parts = live.filter(middle).select("key", "member", "size", "wide").join(of, "member").groupBy("key").applyInArrow(run, "key long, member long, size long, wide long, part long")
    found = written(parts.select(F.xxhash64("key", "part").alias("key"), "member", "size", "wide"))
    parted = written(_live(found))
    removed(found)
    return live.filter(~middle).unionByName(parted)


def _pairs(live: DataFrame) -> DataFrame:
    """(pivot, member): all pairs of the small groups of index keys whose sizes, and places of the key, allow a link."""
    small = live.filter(F.col("n") <= PAIRED).select("key", "member", "size", "wide")
    other = small.select("key", F.col("member").alias("pivot"), F.col("size").alias("other"), F.col("wide").alias("other_wide"))
    fits = (F.col("size") <= F.col("other_wide")) & (F.col("other") <= F.col("wide"))
    both = small.join(other, (small["key"] == other["key"]) & (F.col("pivot") < F.col("member")) & fits)
    return both.select("pivot", "member").distinct()


def _joined(live: DataFrame, kind: Similarity) -> DataFrame:
    """(pivot, member): pairs that share a differing gram early enough to share as many as a link needs.

    Of two members that are linked, the first gram that their differences share leaves at least as many grams after it, in
    either of them, as they must share besides it.
    """
    columns = ["member", "is_a", "is_b", "size", "differ", "at"]
    small = live.filter(F.col("n") <= JOINED)
    x = small.select("key", *[F.col(c).alias(f"x_{c}") for c in columns])
    y = small.select("key", *[F.col(c).alias(f"y_{c}") for c in columns])
    most = F.floor((kind.den - kind.num) * (F.col("x_size") + F.col("y_size")) / (kind.den + kind.num))
    shared = F.ceil((F.col("x_differ") + F.col("y_differ") - most) / 2)
    early = F.least(F.col("x_differ") - F.col("x_at"), F.col("y_differ") - F.col("y_at")) >= shared
    sides = (F.col("x_is_a") & F.col("y_is_b")) | (F.col("x_is_b") & F.col("y_is_a"))
    both = x.join(y, (x["key"] == y["key"]) & (F.col("x_member") < F.col("y_member")) & sides & early & (F.abs(F.col("x_differ") - F.col("y_differ")) <= most))
    return both.select(F.col("x_member").alias("pivot"), F.col("y_member").alias("member")).distinct()


def _stars(live: DataFrame, least: int) -> DataFrame:
    """(line, pivot, member): in each larger group all members with the one that most such groups hold."""
    large = live.filter(F.col("n") > least)
    weight = large.groupBy("member").agg(F.sum("n").alias("w"))
    first = large.select("key", "member").join(weight, "member").groupBy("key").agg(F.max(F.struct("w", (-F.col("member")).alias("m"))).alias("top"))
    stars = large.join(first.select("key", (-F.col("top.m")).alias("pivot")), "key").filter("member <> pivot")
    return stars.select(F.xxhash64("line", "pivot").alias("line"), "pivot", "member").distinct()


def _next(stars: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a written table, the next level that reads it and ``done``): members of a star that share one of the grams that index
    their differences, with the group's size.

    Lines whose members are all linked are settled, and without a linked member there is no pair of class a. Only
    (key, star, position and sides) is shuffled, once; the rest is joined to what meets. Grams meet by pivot, whatever the
    line, so that the differences themselves are neither shuffled nor written again; ``gram`` is the key of that
    meeting, and a filter on it holds for all that is shuffled before.
    """
    star = F.xxhash64("pivot", "member").alias("star")
    both = stars.join(done.drop("a", "b", "every"), ["pivot", "member"])
    lines = both.groupBy("line").agg(F.count(F.lit(1)).alias("of_line"), F.min("linked").alias("all"))
    kept = both.join(lines.filter("of_line > 1 AND NOT all"), "line")
    info = written(kept.select(star, "line", "member", "size", "differ"))
    sides = []
    for tag in ("a", "b"):
        is_a = F.col("linked") | F.lit(tag == "b")
        found = done.select(star, "linked", "pivot", F.posexplode(tag).alias("at", "gram"))
        code = (F.col("at") * 4 + is_a.cast("int") + 2 * (~F.col("linked")).cast("int")).cast("int")
        sides.append(found.select(F.xxhash64("pivot", F.lit(tag), "gram").alias("gram"), "star", code.alias("code")))
    # the later join by star asks for this filter; stated here, it holds for both readers of the shuffle, which is then reused
    rows = sides[0].union(sides[1]).filter("star IS NOT NULL").repartition("gram")
    size = rows.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("code") % 2).alias("has_a"), F.max(F.floor(F.col("code") / 2) % 2).alias("has_b"),
        F.min("star").alias("low"), F.max("star").alias("high"),
    )
    met = rows.join(size.filter("n > 1 AND has_a = 1 AND has_b = 1 AND low < high").select("gram", "n"), "gram")
    return info, met.join(info, "star").select(
        F.xxhash64("line", "gram").alias("key"), "gram", "n", "line", "member", "size", "differ",
        (F.col("code") % 2 == 1).alias("is_a"), (F.floor(F.col("code") / 2) % 2 == 1).alias("is_b"), F.floor(F.col("code") / 4).alias("at"),
    )


def _parts(size: float, most: int) -> int:
    """How many parts of at most that size."""
    return max(1, math.ceil(size / most))


def _in_parts(rows: DataFrame, by: Column, parts: int, made: Callable[[DataFrame], DataFrame] = lambda part: part) -> DataFrame:
    """What is made of the rows, written part by part: the shuffle files of a part go before the next one is made."""
    return reduce(DataFrame.union, [written(made(rows.filter(F.pmod(by, F.lit(parts)) == k))) for k in range(parts)])


def links(rows: DataFrame, classes: DataFrame, sketches: DataFrame, counts: np.ndarray, kind: Similarity) -> DataFrame:
    """(a, b): linked pairs of class representatives that connect all linked classes (not every linked pair)."""
    ranges = ranges_for(rows)
    packed = repeated_keys(rows, _index(kind, rows.sparkSession.sparkContext.broadcast(counts)), ranges)
    # a quarter of the blocks it is read from, which go before it is shuffled further
    index = written(packed)
    removed(packed)
    sets = index.join(classes.select("doc", "rep", F.col("n").alias("size")), "doc").withColumn("wide", kind.partner(F.col("size"), F.col("at")))
    members = written(sets.groupBy("key", F.col("rep").alias("member"), "size").agg(F.max("wide").alias("wide")))
    removed(index.select("key", "doc"))
    live = written(_live(_early(members)))
    removed(members)
    live = _parted(live, sketches, kind)
    # pairs in small groups are only asked for links, so most go by their sketches; with a pivot the differences count too
    stars, near, found = written(_stars(live, PAIRED)), written(_possible(_pairs(live), sketches, kind)), []
    ends = [x.select(F.col(c).alias("doc")) for x in (stars, near) for c in ("pivot", "member")]
    bodies = _bodies(rows, reduce(DataFrame.union, ends).distinct())
    length = bodies.agg(F.avg(F.octet_length("body"))).first()[0] or 0
    while True:
        lines = written(_long(stars, classes))
        removed(stars)
        both = near.select("pivot", "member", F.lit(False).alias("star"), F.lit(False).alias("whole")).union(lines.select("pivot", "member", ~F.col("whole"), "whole"))
        pairs = written(both.groupBy("pivot", "member").agg(F.max("star").alias("star"), F.max("whole").alias("whole")))
        # what the next table is made of is written, so earlier ones go before it is
        removed(near)
        removed(live)
        # pairs are compared, and their grams shuffled, one part after the other, so that only a part is on disk at a time
        parts = _parts(pairs.count() * length, ranges * PART_BYTES)
        done = _in_parts(pairs, F.xxhash64("pivot", "member"), parts, lambda part: _verified(part, bodies, kind))
        removed(pairs)
        found.append(written(done.filter("linked").select(F.col("pivot").alias("a"), F.col("member").alias("b"))))
        found.append(written(_settled(lines.filter("whole"), done, kind)))
        stars = lines.filter("NOT whole").select("line", "pivot", "member")
        if stars.isEmpty():
            removed(done)
            removed(lines)
            break
        info, following = _next(stars, done)
        removed(lines)
        grams = done.agg(F.sum(F.size("a") + F.size("b"))).first()[0] or 0
        live = _in_parts(following, F.col("gram"), _parts(grams, ranges * PART_KEYS))
        removed(done)
        removed(info)
        stars, near = written(_stars(live, JOINED)), written(_possible(_joined(live, kind), sketches, kind))
    removed(bodies)
    every = found[0]
    for part in found[1:]:
        every = every.union(part)
    return every


def similar_groups(documents: DataFrame, kind: Similarity = Similarity(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, class_id, component_id) for every document.

    ``class_id`` is the smallest id with the same set of grams, ``component_id`` the smallest id that links reach. Words are runs
    without white space, with A-Z lower-cased if ``kind.lower``. A text with fewer words than a gram is one gram; null and
    empty texts have no grams and are linked with nothing. Grams are compared by 64-bit hashes. Ids are integers that tell
    the documents apart; a repeated row gets the same answer as the first one, and a row with a null id joins the class of
    its copies but carries no links. An empty table gives no rows.
    """
    rows = documents.select(documents[id].cast("long").alias("doc"), documents[text].cast("string").alias("text"))
    classes, sketches, counts = set_classes(rows, kind)
    parts = connected_components(links(rows, classes, sketches, counts, kind)).withColumnRenamed("node", "rep")
    return classes.join(parts, "rep", "left").select(
        F.col("doc").alias(id), F.col("n").alias("n_shingles"), F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id")
    )


def one_of_each_group(documents: DataFrame, kind: Similarity = Similarity(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group that links connect (the one with the smallest id); other columns as they are.

    Every row counts as a document, whatever its id, so of repeated rows one stays. Texts without words are kept.
    """
    key = free_name(documents, "row")
    keyed = row_keys(documents, id, key)
    found = similar_groups(keyed.select(keyed[key].alias("doc"), keyed[text].alias("text")), kind, "doc", "text")
    first = found.filter("component_id = doc").select(F.col("doc").alias(key))
    return keyed.join(first, key, "left_semi").select(*documents.columns)
