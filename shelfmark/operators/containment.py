"""Substring joins without comparing all pairs.

A text that contains a needle also contains every n-gram of the needle. Each needle is joined on one n-gram,
the one found in the fewest texts, and the few candidates are then tested. Both sides are reduced to
distinct texts first, so copies cost nothing. A short list against a large table needs no join: an automaton
with failure links finds all list texts in one scan of a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.session import cut_lineage

GRAM = 5
# Most characters of a list that is sent to the tasks, and row texts for which the list is scanned once.
LIST_CHARACTERS = 4_000_000
SCANNED = 20_000


def _grams(text: Column, size: Column) -> Column:
    """Distinct substrings of the given size; none when the text is shorter."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, size)))


def contained_pairs(needles: DataFrame, needle: str, texts: DataFrame, text: str, group: Sequence[str] = (), min_length: int = 1) -> DataFrame:
    """Distinct (group, needle, text) where the text contains the needle.

    Needles are at least ``min_length`` long (shorter ones are left out). ``group`` columns must be equal. Of the texts only
    n-grams are counted that some needle has, in the sizes that needles have (a short needle is its own n-gram). Runs a job
    that finds those sizes.
    """
    group = list(group)
    least = max(min_length, 1)
    left = needles.select(*group, F.col(needle).alias("needle")).filter(F.length("needle") >= least).distinct()
    right = texts.select(*group, F.col(text).alias("text")).filter(F.length("text") >= least).distinct()
    needle_size = F.least(F.length("needle"), F.lit(GRAM))
    sizes = [r[0] for r in left.select(needle_size.alias("n")).distinct().collect()] or [least]  # 1 to GRAM
    needle_grams = left.select(*group, "needle", F.explode(_grams(F.col("needle"), needle_size)).alias("gram"))
    text_grams = right.select(
        *group, "text", F.explode(F.flatten(F.transform(F.array(*[F.lit(n) for n in sorted(sizes)]), lambda n: _grams(F.col("text"), n)))).alias("gram")
    ).join(needle_grams.select(*group, "gram").distinct(), [*group, "gram"], "left_semi")
    frequency = text_grams.groupBy(*group, "gram").agg(F.count(F.lit(1)).alias("df"))
    rarest = (
        needle_grams.join(frequency, [*group, "gram"])
        .groupBy(*group, "needle")
        .agg(F.min(F.struct("df", "gram")).alias("best"))
        .select(*group, "needle", F.col("best.gram").alias("gram"))
    )
    return rarest.join(text_grams, [*group, "gram"]).filter(F.col("text").contains(F.col("needle"))).drop("gram")


def _automaton(patterns: Iterable[str]) -> ahocorasick.Automaton:
    """All patterns with failure links: one scan of a text finds every pattern in it."""
    found = ahocorasick.Automaton()
    for pattern in patterns:
        found.add_word(pattern, pattern)
    if len(found):
        found.make_automaton()
    return found


def _inside(automaton: ahocorasick.Automaton, text: str) -> set[str]:
    return {pattern for _, pattern in automaton.iter(text)} if len(automaton) else set()


def small_list_pairs(listed: DataFrame, list_text: str, rows: DataFrame, text: str, row_columns: Sequence[str], contained_min: int, container_min: int | None) -> DataFrame:
    """(list_text, text, row_columns) where a row text lies in a list text, or a list text in a row text; each pair once a row.

    For a short list against a large table. Row texts count from ``contained_min`` characters on, list texts as the contained
    ones from ``container_min`` on (None: never). A list of up to ``LIST_CHARACTERS`` (checked; different texts only) is sent to the
    tasks, which scan every row text once with an automaton of the list texts, and the list once for each ``SCANNED``
    row texts with an automaton of those; the large side is neither grouped nor shuffled. A longer list is joined on the
    rarest n-grams. Runs jobs over the list.
    """
    least = max(contained_min, 1)
    entries = cut_lineage(listed.select(F.col(list_text).alias("__l")).filter(F.length("__l") > 0).distinct())
    wanted = rows.filter(F.length(text) >= least)
    size = entries.agg(F.sum(F.length("__l"))).first()[0] or 0
    if size > LIST_CHARACTERS:
        texts = wanted.select(F.col(text).alias("__t")).distinct()
        pairs = contained_pairs(texts, "__t", entries, "__l", (), least).select(F.col("text").alias("list_text"), F.col("needle").alias("text"))
        if container_min is not None:
            around = contained_pairs(entries, "__l", texts, "__t", (), container_min)
            pairs = pairs.union(around.select(F.col("needle").alias("list_text"), "text")).distinct()
        return wanted.select(*row_columns, F.col(text).alias("__t")).join(pairs, F.col("__t") == F.col("text")).select("list_text", "text", *row_columns)

    shared = rows.sparkSession.sparkContext.broadcast([r[0] for r in entries.collect()])
    kept = [f"__c{k}" for k in range(len(row_columns))]
    source = wanted.select(*[F.col(c).alias(k) for c, k in zip(row_columns, kept)], F.col(text).alias("__t"))
    schema = T.StructType([T.StructField("list_text", T.StringType()), T.StructField("text", T.StringType()), *source.schema.fields[:-1]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = shared.value
        contained = _automaton(x for x in listed if container_min is not None and len(x) >= container_min)

        def answer(some: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(some).combine_chunks()
            texts = table.column("__t").to_pylist()
            holders: dict[str, set[str]] = {}
            own = _automaton(set(texts))
            for entry in listed:
                for found in _inside(own, entry):
                    holders.setdefault(found, set()).add(entry)
            partners: dict[str, list[str]] = {}
            at, entry_texts, row_texts = [], [], []
            for k, value in enumerate(texts):
                if value not in partners:
                    partners[value] = sorted(holders.get(value, set()) | _inside(contained, value))
                for entry in partners[value]:
                    at.append(k)
                    entry_texts.append(entry)
                    row_texts.append(value)
            more = table.select(kept).take(pa.array(at, pa.int64())).combine_chunks()
            columns = [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in more.columns]
            return pa.RecordBatch.from_arrays([pa.array(entry_texts, pa.string()), pa.array(row_texts, pa.string()), *columns], schema.names)

        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            if n >= SCANNED:
                yield answer(waiting)
                waiting, n = [], 0
        if n:
            yield answer(waiting)

    return source.mapInArrow(scan, schema).withColumnsRenamed(dict(zip(kept, row_columns)))


def touching_pairs(left: DataFrame, left_text: str, right: DataFrame, right_text: str, group: Sequence[str] = (), left_min: int = 1, right_min: int = 1) -> DataFrame:
    """Distinct (group, left_text, right_text) where one text contains the other.

    A text only counts as the contained one from its own minimum length on.
    """
    group = list(group)
    forward = contained_pairs(left, left_text, right, right_text, group, left_min).select(
        *group, F.col("needle").alias("left_text"), F.col("text").alias("right_text")
    )
    backward = contained_pairs(right, right_text, left, left_text, group, right_min).select(
        *group, F.col("text").alias("left_text"), F.col("needle").alias("right_text")
    )
    return forward.union(backward).distinct()


def touching_texts(left: DataFrame, left_text: str, right: DataFrame, right_text: str, group: Sequence[str] = (), left_min: int = 1, right_min: int = 1) -> DataFrame:
    """Distinct (group, left_text) of left texts that contain a right text or lie in one.

    As ``touching_pairs``, but each task drops the partner at once, so no pairs are shuffled.
    """
    group = list(group)
    inside = contained_pairs(left, left_text, right, right_text, group, left_min).select(*group, F.col("needle").alias("left_text"))
    around = contained_pairs(right, right_text, left, left_text, group, right_min).select(*group, F.col("text").alias("left_text"))
    return inside.distinct().union(around.distinct()).distinct()
