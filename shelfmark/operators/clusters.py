"""Series guessed from titles alone: shared leading words, shared significant words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.config.vocab import TITLE_STOP_WORDS
from shelfmark.functions.keys import lower_trim
from shelfmark.operators.groups import attach_group
from shelfmark.session import cut_lineage


def common_prefix_series(books: DataFrame, author: str, title: str, row_id: str, least_words: int = 2) -> DataFrame:
    """(author, series_name, row_id): titles of one author whose longest common start has two or more words.

    Two titles share exactly a prefix when they go on differently after it, or both end there. So every title
    emits its prefixes with the word that follows, and a prefix is a series when it is followed by two
    different words (the end counts as one) or ends two titles. No titles are compared with each other.
    """
    words = F.split(F.trim(F.regexp_replace(title, "\\s+", " ")), " ")
    prefixes = (
        books.select(F.col(author), F.col(row_id), words.alias("w"))
        .filter(F.size("w") >= least_words)
        .select(author, row_id, "w", F.explode(F.sequence(F.lit(least_words), F.size("w"))).alias("k"))
        .select(
            author,
            row_id,
            F.array_join(F.slice("w", 1, F.col("k")), " ").alias("spelled"),
            F.lower(F.coalesce(F.try_element_at("w", F.col("k") + 1), F.lit(""))).alias("next"),
        )
        .withColumn("prefix", F.lower("spelled"))
    )
    nodes = prefixes.groupBy(author, "prefix").agg(
        F.count(F.lit(1)).alias("n"), F.min("next").alias("lo"), F.max("next").alias("hi"), F.min("spelled").alias("series_name")
    )
    series = nodes.filter((F.col("lo") != F.col("hi")) | ((F.col("hi") == "") & (F.col("n") >= 2))).select(author, "prefix", "series_name")
    return prefixes.join(series, [author, "prefix"]).select(author, "series_name", row_id)


def related_titles(books: DataFrame, author: str, title: str, row_id: str, least_entries: int = 3) -> DataFrame:
    """(row_id, group_id, related): titles of one author that share two significant words with a seed title.

    Authors with fewer than ``least_entries`` rows are left out. Rows are taken in id order: the first free row
    is a seed and takes every later free row that shares two words with it. ``related`` is the size of the
    group, ``group_id`` the seed's id; groups of one row are left out.

    A row is a seed exactly when no earlier seed shares two words with it. So in each round the rows that are
    first in all their word pairs become seeds and take their neighbours out of the game, until no row is
    left. Runs one action per round; each round is written to the shared folder.
    """
    significant = F.array_except(
        F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(title), F.lit("(?U)\\b[a-z]{4,}\\b"), 0))),
        F.array(*[F.lit(w) for w in TITLE_STOP_WORDS]),
    )
    rows = books.select(F.col(row_id).alias("id"), lower_trim(author).alias("a"), significant.alias("words")).filter("a <> '' AND a <> 'nan'")
    rows = attach_group(rows, ["a"], {"entries": F.count(F.lit(1))}).filter((F.col("entries") >= least_entries) & (F.size("words") >= 2))
    titles = rows.groupBy("a", "words").agg(F.min("id").alias("idx"), F.count(F.lit(1)).alias("n"))
    pair = F.flatten(
        F.transform("words", lambda x, i: F.transform(F.slice("words", i + 2, F.size("words")), lambda y: F.concat(x, F.lit(" "), y)))
    )
    edges = cut_lineage(titles.select("a", "idx", F.explode(pair).alias("pair")))
    left, seeds = edges, []
    while not left.isEmpty():
        first = left.groupBy("a", "pair").agg(F.min("idx").alias("m"))
        new = left.join(first, ["a", "pair"]).groupBy("a", "idx").agg(F.min("m").alias("m")).filter("m = idx").select("a", "idx")
        new = cut_lineage(new)
        seeds.append(new)
        taken_pairs = left.join(new, ["a", "idx"], "left_semi").select("a", "pair").distinct()
        taken = left.join(taken_pairs, ["a", "pair"], "left_semi").select("a", "idx").distinct()
        left = cut_lineage(left.join(taken, ["a", "idx"], "left_anti"))
    if not seeds:
        return rows.select(F.col("id").alias(row_id), F.col("id").alias("group_id"), F.lit(0).cast("long").alias("related")).limit(0)
    every = seeds[0]
    for part in seeds[1:]:
        every = every.union(part)
    # two seeds never share two words, so a pair belongs to one seed at most
    seed_pairs = edges.join(every, ["a", "idx"], "left_semi").select("a", "pair", F.col("idx").alias("seed"))
    owner = (
        edges.join(seed_pairs, ["a", "pair"])
        .filter("seed <= idx")
        .groupBy("a", "idx")
        .agg(F.min("seed").alias("seed"))
    )
    grouped = titles.join(owner, ["a", "idx"]).select("a", "words", "seed", "n")
    sizes = grouped.groupBy("a", "seed").agg(F.sum("n").alias("related")).filter("related >= 2")
    return rows.join(grouped.select("a", "words", "seed").join(sizes, ["a", "seed"]), ["a", "words"]).select(
        F.col("id").alias(row_id), F.col("seed").alias("group_id"), "related"
    )
