"""Books nested in a series row: arrays of structs and repeated column groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.nulls import let
from shelfmark.operators.groups import listed

BOOK_JSON = "array<struct<name: string, number: string, rating: double, count: long>>"


def parse_books(c: Column | str) -> Column:
    """ARRAY of books from a JSON column."""
    return F.from_json(c if isinstance(c, Column) else F.col(c), BOOK_JSON)


def nested_summary(books: Column) -> Column:
    """STRUCT(books, first, last, highest, lowest, avg_rating, names) of a nested book array.

    Books are ordered by number, a missing number counts as 0 and text as 999.
    """
    number = lambda b: F.when(F.coalesce(b["number"], F.lit("")) == "", 0.0).otherwise(F.coalesce(b["number"].try_cast("double"), F.lit(999.0)))
    keyed = F.transform(
        books,
        lambda b, i: F.struct(
            number(b).alias("n"), i.alias("i"), b["name"].alias("name"),
            F.coalesce(b["rating"], F.lit(0.0)).alias("rating"), F.coalesce(b["count"], F.lit(0)).alias("count"),
        ),
    )
    # the books are parsed and sorted once, however many fields name them
    return let(F.array_sort(keyed), lambda ordered: let(F.filter(ordered, lambda b: b["rating"] > 0), lambda rated: _summary(ordered, rated)))


def _summary(ordered: Column, rated: Column) -> Column:
    highest = F.array_min(
        F.transform(rated, lambda b: F.struct((-b["rating"]).alias("r"), (-b["count"]).alias("c"), b["n"], b["i"], b["name"].alias("name")))
    )
    lowest = F.array_min(F.transform(rated, lambda b: F.struct(b["rating"].alias("r"), b["n"], b["i"], b["name"].alias("name"))))
    first, last = F.try_element_at(ordered, F.lit(1)), F.try_element_at(ordered, F.lit(-1))
    total = F.aggregate(rated, F.lit(0.0), lambda acc, b: acc + b["rating"])
    return F.struct(
        F.size(ordered).alias("books"),
        first["name"].alias("first_title"), first["rating"].alias("first_rating"), first["count"].alias("first_count"),
        last["name"].alias("last_title"), last["rating"].alias("last_rating"), last["count"].alias("last_count"),
        F.coalesce(highest["name"], first["name"]).alias("highest_title"),
        F.coalesce(lowest["name"], first["name"]).alias("lowest_title"),
        F.when(F.size(rated) > 0, total / F.size(rated)).otherwise(F.lit(0.0)).alias("avg_rating"),
        F.array_join(F.transform(F.filter(ordered, lambda b: F.length(b["name"]) > 0), lambda b: b["name"]), ", ").alias("names"),
    )


def wide_ratings(pairs: Sequence[tuple[Column, Column]], digits: int = 3) -> Column:
    """STRUCT(total_count, avg_rating, trend, kind) of repeated (rating, count) columns.

    Weighted by the counts where one is known, else a plain mean; trend is last minus first rating.
    """
    every = F.array(*[F.struct(r.cast("double").alias("r"), F.greatest(F.coalesce(c.cast("double"), F.lit(0.0)), F.lit(0.0)).alias("c")) for r, c in pairs])
    kept = F.filter(every, lambda x: x["r"] > 0)
    total = F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x["c"])
    points = F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x["r"] * x["c"])
    plain = F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x["r"])
    n = F.size(kept)
    trend = F.when(n >= 2, F.try_element_at(kept, F.lit(-1))["r"] - F.try_element_at(kept, F.lit(1))["r"]).otherwise(F.lit(0.0))
    return F.struct(
        F.when((n > 0) & (total > 0), total.cast("long")).alias("total_count"),
        F.when(n > 0, F.round(F.when(total > 0, points / total).otherwise(plain / n), digits)).alias("avg_rating"),
        F.when(n > 0, F.round(trend, digits)).alias("trend"),
        F.when(n == 0, F.lit("no_ratings")).when(total > 0, F.lit("weighted")).otherwise(F.lit("unweighted")).alias("kind"),
    )


def nest_books(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column) -> DataFrame:
    """Books of each series as structs with their position: (keys, position, value)."""
    return listed(df, keys, F.struct(*[F.col(c) for c in columns]), order)


def series_by_author(df: DataFrame, author: str, columns: Sequence[str], order: Column) -> DataFrame:
    """All series of each author as structs with their position: (author, position, value)."""
    return nest_books(df.filter(F.trim(author) != ""), [author], columns, order)
