"""List crawls of all genres to scored series. Genres are a column, not a loop."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import fields as dataclass_fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keys import lower_trim
from shelfmark.functions.ladders import hours, pub_year, series_era, series_type
from shelfmark.functions.text import publisher_class
from shelfmark.operators.dedupe import dedup_exact
from shelfmark.operators.filters import verdict_filter
from shelfmark.operators.joins import title_flags
from shelfmark.operators.overlay import apply_by_row
from shelfmark.operators.rollup import BookColumns, series_key, series_rollup
from shelfmark.operators.schema import union_by_name
from shelfmark.operators.scoring import crawl_flags, penalty_score, with_fields
from shelfmark.session import cut_lineage


def genre_series(
    sources: Sequence[DataFrame],
    verdicts: DataFrame | None,
    verdict_keep: Column | None,
    results: DataFrame | None,
    listed: DataFrame | None,
    names: BookColumns = BookColumns(),
    fields: Sequence[str] = ("title", "rating", "count", "day"),
) -> DataFrame:
    """One scored row per (subgenre, series or standalone book), unsorted.

    ``sources``: frames with subgenre, title, author, series_name and the book columns; earlier frames win for
    equal (title, author). ``fields``: see ``series_rollup``; rating and count are needed, the era only comes with the day.
    """
    ranked = [s.withColumn("source_order", F.lit(i)) for i, s in enumerate(sources)]
    books = dedup_exact(union_by_name(*ranked), [names.title, "author"], [F.col("source_order"), F.col(names.row_id)])
    if verdicts is not None:
        books = verdict_filter(books, verdicts, [names.title, "author"], verdict_keep)
    if results is not None:
        books = apply_by_row(books, results, names.row_id, {names.rating: "fill_zero", names.count: "fill_zero"})
    books = books.withColumn("series_key", series_key("series_name", "author", names.title, "standalone"))
    if listed is not None:
        read = ["subgenre", "series_key", "series_name", "author", *(getattr(names, x.name) for x in dataclass_fields(names))]
        books = cut_lineage(books.select(*dict.fromkeys(read)))  # read by the roll-up and by the list matching
    rolled = series_rollup(
        books,
        ["subgenre", "series_key"],
        names,
        extra=[F.min("series_name").alias("series_name"), F.min("author").alias("author")],
        fields=fields,
    )
    alone = F.col("series_key").endswith("|||standalone")
    out = rolled.withColumns(
        {
            "type": F.when(alone, F.lit("Standalone")).otherwise(series_type("books", "crawl")),
            "hours": hours("total_pages", "crawl"),
            "publisher_kind": publisher_class("publisher"),
        }
    )
    if "day" in fields:
        out = out.withColumn("series_era", series_era(pub_year("first_day"), unknown=None))
    out = with_fields(out, crawl_flags("hours", "first_rating", "first_count", "lowest_rating", "highest_rating"))
    out = penalty_score(out, "books", "first_rating", "first_count", "last_count")
    if listed is None:
        return out
    # equal titles have equal flags, so no book is looked up by its id; written, so that Spark knows how few they are
    flags = cut_lineage(title_flags(books, listed, names.title))
    per_series = books.select("subgenre", "series_key", lower_trim(names.title).alias("key")).join(flags, "key")
    # flags name the lists, so their distinct number per series is bounded by the lists
    joined = per_series.groupBy("subgenre", "series_key").agg(F.array_join(F.array_sort(F.collect_set("flags")), " | ").alias("list_flags"))
    return out.join(joined, ["subgenre", "series_key"], "left")
