"""Book table to ranked series report: de-duplicate, ban filter, results overlay, roll-up, weighted score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keys import lower_trim
from shelfmark.functions.ladders import hours, series_type
from shelfmark.functions.text import publisher_class
from shelfmark.operators.dedupe import dedup_most_complete
from shelfmark.operators.filters import ban_reason, split
from shelfmark.operators.overlay import apply_by_row
from shelfmark.operators.ranking import label_order
from shelfmark.operators.rollup import BookColumns, series_rollup
from shelfmark.operators.scoring import weighted_score


def series_report(books: DataFrame, as_of: str, results: DataFrame | None = None, names: BookColumns = BookColumns()) -> DataFrame:
    """One scored row per series, unsorted.

    ``books``: series_name, subgenre and the book columns. ``results`` (row id, rating, rating_count, pages)
    fill blank or zero cells.
    """
    rows = dedup_most_complete(books, "series_name", names.title, [F.col(names.row_id)])
    rows, _ = split(rows, ban_reason("subgenre", "series_name", names.title))
    if results is not None:
        rows = apply_by_row(rows, results, names.row_id, {names.rating: "fill_zero", names.count: "fill_zero", names.pages: "fill_zero"})
    rows = rows.withColumn("series_key", lower_trim("series_name")).filter("series_key <> ''")
    rolled = series_rollup(rows, ["series_key"], names, last_by="date", default_pages=300)
    out = rolled.withColumns(
        {
            "type": series_type("books", "report"),
            "hours": hours("total_pages", "report"),
            "independent": publisher_class("publisher", "Indie").isin("Self-Pub", "Indie"),
        }
    )
    return weighted_score(
        out, "books", "first_rating", "avg_rating", "first_count", "last_count", "last_day", F.lit(as_of).cast("date"), None, F.col("independent")
    )


def sorted_report(report: DataFrame) -> DataFrame:
    """Best rank first, then the highest first rating."""
    return report.orderBy(label_order("rank"), F.desc_nulls_last("first_rating"), "series_key")
