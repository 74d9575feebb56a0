"""Series master to scored series: de-duplicate, tag by bestseller lists, score, flag, explain, sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import rationale
from shelfmark.operators.dedupe import dedup_first
from shelfmark.operators.joins import rank_list_tags
from shelfmark.operators.scoring import ladder_flags, ladder_score, with_fields
from shelfmark.session import cut_lineage

PARTS = [f"{p}_points" for p in ("hours", "first_rating", "first_count", "lowest_rating", "books", "stability", "era", "bonus")]


def score_master(series: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Scored series, unsorted.

    ``series``: row_id, series_name, author, books, hours, first_title, first_rating, first_count,
    lowest_rating, highest_rating, era, validation and any further columns. ``listed``: see ``rank_list_tags``.
    """
    rows = dedup_first(series, "series_name", "author", [F.col("row_id")])
    if listed is not None:
        rows = cut_lineage(rows)  # the matching reads the series table several times
        tags = rank_list_tags(rows, listed, "row_id", ["series_name", "first_title"], "author", F.col("row_id"))
        rows = rows.join(tags.withColumnsRenamed({"tag": "list_tag"}), "row_id", "left")
    else:
        rows = rows.withColumns({"list_tag": F.lit(None).cast("string"), "best_rank": F.lit(None).cast("int")})
    scored = ladder_score(
        rows, "hours", "first_rating", "first_count", "lowest_rating", "highest_rating", "era", "books", "validation", "list_tag"
    )
    flagged = with_fields(scored, ladder_flags("hours", "first_rating", "first_count", "rating_difference", "effective_lowest"))
    line = rationale("rank", "first_rating", "first_count", "books", "era", "validation")
    return flagged.withColumn("rationale", line).drop(*PARTS, "rating_difference", "effective_lowest")


def sorted_master(scored: DataFrame) -> DataFrame:
    """Highest score first."""
    return scored.orderBy(F.desc("score"), "row_id")
