"""Scoring models R1 to R9. Inputs are column expressions, outputs columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.config import models
from shelfmark.functions.keys import lower_trim
from shelfmark.functions.ladders import ladder, recency_factor, upper_flag
from shelfmark.functions.nulls import best_count, col, filled_count, is_missing, present
from shelfmark.functions.text import imprint_of
from shelfmark.functions.titles import is_box_set, series_pattern


def _zero(c: Column | str) -> Column:
    value = col(c).cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value)


def _staged(df: DataFrame, *stages: dict[str, Column]) -> DataFrame:
    """Columns added stage by stage; working names start with two underscores and are dropped at the end.

    Spark keeps a stage of its own for a column that later stages name more than once, so a score is computed
    once and not copied into every rank test.
    """
    kept = list(df.columns)
    for stage in stages:
        df = df.withColumns(stage)
        kept += [name for name in stage if not name.startswith("__") and name not in kept]
    return df.select(*[F.col(f"`{c}`") for c in kept])


def ladder_score(df: DataFrame, length, first_rating, first_count, lowest_rating, highest_rating, era, books, *validation) -> DataFrame:
    """Adds the additive 0-100 model: score, rank, its eight parts, rating_difference, effective_lowest.

    A missing lowest rating is estimated as 0.8 x first rating, and the estimate also counts for stability.
    """
    inputs = {
        "__hours": _zero(length), "__first_rating": _zero(first_rating), "__first_count": _zero(first_count),
        "__books": _zero(books), "__low": _zero(lowest_rating), "__highest": _zero(highest_rating),
        "__era": lower_trim(era),
        "__text": F.lower(F.concat_ws(" ", *[F.coalesce(col(v), F.lit("")) for v in validation])) if validation else F.lit(""),
    }
    lowest = F.when(F.col("__low") <= 0, F.col("__first_rating") * 0.8).otherwise(F.col("__low"))
    both = (F.col("__highest") > 0) & (F.col("effective_lowest") > 0)
    difference = F.when(both, F.abs(F.col("__highest") - F.col("effective_lowest")))
    sources = {"hours": "__hours", "first_rating": "__first_rating", "first_count": "__first_count", "lowest_rating": "effective_lowest", "books": "__books"}
    parts = {name: ladder(F.col(sources[name]), *models.LADDER_SCORE[name]) for name in models.LADDER_SCORE}
    stability = F.when(F.col("rating_difference").isNull(), 5)
    for bound, points in models.STABILITY_STEPS:
        stability = stability.when(F.col("rating_difference") < bound, points)
    parts["stability"] = stability.otherwise(2)
    era_points = None
    for words, points in models.ERA_WORDS:
        hit = reduce(lambda a, b: a | b, [F.col("__era").contains(w) for w in words])
        era_points = F.when(hit, points) if era_points is None else era_points.when(hit, points)
    parts["era"] = era_points.otherwise(models.ERA_DEFAULT)
    bonus = reduce(lambda a, b: a + b, [F.when(F.col("__text").rlike(p), n).otherwise(0) for p, n in models.LIST_BONUS])
    parts["bonus"] = F.least(bonus, F.lit(models.LIST_BONUS_CAP))
    total = reduce(lambda a, b: a + b, [F.col(f"{name}_points") for name in parts])
    return _staged(
        df,
        inputs,
        {"effective_lowest": lowest},
        {"rating_difference": difference},
        {f"{name}_points": p for name, p in parts.items()},
        {"score": F.least(F.greatest(total, F.lit(0)), F.lit(100))},
        {"rank": ladder("score", *models.LADDER_RANKS)},
    )


def ladder_flags(length, first_rating, first_count, rating_difference, effective_lowest) -> Column:
    """STRUCT of the five flags that go with ``ladder_score``."""
    rating, count, difference = _zero(first_rating), _zero(first_count), col(rating_difference)
    return F.struct(
        ladder(_zero(length), *models.LOWER_FLAGS["adaptation_length"]).alias("length_flag"),
        ladder(rating, *models.LOWER_FLAGS["first_rating"]).alias("first_rating_flag"),
        F.when((rating >= 4.2) & (count >= 5000), F.lit("High"))
        .when((rating >= 3.8) | (count >= 1000), F.lit("Medium"))
        .otherwise(F.lit("Low"))
        .alias("appeal_flag"),
        ladder(effective_lowest, *models.LOWER_FLAGS["lowest_rating"]).alias("lowest_flag"),
        F.when(difference.isNull(), F.lit("Stable"))
        .when(difference < 0.3, F.lit("Very Stable"))
        .when(difference < 0.5, F.lit("Stable"))
        .otherwise(F.lit("Variable"))
        .alias("stability_flag"),
    )


def _capped_percent(value: Column, top: float) -> Column:
    return F.least(value / top, F.lit(1.0)) * 100


def volume_points(books: Column | str) -> Column:
    """40 / 60 / 85 / 100 for a standalone, short, middle and long series."""
    n = col(books)
    return F.when(n == 1, 40.0).when(n < 3, 60.0).when(n <= 5, 85.0).otherwise(100.0)


def peak_points(rank: Column | str) -> Column:
    """15 for list rank 1, 10 up to 10, 5 up to 100."""
    r = col(rank)
    return F.when(r == 1, 15.0).when(r <= 10, 10.0).when(r <= 100, 5.0).otherwise(0.0)


def weighted_score(df: DataFrame, books, first_rating, avg_rating, first_count, last_count, last_day=None, as_of=None, best_rank=None, independent=None) -> DataFrame:
    """Adds score, rank, recency and rationale of the weighted percentage model.

    A part below 0.1 counts as 80 (missing data). Readers kept are raised by recency; a list rank adds up to
    15; an independent publisher multiplies by 1.2.
    """

    def doubt(score: Column) -> Column:
        return F.when(score < 0.1, models.DOUBT_SCORE).otherwise(score)

    w = models.WEIGHTED
    recency = recency_factor(last_day, as_of) if last_day is not None else F.struct(F.lit(1.0).alias("factor"), F.lit("Mature").alias("label"))
    kept = F.when(F.col("__count") > 0, _zero(last_count) / F.col("__count")).otherwise(0.0)
    base = (
        F.col("__q1") * w["quality_first"] + F.col("__qavg") * w["quality_avg"] + F.col("__kept") * w["retention"]
        + F.col("__appeal") * w["appeal"] + F.col("__volume") * w["volume"] + F.col("__peak")
    )
    score = F.when(independent, base * models.INDEPENDENT_FACTOR).otherwise(base) if independent is not None else base
    whole = [F.col(c).cast("int") for c in ("__volume", "__q1", "__qavg", "__kept", "__appeal", "__peak")]
    text = F.format_string("Score: %d [%s] (Vol:%d Q1:%d QAvg:%d R:%d A:%d Peak:+%d)", F.col("score").cast("int"), F.col("recency"), *whole)
    return _staged(
        df,
        {"__count": _zero(first_count), "__factor": recency["factor"], "recency": recency["label"]},
        {"__keep": _capped_percent(F.least(kept * F.col("__factor"), F.lit(1.0)), 0.5)},
        {
            "__q1": doubt(_capped_percent(_zero(first_rating), 5.0)),
            "__qavg": doubt(_capped_percent(_zero(avg_rating), 5.0)),
            "__kept": doubt(F.col("__keep")),
            "__appeal": doubt(_capped_percent(F.col("__count"), 10000.0)),
            "__volume": volume_points(books),
            "__peak": peak_points(best_rank) if best_rank is not None else F.lit(0.0),
        },
        {"score": F.round(score, 6)},
        {"rank": ladder("score", *models.WEIGHTED_RANKS), "rationale": text},
    )


def penalty_score(df: DataFrame, books, first_rating, first_count, last_count) -> DataFrame:
    """Adds score and rank of the weighted model that ranks series below 3 books last."""
    w = models.PENALTY_WEIGHTS
    rating, first, last = _zero(first_rating), _zero(first_count), _zero(last_count)
    missing = F.lit(models.DOUBT_SCORE)
    volume = F.least(col(books) / 8.0 * 100, F.lit(100.0))
    quality = F.when(rating > 0, rating / 5.0 * 100).otherwise(missing)
    kept = F.when((first > 0) & (last > 0), F.least(last / first * 100, F.lit(100.0))).otherwise(missing)
    appeal = F.when(first > 0, F.least(first / 1000 * 10, F.lit(100.0))).otherwise(missing)
    total = w["volume"] * volume + w["quality"] * quality + w["retention"] * kept + w["appeal"] * appeal
    rank = F.when(col(books) < 3, F.lit("P5")).otherwise(ladder("__total", *models.PENALTY_RANKS))
    return _staged(df, {"__total": F.round(total, 6)}, {"score": F.round("__total", 1), "rank": rank})


def crawl_flags(length, first_rating, first_count, lowest_rating, highest_rating) -> Column:
    """STRUCT of the five Low to Very High flags."""
    low, high = _zero(lowest_rating), _zero(highest_rating)
    stability = F.when((low > 0) & (high > 0), 1 - (high - low))
    f = models.UPPER_FLAGS
    return F.struct(
        upper_flag(length, *f["hours"]).alias("length_flag"),
        upper_flag(first_rating, *f["first_rating"]).alias("first_rating_flag"),
        upper_flag(first_count, *f["first_count"]).alias("appeal_flag"),
        upper_flag(lowest_rating, *f["lowest_rating"]).alias("lowest_flag"),
        upper_flag(stability, *f["stability"]).alias("stability_flag"),
    )


def bucket_score(bucket, first_rating, first_count, last_rating, last_count, era) -> Column:
    """Additive model with the list bucket; missing parts count 80 %."""
    b = F.coalesce(col(bucket), F.lit(""))
    r, c, lr, lc = (col(x).cast("double") for x in (first_rating, first_count, last_rating, last_count))
    e = F.coalesce(col(era), F.lit(""))
    top = F.when(b.rlike("Top 10(?!0)"), 15).when(b.contains("Top 50"), 10).when(b.contains("Top 100"), 5).otherwise(0)
    rating = F.when(r.isNull(), 20).when(r > 4.5, 25).when(r >= 4.2, 20).when(r >= 4.0, 15).when(r >= 3.8, 10).when(r >= 3.5, 5).otherwise(0)
    count = F.when(c.isNull() | (c <= 0), 24).when(c > 20000, 30).when(c > 10000, 25).when(c >= 5000, 18).when(c >= 1000, 10).otherwise(8)
    delta = F.when(r.isNull() | lr.isNull(), 8).when(lr - r >= -0.1, 10).otherwise(0)
    kept = F.when(c.isNull() | lc.isNull() | (c <= 0), 8).when(lc / c > 0.6, 10).when(lc / c > 0.4, 5).otherwise(0)
    age = F.when(e.contains("After 2020"), 10).when(e.contains("Before 2020"), 5).otherwise(8)
    return F.least(top + rating + count + delta + kept + age, F.lit(100))


def bucket_rank(score, kind, publisher, author) -> Column:
    """Rank of ``bucket_score``: short series last, big publishers not above P2."""
    p, a = lower_trim(publisher), lower_trim(author)
    independent = p.contains("indie") | p.contains("self") | (p == "") | (p == "nan") | a.contains(p) | ((a != "") & p.contains(a))
    rank = ladder(score, *models.BUCKET_RANKS)
    return (
        F.when(col(kind).isin("Standalone", "Short Series"), F.lit("P5"))
        .when(~independent & rank.isin("P0", "P1"), F.lit("P2"))
        .otherwise(rank)
    )


def expansion_score(df: DataFrame, length, first_rating, first_count, lowest_rating, pub_year) -> DataFrame:
    """Adds score and rank: five ladders, a missing input adds nothing; NULL when all are missing."""
    inputs = {"hours": length, "first_rating": first_rating, "first_count": first_count, "lowest_rating": lowest_rating, "pub_year": pub_year}
    points = [F.when(_zero(c) != 0, ladder(_zero(c), *models.EXPANSION[name])).otherwise(0) for name, c in inputs.items()]
    score = F.nullif(F.col("__points"), F.lit(0))
    return _staged(
        df,
        {"__points": reduce(lambda a, b: a + b, points)},
        {"score": score},
        {"rank": F.when(F.col("score").isNotNull(), ladder("score", *models.EXPANSION_RANKS))},
    )


def sanity_issues(kind, books, source_books, pages, series, first_book, last_book, email=None) -> Column:
    """ARRAY of contradictions in a series row, in check order."""
    n, p, s = col(books).cast("double"), col(pages).cast("double"), col(source_books).cast("double")
    sized = n > 0
    per_book = p / n
    first, last = lower_trim(first_book), lower_trim(last_book)
    checks = [
        ("TYPE_MISMATCH", lower_trim(kind).contains("standalone") & (n > 1)),
        ("SAME_FIRST_LAST", (first != "") & (first == last) & (n > 1)),
        ("PAGES_ZERO", sized & p.isin(0.0, 1.0)),
        ("PAGES_LOW", sized & ~p.isin(0.0, 1.0) & (per_book < 50)),
        ("PAGES_HIGH", sized & (per_book > 900)),
        ("SERIES_IS_BOOK_TITLE", (first != "") & (lower_trim(series) == first)),
        ("BOOKS_DEFAULT3", (s == 3) & n.isNull()),
        ("PAGES_FORMULA", sized & ((p == n * 300) | (p == n * 250))),
        ("BOOKS_EXTREME", n >= 50),
    ]
    if email is not None:
        from shelfmark.functions.contacts import looks_fabricated

        checks.append(("EMAIL_FABRICATION_PATTERN", looks_fabricated(email)))
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in checks]))


CRITICAL_ISSUES = ["TYPE_MISMATCH", "SAME_FIRST_LAST", "PAGES_ZERO", "SERIES_IS_BOOK_TITLE"]


def quality_flag(issues: Column | str, critical: Sequence[str] = CRITICAL_ISSUES) -> Column:
    """RED for a critical issue or three issues, YELLOW for any, else GREEN."""
    found = col(issues)
    hard = F.arrays_overlap(found, F.array(*[F.lit(c) for c in critical]))
    return F.when(hard | (F.size(found) >= 3), F.lit("RED")).when(F.size(found) > 0, F.lit("YELLOW")).otherwise(F.lit("GREEN"))


def final_quality_flag(issues: Column | str, has_verified_name: Column, has_email: Column, critical: Sequence[str] = CRITICAL_ISSUES) -> Column:
    """Flag after the repairs: also needs a verified name, and an e-mail for GREEN."""
    found = col(issues)
    hard = F.arrays_overlap(found, F.array(*[F.lit(c) for c in critical]))
    soft = F.arrays_overlap(found, F.array(F.lit("PAGES_FORMULA"), F.lit("BOOKS_DEFAULT3")))
    return F.when(hard | ~has_verified_name, F.lit("RED")).when(soft | ~has_email, F.lit("YELLOW")).otherwise(F.lit("GREEN"))


def worst_flag(*flags: Column | str) -> Column:
    """Most severe of several flags, RED when all are blank."""
    ranked = [
        F.when(F.upper(F.trim(col(f))).isin(*models.SEVERITY_ORDER), F.create_map(*[F.lit(x) for kv in models.SEVERITY_ORDER.items() for x in kv])[F.upper(F.trim(col(f)))])
        for f in flags
    ]
    worst = F.greatest(*ranked) if len(ranked) > 1 else ranked[0]
    return F.when(worst == 0, F.lit("GREEN")).when(worst == 1, F.lit("YELLOW")).otherwise(F.lit("RED"))


def imprint_verdict(publisher, confidence, source, support_publisher, catalogue_source: str = "catalog_search") -> Column:
    """STRUCT(flag, imprint, status) of an audio-imprint check from a product match or a support list."""
    matched = ~is_missing(publisher) | (col(source) == catalogue_source)
    imprint, sure = imprint_of(publisher), col(confidence) != "low"
    listed = col(source) == catalogue_source

    def row(flag: str | None, name: Column, status: str) -> Column:
        return F.struct(F.lit(flag).cast("string").alias("flag"), name.alias("imprint"), F.lit(status).alias("status"))

    none = F.lit(None).cast("string")
    support = F.coalesce(imprint_of(support_publisher), col(support_publisher))
    return (
        F.when(matched & listed & sure, row("yes", F.coalesce(imprint, col(publisher)), "confirmed_yes"))
        .when(matched & imprint.isNotNull() & sure, row("yes", imprint, "confirmed_yes"))
        .when(matched & imprint.isNotNull(), row(None, imprint, "needs_review"))
        .when(matched & sure & ~is_missing(publisher), row("no", none, "confirmed_no"))
        .when(matched, row(None, none, "needs_review"))
        .when(~is_missing(support_publisher), row(None, support, "needs_review"))
        .otherwise(row(None, none, "needs_review"))
    )


def verification_state(title, first_book, books, verified, related: Column) -> Column:
    """STRUCT(state, method, books, verified_books) of the two offline verification layers.

    A series pattern in title or first book gives Yes; a cluster of related titles of the author (its size in
    ``related``, NULL without one) gives Likely. Box sets count at least 3 books.
    """
    n = F.coalesce(best_count(books), F.lit(0))
    open_row = ~lower_trim(verified).isin("yes", "true", "verified") & (n < 3)
    pattern = series_pattern(title, first_book)
    by_title = open_row & pattern.isNotNull()
    boxed = by_title & is_box_set(title, first_book) & (n < 3)
    by_author = ~by_title & ~F.coalesce(present(verified) == "Yes", F.lit(False)) & related.isNotNull()
    return F.struct(
        F.when(by_title, F.lit("Yes")).when(by_author, F.lit("Likely")).otherwise(present(verified)).alias("state"),
        F.when(by_title, pattern).when(by_author, F.lit("author_cluster")).alias("method"),
        F.when(boxed, F.lit(3)).otherwise(n).cast("long").alias("books"),
        F.when(boxed, F.lit(3)).when(by_author & (related > n), related).cast("long").alias("verified_books"),
    )


def completeness(columns: Sequence[str], weights: dict[str, int] | None = None) -> Column:
    """Number, or weighted sum, of filled columns."""
    if weights is None:
        return filled_count(list(columns))
    return reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), weights.get(c, 1)).otherwise(0) for c in columns])


def with_fields(df: DataFrame, value: Column, prefix: str = "") -> DataFrame:
    """Every field of a struct value as a column."""
    out = df.withColumn("__v", value)
    fields = out.schema["__v"].dataType.names
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in {prefix + f for f in fields}], *[F.col("__v")[f].alias(prefix + f) for f in fields])
