"""Ladders, flags, dates and length estimates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.config import models
from shelfmark.functions.nulls import col, trim_space


def ladder(c: Column | str, steps: list, default) -> Column:
    """Value of the first bound (highest first) that the column reaches; ``default`` below all, also for NULL."""
    value = col(c)
    out = None
    for bound, label in steps:
        hit = value >= bound
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def upper_flag(c: Column | str, bounds: list, labels: list[str]) -> Column:
    """Label of the first upper bound that holds the value, the last label above all bounds."""
    value = col(c).cast("double")
    out = F.when(value.isNull() | F.isnan(value), F.lit("Data Missing"))
    for bound, label in zip(bounds, labels):
        out = out.when(value <= bound, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def series_type(c: Column | str, rule: str = "crawl") -> Column:
    """Class of a series by its number of books."""
    steps, default = models.SERIES_TYPES[rule]
    label = ladder(c, steps, default)
    if rule == "outreach":
        return F.when(col(c).isNull(), F.lit("Unknown")).otherwise(label)
    return label


def hours(pages: Column | str, rule: str = "report") -> Column:
    """Listening hours estimated from pages."""
    kind, a, b, digits = models.HOURS_FORMULAS[rule]
    value = col(pages).cast("double")
    if kind == "words":
        value = value * a / b
    elif kind == "factor":
        value = value * a
    else:
        value = value / a
    return F.round(value, digits)


def fill_pages(pages: Column | str, books: Column | str, per_book: int = 300) -> Column:
    """Known pages, else books x pages per book."""
    return F.coalesce(F.when(col(pages) > 0, col(pages)), F.when(col(books) > 0, col(books) * per_book))


def pub_year(c: Column | str) -> Column:
    """First run of four digits as a year."""
    return F.regexp_extract(col(c).cast("string"), "([0-9]{4})", 1).try_cast("int")


def pub_date(c: Column | str) -> Column:
    """Text date in one of the known forms."""
    text = trim_space(c)
    forms = ["yyyy-MM-dd", "MM/dd/yyyy", "MMMM d, yyyy", "MMM d, yyyy"]
    return F.coalesce(*[F.try_to_date(text, form) for form in forms])


def series_era(year: Column | str, rule: str = "single", unknown: str | None = "Unknown") -> Column:
    """Era label of a publication year."""
    y = col(year)
    if rule == "single":
        return F.when(y >= 2020, F.lit("After 2020")).when(y < 2020, F.lit("Before 2020")).otherwise(F.lit(unknown))
    if rule == "three":
        return (
            F.when(y >= 2021, F.lit("After 2020"))
            .when(y >= 2015, F.lit("2015-2020"))
            .when(y.isNotNull(), F.lit("Before 2015"))
            .otherwise(F.lit(unknown))
        )
    raise ValueError(f"unknown rule {rule!r}")


def recency_factor(day: Column | str, as_of: Column | str) -> Column:
    """STRUCT(factor, label) by the age of the last publication."""
    age = F.datediff(F.to_date(as_of) if isinstance(as_of, str) else as_of, col(day))
    return F.struct(
        F.when(age < 90, 1.5).when(age < 180, 1.3).when(age < 365, 1.15).otherwise(1.0).alias("factor"),
        F.when(age < 90, F.lit("New Release (<3mo)"))
        .when(age < 180, F.lit("Recent (<6mo)"))
        .when(age < 365, F.lit("Modern (<1yr)"))
        .otherwise(F.lit("Mature"))
        .alias("label"),
    )


def retention(last_count: Column | str, first_count: Column | str) -> Column:
    """STRUCT(ratio, quality) of readers kept from the first to the last book."""
    last, first = col(last_count).cast("double"), col(first_count).cast("double")
    unknown = last.isNull() | first.isNull() | (last <= 0) | (first <= 0)
    mismatch = (first > 10000) & (last < first * 0.01)
    ratio = F.when(~unknown & ~mismatch, F.round(last / first, 4))
    return F.struct(
        ratio.alias("ratio"),
        F.when(unknown, F.lit("N/A"))
        .when(mismatch, F.lit("DATA_SCALE_MISMATCH"))
        .when(ratio >= 0.5, F.lit("STRONG"))
        .when(ratio >= 0.3, F.lit("MODERATE"))
        .otherwise(F.lit("WEAK"))
        .alias("quality"),
    )


def hours_discrepancy(calculated: Column | str, stated: Column | str, tolerance: float = 0.10) -> Column:
    """STRUCT(hours, differs): stated hours win; ``differs`` when the two are more than 10 % apart."""
    a, b = col(calculated), col(stated)
    known = b.isNotNull() & (b > 0)
    return F.struct(
        F.when(known, b).otherwise(a).alias("hours"),
        F.coalesce(known & (F.abs(a - b) / b > tolerance), F.lit(False)).alias("differs"),
    )


def rank_bucket(rank: Column | str, prefix: str = "", default: str | None = None) -> Column:
    """Top 10 / Top 50 / Top 100 of a list rank."""
    r = col(rank)
    out = None
    for bound, label in models.RANK_BUCKETS:
        hit = r <= bound
        out = F.when(hit, F.lit(prefix + label)) if out is None else out.when(hit, F.lit(prefix + label))
    return out.otherwise(F.lit(default))


def outreach_status(length: Column | str, ratings: Column | str, has_contact: Column) -> Column:
    """Five-way readiness of a row for outreach."""
    h, r = col(length), col(ratings)
    return (
        F.when((h >= 40) & (r >= 2000) & has_contact, F.lit("READY"))
        .when((h >= 40) & has_contact, F.lit("READY (low ratings)"))
        .when(h >= 40, F.lit("NEED CONTACT"))
        .when(h > 0, F.lit("BELOW LENGTH THRESHOLD"))
        .otherwise(F.lit("MISSING DATA"))
    )


def promote_status(status: Column | str, length: Column | str, has_contact: Column) -> Column:
    """READY once a contact was found for a long enough row that waited for one."""
    waiting = col(status).isin("NEED CONTACT", "MISSING DATA")
    return F.when(waiting & has_contact & (col(length) >= 40), F.lit("READY")).otherwise(col(status))


def rating_category(count: Column | str) -> Column:
    """Tier of the first book's number of ratings."""
    n = F.coalesce(col(count), F.lit(0))
    return F.when(n >= 20000, F.lit("Tier 1")).when(n >= 5000, F.lit("Tier 2")).otherwise(F.lit("Tier 3"))


def recency_signal(text: Column | str) -> Column:
    """Recency class by the years named in a text."""
    t = F.lower(F.coalesce(col(text), F.lit("")))
    return (
        F.when(t.rlike("2026|2025|2024|2023"), F.lit("Recent"))
        .when(t.rlike("2022|2021|2020|2019|2018"), F.lit("Midlist backlist"))
        .when(F.length(t) > 0, F.lit("Older backlist"))
    )


def audience_signal(count: Column | str) -> Column:
    """Audience class by the total number of ratings."""
    n = col(count)
    return (
        F.when(n >= 100000, F.lit("Large audience"))
        .when(n >= 25000, F.lit("Meaningful audience"))
        .when(n >= 5000, F.lit("Moderate audience"))
        .when(n > 0, F.lit("Niche audience"))
    )


def author_signal(summary: Column | str) -> Column:
    """Market class by the summary of an author."""
    t = F.lower(F.coalesce(trim_space(summary), F.lit("")))
    known = t.rlike("new york times|usa today|wall street journal|bestselling")
    return F.when(known, F.lit("Known / commercially proven")).when(F.length(t) > 0, F.lit("Some market signal"))
