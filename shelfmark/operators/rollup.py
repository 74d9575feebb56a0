"""Books rolled up to series in one aggregation, and the counts and reports made from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keys import lower_trim
from shelfmark.functions.ladders import rank_bucket, series_era
from shelfmark.functions.nulls import col, is_missing
from shelfmark.operators.filters import is_collection
from shelfmark.operators.groups import attach_group, top_per_key


@dataclass(frozen=True)
class BookColumns:
    """Names of the book columns; ``row_id`` is unique and orders equal book numbers."""

    title: str = "title"
    number: str = "book_number"
    day: str = "pub_date"
    rating: str = "rating"
    count: str = "rating_count"
    pages: str = "pages"
    publisher: str = "publisher"
    row_id: str = "book_id"


def series_key(series: Column | str, author: Column | str, title: Column | str, mode: str = "series+author") -> Column:
    """Group key: ``series``, ``series+author``, or ``standalone`` (a book without a series is its own series)."""
    s, a, t = lower_trim(series), lower_trim(author), lower_trim(title)
    if mode == "series":
        return s
    if mode == "series+author":
        return F.concat(s, F.lit("|||"), a)
    if mode == "standalone":
        alone = F.concat(t, F.lit("|||"), a, F.lit("|||standalone"))
        return F.when(is_missing(series), alone).otherwise(F.concat(s, F.lit("|||"), a))
    raise ValueError(f"unknown mode {mode!r}")


def series_rollup(
    books: DataFrame,
    keys: Sequence[str],
    names: BookColumns = BookColumns(),
    last_by: str = "number",
    default_pages: int | None = None,
    extra: Sequence[Column] = (),
    fields: Sequence[str] = ("title", "rating", "count", "day"),
) -> DataFrame:
    """One row per key: counts, pages, ratings, and the first, last, highest and lowest rated member.

    Members are ordered by book number (unknown numbers last) and row id. ``last_by='date'`` takes the member
    published last instead. Only ratings above 0 count; ties go to the larger rating count, then to the order.
    ``default_pages`` stands in for missing pages. ``fields``: what is wanted of the members; fewer make narrower rows.
    """
    n = names
    member = F.struct(*[F.col(getattr(n, x)).alias(x) for x in fields])
    number, row_id = F.col(n.number), F.col(n.row_id)
    position = F.struct(number.isNull().alias("x"), number.alias("n"), row_id.alias("i"))
    rated = F.col(n.rating) > 0
    last_position = position
    if last_by == "date":
        last_position = F.struct(F.col(n.day).isNotNull().alias("d"), F.col(n.day).alias("v"), position.alias("p"))
    elif last_by != "number":
        raise ValueError(f"unknown order {last_by!r}")
    highest = F.struct((-F.col(n.rating)).alias("r"), (-F.coalesce(F.col(n.count), F.lit(0))).alias("c"), position.alias("p"))
    lowest = F.struct(F.col(n.rating).alias("r"), position.alias("p"))
    pages = F.col(n.pages)
    if default_pages is not None:
        pages = F.coalesce(F.nullif(pages, F.lit(0)), F.lit(default_pages))
    grouped = books.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("books"),
        F.sum(pages).cast("long").alias("total_pages"),
        F.avg(pages).alias("avg_pages"),
        F.avg(F.when(rated, F.col(n.rating))).alias("avg_rating"),
        F.sum(n.count).cast("long").alias("rating_count_sum"),
        (F.sum(F.when(rated, F.col(n.rating) * F.col(n.count))) / F.nullif(F.sum(F.when(rated, F.col(n.count))), F.lit(0))).alias("weighted_rating"),
        F.min(F.year(n.day)).alias("first_year"),
        F.min(F.struct(position.alias("o"), member.alias("m"))).alias("__first"),
        F.max(F.struct(last_position.alias("o"), member.alias("m"))).alias("__last"),
        F.min(F.when(rated, F.struct(highest.alias("o"), member.alias("m")))).alias("__highest"),
        F.min(F.when(rated, F.struct(lowest.alias("o"), member.alias("m")))).alias("__lowest"),
        F.min(F.when(~is_missing(n.publisher), F.struct(position.alias("o"), F.col(n.publisher).alias("m")))).alias("__publisher"),
        *extra,
    )
    kept = [c for c in grouped.columns if not c.startswith("__")]
    flat = [F.col("__publisher.m").alias("publisher")]
    for label in ("first", "last", "highest", "lowest"):
        flat += [F.col(f"__{label}.m.{x}").alias(f"{label}_{x}") for x in fields if x != "day"]
    days = [F.col(f"__{label}.m.day").alias(f"{label}_day") for label in ("first", "last") if "day" in fields]
    return grouped.select(*kept, *flat, *days)


def rated_or_first(df: DataFrame) -> DataFrame:
    """Series without any rating: the first member stands in as highest and lowest."""
    changed = {}
    for label in ("highest", "lowest"):
        none = F.col(f"{label}_title").isNull()
        for field in ("title", "rating", "count"):
            changed[f"{label}_{field}"] = F.when(none, F.col(f"first_{field}")).otherwise(F.col(f"{label}_{field}"))
    return df.withColumns(changed)


def _joined_texts(entries: DataFrame, keys: Sequence[str], text: str, order: Column, values: dict[str, Column], separator: str, name: str) -> DataFrame:
    """Texts per key in order, joined. Copies of a text are merged first, so a cell holds distinct texts only.

    Callers pass entries limited to list ranks, whose distinct texts are bounded by the lists.
    """
    distinct = entries.groupBy(*keys, F.col(text).alias("__t")).agg(
        F.count(F.lit(1)).alias("__n"), F.min(order).alias("__o"), *[v.alias(k) for k, v in values.items()]
    )
    texts = F.transform(F.array_sort(F.collect_list(F.struct(F.col("__o").alias("o"), F.col("__t").alias("t")))), lambda x: x["t"])
    return distinct.groupBy(*keys).agg(
        F.array_join(texts, separator).alias(name),
        F.sum("__n").alias("featured"),
        *[F.min(k).alias(k) for k in values],
    )


def featured_list(books: DataFrame, keys: Sequence[str], title: str, order: Column, ranks: dict[str, str]) -> DataFrame:
    """(keys, featured_text, featured, best_rank, bucket) of members that stand on a bestseller list.

    ``ranks`` maps a list label to its rank column; the text of a member is ``title (Label #3, Label #7)``.
    """
    parts = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{label} #"), F.col(c).cast("int").cast("string"))) for label, c in ranks.items()]
    best = F.least(*[F.col(c) for c in ranks.values()]) if len(ranks) > 1 else F.col(next(iter(ranks.values())))
    listed = books.withColumn("__best", best).filter("__best IS NOT NULL")
    listed = listed.withColumn("__text", F.concat(F.col(title), F.lit(" ("), F.concat_ws(", ", *parts), F.lit(")")))
    out = _joined_texts(listed, keys, "__text", order, {"best_rank": F.min("__best")}, " | ", "featured_text")
    return out.withColumn("bucket", rank_bucket("best_rank", default="No List"))


def category_rank(*texts: Column | str, words: Sequence[str] = ("sports", "hockey"), limit: int = 100) -> Column:
    """STRUCT(rank, category) of the best ``#12 in Category`` in the texts whose category names one of the words."""
    text = F.concat_ws(" ", *[col(t) for t in texts])
    pattern = "#([0-9,]+)\\s+in\\s+([\\p{L}\\p{N}_\\s&]+)"
    found = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), 1).alias("r"), F.regexp_extract_all(text, F.lit(pattern), 2).alias("c")
    )
    typed = F.transform(
        found,
        lambda x, i: F.struct(
            F.replace(x["r"], F.lit(","), F.lit("")).try_cast("int").alias("rank"), i.alias("i"), F.trim(x["c"]).alias("category")
        ),
    )
    kept = F.filter(typed, lambda x: (x["rank"] <= limit) & F.lower(x["category"]).rlike("|".join(words)))
    best = F.array_min(kept)
    return F.when(best.isNotNull(), F.struct(best["rank"].alias("rank"), best["category"].alias("category")))


def validation_text(books: DataFrame, keys: Sequence[str], title: str, order: Column, best: Column, default: str) -> DataFrame:
    """(keys, validation): ``title: #r in category`` of every ranked member, joined; ``default`` without any."""
    marked = books.withColumn("__b", best)
    marked = marked.withColumn("__text", F.concat(F.col(title), F.lit(": #"), F.col("__b.rank").cast("string"), F.lit(" in "), F.col("__b.category")))
    texts = _joined_texts(marked.filter("__text IS NOT NULL"), keys, "__text", order, {}, " | ", "validation").drop("featured")
    return books.select(*keys).distinct().join(texts, list(keys), "left").withColumn("validation", F.coalesce("validation", F.lit(default)))


def first_in_order(books: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column) -> DataFrame:
    """Per key the first filled value of each column in the order."""
    return books.groupBy(*keys).agg(*[F.min_by(c, F.when(~is_missing(c), order)).alias(c) for c in columns])


def weighted_rating(books: DataFrame, keys: Sequence[str], rating: str, count: str) -> DataFrame:
    """(keys, books, total_count, avg_rating): ratings weighted by their counts, 0 without any."""
    c = F.coalesce(F.col(count), F.lit(0))
    points = F.sum(F.coalesce(F.col(rating), F.lit(0.0)) * c)
    total = F.sum(c)
    return books.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("books"), total.cast("long").alias("total_count"),
        F.when(total > 0, F.round(points / total, 2)).otherwise(F.lit(0.0)).alias("avg_rating"),
    )


def series_dates(books: DataFrame, keys: Sequence[str], year: str, featured: Column) -> DataFrame:
    """Every book with first publication year, era and number of listed books of its series."""
    out = attach_group(
        books, list(keys), {"first_year": F.min(year), "listed_books": F.count(F.when(featured, F.lit(1)))}
    )
    return out.withColumn("series_era", series_era("first_year"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, n), most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def gap_to_target(df: DataFrame, group: str, target: int = 500) -> DataFrame:
    """(group, n, missing): how many rows each group lacks to the target."""
    counted = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("missing", F.greatest(F.lit(target) - F.col("n"), F.lit(0)))


def bucket_counts(df: DataFrame, count: Column, group: Sequence[str] = ()) -> DataFrame:
    """Number of rows with 1, 2, 3-5, 6-10, 11-20, more than 20 and an unknown number of books."""

    def n(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, F.lit(1))).alias(name)

    return df.groupBy(*group).agg(
        n(count == 1, "books_1"), n(count == 2, "books_2"), n(count.between(3, 5), "books_3_5"),
        n(count.between(6, 10), "books_6_10"), n(count.between(11, 20), "books_11_20"), n(count > 20, "books_over_20"),
        n(count.isNull() | (count <= 0), "books_unknown"),
    )


def score_stats(df: DataFrame, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Mean, median, least and largest score."""
    return df.groupBy(*group).agg(
        F.round(F.avg(score), 4).alias("mean"), F.median(score).alias("median"), F.min(score).alias("least"), F.max(score).alias("largest")
    )


def coverage(df: DataFrame, group: Sequence[str], filled: Column) -> DataFrame:
    """(group, n, filled, percent) of rows that satisfy the condition."""
    hits = F.count(F.when(filled, F.lit(1)))
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), hits.alias("filled"), F.round(hits * 100.0 / F.count(F.lit(1)), 2).alias("percent")
    )


def works_count(df: DataFrame, keys: Sequence[str], info: str) -> DataFrame:
    """(keys, primary_works, total_works): main works carry a whole ``#n``."""
    primary = F.col(info).rlike("#[0-9]+$|#[0-9]+\\s") & ~F.col(info).contains(".")
    return df.groupBy(*keys).agg(F.count(F.when(primary, F.lit(1))).alias("primary_works"), F.count(F.lit(1)).alias("total_works"))


def consolidate_rows(df: DataFrame, canonical: str, books: str, listed: str, bucket: str, year: str) -> DataFrame:
    """Variants of one series merged: sums, the best bucket, the earliest year and its era."""
    order = F.when(F.col(bucket).contains("Top 100"), 3).when(F.col(bucket).contains("Top 50"), 2).when(F.col(bucket).contains("Top 10"), 1).otherwise(4)
    return (
        df.groupBy(canonical)
        .agg(
            F.sum(books).cast("long").alias(books), F.sum(listed).cast("long").alias(listed),
            F.min(F.struct(order.alias("o"), F.col(bucket).alias("b"))).alias("__b"), F.min(year).alias(year),
        )
        .withColumn(bucket, F.col("__b.b"))
        .withColumn("series_era", series_era(year))
        .drop("__b")
    )


def summarise_series(books: DataFrame, keys: Sequence[str], title: str, title_key: Column, points: Column, number: str, day: str, pages: str, declared: str, row_id: str) -> DataFrame:
    """Per series: best record per title, collections left out (unless there is nothing else), declared
    against observed number of books, and total pages only when every book's pages are known."""
    best = top_per_key(books.withColumn("__t", title_key), [*keys, "__t"], [points.desc(), F.col(row_id)])
    main = ~is_collection(title)
    no_number = F.col(number).isNull() | (F.col(number) <= 0)
    position = F.struct(
        no_number.alias("x"), F.coalesce(number, F.lit(0.0)).alias("n"), F.coalesce(F.col(day).cast("string"), F.lit("")).alias("d"),
        F.lower(title).alias("t"), F.col(row_id).alias("i"),
    )

    def both(f) -> tuple[Column, Column]:
        return f(main), f(F.lit(True))

    def pick(name: str, f) -> Column:
        some, every = both(f)
        return F.when(F.count(F.when(main, F.lit(1))) > 0, some).otherwise(every).alias(name)

    grouped = best.groupBy(*keys).agg(
        pick("observed", lambda c: F.count(F.when(c, F.lit(1)))),
        pick("declared", lambda c: F.max(F.when(c, F.col(declared)))),
        pick("known_pages", lambda c: F.count(F.when(c, F.col(pages)))),
        pick("pages_sum", lambda c: F.sum(F.when(c, F.col(pages)))),
        pick("first_book", lambda c: F.min_by(title, F.when(c, position))),
        pick("last_book", lambda c: F.max_by(title, F.when(c, position))),
    )
    size = F.greatest(F.col("observed"), F.coalesce(F.col("declared").cast("long"), F.lit(0)))
    complete = size == F.col("observed")
    return grouped.select(
        *keys, "observed", "declared", size.alias("books_in_series"), complete.alias("complete"), "first_book", "last_book",
        F.when(complete & (F.col("known_pages") == F.col("observed")), F.col("pages_sum")).cast("long").alias("total_pages"),
    )


def row_ledger(df: DataFrame, step: str):
    """(frame, observation): counts the rows of a step while the job runs, without a pass of its own."""
    from pyspark.sql import Observation

    observation = Observation(step)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
