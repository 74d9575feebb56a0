"""Joins on exact keys, ranges, containment and rank lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.config import models
from shelfmark.functions.keys import lower_trim, punctuation_free_key, rank_list_key, spaced_key
from shelfmark.functions.ladders import rank_bucket
from shelfmark.functions.nulls import col
from shelfmark.operators.containment import small_list_pairs, touching_texts
from shelfmark.operators.groups import Keys, key_columns, top_per_key


def keyed_left_join(left: DataFrame, right: DataFrame, left_keys: Keys, right_keys: Keys, columns: Sequence[str], order: Sequence[Column], suffix: str = "_2") -> DataFrame:
    """Left join to the first right row per key; a column name both sides have gets the suffix."""
    a, names = key_columns(left, left_keys)
    right_names = [f"__r{i}" for i in range(len(right_keys))]
    b = right.withColumns({n: col(k) for n, k in zip(right_names, right_keys)})
    one = top_per_key(b, right_names, order).select(
        *right_names,
        *[F.col(f"`{c}`").alias(c + suffix if c in left.columns else c) for c in columns],
    )
    condition = [F.col(n) == F.col(r) for n, r in zip(names, right_names)]
    return a.join(one, condition, "left").drop(*names, *right_names)


def answers_by_title(asked: DataFrame, answers: DataFrame, title: str, answer_title: str, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Requested titles with the columns of the first answer (in the order) of the same title, case and outer space aside."""
    return keyed_left_join(asked, answers, [lower_trim(title)], [lower_trim(answer_title)], columns, order)


def lookup(df: DataFrame, table: DataFrame, key: Column, table_key: Column, value: str, name: str, default, order: Column) -> DataFrame:
    """Left lookup of one value, ``default`` where the key is unknown. Of a repeated key the first row in the order counts."""
    one = table.groupBy(table_key.alias("__lk")).agg(F.min_by(value, order).alias("__lv"))
    joined = df.withColumn("__dk", key).join(one, F.col("__dk") == F.col("__lk"), "left")
    return joined.withColumn(name, F.coalesce(F.col("__lv"), F.lit(default))).drop("__dk", "__lk", "__lv")


def in_set(df: DataFrame, members: DataFrame, keys: Keys, member_keys: Keys) -> DataFrame:
    """Rows whose key is in the set."""
    return _membership(df, members, keys, member_keys, "left_semi")


def not_in_set(df: DataFrame, members: DataFrame, keys: Keys, member_keys: Keys) -> DataFrame:
    """Rows whose key is not in the set."""
    return _membership(df, members, keys, member_keys, "left_anti")


def _membership(df: DataFrame, members: DataFrame, keys: Keys, member_keys: Keys, how: str) -> DataFrame:
    a, names = key_columns(df, keys)
    known = members.select(*[col(k).alias(f"{n}m") for n, k in zip(names, member_keys)]).distinct()
    return a.join(known, [F.col(n) == F.col(f"{n}m") for n in names], how).drop(*names)


def only_new(df: DataFrame, known: DataFrame, keys: Keys, known_keys: Keys, order: Sequence[Column]) -> DataFrame:
    """Rows with an unknown key, first row per key."""
    return top_per_key(not_in_set(df, known, keys, known_keys), keys, order)


def missing_members(found: DataFrame, existing: DataFrame, title: str, group: Sequence[str] = ()) -> DataFrame:
    """Found titles that neither contain nor are contained in an existing title, per group or overall."""
    group = list(group)
    a = found.withColumn("__t", lower_trim(title))
    b = existing.select(*group, lower_trim(title).alias("__e")).filter("__e <> ''")
    touched = touching_texts(a, "__t", b, "__e", group).withColumnRenamed("left_text", "__t")
    return a.join(touched, [*group, "__t"], "left_anti").select(*found.columns)


def new_authors(listed: DataFrame, existing: DataFrame, listed_author: Column, existing_author: Column, least: int = 5) -> DataFrame:
    """List rows whose author key is unknown: not equal to, contained in or containing a known key.

    Keys shorter than ``least`` characters must be equal.
    """
    a = listed.withColumn("__a", listed_author)
    b = existing.select(existing_author.alias("__e")).filter("__e <> ''").distinct()
    equal = b.select(F.col("__e").alias("__a"))
    touching = touching_texts(a, "__a", b, "__e", (), least, least).withColumnRenamed("left_text", "__a")
    known = equal.union(touching).distinct()
    return a.filter("__a <> ''").join(known, "__a", "left_anti").select(*listed.columns)


def rank_list_tags(series: DataFrame, listed: DataFrame, series_id: str, titles: Sequence[str], author: str, order: Column, list_terms: Sequence[str] = ("title",), prefix: str = "Amazon ") -> DataFrame:
    """(series_id, tag, best_rank) of the series that a bestseller list names.

    ``listed``: list_id, list_name, rank, title (and further search terms), author. Per list row the
    strategies run in order and the first that finds something is used: equal title key; containment either
    way with the first series title in order (our titles over 5 characters, list titles over 8); equal author
    (over 5 characters). Tags of one series are distinct and sorted. The series table is read four times, so
    it should be a written or checkpointed one.
    """
    spelled = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.trim(punctuation_free_key(t)).alias("key")) for i, t in enumerate(titles)])
    )
    ours = (
        series.select(F.col(series_id).alias("sid"), order.alias("o"), spelled.alias("t"))
        .select("sid", F.struct("o", F.col("t.i")).alias("pos"), F.col("t.key").alias("our_key"))
        .filter(F.length("our_key") > 3)
    )
    terms = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), punctuation_free_key(t).alias("key")) for i, t in enumerate(list_terms)]))
    entries = listed.select("list_id", terms.alias("t")).select("list_id", F.col("t.i").alias("i"), F.col("t.key").alias("list_key"))
    least = 1 if len(list_terms) == 1 else 4
    entries = entries.filter(F.length("list_key") >= least)

    exact = entries.join(ours, F.col("list_key") == F.col("our_key")).select("list_id", "i", "sid")
    rest = entries.join(exact.select("list_id", "i").distinct(), ["list_id", "i"], "left_anti").filter(F.length("list_key") > 8)
    touching = small_list_pairs(rest, "list_key", ours, "our_key", ["pos"], 6, 9)
    first_key = touching.groupBy(F.col("list_text").alias("list_key")).agg(F.min(F.struct("pos", "text")).alias("best"))
    first_hit = rest.join(first_key, "list_key").select("list_id", "i", F.col("best.text").alias("our_key"))
    partial = first_hit.join(ours, "our_key").select("list_id", "i", "sid")
    by_title = exact.union(partial).select("list_id", "sid").distinct()

    name = lower_trim("author")
    left_over = listed.join(by_title.select("list_id").distinct(), "list_id", "left_anti").withColumn("__a", name)
    by_author = (
        left_over.filter(F.length("__a") > 5)
        .join(series.select(F.col(series_id).alias("sid"), lower_trim(author).alias("__sa")), F.col("__a") == F.col("__sa"))
        .select("list_id", "sid")
    )
    matches = by_title.union(by_author).join(listed.select("list_id", "list_name", "rank"), "list_id")
    rank = F.coalesce("rank", F.lit(999))
    tag = F.concat(rank_bucket(rank, prefix, prefix + "Top 100"), F.lit(" "), F.col("list_name"))
    return (
        matches.groupBy(F.col("sid").alias(series_id))
        .agg(F.array_join(F.array_sort(F.collect_set(tag)), "; ").alias("tag"), F.min(rank).alias("best_rank"))
    )


def title_flags(books: DataFrame, listed: DataFrame, title: str) -> DataFrame:
    """(key, flags): sorted ``# Top N list`` flags of the lists whose titles contain a book title (lower case, trimmed)."""
    keys = books.select(lower_trim(title).alias("key")).filter("key <> ''").distinct()
    b = listed.withColumn("list_key", F.lower("title"))
    pairs = small_list_pairs(b, "list_key", keys, "key", [], 1, None).withColumnsRenamed({"text": "key", "list_text": "list_key"})
    flag = F.concat(rank_bucket("rank", "# ", "# Top 100"), F.lit(" "), F.col("list_name"))
    return (
        pairs.join(b, "list_key")
        .groupBy("key")
        .agg(F.array_join(F.array_sort(F.collect_set(flag)), " | ").alias("flags"))
    )


def list_flags(books: DataFrame, listed: DataFrame, book_id: str, title: str) -> DataFrame:
    """(book_id, flags): the ``title_flags`` of every book that has some."""
    keyed = books.select(F.col(book_id), lower_trim(title).alias("key"))
    return keyed.join(title_flags(books, listed, title), "key").select(book_id, "flags")


def best_listing(books: DataFrame, listed: DataFrame, title: str, author: str, name: str = "featured") -> DataFrame:
    """Books with ``title: #rank in list`` of the lowest rank of their (title, author); list order breaks ties."""
    best = (
        listed.withColumn("__t", rank_list_key("title"))
        .withColumn("__a", rank_list_key("author"))
        .groupBy("__t", "__a")
        .agg(F.min_by(F.struct("title", "rank", "list_name"), F.struct("rank", "list_id")).alias("b"))
    )
    text = F.concat(F.col("b.title"), F.lit(": #"), F.col("b.rank").cast("string"), F.lit(" in "), F.col("b.list_name"))
    keyed = books.withColumn("__t", rank_list_key(title)).withColumn("__a", rank_list_key(author))
    return keyed.join(best.select("__t", "__a", text.alias(name)), ["__t", "__a"], "left").drop("__t", "__a")


def two_list_featured(books: DataFrame, first: DataFrame, second: DataFrame, title: str, first_name: str, second_name: str, default: str = "No List") -> DataFrame:
    """Both list ranks of a title and the tag of the better one; the first list wins a tie.

    Lists are (title_key, list_rank); of a repeated title the lowest rank counts.
    """
    key = F.regexp_replace(F.lower(F.col(title)), "[^\\p{L}\\p{N}]", "")

    def ranks(table: DataFrame, name: str) -> DataFrame:
        return table.groupBy(F.col("title_key").alias("__k")).agg(F.min("list_rank").alias(name))

    out = books.withColumn("__k", key).join(ranks(first, "first_rank"), "__k", "left").join(ranks(second, "second_rank"), "__k", "left")
    use_first = F.col("first_rank").isNotNull() & (F.col("second_rank").isNull() | (F.col("first_rank") <= F.col("second_rank")))
    tag = (
        F.when(use_first, rank_bucket("first_rank", f"{first_name} ", f"{first_name} Top 100"))
        .when(F.col("second_rank").isNotNull(), rank_bucket("second_rank", f"{second_name} ", f"{second_name} Top 100"))
        .otherwise(F.lit(default))
    )
    return out.withColumn("featured_list", tag).drop("__k")


def best_entry_by_surname(series: DataFrame, listed: DataFrame, author: str, default: str = "Not Available") -> DataFrame:
    """Lowest-ranked list entry whose author has the surname (last word) of the series author as a word."""
    words = F.explode(F.array_distinct(F.split(spaced_key("author"), " +")))
    best = (
        listed.select("list_id", "list_name", "rank", words.alias("__w"))
        .filter("__w <> ''")
        .groupBy("__w")
        .agg(F.min_by(F.struct("list_name", "rank"), F.struct("rank", "list_id")).alias("b"))
    )
    surname = F.element_at(F.split(F.trim(spaced_key(author)), " +"), -1)
    joined = series.withColumn("__w", surname).join(best, "__w", "left")
    text = F.concat(F.col("b.list_name"), F.lit(" #"), F.col("b.rank").cast("string"))
    return joined.withColumn("list_entry", F.coalesce(text, F.lit(default))).withColumn("list_rank", F.col("b.rank")).drop("__w", "b")


def money(c: Column) -> Column:
    """Whole dollars with thousands commas."""
    return F.concat(F.lit("$"), F.format_number(c, 0))


def commercial_band(ratings: Column | str, length: Column | str, bands: list = models.COMMERCIAL_BANDS, dash: str = " - ") -> Column:
    """STRUCT(tier, fee_low, fee_high, fee, share_low, share_high, share) of the first band that fits.

    The bands are a fixed short list, so this is a CASE expression and needs no join.
    """
    r, h = F.coalesce(col(ratings).cast("double"), F.lit(0.0)), F.coalesce(col(length).cast("double"), F.lit(0.0))

    def row(tier, low, high, share_low, share_high) -> Column:
        fee = "No MG" if high == 0 else f"Up to ${high:,}" if low == 0 else f"${low:,}{dash}${high:,}"
        return F.struct(
            F.lit(tier).alias("tier"), F.lit(low).alias("fee_low"), F.lit(high).alias("fee_high"), F.lit(fee).alias("fee"),
            F.lit(share_low).alias("share_low"), F.lit(share_high).alias("share_high"),
            F.lit(f"{share_low}%{dash}{share_high}%").alias("share"),
        )

    out = None
    for _, tier, least, most, hours, low, high, share_low, share_high in bands:
        fits = (r >= least) & (h >= hours)
        if most is not None:
            fits = fits & (r <= most)
        value = row(tier, low, high, share_low, share_high)
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out.otherwise(row(*models.FALLBACK_BAND))


def band_table(bands: Sequence[dict], value: Column, low: str, high: str, columns: Sequence[str]) -> Column:
    """STRUCT of the columns of the first band whose [low, high] range holds the value; an open end is None.

    ``bands`` is a configuration list in the order of precedence, written out as a CASE expression.
    """
    out = F.lit(None)
    for k, r in enumerate(bands):
        fits = F.lit(True)
        if r[low] is not None:
            fits = fits & (value >= r[low])
        if r[high] is not None:
            fits = fits & (value <= r[high])
        band = F.struct(*[F.lit(r[c]).alias(c) for c in columns])
        out = out.when(fits, band) if k else F.when(fits, band)
    return out
