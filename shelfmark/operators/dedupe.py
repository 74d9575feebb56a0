"""De-duplication. "First" is always defined by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keys import author_key, compact_key, crawl_title_key, drop_series_key, series_author_key
from shelfmark.functions.nulls import col, filled_count, is_missing
from shelfmark.functions.titles import fuzzy_title
from shelfmark.operators.groups import Keys, attach_group, key_columns, top_per_key


def dedup_first(df: DataFrame, series: str, author: str, order: Sequence[Column]) -> DataFrame:
    """First row per lower-cased, trimmed (series, author)."""
    return top_per_key(df, [series_author_key(series, author)], order)


def dedup_normalised(df: DataFrame, title: str, author: str, order: Sequence[Column], keep: str = "first", by_author: bool = True) -> DataFrame:
    """One row per fuzzy title and, unless ``by_author`` is off, fuzzy author.

    ``keep``: ``first``, ``last`` in the order, or ``none`` to drop every row that has a duplicate.
    """
    keys: Keys = [fuzzy_title(title)] + ([author_key(author, "fuzzy")] if by_author else [])
    if keep == "first":
        return top_per_key(df, keys, order)
    if keep == "none":
        return attach_group(df, keys, {"__n": F.count(F.lit(1))}).filter("__n = 1").drop("__n")
    if keep == "last":
        keyed, names = key_columns(df, keys)
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        last = keyed.groupBy(*names).agg(F.max_by(row, F.struct(*order)).alias("r"))
        return last.select("r.*")
    raise ValueError(f"unknown keep {keep!r}")


def dedup_most_complete(df: DataFrame, series: str, title: str, order: Sequence[Column]) -> DataFrame:
    """Row with the most filled columns per (series, title) key."""
    filled = filled_count(df.columns)
    return top_per_key(df, [drop_series_key(series), drop_series_key(title)], [filled.desc(), *order])


def dedup_complete_penalised(df: DataFrame, title: str, author: str, publisher: str, weak: str, order: Sequence[Column]) -> DataFrame:
    """Row with the most filled columns per (title, author) key, 10 less for a placeholder publisher."""
    penalty = F.when(F.lower(F.col(publisher)).contains(weak), 10).otherwise(0)
    return top_per_key(df, [compact_key(title), compact_key(author)], [(filled_count(df.columns) - penalty).desc(), *order])


def contact_points(email, agent_email, quality, score) -> Column:
    """Points of an outreach row: e-mail 100, agent 50, GREEN 30 or YELLOW 15, plus its score."""
    flag = F.upper(col(quality))
    return (
        F.when(~is_missing(email), 100.0).otherwise(0.0)
        + F.when(~is_missing(agent_email), 50.0).otherwise(0.0)
        + F.when(flag == "GREEN", 30.0).when(flag == "YELLOW", 15.0).otherwise(0.0)
        + F.coalesce(col(score).cast("double"), F.lit(0.0))
    )


def dedup_best(df: DataFrame, keys: Keys, points: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """Row with the highest points (compared left to right) per key."""
    return top_per_key(df, keys, [*[p.desc_nulls_last() for p in points], *order])


def dedup_lowest(df: DataFrame, keys: Keys, rank: Column, order: Sequence[Column]) -> DataFrame:
    """Row with the lowest rank per key; rows without a rank come last."""
    return top_per_key(df, keys, [rank.asc_nulls_last(), *order])


def dedup_exact(df: DataFrame, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per exact column values."""
    return top_per_key(df, list(columns), order)


def dedup_merge_sources(df: DataFrame, title: str, author: str, source: str, detail: str, order: str, preferred: str = "Bestseller", note: str = "Also in Search") -> DataFrame:
    """One row per crawl key; a ``preferred`` source wins and collects the details of its kind.

    The note is added when a row of another source came first. Equal details of one key count once.
    """
    key = F.concat(crawl_title_key(title), F.lit("|||"), crawl_title_key(author))
    keyed = df.withColumn("__key", key)
    is_preferred = F.col(source) == preferred
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    per_detail = keyed.groupBy("__key", is_preferred.alias("__p"), F.when(is_preferred, F.col(detail)).alias("__d")).agg(
        F.min_by(row, F.col(order)).alias("r"), F.min(order).alias("__o")
    )
    pick = F.struct((~F.col("__p")).cast("int"), F.col("__o"))
    details = F.collect_list(F.when(F.col("__p"), F.struct(F.col("__o").alias("o"), F.col("__d").alias("d"))))
    merged = per_detail.groupBy("__key").agg(
        F.min_by("r", pick).alias("r"),
        F.array_sort(details).alias("ds"),
        F.min_by("__p", "__o").alias("first_preferred"),
    )
    texts = F.transform("ds", lambda x: x["d"])
    noted = F.when(
        ~F.col("first_preferred") & (F.size("ds") > 0),
        F.concat(F.slice(texts, 1, 1), F.array(F.lit(note)), F.slice(texts, 2, F.greatest(F.size("ds"), F.lit(1)))),
    ).otherwise(texts)
    joined = F.when(F.size("ds") > 0, F.array_join(noted, " | ")).otherwise(F.col(f"r.{detail}"))
    return merged.select(*[joined.alias(c) if c == detail else F.col(f"r.`{c}`").alias(c) for c in df.columns])


def duplicated(df: DataFrame, keys: Keys, name: str = "is_duplicate") -> DataFrame:
    """Every row with a flag that says whether its key occurs more than once."""
    return attach_group(df, keys, {name: F.count(F.lit(1)) > 1})


def duplicate_summary(df: DataFrame, keys: Keys) -> DataFrame:
    """One row: number of keys with duplicates and number of rows in them."""
    keyed, names = key_columns(df, keys)
    counts = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counts.agg(
        F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows")
    )
