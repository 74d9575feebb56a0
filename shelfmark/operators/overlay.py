"""Corrections and results laid over a base table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keys import compact_key, lower_trim
from shelfmark.functions.nulls import is_missing
from shelfmark.operators.matching import is_blank


def _absent(name: str, dtype: str) -> Column:
    return is_missing(name) if dtype == "string" else F.col(name).isNull()


def _first_filled(columns: Sequence[str], types: dict[str, str], order: Column) -> list[Column]:
    """Per column the first filled value in the order."""
    return [F.min_by(c, F.when(~_absent(c, types[c]), order)).alias(f"__{c}") for c in columns]


def fill_from(df: DataFrame, columns: Sequence[str], weak: dict[str, Column] | None = None) -> DataFrame:
    """Blank (or weak) cells take the value of the working column ``__<name>``."""
    types = dict(df.dtypes)
    changed = {}
    for c in columns:
        empty = _absent(c, types[c])
        if weak and c in weak:
            empty = empty | F.coalesce(weak[c], F.lit(False))
        changed[c] = F.when(empty, F.coalesce(F.col(f"__{c}"), F.col(c))).otherwise(F.col(c))
    return df.withColumns(changed).drop(*[f"__{c}" for c in columns])


def delta_apply(base: DataFrame, delta: DataFrame, row_id: str, link: str, title: str, author: str, columns: Sequence[str], delta_order: str, weak: dict[str, Column] | None = None) -> DataFrame:
    """Blank cells filled from a delta that names its row by link or, without a link, by (title, author).

    A delta row belongs to the first base row of its key. Of several delta rows for one base row the first
    filled value per cell is used.
    """
    types = dict(delta.dtypes)
    by_link = base.filter(~is_missing(link)).groupBy(F.col(link).alias("__k")).agg(F.min(row_id).alias("__id"))
    by_name = (
        base.select(F.concat(compact_key(title), F.lit("|"), compact_key(author)).alias("__k"), row_id)
        .groupBy("__k")
        .agg(F.min(row_id).alias("__id"))
    )
    has_link = ~is_missing(link)
    linked = delta.filter(has_link).withColumn("__k", F.col(link)).join(by_link, "__k")
    t, a = compact_key(title), compact_key(author)
    named = delta.filter(~has_link & (t != "") & (a != "")).withColumn("__k", F.concat(t, F.lit("|"), a)).join(by_name, "__k")
    values = linked.union(named).groupBy("__id").agg(*_first_filled(columns, types, F.col(delta_order)))
    joined = base.join(values, F.col(row_id) == F.col("__id"), "left").drop("__id")
    return fill_from(joined, columns, weak)


def group_scoped_overlay(base: DataFrame, deltas: DataFrame, row_id: str, category: str, groups: dict[str, Sequence[str]], columns: Sequence[str], marker: str) -> DataFrame:
    """Filled cells of the group files overwrite the base, each file only for the categories of its group.

    ``deltas``: row_id, group, priority, category and the columns. A row counts when its ``marker`` is
    filled; per cell the file with the highest priority wins.
    """
    types = dict(deltas.dtypes)
    in_group = F.lit(False)
    for name, categories in groups.items():
        in_group = in_group | ((F.col("group") == name) & F.col(category).isin(*categories))
    scoped = deltas.filter(in_group & ~is_missing(marker))
    values = scoped.groupBy(F.col(row_id).alias("__id")).agg(
        *[F.max_by(c, F.when(~_absent(c, types[c]), F.col("priority"))).alias(f"__{c}") for c in columns]
    )
    joined = base.join(values, F.col(row_id) == F.col("__id"), "left").drop("__id")
    return joined.withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns}).drop(*[f"__{c}" for c in columns])


def apply_by_author(base: DataFrame, results: DataFrame, author: str, columns: Sequence[str], priority: str = "priority") -> DataFrame:
    """Blank cells of every row of an author filled from the results for that author, lowest priority number first."""
    types = dict(results.dtypes)
    values = results.groupBy(lower_trim(author).alias("__k")).agg(*_first_filled(columns, types, F.col(priority)))
    joined = base.withColumn("__a", lower_trim(author)).join(values, F.col("__a") == F.col("__k"), "left").drop("__a", "__k")
    return fill_from(joined, columns)


def apply_by_row(base: DataFrame, results: DataFrame, row_id: str, policies: dict[str, str], order: Column) -> DataFrame:
    """Results laid over rows by id; per column ``overwrite``, ``fill``, ``fill_zero`` or ``larger``.

    Of several results for an id the first one in the order counts, as a whole row.
    """
    types = dict(base.dtypes)
    row = F.min_by(F.struct(*[F.col(c).alias(f"__{c}") for c in policies]), order)
    values = results.groupBy(F.col(row_id).alias("__id")).agg(row.alias("__row")).select("__id", "__row.*")
    joined = base.join(values, F.col(row_id) == F.col("__id"), "left").drop("__id")
    changed = {}
    for c, policy in policies.items():
        new, old = F.col(f"__{c}"), F.col(c)
        if policy == "overwrite":
            changed[c] = F.coalesce(new, old)
        elif policy == "fill":
            changed[c] = F.when(_absent(c, types[c]), new).otherwise(old)
        elif policy == "fill_zero":
            changed[c] = F.when(is_blank(c, types[c]), F.coalesce(new, old)).otherwise(old)
        elif policy == "larger":
            changed[c] = F.greatest(old, new)
        else:
            raise ValueError(f"unknown policy {policy!r}")
    return joined.withColumns(changed).drop(*[f"__{c}" for c in policies])


def override_table(base: DataFrame, patches: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column) -> DataFrame:
    """Patch values win over base values; patch rows with a new key are added.

    Of several patches for a key each cell takes the first filled value in the order.
    """
    cells = [F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"__{c}") for c in columns]
    right = patches.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(*cells)
    joined = base.join(right, [F.col(k) == F.col(f"__{k}") for k in keys], "full_outer")
    out = []
    for c in base.columns:
        if c in keys or c in columns:
            out.append(F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)
