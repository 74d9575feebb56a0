"""Sorting, limits, quotas and running streaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.config import models
from shelfmark.operators.groups import attach_group, ranked_per_key, top_per_key
from shelfmark.operators.rollup import gap_to_target


def label_order(c: Column | str, order: dict[str, int] = models.PRIORITY_ORDER, unknown: int = 9) -> Column:
    """Sort position of a label, unknown labels last."""
    value = F.col(c) if isinstance(c, str) else c
    out = None
    for label, position in order.items():
        out = F.when(value == label, position) if out is None else out.when(value == label, position)
    return out.otherwise(unknown)


def priority_sort(df: DataFrame, label: str, *then: Column, order: dict[str, int] = models.PRIORITY_ORDER) -> DataFrame:
    """Rows by label position, then by the given columns."""
    return df.orderBy(label_order(label, order), *then)


def master_sort(df: DataFrame, series: str, number: str, title: str) -> DataFrame:
    """Rows by series, book number and title, unknown values last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in (series, number, title)])


def view_sort(df: DataFrame, label: str, number: str, *then: Column) -> DataFrame:
    """Rows by priority label and order number; a number that is none comes last."""
    return df.orderBy(label_order(label), F.col(number).cast("string").try_cast("double").asc_nulls_last(), *then)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows."""
    return df.orderBy(*order).limit(k)


def group_head(df: DataFrame, group: str, *order: Column) -> DataFrame:
    """One representative row per group."""
    return top_per_key(df, [group], list(order))


def quota_fill(current: DataFrame, candidates: DataFrame, group: str, order: Sequence[Column], target: int = 500) -> DataFrame:
    """Candidates, in order, that bring every group of the current rows up to the target."""
    gaps = gap_to_target(current, group, target).select(F.col(group).alias("__g"), "missing")
    ranked = ranked_per_key(candidates, [group], order, target, "__rank")
    joined = ranked.join(gaps, F.col(group) == F.col("__g"), "left")
    return joined.filter(F.col("__rank") <= F.coalesce("missing", F.lit(target))).drop("__rank", "__g", "missing")


def miss_streak_stop(df: DataFrame, group: str, order: str, miss: Column, limit: int = 400, width: int = 100_000) -> DataFrame:
    """Every row with ``skipped``: true after the first run of ``limit`` misses in a row in its group.

    ``order`` is a unique whole number. A group is cut into chunks of ``width`` order values; runs are counted
    inside the chunks and carried over from chunk to chunk, so no task sees a whole group.
    """
    rows = df.withColumn("__c", F.floor(F.col(order) / width)).withColumn("__m", F.coalesce(miss, F.lit(False)))
    inside = Window.partitionBy(group, "__c").orderBy(order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    counted = rows.withColumn("__i", F.row_number().over(inside))
    counted = counted.withColumn("__h", F.max(F.when(~F.col("__m"), F.col("__i"))).over(so_far))
    chunks = counted.groupBy(F.col(group).alias("__g"), F.col("__c").alias("__cc")).agg(
        F.max("__i").alias("n"), F.max("__h").alias("h")
    )
    by_chunk = Window.partitionBy("__g").orderBy("__cc")
    tail = F.col("n") - F.coalesce("h", F.lit(0))
    island = F.sum(F.when(F.col("h").isNotNull(), 1).otherwise(0)).over(by_chunk.rowsBetween(Window.unboundedPreceding, 0))
    carried = chunks.withColumn("t", tail).withColumn("island", island)
    in_island = Window.partitionBy("__g", "island").orderBy("__cc").rowsBetween(Window.unboundedPreceding, 0)
    carried = carried.withColumn("out", F.sum("t").over(in_island)).withColumn("carry", F.lag("out", 1, 0).over(by_chunk))
    joined = counted.join(
        carried.select("__g", "__cc", "carry"), F.col(group).eqNullSafe(F.col("__g")) & (F.col("__c") == F.col("__cc"))
    )
    streak = F.col("__i") - F.coalesce("__h", F.lit(0)) + F.when(F.col("__h").isNull(), F.col("carry")).otherwise(0)
    marked = joined.withColumn("__stop", F.when(F.col("__m") & (streak >= limit), F.col(order)))
    out = attach_group(marked.select(*df.columns, "__stop"), [group], {"__first": F.min("__stop")})
    return out.withColumn("skipped", F.coalesce(F.col(order) > F.col("__first"), F.lit(False))).drop("__stop", "__first")
