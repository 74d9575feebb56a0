"""Group values on rows, and one row per group.

No operator here puts a group into one task. Picking a row per key is a ranking window with a literal
limit, which Spark cuts per input partition before the shuffle (WindowGroupLimit). A group value on rows is
a partial aggregate joined back; a key that holds a large share of the rows is split by the adaptive skew
join, because the aggregate side has one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.nulls import col
from shelfmark.session import cut_lineage

Keys = Sequence[Column | str]


def key_columns(df: DataFrame, keys: Keys) -> tuple[DataFrame, list[str]]:
    """Frame with the key expressions under working names, and those names."""
    names = [f"__k{i}" for i in range(len(keys))]
    return df.withColumns({n: col(k) for n, k in zip(names, keys)}), names


def top_per_key(df: DataFrame, keys: Keys, order: Sequence[Column], limit: int = 1) -> DataFrame:
    """The first ``limit`` rows of every key in the given order; they stay dealt by the keys."""
    return ranked_per_key(df, keys, order, limit, "__rn").drop("__rn")


def ranked_per_key(df: DataFrame, keys: Keys, order: Sequence[Column], limit: int, name: str = "rank") -> DataFrame:
    """As ``top_per_key`` with the position in a column."""
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= limit)


def attach_group(df: DataFrame, keys: Keys, values: dict[str, Column]) -> DataFrame:
    """Every row with the aggregates of its group; rows with a NULL key get the group of NULL keys."""
    keyed, names = key_columns(df, keys)
    grouped = keyed.groupBy(*names).agg(*[v.alias(n) for n, v in values.items()])
    right = grouped.withColumnsRenamed({n: f"{n}g" for n in names})
    condition = [F.col(n).eqNullSafe(F.col(f"{n}g")) for n in names]
    kept = [c for c in df.columns if c not in values]
    return keyed.drop(*values).join(right, condition, "left").select(*[F.col(f"`{c}`") for c in kept], *values)


def broadcast_group_value(df: DataFrame, keys: Keys, value: str, strong: Column, weak: Column, order: Column) -> DataFrame:
    """Fill a weak value with the first strong value of its group."""
    first = F.min_by(F.when(strong, F.col(value)), F.when(strong, order))
    out = attach_group(df, keys, {"__strong": first})
    return out.withColumn(value, F.when(weak & F.col("__strong").isNotNull(), F.col("__strong")).otherwise(F.col(value))).drop("__strong")


def copy_from_twin(df: DataFrame, key: Column, marker: str, columns: Sequence[str], order: Column) -> DataFrame:
    """Rows without ``marker`` take the listed columns from the last row of the same key that has it."""
    has = F.col(marker).isNotNull() & (F.col(marker) != "")
    twin = F.max_by(F.struct(*[F.col(c) for c in [marker, *columns]]), F.when(has, order))
    out = attach_group(df, [key], {"__twin": F.when(F.max(has), twin)})
    need = ~F.coalesce(has, F.lit(False)) & F.col("__twin").isNotNull()
    return out.withColumns(
        {c: F.when(need, F.col("__twin")[c]).otherwise(F.col(c)) for c in [marker, *columns]}
    ).drop("__twin")


def drop_minority(df: DataFrame, group: str, member: str, least: int = 3) -> DataFrame:
    """In groups whose most frequent member value has at least ``least`` rows, drop the rows of other values.

    The most frequent value is the smallest one on a tie. NULL groups are left alone.
    """
    per_value = df.filter(F.col(group).isNotNull()).groupBy(group, member).agg(F.count(F.lit(1)).alias("__n"))
    main = per_value.groupBy(F.col(group).alias("__g")).agg(
        F.min_by(F.struct(F.col(member).alias("m"), F.col("__n").alias("n")), F.struct(-F.col("__n"), F.col(member))).alias("__main")
    )
    joined = df.join(main, F.col(group) == F.col("__g"), "left")
    minority = (F.col("__main")["n"] >= least) & ~F.col(member).eqNullSafe(F.col("__main")["m"])
    return joined.filter(~F.coalesce(minority, F.lit(False))).drop("__g", "__main")


def group_modes(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Most frequent non-NULL value of each column per key, smallest on a tie; counted before the final group."""
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    counted = (
        df.select(*keys, entries.alias("e"))
        .filter("e.v IS NOT NULL")
        .groupBy(*keys, F.col("e.c").alias("c"), F.col("e.v").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy(*keys).agg(
        *[
            F.min_by(F.when(F.col("c") == c, F.col("v")), F.when(F.col("c") == c, F.struct(-F.col("n"), F.col("v")))).alias(f"{c}_mode")
            for c in columns
        ]
    )


def listed(df: DataFrame, keys: Sequence[str], value: Column, order: Column) -> DataFrame:
    """All values of every group in long form: (keys, position, value), positions from 1 in the order, then by value.

    The rows are sorted over the whole cluster by key and order, and counted per partition: a row's position is its place
    in the partition plus what earlier partitions hold of its group. So no group is gathered or sorted by one task. The
    sorted rows are written to the shared folder (an action).
    """
    names = list(keys)
    rows = df.select(*names, order.alias("__o"), value.alias("__v"))
    spread = rows.repartitionByRange(*names, "__o", "__v").sortWithinPartitions(*names, "__o", "__v")
    own = cut_lineage(spread.withColumn("__at", F.monotonically_increasing_id())).withColumn("__p", F.shiftright("__at", 33))
    parts = own.groupBy(*names, "__p").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*names).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(*[F.col(k).alias(f"__{k}") for k in names], F.col("__p").alias("__pp"), "__first", F.coalesce(before, F.lit(0)).alias("__before"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in names] + [F.col("__p") == F.col("__pp")]
    position = F.col("__at") - F.col("__first") + F.col("__before") + 1
    return own.join(parts, same).select(*names, position.alias("position"), F.col("__v").alias("value"))


def concat_unique(df: DataFrame, keys: Sequence[str], value: str, order: Column) -> DataFrame:
    """Distinct non-NULL values per group in order of first appearance: (keys, position, value)."""
    first = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(order).alias("__first"))
    return listed(first, keys, F.col(value), F.col("__first")).withColumnRenamed("value", value)
