"""Near-duplicate embeddings: tiled comparison in the order of the principal components.

Vectors of length 1 are turned so that the leading dimensions hold most of what tells them apart, and laid out in tiles. A pair of tiles
is compared a few dimensions at a time: what the remaining dimensions can add to a product is at most the product of
the two rests' lengths, so rows and columns that cannot reach the threshold any more are dropped, and the pair of tiles is
left as soon as none is left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.components import connected_components
from shelfmark.llm.tables import prepare, written
from shelfmark.llm.vectors import matrix, usable

# Vectors of a stripe (two stripes meet in one task), rows of a tile, and bytes of a stripe's matrix at most.
STRIPE = 8192
TILE = 512
STRIPE_BYTES = 32 << 20
# Dimensions after which bounds are taken.
STEPS = (4, 8, 16, 32)
# Beyond rounding, a bound below the threshold is below it.
ROUNDING = 1e-9


def principal_axes(units: DataFrame, size: int) -> np.ndarray:
    """Columns: orthonormal axes by falling second moment. Tasks add up their products; only sums reach the driver."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            rows = matrix(batch.column("v"))
            if len(rows):
                total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size, dtype=np.int32)), pa.array(total.ravel())], ["k", "x"])

    sums = units.select("v").mapInArrow(products, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect()
    total = np.zeros(size * size)
    for row in sums:
        total[row["k"]] = row["x"]
    _, axes = np.linalg.eigh(total.reshape(size, size))
    return axes[:, ::-1]


def close_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) that reach the threshold by the leading dimensions and the bound of the rest: few more than do."""
    rows, columns = np.arange(len(left)), np.arange(len(right))
    size, at = left.shape[1], 0
    sums = np.zeros((len(left), len(right)))
    tail_left, tail_right = left**2, right**2
    for end in [x for x in STEPS if x < size] + [size]:
        sums += left[rows, at:end] @ right[columns, at:end].T
        at = end
        rest_left, rest_right = (np.sqrt(np.maximum(t[k, end:].sum(axis=1), 0)) for t, k in ((tail_left, rows), (tail_right, columns)))
        open_ = sums + rest_left[:, None] * rest_right[None, :] >= threshold - ROUNDING
        if end == size:
            hit = np.nonzero(open_)
            return rows[hit[0]], columns[hit[1]]
        keep_rows, keep_columns = open_.any(axis=1), open_.any(axis=0)
        if not keep_rows.any():
            break
        if keep_rows.mean() * keep_columns.mean() < 0.7:
            rows, columns, sums = rows[keep_rows], columns[keep_columns], sums[np.ix_(keep_rows, keep_columns)]
    return rows[:0], columns[:0]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer edges that connect the same nodes: each node to the smallest one that the edges reach."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    low = np.arange(len(nodes))
    while True:
        m = np.minimum(low[x], low[y])
        new = low.copy()
        np.minimum.at(new, x, m)
        np.minimum.at(new, y, m)
        np.minimum.at(new, low, new.copy())
        new = new[new]
        if (new == low).all():
            break
        low = new
    other = low != np.arange(len(nodes))
    return nodes[other], nodes[low[other]]


def near_duplicates(embeddings: DataFrame, threshold: float = 0.9, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for every row: cosine at or above the threshold links, in double precision.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id that links reach, ``kept`` tells whether
    that is the row's own. Null, empty or zero vectors and those with null or non-finite components link with nothing,
    nor do vectors of different lengths link with each other. Ids must be unique. An empty table gives no rows.

    Equal vectors are compared once, with their number. Every two stripes of a bounded size meet in a task, which answers
    with counts and with edges that connect what is linked, never with all pairs.
    """
    spark = prepare(embeddings.sparkSession)
    every = usable(embeddings, id, vector)
    classes = written(every.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("rep")))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))  # scaled first, so that squares neither vanish nor overflow
    units = classes.withColumn("v", F.transform("v", lambda x: x / largest)).withColumn("v", F.transform("v", lambda x: x / length))
    units = written(units.withColumn("size", F.size("v")))
    found = []
    for size, count in sorted((r["size"], r["n"]) for r in units.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()):
        own = units.filter(F.col("size") == size)
        found.append(_linked(spark, own, size, count, threshold))
    schema = "a long, b long, n long"
    links = found[0] if found else spark.createDataFrame([], schema)
    for part in found[1:]:
        links = links.union(part)
    links = written(links)
    counts = links.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))
    parts = connected_components(links.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "rep")
    answers = classes.select("v", "n", "rep").join(counts, "rep", "left").join(parts, "rep", "left")
    answers = answers.select(
        "v", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    own = every.join(answers, "v").select(F.col("id").alias("own"), "n_links", "component_id")
    rows = embeddings.select(embeddings[id].cast("long").alias(id))
    rows = rows.join(own, rows[id] == F.col("own"), "left")
    component = F.coalesce("component_id", F.col(id))
    return rows.select(id, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col(id)).alias("kept"))


def _linked(spark, units: DataFrame, size: int, count: int, threshold: float) -> DataFrame:
    """(a, null, n): rows that other classes link to class a; (a, b, 0): edges that connect linked classes."""
    axes = spark.sparkContext.broadcast(principal_axes(units, size))
    stripe = max(1, min(STRIPE, STRIPE_BYTES // (8 * size)))
    stripes = max(1, math.ceil(count / stripe))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = matrix(batch.column("v")) @ axes.value if len(batch) else np.zeros((0, size))
            values = pa.array([x.tobytes() for x in turned], pa.binary())
            lead = pa.array(turned[:, 0] if len(turned) else np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("n"), lead, values], ["rep", "n", "lead", "turned"])

    turned = units.select("rep", "n", "v").mapInArrow(turn, "rep long, n long, lead double, turned binary")
    # each vector goes to every pair of stripes that holds its own one
    own = turned.withColumn("own", F.pmod(F.xxhash64("rep"), F.lit(stripes)).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    low, high, second = F.least("own", "other"), F.greatest("own", "other"), F.col("own") > F.col("other")
    met = met.select(low.alias("low"), high.alias("high"), second.alias("second"), "rep", "n", "lead", "turned")

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        alone = group["low"].iloc[0] == group["high"].iloc[0]
        sides = []
        for second in (False, True):
            part = group[group["second"] == second].sort_values(["lead", "rep"])
            values = np.frombuffer(b"".join(part["turned"]), np.float64).reshape(len(part), size)
            sides.append((part["rep"].to_numpy(), part["n"].to_numpy(), values))
        left = sides[0]
        right = left if alone else sides[1]
        rows_a, rows_b = [], []
        for i in range(0, len(left[0]), TILE):
            for j in range(i if alone else 0, len(right[0]), TILE):
                a, b = close_pairs(left[2][i : i + TILE], right[2][j : j + TILE], threshold)
                a, b = a + i, b + j
                if alone and i == j:
                    a, b = a[a < b], b[a < b]
                rows_a.append(a)
                rows_b.append(b)
        a, b = (np.concatenate(x) if x else np.zeros(0, int) for x in (rows_a, rows_b))
        # the bound leaves room for rounding; this is the test itself
        products = np.einsum("ij,ij->i", left[2][a], right[2][b]) if len(a) else np.zeros(0)
        a, b = a[products >= threshold], b[products >= threshold]
        out = []
        linked = np.bincount(a, right[1][b], len(left[0])).astype(np.int64)
        back = np.bincount(b, left[1][a], len(right[0])).astype(np.int64)
        for (reps, _, _), n in (((left), linked), (right, back)):
            out.append(pd.DataFrame({"a": reps[n > 0], "b": pd.array([None] * int((n > 0).sum()), "Int64"), "n": n[n > 0]}))
        if len(a):
            x, y = forest(left[0][a], right[0][b])
            out.append(pd.DataFrame({"a": x, "b": pd.array(y, "Int64"), "n": np.zeros(len(x), np.int64)}))
        return pd.concat(out, ignore_index=True)

    return met.groupBy("low", "high").applyInPandas(meet, "a long, b long, n long")
