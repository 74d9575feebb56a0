"""Embedding vectors: which ones take part, different ones once, and rows as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid(vector: Column) -> Column:
    """True for a vector that is there, not empty, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """(id long, v array<double>): the rows that take part; -0.0 counts as 0.0."""
    rows = rows.select(rows[id].cast("long").alias("id"), rows[vector].cast("array<double>").alias("v")).filter(valid(F.col("v")))
    return rows.select("id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    return np.asarray(lists.flatten(), np.float64).reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))
