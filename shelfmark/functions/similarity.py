"""Text similarity. Only the matching-blocks ratio runs in Python (Arrow batches), on candidate pairs."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.keys import author_key, series_word_key
from shelfmark.functions.nulls import col
from shelfmark.functions.titles import normalize_title


@F.pandas_udf(T.DoubleType())
def matching_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two texts, 0 for NULL; equal pairs of a batch are computed once."""
    known: dict[tuple, float] = {}
    out = []
    for pair in zip(left, right):
        if pair not in known:
            a, b = pair
            known[pair] = SequenceMatcher(None, a, b).ratio() if isinstance(a, str) and isinstance(b, str) else 0.0
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


# Spark copies a deterministic expression into every place that names it; this one is worth computing once
matching_ratio = matching_ratio.asNondeterministic()


def edit_ratio(left: Column | str, right: Column | str) -> Column:
    """1 - edit distance / longer length, lower case; 0 when a side is empty."""
    a, b = F.lower(col(left)), F.lower(col(right))
    longest = F.greatest(F.length(a), F.length(b))
    known = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(known, 1.0 - F.levenshtein(a, b) / longest).otherwise(0.0)


def similarity(left: Column | str, right: Column | str) -> Column:
    """Mean of the matching-blocks ratio and the edit ratio."""
    a, b = F.lower(col(left)), F.lower(col(right))
    known = (F.length(a) > 0) & (F.length(b) > 0)
    ratio = matching_ratio(F.when(a != b, a), F.when(a != b, b))
    return F.when(known & (a == b), 1.0).when(known, (ratio + edit_ratio(a, b)) / 2).otherwise(0.0)


def title_similarity(left: Column | str, right: Column | str) -> Column:
    """1 for equal keys, 0.9 when one key contains the other, else the matching-blocks ratio."""
    return key_similarity(series_word_key(left), series_word_key(right))


def key_similarity(a: Column, b: Column) -> Column:
    """``title_similarity`` of columns that hold normalised keys."""
    empty = (F.length(a) == 0) | (F.length(b) == 0) | a.isNull() | b.isNull()
    # pairs decided by the JVM are handed to Python as NULL
    open_pair = ~empty & ~a.contains(b) & ~b.contains(a)
    ratio = matching_ratio(F.when(open_pair, a), F.when(open_pair, b))
    return F.when(empty, 0.0).when(a == b, 1.0).when(a.contains(b) | b.contains(a), 0.9).otherwise(ratio)


def same_title(df: DataFrame, left: Column | str, right: Column | str, name: str = "same", threshold: float = 0.85) -> DataFrame:
    """Adds whether two titles have equal fuzzy keys, or similar standard or core titles.

    The normal forms become columns first: Python is handed plain columns, each computed once.
    """
    forms = df.withColumns({"__a": normalize_title(left), "__b": normalize_title(right)})
    a, b = F.col("__a"), F.col("__b")
    equal = (F.length(a["fuzzy"]) > 0) & (a["fuzzy"] == b["fuzzy"])
    close = similarity(a["standard"], b["standard"]) >= threshold
    core = similarity(a["core_title"], b["core_title"]) >= threshold
    return forms.withColumn(name, equal | close | core).drop("__a", "__b")


def same_author(left: Column | str, right: Column | str, threshold: float = 0.90) -> Column:
    """Equal or similar fuzzy author keys."""
    a, b = author_key(left, "fuzzy"), author_key(right, "fuzzy")
    return (F.length(a) > 0) & (F.length(b) > 0) & ((a == b) | (similarity(a, b) >= threshold))
