"""Missing values, lenient numbers and trimming."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.config.vocab import MISSING_SPELLINGS, NULL_PLACEHOLDERS

# every character Unicode counts as white space or separator
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
NUMBER = "^[\\s\\p{Z}]*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?[\\s\\p{Z}]*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def trim_space(c: Column | str) -> Column:
    """Strip Unicode white space on both ends (SQL ``trim`` strips only the space character)."""
    return F.btrim(col(c), F.lit(WHITE_SPACE))


def trimmed(value: Column) -> Column:
    """``trim_space`` of a plain column or lambda variable; a text with printable ASCII at both ends is not searched."""
    clean = F.ascii(value).between(33, 126) & F.ascii(F.right(value, F.lit(1))).between(33, 126)
    return F.when(clean, value).otherwise(trim_space(value))


def present_once(c: Column | str) -> Column:
    """``present`` for use inside lambdas, where Spark shares no subexpressions: the value is trimmed once."""
    longest = max(len(x) for x in MISSING_SPELLINGS)
    return let(let(col(c), trimmed), lambda t: F.when((F.length(t) > longest) | ~F.lower(t).isin(*MISSING_SPELLINGS), t))


def collapse_space(c: Column | str) -> Column:
    """Strip and turn inner runs of white space into one space."""
    return F.regexp_replace(trim_space(c), "[\\s\\p{Z}]+", " ")


def null_if_placeholder(c: Column | str, spellings: list[str] = NULL_PLACEHOLDERS) -> Column:
    """NULL for the spellings that mean "missing", else the trimmed text."""
    text = trim_space(c)
    return F.when(~F.lower(text).isin(*spellings), text)


def zero_as_null(c: Column | str) -> Column:
    """NULL where a number is 0 or NaN."""
    value = col(c)
    return F.when((value != 0) & ~F.isnan(value.cast("double")), value)


def is_missing(c: Column | str) -> Column:
    """True for NULL and for text spellings of a missing value."""
    return F.coalesce(F.lower(trim_space(c)).isin(*MISSING_SPELLINGS), F.lit(True))


def present(c: Column | str) -> Column:
    """The trimmed text, NULL where missing."""
    return F.when(~is_missing(c), trim_space(c))


def first_non_missing(*columns: Column | str) -> Column:
    """First value that is not NULL and not spelled as missing."""
    return F.coalesce(*[F.when(~is_missing(col(c).cast("string")), col(c)) for c in columns])


def first_line(c: Column | str) -> Column:
    """Text before the first line break."""
    return trim_space(F.substring_index(col(c), "\n", 1))


def to_number(c: Column | str, mode: str = "strict") -> Column:
    """Text to DOUBLE, NULL where it is not a number.

    ``strict``: the whole text is a number; ``commas``: thousands commas are dropped first;
    ``digits``: everything but digits and the point is dropped first; ``suffix``: also accepts 1.2k and 3m.
    """
    text = col(c).cast("string")
    scale = F.lit(1.0)
    if mode == "digits":
        text = F.regexp_replace(text, "[^0-9.]", "")
    elif mode == "commas":
        text = F.replace(text, F.lit(","), F.lit(""))
    elif mode == "suffix":
        text = F.lower(F.replace(trim_space(text), F.lit(","), F.lit("")))
        scale = F.when(text.endswith("k"), 1e3).when(text.endswith("m"), 1e6).otherwise(1.0)
        text = F.regexp_replace(text, "[km]$", "")
    elif mode != "strict":
        raise ValueError(f"unknown mode {mode!r}")
    return F.when(text.rlike(NUMBER), trim_space(text).try_cast("double") * scale)


def to_whole(c: Column | str, mode: str = "strict") -> Column:
    """Lenient whole number: the fraction is cut off."""
    return to_number(c, mode).try_cast("long")


def clean_book_number(c: Column | str) -> Column:
    """``1.0`` becomes ``1``; ``1.5`` and text stay."""
    text = trim_space(col(c).cast("string"))
    value = to_number(text)
    return (
        F.when(is_missing(text), None)
        .when(value == F.floor(value), F.floor(value).cast("string"))
        .when(value.isNotNull(), value.cast("string"))
        .otherwise(text)
    )


def book_order(c: Column | str) -> Column:
    """Number used to order members: first run of digits in the text."""
    return F.regexp_extract(col(c).cast("string"), "([0-9]+)", 1).try_cast("double")


def best_count(*columns: Column | str) -> Column:
    """Largest known whole count; NULL while no column holds a count above 0."""
    known = [F.when(to_whole(c) > 0, to_whole(c)) for c in columns]
    return F.greatest(*known) if len(known) > 1 else known[0]


def any_missing(columns: list[str]) -> Column:
    """True where at least one of the columns is missing."""
    return reduce(lambda a, b: a | b, [is_missing(F.col(c).cast("string")) for c in columns])


def all_missing(columns: list[str]) -> Column:
    """True where every one of the columns is missing."""
    return reduce(lambda a, b: a & b, [is_missing(F.col(c).cast("string")) for c in columns])


def filled_count(columns: list[str]) -> Column:
    """How many of the columns hold a value."""
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])
