"""Key normalisers: the text forms that matching and de-duplication compare."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.nulls import col, collapse_space, trim_space

AUTHOR_SUFFIX = "(?i),?\\s+(Jr\\.?|Sr\\.?|III?|IV|Ph\\.?D\\.?|M\\.?D\\.?)$"


def _accent_pairs() -> tuple[str, str]:
    """Every precomposed Latin letter and its base letter, by Unicode decomposition."""
    source, target = [], []
    for code in list(range(0xC0, 0x250)) + list(range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code):
            source.append(chr(code))
            target.append(base)
    return "".join(source), "".join(target)


ACCENTED, BASE_LETTERS = _accent_pairs()


def fold_accents(c: Column | str) -> Column:
    """Letters without their accents."""
    return F.regexp_replace(F.translate(col(c), ACCENTED, BASE_LETTERS), "\\p{Mn}+", "")


def lower_trim(c: Column | str) -> Column:
    """Lower case, outer white space stripped; NULL becomes the empty text."""
    return F.lower(trim_space(F.coalesce(col(c).cast("string"), F.lit(""))))


def spaced_key(c: Column | str) -> Column:
    """Lower case letters, digits and spaces."""
    return F.regexp_replace(lower_trim(c), "[^a-z0-9 ]", "")


def compact_key(c: Column | str) -> Column:
    """Lower case letters and digits."""
    return F.regexp_replace(lower_trim(c), "[^a-z0-9]", "")


def word_key(c: Column | str) -> Column:
    """Lower case words separated by one space."""
    return F.trim(F.regexp_replace(lower_trim(c), "[^a-z0-9]+", " "))


def punctuation_free_key(c: Column | str) -> Column:
    """Lower case without punctuation; letters of every script stay."""
    return F.regexp_replace(lower_trim(c), "[^\\p{L}\\p{N}_\\s\\p{Z}]", "")


def series_word_key(c: Column | str) -> Column:
    """Words without parenthesised parts, the word "series", volume and # numbers."""
    text = F.lower(collapse_space(F.coalesce(col(c).cast("string"), F.lit(""))))
    for pattern in (
        "\\(.*?\\)",
        "\\bseries\\b",
        "\\bvol(?:ume)?\\.?\\s*[0-9]+\\b",
        "#\\s*[0-9]+(?:\\.[0-9]+)?(?:-[0-9]+(?:\\.[0-9]+)?)?",
    ):
        text = F.regexp_replace(text, pattern, "")
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def product_key(c: Column | str) -> Column:
    """Words with ``&`` spelled out and the word "series" dropped."""
    text = F.replace(lower_trim(c), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(text, "\\bseries\\b", " "), "[^a-z0-9]+", " "))


def product_title_key(c: Column | str) -> Column:
    """``product_key`` of a title without parenthesised parts and book numbers."""
    text = F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), "\\([^)]*\\)", " ")
    return product_key(F.regexp_replace(text, "(?i)\\bbook\\s+[0-9]+\\b", " "))


def crawl_title_key(c: Column | str) -> Column:
    """Letters, digits and spaces, cut at the first series or edition suffix."""
    text = F.trim(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9\\s]", ""))
    return F.regexp_replace(text, "\\s*(a novel|book [0-9]+|volume [0-9]+|series|edition).*$", "")


def drop_series_key(c: Column | str) -> Column:
    """Lower case without the text " series"."""
    return F.replace(lower_trim(c), F.lit(" series"), F.lit(""))


def rank_list_key(c: Column | str) -> Column:
    """Lower case without quotes, colons and dashes."""
    return F.translate(lower_trim(c), "'’:-", "")


def author_key(c: Column | str, level: str = "standard") -> Column:
    """Author name without a leading "by" and trailing Jr/Sr/III/PhD; ``fuzzy`` keeps letters and digits only."""
    text = fold_accents(lower_free(c))
    text = F.regexp_replace(F.regexp_replace(text, AUTHOR_SUFFIX, ""), "(?i)^by\\s+", "")
    if level == "fuzzy":
        return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")
    return collapse_space(text)


def lower_free(c: Column | str) -> Column:
    """Trimmed text; the spellings of a missing name become the empty text."""
    text = trim_space(F.coalesce(col(c).cast("string"), F.lit("")))
    return F.when(F.lower(text).isin("nan", "none"), F.lit("")).otherwise(text)


def series_author_key(series: Column | str, author: Column | str, separator: str = "|") -> Column:
    """The pair key of U1."""
    return F.concat(lower_trim(series), F.lit(separator), lower_trim(author))


def slug(c: Column | str) -> Column:
    """Safe name for a file or partition."""
    text = F.regexp_replace(lower_trim(c), "[&/]", "_and_")
    text = F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", "_"), "_+", "_")
    return F.regexp_replace(text, "^_+|_+$", "")


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, so also after ``-`` and ``'`` (``initcap`` looks at spaces only)."""
    parts = F.regexp_extract_all(F.lower(col(c)), F.lit("([^\\p{L}]*)(\\p{L}*)"), 0)
    return F.array_join(
        F.transform(
            parts,
            lambda part: F.concat(
                F.regexp_extract(part, "^([^\\p{L}]*)", 1),
                F.upper(F.substring(F.regexp_extract(part, "(\\p{L}*)$", 1), 1, 1)),
                F.regexp_extract(part, "\\p{L}(\\p{L}*)$", 1),
            ),
        ),
        "",
    )


def clean_series_name(c: Column | str) -> Column:
    """Series name in title case without a trailing ``, #``."""
    return title_case(F.regexp_replace(trim_space(c), "[,#\\s]+$", ""))


def clean_series_label(c: Column | str) -> Column:
    """Series name without a trailing ``(... #n)`` or ``, #n``."""
    number = "#\\s*[0-9]+(?:\\.[0-9]+)?(?:-[0-9]+(?:\\.[0-9]+)?)?"
    text = F.regexp_replace(trim_space(c), f"\\s*\\([^)]*{number}[^)]*\\)\\s*$", "")
    return F.regexp_replace(F.regexp_replace(text, f"\\s*,?\\s*{number}\\s*$", ""), "^[ ,]+|[ ,]+$", "")


def clean_title(c: Column | str) -> Column:
    """Title without parenthesised series info (closed or cut off) and trailing ``, #``."""
    text = F.regexp_replace(trim_space(c), "\\s*\\([^)]+(\\)|$)", "")
    return F.regexp_replace(text, "[,#\\s]+$", "")
