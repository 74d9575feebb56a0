"""Title parsing: series name, book number, subtitle, list entries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.config.vocab import BOX_SET_PATTERNS, LIST_SKIP_WORDS, SERIES_TITLE_PATTERNS
from shelfmark.functions.keys import fold_accents, lower_free
from shelfmark.functions.nulls import col, collapse_space, let, trim_space

# Series patterns in order: (pattern, has series group, number group) -----------------
SERIES_PATTERNS = [
    ("\\(([^)]+(?:Series|Saga|Trilogy|Duology))\\s*(?:#|Book)?\\s*([0-9]+)?\\)", True, 2),
    ("\\(([^)]+)\\s+(?:#|Book)\\s*([0-9]+(?:\\.[0-9]+)?)\\)", True, 2),
    (":\\s*(?:Book|#)\\s*([0-9]+(?:\\.[0-9]+)?)", False, 1),
    ("-\\s*(?:Book|#)\\s*([0-9]+(?:\\.[0-9]+)?)", False, 1),
    ("\\(#([0-9]+(?:\\.[0-9]+)?)\\)", False, 1),
]
# Patterns of list titles (X10) -------------------------------------------------------
LIST_SERIES_PATTERNS = [
    "\\((.+?)\\s+(?:Book|#|Vol|Series|Bk)\\s*[0-9]",
    "\\((.+?)\\s+[0-9]+\\)",
    ":\\s+(?:A\\s+)?(.+?)\\s+(?:Novel|Romance|Story|Series)",
    "\\((.+?)\\)",
]


def _first_case(conditions: list[Column], values: list[Column]) -> Column:
    """CASE WHEN over two aligned lists."""
    out = F.when(conditions[0], values[0])
    for condition, value in zip(conditions[1:], values[1:]):
        out = out.when(condition, value)
    return out


def map_characters(c: Column | str) -> Column:
    """Typographic dashes, quotes and the ellipsis to their plain forms, ``&`` to "and"."""
    text = F.translate(col(c), "–—‘’“”", "--''\"\"")
    return F.replace(F.replace(text, F.lit("…"), F.lit("...")), F.lit("&"), F.lit("and"))


def series_info(c: Column | str) -> Column:
    """STRUCT(series_name, book_number, cleaned) by the first series pattern that matches."""
    return let(col(c), _series_info)


def _series_info(text: Column) -> Column:
    hits = [text.rlike("(?i)" + pattern) for pattern, _, _ in SERIES_PATTERNS]
    series, number, cleaned = [], [], []
    for pattern, has_series, group in SERIES_PATTERNS:
        name = F.regexp_extract(text, "(?i)" + pattern, 1) if has_series else F.lit("")
        series.append(F.regexp_replace(trim_space(name), "[\\s,;:#-]+$", ""))
        number.append(F.regexp_extract(text, "(?i)" + pattern, group))
        rest = 4 if has_series else 3
        cleaned.append(collapse_space(F.regexp_replace(text, f"(?is)^(.*?){pattern}(.*)$", f"$1 ${rest}")))
    return F.struct(
        F.nullif(_first_case(hits, series), F.lit("")).alias("series_name"),
        F.nullif(_first_case(hits, number), F.lit("")).alias("book_number"),
        _first_case(hits, cleaned).otherwise(text).alias("cleaned"),
    )


# En and em dash, in the order in which they are tried after the colon
LONG_DASHES = ("\u2013", "\u2014")


def main_title(c: Column | str, spaced_dash: bool = False) -> Column:
    """Title before the subtitle: cut at the first colon, else en dash, else em dash.

    With ``spaced_dash`` the first of a colon and a spaced hyphen comes before the long dashes.
    """
    text = col(c)
    cuts = ["(?s)^(.*?)(?::\\s*.+|\\s-\\s.+)$" if spaced_dash else "(?s)^(.*?):\\s*.+$", *(f"(?s)^(.*?){dash}\\s*.+$" for dash in LONG_DASHES)]
    out = F.when(text.rlike(cuts[0]), F.regexp_extract(text, cuts[0], 1))
    for cut in cuts[1:]:
        out = out.when(text.rlike(cut), F.regexp_extract(text, cut, 1))
    return trim_space(out.otherwise(text))


def subtitle(c: Column | str) -> Column:
    """Text after the first colon, else en dash, else em dash; NULL without one."""
    found = [F.nullif(trim_space(F.regexp_extract(col(c), f"(?s)^.*?{mark}\\s*(.+)$", 1)), F.lit("")) for mark in (":", *LONG_DASHES)]
    return F.coalesce(*found)


def normalize_title(c: Column | str, spaced_dash: bool = False) -> Column:
    """STRUCT(original, strict, standard, fuzzy, core_title, series_name, book_number)."""

    def forms(original: Column, strict: Column, info: Column) -> Column:
        return let(
            collapse_space(F.regexp_replace(info["cleaned"], "[<>{}\\[\\]\\\\|]", "")),
            lambda standard: F.struct(
                original.alias("original"),
                trim_space(strict).alias("strict"),
                standard.alias("standard"),
                F.regexp_replace(F.lower(standard), "[^a-z0-9]", "").alias("fuzzy"),
                main_title(info["cleaned"], spaced_dash).alias("core_title"),
                info["series_name"].alias("series_name"),
                info["book_number"].alias("book_number"),
            ),
        )

    return let(
        lower_free(c),
        lambda original: let(
            fold_accents(original),
            lambda strict: let(series_info(map_characters(strict)), lambda info: forms(original, strict, info)),
        ),
    )


def fuzzy_title(c: Column | str) -> Column:
    """Only the ``fuzzy`` form of a title."""
    text = map_characters(fold_accents(lower_free(c)))
    return F.regexp_replace(F.lower(series_info(text)["cleaned"]), "[^a-z0-9]", "")


def list_series(c: Column | str) -> Column:
    """Series name in a list title: first pattern whose text has more than 3 and fewer than 100 characters."""
    found = [trim_space(F.regexp_extract(col(c), p, 1)) for p in LIST_SERIES_PATTERNS]
    return F.coalesce(*[F.when((F.length(s) > 3) & (F.length(s) < 100), s) for s in found])


def series_from_title(title: Column | str, series: Column | str) -> Column:
    """Known series name, else the parenthesised text of the title without its number."""
    known = F.when(~F.lower(trim_space(series)).isin("nan", "no_series", ""), col(series))
    return F.coalesce(known, F.nullif(trim_space(F.regexp_extract(col(title), "\\(([^#)]+)(?:\\s+#[0-9]+)?\\)", 1)), F.lit("")))


def _unicode(pattern: str) -> str:
    return "(?iU)" + pattern


def _title_text(title: Column | str, first_book: Column | str | None) -> Column:
    second = F.lit("") if first_book is None else F.coalesce(col(first_book), F.lit(""))
    return F.concat_ws(" ", F.coalesce(col(title), F.lit("")), second)


def series_pattern(title: Column | str, first_book: Column | str | None = None) -> Column:
    """``title_pattern: <n>`` for the first series pattern (1 to 11) found in title and first book, else NULL."""
    text = _title_text(title, first_book)
    hits = [text.rlike(_unicode(p)) for p in SERIES_TITLE_PATTERNS]
    return _first_case(hits, [F.lit(f"title_pattern: {i}") for i in range(1, len(hits) + 1)])


def is_box_set(title: Column | str, first_book: Column | str | None = None) -> Column:
    """True when title or first book reads like a box set."""
    text = _title_text(title, first_book)
    return reduce(lambda a, b: a | b, [text.rlike(_unicode(p)) for p in BOX_SET_PATTERNS])


def list_item(c: Column | str) -> Column:
    """STRUCT(rank, title, author) of the text of one bestseller list entry.

    Entries of several lines: the first two plain lines after the ``#n`` line are title and author.
    Entries in one line: the text before the rating is split at the last lower-to-upper boundary beyond
    the tenth character, or after a closing parenthesis.
    """
    return let(trim_space(c), _list_item)


def _list_item(text: Column) -> Column:
    lines = F.filter(F.transform(F.split(text, "\n"), trim_space), lambda x: F.length(x) > 0)

    def plain(line: Column) -> Column:
        skip = reduce(lambda a, b: a | b, [line.contains(w) for w in LIST_SKIP_WORDS])
        return ~line.startswith("#") & (F.length(line) >= 3) & ~skip & ~line.rlike("^[0-9.,]+$")

    single = F.size(F.filter(lines, lambda x: ~x.startswith("#"))) == 0
    plain_lines = F.filter(lines, plain)
    title_many = F.try_element_at(F.filter(plain_lines, lambda x: F.length(x) > 3), F.lit(1))
    after = F.slice(plain_lines, F.greatest(F.array_position(plain_lines, title_many), F.lit(1)) + 1, F.size(plain_lines) + 1)
    author_many = F.try_element_at(F.filter(after, lambda x: (F.length(x) > 2) & (x != title_many)), F.lit(1))

    blob = F.regexp_replace(F.element_at(F.split(text, "\n"), 1), "^#[0-9]+\\s*", "")
    rating = "[0-9]+\\.[0-9]+\\s+out\\s+of\\s+5\\s+star"
    rated = blob.rlike(rating)
    both = trim_space(F.regexp_extract(blob, f"^(.*?){rating}", 1))
    closing = "^(.*?\\))(\\p{Lu}.*)$"
    boundary = "^(.{10,}[\\p{Ll}.!?,;:])(\\p{Lu}.*)$"
    split_at = F.when(both.rlike(closing), F.struct(F.regexp_extract(both, closing, 1).alias("t"), F.regexp_extract(both, closing, 2).alias("a"))).when(
        both.rlike(boundary),
        F.struct(F.regexp_extract(both, boundary, 1).alias("t"), F.regexp_extract(both, boundary, 2).alias("a")),
    ).otherwise(F.struct(both.alias("t"), F.lit("").alias("a")))
    title_one = F.when(rated, split_at["t"]).when(F.length(blob) > 5, F.substring(blob, 1, 200))
    author_one = F.when(rated, split_at["a"])
    return F.struct(
        F.coalesce(F.regexp_extract(text, "^#([0-9]+)", 1).try_cast("int"), F.lit(0)).alias("rank"),
        F.nullif(trim_space(F.when(single, title_one).otherwise(title_many)), F.lit("")).alias("title"),
        F.nullif(trim_space(F.when(single, author_one).otherwise(author_many)), F.lit("")).alias("author"),
    )
