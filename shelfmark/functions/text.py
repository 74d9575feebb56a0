"""Keyword tests, classification by keywords, and generated text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.config import vocab
from shelfmark.functions.keys import lower_trim, product_key, product_title_key, word_key
from shelfmark.functions.nulls import col, collapse_space, is_missing, let, present, trim_space


def quote(term: str) -> str:
    """A term with the regex characters escaped."""
    return "".join("\\" + ch if ch in "\\.^$|?*+()[]{}" else ch for ch in term)


def has_word(c: Column, term: str) -> Column:
    """Term on Unicode word boundaries; texts without the term skip the regex."""
    return c.contains(term) & c.rlike(f"(?U)\\b{quote(term)}\\b")


def has_term(c: Column, term: str, word_length: int = 0) -> Column:
    """Term anywhere in the text; terms up to ``word_length`` characters only as a whole word."""
    return has_word(c, term) if len(term) <= word_length else c.contains(term)


def any_term(c: Column, terms: list[str], word_length: int = 0) -> Column:
    """True when one of the terms occurs."""
    return reduce(lambda a, b: a | b, [has_term(c, t, word_length) for t in terms])


def any_pattern(c: Column, patterns: list[str], flags: str = "(?i)") -> Column:
    """True when one of the patterns is found."""
    return reduce(lambda a, b: a | b, [c.rlike(flags + p) for p in patterns])


def first_term(c: Column, terms: list[str], prefix: str = "", word_length: int = 0) -> Column:
    """``prefix`` + first term in list order that occurs, else NULL."""
    out = F.when(has_term(c, terms[0], word_length), F.lit(prefix + terms[0]))
    for term in terms[1:]:
        out = out.when(has_term(c, term, word_length), F.lit(prefix + term))
    return out


def terms_found(c: Column, terms: list[str], word_length: int = 0) -> Column:
    """ARRAY of the terms that occur, in list order."""
    return F.array_compact(F.array(*[F.when(has_term(c, t, word_length), F.lit(t)) for t in terms]))


def joined_text(*columns: Column | str) -> Column:
    """The columns as one lower-case text."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns]))


def short_synopsis(c: Column | str, sentences: int = 2, limit: int = 300) -> Column:
    """First sentences of a text, at most ``limit`` characters."""
    parts = F.split(trim_space(c), "(?<=[.!?])\\s+", sentences + 1)
    return F.substring(F.array_join(F.slice(parts, 1, sentences), " "), 1, limit)


def trope_scores(c: Column | str, tropes: dict[str, list[str]] = vocab.TROPES) -> Column:
    """ARRAY<STRUCT(score, neg_pos, name)>: number of keywords found per trope."""
    return let(F.lower(F.coalesce(col(c), F.lit(""))), lambda text: _trope_scores(text, tropes))


def _trope_scores(text: Column, tropes: dict[str, list[str]]) -> Column:
    return F.array(
        *[
            F.struct(
                reduce(lambda a, b: a + b, [text.contains(w).cast("int") for w in words]).alias("score"),
                F.lit(-i).alias("neg_pos"),
                F.lit(name).alias("name"),
            )
            for i, (name, words) in enumerate(tropes.items())
        ]
    )


def main_trope(c: Column | str, tropes: dict[str, list[str]] = vocab.TROPES) -> Column:
    """Trope with the most keywords, first in list order on a tie, NULL without any."""
    return let(F.array_max(trope_scores(c, tropes)), lambda best: F.when(best["score"] > 0, best["name"]))


def sport_tag(title: Column | str, author: Column | str, default: str = "Sports Romance") -> Column:
    """Sport named by title and author."""
    text = joined_text(title, author)
    out = None
    for tag, words in vocab.SPORT_TAG_WORDS.items():
        hit = any_term(text, words)
        out = F.when(hit, F.lit(tag)) if out is None else out.when(hit, F.lit(tag))
    return out.otherwise(F.lit(default))


def publisher_class(publisher: Column | str, blank: str = "") -> Column:
    """Self-Pub / Big Pub / Indie by publisher keywords; ``blank`` for a missing publisher."""
    text = lower_trim(publisher)
    return (
        F.when(text == "", F.lit(blank))
        .when(any_term(text, vocab.SELF_PUBLISHERS), F.lit("Self-Pub"))
        .when(any_term(text, vocab.BIG_PUBLISHERS), F.lit("Big Pub"))
        .otherwise(F.lit("Indie"))
    )


def publisher_class_by_author(publisher: Column | str, author: Column | str) -> Column:
    """As ``publisher_class`` with the rule that an author who is the publisher publishes on their own."""
    text, name = lower_trim(publisher), lower_trim(author)
    own = (F.length(text) > 0) & (F.length(name) > 0) & (text.contains(name) | name.contains(text))
    return (
        F.when(text.isin("", "nan", "unknown"), F.lit("Indie"))
        .when(own, F.lit("Self Pub"))
        .when(any_term(text, vocab.BIG_PUBLISHERS_WIDE), F.lit("Big Pub"))
        .when(any_term(text, vocab.SELF_PUBLISHERS_WIDE), F.lit("Self Pub"))
        .otherwise(F.lit("Indie"))
    )


def is_self_published(publisher: Column | str) -> Column:
    """Yes / No; a publisher that is unknown or not a big one counts as Yes."""
    text = lower_trim(publisher)
    big = any_term(text, vocab.BIG_PUBLISHERS) & ~any_term(text, vocab.SELF_PUBLISHERS)
    return F.when(big, F.lit("No")).otherwise(F.lit("Yes"))


def clean_publisher_flag(flag: Column | str) -> Column:
    """Spellings of the publisher flag folded to Self Pub / Big Pub / Indie."""
    text = lower_trim(flag)
    return (
        F.when(col(flag).isNull(), None)
        .when(text.isin("true", "self pub", "self-published"), F.lit("Self Pub"))
        .when(text.isin("false", "big pub", "traditional"), F.lit("Big Pub"))
        .otherwise(F.lit("Indie"))
    )


def imprint_of(publisher: Column | str, imprints: dict[str, list[str]] = vocab.AUDIO_IMPRINTS) -> Column:
    """Imprint whose alias occurs in the publisher text, first in list order."""
    text = product_key(publisher)
    out = None
    for name, aliases in imprints.items():
        hit = any_term(text, aliases)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def byline(c: Column | str) -> Column:
    """STRUCT(author, publisher) of ``Name (Role), Name (Role)``."""
    pairs = F.regexp_extract_all(col(c), F.lit("([^()]+?)\\s*\\(([^)]+)\\)"), 0)

    def of_role(role: str) -> Column:
        hit = F.filter(pairs, lambda p: F.lower(F.trim(F.regexp_extract(p, "\\(([^)]+)\\)", 1))) == role)
        name = F.regexp_extract(F.try_element_at(hit, F.lit(1)), "^([^()]+?)\\s*\\(", 1)
        return F.nullif(F.regexp_replace(name, "^[ ,]+|[ ,]+$", ""), F.lit(""))

    return F.struct(of_role("author").alias("author"), of_role("publisher").alias("publisher"))


def product_credits(c: Column | str) -> Column:
    """STRUCT(author, publisher) of the credits at the end of a product page title."""
    credits = F.regexp_extract(col(c), "\\(Audible Audio Edition\\):\\s*(.+?)\\s*:\\s*Books$", 1)
    names = F.filter(F.transform(F.split(credits, ","), trim_space), lambda x: F.length(x) > 0)
    last = F.try_element_at(names, F.lit(-1))
    company = (F.size(names) >= 2) & F.lower(last).isin(*vocab.COMPANY_SUFFIXES)
    return F.struct(
        F.try_element_at(names, F.lit(1)).alias("author"),
        F.when(company, F.concat_ws(", ", F.try_element_at(names, F.lit(-2)), last)).otherwise(last).alias("publisher"),
    )


def featured_titles(c: Column | str) -> Column:
    """ARRAY of distinct titles in a text joined by bars, without their parentheses."""
    titles = F.transform(F.split(col(c), "\\|"), lambda x: trim_space(F.regexp_replace(x, "\\([^)]*\\)", "")))
    return F.array_distinct(F.filter(titles, lambda x: (F.length(x) > 0) & (F.lower(x) != "nan")))


def distinct_titles(titles: Column | str) -> Column:
    """ARRAY without titles whose product key already occurred, order kept."""
    keyed = F.filter(
        F.transform(col(titles), lambda t: F.struct(product_title_key(t).alias("k"), trim_space(t).alias("t"))),
        lambda s: F.length(s["k"]) > 0,
    )

    def first_of_each(pairs: Column) -> Column:
        return F.transform(F.filter(pairs, lambda s, i: F.array_position(pairs["k"], s["k"]) == i + 1), lambda s: s["t"])

    return let(keyed, first_of_each)


def clean_agent_name(c: Column | str) -> Column:
    """Agent name without markdown, links, addresses and prose; NULL when none is left."""
    raw = col(c)
    text = F.regexp_replace(raw, "\\*+", "")
    text = F.regexp_replace(text, "\\[([^\\]]+)\\]\\([^)]+\\)", "$1")
    for pattern in (
        "https?://\\S+",
        "[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+(?:\\.[A-Za-z]{2,})?",
        "www\\.\\S+",
        "(?is)WEBSITE:.*$",
        "(?is)EMAIL:.*$",
        "(?i)\\bNONE\\b",
    ):
        text = F.regexp_replace(text, pattern, "")
    text = collapse_space(text)
    head = F.regexp_extract(text, "^([^.!?\\n]{10,80})", 1)
    text = F.when((F.length(text) > 80) & (F.length(head) > 0), trim_space(head)).otherwise(text)
    text = F.regexp_replace(text, "[ ,;:.]+$", "")
    not_agent = any_pattern(raw, vocab.NOT_AN_AGENT) | is_missing(raw) | (F.length(raw) < 3)
    return F.when(~not_agent & (F.length(text) > 3), text)


def plausible_agent(c: Column | str) -> Column:
    """False for blanks, stop words only, and one or two lower-case words."""
    raw = F.coalesce(trim_space(c), F.lit(""))
    tokens = F.regexp_extract_all(raw, F.lit("[A-Za-z]+"), 0)
    stops = F.forall(tokens, lambda t: F.lower(t).isin(*vocab.AGENT_STOP_WORDS))
    return (F.size(tokens) > 0) & ~stops & ~((F.lower(raw) == raw) & (F.size(tokens) <= 2))


def agent_from_text(c: Column | str) -> Column:
    """Agent named by the first sentence pattern that gives a plausible name."""
    found = []
    for pattern in vocab.AGENT_SENTENCE_PATTERNS:
        name = collapse_space(F.regexp_extract(col(c), "(?i)" + pattern, 1))
        name = F.regexp_replace(name, "^[ :\\-,]+|[ :\\-,]+$", "")
        name = F.regexp_replace(F.regexp_replace(name, "(?i)\\b(?:at|via)\\b.*$", ""), "^[ :\\-,]+|[ :\\-,]+$", "")
        found.append(F.when(plausible_agent(name), name))
    return F.coalesce(*found)


def rationale(rank, rating, count, books, era, validation) -> Column:
    """One line such as ``P0: 4.3* (12.5k ratings), 5 books, After 2020. <validation>``."""
    r, n = F.coalesce(col(rating), F.lit(0.0)), F.coalesce(col(count).cast("double"), F.lit(0.0))
    stars = F.when(r > 0, F.format_string("%.1f", F.round(r, 1))).otherwise(F.lit("N/A"))
    volume = F.when(n >= 1000, F.format_string("%.1fk", F.round(n / 1000, 1))).otherwise(n.cast("long").cast("string"))
    size = F.when(col(books) > 0, col(books).cast("long").cast("string")).otherwise(F.lit("?"))
    head = F.concat(
        col(rank), F.lit(": "), stars, F.lit("* ("), volume, F.lit(" ratings), "), size, F.lit(" books, "),
        F.coalesce(present(era), F.lit("Unknown era")),
    )
    return F.concat_ws(". ", head, present(validation))


def fill_template(template: str, fields: dict[str, Column]) -> Column:
    """Template text with ``{name}`` replaced by the columns."""
    out = F.lit(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def has_placeholder(c: Column | str) -> Column:
    """True while a ``{name}`` is left in the text."""
    return col(c).rlike("\\{[a-z_]+\\}")


def salutation(author: Column | str) -> Column:
    """First word of the author's name, "Author" when that is an article, a title or one letter."""
    first = F.regexp_extract(F.coalesce(col(author), F.lit("")), "(\\S+)", 1)
    good = (F.length(first) > 1) & ~F.lower(first).isin(*vocab.GENERIC_SALUTATIONS)
    return F.when(good, first).otherwise(F.lit("Author"))


def headline_fee(display: Column | str) -> Column:
    """Upper amount of a fee range; "Revenue Share Only" without a fee."""
    amount = F.regexp_extract(col(display), "\\$([0-9,]+)\\s*$", 1)
    return (
        F.when(F.length(amount) > 0, F.concat(F.lit("$"), amount))
        .when(is_missing(display) | (col(display) == "No MG"), F.lit("Revenue Share Only"))
        .otherwise(col(display))
    )


def labelled(parts: dict[str, Column], separator: str = " | ", default: str | None = None) -> Column:
    """``label: value`` for every present value, joined."""
    pieces = [F.when(~is_missing(v), F.concat(F.lit(f"{k}: "), trim_space(v))) for k, v in parts.items()]
    text = F.concat_ws(separator, *pieces)
    return F.when(F.length(text) > 0, text).otherwise(F.lit(default))


def repair_summary(pairs: list[tuple[str, Column, Column]]) -> Column:
    """``what corrected to value`` for every verified value that differs from the source, joined by "; "."""
    notes = [
        F.when(~is_missing(new) & (word_key(new) != word_key(old)), F.concat(F.lit(f"{what} corrected to "), new))
        for what, new, old in pairs
    ]
    return F.concat_ws("; ", *notes)
