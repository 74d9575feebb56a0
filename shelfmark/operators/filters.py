"""Row filters. Each gives a reason column; ``split`` turns it into kept rows and removed rows with reason."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.config import vocab
from shelfmark.functions.keys import lower_trim, spaced_key
from shelfmark.functions.nulls import all_missing, any_missing, best_count, col, is_missing, let, present
from shelfmark.functions.text import any_pattern, any_term, first_term, has_word, joined_text, terms_found
from shelfmark.operators.groups import top_per_key

REASON = "reject_reason"


def with_reason(df: DataFrame, reason: Column) -> DataFrame:
    """All rows with their reason, NULL for rows to keep."""
    return df.withColumn(REASON, reason)


def split(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(kept rows, removed rows with their reason)."""
    marked = with_reason(df, reason)
    return marked.filter(F.col(REASON).isNull()).drop(REASON), marked.filter(F.col(REASON).isNotNull())


def first_reason(*reasons: Column) -> Column:
    """Reason of the first filter that rejects the row."""
    return F.coalesce(*reasons)


def reject_unless(keep: Column, reason: str) -> Column:
    """Reason text where the condition is not true."""
    return F.when(~F.coalesce(keep, F.lit(False)), F.lit(reason))


def keyword_reason(
    *columns: Column | str,
    non_fiction: list[str] = vocab.NON_FICTION_DENY,
    allow: list[str] = vocab.ALLOW_EXCEPTIONS,
    deny: list[str] = vocab.HARD_DENY,
    context: list[str] = vocab.CONTEXT_DENY,
    word_length: int = 4,
    least_context: int = 2,
) -> Column:
    """Non-fiction terms, then exceptions that keep the row, then hard terms, then two context terms.

    Terms of up to ``word_length`` characters must be whole words.
    """

    def listed(found: Column) -> Column:
        return F.when(F.size(found) >= least_context, F.concat(F.lit("fantasy-context: "), F.array_join(found, ", ")))

    def reason(text: Column) -> Column:
        hard = first_term(text, deny, "fantasy: ", word_length)
        many = let(terms_found(text, context, word_length), listed)
        return F.coalesce(
            first_term(text, non_fiction, "non-romance: "), F.when(~any_term(text, allow), F.coalesce(hard, many))
        )

    return let(joined_text(*columns), reason)


def simple_keyword_reason(*columns: Column | str, deny: list[str], allow: Sequence[str] = (), prefix: str = "excluded: ") -> Column:
    """First denied term anywhere in the text unless an exception occurs."""

    def reason(text: Column) -> Column:
        hit = first_term(text, deny, prefix)
        return F.when(~any_term(text, list(allow)), hit) if allow else hit

    return let(joined_text(*columns), reason)


def topic_reason(*columns: Column | str, long_text: int = 150) -> Column:
    """Keeps fiction on the topic; long texts also need a drama word or a general fiction word."""
    # every filled field is appended with a leading space; the length test counts those spaces
    text = F.lower(F.concat_ws("", *[F.concat(F.lit(" "), F.nullif(col(c).cast("string"), F.lit(""))) for c in columns]))
    return let(text, lambda t: _topic_reason(t, long_text))


def _topic_reason(text: Column, long_text: int) -> Column:
    dry = (F.length(text) > long_text) & ~any_term(text, vocab.DRAMA_WORDS) & ~any_term(text, vocab.DRAMA_FALLBACK)
    non_fiction = reduce(lambda a, b: a | b, [has_word(text, w) for w in vocab.TOPIC_NON_FICTION])
    return (
        F.when(non_fiction, F.lit("non-fiction"))
        .when(~any_term(text, vocab.TOPIC_WORDS), F.lit("off-topic"))
        .when(dry, F.lit("no-drama"))
    )


def ban_reason(subgenre: Column | str, series: Column | str, title: Column | str) -> Column:
    """Banned script, banned title, or banned genre without the sports exemption."""
    s, t = F.lower(F.coalesce(col(series), F.lit(""))), F.lower(F.coalesce(col(title), F.lit("")))
    g = F.lower(F.coalesce(col(subgenre), F.lit("")))
    both = F.concat(s, F.lit("\n"), t)
    return (
        F.when(both.rlike(vocab.CJK_SCRIPT), F.lit("script"))
        .when(any_term(both, vocab.BAN_TITLES), F.lit("title"))
        .when(any_term(g, vocab.BAN_GENRES) & ~any_term(g, vocab.BAN_GENRE_EXEMPT), F.lit("genre"))
    )


def english_reason(title: Column | str) -> Column:
    """Foreign edition phrases and scripts."""
    text = F.coalesce(col(title), F.lit(""))
    return F.when(any_term(F.lower(text), vocab.EDITION_PHRASES), F.lit("foreign edition")).when(
        text.rlike(vocab.FOREIGN_SCRIPT), F.lit("foreign script")
    )


def junk_reason(title: Column | str, author: Column | str) -> Column:
    """Institutional authors and titles, author fields that are no names."""
    t, a = lower_trim(title), lower_trim(author)
    return (
        F.when(any_term(a, vocab.JUNK_AUTHORS), F.lit("junk author"))
        .when(any_term(t, vocab.JUNK_TITLES), F.lit("junk title"))
        .when(any_pattern(a, vocab.JUNK_AUTHOR_PATTERNS), F.lit("not an author"))
        .when(a.isin(*vocab.WRONG_GENRE_AUTHORS), F.lit("wrong genre"))
    )


def quality_reason(title: Column | str, author: Column | str) -> Column:
    """Title and author present and different, title of at least 3 characters."""
    t, a = lower_trim(title), lower_trim(author)
    return (
        F.when(is_missing(title), F.lit("no title"))
        .when(is_missing(author), F.lit("no author"))
        .when(t == a, F.lit("title is author"))
        .when(F.length(col(title)) < 3, F.lit("short title"))
    )


def long_enough(books: Column | str, verified_books: Column | str, verified: Column | str, method: Column | str) -> Column:
    """Three or more books; an unknown count passes when the series is verified."""
    n = best_count(books, verified_books)
    sure = present(verified).isin("Yes", "Likely")
    hinted = F.coalesce(col(method), F.lit("")).contains("title_pattern") | F.lower(F.coalesce(col(method), F.lit(""))).contains("box")
    return F.when(n >= 3, True).when(n.isNotNull(), False).otherwise(F.coalesce(sure, F.lit(False)) | hinted)


def viable_series(books, verified_books, verified, method, rating, first_book) -> Column:
    """Keep rule of the verification step; the order of the tests decides."""
    n = F.coalesce(best_count(books, verified_books), F.lit(0))
    state = F.coalesce(present(verified), F.lit(""))
    how = F.lower(F.coalesce(col(method), F.lit("")))
    hinted = how.contains("box") | how.contains("title_pattern")
    has_rating, has_first = ~is_missing(col(rating).cast("string")), ~is_missing(first_book)
    return (
        F.when(n >= 3, True)
        .when((state == "Yes") & (n == 0), True)
        .when((state == "Likely") & (n != 1), True)
        .when(hinted & (n.isin(0) | (n >= 2)), True)
        .when((state == "Skipped") & (has_rating | has_first), True)
        .when(state == "No", False)
        .when(n.isin(1, 2), False)
        .otherwise(has_rating)
    )


def length_or_signal(books, rating, first_book) -> Column:
    """Three or more books, or an unknown count with a rating or a first book."""
    n = best_count(books)
    return F.when(n.isNotNull(), n >= 3).otherwise(~is_missing(col(rating).cast("string")) | ~is_missing(first_book))


def independent_only(flag: Column | str, publisher: Column | str) -> Column:
    """Rejects "traditional"; accepts independent flags, independent publishers and unknown flags."""
    kind, name = lower_trim(flag), lower_trim(publisher)
    return (
        F.when(kind == "traditional", False)
        .when(any_term(kind, vocab.INDEPENDENT_FLAGS), True)
        .when(any_term(name, vocab.INDEPENDENT_PUBLISHERS), True)
        .otherwise(kind.isin("", "nan"))
    )


def is_collection(title: Column | str) -> Column:
    """Box set, collection, omnibus or a range of books."""
    text = F.lower(F.coalesce(col(title), F.lit("")))
    return any_pattern(text, vocab.COLLECTION_PATTERNS, "(?U)") | any_term(text, vocab.BUNDLE_PHRASES)


def is_main_entry(book_number: Column | str) -> Column:
    """Whole book number from 1: no 0, no halves, no ranges."""
    text = F.coalesce(F.trim(col(book_number).cast("string")), F.lit(""))
    return ~(text.isin("", "0") | text.startswith("0.") | text.contains(".5") | text.contains("-"))


def needs_verification(books: Column | str, verified: Column | str) -> Column:
    """Not verified yet and fewer than 3 known books."""
    done = lower_trim(verified).isin("yes", "true", "verified")
    return ~done & ~F.coalesce(best_count(books) >= 3, F.lit(False))


def eligible_outreach(status: Column | str, email_status: Column | str) -> Column:
    """Waiting for a contact and nothing sent yet."""
    sent = F.coalesce(F.lower(col(email_status)).contains("sent"), F.lit(False))
    return F.coalesce(F.trim(col(status)).isin(*vocab.ELIGIBLE_STATUSES), F.lit(False)) & ~sent


def not_failed(status: Column | str) -> Column:
    """False for rows whose lookup failed."""
    return F.coalesce(col(status) != "FAILED_LOOKUP", F.lit(True))


def wrong_link(link: Column | str, host_part: str, search_marks: Sequence[str] = ("/s?", "/search")) -> Column:
    """Missing link, link to another host, or link to a search page."""
    text = F.lower(F.coalesce(col(link), F.lit("")))
    return ~text.contains(host_part) | any_term(text, list(search_marks))


def needs_work(any_of: Sequence[str] = (), all_of: Sequence[str] = (), zero: Sequence[str] = (), links: dict[str, str] | None = None, long_text: dict[str, int] | None = None) -> Column:
    """True for rows a repair step must look at; every rule given is one way to qualify.

    ``any_of``: one of the columns is missing; ``all_of``: all of them are; ``zero``: a number is missing or 0;
    ``links``: column to host, the link is missing or wrong; ``long_text``: column to most characters.
    """
    rules = []
    if any_of:
        rules.append(any_missing(list(any_of)))
    if all_of:
        rules.append(all_missing(list(all_of)))
    rules += [F.coalesce(F.col(c) == 0, F.lit(True)) for c in zero]
    rules += [wrong_link(c, host_part) for c, host_part in (links or {}).items()]
    rules += [F.coalesce(F.length(c) > n, F.lit(False)) for c, n in (long_text or {}).items()]
    return reduce(lambda a, b: a | b, rules)


def verdict_filter(df: DataFrame, verdicts: DataFrame, keys: Sequence[str], keep: Column) -> DataFrame:
    """Rows whose verdict says keep; rows without a verdict stay. ``keep`` reads verdict columns."""
    judged = verdicts.withColumn("__keep", F.coalesce(keep, F.lit(True))).groupBy(*keys).agg(F.min("__keep").alias("__keep"))
    return df.join(judged, list(keys), "left").filter(F.coalesce(F.col("__keep"), F.lit(True))).drop("__keep")


def validated_series(df: DataFrame, existing: DataFrame, order: Sequence[Column], deny: list[str] = vocab.DISCOVERY_DENY) -> DataFrame:
    """Seven filters on discovered series.

    ``df``: series_name, author_name, num_books, genres, description, self_pub_flag, validated, ratings
    (array). ``existing``: one ``key`` column with "series|||author" and "series" keys (S8).
    """
    text_ok = ~any_term(joined_text("genres", "series_name", "description"), deny)
    rated = F.filter("ratings", lambda r: r > 0)
    passed = (
        F.coalesce(F.col("validated"), F.lit(False))
        & (F.col("num_books") >= 3)
        & ~F.coalesce(F.col("self_pub_flag") == "Big Pub", F.lit(False))
        & text_ok
        & ((F.size(rated) <= 0) | (F.array_max(rated) >= 3.0))
    )
    series = spaced_key("series_name")
    kept = df.filter(passed).withColumn("__s", series).withColumn("__sa", F.concat(series, F.lit("|||"), spaced_key("author_name")))
    known = existing.select("key").distinct()
    kept = kept.join(known.withColumnRenamed("key", "__sa"), "__sa", "left_anti")
    kept = kept.join(known.withColumnRenamed("key", "__s"), "__s", "left_anti")
    return top_per_key(kept, ["__sa"], order).drop("__s", "__sa")


def spot_check(df: DataFrame, key: Column, n: int, seed: int = 7) -> DataFrame:
    """The same n rows on every run: the first ones by the MD5 digest of the key as text with the seed."""
    return df.orderBy(F.md5(F.concat_ws("|", key.cast("string"), F.lit(seed)).cast("binary")), key).limit(n)
