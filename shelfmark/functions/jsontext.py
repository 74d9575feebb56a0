"""JSON held in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.contacts import checked_evidence
from shelfmark.functions.nulls import NUMBER, col, let, present, present_once, trim_space, trimmed


def bare_json(c: Column | str) -> Column:
    """JSON text without code fences and trailing commas."""
    def unfenced(text: Column) -> Column:
        return F.when(text.contains("```"), trim_space(F.regexp_replace(text, "^```(?:json)?|```$", ""))).otherwise(text)

    text = let(let(col(c), trimmed), unfenced)
    return F.regexp_replace(text, ",\\s*([}\\]])", "$1")


def lenient_rows(c: Column | str, row: T.StructType) -> Column:
    """ARRAY of rows from an answer text.

    Tried in order: the whole text, its outermost array, each flat object on its own. A single object is
    one row.
    """
    return let(bare_json(c), lambda text: _lenient_rows(text, row))


def _lenient_rows(text: Column, row: T.StructType) -> Column:
    schema = T.ArrayType(row)
    options = {"mode": "PERMISSIVE"}

    def rows(part: Column) -> Column:
        parsed = F.filter(F.from_json(part, schema, options), lambda r: r.isNotNull())
        return F.when(part.isNotNull() & F.json_array_length(part).isNotNull(), parsed)

    def single(part: Column) -> Column:
        whole = F.json_object_keys(part).isNotNull()
        return F.when(whole, F.array(F.from_json(part, row, options)))

    outer = F.nullif(F.regexp_extract(text, "(?s)(\\[.*\\])", 1), F.lit(""))
    flat = F.regexp_extract_all(text, F.lit("(?s)\\{[^{}]+\\}"), 0)
    salvaged = F.transform(
        F.filter(flat, lambda o: F.json_object_keys(o).isNotNull()), lambda o: F.from_json(o, row, options)
    )
    return F.coalesce(rows(text), single(text), rows(outer), salvaged)


def answer_text(c: Column | str) -> Column:
    """Joined text parts of the first candidate in a response envelope."""
    envelope = F.from_json(
        col(c), "struct<candidates: array<struct<content: struct<parts: array<struct<text: string>>>>>>"
    )
    parts = F.try_element_at(envelope["candidates"], F.lit(1))["content"]["parts"]
    return trim_space(F.array_join(F.transform(parts, lambda p: p["text"]), " "))


def answer_sources(c: Column | str) -> Column:
    """ARRAY of the distinct source links of the first candidate, in order."""
    envelope = F.from_json(
        col(c),
        "struct<candidates: array<struct<groundingMetadata: struct<groundingChunks: "
        "array<struct<web: struct<uri: string>>>>>>>",
    )
    chunks = F.try_element_at(envelope["candidates"], F.lit(1))["groundingMetadata"]["groundingChunks"]
    return F.array_distinct(F.filter(F.transform(chunks, lambda x: x["web"]["uri"]), lambda u: u.isNotNull()))


# Keys of an author payload whose names differ from client to client; a caller maps its own names to these.
PAYLOAD_KEYS = {
    "represented": "represented",
    "author_check_url": "author_check_url",
    "check_status": "check_status",
    "check_url": "check_url",
    "check_note": "check_note",
}
_AUTHOR_TEXTS = ("author_name", "representation_evidence_url", "author_check_url")
_SERIES_TEXTS = (
    "series_name", "goodreads_series_url", "primary_works", "total_books", "threshold_flag", "first_book_title",
    "first_book_goodreads_rating", "first_book_goodreads_rating_count", "genre_bucket", "lead_pairing", "sub_genre",
    "primary_trope", "check_status", "check_url", "check_note", "confidence_notes",
)


def author_payload(c: Column | str, author: Column | str, keys: dict[str, str] | None = None) -> Column:
    """One author payload from any of three shapes: an object, a list of objects, a list of series.

    ``keys`` gives the payload's names for the entries of ``PAYLOAD_KEYS``. The text is parsed once, as a list of objects
    that may have the fields of an author and of a series; a single object is made a list first.
    """
    named = PAYLOAD_KEYS | (keys or {})
    return let(bare_json(c), lambda text: _author_payload(text, author, named))


def _author_payload(text: Column, author: Column | str, named: dict[str, str]) -> Column:
    def fields(names) -> list[T.StructField]:
        return [T.StructField(named.get(name, name), T.StringType()) for name in names]

    urls = T.StructField("support_urls", T.ArrayType(T.StringType()))
    series = T.StructType([*fields(_SERIES_TEXTS), urls])
    represented = T.StructField(named["represented"], T.BooleanType())
    own = [*fields(_AUTHOR_TEXTS), represented, T.StructField("qualifying_series", T.ArrayType(series))]
    both = T.StructType([*own, *(f for f in series.fields if f.name not in {x.name for x in own})])
    listed = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)

    def as_series(x: Column) -> Column:
        return F.struct(*[x[named.get(name, name)].alias(name) for name in _SERIES_TEXTS], x["support_urls"].alias("support_urls"))

    def payload(items: Column) -> Column:
        is_series = ~text.startswith("{") & F.exists(items, lambda x: x["series_name"].isNotNull())
        first = F.try_element_at(items, F.lit(1))
        return F.when(
            is_series,
            F.struct(
                col(author).alias("author_name"), F.lit("").alias("representation_evidence_url"), F.lit("").alias("author_check_url"),
                F.lit(True).alias("represented"), F.transform(items, as_series).alias("qualifying_series"),
            ),
        ).when(
            first.isNotNull(),
            F.struct(
                *[first[named.get(name, name)].alias(name) for name in _AUTHOR_TEXTS], first[named["represented"]].alias("represented"),
                F.transform(first["qualifying_series"], as_series).alias("qualifying_series"),
            ),
        )

    return let(F.from_json(listed, T.ArrayType(both), {"mode": "PERMISSIVE"}), payload)


# Outcomes of the evidence check (M12)
CHECK_STATES = ["yes_series_level", "yes_author_level", "no"]


def qualifying_series(payload: Column, threshold: int = 5, domains: list[str] | None = None) -> Column:
    """ARRAY of the series of a represented author with at least ``threshold`` main works, typed, defaults set.

    An unknown check state is ``no``; with ``domains`` it is kept only while its evidence lies on one of them.
    """
    def number(c: Column) -> Column:
        return let(F.replace(c, F.lit(","), F.lit("")), lambda t: F.when(t.rlike(NUMBER), trimmed(t).try_cast("double")))

    def typed(s: Column, works: Column, author_url: Column, evidence_url: Column) -> Column:
        state = F.lower(F.trim(F.coalesce(s["check_status"], F.lit(""))))
        state = let(state, lambda x: F.when(x.isin(CHECK_STATES), x).otherwise(F.lit("no")))
        checked = F.struct(state.alias("status"), present_once(s["check_url"]).alias("url"))
        if domains:
            checked = let(checked, lambda c: checked_evidence(c["status"], c["url"], author_url, domains))
        urls = F.coalesce(s["support_urls"], F.array().cast("array<string>"))
        return let(checked, lambda checked: F.struct(
            present_once(s["series_name"]).alias("series_name"),
            present_once(s["goodreads_series_url"]).alias("series_url"),
            works.alias("primary_works"),
            number(s["total_books"]).try_cast("long").alias("total_books"),
            F.coalesce(
                present_once(s["threshold_flag"]),
                F.when(works == threshold, F.lit("eq5_included")).otherwise(F.lit("gt5_or_more")),
            ).alias("threshold_flag"),
            present_once(s["first_book_title"]).alias("first_book_title"),
            number(s["first_book_goodreads_rating"]).alias("first_book_rating"),
            number(s["first_book_goodreads_rating_count"]).try_cast("long").alias("first_book_rating_count"),
            present_once(s["genre_bucket"]).alias("genre"),
            present_once(s["lead_pairing"]).alias("lead_pairing"),
            present_once(s["sub_genre"]).alias("sub_genre"),
            present_once(s["primary_trope"]).alias("primary_trope"),
            checked["status"].alias("check_status"),
            checked["url"].alias("check_url"),
            present_once(s["check_note"]).alias("check_note"),
            author_url.alias("author_check_url"),
            evidence_url.alias("representation_evidence_url"),
            F.array_join(F.array_distinct(F.filter(F.transform(urls, lambda u: F.trim(u)), lambda u: u != "")), " | ").alias("support_urls"),
            present_once(s["confidence_notes"]).alias("confidence_notes"),
        ))

    def of_author(own: Column) -> Column:
        counted = F.transform(payload["qualifying_series"], lambda s: F.struct(s.alias("s"), number(s["primary_works"]).try_cast("long").alias("works")))
        kept = F.filter(counted, lambda x: x["works"] >= threshold)
        return F.transform(kept, lambda x: typed(x["s"], x["works"], own["url"], own["evidence"]))

    named = present(payload["author_name"]).isNotNull() & payload["represented"]
    own = F.struct(present_once(payload["author_check_url"]).alias("url"), present_once(payload["representation_evidence_url"]).alias("evidence"))
    return F.when(named, let(own, of_author))


VOLUME = (
    "struct<id: string, volumeInfo: struct<title: string, subtitle: string, authors: array<string>, "
    "description: string, categories: array<string>, pageCount: int, averageRating: double, "
    "ratingsCount: long, publisher: string, publishedDate: string, "
    "industryIdentifiers: array<struct<type: string, identifier: string>>>>"
)
DOC = (
    "struct<key: string, title: string, author_name: array<string>, first_publish_year: int, "
    "number_of_pages_median: int, ratings_average: double, ratings_count: long, publisher: array<string>, "
    "isbn: array<string>>"
)
STORE_ITEM = (
    "struct<trackId: long, trackName: string, artistName: string, averageUserRating: double, "
    "userRatingCount: long, releaseDate: string, description: string, genres: array<string>>"
)


def catalogue_record(c: Column | str, provider: str) -> Column:
    """One flat record of a stored catalogue answer.

    Providers: ``volume`` (nested volume info), ``doc`` (search documents), ``store`` (shop items).
    """
    if provider == "volume":
        v = F.from_json(col(c), VOLUME)
        info = v["volumeInfo"]
        isbn = F.filter(info["industryIdentifiers"], lambda i: i["type"] == "ISBN_13")
        fields = [
            v["id"], info["title"], F.try_element_at(info["authors"], F.lit(1)), info["publisher"],
            info["pageCount"], info["averageRating"], info["ratingsCount"], info["publishedDate"],
            F.try_element_at(isbn, F.lit(1))["identifier"],
        ]
    elif provider == "doc":
        v = F.from_json(col(c), DOC)
        fields = [
            v["key"], v["title"], F.try_element_at(v["author_name"], F.lit(1)),
            F.try_element_at(v["publisher"], F.lit(1)), v["number_of_pages_median"], v["ratings_average"],
            v["ratings_count"], v["first_publish_year"].cast("string"), F.try_element_at(v["isbn"], F.lit(1)),
        ]
    elif provider == "store":
        v = F.from_json(col(c), STORE_ITEM)
        fields = [
            v["trackId"].cast("string"), v["trackName"], v["artistName"], F.lit(None).cast("string"),
            F.lit(None).cast("int"), v["averageUserRating"], v["userRatingCount"], v["releaseDate"],
            F.lit(None).cast("string"),
        ]
    else:
        raise ValueError(f"unknown provider {provider!r}")
    names = ["source_id", "title", "author", "publisher", "pages", "rating", "rating_count", "published", "isbn"]
    return F.struct(
        *[f.alias(n) for f, n in zip(fields, names)],
        F.regexp_extract(fields[7], "^([0-9]{4})", 1).try_cast("int").alias("pub_year"),
        F.lit(provider).alias("provider"),
    )


def tagged_line(c: Column | str, tags: list[str], blanks: tuple[str, ...] = ("UNKNOWN", "NONE", "N/A", "")) -> Column:
    """STRUCT of ``TAG: value | TAG: value`` text; unknown values become NULL."""

    def value(tag: str) -> Column:
        text = trim_space(F.regexp_extract(col(c), f"(?i){tag}:\\s*([^|]+)", 1))
        return F.when(~F.upper(text).isin(*blanks), text)

    return F.struct(*[value(t).alias(t.lower()) for t in tags])


def grounded_label(found: Column, sources: Column | str, host_part: str, label: str = "search") -> Column:
    """Source label of an answer: grounded when one of its sources lies on the host."""
    grounded = F.exists(col(sources), lambda s: s.contains(host_part))
    return F.when(found, F.when(grounded, F.lit(f"{label}-grounded")).otherwise(F.lit(f"{label}-ungrounded")))


def merge_links(*arrays: Column | str) -> Column:
    """Distinct http links of several lists, in order."""
    every = F.flatten(F.array(*[F.coalesce(col(a), F.array().cast("array<string>")) for a in arrays]))
    return F.array_distinct(F.filter(every, lambda u: u.startswith("http")))
