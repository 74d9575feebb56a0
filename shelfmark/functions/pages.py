"""Fields of stored catalogue and shop pages, all from one scan of each page (``outline``), in Arrow batches.

Structured data wins over visible elements, and the rules of a field are tried in their order. Texts have single spaces; what
is missing is NULL. Class names, ids and labels of the pages are fixed values.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.nulls import col
from shelfmark.functions.outline import Element, Outline

BOOK_FIELDS = (
    "title string, author string, rating double, rating_count long, review_count long, pages int, publication string, published string, publisher string, "
    "first_published string, isbn string, asin string, settings string, awards string, original_title string, genres array<string>, synopsis string, "
    "series string, series_url string, number string, store_url string"
)
SHOP_FIELDS = (
    "title string, author string, rating double, rating_count long, series string, number string, total_books string, pages int, publisher string, "
    "published string, best_rank string, catalogue_rating double, catalogue_rating_count long, synopsis string"
)
GENRES = 5
STORES = ("amazon", "kindle")
_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[A-Z][a-z]+ [0-9]+, [0-9]{4}")


def _found(pattern: str, text: str | None, group: int = 1, flags: int = re.I) -> str | None:
    hit = re.search(pattern, text, flags) if text else None
    return hit.group(group).strip() or None if hit and hit.group(group) else None


def _number(value: object, kind: type) -> object:
    try:
        return kind(float(str(value).strip())) if value is not None else None
    except (ValueError, OverflowError):
        return None


def _digits(text: str | None) -> int | None:
    return _number(re.sub(r"[^0-9]", "", text) or None, int) if text else None


def _first(*values: object) -> object:
    return next((x for x in values if x is not None), None)


def _structured(page: Outline) -> dict:
    for element, body in page.scripts:
        if "ld+json" in (element.get("type") or "").lower():
            try:
                data = json.loads(body)
            except ValueError:
                return {}
            return data if isinstance(data, dict) else {}
    return {}


def _people(value: object) -> str | None:
    names = [x.get("name") if isinstance(x, dict) else x for x in (value if isinstance(value, list) else [value])]
    return ", ".join(x for x in names if isinstance(x, str) and x) or None


def _details(page: Outline) -> list[tuple[str, str, Element]]:
    """(lower-case label, value, item) of the description list."""
    items = page.all(".CollapsableList .DescListItem") or page.all(".BookDetails .DescListItem") or page.all('[data-testid*="details"] dt')
    out = []
    for item in items:
        label = page.first("dt, .DescListItem__label", item) or item
        value = page.first("dd, .DescListItem__content", item) or page.next_sibling(item)
        if value is not None:
            out.append(((page.text(label) or "").lower(), page.text(value) or "", item))
    return out


def _absolute(link: str | None, site: str) -> str | None:
    return link if not link or link.startswith("http") else site + link


def read_book_page(html: str | None, site: str = "") -> dict:
    """The values of ``BOOK_FIELDS`` of a catalogue page; relative links are completed with ``site``."""
    page = Outline(html or "")
    data = _structured(page)
    votes = data.get("aggregateRating") if isinstance(data.get("aggregateRating"), dict) else {}
    out: dict[str, object] = {}

    def at(name: str) -> str | None:
        return page.text(page.first(f'[data-testid="{name}"]'))

    out["title"] = _first(at("bookTitle"), data.get("name") if isinstance(data.get("name"), str) else None)
    out["author"] = _first(_people(data.get("author")), page.text(page.first(".ContributorLink__name")))
    out["rating"] = _first(_number(votes.get("ratingValue"), float), _number(page.text(page.first(".RatingStatistics__rating")), float))
    out["rating_count"] = _first(_number(votes.get("ratingCount"), int), _digits(at("ratingsCount")))
    out["review_count"] = _first(_number(votes.get("reviewCount"), int), _digits(at("reviewsCount")))

    line = out["publication"] = at("publicationInfo")
    out["published"] = _found(r"published\s+(.*?)(?:\s+by\s+(.*))?$", line)
    out["publisher"] = _found(r"published\s+(.*?)(?:\s+by\s+(.*))?$", line, 2)
    awards = []
    details = _details(page)
    for label, value, _ in details:
        if "isbn" in label and "isbn13" not in label:
            out["isbn"] = value or None
        elif "asin" in label:
            out["asin"] = value or None
        elif "setting" in label:
            out["settings"] = value or None
        elif "award" in label:
            awards.append(value)
        elif "publisher" in label:
            out["publisher"] = value or out["publisher"]
        elif "original title" in label:
            out["original_title"] = value or None
        elif "original publication date" in label:
            out["first_published"] = value or None
    out["awards"] = ", ".join(x for x in awards if x) or None
    in_details = next((n for _, value, _ in details if (n := _found(r"([0-9]+)\s*pages", value))), None)
    out["pages"] = _number(_first(data.get("numberOfPages") or None, _found(r"([0-9]+)\s*pages", at("pagesFormat")), in_details), int)

    genres = [page.text(x) for x in page.all(".BookPageMetadataSection__genres .Button__labelItem")[:GENRES]]
    out["genres"] = [x for x in genres if x]
    places = ['[data-testid="description"] .Formatted', ".DetailsLayoutRightParagraph .Formatted", ".BookPageMetadataSection__description .Formatted", 'div[data-testid="description"]']
    texts = [x for place in places if (x := page.text(page.first(place))) and len(x) > 50]
    texts += [x for element in page.all("div.Formatted") if (x := page.text(element)) and len(x) > 100]
    out["synopsis"] = texts[0] if texts else None

    link = page.first('h3[aria-label="Book Series"] a') or page.first('a[href*="/series/"]')
    out["series"] = page.text(link)
    out["series_url"] = _absolute(link.get("href"), site) if link else None
    if out["series"] is None:
        in_title = _found(r"\(([^)]+)\)", out["title"])
        marked = in_title if in_title and ("series" in in_title.lower() or "#" in in_title) else None
        out["series"] = _first(_found(r"\(([^)]+Series[^)]*)\)", out["title"]), marked)
    out["number"] = _found(r"#\s*([0-9]+(?:\.[0-9]+)?)", out["series"])

    for place in (".BookPageMetadataSection__buyButtons a", ".Button__container--block a"):
        for element in page.all(place) if out.get("store_url") is None else ():
            target, shown = element.get("href"), (page.text(element) or "").lower()
            if target and not target.startswith("javascript") and any(x in shown for x in STORES):
                out["store_url"] = _absolute(target, site)
    return out


def _bullets(page: Outline) -> dict[str, str]:
    """Lower-case label -> value of the ``Label : value`` list items of a page; the first of a label counts."""
    out: dict[str, str] = {}
    for item in page.all("li"):
        hit = re.match(r"([^:]{1,60}?)[^\w)]*:\s*(\S.*)$", page.text(item) or "")
        if hit:
            out.setdefault(hit.group(1).strip().lower(), hit.group(2).strip())
    return out


def _without_notes(text: str | None) -> str | None:
    return re.sub(r"\s*\([^)]+\)\s*", "", text).strip() or None if text else None


def _best_rank(page: Outline, items: list[Element], bullets: dict[str, str]) -> str | None:
    """The ranks of all categories, from the most general on, joined by ``|``."""
    clean = lambda text: " ".join(re.sub(r"\(See Top [0-9]+.*?\)", "", text or "").split())
    for item in items:
        bold = page.text(page.first(".a-text-bold", item)) or ""
        if "Best Sellers Rank" not in bold:
            continue
        nested = page.first("ul.zg_hrsr", item)
        if nested is not None:
            parts = [page.text(x) for x in page.all("li span.a-list-item", nested)]
        else:
            text = page.text(item) or ""
            parts = [clean(re.sub(r"^.*?Best Sellers Rank\s*:?", "", text))]
        if any(parts):
            return " | ".join(x for x in parts if x)
    for row in page.all(".a-keyvalue.a-vertical-stripes.a-span6 tr"):
        if "Rank" in (page.text(page.first("th", row)) or ""):
            parts = [x for e in page.all("td span", row) if (x := page.text(e))]
            if parts:
                return " | ".join(parts)
    return clean(bullets.get("best sellers rank")) or None


def read_shop_page(html: str | None) -> dict:
    """The values of ``SHOP_FIELDS`` of a product page."""
    page = Outline(html or "")
    bullets, items = _bullets(page), page.all("ul.detail-bullet-list li")
    out: dict[str, object] = {"title": page.text(page.first("#productTitle")), "author": page.text(page.first(".author .a-link-normal"))}
    stars = page.first(".reviewCountTextLinkedHistogram")
    out["rating"] = _number((stars.get("title") or "").split(" ")[0] or None, float) if stars else None
    out["rating_count"] = _digits(page.text(page.first("#acrCustomerReviewText")))

    out["series"] = page.text(page.first("#rpi-icon-link-book_details-series"))
    place = page.text(page.first("#rpi-attribute-book_details-series .rpi-attribute-label span"))
    for item in [] if place and re.match(r"Book\s+[0-9]+\s+of\s+[0-9]+", place, re.I) else page.all("#detailBullets_feature_div ul.detail-bullet-list li"):
        bold = page.text(page.first(".a-text-bold", item)) or ""
        if "Book" in bold and "of" in bold:
            place = bold
            out["series"] = _first(out["series"], page.text(page.first("a.a-link-normal span", item)))
            break
    out["number"] = _found(r"^Book\s+([0-9]+)\s+of\s+([0-9]+)", place)
    out["total_books"] = _found(r"^Book\s+([0-9]+)\s+of\s+([0-9]+)", place, 2)

    base = "#reviewFeatureGroup .a-section.gr-review-base"
    out["catalogue_rating"] = _number(_found(r"([0-9]+(?:\.[0-9]+)?)", page.text(page.first(f"{base} .gr-review-rating-text"))), float)
    out["catalogue_rating_count"] = _digits(page.text(page.first(f"{base} .gr-review-count-text")))

    in_list = next((n for x in items if (t := page.text(x)) and ("Print length" in t or "pages" in t.lower()) and (n := _found(r"([0-9]+)\s*pages", t))), None)
    out["pages"] = _number(
        _first(
            _found(r"([0-9]+)", page.text(page.first("#rpi-attribute-book_details-ebook_pages .rpi-attribute-value span"))),
            _found(r"([0-9]+)", page.text(page.first("#detail_bullets-book_details-ebook_pages span"))),
            in_list,
            _found(r"([0-9]+)", _first(bullets.get("print length"), bullets.get("pages"))),
        ),
        int,
    )
    publisher = None
    for item in page.all("ul.detail-bullet-list li span.a-list-item"):
        spans = page.all("span", item)
        if len(spans) >= 2 and "Publisher" in (page.text(spans[0]) or ""):
            publisher = page.text(spans[1])
            break
    for row in page.all(".a-keyvalue.a-spacing-base tr") if publisher is None else ():
        if "Publisher" in (page.text(page.first("th", row)) or "") and (cell := page.first("td", row)) is not None:
            publisher = page.text(cell)
            break
    out["publisher"] = _without_notes(_first(publisher, bullets.get("publisher")))
    dated = next((page.text(x) for x in items if re.search("Publication date|Release date", page.text(page.first(".a-text-bold", x)) or "")), None)
    day = _DATE.search(_first(dated, bullets.get("publication date"), bullets.get("release date"), ""))
    out["published"] = day.group(0) if day else None
    out["best_rank"] = _best_rank(page, page.all("#detailBullets_feature_div ul.detail-bullet-list li"), bullets)
    about = page.raw_text(page.first('div[data-feature-name="bookDescription"] .a-expander-content'))
    out["synopsis"] = next((line.strip()[:300] for line in about.split("\n") if line.strip()), None)
    return out


def _reader(read, fields: str, *more):
    names = [x.split()[0] for x in fields.split(", ")]

    @F.pandas_udf(fields)
    def fields_of(pages: pd.Series) -> pd.DataFrame:
        rows = [read(x if isinstance(x, str) else None, *more) for x in pages]
        return pd.DataFrame({name: pd.Series([r.get(name) for r in rows], dtype=object) for name in names})

    return fields_of


def book_fields(c: Column | str, site: str = "") -> Column:
    """STRUCT of ``BOOK_FIELDS`` of a stored catalogue page."""
    return _reader(read_book_page, BOOK_FIELDS, site)(col(c))


def product_fields(c: Column | str) -> Column:
    """STRUCT of ``SHOP_FIELDS`` of a stored product page."""
    return _reader(read_shop_page, SHOP_FIELDS)(col(c))
