"""Column functions on literal examples."""

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import contacts, jsontext, keys, ladders, nulls, similarity, text, titles, urls
from shelfmark.operators.joins import commercial_band


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "title, core, fuzzy, series, number",
    [
        ("Pucking Around (Jacksonville Rays, #1)", "Pucking Around", "puckingaround", "Jacksonville Rays", "1"),
        ("Pucking Around (Jacksonville Rays, Book 1)", "Pucking Around", "puckingaround", "Jacksonville Rays", "1"),
        ("PUCKING AROUND (Jacksonville Rays #1)", "PUCKING AROUND", "puckingaround", "Jacksonville Rays", "1"),
        ("Pucking Around: Jacksonville Rays - Book #1", "Pucking Around", "puckingaroundjacksonvilleraysbook1", None, None),
        ("The Deal: A Hockey Romance", "The Deal", "thedealahockeyromance", None, None),
        ("Café (The Élan Saga)", "Cafe", "cafe", "The Elan Saga", None),
        ("Title – Book 2.5", "Title", "title", None, "2.5"),
    ],
)
def test_normalize_title(spark, title, core, fuzzy, series, number):
    n = one(spark, titles.normalize_title(F.lit(title)))
    assert (n["core_title"], n["fuzzy"], n["series_name"], n["book_number"]) == (core, fuzzy, series, number)


def test_missing_title(spark):
    n = one(spark, titles.normalize_title(F.lit("nan")))
    assert n["standard"] == "" and n["series_name"] is None


@pytest.mark.parametrize(
    "value, standard, fuzzy",
    [("by Zoë Smith, Jr.", "Zoe Smith", "zoesmith"), ("A. B.  Writer PhD", "A. B. Writer", "abwriter"), (None, "", "")],
)
def test_author_key(spark, value, standard, fuzzy):
    c = F.lit(value).cast("string")
    assert one(spark, keys.author_key(c)) == standard
    assert one(spark, keys.author_key(c, "fuzzy")) == fuzzy


@pytest.mark.parametrize(
    "value, mode, want",
    [("1,234", "commas", 1234.0), ("1.2k", "suffix", 1200.0), ("3m", "suffix", 3e6), ("abc", "strict", None), ("nan", "strict", None), ("1d", "strict", None), ("12 pages", "digits", 12.0), (" 4.5 ", "strict", 4.5)],
)
def test_to_number(spark, value, mode, want):
    assert one(spark, nulls.to_number(F.lit(value), mode)) == want


def test_book_numbers(spark):
    assert [one(spark, nulls.clean_book_number(F.lit(v))) for v in ("1.0", "1.5", "one", "nan")] == ["1", "1.5", "one", None]


def test_title_case(spark):
    assert one(spark, keys.title_case(F.lit("off-campus o'neil"))) == "Off-Campus O'Neil"
    assert one(spark, keys.clean_title(F.lit("The Deal (Off-Campus"))) == "The Deal"


def test_slug(spark):
    assert one(spark, keys.slug(F.lit("Romantic Suspense/Psychological Thriller"))) == "romantic_suspense_and_psychological_thriller"
    assert one(spark, keys.slug(F.lit("Dark & Forbidden Romance"))) == "dark_and_forbidden_romance"


def test_emails(spark):
    valid = {"jane@janedoe.com": True, "logo@2x.png": False, "noreply@site.com": False, "user@domain.com": False, "a@b": False}
    for address, want in valid.items():
        assert one(spark, contacts.valid_email(F.lit(address))) is want
    assert one(spark, contacts.looks_fabricated(F.lit("janeauthor@gmail.com"))) is True
    assert one(spark, contacts.is_publicity(F.lit("press@x.com"))) is True
    assert one(spark, contacts.emails_in(F.lit("write to a.b@c.net, or a.b@c.net; not x@y.png"))) == ["a.b@c.net"]


def test_checked_evidence(spark):
    def check(status, series, author):
        r = one(spark, contacts.checked_evidence(F.lit(status), F.lit(series), F.lit(author), ["audio.com"]))
        return r["status"], r["url"]

    assert check("yes_series_level", "https://audio.com/a", "") == ("yes_series_level", "https://audio.com/a")
    assert check("yes_series_level", "https://x.com/a", "https://www.audio.com/b") == ("yes_author_level", "https://www.audio.com/b")
    assert check("yes_author_level", "https://x.com", "https://y.com") == ("no", None)


def test_bands(spark):
    want = {(25000, 85): 1, (25000, 45): 2, (6000, 50): 6, (3000, 45): 9, (3000, 10): 10, (25000, 10): 10}
    for (ratings, hours), tier in want.items():
        band = one(spark, commercial_band(F.lit(ratings), F.lit(hours)))
        assert band["tier"] == tier
    assert one(spark, commercial_band(F.lit(3000), F.lit(45)))["fee"] == "Up to $1,000"


def test_retention(spark):
    def r(last, first):
        row = one(spark, ladders.retention(F.lit(last), F.lit(first)))
        return row["ratio"], row["quality"]

    assert r(8000, 20000) == (0.4, "MODERATE")
    assert r(50, 20000) == (None, "DATA_SCALE_MISMATCH")
    assert r(0, 10) == (None, "N/A")


def test_series_types(spark):
    for rule, want in {
        "crawl": ["Standalone", "Short Series", "Short Series", "Series", "Series", "Long Series"],
        "report": ["Standalone", "Short Series", "Series", "Series", "Series", "Long Series"],
        "commissioning": ["Standalone", "Short Series", "Short Series", "Series", "Series", "Long Series"],
        "outreach": ["Standalone", "Short Series", "Short Series", "Series", "Series", "Series"],
    }.items():
        assert [one(spark, ladders.series_type(F.lit(n), rule)) for n in range(1, 7)] == want


def test_similarity_values(spark):
    from difflib import SequenceMatcher

    def both(a, b):
        return spark.createDataFrame([(a, b)], "a string, b string").select(similarity.similarity("a", "b").alias("s"), similarity.title_similarity("a", "b").alias("t")).first()

    row = both("kitten", "sitting")
    assert row["s"] == pytest.approx((SequenceMatcher(None, "kitten", "sitting").ratio() + 1 - 3 / 7) / 2)
    assert both("The Deal Series", "the deal")["t"] == 1.0
    assert both("The Deal", "The Deal Again")["t"] == 0.9
    assert both("", "x")["s"] == 0.0


def test_lenient_json(spark):
    from pyspark.sql import types as T

    row = T.StructType([T.StructField("a", T.LongType())])
    cases = {
        '```json\n[{"a": 1,}, {"a": 2}]\n```': [1, 2],
        'Sure! [{"a": 3}] done': [3],
        '{"a": 4}': [4],
        'broken {"a": 5} and {"a": 6} {oops': [5, 6],
    }
    for value, want in cases.items():
        assert [r["a"] for r in one(spark, jsontext.lenient_rows(F.lit(value), row))] == want


def test_urls(spark):
    assert one(spark, urls.host(F.lit("https://www.Site.com:80/x"))) == "site.com:80"
    assert one(spark, urls.catalogue_id(F.lit("https://x.com/book/show/123-abc"))) == "123"
    assert one(spark, urls.ensure_scheme(F.lit("site.com"))) == "https://site.com"
    frame = spark.createDataFrame([("https://x.com/book/show/1-the-deal", "The Deal"), ("https://x.com/book/show/2-summary-of-the-deal", "The Deal")], "u string, t string")
    assert [r["m"] for r in frame.select(urls.slug_matches("u", "t").alias("m")).collect()] == [True, False]


def test_text_helpers(spark):
    assert one(spark, text.short_synopsis(F.lit("One. Two! Three?"))) == "One. Two!"
    assert one(spark, text.main_trope(F.lit("She hated her rival, a hockey player on the team"))) == "Enemies to Lovers"
    assert one(spark, text.headline_fee(F.lit("$12,500 - $17,500"))) == "$17,500"
    assert one(spark, text.salutation(F.lit("Dr Who"))) == "Author"
    assert one(spark, text.has_placeholder(F.lit("Dear {name}"))) is True
    assert one(spark, text.agent_from_text(F.lit("She is represented by Ann Lee at Big Agency."))) == "Ann Lee"
    assert one(spark, text.rationale(F.lit("P0"), F.lit(4.3), F.lit(12500), F.lit(5), F.lit("After 2020"), F.lit(None).cast("string"))) == "P0: 4.3* (12.5k ratings), 5 books, After 2020"


def test_category_rank(spark):
    from shelfmark.operators.rollup import category_rank

    best = one(spark, category_rank(F.lit("#1,250 in Kindle Store | #12 in Sports Romance | #7 in Hockey & More | #3 in Cooking")))
    assert (best["rank"], best["category"]) == (7, "Hockey & More")


def test_list_item_single_line(spark):
    item = one(spark, titles.list_item(F.lit("#3Reminders of Him: A NovelColleen Hoover4.7 out of 5 stars 12")))
    assert (item["rank"], item["title"], item["author"]) == (3, "Reminders of Him: A Novel", "Colleen Hoover")


def test_payload_in_the_documented_shape(spark):
    keys = {"represented": "represented_by_agency", "check_status": "imprint_check", "check_url": "imprint_url", "check_note": "imprint_note", "author_check_url": "author_level_url"}
    text = """```json
{"author_name": "Ann Writer", "represented_by_agency": true, "representation_evidence_url": "https://a.example.com",
 "qualifying_series": [{"series_name": "Iron", "goodreads_series_url": "https://g.example.com/1", "primary_works": 5, "total_books": 7,
  "threshold_flag": "", "first_book_title": "One", "first_book_goodreads_rating": 4.1, "first_book_goodreads_rating_count": 1200,
  "genre_bucket": "sports", "lead_pairing": "x", "sub_genre": "y", "primary_trope": "z", "imprint_check": "YES_AUTHOR_LEVEL",
  "imprint_url": "https://i.example.com", "imprint_note": "n"}, {"series_name": "Short", "primary_works": 4}],
 "author_level_url": "https://l.example.com"}
```"""
    rows = spark.createDataFrame([(text,), (text.replace("true", "false"),), ("nothing",), (None,)], "t string")
    found = rows.select(jsontext.qualifying_series(jsontext.author_payload("t", F.lit("given"), keys)).alias("s")).collect()
    assert [len(r.s) if r.s is not None else None for r in found] == [1, None, None, None]
    one = found[0].s[0]
    assert (one.series_name, one.primary_works, one.total_books, one.threshold_flag, one.first_book_rating, one.first_book_rating_count) == ("Iron", 5, 7, "eq5_included", 4.1, 1200)
    assert (one.genre, one.lead_pairing, one.sub_genre, one.primary_trope, one.check_status) == ("sports", "x", "y", "z", "yes_author_level")
    assert (one.check_url, one.check_note, one.author_check_url, one.series_url) == ("https://i.example.com", "n", "https://l.example.com", "https://g.example.com/1")


def test_subtitles_after_dashes(spark):
    rows = spark.createDataFrame([("The Deal \u2013 A Romance",), ("Deal\u2014Two",), ("A \u2014 B: C",), ("Plain",), (None,)], "t string")
    found = rows.select(titles.main_title("t").alias("m"), titles.subtitle("t").alias("s")).collect()
    assert [tuple(r) for r in found] == [("The Deal", "A Romance"), ("Deal", "Two"), ("A \u2014 B", "C"), ("Plain", None), (None, None)]


def test_every_imprint_has_an_alias(spark):
    assert spark.range(1).select(text.imprint_of(F.lit("Editions Theleme"))).first()[0] == "Editions Theleme"
    assert spark.range(1).select(text.imprint_of(F.lit("RBmedia Verlag GmbH"))).first()[0] == "RBmedia Verlag"


def test_personal_addresses(spark):
    rows = spark.createDataFrame([("ann.writer@x.net", "Ann Writer"), ("info@x.net", "Ann Writer"), ("infowriter@x.net", "Ann Writer"), ("zed@x.net", "Ann Writer")], "e string, a string")
    assert [r[0] for r in rows.select(contacts.is_personal("e", "a")).collect()] == [True, False, True, True]


def test_same_author(spark):
    rows = spark.createDataFrame([("Ann B. Writer", "ann b writer"), ("Ann Writer", "Anne Writer"), ("Ann Writer", "Bob Author"), ("", ""), (None, "Ann")], "a string, b string")
    assert [bool(r[0]) for r in rows.select(similarity.same_author("a", "b")).collect()] == [True, True, False, False, False]


def test_master_sort(spark):
    from shelfmark.operators.ranking import master_sort

    rows = spark.createDataFrame([("b", 1.0, "x"), (None, 1.0, "a"), ("a", 2.0, "x"), ("a", None, "x"), ("a", 2.0, None), ("a", 1.0, "z")], "s string, n double, t string")
    want = [("a", 1.0, "z"), ("a", 2.0, "x"), ("a", 2.0, None), ("a", None, "x"), ("b", 1.0, "x"), (None, 1.0, "a")]
    assert [tuple(r) for r in master_sort(rows, "s", "n", "t").collect()] == want


def test_values_trimmed_once_equal_present(spark):
    texts = ["", " ", "x", " x", "x ", "　", "nan", " NULL ", "None.", "none", "nat\t", "é", "a b", "nulls", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", nulls.present("t").alias("a"), nulls.present_once("t").alias("b"), nulls.trim_space("t").alias("c"), nulls.trimmed(F.col("t")).alias("d")).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r["a"], r["c"]) == (r["b"], r["d"]), r
