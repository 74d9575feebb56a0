"""Elements of pages and the fields of catalogue and shop pages."""

from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import pages
from shelfmark.functions.outline import Outline
from shelfmark.functions.pages import read_book_page, read_shop_page
from shelfmark.queries.catalogue import QUERIES


def texts(html, selector):
    page = Outline(html)
    return [page.text(x) for x in page.all(selector)]


def test_elements_are_balanced():
    assert texts("<div id=a><div>in</div> out</div> after", "#a") == ["in out"]
    assert texts("<ul><li>a<li>b<ul><li>c</li></ul>x<li>d</ul>", "li") == ["a", "bcx", "c", "d"]
    assert texts("<dl><dt>k<dd>v<dt>l<dd>w</dl>", "dd") == ["v", "w"]
    assert texts("<table><tr><th>h<td>x<td>y<tr><td>z</table>", "tr td") == ["x", "y", "z"]
    assert texts("<p>one<p>two<div>three</div>", "p") == ["one", "two"]
    assert texts("<b>a<br>b<img src='>'>c</b></b></i>d", "b") == ["abc"]
    assert texts("<div>never <span>closed", "div") == ["never closed"]
    assert texts("<div>x<script>var a='<div>';</script><!-- <div> -->y</div>", "div") == ["xy"]
    assert texts("", "div") == [] and texts("a < b & c", "div") == []


def test_selectors():
    html = '<div class="a b" data-testid="book details"><p><a href="/series/1" class="x">s</a></p><a href="/b">t</a></div><a class=x>u</a>'
    assert texts(html, ".a a") == ["s", "t"]
    assert texts(html, "div.b.a p a") == ["s"]
    assert texts(html, 'a[href*="/series/"], a.x') == ["s", "u"]
    assert texts(html, '[data-testid="book details"] .x') == ["s"]
    assert texts(html, ".c a") == [] and texts(html, "p .a") == []


TREES = st.recursive(st.text(alphabet="ab c&<", max_size=4).map(lambda t: t.replace("&", "&amp;").replace("<", "&lt;")), lambda x: st.lists(x, max_size=4).map(lambda y: f"<div>{''.join(y)}</div>"), max_leaves=12)


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.open, self.found = [], []

    def handle_starttag(self, tag, attrs):
        self.found.append([])
        self.open.append(self.found[-1])

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        for x in self.open:
            x.append(data)


@settings(max_examples=150, deadline=None)
@given(TREES)
def test_nested_texts_equal_the_library(html):
    want = Plain()
    want.feed(html)
    want.close()
    page = Outline(html)
    assert [page.raw_text(x) for x in page.all("div")] == ["".join(x) for x in want.found]


BOOK = """<script type="application/ld+json">{"numberOfPages": 320, "aggregateRating": {"ratingValue": 4.2, "ratingCount": 77}}</script>
<h3 aria-label="Book Series"><a href="/series/1">Rays #1.5</a></h3><p data-testid="publicationInfo">First published May 3, 2021 by House</p>
<div class="BookDetails"><div class="DescListItem"><dt>Publisher</dt><dd>Big <b>House</b></dd></div><div class="DescListItem"><dt>ISBN13</dt><dd>978</dd></div>
<div class="DescListItem"><dt>ISBN</dt><dd>123</dd></div><div class="DescListItem"><dt>Setting</dt><dd>Ohio</dd></div><div class="DescListItem"><dt>Original publication date</dt><dd>1999</dd></div></div>"""


def test_book_page():
    b = read_book_page(BOOK, "https://s.example.com")
    assert (b["pages"], b["rating"], b["rating_count"], b["series"], b["number"]) == (320, 4.2, 77, "Rays #1.5", "1.5")
    assert (b["published"], b["publisher"], b["isbn"], b["settings"], b["first_published"]) == ("May 3, 2021", "Big House", "123", "Ohio", "1999")
    assert b["series_url"] == "https://s.example.com/series/1" and b["synopsis"] is None and b["genres"] == []


@pytest.mark.parametrize(
    "html,field,value",
    [
        ('<div data-testid="publicationInfo"><div>First</div> published May 3, 2021 by House</div>', "published", "May 3, 2021"),
        ('<div data-testid="publicationInfo">Published 2020</div>', "publisher", None),
        ('<p data-testid="pagesFormat">1 hour</p><div class="CollapsableList"><div class="DescListItem"><dt>Format</dt><dd>212 pages, Paper</dd></div></div>', "pages", 212),
        ('<h1 data-testid="bookTitle">T (The Ray Rules Series)</h1>', "series", "The Ray Rules Series"),
        ('<h1 data-testid="bookTitle">T (Rays, #3)</h1>', "number", "3"),
        ('<h1 data-testid="bookTitle">T (a note)</h1>', "series", None),
        ("<div data-testid=description>" + "x" * 51 + "</div>", "synopsis", "x" * 51),
        ("<div class=Formatted>" + "x" * 100 + "</div>", "synopsis", None),
        ("<div class=Formatted>" + "x" * 101 + "</div>", "synopsis", "x" * 101),
        ('<div class="Button__container--block"><a href="https://s/x">On Amazon</a></div>', "store_url", "https://s/x"),
        ('<script type="application/ld+json">[1]</script>', "title", None),
        ('<script type="application/ld+json">{"name": "B", </script>', "title", None),
        ('<script type="application/ld+json">{"author": {"name": "Ann"}}</script>', "author", "Ann"),
        ("".join(f'<div class="BookPageMetadataSection__genres"><i class="Button__labelItem">g{k}</i></div>' for k in range(7)), "genres", ["g0", "g1", "g2", "g3", "g4"]),
    ],
)
def test_book_fields(html, field, value):
    assert read_book_page(html)[field] == value


@pytest.mark.parametrize(
    "html,field,value",
    [
        ('<i class="reviewCountTextLinkedHistogram" title="4.5 out of 5 stars"></i>', "rating", 4.5),
        ('<a id="rpi-icon-link-book_details-series">Forge</a><div id="rpi-attribute-book_details-series"><i class="rpi-attribute-label"><span>Book 3 of 9</span></i></div>', "total_books", "9"),
        ('<div id="reviewFeatureGroup"><i class="a-section gr-review-base"><b class="gr-review-rating-text">4.1 on the list</b></i></div>', "catalogue_rating", 4.1),
        ('<div id="reviewFeatureGroup"><i class="a-section gr-review-base"><b class="gr-review-count-text">1,204 ratings</b></i></div>', "catalogue_rating_count", 1204),
        ('<div id="rpi-attribute-book_details-ebook_pages"><i class="rpi-attribute-value"><span>310 pages</span></i></div>', "pages", 310),
        ('<table class="a-keyvalue a-spacing-base"><tr><th>Publisher<td>Oak (2021)</table>', "publisher", "Oak"),
        ('<table class="a-keyvalue a-vertical-stripes a-span6"><tr><th>Best Rank</th><td><span>#1 in A</span><span>#2 in B</span></td></table>', "best_rank", "#1 in A | #2 in B"),
        ('<ul class="detail-bullet-list"><li><b class="a-text-bold">Release date :</b> 2021-05-03</ul>', "published", "2021-05-03"),
        ("<ul><li>Best Sellers Rank: #88 in Store (See Top 100 in Store)</ul>", "best_rank", "#88 in Store"),
        ('<div data-feature-name="bookDescription"><div class="a-expander-content">\n  first line \nsecond</div></div>', "synopsis", "first line"),
    ],
)
def test_shop_fields(html, field, value):
    assert read_shop_page(html)[field] == value


def test_columns_of_fields(spark):
    frame = spark.createDataFrame([(1, BOOK), (2, None), (3, "")], "id int, html string")
    got = {r.id: r.b for r in frame.select("id", pages.book_fields("html").alias("b")).collect()}
    assert got[1]["isbn"] == "123" and got[1]["rating_count"] == 77
    assert {k for x in (got[2], got[3]) for k, v in x.asDict().items() if v} == set()
    shop = frame.select(pages.product_fields(F.col("html")).alias("p")).filter("p.publisher IS NOT NULL").count()
    assert shop == 0


def test_structured_page_of_id_zero_has_valid_json(spark, tmp_path):
    pages = spark.createDataFrame([(0, "http://a.example.net/en/1", "<p>x</p>"), (3, "http://a.example.net/en/2", "<p>x</p>")], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    rows = QUERIES["book_pages"](spark, str(tmp_path)).orderBy("page_id").collect()
    assert [(r["title"], r["author"], r["rating"], r["rating_count"]) for r in rows] == [("Book (0)", "Ann Lee, Bo Ray", 3.0, 7), ("Book (3)", "Ann Lee, Bo Ray", 3.3, 37)]
