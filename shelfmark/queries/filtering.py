"""Queries: row filters with their reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.config import vocab
from shelfmark.functions import titles as TT
from shelfmark.functions.nulls import all_missing, any_missing
from shelfmark.operators import filters as FL
from shelfmark.operators import groups, joins
from shelfmark.queries.registry import Tables, query
from shelfmark.queries.views import (
    BOOKS, TITLED, books, sql_any, sql_first, sql_quote, sql_term, sql_word, titled_parts,
)

_CONTEXT = "[" + ", ".join(f"CASE WHEN {sql_term('x', w, 4)} THEN {sql_quote(w)} END" for w in vocab.CONTEXT_DENY) + "]"


@query(
    "keyword_filter",
    f"""WITH d AS (SELECT doc_id, lower(text || ' ' || source) AS x FROM documents),
r AS (SELECT doc_id, {sql_first('x', vocab.NON_FICTION_DENY, 'non-romance: ')} AS r1, {sql_any('x', vocab.ALLOW_EXCEPTIONS)} AS ok,
 {sql_first('x', vocab.HARD_DENY, 'fantasy: ', 4)} AS r2, list_filter({_CONTEXT}, lambda w: w IS NOT NULL) AS c FROM d)
SELECT doc_id, coalesce(r1, CASE WHEN NOT ok THEN coalesce(r2, CASE WHEN len(c) >= 2 THEN 'fantasy-context: ' || array_to_string(c, ', ') END) END) AS reject_reason FROM r""",
)
def keyword_filter(t: Tables) -> DataFrame:
    return FL.with_reason(t.documents, FL.keyword_reason("text", "source")).select("doc_id", FL.REASON)


@query(
    "keyword_filter_counts",
    f"""WITH d AS (SELECT lower(text) AS x FROM documents), r AS (SELECT {sql_first('x', vocab.DISCOVERY_DENY, 'excluded: ')} AS reject_reason FROM d)
SELECT coalesce(reject_reason, 'kept') AS outcome, count(*) AS n FROM r GROUP BY 1""",
)
def keyword_filter_counts(t: Tables) -> DataFrame:
    reason = FL.simple_keyword_reason("text", deny=vocab.DISCOVERY_DENY)
    kept, removed = FL.split(t.documents, reason)
    every = kept.select(F.lit("kept").alias("outcome")).union(removed.select(F.col(FL.REASON).alias("outcome")))
    return every.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


_NOT_FICTION = "(" + " OR ".join(sql_word("x", w) for w in vocab.TOPIC_NON_FICTION) + ")"


@query(
    "topic_filter",
    f"""WITH d AS (SELECT doc_id, lower(' ' || source || ' ' || text) AS x FROM documents)
SELECT doc_id, CASE WHEN {_NOT_FICTION} THEN 'non-fiction' WHEN NOT {sql_any('x', vocab.TOPIC_WORDS)} THEN 'off-topic'
 WHEN length(x) > 150 AND NOT {sql_any('x', vocab.DRAMA_WORDS)} AND NOT {sql_any('x', vocab.DRAMA_FALLBACK)} THEN 'no-drama' END AS reject_reason FROM d""",
)
def topic_filter(t: Tables) -> DataFrame:
    return FL.with_reason(t.documents, FL.topic_reason("source", "text")).select("doc_id", FL.REASON)


@query(
    "ban_filter",
    f"""WITH d AS (SELECT doc_id, lower(text) AS x, CASE lang WHEN 'fr' THEN 'Sports Fantasy' WHEN 'de' THEN 'Dark Fantasy' ELSE 'Drama' END AS g FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(x, '[一-鿿]') THEN 'script' WHEN {sql_any('x', vocab.BAN_TITLES)} THEN 'title'
 WHEN {sql_any('lower(g)', vocab.BAN_GENRES)} AND NOT {sql_any('lower(g)', vocab.BAN_GENRE_EXEMPT)} THEN 'genre' END AS reject_reason FROM d""",
)
def ban_filter(t: Tables) -> DataFrame:
    genre = F.when(F.col("lang") == "fr", F.lit("Sports Fantasy")).when(F.col("lang") == "de", F.lit("Dark Fantasy")).otherwise(F.lit("Drama"))
    return FL.with_reason(t.documents, FL.ban_reason(genre, F.lit(""), "text")).select("doc_id", FL.REASON)


@query(
    "english_filter",
    f"""WITH d AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN text || ' (French Edition)' WHEN lang = 'de' AND source <> 'src1' THEN text || ' Ausgabe'
 WHEN lang = 'es' THEN text || ' Издание' ELSE text END AS x FROM documents)
SELECT doc_id, CASE WHEN {sql_any('lower(x)', vocab.EDITION_PHRASES)} THEN 'foreign edition'
 WHEN regexp_matches(x, '[\\x{{4e00}}-\\x{{9fff}}\\x{{3040}}-\\x{{309f}}\\x{{30a0}}-\\x{{30ff}}\\x{{ac00}}-\\x{{d7af}}\\x{{0600}}-\\x{{06ff}}\\x{{0400}}-\\x{{04ff}}]') THEN 'foreign script' END AS reject_reason FROM d""",
)
def english_filter(t: Tables) -> DataFrame:
    title = (
        F.when(F.col("lang") == "fr", F.concat("text", F.lit(" (French Edition)")))
        .when((F.col("lang") == "de") & (F.col("source") != "src1"), F.concat("text", F.lit(" Ausgabe")))
        .when(F.col("lang") == "es", F.concat("text", F.lit(" Издание")))
        .otherwise(F.col("text"))
    )
    return FL.with_reason(t.documents, FL.english_reason(title)).select("doc_id", FL.REASON)


@query(
    "junk_filter",
    f"""WITH d AS (SELECT p_partkey, p_name || CASE p_type WHEN 'SMALL' THEN ' Navigation Rules' ELSE '' END AS t,
 CASE p_type WHEN 'PROMO' THEN 'Copyright Office' WHEN 'LARGE' THEN 'Book ' || p_size || ' of 50' WHEN 'ECONOMY' THEN ' Lewis Carroll ' ELSE p_brand END AS a FROM part)
SELECT p_partkey, CASE WHEN {sql_any('lower(a)', vocab.JUNK_AUTHORS)} THEN 'junk author' WHEN {sql_any('lower(t)', vocab.JUNK_TITLES)} THEN 'junk title'
 WHEN regexp_matches(lower(a), 'kindle edition|^book [0-9]+ of [0-9]+') THEN 'not an author' WHEN trim(lower(a)) = 'lewis carroll' THEN 'wrong genre' END AS reject_reason FROM d""",
)
def junk_filter(t: Tables) -> DataFrame:
    title = F.concat("p_name", F.when(F.col("p_type") == "SMALL", F.lit(" Navigation Rules")).otherwise(F.lit("")))
    author = (
        F.when(F.col("p_type") == "PROMO", F.lit("Copyright Office"))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("Book "), F.col("p_size"), F.lit(" of 50")))
        .when(F.col("p_type") == "ECONOMY", F.lit(" Lewis Carroll "))
        .otherwise(F.col("p_brand"))
    )
    return FL.with_reason(t.part, FL.junk_reason(title, author)).select("p_partkey", FL.REASON)


@query(
    "basic_quality",
    """WITH d AS (SELECT event_id, CASE WHEN value < 3 THEN ' ' WHEN value < 6 THEN 'ab' ELSE event_type END AS t, CASE WHEN value > 30 THEN 'nan' WHEN value > 20 THEN upper(event_type) ELSE 'user ' || user_id END AS a FROM events)
SELECT event_id, CASE WHEN trim(t) = '' THEN 'no title' WHEN a = 'nan' THEN 'no author' WHEN lower(t) = lower(a) THEN 'title is author' WHEN length(t) < 3 THEN 'short title' END AS reject_reason FROM d""",
)
def basic_quality(t: Tables) -> DataFrame:
    title = F.when(F.col("value") < 3, F.lit(" ")).when(F.col("value") < 6, F.lit("ab")).otherwise(F.col("event_type"))
    author = (
        F.when(F.col("value") > 30, F.lit("nan"))
        .when(F.col("value") > 20, F.upper("event_type"))
        .otherwise(F.concat(F.lit("user "), F.col("user_id")))
    )
    rows = t.events.select("event_id", title.alias("t"), author.alias("a"))
    return FL.with_reason(rows, FL.quality_reason("t", "a")).select("event_id", FL.REASON)


_STATES = """s AS (SELECT o.o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE n END AS books, CASE WHEN o_orderpriority LIKE '1%' THEN n END AS verified_books,
 CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Yes' WHEN '2' THEN 'Likely' WHEN '3' THEN 'No' WHEN '4' THEN 'Skipped' ELSE '' END AS verified,
 CASE WHEN n > 5 THEN 'title_pattern: 1' WHEN n = 4 THEN 'Box set' ELSE '' END AS method, rating, CASE WHEN n > 2 THEN 'Book' END AS first_book,
 CASE o_orderstatus WHEN 'F' THEN 'Traditional' WHEN 'O' THEN 'Indie author' ELSE '' END AS flag, CASE WHEN n > 4 THEN 'KDP' ELSE 'Oak' END AS publisher
 FROM orders o JOIN (SELECT series_id, count(*) AS n, min(rating) AS rating FROM books GROUP BY 1) b ON o.o_orderkey = b.series_id),
k AS (SELECT *, nullif(greatest(coalesce(books, 0), coalesce(verified_books, 0)), 0) AS best FROM s)"""


@query(
    "length_filters",
    f"""WITH {BOOKS}, {_STATES}
SELECT o_orderkey,
 CASE WHEN best >= 3 THEN true WHEN best IS NOT NULL THEN false ELSE verified IN ('Yes', 'Likely') OR contains(method, 'title_pattern') OR contains(lower(method), 'box') END AS long_enough,
 CASE WHEN coalesce(best, 0) >= 3 THEN true WHEN verified = 'Yes' AND best IS NULL THEN true WHEN verified = 'Likely' AND coalesce(best, 0) <> 1 THEN true
  WHEN (contains(lower(method), 'box') OR contains(method, 'title_pattern')) AND (best IS NULL OR best >= 2) THEN true
  WHEN verified = 'Skipped' AND (rating IS NOT NULL OR first_book IS NOT NULL) THEN true WHEN verified = 'No' THEN false WHEN best IN (1, 2) THEN false ELSE rating IS NOT NULL END AS viable,
 CASE WHEN books IS NOT NULL THEN books >= 3 ELSE rating IS NOT NULL OR first_book IS NOT NULL END AS length_or_signal,
 CASE WHEN flag = 'Traditional' THEN false WHEN flag = 'Indie author' THEN true WHEN publisher = 'KDP' THEN true ELSE flag = '' END AS independent,
 verified <> 'Yes' AND coalesce(books, 0) < 3 AS needs_verification FROM k""",
)
def length_filters(t: Tables) -> DataFrame:
    per = books(t).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.min("rating").alias("rating"))
    o = t.orders.join(per, F.col("o_orderkey") == F.col("series_id"))
    first = F.substring("o_orderpriority", 1, 1)
    s = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("n")).alias("books"),
        F.when(first == "1", F.col("n")).alias("verified_books"),
        F.when(first == "1", F.lit("Yes")).when(first == "2", F.lit("Likely")).when(first == "3", F.lit("No")).when(first == "4", F.lit("Skipped")).otherwise(F.lit("")).alias("verified"),
        F.when(F.col("n") > 5, F.lit("title_pattern: 1")).when(F.col("n") == 4, F.lit("Box set")).otherwise(F.lit("")).alias("method"),
        "rating",
        F.when(F.col("n") > 2, F.lit("Book")).alias("first_book"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Traditional")).when(F.col("o_orderstatus") == "O", F.lit("Indie author")).otherwise(F.lit("")).alias("flag"),
        F.when(F.col("n") > 4, F.lit("KDP")).otherwise(F.lit("Oak")).alias("publisher"),
    )
    return s.select(
        "o_orderkey",
        FL.long_enough("books", "verified_books", "verified", "method").alias("long_enough"),
        FL.viable_series("books", "verified_books", "verified", "method", "rating", "first_book").alias("viable"),
        FL.length_or_signal("books", "rating", "first_book").alias("length_or_signal"),
        FL.independent_only("flag", "publisher").alias("independent"),
        FL.needs_verification("books", "verified").alias("needs_verification"),
    )


@query(
    "title_patterns",
    f"""WITH {TITLED}
SELECT p_partkey, regexp_matches(lower(title), '\\bbox set\\b|\\bcollection\\b|\\bbooks?\\s+[0-9]+(-[0-9]+)?\\b|\\bvol(ume)?\\.?\\b|\\bomnibus\\b') AS is_collection,
 CASE WHEN regexp_matches(title, '(?i)\\bbook\\s*#?\\s*([0-9]+|one|two|three|four|five|six|seven|eight|nine|ten)\\b') THEN 'title_pattern: 1' WHEN regexp_matches(title, '#\\s*([0-9]+)') THEN 'title_pattern: 2'
  WHEN regexp_matches(title, '(?i)\\b(trilogy|duology|saga|quartet|quintet)\\b') THEN 'title_pattern: 5' WHEN regexp_matches(title, '(?i)\\bbox\\s*(ed)?\\s*set\\b') THEN 'title_pattern: 6'
  WHEN regexp_matches(title, '(?i):\\s*a\\s+\\w+\\s+(novel|romance|story)\\s*$') THEN 'title_pattern: 11' END AS series_pattern,
 regexp_matches(title, '(?i)\\bbox\\s*(ed)?\\s*set\\b') AS box_set FROM titled""",
)
def title_patterns(t: Tables) -> DataFrame:
    return titled_parts(t).select(
        "p_partkey",
        FL.is_collection("title").alias("is_collection"),
        TT.series_pattern("title").alias("series_pattern"),
        TT.is_box_set("title").alias("box_set"),
    )


@query(
    "main_entries",
    """WITH n AS (SELECT *, CASE l_returnflag WHEN 'A' THEN CAST(l_linenumber AS VARCHAR) WHEN 'N' THEN (l_linenumber - 1) || '.5' ELSE CASE l_linestatus WHEN 'F' THEN l_linenumber || '-' || (l_linenumber + 1) ELSE CAST(l_linenumber - 1 AS VARCHAR) END END AS number FROM lineitem)
SELECT l_orderkey, count(*) AS n, count(*) FILTER (number <> '0' AND NOT number LIKE '0.%' AND NOT number LIKE '%.5%' AND NOT number LIKE '%-%') AS main FROM n GROUP BY 1""",
)
def main_entries(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    number = (
        F.when(F.col("l_returnflag") == "A", line.cast("string"))
        .when(F.col("l_returnflag") == "N", F.concat((line - 1).cast("string"), F.lit(".5")))
        .when(F.col("l_linestatus") == "F", F.concat(line.cast("string"), F.lit("-"), (line + 1).cast("string")))
        .otherwise((line - 1).cast("string"))
    )
    return t.lineitem.select("l_orderkey", number.alias("number")).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(FL.is_main_entry("number"), F.lit(1))).alias("main")
    )


@query(
    "validated_series",
    f"""WITH {BOOKS}, s AS (SELECT 'Order ' || (series_id // 3) AS series_name, o_custkey, 'Writer ' || o_custkey AS author_name, series_id, count(*) AS num_books, min(rating) AS lo, max(rating) AS hi,
 min(publisher) AS publisher, any_value(o_orderstatus) AS st, any_value(o_orderpriority) AS genres FROM books JOIN orders ON series_id = o_orderkey GROUP BY ALL),
c AS (SELECT series_id, series_name, author_name, num_books, lower(series_name) AS s, lower(series_name) || '|||' || lower(author_name) AS sa FROM s
 WHERE st <> 'P' AND num_books >= 3 AND publisher <> 'Penguin Random House' AND (hi IS NULL OR hi >= 3.0)),
e AS (SELECT 'order ' || o_custkey AS key FROM orders WHERE o_totalprice > 450000 UNION SELECT 'order ' || o_orderkey || '|||writer ' || o_custkey FROM orders WHERE o_totalprice < 20000)
SELECT series_id, series_name, author_name, num_books FROM (SELECT *, row_number() OVER (PARTITION BY sa ORDER BY series_id) AS rn FROM c WHERE s NOT IN (SELECT key FROM e) AND sa NOT IN (SELECT key FROM e)) WHERE rn = 1""",
)
def validated_series(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    s = (
        books(t)
        .groupBy("series_id")
        .agg(F.count(F.lit(1)).alias("num_books"), F.min("rating").alias("lo"), F.max("rating").alias("hi"), F.min("publisher").alias("p"))
        .join(orders, F.col("series_id") == F.col("o_orderkey"))
        .select(
            "series_id",
            F.concat(F.lit("Order "), F.floor(F.col("series_id") / 3).cast("string")).alias("series_name"),
            F.concat(F.lit("Writer "), F.col("o_custkey")).alias("author_name"),
            "num_books",
            F.col("o_orderpriority").alias("genres"),
            F.lit("").alias("description"),
            F.when(F.col("p") == "Penguin Random House", F.lit("Big Pub")).otherwise(F.lit("Indie")).alias("self_pub_flag"),
            (F.col("o_orderstatus") != "P").alias("validated"),
            F.array_compact(F.array("lo", "hi")).alias("ratings"),
        )
    )
    one = orders.filter("o_totalprice > 450000").select(F.concat(F.lit("order "), F.col("o_custkey")).alias("key"))
    two = orders.filter("o_totalprice < 20000").select(
        F.concat(F.lit("order "), F.col("o_orderkey"), F.lit("|||writer "), F.col("o_custkey")).alias("key")
    )
    return FL.validated_series(s, one.union(two), [F.col("series_id")]).select("series_id", "series_name", "author_name", "num_books")


@query(
    "gap_selectors",
    f"""WITH {BOOKS} SELECT series_id, book_id, book_number, rating IS NULL OR pages IS NULL AS any_gap, rating IS NULL AND pages IS NULL AS all_gap FROM books""",
)
def gap_selectors(t: Tables) -> DataFrame:
    gaps = ["rating", "pages"]
    return books(t).select("series_id", "book_id", "book_number", any_missing(gaps).alias("any_gap"), all_missing(gaps).alias("all_gap"))


@query(
    "needs_work",
    """SELECT page_id, NOT contains(lower(url), 'example.com') OR contains(lower(url), '/fr/') OR length(html) > 4000 OR page_id % 10 = 0 AS todo FROM pages""",
)
def needs_work(t: Tables) -> DataFrame:
    link = F.when(F.col("url").contains("/fr/"), F.concat(F.col("url"), F.lit("/s?k=1"))).otherwise(F.col("url"))
    rows = t.pages.select("page_id", "html", link.alias("link"), F.pmod("page_id", F.lit(10)).alias("rating"))
    return rows.select("page_id", FL.needs_work(zero=["rating"], links={"link": "example.com"}, long_text={"html": 4000}).alias("todo"))


@query(
    "verdict_filter",
    """SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR (l.toxic = 0 AND l.quality = 1)""",
)
def verdict_filter(t: Tables) -> DataFrame:
    keep = (F.col("toxic") == 0) & (F.col("quality") == 1)
    return FL.verdict_filter(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"], keep)


@query(
    "minority_authors",
    """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
m AS (SELECT user_id, event_type AS main, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM c) WHERE rn = 1)
SELECT event_id, user_id, event_type FROM events JOIN m USING (user_id) WHERE NOT (m.n >= 20 AND event_type <> main)""",
)
def minority_authors(t: Tables) -> DataFrame:
    return groups.drop_minority(t.events.select("event_id", "user_id", "event_type"), "user_id", "event_type", 20)


@query(
    "eligible_outreach",
    """WITH s AS (SELECT o_orderkey, o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'NEED CONTACT' WHEN 'O' THEN ' BELOW LENGTH THRESHOLD ' ELSE 'READY' END AS status,
 CASE WHEN o_orderpriority LIKE '1%' THEN 'Sent 2024' WHEN o_orderpriority LIKE '5%' THEN 'FAILED_LOOKUP' END AS mail FROM orders)
SELECT o_orderkey, trim(status) IN ('NEED CONTACT', 'BELOW LENGTH THRESHOLD') AND coalesce(mail, '') <> 'Sent 2024' AS eligible, coalesce(mail, '') <> 'FAILED_LOOKUP' AS looked_up FROM s""",
)
def eligible_outreach(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", F.lit("NEED CONTACT")).when(F.col("o_orderstatus") == "O", F.lit(" BELOW LENGTH THRESHOLD ")).otherwise(F.lit("READY"))
    first = F.substring("o_orderpriority", 1, 1)
    mail = F.when(first == "1", F.lit("Sent 2024")).when(first == "5", F.lit("FAILED_LOOKUP"))
    rows = t.orders.select("o_orderkey", status.alias("status"), mail.alias("mail"))
    return rows.select("o_orderkey", FL.eligible_outreach("status", "mail").alias("eligible"), FL.not_failed("mail").alias("looked_up"))


@query(
    "spot_check",
    f"""WITH {BOOKS}, k AS (SELECT *, series_id || '-' || CAST(book_number AS INTEGER) || '-' || book_id AS key FROM books)
SELECT * EXCLUDE (key) FROM k ORDER BY md5(key || '|7'), key LIMIT 20""",
)
def spot_check(t: Tables) -> DataFrame:
    key = F.concat_ws("-", "series_id", F.col("book_number").cast("int"), "book_id")
    return FL.spot_check(books(t), key, 20)


@query(
    "set_membership",
    """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS waiting FROM customer""",
)
def set_membership(t: Tables) -> DataFrame:
    open_orders = t.orders.filter("o_orderstatus = 'P'")
    has = joins.in_set(t.customer, open_orders, ["c_custkey"], ["o_custkey"]).select("c_custkey", F.lit(True).alias("waiting"))
    has_not = joins.not_in_set(t.customer, open_orders, ["c_custkey"], ["o_custkey"]).select("c_custkey", F.lit(False).alias("waiting"))
    return has.union(has_not)
