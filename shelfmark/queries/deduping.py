"""Queries: de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import distinct_titles
from shelfmark.operators import dedupe as D
from shelfmark.queries.registry import Tables, query
from shelfmark.queries.views import BOOKS, TITLED, books, titled_parts


@query(
    "dedup_first",
    """WITH s AS (SELECT o_orderkey, ' ' || upper(o_orderpriority) || ' ' AS series, 'Customer ' || o_custkey AS author, o_totalprice FROM orders)
SELECT o_orderkey, series, author, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(series)), lower(author) ORDER BY o_orderkey) AS rn FROM s) WHERE rn = 1""",
)
def dedup_first(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        F.concat(F.lit(" "), F.upper("o_orderpriority"), F.lit(" ")).alias("series"),
        F.concat(F.lit("Customer "), F.col("o_custkey")).alias("author"),
        "o_totalprice",
    )
    return D.dedup_first(rows, "series", "author", [F.col("o_orderkey")])


_FUZZY = """f AS (SELECT *, regexp_replace(lower(CASE WHEN p_type = 'PROMO' THEN p_name WHEN p_type = 'SMALL' THEN p_name WHEN p_type = 'LARGE' THEN p_name
 ELSE title END), '[^a-z0-9]', '', 'g') AS ft, regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') AS fa FROM titled)"""


@query(
    "dedup_normalised",
    f"""WITH {TITLED}, {_FUZZY}
SELECT p_partkey, title, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY ft, fa ORDER BY p_partkey) AS rn FROM f) WHERE rn = 1""",
)
def dedup_normalised(t: Tables) -> DataFrame:
    rows = titled_parts(t).select("p_partkey", "title", "p_brand")
    return D.dedup_normalised(rows, "title", "p_brand", [F.col("p_partkey")])


@query(
    "dedup_keep_variants",
    f"""WITH {TITLED}, {_FUZZY}, n AS (SELECT *, count(*) OVER (PARTITION BY ft, fa) AS n, row_number() OVER (PARTITION BY ft ORDER BY p_partkey DESC) AS rn FROM f)
SELECT 'none' AS keep, p_partkey, title FROM n WHERE n = 1 UNION ALL SELECT 'last', p_partkey, title FROM n WHERE rn = 1""",
)
def dedup_keep_variants(t: Tables) -> DataFrame:
    rows = titled_parts(t).select("p_partkey", "title", "p_brand")
    none = D.dedup_normalised(rows, "title", "p_brand", [F.col("p_partkey")], keep="none").select(F.lit("none").alias("keep"), "p_partkey", "title")
    last = D.dedup_normalised(rows, "title", "p_brand", [F.col("p_partkey")], keep="last", by_author=False)
    return none.union(last.select(F.lit("last").alias("keep"), "p_partkey", "title"))


@query(
    "dedup_most_complete",
    f"""WITH {BOOKS}, c AS (SELECT *, (rating IS NOT NULL)::INT + (pages IS NOT NULL)::INT AS filled FROM books)
SELECT author_id, book_id, series_id, book_number, rating, pages FROM (SELECT *, row_number() OVER (PARTITION BY author_id, title ORDER BY filled DESC, series_id, book_number) AS rn FROM c) WHERE rn = 1""",
)
def dedup_most_complete(t: Tables) -> DataFrame:
    rows = books(t).select("author_id", "title", "book_id", "series_id", "book_number", "rating", "pages")
    rows = rows.withColumn("author_name", F.concat(F.lit(" Author "), F.col("author_id"), F.lit(" Series")))
    kept = D.dedup_most_complete(rows, "author_name", "title", [F.col("series_id"), F.col("book_number")])
    return kept.select("author_id", "book_id", "series_id", "book_number", "rating", "pages")


@query(
    "dedup_penalised",
    f"""WITH {BOOKS}, c AS (SELECT *, (rating IS NOT NULL)::INT + (pages IS NOT NULL)::INT - CASE WHEN contains(lower(publisher), 'independently') THEN 10 ELSE 0 END AS points FROM books)
SELECT author_id, book_id, publisher, series_id, book_number FROM (SELECT *, row_number() OVER (PARTITION BY author_id, title ORDER BY points DESC, series_id, book_number) AS rn FROM c) WHERE rn = 1""",
)
def dedup_penalised(t: Tables) -> DataFrame:
    rows = books(t).select("author_id", "title", "book_id", "series_id", "book_number", "rating", "pages", "publisher")
    kept = D.dedup_complete_penalised(rows, "title", "author_id", "publisher", "independently", [F.col("series_id"), F.col("book_number")])
    return kept.select("author_id", "book_id", "publisher", "series_id", "book_number")


@query(
    "dedup_best_scored",
    """WITH s AS (SELECT o_orderkey, o_custkey, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN 'a@b.net' ELSE '' END AS email, CASE WHEN o_totalprice > 300000 THEN 'c@d.net' END AS agent,
 CASE o_orderstatus WHEN 'F' THEN 'Green' WHEN 'O' THEN 'yellow' END AS quality, round(o_totalprice / 5000) AS score FROM orders),
p AS (SELECT *, CASE WHEN email <> '' THEN 100.0 ELSE 0.0 END + CASE WHEN agent IS NOT NULL THEN 50.0 ELSE 0.0 END + CASE quality WHEN 'Green' THEN 30.0 WHEN 'yellow' THEN 15.0 ELSE 0.0 END + score AS points FROM s)
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(points AS DOUBLE) AS points FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY points DESC, o_orderkey) AS rn FROM p) WHERE rn = 1""",
)
def dedup_best_scored(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderpriority",
        F.when(F.col("o_orderstatus") == "P", F.lit("a@b.net")).otherwise(F.lit("")).alias("email"),
        F.when(F.col("o_totalprice") > 300000, F.lit("c@d.net")).alias("agent"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Green")).when(F.col("o_orderstatus") == "O", F.lit("yellow")).alias("quality"),
        F.round(F.col("o_totalprice") / 5000).alias("score"),
    )
    rows = rows.withColumn("points", D.contact_points("email", "agent", "quality", "score"))
    best = D.dedup_best(rows, ["o_custkey", "o_orderpriority"], [F.col("points")], [F.col("o_orderkey")])
    return best.select("o_orderkey", "o_custkey", "o_orderpriority", "points")


@query(
    "dedup_merge_sources",
    """WITH c AS (SELECT p_partkey, p_name || CASE WHEN p_size > 25 THEN ': A Novel' ELSE '' END AS title, p_brand AS author, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'Bestseller' ELSE 'Search' END AS source,
 '#' || p_size || ' in ' || p_type AS detail, p_name || '|||' || lower(replace(p_brand, '#', '')) AS key FROM part),
d AS (SELECT key, source, CASE WHEN source = 'Bestseller' THEN detail END AS detail, min(p_partkey) AS o FROM c GROUP BY ALL),
f AS (SELECT key, arg_min(source, o) AS first_source, count(*) FILTER (source = 'Bestseller') AS n, min(o) FILTER (source = 'Bestseller') AS ob, min(o) AS oa FROM d GROUP BY key),
l AS (SELECT d.key, string_agg(d.detail || CASE WHEN d.o = f.ob AND f.first_source = 'Search' THEN ' | Also in Search' ELSE '' END, ' | ' ORDER BY d.o) AS details FROM d JOIN f ON d.key = f.key WHERE d.source = 'Bestseller' GROUP BY d.key)
SELECT c.p_partkey, c.title, c.author, c.source, coalesce(l.details, c.detail) AS detail FROM f JOIN c ON c.key = f.key AND c.p_partkey = coalesce(f.ob, f.oa) LEFT JOIN l ON l.key = f.key""",
)
def dedup_merge_sources(t: Tables) -> DataFrame:
    rows = t.part.select(
        "p_partkey",
        F.concat("p_name", F.when(F.col("p_size") > 25, F.lit(": A Novel")).otherwise(F.lit(""))).alias("title"),
        F.col("p_brand").alias("author"),
        F.when(F.col("p_type").isin("PROMO", "SMALL"), F.lit("Bestseller")).otherwise(F.lit("Search")).alias("source"),
        F.concat(F.lit("#"), F.col("p_size"), F.lit(" in "), F.col("p_type")).alias("detail"),
    )
    return D.dedup_merge_sources(rows, "title", "author", "source", "detail", "p_partkey")


@query(
    "dedup_lowest_rank",
    f"""WITH {BOOKS} SELECT author_id, series_id, book_number, rating_count FROM (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY CASE WHEN rating_count > 200 THEN rating_count END NULLS LAST, series_id, book_number, book_id) AS rn FROM books) WHERE rn = 1""",
)
def dedup_lowest_rank(t: Tables) -> DataFrame:
    rank = F.when(F.col("rating_count") > 200, F.col("rating_count"))
    order = [F.col("series_id"), F.col("book_number"), F.col("book_id")]
    return D.dedup_lowest(books(t), ["author_id"], rank, order).select("author_id", "series_id", "book_number", "rating_count")


@query(
    "distinct_titles",
    """SELECT p_partkey, CASE WHEN p_type = 'LARGE' THEN p_name || '|' || 'extra ' || p_name ELSE p_name || '|extra ' || p_name END AS titles FROM part""",
)
def unique_titles(t: Tables) -> DataFrame:
    several = F.array("p_name", F.upper("p_name"), F.concat("p_name", F.lit(" (Saga #1)")), F.concat(F.lit("extra "), F.col("p_name")), F.lit(" "))
    return t.part.select("p_partkey", F.array_join(distinct_titles(several), "|").alias("titles"))


@query(
    "duplicate_rows",
    f"""WITH {BOOKS}, d AS (SELECT *, count(*) OVER (PARTITION BY author_id, title) > 1 AS is_duplicate FROM books)
SELECT author_id, is_duplicate, count(*) AS n FROM d GROUP BY 1, 2""",
)
def duplicate_rows(t: Tables) -> DataFrame:
    marked = D.duplicated(books(t).select("author_id", "title", "book_id"), ["author_id", "title"])
    return marked.groupBy("author_id", "is_duplicate").agg(F.count(F.lit(1)).alias("n"))


@query(
    "duplicate_summary",
    f"""WITH {BOOKS}, d AS (SELECT count(*) AS n FROM books GROUP BY author_id, title HAVING count(*) > 1) SELECT count(*) AS duplicate_keys, CAST(sum(n) AS BIGINT) AS duplicate_rows FROM d""",
)
def duplicate_summary(t: Tables) -> DataFrame:
    return D.duplicate_summary(books(t), ["author_id", "title"])


@query(
    "dedup_exact",
    """SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def dedup_exact(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderkey")
    return D.dedup_exact(rows, ["o_custkey", "o_orderstatus", "o_orderpriority"], [F.col("o_orderkey")])
