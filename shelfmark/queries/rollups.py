"""Queries: books rolled up to series, and reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators import groups, nested, quality, ranking
from shelfmark.operators import rollup as R
from shelfmark.operators.matching import record_points
from shelfmark.queries.registry import Tables, query
from shelfmark.queries.views import BOOKS, RANK_LIST, books, rank_list, with_position


def _pick(label: str, order: str, where: str = "true", keys: str = "series_id") -> str:
    """CTE of the first row per key in an order, its title, rating and count."""
    return f"""{label} AS (SELECT {keys}, title AS {label}_title, rating AS {label}_rating, rating_count AS {label}_count, pub_date AS {label}_day
 FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM books WHERE {where}) WHERE rn = 1)"""


_FIRST = _pick("first", "book_number, book_id")
_LAST = _pick("last", "book_number DESC, book_id DESC")
_LAST_DATE = _pick("last", "pub_date DESC, book_number DESC, book_id DESC")
_HIGH = _pick("highest", "rating DESC, rating_count DESC, book_number, book_id", "rating > 0")
_LOW = _pick("lowest", "rating, book_number, book_id", "rating > 0")
_PUB = """pub AS (SELECT series_id, publisher FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY book_number, book_id) AS rn FROM books) WHERE rn = 1)"""


@query(
    "series_rollup",
    f"""WITH {BOOKS}, {_FIRST}, {_LAST}, {_HIGH}, {_LOW}, {_PUB},
g AS (SELECT series_id, count(*) AS books, CAST(sum(pages) AS BIGINT) AS total_pages, round(avg(pages), 4) AS avg_pages, round(avg(rating), 4) AS avg_rating,
 CAST(sum(rating_count) AS BIGINT) AS rating_count_sum, round(sum(rating * rating_count) / nullif(sum(rating_count) FILTER (rating IS NOT NULL), 0), 4) AS weighted_rating, CAST(min(year(pub_date)) AS INTEGER) AS first_year FROM books GROUP BY 1)
SELECT g.*, publisher, first_title, first_rating, first_count, last_title, last_rating, last_count, highest_title, highest_rating, highest_count, lowest_title, lowest_rating, lowest_count, first_day, last_day
FROM g JOIN first USING (series_id) JOIN last USING (series_id) LEFT JOIN highest USING (series_id) LEFT JOIN lowest USING (series_id) JOIN pub USING (series_id)""",
)
def series_rollup(t: Tables) -> DataFrame:
    rolled = R.series_rollup(books(t), ["series_id"])
    return rolled.withColumns({c: F.round(c, 4) for c in ("avg_pages", "avg_rating", "weighted_rating")})


@query(
    "series_rollup_by_date",
    f"""WITH {BOOKS}, {_FIRST}, {_LAST_DATE},
g AS (SELECT series_id, count(*) AS books, CAST(sum(coalesce(nullif(pages, 0), 300)) AS BIGINT) AS total_pages FROM books GROUP BY 1)
SELECT series_id, books, total_pages, first_title, first_day, last_title, last_day, last_count FROM g JOIN first USING (series_id) JOIN last USING (series_id)""",
)
def series_rollup_by_date(t: Tables) -> DataFrame:
    rolled = R.series_rollup(books(t), ["series_id"], last_by="date", default_pages=300)
    return rolled.select("series_id", "books", "total_pages", "first_title", "first_day", "last_title", "last_day", "last_count")


@query(
    "series_rollup_fallback",
    f"""WITH {BOOKS}, {_FIRST}, {_HIGH}, {_LOW}
SELECT series_id, coalesce(highest_title, first_title) AS highest_title, CASE WHEN highest_title IS NULL THEN first_rating ELSE highest_rating END AS highest_rating,
 coalesce(lowest_title, first_title) AS lowest_title, CASE WHEN lowest_title IS NULL THEN first_count ELSE lowest_count END AS lowest_count
FROM first LEFT JOIN highest USING (series_id) LEFT JOIN lowest USING (series_id)""",
)
def series_rollup_fallback(t: Tables) -> DataFrame:
    rolled = R.rated_or_first(R.series_rollup(books(t), ["series_id"]))
    return rolled.select("series_id", "highest_title", "highest_rating", "lowest_title", "lowest_count")


@query(
    "series_keys",
    f"""WITH {BOOKS}, k AS (SELECT CASE WHEN book_number = 1 THEN 'nan' ELSE series_name END AS s, 'Author ' || author_id AS a, title FROM books),
m AS (SELECT 'series' AS mode, lower(s) AS key FROM k UNION ALL SELECT 'series+author', lower(s) || '|||' || lower(a) FROM k
 UNION ALL SELECT 'standalone', CASE WHEN s = 'nan' THEN lower(title) || '|||' || lower(a) || '|||standalone' ELSE lower(s) || '|||' || lower(a) END FROM k)
SELECT mode, key, count(*) AS n FROM m GROUP BY 1, 2""",
)
def series_keys(t: Tables) -> DataFrame:
    rows = books(t).select(
        F.when(F.col("book_number") == 1, F.lit("nan")).otherwise(F.col("series_name")).alias("s"),
        F.concat(F.lit("Author "), F.col("author_id")).alias("a"),
        "title",
    )
    modes = ["series", "series+author", "standalone"]
    entry = F.explode(F.array(*[F.struct(F.lit(m).alias("mode"), R.series_key("s", "a", "title", m).alias("key")) for m in modes]))
    return rows.select(entry.alias("e")).groupBy("e.mode", "e.key").agg(F.count(F.lit(1)).alias("n"))


def _mode(column: str) -> str:
    return f"""m_{column} AS (SELECT series_id, {column}_mode FROM (SELECT series_id, {column}_mode, row_number() OVER (PARTITION BY series_id ORDER BY n DESC, {column}_mode) AS rn
 FROM (SELECT series_id, CAST({column} AS VARCHAR) AS {column}_mode, count(*) AS n FROM books GROUP BY 1, 2)) WHERE rn = 1)"""


@query(
    "group_modes",
    f"""WITH {BOOKS}, {_mode('publisher')}, {_mode('author_id')} SELECT series_id, publisher_mode, author_id_mode FROM m_publisher JOIN m_author_id USING (series_id)""",
)
def group_modes(t: Tables) -> DataFrame:
    return groups.group_modes(books(t), ["series_id"], ["publisher", "author_id"])


@query(
    "concat_unique",
    f"""WITH {BOOKS}, f AS (
  SELECT publisher, title, row_number() OVER (PARTITION BY publisher, title ORDER BY series_id, book_id) AS rn, series_id, book_id FROM books
)
SELECT publisher, row_number() OVER (PARTITION BY publisher ORDER BY series_id, book_id, title) AS position, title FROM f WHERE rn = 1""",
)
def concat_unique(t: Tables) -> DataFrame:
    return groups.concat_unique(books(t), ["publisher"], "title", F.struct("series_id", "book_id"))


@query(
    "member_lists",
    f"""WITH {BOOKS} SELECT publisher, row_number() OVER (PARTITION BY publisher ORDER BY series_id, book_number, book_id) AS position, title FROM books""",
)
def member_lists(t: Tables) -> DataFrame:
    """Three groups that hold all rows."""
    order = F.struct("series_id", "book_number", "book_id")
    return groups.listed(books(t), ["publisher"], F.col("title"), order).withColumnRenamed("value", "title")


_RANKED = """ranked AS (SELECT b.*, s.rank AS sports_rank, h.rank AS hockey_rank FROM books b LEFT JOIN (SELECT list_id, rank FROM rank_list WHERE list_name IN ('PROMO', 'SMALL')) s ON s.list_id = b.book_id // 100000000
 LEFT JOIN (SELECT list_id, min(rank) AS rank FROM rank_list WHERE list_name IN ('SMALL', 'LARGE') GROUP BY 1) h ON h.list_id = b.book_id // 100000000)"""


def _ranked(t: Tables) -> DataFrame:
    listed = rank_list(t)
    part = F.floor(F.col("book_id") / 100000000)
    sports = listed.filter(F.col("list_name").isin("PROMO", "SMALL")).select(F.col("list_id").alias("s_id"), F.col("rank").alias("sports_rank"))
    hockey = listed.filter(F.col("list_name").isin("SMALL", "LARGE")).select(F.col("list_id").alias("h_id"), F.col("rank").alias("hockey_rank"))
    return books(t).withColumn("part", part).join(sports, F.col("part") == F.col("s_id"), "left").join(hockey, F.col("part") == F.col("h_id"), "left")


@query(
    "featured_list",
    f"""WITH {BOOKS}, {RANK_LIST}, {_RANKED}, l AS (SELECT series_id, title || ' (' || concat_ws(', ', 'Sports #' || sports_rank, 'Hockey #' || hockey_rank) || ')' AS text, least(sports_rank, hockey_rank) AS best, book_number, book_id FROM ranked WHERE sports_rank IS NOT NULL OR hockey_rank IS NOT NULL),
d AS (SELECT series_id, text, count(*) AS n, min(best) AS best, arg_min(book_id, book_number * 1e14::DECIMAL(38,0) + book_id) AS bid, min(book_number) AS bn FROM l GROUP BY 1, 2)
SELECT series_id, string_agg(text, ' | ' ORDER BY bn, bid) AS featured_text, CAST(sum(n) AS BIGINT) AS featured, min(best) AS best_rank,
 CASE WHEN min(best) <= 10 THEN 'Top 10' WHEN min(best) <= 50 THEN 'Top 50' ELSE 'Top 100' END AS bucket FROM d GROUP BY 1""",
)
def featured_list(t: Tables) -> DataFrame:
    ranks = {"Sports": "sports_rank", "Hockey": "hockey_rank"}
    return R.featured_list(_ranked(t), ["series_id"], "title", with_position(), ranks)


@query(
    "category_ranks",
    f"""WITH {BOOKS}, {RANK_LIST}, {_RANKED}, b AS (SELECT series_id, title, book_number, book_id, least(sports_rank, hockey_rank) AS r,
 CASE WHEN hockey_rank IS NULL OR sports_rank <= hockey_rank THEN 'Sports Fiction' ELSE 'Hockey Romance' END AS c FROM ranked),
x AS (SELECT series_id, title || ': #' || r || ' in ' || c AS text, min(book_number) AS bn, arg_min(book_id, book_number * 1e14::DECIMAL(38,0) + book_id) AS bid FROM b WHERE r IS NOT NULL GROUP BY 1, 2),
j AS (SELECT series_id, string_agg(text, ' | ' ORDER BY bn, bid) AS v FROM x GROUP BY 1)
SELECT s.series_id, coalesce(v, 'No Top 100 Rank') AS validation FROM (SELECT DISTINCT series_id FROM books) s LEFT JOIN j USING (series_id)""",
)
def category_ranks(t: Tables) -> DataFrame:
    rows = _ranked(t)
    top = F.when(F.col("sports_rank").isNotNull(), F.concat(F.lit("#1,250 in Kindle Store | #"), F.col("sports_rank"), F.lit(" in Sports Fiction | #2 in Cooking")))
    peak = F.when(F.col("hockey_rank").isNotNull(), F.concat(F.lit("#"), F.col("hockey_rank"), F.lit(" in Hockey Romance")))
    best = R.category_rank(F.coalesce(top, F.lit("")), F.coalesce(peak, F.lit("")))
    return R.validation_text(rows, ["series_id"], "title", with_position(), best, "No Top 100 Rank")


@query(
    "first_filled",
    f"""WITH {BOOKS}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY book_number, book_id) AS rn FROM books WHERE publisher <> 'Oak Press'),
k AS (SELECT DISTINCT series_id FROM books) SELECT k.series_id, publisher FROM k LEFT JOIN r ON k.series_id = r.series_id AND rn = 1""",
)
def first_filled(t: Tables) -> DataFrame:
    rows = books(t).withColumn("publisher", F.when(F.col("publisher") == "Oak Press", F.lit("nan")).otherwise(F.col("publisher")))
    return R.first_in_order(rows, ["series_id"], ["publisher"], with_position())


@query(
    "weighted_rating",
    f"""WITH {BOOKS} SELECT author_id, count(*) AS books, CAST(sum(rating_count) AS BIGINT) AS total_count, round(sum(coalesce(rating, 0) * rating_count) / sum(rating_count), 2) AS avg_rating FROM books GROUP BY 1""",
)
def weighted_rating(t: Tables) -> DataFrame:
    return R.weighted_rating(books(t), ["author_id"], "rating", "rating_count")


@query(
    "wide_ratings",
    """WITH w AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 3 + 20 * l_discount AS r1, CASE WHEN l_tax = 0 THEN NULL ELSE 2 + 20 * l_tax END AS r2, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 4 END AS r3,
 CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END AS c1, CASE WHEN l_linestatus = 'F' THEN 10 ELSE 0 END AS c2, NULL AS c3 FROM lineitem),
a AS (SELECT *, coalesce(r1 * c1, 0) + coalesce(r2 * c2, 0) AS p, c1 + CASE WHEN r2 IS NULL THEN 0 ELSE c2 END AS n, r1 + coalesce(r2, 0) + r3 AS s, 1 + (r2 IS NOT NULL)::INT + (r3 > 0)::INT AS k,
 CASE WHEN r3 > 0 THEN r3 WHEN r2 IS NOT NULL THEN r2 ELSE r1 END - r1 AS d FROM w)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN n > 0 THEN CAST(n AS BIGINT) END AS total_count, round(CAST(CASE WHEN n > 0 THEN p / n ELSE s / k END AS DOUBLE), 6) AS avg_rating, round(CAST(d AS DOUBLE), 6) AS trend, CASE WHEN n > 0 THEN 'weighted' ELSE 'unweighted' END AS kind FROM a""",
)
def wide_ratings(t: Tables) -> DataFrame:
    live = F.col("l_linestatus") == "F"
    pairs = [
        (3 + 20 * F.col("l_discount"), F.when(live, F.col("l_quantity")).otherwise(0.0)),
        (F.when(F.col("l_tax") != 0, 2 + 20 * F.col("l_tax")), F.when(live, 10.0).otherwise(0.0)),
        (F.when(F.col("l_returnflag") == "R", 0.0).otherwise(4.0), F.lit(None)),
    ]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", nested.wide_ratings(pairs, 6).alias("w")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "w.*"
    )


@query(
    "series_dates",
    f"""WITH {BOOKS}, g AS (SELECT series_id, CAST(min(year(pub_date)) AS INTEGER) AS first_year, count(*) FILTER (rating_count > 5000) AS listed_books FROM books GROUP BY 1)
SELECT series_id, book_id, book_number, first_year, listed_books, CASE WHEN first_year >= 2020 THEN 'After 2020' ELSE 'Before 2020' END AS series_era FROM books JOIN g USING (series_id)""",
)
def series_dates(t: Tables) -> DataFrame:
    rows = books(t).select("series_id", "book_id", "book_number", F.year("pub_date").alias("y"), "rating_count")
    return R.series_dates(rows, ["series_id"], "y", F.col("rating_count") > 5000).drop("y", "rating_count")


@query("value_counts", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def value_counts(t: Tables) -> DataFrame:
    return R.value_counts(t.part, "p_brand")


@query("gap_to_target", "SELECT o_custkey, count(*) AS n, greatest(12 - count(*), 0) AS missing FROM orders GROUP BY 1")
def gap_to_target(t: Tables) -> DataFrame:
    return R.gap_to_target(t.orders, "o_custkey", 12)


@query(
    "bucket_counts",
    """WITH n AS (SELECT o_orderpriority, b.n FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) b ON o_orderkey = l_orderkey)
SELECT o_orderpriority, count(*) FILTER (n = 1) AS books_1, count(*) FILTER (n = 2) AS books_2, count(*) FILTER (n BETWEEN 3 AND 5) AS books_3_5, count(*) FILTER (n BETWEEN 6 AND 10) AS books_6_10,
 count(*) FILTER (n BETWEEN 11 AND 20) AS books_11_20, count(*) FILTER (n > 20) AS books_over_20, count(*) FILTER (n IS NULL) AS books_unknown FROM n GROUP BY 1""",
)
def bucket_counts(t: Tables) -> DataFrame:
    sizes = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    rows = t.orders.join(sizes, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return R.bucket_counts(rows, F.col("n"), ["o_orderpriority"])


@query(
    "score_stats",
    "SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean, median(c_acctbal) AS median, min(c_acctbal) AS least, max(c_acctbal) AS largest FROM customer GROUP BY 1",
)
def score_stats(t: Tables) -> DataFrame:
    return R.score_stats(t.customer, "c_acctbal", ["c_mktsegment"])


@query(
    "coverage",
    "SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus <> 'P') AS filled, round(count(*) FILTER (o_orderstatus <> 'P') * 100.0::DOUBLE / count(*), 2) AS percent FROM orders GROUP BY 1",
)
def coverage(t: Tables) -> DataFrame:
    return R.coverage(t.orders, ["o_orderpriority"], F.col("o_orderstatus") != "P")


@query(
    "missing_audit",
    f"""WITH {BOOKS}, c AS (SELECT 'rating' AS field, count(*) - count(rating) AS missing, count(rating) AS present FROM books UNION ALL SELECT 'pages', count(*) - count(pages), count(pages) FROM books
 UNION ALL SELECT 'publisher', 0, count(*) FROM books) SELECT field, present, missing, round(missing * 100.0::DOUBLE / (present + missing), 2) AS missing_percent FROM c""",
)
def missing_audit(t: Tables) -> DataFrame:
    return quality.missing_audit(books(t), ["rating", "pages", "publisher"])


@query(
    "works_count",
    """WITH i AS (SELECT l_orderkey, 'Saga #' || CASE WHEN l_returnflag = 'R' THEN l_linenumber || '.5' WHEN l_linestatus = 'F' THEN l_linenumber || '-' || 9 ELSE CAST(l_linenumber AS VARCHAR) END AS info FROM lineitem)
SELECT l_orderkey, count(*) FILTER (regexp_matches(info, '#[0-9]+$')) AS primary_works, count(*) AS total_works FROM i GROUP BY 1""",
)
def works_count(t: Tables) -> DataFrame:
    line = F.col("l_linenumber").cast("string")
    number = F.when(F.col("l_returnflag") == "R", F.concat(line, F.lit(".5"))).when(F.col("l_linestatus") == "F", F.concat(line, F.lit("-9"))).otherwise(line)
    return R.works_count(t.lineitem.select("l_orderkey", F.concat(F.lit("Saga #"), number).alias("info")), ["l_orderkey"], "info")


@query(
    "consolidated_variants",
    f"""WITH {BOOKS}, v AS (SELECT series_id // 2 AS canonical, count(*) AS books, count(*) FILTER (rating_count > 9000) AS listed, CASE WHEN max(rating_count) > 20000 THEN 'Top 10' WHEN max(rating_count) > 9000 THEN 'Top 50' WHEN max(rating_count) > 4000 THEN 'Top 100' ELSE 'No List' END AS bucket,
 CAST(min(year(pub_date)) AS INTEGER) AS y FROM books GROUP BY series_id, canonical)
SELECT canonical, CAST(sum(books) AS BIGINT) AS books, CAST(sum(listed) AS BIGINT) AS listed, arg_min(bucket, CASE bucket WHEN 'Top 10' THEN 1 WHEN 'Top 50' THEN 2 WHEN 'Top 100' THEN 3 ELSE 4 END) AS bucket, min(y) AS y,
 CASE WHEN min(y) >= 2020 THEN 'After 2020' ELSE 'Before 2020' END AS series_era FROM v GROUP BY 1""",
)
def consolidated_variants(t: Tables) -> DataFrame:
    top = F.max("rating_count")
    bucket = F.when(top > 20000, F.lit("Top 10")).when(top > 9000, F.lit("Top 50")).when(top > 4000, F.lit("Top 100")).otherwise(F.lit("No List"))
    variants = books(t).groupBy("series_id").agg(
        F.count(F.lit(1)).alias("books"), F.count(F.when(F.col("rating_count") > 9000, 1)).alias("listed"), bucket.alias("bucket"), F.min(F.year("pub_date")).alias("y")
    )
    variants = variants.withColumn("canonical", F.floor(F.col("series_id") / 2))
    return R.consolidate_rows(variants, "canonical", "books", "listed", "bucket", "y")


@query(
    "series_summary",
    f"""WITH {BOOKS}, b AS (SELECT *, 'Tome ' || (book_id // 100000000 // 100) || CASE WHEN publisher = 'Oak Press' AND rating IS NULL THEN ' Omnibus' ELSE '' END AS t2,
 CASE WHEN pages IS NOT NULL THEN 3 ELSE 0 END + 2 + 2 + CASE publisher WHEN 'Oak Press' THEN 1 ELSE 0 END AS points, CASE WHEN book_number > 3 THEN CAST(book_number AS INTEGER) END AS declared FROM books),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY author_id, lower(t2) ORDER BY points DESC, series_id, book_number, book_id) AS rn FROM b) WHERE rn = 1),
f AS (SELECT *, contains(t2, 'Omnibus') AS coll FROM u), h AS (SELECT author_id, bool_or(NOT coll) AS has_main FROM f GROUP BY 1),
m AS (SELECT f.* FROM f JOIN h USING (author_id) WHERE NOT coll OR NOT has_main),
g AS (SELECT author_id, count(*) AS observed, max(declared) AS declared, count(pages) AS kp, sum(pages) AS ps FROM m GROUP BY 1),
o AS (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY book_number, CAST(pub_date AS VARCHAR), lower(t2), series_id) AS a, row_number() OVER (PARTITION BY author_id ORDER BY book_number DESC, CAST(pub_date AS VARCHAR) DESC, lower(t2) DESC, series_id DESC) AS z FROM m)
SELECT g.author_id, observed, declared, greatest(observed, coalesce(declared, 0)) AS books_in_series, greatest(observed, coalesce(declared, 0)) = observed AS complete,
 (SELECT t2 FROM o WHERE o.author_id = g.author_id AND a = 1) AS first_book, (SELECT t2 FROM o WHERE o.author_id = g.author_id AND z = 1) AS last_book,
 CASE WHEN greatest(observed, coalesce(declared, 0)) = observed AND kp = observed THEN CAST(ps AS BIGINT) END AS total_pages FROM g""",
)
def series_summary(t: Tables) -> DataFrame:
    name = F.concat(F.lit("Tome "), F.floor(F.col("book_id") / 100000000 / 100).cast("string"))
    omnibus = (F.col("publisher") == "Oak Press") & F.col("rating").isNull()
    rows = books(t).select(
        "author_id", "series_id", "book_id", "pub_date", "pages", "publisher", "rating_count", "book_number",
        F.concat(name, F.when(omnibus, F.lit(" Omnibus")).otherwise(F.lit(""))).alias("t2"),
        F.when(F.col("book_number") > 3, F.col("book_number").cast("int")).alias("declared"),
        F.struct("series_id", "book_number", "book_id").alias("row_id"),
    )
    points = record_points("pages", "rating_count", "book_number", "publisher", {"Oak Press": 1})
    return R.summarise_series(rows, ["author_id"], "t2", F.lower("t2"), points, "book_number", "pub_date", "pages", "declared", "row_id")


@query(
    "series_by_author",
    """SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS position, o_orderkey || ':' || o_orderpriority AS series FROM orders""",
)
def series_by_author(t: Tables) -> DataFrame:
    lists = nested.series_by_author(t.orders, "o_custkey", ["o_orderkey", "o_orderpriority"], F.col("o_orderkey"))
    text = F.concat(F.col("value.o_orderkey").cast("string"), F.lit(":"), F.col("value.o_orderpriority"))
    return lists.select("o_custkey", "position", text.alias("series"))


@query(
    "nested_books",
    f"""WITH {BOOKS}, b AS (SELECT series_id, title AS name, book_number, book_id, coalesce(rating, 0) AS rating, rating_count FROM books),
o AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY book_number, book_id) AS a, row_number() OVER (PARTITION BY series_id ORDER BY book_number DESC, book_id DESC) AS z,
 row_number() OVER (PARTITION BY series_id ORDER BY rating DESC, rating_count DESC, book_number, book_id) AS hi, row_number() OVER (PARTITION BY series_id ORDER BY CASE WHEN rating > 0 THEN rating ELSE 99 END, book_number, book_id) AS lo FROM b)
SELECT series_id, CAST(count(*) AS INTEGER) AS books, max(name) FILTER (a = 1) AS first_title, max(rating) FILTER (a = 1) AS first_rating, max(rating_count) FILTER (a = 1) AS first_count, max(name) FILTER (z = 1) AS last_title,
 max(name) FILTER (CASE WHEN rating > 0 THEN hi = 1 END) AS h0, coalesce(max(name) FILTER (hi = 1 AND rating > 0), max(name) FILTER (a = 1)) AS highest_title, coalesce(max(name) FILTER (lo = 1 AND rating > 0), max(name) FILTER (a = 1)) AS lowest_title,
 round(coalesce(sum(rating) / nullif(count(*) FILTER (rating > 0), 0), 0), 4) AS avg_rating, string_agg(name, ', ' ORDER BY book_number, book_id) AS names FROM o GROUP BY 1""".replace(
        " max(name) FILTER (CASE WHEN rating > 0 THEN hi = 1 END) AS h0,", ""
    ),
)
def nested_books(t: Tables) -> DataFrame:
    rows = books(t).withColumnsRenamed({"title": "name", "rating_count": "count"}).withColumn("number", F.col("book_number").cast("string"))
    long = nested.nest_books(rows, ["series_id"], ["name", "number", "rating", "count"], with_position())
    # the stored form is one cell for a series, as long as the series
    arrays = long.groupBy("series_id").agg(F.array_sort(F.collect_list(F.struct("position", "value"))).alias("l"))
    stored = arrays.select("series_id", F.to_json(F.transform("l", lambda x: x["value"])).alias("books_json"))
    summary = nested.nested_summary(nested.parse_books("books_json"))
    out = stored.select("series_id", summary.alias("s")).select("series_id", "s.*")
    return out.withColumn("avg_rating", F.round("avg_rating", 4)).drop("last_rating", "last_count")


@query(
    "group_heads",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1",
)
def group_heads(t: Tables) -> DataFrame:
    return ranking.group_head(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", F.desc("o_totalprice"), F.col("o_orderkey"))


@query(
    "priority_sort",
    "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders",
)
def priority_sort(t: Tables) -> DataFrame:
    order = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
    return ranking.priority_sort(
        t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), "o_orderpriority", F.desc("o_totalprice"), F.col("o_orderkey"), order=order
    )


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(t: Tables) -> DataFrame:
    return ranking.top_k(t.orders.select("o_orderkey", "o_totalprice"), 25, F.desc("o_totalprice"), F.col("o_orderkey"))


@query(
    "top_k_per_group",
    "SELECT p_brand, p_partkey, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn <= 10",
)
def top_k_per_group(t: Tables) -> DataFrame:
    return groups.ranked_per_key(t.part.select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], 10).drop("p_retailprice")


@query(
    "quota_fill",
    """WITH c AS (SELECT c_mktsegment AS g, count(*) AS n FROM customer WHERE c_acctbal < 1000 GROUP BY 1),
n AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey, c_custkey) AS rn FROM customer WHERE c_acctbal >= 1000)
SELECT c_custkey, c_mktsegment FROM n LEFT JOIN c ON g = c_mktsegment WHERE rn <= greatest(60 - coalesce(c.n, 0), 0)""",
)
def quota_fill(t: Tables) -> DataFrame:
    current = t.customer.filter("c_acctbal < 1000")
    new = t.customer.filter("c_acctbal >= 1000").select("c_custkey", "c_mktsegment", "c_nationkey")
    return ranking.quota_fill(current, new, "c_mktsegment", [F.col("c_nationkey"), F.col("c_custkey")], 60).drop("c_nationkey")


@query(
    "miss_streak_stop",
    """WITH e AS (SELECT event_id, event_type, value < 16 AS miss FROM events),
i AS (SELECT *, count(*) FILTER (NOT miss) OVER (PARTITION BY event_type ORDER BY event_id) AS island FROM e),
s AS (SELECT *, count(*) FILTER (miss) OVER (PARTITION BY event_type, island ORDER BY event_id) AS streak FROM i),
f AS (SELECT event_type, min(event_id) AS stop FROM s WHERE miss AND streak >= 12 GROUP BY 1)
SELECT event_id, e.event_type, coalesce(event_id > stop, false) AS skipped FROM e LEFT JOIN f ON e.event_type = f.event_type""",
)
def miss_streak_stop(t: Tables) -> DataFrame:
    return ranking.miss_streak_stop(t.events.select("event_id", "event_type", "value"), "event_type", "event_id", F.col("value") < 16, 12, width=1000).drop("value")
