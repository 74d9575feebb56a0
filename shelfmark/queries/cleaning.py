"""Queries: missing values, numbers, headers, columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import nulls as N
from shelfmark.functions.text import is_self_published
from shelfmark.operators import groups, overlay, schema
from shelfmark.queries.registry import Tables, query
from shelfmark.queries.views import BOOKS, RANK_LIST, books, rank_list, sql_trim, with_position
from shelfmark.sources.readers import contact_rows, existing_keys

_RAW = """raw AS (SELECT event_id, event_type, CASE WHEN value < 2 THEN ' N/A ' WHEN value < 4 THEN 'nan' WHEN value < 6 THEN '0.0'
 WHEN value < 8 THEN 'Unknown Publisher' ELSE '  ' || event_type || chr(10) || props || ' ' END AS raw FROM events)"""


@query(
    "null_placeholders",
    f"""WITH {_RAW}, t AS (SELECT *, {sql_trim('raw')} AS x FROM raw)
SELECT event_id, CASE WHEN lower(x) NOT IN ('', '0', '0.0', 'nan', 'none', 'null', 'unknown', 'unknown publisher', 'n/a') THEN x END AS clean,
 lower(x) IN ('', 'nan', 'none', 'null', 'nat') AS missing, {sql_trim("split_part(raw, chr(10), 1)")} AS line,
 CASE WHEN lower(x) NOT IN ('', 'nan', 'none', 'null', 'nat') THEN raw ELSE event_type END AS first_value FROM t""",
)
def null_placeholders(t: Tables) -> DataFrame:
    raw = (
        F.when(F.col("value") < 2, F.lit(" N/A "))
        .when(F.col("value") < 4, F.lit("nan"))
        .when(F.col("value") < 6, F.lit("0.0"))
        .when(F.col("value") < 8, F.lit("Unknown Publisher"))
        .otherwise(F.concat(F.lit("  "), F.col("event_type"), F.lit("\n"), F.col("props"), F.lit(" ")))
    )
    return t.events.select("event_id", "event_type", raw.alias("raw")).select(
        "event_id",
        N.null_if_placeholder("raw").alias("clean"),
        N.is_missing("raw").alias("missing"),
        N.first_line("raw").alias("line"),
        N.first_non_missing("raw", "event_type").alias("first_value"),
    )


_NUM = "'^[\\s\\p{Z}]*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?[\\s\\p{Z}]*$'"


def _sql_number(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {_NUM}) THEN TRY_CAST(trim({x}) AS DOUBLE) END"


@query(
    "lenient_numbers",
    f"""WITH x AS (SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN c_custkey || ',000.5' WHEN 'HOUSEHOLD' THEN c_custkey || 'K'
 WHEN 'MACHINERY' THEN 'about ' || c_custkey || ' pages' WHEN 'AUTOMOBILE' THEN ' ' || c_custkey || '.25 ' ELSE '#' || c_custkey || '.0' END AS v FROM customer)
SELECT c_custkey, {_sql_number('v')} AS strict, {_sql_number("replace(v, ',', '')")} AS commas,
 {_sql_number("regexp_replace(v, '[^0-9.]', '', 'g')")} AS digits,
 CASE WHEN v LIKE '%K' THEN 1000.0::DOUBLE ELSE 1.0::DOUBLE END * ({_sql_number("regexp_replace(lower(trim(replace(v, ',', ''))), '[km]$', '')")}) AS suffix,
 CAST(floor({_sql_number("replace(v, ',', '')")}) AS BIGINT) AS whole,
 CASE WHEN regexp_matches(v, {_NUM}) THEN (CASE WHEN TRY_CAST(trim(v) AS DOUBLE) = floor(TRY_CAST(trim(v) AS DOUBLE)) THEN CAST(CAST(floor(TRY_CAST(trim(v) AS DOUBLE)) AS BIGINT) AS VARCHAR) ELSE CAST(TRY_CAST(trim(v) AS DOUBLE) AS VARCHAR) END) ELSE trim(v) END AS book_number,
 TRY_CAST(nullif(regexp_extract(v, '([0-9]+)', 1), '') AS DOUBLE) AS book_order FROM x""",
)
def lenient_numbers(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    v = (
        F.when(F.col("c_mktsegment") == "FURNITURE", F.concat(key, F.lit(",000.5")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(key, F.lit("K")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("about "), key, F.lit(" pages")))
        .when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(F.lit(" "), key, F.lit(".25 ")))
        .otherwise(F.concat(F.lit("#"), key, F.lit(".0")))
    )
    return t.customer.select("c_custkey", v.alias("v")).select(
        "c_custkey",
        N.to_number("v").alias("strict"),
        N.to_number("v", "commas").alias("commas"),
        N.to_number("v", "digits").alias("digits"),
        N.to_number("v", "suffix").alias("suffix"),
        N.to_whole("v", "commas").alias("whole"),
        N.clean_book_number("v").alias("book_number"),
        N.book_order("v").alias("book_order"),
    )


@query(
    "header_repair",
    """SELECT p_name AS book_name, p_brand AS author_name, p_size AS pages, CAST(NULL AS DOUBLE) AS rating,
 p_partkey AS row_key, p_retailprice AS extra_price FROM part""",
)
def header_repair(t: Tables) -> DataFrame:
    messy = t.part.select(
        F.col("p_name").alias("book \nname"),
        F.col("p_brand").alias("Writer"),
        F.col("p_size").cast("string").alias("pages"),
        F.col("p_type").alias("Unnamed: 3"),
        F.col("p_type").alias("Universe Type"),
        F.col("p_brand").alias("author_name"),
        F.col("p_retailprice").alias("extra_price"),
        F.col("p_partkey").alias("row_key"),
    )
    repaired = schema.repair_header(messy, {"book name": "book_name", "Writer": "author_name"}, ["Universe Type"])
    wanted = T.StructType(
        [
            T.StructField("book_name", T.StringType()),
            T.StructField("author_name", T.StringType()),
            T.StructField("pages", T.IntegerType()),
            T.StructField("rating", T.DoubleType()),
        ]
    )
    return schema.align_to_schema(repaired, wanted, extras="keep")


@query(
    "swapped_links",
    """WITH l AS (SELECT page_id, url AS first_link, CASE WHEN contains(url, 'example.org') AND contains(url, '/en/') THEN 'http://x.example.com/' || page_id
 WHEN contains(url, '/fr/') THEN 'http://y.example.org/' || page_id END AS second_link FROM pages),
f AS (SELECT *, coalesce(contains(lower(first_link), 'example.org'), false) AS a, coalesce(contains(lower(second_link), 'example.com'), false) AS b FROM l)
SELECT page_id, CASE WHEN a AND b THEN second_link WHEN a THEN NULL ELSE first_link END AS first_link,
 CASE WHEN a THEN first_link ELSE second_link END AS second_link FROM f""",
)
def swapped_links(t: Tables) -> DataFrame:
    second = F.when(
        F.col("url").contains("example.org") & F.col("url").contains("/en/"), F.concat(F.lit("http://x.example.com/"), F.col("page_id"))
    ).when(F.col("url").contains("/fr/"), F.concat(F.lit("http://y.example.org/"), F.col("page_id")))
    links = t.pages.select("page_id", F.col("url").alias("first_link"), second.alias("second_link"))
    return schema.fix_swapped_links(links, "first_link", "second_link", "example.com", "example.org")


@query(
    "verified_values",
    """SELECT o_orderkey, o_orderpriority, CASE o_orderstatus WHEN 'P' THEN ' 1-URGENT ' WHEN 'O' THEN '' ELSE 'nan' END AS "Verified_o_orderpriority",
 CASE o_orderstatus WHEN 'P' THEN '1-URGENT' ELSE o_orderpriority END AS "Final_o_orderpriority" FROM orders""",
)
def verified_values(t: Tables) -> DataFrame:
    checked = F.when(F.col("o_orderstatus") == "P", F.lit(" 1-URGENT ")).when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.lit("nan"))
    rows = t.orders.select("o_orderkey", "o_orderpriority", checked.alias("Verified_o_orderpriority"))
    return schema.apply_verified(rows, ["o_orderpriority"])


@query(
    "strong_publisher",
    f"""WITH {BOOKS}, s AS (SELECT *, contains(lower(publisher), 'independently') AS weak FROM books),
f AS (SELECT series_id, publisher AS strong FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY book_number, book_id) AS rn FROM s WHERE NOT weak) WHERE rn = 1),
p AS (SELECT s.series_id, s.book_id, s.book_number, CASE WHEN weak AND strong IS NOT NULL THEN strong ELSE publisher END AS publisher FROM s LEFT JOIN f USING (series_id))
SELECT series_id, book_id, book_number, publisher, CASE WHEN contains(lower(publisher), 'penguin') THEN 'No' ELSE 'Yes' END AS self_published FROM p""",
)
def strong_publisher(t: Tables) -> DataFrame:
    weak = F.lower("publisher").contains("independently")
    rows = books(t).select("series_id", "book_id", "book_number", "publisher")
    filled = groups.broadcast_group_value(rows, ["series_id"], "publisher", ~weak, weak, with_position())
    return filled.withColumn("self_published", is_self_published("publisher"))


@query(
    "twin_values",
    """WITH b AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal > 3000 THEN 'https://catalogue.example.com/series/' || c_custkey ELSE '' END AS url,
 CAST(floor(c_acctbal) AS BIGINT) AS ratings FROM customer),
l AS (SELECT c_nationkey, url AS twin_url, ratings AS twin_ratings FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) AS rn FROM b WHERE url <> '') WHERE rn = 1)
SELECT c_custkey, b.c_nationkey, CASE WHEN url = '' AND twin_url IS NOT NULL THEN twin_url ELSE url END AS url,
 CASE WHEN url = '' AND twin_url IS NOT NULL THEN twin_ratings ELSE ratings END AS ratings FROM b LEFT JOIN l ON b.c_nationkey = l.c_nationkey""",
)
def twin_values(t: Tables) -> DataFrame:
    url = F.when(F.col("c_acctbal") > 3000, F.concat(F.lit("https://catalogue.example.com/series/"), F.col("c_custkey"))).otherwise(F.lit(""))
    rows = t.customer.select("c_custkey", "c_nationkey", url.alias("url"), F.floor("c_acctbal").alias("ratings"))
    return groups.copy_from_twin(rows, F.col("c_nationkey"), "url", ["ratings"], F.col("c_custkey"))


@query(
    "manual_overrides",
    """WITH every AS (
  SELECT o_custkey AS c_custkey, CASE WHEN o_orderstatus = 'F' THEN 'Clerk ' || o_orderkey END AS c_name, o_orderpriority AS c_mktsegment, o_orderkey AS ord FROM orders
  UNION ALL SELECT s_suppkey + 1000000000, s_name, NULL, s_suppkey FROM supplier
),
p AS (SELECT c_custkey, arg_min(c_name, ord) AS c_name, arg_min(c_mktsegment, ord) AS c_mktsegment FROM every GROUP BY 1)
SELECT coalesce(p.c_custkey, c.c_custkey) AS c_custkey, coalesce(p.c_name, c.c_name) AS c_name, coalesce(p.c_mktsegment, c.c_mktsegment) AS c_mktsegment,
 c.c_acctbal FROM customer c FULL JOIN p ON c.c_custkey = p.c_custkey""",
)
def manual_overrides(t: Tables) -> DataFrame:
    name = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Clerk "), F.col("o_orderkey")))
    patches = t.orders.select(F.col("o_custkey").alias("c_custkey"), name.alias("c_name"), F.col("o_orderpriority").alias("c_mktsegment"), F.col("o_orderkey").alias("ord"))
    added = t.supplier.select((F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit(None).cast("string").alias("c_mktsegment"), "s_suppkey")
    base = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return overlay.override_table(base, patches.union(added), ["c_custkey"], ["c_name", "c_mktsegment"], F.col("ord"))


@query(
    "best_book_count",
    """WITH c AS (SELECT l_orderkey, CAST(count(*) AS VARCHAR) AS books_in_series, CASE WHEN max(l_quantity) > 45 THEN max(l_linenumber) || '.0' ELSE 'unknown' END AS verified_books FROM lineitem GROUP BY 1)
SELECT l_orderkey, greatest(CAST(books_in_series AS BIGINT), CAST(TRY_CAST(verified_books AS DOUBLE) AS BIGINT)) AS best FROM c""",
)
def best_book_count(t: Tables) -> DataFrame:
    counts = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("string").alias("books_in_series"),
        F.when(F.max("l_quantity") > 45, F.concat(F.max("l_linenumber").cast("string"), F.lit(".0"))).otherwise(F.lit("unknown")).alias("verified_books"),
    )
    return counts.select("l_orderkey", N.best_count("books_in_series", "verified_books").alias("best"))


@query(
    "cleaned_table",
    """SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_acctbal <> 0 THEN c_acctbal END AS c_acctbal, CAST(c_nationkey AS DOUBLE) AS c_nationkey FROM customer""",
)
def cleaned_table(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("c_name", F.concat(F.lit("  "), F.col("c_name"), F.lit(" \t")))
    return schema.clean_numbers(schema.clean_strings(rows), ["c_acctbal", "c_nationkey"], zero_is_value=["c_nationkey"])


@query(
    "contact_cache",
    """WITH e AS (SELECT c_custkey, lower(c_name) AS author_key, c_name FROM customer)
SELECT author_key, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'desk' || c_custkey || '@mail.example.net' ELSE 'old' || c_custkey || '@mail.example.net' END AS email,
 CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'second' ELSE 'seed' END AS email_source FROM e""",
)
def contact_cache(t: Tables) -> DataFrame:
    def cache(rows: DataFrame, key: str, name: str, mailbox: str, source: str, order: int) -> DataFrame:
        text = F.format_string(
            '{"%s": {"author": "%s", "email": "' + mailbox + '%d@mail.example.net", "email_source": "' + source + '"}}', F.upper(name), F.col(name), F.col(key)
        )
        return rows.select(text.alias("json"), F.lit(order).alias("cache_order"))

    active = t.customer.join(t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey")
    caches = cache(t.customer, "c_custkey", "c_name", "old", "seed", 0).union(cache(active, "c_custkey", "c_name", "desk", "second", 1))
    return contact_rows(caches, "json", "cache_order").select("author_key", "email", "email_source")


@query(
    "existing_keys",
    """WITH s AS (SELECT p_name AS s, p_brand AS a FROM part UNION SELECT c_mktsegment, c_name FROM customer),
k AS (SELECT regexp_replace(lower(s), '[^a-z0-9 ]', '', 'g') AS s, regexp_replace(lower(a), '[^a-z0-9 ]', '', 'g') AS a FROM s)
SELECT s || '|||' || a AS key FROM k UNION SELECT s FROM k""",
)
def existing_series_keys(t: Tables) -> DataFrame:
    return existing_keys([(t.part, F.col("p_name"), F.col("p_brand")), (t.customer, F.col("c_mktsegment"), F.col("c_name"))])


@query(
    "union_sources",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance, 'customer' AS source FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, 'supplier' FROM supplier""",
)
def union_sources(t: Tables) -> DataFrame:
    a = schema.to_standard(t.customer, {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}, {"source": "customer"})
    b = schema.to_standard(t.supplier, {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"}, {"source": "supplier"})
    return schema.union_by_name(a, b)


@query(
    "guessed_rank_list",
    f"""WITH {RANK_LIST} SELECT regexp_replace(title, '[^a-z]', '', 'g') AS title_key, rank AS list_rank FROM rank_list""",
)
def guessed_rank_list(t: Tables) -> DataFrame:
    listed = rank_list(t).select("list_id", F.initcap("title").alias("Book Title"), F.concat(F.lit("# "), F.col("rank").cast("string")).alias("Rank"))
    return schema.ranked_titles(listed)
