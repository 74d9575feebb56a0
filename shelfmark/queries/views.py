"""The shared tables seen as a catalogue: each view once for Spark and once as a SQL common table expression.

Books are order lines, a series is an order, an author is a supplier (per book) or a customer (per series),
a bestseller list is the 100 dearest parts of a brand or type, and descriptions are documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.groups import ranked_per_key
from shelfmark.queries.registry import Tables

SPACE = "[\\s\\p{Z}]"


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_any(x: str, terms: list[str]) -> str:
    """True when one of the terms occurs."""
    return "(" + " OR ".join(f"contains({x}, {sql_quote(t)})" for t in terms) + ")"


def sql_word(x: str, term: str) -> str:
    """True when the term occurs as a whole word."""
    escaped = "".join("\\" + ch if ch in "\\.^$|?*+()[]{}-" else ch for ch in term)
    return f"regexp_matches({x}, '(^|[^\\p{{L}}\\p{{N}}\\p{{M}}_]){escaped.replace(chr(39), chr(39) * 2)}($|[^\\p{{L}}\\p{{N}}\\p{{M}}_])')"


def sql_term(x: str, term: str, word_length: int) -> str:
    return sql_word(x, term) if len(term) <= word_length else f"contains({x}, {sql_quote(term)})"


def sql_first(x: str, terms: list[str], prefix: str = "", word_length: int = 0) -> str:
    """Prefix + first term that occurs."""
    cases = " ".join(f"WHEN {sql_term(x, t, word_length)} THEN {sql_quote(prefix + t)}" for t in terms)
    return f"CASE {cases} END"


def sql_ladder(x: str, steps: list, default) -> str:
    """First bound that the value reaches."""

    def lit(v) -> str:
        return "NULL" if v is None else sql_quote(v) if isinstance(v, str) else str(v)

    return "CASE " + " ".join(f"WHEN {x} >= {b} THEN {lit(v)}" for b, v in steps) + f" ELSE {lit(default)} END"


def books(t: Tables, lines: DataFrame | None = None, *more: Column | str) -> DataFrame:
    """Book rows: one per order line (of ``lines``, if given), with further columns of it."""
    return (t.lineitem if lines is None else lines).select(
        F.col("l_orderkey").alias("series_id"),
        F.concat(F.lit("Series "), F.col("l_orderkey")).alias("series_name"),
        F.col("l_suppkey").alias("author_id"),
        F.concat(F.lit("Book "), F.col("l_partkey")).alias("title"),
        F.col("l_linenumber").cast("double").alias("book_number"),
        ((F.col("l_partkey") * 1000000 + F.col("l_suppkey")) * 100 + F.col("l_quantity").cast("long")).alias("book_id"),
        F.when(F.col("l_tax") != 0, F.round(3.0 + 20 * F.col("l_discount"), 2)).alias("rating"),
        (F.col("l_quantity") * F.col("l_quantity") * 10).cast("long").alias("rating_count"),
        F.when(F.col("l_returnflag") != "R", (F.col("l_quantity") * 12).cast("int")).alias("pages"),
        F.when(F.col("l_returnflag") == "A", F.lit("Independently Published"))
        .when(F.col("l_returnflag") == "N", F.lit("Penguin Random House"))
        .otherwise(F.lit("Oak Press"))
        .alias("publisher"),
        F.add_months("l_shipdate", 240).alias("pub_date"),
        *more,
    )


BOOKS = """books AS (SELECT l_orderkey AS series_id, 'Series ' || l_orderkey AS series_name, l_suppkey AS author_id,
 'Book ' || l_partkey AS title, CAST(l_linenumber AS DOUBLE) AS book_number, (l_partkey * 1000000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS book_id,
 CASE WHEN l_tax <> 0 THEN round(3.0::DOUBLE + 20 * l_discount, 2) END AS rating,
 CAST(l_quantity * l_quantity * 10 AS BIGINT) AS rating_count,
 CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity * 12 AS INTEGER) END AS pages,
 CASE l_returnflag WHEN 'A' THEN 'Independently Published' WHEN 'N' THEN 'Penguin Random House' ELSE 'Oak Press' END AS publisher,
 CAST(l_shipdate + INTERVAL 20 YEAR AS DATE) AS pub_date FROM lineitem)"""


def titled_parts(t: Tables) -> DataFrame:
    """Parts under book-like titles with series, number and edition wording."""
    size = F.col("p_size").cast("string")
    title = (
        F.when(F.col("p_type") == "ECONOMY", F.concat("p_name", F.lit(" Box Set")))
        .when(F.col("p_type") == "PROMO", F.concat("p_name", F.lit(" (Iron Saga, #"), size, F.lit(")")))
        .when(F.col("p_type") == "LARGE", F.concat("p_name", F.lit(": Book "), size))
        .when(F.col("p_type") == "SMALL", F.concat("p_name", F.lit(" (Copper Forge Book "), size, F.lit(")")))
        .when(F.col("p_type") == "MEDIUM", F.concat("p_name", F.lit(": A Workshop Romance")))
        .otherwise(F.concat(F.lit("Tin "), F.col("p_name")))
    )
    return t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", title.alias("title"))


TITLED = """titled AS (SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, CASE p_type
 WHEN 'ECONOMY' THEN p_name || ' Box Set' WHEN 'PROMO' THEN p_name || ' (Iron Saga, #' || p_size || ')'
 WHEN 'LARGE' THEN p_name || ': Book ' || p_size WHEN 'SMALL' THEN p_name || ' (Copper Forge Book ' || p_size || ')'
 WHEN 'MEDIUM' THEN p_name || ': A Workshop Romance' ELSE 'Tin ' || p_name END AS title FROM part)"""


def rank_list(t: Tables) -> DataFrame:
    """Bestseller lists: the 100 dearest parts of every type (list_id, list_name, rank, title, author)."""
    ranked = ranked_per_key(t.part, ["p_type"], [F.col("p_retailprice").desc(), F.col("p_partkey")], 100)
    return ranked.select(
        F.col("p_partkey").alias("list_id"),
        F.col("p_type").alias("list_name"),
        "rank",
        F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("title"),
        F.col("p_brand").alias("author"),
    )


RANK_LIST = """rank_list AS (SELECT p_partkey AS list_id, p_type AS list_name, rank, p_name || ' ' || lower(p_type) AS title,
 p_brand AS author FROM (SELECT *, CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS rank
 FROM part) WHERE rank <= 100)"""


def name_series(t: Tables) -> DataFrame:
    """Series of parts of one name and brand (sid, series_name, author, n)."""
    grouped = t.part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("sid"), F.count(F.lit(1)).alias("n"))
    return grouped.select("sid", F.col("p_name").alias("series_name"), F.col("p_brand").alias("author"), "n")


NAME_SERIES = """name_series AS (SELECT min(p_partkey) AS sid, p_name AS series_name, p_brand AS author, count(*) AS n
 FROM part GROUP BY p_name, p_brand)"""


def with_position(c: str = "book_number") -> Column:
    """Order of the books of a series."""
    return F.struct(F.col(c), F.col("book_id"))
