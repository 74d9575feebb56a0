"""Queries: ladders, scoring models, checks, and the whole jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.config import models
from shelfmark.functions import ladders as L
from shelfmark.functions.text import publisher_class, rationale
from shelfmark.operators import quality as Q
from shelfmark.operators import ranking
from shelfmark.operators import rollup as R
from shelfmark.operators import scoring as SC
from shelfmark.plans import book_report, genre_lists, outreach, series_master
from shelfmark.queries.joining import _band_sql
from shelfmark.queries.registry import Tables, query
from shelfmark.queries.rollups import _FIRST, _HIGH, _LAST, _LAST_DATE, _LOW, _PUB
from shelfmark.queries.views import BOOKS, RANK_LIST, books, rank_list, sql_ladder

_ROLLED = f"""{_FIRST}, {_LAST}, {_HIGH}, {_LOW}, {_PUB},
g AS (SELECT series_id, count(*) AS books, CAST(sum(pages) AS BIGINT) AS total_pages, avg(rating) AS avg_rating, CAST(min(year(pub_date)) AS INTEGER) AS first_year FROM books GROUP BY 1),
s AS (SELECT * FROM g JOIN first USING (series_id) JOIN last USING (series_id) LEFT JOIN highest USING (series_id) LEFT JOIN lowest USING (series_id) JOIN pub USING (series_id))"""
_ERA = "CASE WHEN year(first_day) >= 2020 THEN 'After 2020' WHEN year(first_day) < 2020 THEN 'Before 2020' ELSE 'Unknown' END"


def rolled(t: Tables) -> DataFrame:
    """Series with the first publication year of their first book and its era."""
    out = R.series_rollup(books(t), ["series_id"])
    return out.withColumn("era", L.series_era(F.year("first_day")))


def _upper(x: str, bounds: list, labels: list[str]) -> str:
    cases = " ".join(f"WHEN {x} <= {b} THEN '{label}'" for b, label in zip(bounds, labels))
    return f"CASE WHEN {x} IS NULL THEN 'Data Missing' {cases} ELSE '{labels[-1]}' END"


@query(
    "length_estimates",
    f"""WITH {BOOKS}, p AS (SELECT series_id, count(*) AS n, CAST(sum(pages) AS BIGINT) AS pages FROM books GROUP BY 1), f AS (SELECT series_id, n, coalesce(CASE WHEN pages > 0 THEN pages END, CASE WHEN n > 0 THEN n * 300 END) AS pages FROM p)
SELECT series_id, pages, round(pages * 300.0::DOUBLE / 10000, 1) AS report_hours, round(pages * 0.03::DOUBLE, 2) AS crawl_hours, round(pages / 33.33::DOUBLE, 1) AS audit_hours, round(pages * 250.0::DOUBLE / 9600, 2) AS outreach_hours, round(pages * 300.0::DOUBLE / 9600, 2) AS combined_hours,
 {sql_ladder('n', models.SERIES_TYPES['crawl'][0], models.SERIES_TYPES['crawl'][1])} AS crawl_type, {sql_ladder('n', models.SERIES_TYPES['report'][0], 'Standalone')} AS report_type, CASE WHEN n <= 1 THEN 'Standalone' WHEN n <= 3 THEN 'Short Series' WHEN n <= 7 THEN 'Series' ELSE 'Long Series' END AS outreach_type,
 {sql_ladder('n', models.SERIES_TYPES['enrichment'][0], None)} AS enrichment_type, {sql_ladder('n', models.SERIES_TYPES['discovery'][0], 'Series')} AS discovery_type FROM f""",
)
def length_estimates(t: Tables) -> DataFrame:
    per = books(t).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.sum("pages").alias("p"))
    filled = per.select("series_id", "n", L.fill_pages("p", "n").alias("pages"))
    return filled.select(
        "series_id",
        "pages",
        *[L.hours("pages", rule).alias(f"{rule}_hours") for rule in models.HOURS_FORMULAS],
        *[L.series_type("n", rule).alias(f"{rule}_type") for rule in ("crawl", "report", "outreach", "enrichment", "discovery")],
    )


@query(
    "retention_and_signals",
    f"""WITH {BOOKS}, {_FIRST}, {_LAST_DATE}, x AS (SELECT series_id, CASE WHEN first_count > 20000 THEN 30 ELSE last_count END AS last_count, first_count, last_day, coalesce(CASE WHEN first_count > 100 THEN first_count END, 0) AS hours FROM first JOIN last USING (series_id))
SELECT series_id, CASE WHEN NOT (first_count > 10000 AND last_count < first_count * 0.01) THEN round(last_count / first_count, 4) END AS ratio,
 CASE WHEN first_count > 10000 AND last_count < first_count * 0.01 THEN 'DATA_SCALE_MISMATCH' WHEN round(last_count / first_count, 4) >= 0.5 THEN 'STRONG' WHEN round(last_count / first_count, 4) >= 0.3 THEN 'MODERATE' ELSE 'WEAK' END AS quality,
 CASE WHEN DATE '2022-06-01' - last_day < 90 THEN 1.5::DOUBLE WHEN DATE '2022-06-01' - last_day < 180 THEN 1.3::DOUBLE WHEN DATE '2022-06-01' - last_day < 365 THEN 1.15::DOUBLE ELSE 1.0::DOUBLE END AS factor,
 CASE WHEN year(last_day) >= 2021 THEN 'After 2020' WHEN year(last_day) >= 2015 THEN '2015-2020' ELSE 'Before 2015' END AS era3,
 CASE WHEN first_count >= 20000 THEN 'Tier 1' WHEN first_count >= 5000 THEN 'Tier 2' ELSE 'Tier 3' END AS category, CASE WHEN first_count >= 5000 THEN CASE WHEN first_count >= 25000 THEN 'Meaningful audience' ELSE 'Moderate audience' END WHEN first_count > 0 THEN 'Niche audience' END AS audience,
 CASE WHEN hours >= 40 AND first_count >= 2000 THEN 'READY' WHEN hours >= 40 THEN 'READY (low ratings)' WHEN hours > 0 THEN 'BELOW LENGTH THRESHOLD' ELSE 'MISSING DATA' END AS status, CASE WHEN regexp_matches(CAST(last_day AS VARCHAR), '2026|2025|2024|2023') THEN 'Recent' WHEN regexp_matches(CAST(last_day AS VARCHAR), '2022|2021|2020|2019|2018') THEN 'Midlist backlist' ELSE 'Older backlist' END AS recency FROM x""",
)
def retention_and_signals(t: Tables) -> DataFrame:
    r = R.series_rollup(books(t), ["series_id"], last_by="date")
    x = r.select(
        "series_id", F.when(F.col("first_count") > 20000, F.lit(30)).otherwise(F.col("last_count")).alias("last_count"), "first_count", "last_day",
        F.when(F.col("first_count") > 100, F.col("first_count")).otherwise(0).alias("hours"),
    )
    kept = L.retention("last_count", "first_count")
    return x.select(
        "series_id",
        kept["ratio"].alias("ratio"),
        kept["quality"].alias("quality"),
        L.recency_factor("last_day", F.lit("2022-06-01").cast("date"))["factor"].alias("factor"),
        L.series_era(L.pub_year("last_day"), "three").alias("era3"),
        L.rating_category("first_count").alias("category"),
        L.audience_signal("first_count").alias("audience"),
        L.outreach_status("hours", "first_count", F.lit(True)).alias("status"),
        L.recency_signal(F.col("last_day").cast("string")).alias("recency"),
    )


@query(
    "hours_discrepancy",
    """WITH h AS (SELECT o_orderkey, o_totalprice / 1000 AS calculated, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN o_totalprice / 1050 ELSE o_totalprice / 1200 END AS stated FROM orders)
SELECT o_orderkey, round(coalesce(stated, calculated), 6) AS hours, coalesce(abs(calculated - stated) / stated > 0.10, false) AS differs FROM h""",
)
def hours_discrepancy(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    stated = F.when(F.col("o_orderstatus") == "F", price / 1050).when(F.col("o_orderstatus") == "O", price / 1200)
    both = L.hours_discrepancy(price / 1000, stated)
    return t.orders.select("o_orderkey", F.round(both["hours"], 6).alias("hours"), both["differs"].alias("differs"))


@query(
    "publication_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
)
def publication_dates(t: Tables) -> DataFrame:
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "MMMM d, yyyy"))
        .otherwise(F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" ")))
    )
    return t.orders.select("o_orderkey", L.pub_date(text).alias("day"), L.pub_year(text).alias("year"))


def _ladder_sql() -> tuple[str, str]:
    """CTE columns of the additive model over the rolled series, and its flags."""
    step = models.LADDER_SCORE
    low = "CASE WHEN coalesce(lowest_rating, 0) <= 0 THEN coalesce(first_rating, 0) * 0.8::DOUBLE ELSE lowest_rating END"
    parts = f"""SELECT *, coalesce(round(total_pages * 300.0::DOUBLE / 10000, 1), 0) AS h, coalesce(first_rating, 0) AS fr, {low} AS lo, {_ERA} AS era FROM s"""
    both = "(coalesce(highest_rating, 0) > 0 AND lo > 0)"
    diff = "abs(highest_rating - lo)"
    points = f"""SELECT *, CASE WHEN {both} THEN {diff} END AS diff, {sql_ladder('h', *step['hours'])} + {sql_ladder('fr', *step['first_rating'])} + {sql_ladder('first_count', *step['first_count'])} + {sql_ladder('lo', *step['lowest_rating'])}
 + {sql_ladder('books', *step['books'])} + CASE WHEN NOT {both} THEN 5 WHEN {diff} < 0.2 THEN 10 WHEN {diff} < 0.4 THEN 8 WHEN {diff} < 0.6 THEN 6 WHEN {diff} < 0.8 THEN 4 ELSE 2 END
 + CASE WHEN contains(era, '2020') THEN 10 WHEN contains(lower(era), 'before') THEN 5 ELSE 6 END"""
    return parts, points


_PARTS, _POINTS = _ladder_sql()
_BONUS = "CASE WHEN contains(lower(publisher), 'penguin') THEN 3 ELSE 0 END"


@query(
    "ladder_score",
    f"""WITH {BOOKS}, {_ROLLED}, a AS ({_PARTS}), b AS ({_POINTS} + {_BONUS} AS score FROM a)
SELECT series_id, CAST(score AS INTEGER) AS score, {sql_ladder('score', *models.LADDER_RANKS)} AS rank, {sql_ladder('h', *models.LOWER_FLAGS['adaptation_length'])} AS length_flag, {sql_ladder('fr', *models.LOWER_FLAGS['first_rating'])} AS first_rating_flag,
 CASE WHEN fr >= 4.2 AND first_count >= 5000 THEN 'High' WHEN fr >= 3.8 OR first_count >= 1000 THEN 'Medium' ELSE 'Low' END AS appeal_flag, {sql_ladder('lo', *models.LOWER_FLAGS['lowest_rating'])} AS lowest_flag,
 CASE WHEN diff IS NULL THEN 'Stable' WHEN diff < 0.3 THEN 'Very Stable' WHEN diff < 0.5 THEN 'Stable' ELSE 'Variable' END AS stability_flag FROM b""",
)
def ladder_score(t: Tables) -> DataFrame:
    s = rolled(t).withColumn("hours", L.hours("total_pages", "report"))
    praise = F.when(F.lower("publisher").contains("penguin"), F.lit("NYT Bestseller")).otherwise(F.lit(""))
    scored = SC.ladder_score(s, "hours", "first_rating", "first_count", "lowest_rating", "highest_rating", "era", "books", praise)
    flagged = SC.with_fields(scored, SC.ladder_flags("hours", "first_rating", "first_count", "rating_difference", "effective_lowest"))
    return flagged.select("series_id", "score", "rank", "length_flag", "first_rating_flag", "appeal_flag", "lowest_flag", "stability_flag")


_W = models.WEIGHTED


def _doubt(x: str) -> str:
    return f"(CASE WHEN {x} < 0.1 THEN 80.0::DOUBLE ELSE {x} END)"


_WEIGHTED_SQL = f"""round(({_doubt('least(coalesce(first_rating, 0) / 5.0::DOUBLE, 1.0::DOUBLE) * 100')} * 0.15::DOUBLE + {_doubt('least(coalesce(avg_rating, 0) / 5.0::DOUBLE, 1.0::DOUBLE) * 100')} * 0.10::DOUBLE
 + {_doubt('least(least(CASE WHEN first_count > 0 THEN last_count / first_count ELSE 0 END * factor, 1.0::DOUBLE) / 0.5::DOUBLE, 1.0::DOUBLE) * 100')} * 0.25::DOUBLE + {_doubt('least(first_count / 10000.0::DOUBLE, 1.0::DOUBLE) * 100')} * 0.20::DOUBLE
 + (CASE WHEN books = 1 THEN 40.0::DOUBLE WHEN books < 3 THEN 60.0::DOUBLE WHEN books <= 5 THEN 85.0::DOUBLE ELSE 100.0::DOUBLE END) * 0.30::DOUBLE) * CASE WHEN independent THEN 1.20::DOUBLE ELSE 1.0::DOUBLE END, 6)"""
_FACTOR = "CASE WHEN DATE '2022-06-01' - last_day < 90 THEN 1.5::DOUBLE WHEN DATE '2022-06-01' - last_day < 180 THEN 1.3::DOUBLE WHEN DATE '2022-06-01' - last_day < 365 THEN 1.15::DOUBLE ELSE 1.0::DOUBLE END"
_RECENCY = "CASE WHEN DATE '2022-06-01' - last_day < 90 THEN 'New Release (<3mo)' WHEN DATE '2022-06-01' - last_day < 180 THEN 'Recent (<6mo)' WHEN DATE '2022-06-01' - last_day < 365 THEN 'Modern (<1yr)' ELSE 'Mature' END"


@query(
    "weighted_score",
    f"""WITH {BOOKS}, {_FIRST}, {_LAST_DATE}, {_PUB}, g AS (SELECT series_id, count(*) AS books, avg(rating) AS avg_rating FROM books GROUP BY 1),
x AS (SELECT *, publisher <> 'Penguin Random House' AS independent, {_FACTOR} AS factor, {_RECENCY} AS recency FROM g JOIN first USING (series_id) JOIN last USING (series_id) JOIN pub USING (series_id)), w AS (SELECT *, {_WEIGHTED_SQL} AS score FROM x)
SELECT series_id, score, {sql_ladder('score', *models.WEIGHTED_RANKS)} AS rank, recency FROM w""",
)
def weighted_score(t: Tables) -> DataFrame:
    s = R.series_rollup(books(t), ["series_id"], last_by="date")
    scored = SC.weighted_score(
        s, "books", "first_rating", "avg_rating", "first_count", "last_count", "last_day", F.lit("2022-06-01").cast("date"), None,
        publisher_class("publisher", "Indie") != "Big Pub",
    )
    return scored.select("series_id", "score", "rank", "recency")


@query(
    "penalty_score",
    f"""WITH {BOOKS}, {_ROLLED}, x AS (SELECT *, round(0.30::DOUBLE * least(books / 8.0::DOUBLE * 100, 100.0::DOUBLE) + 0.25::DOUBLE * CASE WHEN first_rating > 0 THEN first_rating / 5.0::DOUBLE * 100 ELSE 80.0::DOUBLE END + 0.25::DOUBLE * CASE WHEN first_count > 0 AND last_count > 0 THEN least(last_count / first_count * 100, 100.0::DOUBLE) ELSE 80.0::DOUBLE END
 + 0.20::DOUBLE * CASE WHEN first_count > 0 THEN least(first_count / 1000.0::DOUBLE * 10, 100.0::DOUBLE) ELSE 80.0::DOUBLE END, 6) AS total, total_pages * 0.03::DOUBLE AS h, 1 - (highest_rating - lowest_rating) AS st FROM s)
SELECT series_id, round(total, 4) AS total, CASE WHEN books < 3 THEN 'P5' ELSE {sql_ladder('total', *models.PENALTY_RANKS)} END AS rank, {_upper('round(h, 2)', *models.UPPER_FLAGS['hours'])} AS length_flag, {_upper('first_rating', *models.UPPER_FLAGS['first_rating'])} AS first_rating_flag,
 {_upper('first_count', *models.UPPER_FLAGS['first_count'])} AS appeal_flag, {_upper('lowest_rating', *models.UPPER_FLAGS['lowest_rating'])} AS lowest_flag, {_upper('st', *models.UPPER_FLAGS['stability'])} AS stability_flag FROM x""".replace(
        "SELECT series_id, round(total, 4) AS total,", "SELECT series_id,"
    ),
)
def penalty_score(t: Tables) -> DataFrame:
    s = rolled(t).withColumn("hours", L.hours("total_pages", "crawl"))
    scored = SC.penalty_score(s, "books", "first_rating", "first_count", "last_count")
    flagged = SC.with_fields(scored, SC.crawl_flags("hours", "first_rating", "first_count", "lowest_rating", "highest_rating"))
    return flagged.select("series_id", "rank", "length_flag", "first_rating_flag", "appeal_flag", "lowest_flag", "stability_flag")


@query(
    "bucket_score",
    f"""WITH {BOOKS}, {_ROLLED}, x AS (SELECT *, CASE WHEN first_count > 20000 THEN 'Amazon Top 10' WHEN first_count > 10000 THEN 'Top 50' WHEN first_count > 5000 THEN 'Sports Top 100' ELSE 'No List' END AS bucket, {_ERA} AS era FROM s),
p AS (SELECT *, CASE bucket WHEN 'Amazon Top 10' THEN 15 WHEN 'Top 50' THEN 10 WHEN 'Sports Top 100' THEN 5 ELSE 0 END + CASE WHEN first_rating IS NULL THEN 20 WHEN first_rating > 4.5 THEN 25 WHEN first_rating >= 4.2 THEN 20 WHEN first_rating >= 4.0 THEN 15 WHEN first_rating >= 3.8 THEN 10 WHEN first_rating >= 3.5 THEN 5 ELSE 0 END
 + CASE WHEN first_count > 20000 THEN 30 WHEN first_count > 10000 THEN 25 WHEN first_count >= 5000 THEN 18 WHEN first_count >= 1000 THEN 10 WHEN first_count > 0 THEN 8 ELSE 24 END + CASE WHEN first_rating IS NULL OR last_rating IS NULL THEN 8 WHEN last_rating - first_rating >= -0.1::DOUBLE THEN 10 ELSE 0 END
 + CASE WHEN last_count / first_count > 0.6 THEN 10 WHEN last_count / first_count > 0.4 THEN 5 ELSE 0 END + CASE WHEN era = 'After 2020' THEN 10 WHEN era = 'Before 2020' THEN 5 ELSE 8 END AS points FROM x)
SELECT series_id, CAST(least(points, 100) AS INTEGER) AS score, CASE WHEN books <= 3 THEN 'P5' WHEN publisher <> 'Independently Published' AND points >= 48 THEN 'P2' ELSE {sql_ladder('points', *models.BUCKET_RANKS)} END AS rank FROM p""",
)
def bucket_score(t: Tables) -> DataFrame:
    n = F.col("first_count")
    bucket = F.when(n > 20000, F.lit("Amazon Top 10")).when(n > 10000, F.lit("Top 50")).when(n > 5000, F.lit("Sports Top 100")).otherwise(F.lit("No List"))
    s = rolled(t).withColumns({"bucket": bucket, "kind": L.series_type("books", "commissioning")})
    scored = s.withColumn("score", SC.bucket_score("bucket", "first_rating", "first_count", "last_rating", "last_count", "era"))
    publisher = F.when(F.col("publisher") == "Independently Published", F.lit("Indie")).otherwise(F.col("publisher"))
    return scored.select("series_id", "score", SC.bucket_rank("score", "kind", publisher, F.lit("Some Writer")).alias("rank"))


def _missing_ladder(x: str, name: str) -> str:
    return f"CASE WHEN coalesce({x}, 0) <> 0 THEN {sql_ladder(x, *models.EXPANSION[name])} ELSE 0 END"


@query(
    "expansion_score",
    f"""WITH {BOOKS}, {_ROLLED}, x AS (SELECT series_id, nullif({_missing_ladder('round(total_pages * 300.0::DOUBLE / 10000, 1)', 'hours')} + {_missing_ladder('first_rating', 'first_rating')} + {_missing_ladder('first_count', 'first_count')} + {_missing_ladder('lowest_rating', 'lowest_rating')} + {_missing_ladder('first_year', 'pub_year')}, 0) AS score FROM s)
SELECT series_id, CAST(score AS INTEGER) AS score, {sql_ladder('score', *models.EXPANSION_RANKS)} AS rank FROM x""",
)
def expansion_score(t: Tables) -> DataFrame:
    s = rolled(t).withColumn("hours", L.hours("total_pages", "report"))
    return SC.expansion_score(s, "hours", "first_rating", "first_count", "lowest_rating", "first_year").select("series_id", "score", "rank")


@query(
    "quality_flags",
    f"""WITH {BOOKS}, {_FIRST}, {_LAST}, g AS (SELECT series_id, count(*) AS n, CAST(sum(pages) AS BIGINT) AS p FROM books GROUP BY 1), x AS (SELECT series_id, n, p, CASE WHEN n > 6 THEN 'Standalone' ELSE 'Series' END AS kind, lower(first_title) AS f, lower(last_title) AS l FROM g JOIN first USING (series_id) JOIN last USING (series_id)),
i AS (SELECT *, list_filter([CASE WHEN kind = 'Standalone' AND n > 1 THEN 'TYPE_MISMATCH' END, CASE WHEN f = l AND n > 1 THEN 'SAME_FIRST_LAST' END, CASE WHEN p IN (0, 1) THEN 'PAGES_ZERO' END, CASE WHEN p NOT IN (0, 1) AND p / n < 50 THEN 'PAGES_LOW' END, CASE WHEN p / n > 900 THEN 'PAGES_HIGH' END,
 CASE WHEN p = n * 300 OR p = n * 250 THEN 'PAGES_FORMULA' END], lambda v: v IS NOT NULL) AS issues FROM x)
SELECT series_id, array_to_string(issues, ' | ') AS issues, CASE WHEN list_has_any(issues, ['TYPE_MISMATCH', 'SAME_FIRST_LAST', 'PAGES_ZERO']) OR len(issues) >= 3 THEN 'RED' WHEN len(issues) > 0 THEN 'YELLOW' ELSE 'GREEN' END AS flag,
 CASE WHEN list_has_any(issues, ['TYPE_MISMATCH', 'SAME_FIRST_LAST', 'PAGES_ZERO']) OR n < 2 THEN 'RED' WHEN list_contains(issues, 'PAGES_FORMULA') OR n % 2 = 0 THEN 'YELLOW' ELSE 'GREEN' END AS final_flag,
 CASE WHEN list_has_any(issues, ['TYPE_MISMATCH', 'SAME_FIRST_LAST', 'PAGES_ZERO']) OR len(issues) >= 3 THEN 'RED' ELSE 'YELLOW' END AS worst FROM i""",
)
def quality_flags(t: Tables) -> DataFrame:
    s = R.series_rollup(books(t), ["series_id"])
    kind = F.when(F.col("books") > 6, F.lit("Standalone")).otherwise(F.lit("Series"))
    issues = SC.sanity_issues(kind, "books", "books", "total_pages", F.lit("Some Series"), "first_title", "last_title")
    marked = s.select("series_id", "books", issues.alias("i")).withColumn("flag", SC.quality_flag("i"))
    return marked.select(
        "series_id",
        F.array_join("i", " | ").alias("issues"),
        "flag",
        SC.final_quality_flag("i", F.col("books") >= 2, F.pmod("books", F.lit(2)) == 1).alias("final_flag"),
        SC.worst_flag("flag", F.lit("yellow")).alias("worst"),
    )


@query(
    "imprint_verdicts",
    """WITH x AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Tantor Audio' WHEN 'PROMO' THEN 'Oak House' WHEN 'LARGE' THEN 'HighBridge' END AS pub, CASE WHEN p_size > 25 THEN 'high' ELSE 'low' END AS conf, CASE WHEN p_type = 'SMALL' THEN 'Dreamscape Media' END AS sup FROM part)
SELECT p_partkey, CASE WHEN conf = 'high' AND pub IN ('Tantor Audio', 'HighBridge') THEN 'yes' WHEN conf = 'high' AND pub = 'Oak House' THEN 'no' END AS flag, CASE WHEN pub = 'Tantor Audio' THEN 'Tantor Media' WHEN pub = 'HighBridge' THEN 'HighBridge' WHEN pub IS NULL AND sup IS NOT NULL THEN 'Dreamscape' END AS imprint,
 CASE WHEN conf = 'high' AND pub IN ('Tantor Audio', 'HighBridge') THEN 'confirmed_yes' WHEN conf = 'high' AND pub = 'Oak House' THEN 'confirmed_no' ELSE 'needs_review' END AS status FROM x""",
)
def imprint_verdicts(t: Tables) -> DataFrame:
    publisher = F.when(F.col("p_type") == "ECONOMY", F.lit("Tantor Audio")).when(F.col("p_type") == "PROMO", F.lit("Oak House")).when(F.col("p_type") == "LARGE", F.lit("HighBridge"))
    sure = F.when(F.col("p_size") > 25, F.lit("high")).otherwise(F.lit("low"))
    support = F.when(F.col("p_type") == "SMALL", F.lit("Dreamscape Media"))
    return t.part.select("p_partkey", SC.imprint_verdict(publisher, sure, F.lit("shop"), support).alias("v")).select("p_partkey", "v.*")


@query(
    "completeness",
    f"""WITH {BOOKS} SELECT series_id, book_id, book_number, (rating IS NOT NULL)::INT + (pages IS NOT NULL)::INT + 1 AS filled, CASE WHEN rating IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN pages IS NOT NULL THEN 3 ELSE 0 END + 1 AS weighted FROM books""",
)
def completeness(t: Tables) -> DataFrame:
    columns = ["rating", "pages", "publisher"]
    return books(t).select(
        "series_id", "book_id", "book_number", SC.completeness(columns).alias("filled"), SC.completeness(columns, {"rating": 5, "pages": 3}).alias("weighted")
    )


@query(
    "rationales",
    f"""WITH {BOOKS}, {_FIRST}, g AS (SELECT series_id, count(*) AS n FROM books GROUP BY 1)
SELECT series_id, 'P1: ' || CASE WHEN first_rating > 0 THEN printf('%.1f', round(first_rating, 1)) ELSE 'N/A' END || '* (' || CASE WHEN first_count >= 1000 THEN printf('%.1fk', round(first_count / 1000.0::DOUBLE, 1)) ELSE CAST(first_count AS VARCHAR) END || ' ratings), ' || n || ' books, ' || CASE WHEN n > 4 THEN 'After 2020' ELSE 'Unknown era' END || CASE WHEN n > 6 THEN '. NYT Bestseller' ELSE '' END AS line FROM g JOIN first USING (series_id)""",
)
def rationales(t: Tables) -> DataFrame:
    s = rolled(t)
    era = F.when(F.col("books") > 4, F.lit("After 2020")).otherwise(F.lit("nan"))
    praise = F.when(F.col("books") > 6, F.lit("NYT Bestseller")).otherwise(F.lit(""))
    return s.select("series_id", rationale(F.lit("P1"), "first_rating", "first_count", "books", era, praise).alias("line"))


_CHECK_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("event_id", "ts", "user_id", "event_type", "value", "props", "url")])


@query(
    "validation_report",
    """SELECT 'WARNING' AS severity, 'url' AS field, 'missing column' AS check, 1::BIGINT AS n, '' AS sample
UNION ALL SELECT 'INFO', 'mail', 'unknown column', 1, ''
UNION ALL SELECT 'CRITICAL', 'series', 'required column missing', 1, ''
UNION ALL SELECT 'ERROR', 'event_type', 'required', count(*), '' FROM events WHERE event_type = 'error' UNION ALL SELECT 'ERROR', 'value', 'outside 1 to 30', count(*), min(value) || '|' || max(value) FROM events WHERE value < 1 OR value > 30
UNION ALL SELECT 'ERROR', 'props', 'not a number', count(*), min(props) || '|' || max(props) FROM events UNION ALL SELECT 'WARNING', 'user_id', 'duplicates', sum(n)::BIGINT, '' FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 1)
UNION ALL SELECT 'WARNING', 'props', 'unexpected form', count(*), min(props) || '|' || max(props) FROM events WHERE NOT regexp_matches(props, '^\\{"k": [0-9]\\}')""",
)
def validation_report(t: Tables) -> DataFrame:
    rows = t.events.withColumn("event_type", F.when(F.col("event_type") == "error", F.lit(" ")).otherwise(F.col("event_type"))).withColumn("mail", F.lit("x"))
    checks = [
        Q.recommended("props"), Q.numeric("props"), Q.numeric("value"), Q.not_negative("value"), Q.in_range("value", 1, 30),
        Q.matches("props", '\\{"k": [0-9]\\}'),
    ]
    keys = ["user_id", F.when(F.trim("event_type") == "", F.lit("error")).otherwise(F.col("event_type"))]
    report = Q.run_all(rows, _CHECK_SCHEMA, checks, keys, "user_id", ["event_type", "series"])
    return report.withColumn("sample", F.array_join("sample", "|"))


@query(
    "report_validity",
    """SELECT 'range' AS report, count(*) FILTER (value < 1 OR value > 30 OR trim(event_type) = '') = 0 AS valid FROM events
UNION ALL SELECT 'sign', count(*) FILTER (value < 0 OR trim(event_type) = '') = 0 FROM events
UNION ALL SELECT 'columns', count(*) = 2 FROM (DESCRIBE events) WHERE column_name IN ('event_type', 'series')""",
)
def report_validity(t: Tables) -> DataFrame:
    """A value out of range, a clean table, and a clean table that lacks a required column."""
    keys, schema = ["event_id"], t.events.schema
    reports = {
        "range": Q.run_checks(t.events, [Q.in_range("value", 1, 30), Q.required("event_type")]),
        "sign": Q.run_checks(t.events, [Q.not_negative("value"), Q.required("event_type")]),
        "columns": Q.run_all(t.events, schema, [Q.not_negative("value")], keys, "event_id", ["event_type", "series"]),
    }
    rows = [Q.is_valid(report).select(F.lit(name).alias("report"), "valid") for name, report in reports.items()]
    return rows[0].union(rows[1]).union(rows[2])


@query(
    "rating_repairs",
    f"""WITH {BOOKS} SELECT series_id, book_id, book_number, CASE WHEN rating = 5.0 AND rating_count > 20 THEN CASE WHEN pages > 100 THEN 3.9::DOUBLE ELSE 4.5::DOUBLE END ELSE rating END AS rating FROM books""",
)
def rating_repairs(t: Tables) -> DataFrame:
    other = F.when(F.col("pages") > 100, 3.9)
    return books(t).select("series_id", "book_id", "book_number", Q.repaired_rating("rating", "rating_count", other).alias("rating"))


@query(
    "count_anomalies",
    f"""WITH {BOOKS}, c AS (SELECT series_id, CAST(sum(rating_count) AS BIGINT) AS a, CAST(sum(pages) * 50 AS BIGINT) AS b FROM books GROUP BY 1) SELECT series_id, 'first >> second' AS reason FROM c WHERE a > 0 AND b > 0 AND a > b * 1.5 UNION ALL SELECT series_id, 'round number estimate' FROM c WHERE a > 1000 AND b > 0 AND a % 500 = 0""",
)
def count_anomalies(t: Tables) -> DataFrame:
    c = books(t).groupBy("series_id").agg(F.sum("rating_count").alias("a"), (F.sum("pages") * 50).alias("b"))
    return Q.count_anomalies(c, "a", "b").select("series_id", "reason")


@query(
    "contradiction_repairs",
    """WITH b AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Iron' ELSE 'Forge' END AS series, 'iron' AS first_book, CASE WHEN o_orderpriority LIKE '1%' THEN ' IRON' ELSE 'Last' END AS last_book, CASE WHEN o_orderpriority LIKE '2%' THEN 'Standalone' ELSE 'Series' END AS kind, o_orderkey % 4 AS n, CASE WHEN o_totalprice > 250000 THEN 'Verified' END AS v FROM orders)
SELECT o_orderkey, CASE WHEN series = 'Iron' AND v IS NOT NULL THEN v ELSE series END AS series, CASE WHEN last_book = ' IRON' AND n > 1 THEN NULL ELSE last_book END AS last_book, CASE WHEN kind = 'Standalone' AND n > 1 THEN 'Short Series' ELSE kind END AS kind FROM b""",
)
def contradiction_repairs(t: Tables) -> DataFrame:
    first = F.substring("o_orderpriority", 1, 1)
    rows = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit("Iron")).otherwise(F.lit("Forge")).alias("series"), F.lit("iron").alias("first_book"),
        F.when(first == "1", F.lit(" IRON")).otherwise(F.lit("Last")).alias("last_book"), F.when(first == "2", F.lit("Standalone")).otherwise(F.lit("Series")).alias("kind"),
        F.pmod("o_orderkey", F.lit(4)).alias("n"), F.when(F.col("o_totalprice") > 250000, F.lit("Verified")).alias("verified"),
    )
    out = Q.repair_contradictions(rows, "series", "verified", "first_book", "last_book", "kind", "n", L.series_type("n", "outreach"))
    return out.select("o_orderkey", "series", "last_book", "kind")


@query(
    "gap_triggers",
    f"""WITH {BOOKS}, m AS (SELECT round((count(*) - count(rating)) / count(*)::DOUBLE, 6) AS r, round((count(*) - count(pages)) / count(*)::DOUBLE, 6) AS p FROM books)
SELECT 'recovery' AS phase, 'store_rating' AS gap, r AS missing_share, 0.10::DOUBLE AS threshold, r > 0.10 AS run, r < 0.02 AS converged FROM m UNION ALL SELECT 'series_bulk', 'review_rating', r, 0.10::DOUBLE, r > 0.10, r < 0.02 FROM m
UNION ALL SELECT 'detailed', 'pages', p, 0.10::DOUBLE, p > 0.10, p < 0.02 FROM m UNION ALL SELECT 'detailed', 'publisher', 0.0::DOUBLE, 0.10::DOUBLE, false, true""",
)
def gap_triggers(t: Tables) -> DataFrame:
    return Q.gap_triggers(books(t), {"store_rating": "rating", "review_rating": "rating", "pages": "pages", "publisher": "publisher"})


_MASTER = f"""WITH {BOOKS}, {RANK_LIST}, {_ROLLED}, m AS (SELECT s.*, o_custkey, o_orderpriority AS subgenre FROM s JOIN orders ON o_orderkey = series_id),
l AS (SELECT list_id, list_name, rank, 'Book ' || list_id AS title FROM rank_list),
o AS (SELECT first_title, min(series_id) AS o FROM m GROUP BY 1),
e AS (SELECT l.list_id, m.series_id FROM m JOIN l ON m.first_title = l.title), f1 AS (SELECT list_id, arg_min(first_title, o) AS first_title FROM l JOIN o ON length(first_title) > 5 AND (contains(l.title, first_title) OR contains(first_title, l.title)) WHERE length(l.title) > 8 AND list_id NOT IN (SELECT list_id FROM e) GROUP BY 1),
mt AS (SELECT * FROM e UNION SELECT f1.list_id, m.series_id FROM f1 JOIN m USING (first_title)),
tg AS (SELECT mt.series_id, string_agg(DISTINCT 'Amazon ' || CASE WHEN l.rank <= 10 THEN 'Top 10' WHEN l.rank <= 50 THEN 'Top 50' ELSE 'Top 100' END || ' ' || list_name, '; ' ORDER BY 'Amazon ' || CASE WHEN l.rank <= 10 THEN 'Top 10' WHEN l.rank <= 50 THEN 'Top 50' ELSE 'Top 100' END || ' ' || list_name) AS list_tag, min(l.rank) AS best_rank FROM mt JOIN l USING (list_id) GROUP BY 1),
a AS (SELECT m.*, list_tag, best_rank, coalesce(round(total_pages * 300.0::DOUBLE / 10000, 1), 0) AS h, coalesce(first_rating, 0) AS fr, CASE WHEN coalesce(lowest_rating, 0) <= 0 THEN coalesce(first_rating, 0) * 0.8::DOUBLE ELSE lowest_rating END AS lo, {_ERA} AS era FROM m LEFT JOIN tg USING (series_id)),
b AS ({_POINTS} + CASE WHEN contains(list_tag, 'Top 10 ') THEN 3 WHEN contains(list_tag, 'Top 50 ') THEN 2 WHEN contains(list_tag, 'Top 100 ') THEN 1 ELSE 0 END AS score FROM a)"""


@query(
    "series_master",
    f"""{_MASTER}
SELECT series_id AS row_id, subgenre, CAST(score AS INTEGER) AS score, {sql_ladder('score', *models.LADDER_RANKS)} AS rank, list_tag, best_rank, {sql_ladder('h', *models.LOWER_FLAGS['adaptation_length'])} AS length_flag,
 CASE WHEN diff IS NULL THEN 'Stable' WHEN diff < 0.3 THEN 'Very Stable' WHEN diff < 0.5 THEN 'Stable' ELSE 'Variable' END AS stability_flag,
 {sql_ladder('score', *models.LADDER_RANKS)} || ': ' || CASE WHEN fr > 0 THEN printf('%.1f', round(fr, 1)) ELSE 'N/A' END || '* (' || CASE WHEN first_count >= 1000 THEN printf('%.1fk', round(first_count / 1000.0::DOUBLE, 1)) ELSE CAST(first_count AS VARCHAR) END || ' ratings), ' || books || ' books, ' || era AS rationale FROM b""",
)
def flagship(t: Tables) -> DataFrame:
    s = rolled(t).withColumn("hours", L.hours("total_pages", "report"))
    owner = t.orders.select(F.col("o_orderkey").alias("series_id"), F.col("o_custkey"), F.col("o_orderpriority").alias("subgenre"))
    master = s.join(owner, "series_id").withColumns(
        {
            "row_id": F.col("series_id"),
            "series_name": F.concat(F.lit("Series "), F.col("series_id")),
            "author": F.concat(F.lit("Customer "), F.col("o_custkey")),
            "validation": F.lit(""),
        }
    )
    listed = rank_list(t).withColumns({"title": F.concat(F.lit("Book "), F.col("list_id")), "author": F.lit("")})
    scored = series_master.sorted_master(series_master.score_master(master, listed))
    return scored.select("row_id", "subgenre", "score", "rank", "list_tag", "best_rank", "length_flag", "stability_flag", "rationale")


_POSITION = "series_id, book_number, book_id"


@query(
    "series_report",
    f"""WITH {BOOKS}, d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id, title ORDER BY (rating IS NOT NULL)::INT + (pages IS NOT NULL)::INT DESC, {_POSITION}) AS rn FROM books) WHERE rn = 1),
books2 AS (SELECT * EXCLUDE rn FROM d), {_FIRST.replace('FROM books WHERE', 'FROM books2 WHERE')}, {_LAST_DATE.replace('FROM books WHERE', 'FROM books2 WHERE')}, {_PUB.replace('FROM books)', 'FROM books2)')},
g AS (SELECT series_id, count(*) AS books, avg(rating) AS avg_rating, CAST(sum(coalesce(nullif(pages, 0), 300)) AS BIGINT) AS total_pages FROM books2 GROUP BY 1),
x AS (SELECT *, publisher <> 'Penguin Random House' AS independent, {_FACTOR} AS factor FROM g JOIN first USING (series_id) JOIN last USING (series_id) JOIN pub USING (series_id)), w AS (SELECT *, {_WEIGHTED_SQL} AS score FROM x)
SELECT 'series ' || series_id AS series_key, books, round(total_pages * 300.0::DOUBLE / 10000, 1) AS hours, {sql_ladder('books', models.SERIES_TYPES['report'][0], 'Standalone')} AS type, score, {sql_ladder('score', *models.WEIGHTED_RANKS)} AS rank FROM w""",
)
def series_report(t: Tables) -> DataFrame:
    b = books(t).withColumns({"subgenre": F.lit("Drama"), "book_id": F.struct("series_id", "book_number", "book_id")})
    report = book_report.series_report(b, "2022-06-01")
    return book_report.sorted_report(report).select("series_key", "books", "hours", "type", "score", "rank")


@query(
    "genre_series",
    f"""WITH {BOOKS}, {RANK_LIST}, o AS (SELECT books.*, 'Writer ' || author_id AS author, o_orderpriority AS subgenre, CASE WHEN publisher = 'Penguin Random House' THEN 0 ELSE 1 END AS source FROM books JOIN orders ON o_orderkey = series_id),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title, author ORDER BY source, {_POSITION}) AS rn FROM o) WHERE rn = 1),
v AS (SELECT DISTINCT title, author FROM o WHERE rating_count > 24000), k AS (SELECT d.*, CASE WHEN pages IS NULL THEN lower(d.title) || '|||' || lower(d.author) || '|||standalone' ELSE lower(series_name) || '|||' || lower(d.author) END AS series_key FROM d WHERE (title, author) NOT IN (SELECT (title, author) FROM v)),
r AS (SELECT *, row_number() OVER (PARTITION BY subgenre, series_key ORDER BY book_number, {_POSITION}) AS a, row_number() OVER (PARTITION BY subgenre, series_key ORDER BY book_number DESC, series_id DESC, book_id DESC) AS z FROM k),
g AS (SELECT subgenre, series_key, count(*) AS books, sum(pages) AS p, max(rating) FILTER (a = 1) AS first_rating, max(rating_count) FILTER (a = 1) AS first_count, max(rating_count) FILTER (z = 1) AS last_count, max(publisher) FILTER (a = 1) AS publisher FROM r GROUP BY 1, 2),
n AS (SELECT DISTINCT title FROM k), fl AS (SELECT DISTINCT n.title, '# ' || CASE WHEN rank <= 10 THEN 'Top 10' WHEN rank <= 50 THEN 'Top 50' ELSE 'Top 100' END || ' ' || list_name AS flag FROM n JOIN rank_list ON contains('Book ' || list_id || ' special', n.title)),
f AS (SELECT title, string_agg(flag, ' | ' ORDER BY flag) AS flags FROM fl GROUP BY 1), e AS (SELECT subgenre, series_key, string_agg(DISTINCT flags, ' | ' ORDER BY flags) AS list_flags FROM k JOIN f USING (title) GROUP BY 1, 2),
x AS (SELECT *, round(0.30::DOUBLE * least(books / 8.0::DOUBLE * 100, 100.0::DOUBLE) + 0.25::DOUBLE * CASE WHEN first_rating > 0 THEN first_rating / 5.0::DOUBLE * 100 ELSE 80.0::DOUBLE END + 0.25::DOUBLE * least(last_count / first_count * 100, 100.0::DOUBLE) + 0.20::DOUBLE * least(first_count / 1000.0::DOUBLE * 10, 100.0::DOUBLE), 6) AS total, round(p * 0.03::DOUBLE, 2) AS h FROM g)
SELECT x.subgenre, x.series_key, books, CASE WHEN x.series_key LIKE '%|||standalone' THEN 'Standalone' ELSE {sql_ladder('books', *models.SERIES_TYPES['crawl'])} END AS type, CASE WHEN books < 3 THEN 'P5' ELSE {sql_ladder('total', *models.PENALTY_RANKS)} END AS rank,
 CASE publisher WHEN 'Independently Published' THEN 'Self-Pub' WHEN 'Penguin Random House' THEN 'Big Pub' ELSE 'Indie' END AS publisher_kind, list_flags, {_upper('h', *models.UPPER_FLAGS['hours'])} AS length_flag FROM x LEFT JOIN e ON x.subgenre = e.subgenre AND x.series_key = e.series_key""",
)
def genre_series(t: Tables) -> DataFrame:
    # joined as plain order lines, which are narrower than the books made of them
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    b = books(t, lines, F.col("o_orderpriority").alias("subgenre")).withColumns(
        {
            "author": F.concat(F.lit("Writer "), F.col("author_id")),
            "book_id": F.struct("series_id", "book_number", "book_id"),
            "series_name": F.when(F.col("pages").isNotNull(), F.col("series_name")),
        }
    )
    b = b.drop("series_id", "author_id")
    sources = [b.filter(F.col("publisher") == "Penguin Random House"), b.filter(F.col("publisher") != "Penguin Random House")]
    verdicts = b.filter("rating_count > 24000").select("title", "author").distinct().withColumn("ok", F.lit(False))
    listed = rank_list(t).withColumn("title", F.concat(F.lit("Book "), F.col("list_id"), F.lit(" special")))
    out = genre_lists.genre_series(sources, verdicts, F.col("ok"), None, listed, fields=("rating", "count"))
    return out.select("subgenre", "series_key", "books", "type", "rank", "publisher_kind", "list_flags", "length_flag")


@query(
    "outreach_master",
    f"""WITH {BOOKS}, {RANK_LIST}, {_ROLLED}, x AS (SELECT series_id AS row_id, total_pages, CASE WHEN books > 5 THEN total_pages / 30.0::DOUBLE END AS stated, round(total_pages * 250.0::DOUBLE / 9600, 2) AS calc, first_count AS r, last_count, o_custkey FROM s JOIN orders ON o_orderkey = series_id),
h AS (SELECT *, CASE WHEN stated > 0 THEN stated ELSE calc END AS h, coalesce(stated > 0 AND abs(calc - stated) / stated > 0.10, false) AS differs FROM x),
b AS (SELECT h.*, {{band}} AS b, c_acctbal > 5000 AS reachable FROM h JOIN customer ON c_custkey = o_custkey WHERE h >= 40), l AS (SELECT rank, arg_min(list_name, list_id) AS list_name FROM rank_list GROUP BY 1)
SELECT row_id, round(h, 6) AS hours, differs, b.tier AS tier, b.fee AS fee, b.share AS share, CASE WHEN r > 10000 AND last_count < r * 0.01 THEN 'DATA_SCALE_MISMATCH' WHEN round(last_count / r, 4) >= 0.5 THEN 'STRONG' WHEN round(last_count / r, 4) >= 0.3 THEN 'MODERATE' ELSE 'WEAK' END AS retention_quality,
 coalesce(list_name || ' #' || rank, 'Not Available') AS list_entry, CASE WHEN r >= 20000 THEN 'Tier 1' WHEN r >= 5000 THEN 'Tier 2' ELSE 'Tier 3' END AS rating_category,
 CASE WHEN reachable AND r >= 2000 THEN 'READY' WHEN reachable THEN 'READY (low ratings)' ELSE 'NEED CONTACT' END AS status,
 CASE WHEN reachable THEN 'Dear Customer, we offer ' || CASE WHEN b.fee = 'No MG' THEN 'Revenue Share Only' ELSE regexp_extract(b.fee, '(\\$[0-9,]+)$', 1) END || ' and ' || regexp_extract(b.share, '^([0-9]+%)', 1) || ' for Series ' || row_id || '.' END AS letter
FROM b LEFT JOIN l ON rank = o_custkey""".replace("{band}", _band_sql(" - ")),
)
def outreach_master(t: Tables) -> DataFrame:
    s = rolled(t)
    owner = t.orders.select(F.col("o_orderkey").alias("series_id"), F.col("o_custkey"))
    rows = s.join(owner, "series_id").select(
        F.col("series_id").alias("row_id"), F.concat(F.lit("Series "), F.col("series_id")).alias("series_name"), F.concat(F.lit("Customer Writer"), F.col("o_custkey")).alias("author"),
        "total_pages", F.when(F.col("books") > 5, F.col("total_pages") / 30).alias("stated_hours"), "first_count", "last_count",
    )
    contacts = t.customer.select(
        F.col("c_custkey").alias("contact_order"), F.concat(F.lit("customer writer"), F.col("c_custkey")).alias("author"),
        F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("w"), F.col("c_custkey"), F.lit("@mail.example.net"))).alias("email"), F.lit(None).cast("string").alias("agent_email"),
    )
    listed = rank_list(t).withColumn("author", F.concat(F.lit("Ann Writer"), F.col("rank")))
    template = "Dear {salutation}, we offer {fee} and {share} for {series}."
    kept, _ = outreach.outreach_master(rows, contacts, listed, template)
    return kept.select("row_id", F.round("hours", 6).alias("hours"), "differs", "tier", "fee", "share", "retention_quality", "list_entry", "rating_category", "status", "letter")


@query("view_sort", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def view_sort(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1)).alias("band"), "o_orderpriority", "o_totalprice")
    return ranking.view_sort(rows, "band", "o_totalprice", F.col("o_orderkey")).drop("band")
