"""Queries: joins, matching, overlays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.config import models
from shelfmark.functions.titles import normalize_title
from shelfmark.operators import joins as J
from shelfmark.operators import matching as M
from shelfmark.operators import overlay as O
from shelfmark.operators.containment import contained_pairs
from shelfmark.operators.editjoin import edit_candidates
from shelfmark.operators.scoring import with_fields
from shelfmark.queries.registry import Tables, query
from shelfmark.queries.views import (
    BOOKS, NAME_SERIES, RANK_LIST, TITLED, books, name_series, rank_list, titled_parts,
)


@query(
    "keyed_left_join",
    """WITH r AS (SELECT o_custkey, o_totalprice, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1)
SELECT c_custkey, c_name, c_acctbal AS o_totalprice, o_totalprice AS o_totalprice_2, o_orderpriority FROM customer LEFT JOIN r ON c_custkey = o_custkey""",
)
def keyed_left_join(t: Tables) -> DataFrame:
    left = t.customer.select("c_custkey", "c_name", F.col("c_acctbal").alias("o_totalprice"))
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    return J.keyed_left_join(left, t.orders, ["c_custkey"], ["o_custkey"], ["o_totalprice", "o_orderpriority"], order)


@query(
    "lookup_default",
    """WITH first AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS t100 FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(t100, 'Not Listed') AS listed FROM customer LEFT JOIN first ON c_custkey = o_custkey""",
)
def lookup_default(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey")
    return J.lookup(customers, t.orders, F.col("c_custkey"), F.col("o_custkey"), "o_orderpriority", "listed", "Not Listed", F.col("o_orderkey"))


@query(
    "only_new",
    """SELECT p_partkey, p_brand, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) AS rn FROM part
 WHERE NOT EXISTS (SELECT 1 FROM part k WHERE k.p_type = 'PROMO' AND k.p_brand = part.p_brand AND k.p_name = part.p_name)) WHERE rn = 1""",
)
def only_new(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_brand", "p_name")
    known = t.part.filter("p_type = 'PROMO'")
    return J.only_new(rows, known, ["p_brand", "p_name"], ["p_brand", "p_name"], [F.col("p_partkey")])


@query(
    "never_ordered",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
)
def never_ordered(t: Tables) -> DataFrame:
    return J.not_in_set(t.customer.select("c_custkey", "c_name"), t.orders, ["c_custkey"], ["o_custkey"])


@query(
    "missing_members",
    f"""WITH {TITLED}, f AS (SELECT p_partkey, p_brand, lower(title) AS t FROM titled WHERE p_type <> 'PROMO'), e AS (SELECT DISTINCT p_brand, p_name AS e FROM part WHERE p_type = 'PROMO')
SELECT p_partkey, p_brand FROM f WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.p_brand = f.p_brand AND (contains(f.t, e.e) OR contains(e.e, f.t)))""",
)
def missing_members(t: Tables) -> DataFrame:
    found = titled_parts(t).filter("p_type <> 'PROMO'").select("p_partkey", "p_brand", "title")
    existing = t.part.filter("p_type = 'PROMO'").select("p_brand", F.col("p_name").alias("title"))
    return J.missing_members(found, existing, "title", ["p_brand"]).select("p_partkey", "p_brand")


def _words(frame: DataFrame, *keys: str) -> DataFrame:
    """Different lower-case words (A-Z) of whole texts, with the keys of their rows."""
    return frame.select(*keys, F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), 1)).alias("t")).select(*keys, F.lower("t").alias("t")).distinct()


_WORDS = "unnest(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z]+'), lambda x: lower(x))))"


@query(
    "missing_members_overall",
    f"""WITH f AS (SELECT DISTINCT {_WORDS} AS t FROM documents), e AS (SELECT DISTINCT p_name AS e FROM part UNION SELECT DISTINCT {_WORDS} FROM conversations)
SELECT t FROM f WHERE NOT EXISTS (SELECT 1 FROM e WHERE contains(f.t, e.e) OR contains(e.e, f.t))""",
)
def missing_members_overall(t: Tables) -> DataFrame:
    existing = t.part.select(F.col("p_name").alias("t")).union(_words(t.conversations))
    return J.missing_members(_words(t.documents), existing, "t")


@query(
    "contained_pairs",
    """WITH n AS (SELECT DISTINCT p_name AS needle FROM part), x AS (SELECT DISTINCT p_name || ' ' || lower(p_type) AS text FROM part UNION SELECT DISTINCT 's' || p_name FROM part)
SELECT needle, text FROM n JOIN x ON contains(text, needle)""",
)
def containment(t: Tables) -> DataFrame:
    texts = t.part.select(F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("text")).union(t.part.select(F.concat(F.lit("s"), F.col("p_name"))))
    return contained_pairs(t.part, "p_name", texts, "text")


@query(
    "new_authors",
    f"""WITH l AS (SELECT DISTINCT conv_id, turn, {_WORDS} AS a FROM conversations), e AS (SELECT DISTINCT {_WORDS} AS e FROM documents),
n AS (SELECT a FROM (SELECT DISTINCT a FROM l) WHERE NOT EXISTS (SELECT 1 FROM e WHERE a = e OR (length(a) > 4 AND contains(e, a)) OR (length(e) > 4 AND contains(a, e))))
SELECT conv_id, turn, a AS author FROM l JOIN n USING (a)""",
)
def new_authors(t: Tables) -> DataFrame:
    listed = _words(t.conversations, "conv_id", "turn").withColumnRenamed("t", "author")
    return J.new_authors(listed, _words(t.documents), F.col("author"), F.col("t"))


_TAG = "'Amazon ' || CASE WHEN rank <= 10 THEN 'Top 10' WHEN rank <= 50 THEN 'Top 50' ELSE 'Top 100' END || ' ' || list_name"


@query(
    "rank_list_tags",
    f"""WITH {RANK_LIST}, {NAME_SERIES}, o AS (SELECT series_name, min(sid) AS o FROM name_series WHERE length(series_name) > 5 GROUP BY 1),
t AS (SELECT list_id, arg_min(series_name, o) AS series_name FROM rank_list JOIN o ON contains(title, series_name) OR (length(title) > 8 AND contains(series_name, title)) WHERE length(title) > 8 GROUP BY 1),
m AS (SELECT t.list_id, s.sid FROM t JOIN name_series s USING (series_name)),
x AS (SELECT l.list_id, s.sid FROM rank_list l JOIN name_series s ON lower(l.author) = lower(s.author) WHERE l.list_id NOT IN (SELECT list_id FROM m)),
a AS (SELECT DISTINCT sid, {_TAG} AS tag, rank FROM (SELECT * FROM m UNION SELECT * FROM x) JOIN rank_list USING (list_id))
SELECT sid, string_agg(DISTINCT tag, '; ' ORDER BY tag) AS tag, min(rank) AS best_rank FROM a GROUP BY 1""",
)
def rank_list_tags(t: Tables) -> DataFrame:
    return J.rank_list_tags(name_series(t), rank_list(t), "sid", ["series_name"], "author", F.col("sid"))


@query(
    "list_flags",
    f"""WITH {RANK_LIST}, p AS (SELECT DISTINCT p_name FROM part), f AS (SELECT DISTINCT p_name, '# ' || CASE WHEN rank <= 10 THEN 'Top 10' WHEN rank <= 50 THEN 'Top 50' ELSE 'Top 100' END || ' ' || list_name AS flag FROM p JOIN rank_list ON contains(title, p_name)),
g AS (SELECT p_name, string_agg(flag, ' | ' ORDER BY flag) AS flags FROM f GROUP BY 1) SELECT p_partkey, flags FROM part JOIN g USING (p_name)""",
)
def list_flags(t: Tables) -> DataFrame:
    return J.list_flags(t.part, rank_list(t), "p_partkey", "p_name")


@query(
    "best_listing",
    f"""WITH {RANK_LIST}, b AS (SELECT title, author, rank, list_name FROM (SELECT *, row_number() OVER (PARTITION BY title, author ORDER BY rank, list_id) AS rn FROM rank_list) WHERE rn = 1)
SELECT p_partkey, b.title || ': #' || rank || ' in ' || list_name AS featured FROM part LEFT JOIN b ON b.title = p_name || ' ' || lower(p_type) AND b.author = p_brand""",
)
def best_listing(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.concat("p_name", F.lit(" - "), F.lower("p_type")).alias("x"), "p_brand", "p_name", "p_type")
    rows = rows.withColumn("title", F.concat(F.upper("p_name"), F.lit(" "), F.lower("p_type"), F.lit(":")))
    return J.best_listing(rows, rank_list(t), "title", "p_brand").select("p_partkey", "featured")


@query(
    "two_list_featured",
    f"""WITH {RANK_LIST}, a AS (SELECT regexp_replace(title, '[^a-z]', '', 'g') AS k, min(rank) AS r FROM rank_list WHERE list_name IN ('PROMO', 'LARGE', 'ECONOMY') GROUP BY 1),
b AS (SELECT regexp_replace(title, '[^a-z]', '', 'g') AS k, min(rank) AS r FROM rank_list WHERE list_name <> 'LARGE' GROUP BY 1),
x AS (SELECT p_partkey, a.r AS first_rank, b.r AS second_rank FROM part LEFT JOIN a ON a.k = replace(p_name, ' ', '') || lower(p_type) LEFT JOIN b ON b.k = replace(p_name, ' ', '') || lower(p_type))
SELECT p_partkey, first_rank, second_rank, CASE WHEN first_rank IS NOT NULL AND (second_rank IS NULL OR first_rank <= second_rank) THEN 'Sports ' || CASE WHEN first_rank <= 10 THEN 'Top 10' WHEN first_rank <= 50 THEN 'Top 50' ELSE 'Top 100' END
 WHEN second_rank IS NOT NULL THEN 'Hockey ' || CASE WHEN second_rank <= 10 THEN 'Top 10' WHEN second_rank <= 50 THEN 'Top 50' ELSE 'Top 100' END ELSE 'No List' END AS featured_list FROM x""",
)
def two_list_featured(t: Tables) -> DataFrame:
    listed = rank_list(t).select(F.regexp_replace("title", "[^a-z]", "").alias("title_key"), F.col("rank").alias("list_rank"), "list_name")
    rows = t.part.select("p_partkey", F.concat("p_name", F.lit(" "), "p_type").alias("title"))
    first = listed.filter("list_name IN ('PROMO', 'LARGE', 'ECONOMY')")
    second = listed.filter("list_name <> 'LARGE'")
    return J.two_list_featured(rows, first, second, "title", "Sports", "Hockey").drop("title")


@query(
    "list_entry_by_surname",
    f"""WITH {RANK_LIST}, w AS (SELECT list_id, list_name, rank, unnest(list_distinct(string_split(title, ' '))) AS w FROM rank_list), b AS (SELECT w, list_name, rank FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY rank, list_id) AS rn FROM w) WHERE rn = 1)
SELECT p_partkey, coalesce(list_name || ' #' || rank, 'Not Available') AS list_entry, rank AS list_rank FROM part LEFT JOIN b ON w = string_split(p_name, ' ')[2]""",
)
def list_entry_by_surname(t: Tables) -> DataFrame:
    listed = rank_list(t).withColumn("author", F.col("title"))
    rows = t.part.select("p_partkey", F.initcap("p_name").alias("author"))
    return J.best_entry_by_surname(rows, listed, "author").drop("author")


def _band_sql(dash: str) -> str:
    cases = []
    for _, tier, least, most, hours, low, high, s1, s2 in models.COMMERCIAL_BANDS:
        fee = "No MG" if high == 0 else f"Up to ${high:,}" if low == 0 else f"${low:,}{dash}${high:,}"
        top = "" if most is None else f" AND r <= {most}"
        cases.append(f"WHEN r >= {least}{top} AND h >= {hours} THEN {{'tier': {tier}, 'fee_low': {low}, 'fee_high': {high}, 'fee': '{fee}', 'share': '{s1}%{dash}{s2}%'}}")
    return "CASE " + " ".join(cases) + f" ELSE {{'tier': 10, 'fee_low': 0, 'fee_high': 0, 'fee': 'No MG', 'share': '12%{dash}18%'}} END"


@query(
    "commercial_bands",
    f"""WITH {BOOKS}, s AS (SELECT series_id, CAST(max(rating_count) AS DOUBLE) AS r, round(sum(pages) * 250.0::DOUBLE / 2400, 2) AS h FROM books GROUP BY 1), b AS (SELECT series_id, {_band_sql(' - ')} AS b FROM s)
SELECT series_id, b.tier AS tier, b.fee_low AS fee_low, b.fee_high AS fee_high, b.fee AS fee, b.share AS share FROM b""",
)
def commercial_bands(t: Tables) -> DataFrame:
    s = books(t).groupBy("series_id").agg(F.max("rating_count").alias("r"), F.round(F.sum("pages") * 250 / 2400, 2).alias("h"))
    return with_fields(s, J.commercial_band("r", "h")).select("series_id", "tier", "fee_low", "fee_high", "fee", "share")


@query(
    "band_table",
    """WITH b AS (SELECT r_regionkey AS ord, r_regionkey * 100000.0 AS low, CASE WHEN r_regionkey < 4 THEN r_regionkey * 100000 + 99999.99 END AS high, r_name FROM region)
SELECT o_orderkey, (SELECT arg_min(r_name, ord) FROM b WHERE o_totalprice >= low AND (high IS NULL OR o_totalprice <= high)) AS r_name FROM orders""",
)
def band_table(t: Tables) -> DataFrame:
    key = F.col("r_regionkey")
    bands = t.region.select((key * 100000.0).alias("low"), F.when(key < 4, key * 100000 + F.lit(99999.99)).alias("high"), "r_name")
    # the regions are the configuration here: a fixed list of five
    band = J.band_table([r.asDict() for r in bands.orderBy("low").collect()], F.col("o_totalprice"), "low", "high", ["r_name"])
    return t.orders.select("o_orderkey", band["r_name"].alias("r_name"))


@query(
    "edit_candidates",
    f"""WITH {TITLED}, n AS (SELECT DISTINCT p_brand, lower(title) AS a FROM titled)
SELECT n.p_brand, n.a AS left_text, m.a AS right_text FROM n JOIN n AS m ON n.p_brand = m.p_brand
WHERE levenshtein(n.a, m.a) <= greatest(length(n.a), length(m.a)) * 0.30""",
)
def edit_pairs(t: Tables) -> DataFrame:
    rows = titled_parts(t).select("p_brand", F.lower("title").alias("title"))
    return edit_candidates(rows, "title", rows, "title", 0.30, ["p_brand"])


@query(
    "edit_candidates_overall",
    """WITH n AS (SELECT DISTINCT p_name AS a FROM part) SELECT x.a AS left_text, y.a AS right_text FROM n x, n y WHERE levenshtein(x.a, y.a) <= greatest(length(x.a), length(y.a)) * 0.45""",
)
def edit_pairs_overall(t: Tables) -> DataFrame:
    return edit_candidates(t.part, "p_name", t.part, "p_name", 0.45)


def _catalogue(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(search keys, target keys): parts of four types looked up among the parts of two types."""
    rows = titled_parts(t)
    target = rows.filter("p_type IN ('STANDARD', 'SMALL')")
    search = rows.filter("p_type NOT IN ('STANDARD', 'SMALL')")
    keys = [M.match_keys(r, "p_partkey", "title", "p_brand") for r in (search, target)]
    return keys[0], keys[1]


@query("cascade_match")
def cascade_match(t: Tables) -> DataFrame:
    search, target = _catalogue(t)
    return M.cascade_match(search, target).withColumn("confidence", F.round("confidence", 6))


@query(
    "exact_match",
    f"""WITH {TITLED}, k AS (SELECT *, CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN p_name ELSE title END AS std FROM titled),
m AS (SELECT std, p_brand, min(p_partkey) AS match_id FROM k WHERE p_type IN ('STANDARD', 'SMALL') GROUP BY 1, 2)
SELECT p_partkey AS id, match_id, CASE WHEN match_id IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS confidence, CASE WHEN match_id IS NULL THEN 'none' ELSE 'exact' END AS strategy FROM k LEFT JOIN m USING (std, p_brand) WHERE p_type NOT IN ('STANDARD', 'SMALL')""",
)
def exact_match(t: Tables) -> DataFrame:
    search, target = _catalogue(t)
    return M.cascade_match(search, target, strategies=["exact"])


_MERGE = f"""{TITLED}, k AS (SELECT *, CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN p_name ELSE title END AS std FROM titled),
tg AS (SELECT p_partkey, std, p_brand, CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS pages, CASE WHEN p_size % 2 = 0 THEN p_type END AS trope FROM k WHERE p_type IN ('STANDARD', 'SMALL')),
sr AS (SELECT p_partkey, std, p_brand, CASE WHEN p_size > 20 THEN p_size ELSE 0 END AS pages, p_type AS trope FROM k WHERE p_type NOT IN ('STANDARD', 'SMALL')),
m AS (SELECT std, p_brand, min(p_partkey) AS match_id FROM tg GROUP BY 1, 2), j AS (SELECT sr.*, match_id FROM sr LEFT JOIN m USING (std, p_brand)),
f AS (SELECT match_id, arg_min(pages, p_partkey) FILTER (pages <> 0) AS pages, arg_min(trope, p_partkey) AS trope FROM j WHERE match_id IS NOT NULL GROUP BY 1),
u AS (SELECT std, p_brand, min(p_partkey) AS p_partkey, arg_min(pages, p_partkey) AS own, coalesce(arg_min(pages, p_partkey) FILTER (pages <> 0), 0) AS pages, arg_min(trope, p_partkey) AS trope, count(*) AS n FROM j WHERE match_id IS NULL GROUP BY 1, 2)"""


@query(
    "merge_fill",
    f"""WITH {_MERGE} SELECT p_partkey, p_brand, CASE WHEN tg.pages = 0 AND f.pages IS NOT NULL THEN f.pages ELSE tg.pages END AS pages, coalesce(tg.trope, f.trope) AS trope FROM tg LEFT JOIN f ON match_id = p_partkey
UNION ALL SELECT p_partkey, p_brand, pages, trope FROM u""",
)
def merge_fill(t: Tables) -> DataFrame:
    return _merged(t)[0].select("p_partkey", "p_brand", "pages", "trope")


def _merged(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = titled_parts(t)
    known = rows.filter("p_type IN ('STANDARD', 'SMALL')")
    found = rows.filter("p_type NOT IN ('STANDARD', 'SMALL')")
    size = F.col("p_size")
    target = known.select(
        "p_partkey", "title", "p_brand", F.when(size > 10, size).otherwise(0).alias("pages"), F.when(F.pmod(size, F.lit(2)) == 0, F.col("p_type")).alias("trope")
    )
    source = found.select("p_partkey", "title", "p_brand", F.when(size > 20, size).otherwise(0).alias("pages"), F.col("p_type").alias("trope"))
    matches = M.cascade_match(*[M.match_keys(f, "p_partkey", "title", "p_brand") for f in (source, target)], strategies=["exact"])
    return M.merge_fill(target, source, matches, "p_partkey", ["pages", "trope"], "p_partkey", [normalize_title("title")["standard"], F.col("p_brand")])


@query(
    "merge_counts",
    f"""WITH {_MERGE} SELECT (SELECT count(*) FROM j WHERE match_id IS NOT NULL) + (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM u) AS matched, (SELECT count(*) FROM u) AS added, 0::BIGINT AS skipped,
 (SELECT CAST(coalesce(sum((tg.pages = 0 AND f.pages IS NOT NULL)::INT + (tg.trope IS NULL AND f.trope IS NOT NULL)::INT), 0) AS BIGINT) FROM tg JOIN f ON match_id = p_partkey) + (SELECT count(*) FROM u WHERE own = 0 AND pages <> 0) AS updated""",
)
def merge_counts(t: Tables) -> DataFrame:
    return _merged(t)[1]


@query(
    "lineage_match",
    """WITH b AS (SELECT o_orderkey, 'C' || o_custkey AS author, o_orderpriority AS series, 'O' || (o_orderkey // 2) AS first_book FROM orders),
s1 AS (SELECT 'C' || o_custkey AS author, o_orderpriority AS series, 'O' || (o_orderkey // 3) AS first_book, CAST(o_orderkey AS VARCHAR) AS mark FROM orders),
s2 AS (SELECT 'C' || o_custkey AS author, o_orderpriority AS series, 'O' || (o_orderkey // 2) AS first_book, 'm' || o_orderkey AS mark FROM orders),
u11 AS (SELECT author, series, min(mark) AS mark FROM s1 GROUP BY 1, 2 HAVING count(*) = 1), u12 AS (SELECT author, first_book, min(mark) AS mark FROM s1 GROUP BY 1, 2 HAVING count(*) = 1),
u21 AS (SELECT author, series, min(mark) AS mark FROM s2 GROUP BY 1, 2 HAVING count(*) = 1), u22 AS (SELECT author, first_book, min(mark) AS mark FROM s2 GROUP BY 1, 2 HAVING count(*) = 1)
SELECT o_orderkey, coalesce(u11.mark, u12.mark, u21.mark, u22.mark) AS mark, CASE WHEN u11.mark IS NOT NULL OR u12.mark IS NOT NULL THEN 'waiting' WHEN u21.mark IS NOT NULL OR u22.mark IS NOT NULL THEN 'filled' END AS lineage_source,
 CASE WHEN u11.mark IS NOT NULL THEN 'author+series' WHEN u12.mark IS NOT NULL THEN 'author+first-book' WHEN u21.mark IS NOT NULL THEN 'author+series' WHEN u22.mark IS NOT NULL THEN 'author+first-book' END AS lineage_match
FROM b LEFT JOIN u11 ON b.author = u11.author AND b.series = u11.series LEFT JOIN u12 ON b.author = u12.author AND b.first_book = u12.first_book LEFT JOIN u21 ON b.author = u21.author AND b.series = u21.series LEFT JOIN u22 ON b.author = u22.author AND b.first_book = u22.first_book""",
)
def lineage_match(t: Tables) -> DataFrame:
    def rows(frame: DataFrame, step: int, mark) -> DataFrame:
        return frame.select(
            "o_orderkey",
            F.concat(F.lit("C"), F.col("o_custkey")).alias("author"),
            F.col("o_orderpriority").alias("series"),
            F.concat(F.lit("O"), F.floor(F.col("o_orderkey") / step).cast("string")).alias("first_book"),
            mark.alias("mark"),
        )

    base = rows(t.orders, 2, F.lit(None).cast("string"))
    first = rows(t.orders, 3, F.col("o_orderkey").cast("string"))
    second = rows(t.orders, 2, F.concat(F.lit("m"), F.col("o_orderkey")))
    out = M.lineage_match(base, [("waiting", first), ("filled", second)], "author", "series", "first_book", ["mark"])
    return out.select("o_orderkey", "mark", "lineage_source", "lineage_match")


def _shelf(t: Tables) -> DataFrame:
    """Catalogue books (author, series, title, book_order) of the part table."""
    return titled_parts(t).select(
        F.col("p_brand").alias("author"), F.concat("p_name", F.lit(" saga")).alias("series"), "title", F.col("p_partkey").alias("book_order")
    )


def _asked(t: Tables) -> DataFrame:
    """Rows that look for a series: the parts with slightly different wording."""
    return titled_parts(t).select(
        "p_partkey",
        F.col("p_brand").alias("author"),
        F.when(F.col("p_size") > 40, F.concat("p_name", F.lit(" sagas"))).when(F.col("p_size") > 30, F.concat("p_name", F.lit(" Saga"))).otherwise(F.lit("Unknown")).alias("series"),
        F.when(F.col("p_size") <= 10, F.col("title")).when(F.col("p_size") <= 20, F.concat(F.lit("lost "), F.col("p_name"))).otherwise(F.lit("")).alias("first_book"),
    )


@query("local_series_match")
def local_series_match(t: Tables) -> DataFrame:
    return M.local_series_match(_asked(t), _shelf(t), "p_partkey", "author", "series", "first_book")


@query("author_correction")
def author_correction(t: Tables) -> DataFrame:
    rows = _asked(t).withColumn("author", F.concat(F.lit("Brand"), F.col("p_partkey") % 40))
    return M.author_correction(rows, _shelf(t), "p_partkey", "author", "series", "first_book")


@query("choose_search_result")
def choose_search_result(t: Tables) -> DataFrame:
    requests = titled_parts(t).select("p_partkey", F.col("p_brand").alias("author"), "title", F.col("p_name").alias("series"))
    names = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("result_order"), "l_returnflag", "l_suppkey").distinct()
    results = names.join(t.part.select("p_partkey", "p_name", "p_brand"), "p_partkey").select(
        "p_partkey",
        "result_order",
        F.when(F.col("l_returnflag") == "A", F.col("p_brand")).otherwise(F.concat(F.lit("Supplier "), F.col("l_suppkey"))).alias("author"),
        F.concat("p_name", F.lit(" novel")).alias("title"),
        F.when(F.col("l_returnflag") == "R", F.lit("other")).otherwise(F.col("p_name")).alias("title_base"),
    )
    best = M.choose_search_result(requests, results, "p_partkey")
    return best.withColumn("points", F.round("points", 6)).select("p_partkey", "author", "title_base", "points")


@query(
    "product_match",
    """WITH x AS (SELECT p_partkey, p_name AS q, CASE p_type WHEN 'LARGE' THEN p_name || ' (Unabridged)' WHEN 'PROMO' THEN 'the ' || p_name || ' audio' WHEN 'SMALL' THEN lower(p_brand) || ' stories' ELSE 'another thing' END AS p, lower(replace(p_brand, '#', ' ')) AS w,
 CASE WHEN p_size > 30 THEN lower(replace(p_brand, '#', ' ')) WHEN p_size > 20 THEN lower(replace(p_brand, '#', ' ')) || ' and sons' WHEN p_size > 10 THEN 'nobody' ELSE '' END AS g FROM part),
s AS (SELECT *, CASE WHEN p = q || ' (Unabridged)' THEN 60 WHEN contains(p, q) THEN 45 WHEN p LIKE '%stories' THEN 25 ELSE 0 END AS a, CASE WHEN g = '' THEN 0 WHEN g = w THEN 40 WHEN contains(g, w) OR contains(w, g) THEN 25 ELSE -25 END AS b,
 CASE WHEN p = q || ' (Unabridged)' THEN 'exact_title' WHEN contains(p, q) THEN 'title_contains' WHEN p LIKE '%stories' THEN 'series_prefix' END AS n1, CASE WHEN g = '' THEN NULL WHEN g = w THEN 'exact_author' WHEN contains(g, w) THEN 'partial_author' ELSE 'author_mismatch' END AS n2 FROM x)
SELECT p_partkey, CAST(a + b AS INTEGER) AS score, CASE WHEN a + b >= 95 THEN 'high' WHEN a + b >= 70 THEN 'medium' ELSE 'low' END AS confidence, concat_ws(',', n1, n2) AS notes FROM s""",
)
def product_match(t: Tables) -> DataFrame:
    brand = F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit(" ")))
    product = (
        F.when(F.col("p_type") == "LARGE", F.concat("p_name", F.lit(" (Unabridged)")))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit("the "), "p_name", F.lit(" audio")))
        .when(F.col("p_type") == "SMALL", F.concat("p_brand", F.lit(" stories")))
        .otherwise(F.lit("another thing"))
    )
    got = (
        F.when(F.col("p_size") > 30, brand)
        .when(F.col("p_size") > 20, F.concat(brand, F.lit(" & Sons")))
        .when(F.col("p_size") > 10, F.lit("Nobody"))
        .otherwise(F.lit(""))
    )
    rows = t.part.select("p_partkey", M.product_match("p_name", product, "p_brand", got, "p_brand").alias("m"))
    return rows.select("p_partkey", "m.*")


@query(
    "best_record",
    """WITH u AS (SELECT page_id AS row_id, CASE WHEN contains(url, '/en/') THEN regexp_extract(url, '/en/([0-9]+)', 1) END AS gid, 'first' AS source, length(html) AS pages, CASE WHEN contains(url, '?') THEN 5 END AS ratings FROM pages
 UNION ALL SELECT doc_id, CAST(doc_id AS VARCHAR), 'second', 0, CAST(n_chars AS INTEGER) FROM documents),
p AS (SELECT *, CASE WHEN pages <> 0 THEN 3 ELSE 0 END + CASE WHEN coalesce(ratings, 0) <> 0 THEN 2 ELSE 0 END + 2 + CASE source WHEN 'first' THEN 3 ELSE 1 END AS points, coalesce(gid, 'page ' || row_id || '|writer') AS key FROM u)
SELECT row_id, source, points FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY points DESC, source, row_id) AS rn FROM p) WHERE rn = 1""",
)
def best_record(t: Tables) -> DataFrame:
    first = t.pages.select(
        F.col("page_id").alias("row_id"), F.when(F.col("url").contains("/en/"), F.regexp_extract("url", "/en/([0-9]+)", 1)).alias("gid"), F.lit("first").alias("source"),
        F.length("html").alias("pages"), F.when(F.col("url").contains("?"), 5).alias("ratings"),
    )
    second = t.documents.select(F.col("doc_id").alias("row_id"), F.col("doc_id").cast("string").alias("gid"), F.lit("second").alias("source"), F.lit(0).alias("pages"), F.col("n_chars").cast("int").alias("ratings"))
    every = first.unionByName(second).withColumns({"title": F.concat(F.lit("Page "), F.col("row_id")), "author": F.lit("Writer"), "number": F.lit(1)})
    points = M.record_points("pages", "ratings", "number", "source", {"first": 3, "second": 1})
    best = M.best_record(every.withColumn("points", points), F.col("gid"), "title", "author", F.col("points"), [F.col("source"), F.col("row_id")])
    return best.select("row_id", "source", "points")


@query(
    "delta_apply",
    """WITH b AS (SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN 'link' || c_nationkey || '-' || c_mktsegment END AS link, c_name, CASE WHEN c_acctbal > 5000 THEN 'amazon digital' WHEN c_acctbal > 2000 THEN c_mktsegment END AS publisher, CASE WHEN c_acctbal > 4000 THEN 9 END AS pages FROM customer),
fl AS (SELECT link, min(c_custkey) AS id FROM b WHERE link IS NOT NULL GROUP BY 1),
d AS (SELECT s_suppkey AS o, CASE WHEN s_suppkey % 3 <> 0 THEN 'link' || s_nationkey || '-BUILDING' END AS link, 'Customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS c_name, CASE WHEN s_acctbal > 4000 THEN s_name END AS publisher, CASE WHEN s_acctbal < 7000 THEN CAST(floor(s_acctbal) AS INTEGER) END AS pages FROM supplier),
k AS (SELECT d.*, fl.id FROM d JOIN fl ON d.link = fl.link WHERE d.link IS NOT NULL UNION ALL SELECT d.*, b.c_custkey FROM d JOIN b ON d.c_name = b.c_name WHERE d.link IS NULL),
v AS (SELECT id, arg_min(publisher, o) FILTER (publisher IS NOT NULL) AS publisher, arg_min(pages, o) FILTER (pages IS NOT NULL) AS pages FROM k GROUP BY 1)
SELECT c_custkey, CASE WHEN b.publisher IS NULL OR contains(b.publisher, 'amazon digital') THEN coalesce(v.publisher, b.publisher) ELSE b.publisher END AS publisher, coalesce(b.pages, v.pages) AS pages FROM b LEFT JOIN v ON id = c_custkey""",
)
def delta_apply(t: Tables) -> DataFrame:
    base = t.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") < 20, F.concat(F.lit("link"), F.col("c_nationkey"), F.lit("-"), F.col("c_mktsegment"))).alias("link"),
        F.col("c_name").alias("title"),
        F.lit("Writer").alias("author"),
        F.when(F.col("c_acctbal") > 5000, F.lit("amazon digital")).when(F.col("c_acctbal") > 2000, F.col("c_mktsegment")).alias("publisher"),
        F.when(F.col("c_acctbal") > 4000, 9).alias("pages"),
    )
    delta = t.supplier.select(
        F.col("s_suppkey").alias("o"),
        F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("link"), F.col("s_nationkey"), F.lit("-BUILDING"))).alias("link"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("title"),
        F.lit("writer").alias("author"),
        F.when(F.col("s_acctbal") > 4000, F.col("s_name")).alias("publisher"),
        F.when(F.col("s_acctbal") < 7000, F.floor("s_acctbal").cast("int")).alias("pages"),
    )
    weak = {"publisher": F.lower("publisher").contains("amazon digital")}
    return O.delta_apply(base, delta, "c_custkey", "link", "title", "author", ["publisher", "pages"], "o", weak).select("c_custkey", "publisher", "pages")


@query(
    "group_scoped_overlay",
    """WITH d AS (SELECT o_orderkey, 'g1' AS g, 1 AS p, o_orderpriority AS c, CASE WHEN o_totalprice > 100000 THEN 'Yes' ELSE '' END AS v, 'A' || o_custkey AS publisher FROM orders UNION ALL SELECT o_orderkey, 'g2', 2, o_orderpriority, 'Likely', CASE WHEN o_totalprice > 300000 THEN 'B' || o_custkey END FROM orders),
s AS (SELECT * FROM d WHERE v <> '' AND ((g = 'g1' AND c IN ('1-URGENT', '2-HIGH')) OR (g = 'g2' AND c IN ('2-HIGH', '5-LOW')))),
x AS (SELECT o_orderkey, arg_max(v, p) AS v, arg_max(publisher, p) FILTER (publisher IS NOT NULL) AS publisher FROM s GROUP BY 1)
SELECT o.o_orderkey, coalesce(x.v, 'No') AS verified, coalesce(x.publisher, o_orderstatus) AS publisher FROM orders o LEFT JOIN x ON o.o_orderkey = x.o_orderkey""",
)
def group_scoped_overlay(t: Tables) -> DataFrame:
    base = t.orders.select("o_orderkey", F.lit("No").alias("verified"), F.col("o_orderstatus").alias("publisher"))
    common = ["o_orderkey", F.col("o_orderpriority").alias("category")]
    one = t.orders.select(*common, F.lit("g1").alias("group"), F.lit(1).alias("priority"), F.when(F.col("o_totalprice") > 100000, F.lit("Yes")).otherwise(F.lit("")).alias("verified"), F.concat(F.lit("A"), F.col("o_custkey")).alias("publisher"))
    two = t.orders.select(*common, F.lit("g2").alias("group"), F.lit(2).alias("priority"), F.lit("Likely").alias("verified"), F.when(F.col("o_totalprice") > 300000, F.concat(F.lit("B"), F.col("o_custkey"))).alias("publisher"))
    scopes = {"g1": ["1-URGENT", "2-HIGH"], "g2": ["2-HIGH", "5-LOW"]}
    return O.group_scoped_overlay(base, one.unionByName(two), "o_orderkey", "category", scopes, ["verified", "publisher"], "verified")


@query(
    "results_by_author",
    """WITH b AS (SELECT o_orderkey, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS author, CASE WHEN o_orderstatus = 'P' THEN 'own@mail.example.net' WHEN o_orderstatus = 'F' THEN 'nan' END AS email FROM orders),
r AS (SELECT lower(c_name) AS k, CASE WHEN c_acctbal > 2000 THEN 'a' || c_custkey || '@x.net' ELSE 'b' || c_custkey || '@x.net' END AS email, CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS site FROM customer)
SELECT o_orderkey, CASE WHEN b.email IS NULL OR b.email = 'nan' THEN coalesce(r.email, b.email) ELSE b.email END AS email, r.site AS website FROM b LEFT JOIN r ON lower(author) = k""",
)
def results_by_author(t: Tables) -> DataFrame:
    base = t.orders.select(
        "o_orderkey",
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("author"),
        F.when(F.col("o_orderstatus") == "P", F.lit("own@mail.example.net")).when(F.col("o_orderstatus") == "F", F.lit("nan")).alias("email"),
        F.lit(None).cast("string").alias("website"),
    )
    first = t.customer.select(
        F.upper("c_name").alias("author"), F.when(F.col("c_acctbal") > 2000, F.concat(F.lit("a"), F.col("c_custkey"), F.lit("@x.net"))).alias("email"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).alias("website"), F.lit(1).alias("priority"),
    )
    second = t.customer.select(
        F.col("c_name").alias("author"), F.concat(F.lit("b"), F.col("c_custkey"), F.lit("@x.net")).alias("email"), F.lit("").alias("website"), F.lit(2).alias("priority")
    )
    return O.apply_by_author(base, first.union(second), "author", ["email", "website"]).drop("author")


@query(
    "results_by_row",
    """WITH r AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rn FROM lineitem) WHERE rn = 1
)
SELECT o_orderkey, coalesce(l_returnflag, o_orderstatus) AS status,
  coalesce(CASE WHEN o_orderpriority LIKE '1%' THEN o_orderpriority END, CASE WHEN l_orderkey IS NOT NULL THEN 'found' END) AS trope,
  CASE WHEN o_orderstatus = 'F' THEN coalesce(l_quantity, 0) ELSE 5 END AS pages, greatest(4, l_linenumber) AS books
FROM orders LEFT JOIN r ON o_orderkey = l_orderkey""",
)
def results_by_row(t: Tables) -> DataFrame:
    base = t.orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")).alias("trope"),
        F.when(F.col("o_orderstatus") == "F", 0.0).otherwise(5.0).alias("pages"), F.lit(4).cast("long").alias("books"),
    )
    results = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("status"), F.lit("found").alias("trope"),
        F.col("l_quantity").alias("pages"), F.col("l_linenumber").cast("long").alias("books"), "l_extendedprice",
    )
    best_first = F.struct(-F.col("l_extendedprice"), F.col("books"))
    policies = {"status": "overwrite", "trope": "fill", "pages": "fill_zero", "books": "larger"}
    return O.apply_by_row(base, results, "o_orderkey", policies, best_first)
