"""Queries: keys, titles, texts, addresses, links, stored pages, JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.config import vocab
from shelfmark.config.vocab import TITLE_STOP_WORDS
from shelfmark.functions import contacts as C
from shelfmark.functions import html as H
from shelfmark.functions import jsontext as K
from shelfmark.functions import keys as X
from shelfmark.functions import pages as P
from shelfmark.functions import similarity as S
from shelfmark.functions import text as TX
from shelfmark.functions import titles as TT
from shelfmark.functions import urls as U
from shelfmark.operators import clusters
from shelfmark.operators.evidence import author_candidates, evidence_status
from shelfmark.operators.scoring import verification_state
from shelfmark.operators import joins as J
from shelfmark.queries.registry import Tables, query
from shelfmark.queries.views import TITLED, sql_any, sql_quote, titled_parts


@query(
    "normalised_titles",
    f"""WITH {TITLED} SELECT p_partkey, title AS original, title AS strict, CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN p_name ELSE title END AS standard,
 regexp_replace(lower(CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN p_name ELSE title END), '[^a-z0-9]', '', 'g') AS fuzzy,
 CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE', 'MEDIUM') THEN p_name ELSE title END AS core_title, CASE p_type WHEN 'PROMO' THEN 'Iron Saga' WHEN 'SMALL' THEN 'Copper Forge' END AS series_name,
 CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN CAST(p_size AS VARCHAR) END AS book_number FROM titled""",
)
def normalised_titles(t: Tables) -> DataFrame:
    return titled_parts(t).select("p_partkey", TT.normalize_title("title").alias("n")).select("p_partkey", "n.*")


@query(
    "folded_texts",
    """SELECT doc_id, md5(replace(replace(strip_accents(text), 'ß', 'ß'), chr(160), chr(160))) AS digest, length(text) AS n FROM documents""",
)
def folded_texts(t: Tables) -> DataFrame:
    folded = X.fold_accents("text")
    return t.documents.select("doc_id", F.md5(folded).alias("digest"), F.length("text").cast("long").alias("n"))


@query(
    "subtitles",
    f"""WITH {TITLED}, m AS (
  SELECT p_partkey, CASE WHEN p_size % 3 = 1 THEN replace(title, ':', ' –') WHEN p_size % 3 = 2 THEN replace(title, ':', '—') || CASE WHEN p_size % 2 = 0 THEN ': x' ELSE '' END ELSE title END AS title
  FROM titled
),
c AS (SELECT *, CASE WHEN contains(title, ':') THEN ':' WHEN contains(title, '–') THEN '–' WHEN contains(title, '—') THEN '—' END AS mark FROM m)
SELECT p_partkey, nullif(trim(substr(title, instr(title, mark) + 1)), '') AS subtitle,
  trim(CASE WHEN mark IS NULL THEN title ELSE substr(title, 1, instr(title, mark) - 1) END) AS main_title
FROM c""",
)
def subtitles(t: Tables) -> DataFrame:
    """Colons, en dashes, em dashes, and a colon after an em dash."""
    size = F.col("p_size") % 3
    more = F.when(F.col("p_size") % 2 == 0, F.lit(": x")).otherwise(F.lit(""))
    dashed = F.when(size == 1, F.replace("title", F.lit(":"), F.lit(" –"))).when(size == 2, F.concat(F.replace("title", F.lit(":"), F.lit("—")), more)).otherwise(F.col("title"))
    rows = titled_parts(t).withColumn("title", dashed)
    return rows.select("p_partkey", TT.subtitle("title").alias("subtitle"), TT.main_title("title").alias("main_title"))


@query(
    "author_keys",
    """WITH a AS (SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN 'by ' || c_name WHEN 'HOUSEHOLD' THEN c_name || ', Jr.' WHEN 'MACHINERY' THEN c_name || ' Ph.D.' WHEN 'BUILDING' THEN 'nan' ELSE 'Zoë ' || c_name END AS a, c_name, c_mktsegment FROM customer)
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'AUTOMOBILE' THEN 'Zoe ' || c_name ELSE c_name END AS standard,
 CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'AUTOMOBILE' THEN 'zoe' ELSE '' END || CASE WHEN c_mktsegment <> 'BUILDING' THEN replace(lower(c_name), '#', '') ELSE '' END AS fuzzy FROM a""",
)
def author_keys(t: Tables) -> DataFrame:
    name = (
        F.when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("by "), "c_name"))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat("c_name", F.lit(", Jr.")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat("c_name", F.lit(" Ph.D.")))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit("nan"))
        .otherwise(F.concat(F.lit("Zoë "), "c_name"))
    )
    return t.customer.select("c_custkey", name.alias("a")).select(
        "c_custkey", X.author_key("a").alias("standard"), X.author_key("a", "fuzzy").alias("fuzzy")
    )


_RAW_TITLE = "p_name || ' & Co.: the ' || p_type || ' Series, vol. ' || p_size || ' (Part #' || p_size || ')'"


@query(
    "key_forms",
    f"""WITH r AS (SELECT p_partkey, p_name, p_type, p_size, {_RAW_TITLE} AS x FROM part)
SELECT p_partkey, regexp_replace(lower(x), '[^a-z0-9 ]', '', 'g') AS spaced, regexp_replace(lower(x), '[^a-z0-9]', '', 'g') AS compact, trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')) AS words,
 regexp_replace(lower(x), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g') AS plain, p_name || ' co the ' || lower(p_type) AS series_words,
 p_name || ' and co the ' || lower(p_type) || ' vol ' || p_size || ' part ' || p_size AS product, p_name || ' and co the ' || lower(p_type) || ' vol ' || p_size AS product_title,
 p_name || '  co the ' || lower(p_type) AS crawl, replace(lower(x), ' series', '') AS no_series, replace(lower(x), ':', '') AS listed,
 replace(p_name, ' ', '_') || '_and_co_the_' || lower(p_type) || '_series_vol_' || p_size || '_part_' || p_size AS slug FROM r""",
)
def key_forms(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    title = F.concat("p_name", F.lit(" & Co.: the "), "p_type", F.lit(" Series, vol. "), size, F.lit(" (Part #"), size, F.lit(")"))
    return t.part.select("p_partkey", title.alias("x")).select(
        "p_partkey",
        X.spaced_key("x").alias("spaced"),
        X.compact_key("x").alias("compact"),
        X.word_key("x").alias("words"),
        X.punctuation_free_key("x").alias("plain"),
        X.series_word_key("x").alias("series_words"),
        X.product_key("x").alias("product"),
        X.product_title_key("x").alias("product_title"),
        X.crawl_title_key("x").alias("crawl"),
        X.drop_series_key("x").alias("no_series"),
        X.rank_list_key("x").alias("listed"),
        X.slug("x").alias("slug"),
    )


@query(
    "clean_names",
    f"""WITH {TITLED} SELECT p_partkey, upper(p_name[1]) || substr(split_part(p_name, ' ', 1), 2) || ' O''Neil-' || upper(split_part(p_name, ' ', 2)[1]) || substr(split_part(p_name, ' ', 2), 2) AS series_name,
 p_name || ' (Forge, #2-3)' AS series_label, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN p_name ELSE title END AS clean_title FROM titled""",
)
def clean_names(t: Tables) -> DataFrame:
    first, second = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)
    raw = F.concat(first, F.lit(" o'neil-"), second, F.lit(" , # "))
    label = F.concat("p_name", F.lit(" (Forge, #2-3), #"), F.col("p_size").cast("string"))
    return titled_parts(t).select(
        "p_partkey", X.clean_series_name(raw).alias("series_name"), X.clean_series_label(label).alias("series_label"), X.clean_title("title").alias("clean_title")
    )


@query(
    "list_series",
    f"""WITH {TITLED} SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'Iron Saga,' WHEN 'SMALL' THEN 'Copper Forge' WHEN 'MEDIUM' THEN 'Workshop' END AS list_series,
 CASE p_type WHEN 'PROMO' THEN 'Iron Saga,' WHEN 'SMALL' THEN 'Copper Forge Book ' || p_size ELSE NULL END AS from_title FROM titled""",
)
def list_series(t: Tables) -> DataFrame:
    return titled_parts(t).select(
        "p_partkey", TT.list_series("title").alias("list_series"), TT.series_from_title("title", F.lit("NO_SERIES")).alias("from_title")
    )


@query(
    "list_items",
    """SELECT p_partkey, CAST(p_size AS INTEGER) AS rank, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN p_name || ' tale' WHEN p_type = 'LARGE' THEN p_name || ' tale (Saga 1)' WHEN p_type = 'MEDIUM' THEN p_name || ' plain' ELSE upper(p_name) || ' x' END AS title,
 CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'Ann ' || p_brand WHEN p_type = 'LARGE' THEN 'Ann B' WHEN p_type = 'MEDIUM' THEN NULL ELSE 'Written By' END AS author FROM part""",
)
def list_items(t: Tables) -> DataFrame:
    head = F.concat(F.lit("#"), F.col("p_size").cast("string"))
    text = (
        F.when(F.col("p_type").isin("PROMO", "SMALL"), F.concat(head, F.lit("\n\n"), "p_name", F.lit(" tale\nKindle Edition\nAnn "), "p_brand", F.lit("\n4.7 out of 5 stars\n1,234")))
        .when(F.col("p_type") == "LARGE", F.concat(head, F.lit(" "), "p_name", F.lit(" tale (Saga 1)Ann B4.7 out of 5 stars 1,234")))
        .when(F.col("p_type") == "MEDIUM", F.concat(head, F.lit(" "), "p_name", F.lit(" plain")))
        .otherwise(F.concat(head, F.lit("\n12.5\n"), F.upper("p_name"), F.lit(" x\n"), F.upper("p_name"), F.lit(" x\nWritten By")))
    )
    return t.part.select("p_partkey", TT.list_item(text).alias("i")).select("p_partkey", "i.*")


@query(
    "synopses",
    """WITH s AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents)
SELECT doc_id, substr(array_to_string(p[1:2], ' '), 1, 300) AS synopsis FROM s""",
)
def synopses(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", TX.short_synopsis("text").alias("synopsis"))


def _trope_sql() -> str:
    cases = []
    for i, (name, words) in enumerate(vocab.TROPES.items()):
        score = " + ".join(f"contains(x, {sql_quote(w)})::INT" for w in words)
        cases.append(f"{{'s': {score}, 'p': {-i}, 'n': {sql_quote(name)}}}")
    return "list_max([" + ", ".join(cases) + "])"


@query(
    "main_tropes",
    f"""WITH d AS (SELECT doc_id, lower(text) AS x FROM documents), s AS (SELECT doc_id, {_trope_sql()} AS b FROM d) SELECT doc_id, CASE WHEN b.s > 0 THEN b.n END AS trope, CASE WHEN b.s > 0 THEN CAST(b.s AS INTEGER) ELSE 0 END AS hits FROM s""",
)
def main_tropes(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", TX.main_trope("text").alias("trope"), F.array_max(TX.trope_scores("text"))["score"].alias("hits"))


@query(
    "sport_tags",
    f"""WITH d AS (SELECT conv_id, turn, lower(role || ' ' || text) AS x FROM conversations) SELECT conv_id, turn, CASE WHEN {sql_any('x', vocab.SPORT_TAG_WORDS['Hockey'])} THEN 'Hockey' WHEN {sql_any('x', vocab.SPORT_TAG_WORDS['Other Sport'])} THEN 'Other Sport' ELSE 'Sports Romance' END AS tag FROM d""",
)
def sport_tags(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", TX.sport_tag("role", "text").alias("tag"))


@query(
    "publisher_classes",
    """WITH p AS (SELECT p_partkey, p_name, CASE p_type WHEN 'ECONOMY' THEN ' Independently Published ' WHEN 'PROMO' THEN 'Penguin Press' WHEN 'LARGE' THEN 'Tantor Audio & Co' WHEN 'SMALL' THEN p_name WHEN 'MEDIUM' THEN NULL ELSE 'Oak House' END AS pub, p_type FROM part)
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Self-Pub' WHEN 'PROMO' THEN 'Big Pub' WHEN 'LARGE' THEN 'Big Pub' WHEN 'MEDIUM' THEN '' ELSE 'Indie' END AS kind,
 CASE p_type WHEN 'ECONOMY' THEN 'Self Pub' WHEN 'PROMO' THEN 'Big Pub' WHEN 'LARGE' THEN 'Big Pub' WHEN 'SMALL' THEN 'Self Pub' ELSE 'Indie' END AS by_author,
 CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'No' ELSE 'Yes' END AS self_published, CASE p_type WHEN 'ECONOMY' THEN 'Indie' WHEN 'PROMO' THEN 'Indie' WHEN 'LARGE' THEN 'Indie' WHEN 'SMALL' THEN 'Indie' WHEN 'STANDARD' THEN 'Indie' END AS clean_flag,
 CASE WHEN p_type = 'LARGE' THEN 'Tantor Media' END AS imprint FROM p""",
)
def publisher_classes(t: Tables) -> DataFrame:
    publisher = (
        F.when(F.col("p_type") == "ECONOMY", F.lit(" Independently Published "))
        .when(F.col("p_type") == "PROMO", F.lit("Penguin Press"))
        .when(F.col("p_type") == "LARGE", F.lit("Tantor Audio & Co"))
        .when(F.col("p_type") == "SMALL", F.col("p_name"))
        .when(F.col("p_type") == "MEDIUM", F.lit(None))
        .otherwise(F.lit("Oak House"))
    )
    return t.part.select("p_partkey", "p_name", publisher.alias("pub")).select(
        "p_partkey",
        TX.publisher_class("pub").alias("kind"),
        TX.publisher_class_by_author("pub", "p_name").alias("by_author"),
        TX.is_self_published("pub").alias("self_published"),
        TX.clean_publisher_flag("pub").alias("clean_flag"),
        TX.imprint_of("pub").alias("imprint"),
    )


@query(
    "bylines",
    """SELECT p_partkey, CASE WHEN p_size > 10 THEN p_name END AS author, CASE WHEN p_size > 10 THEN 'House of ' || p_brand END AS publisher, CASE WHEN p_type = 'LARGE' THEN p_name END AS credit_author,
 CASE WHEN p_type = 'LARGE' THEN CASE WHEN p_size > 25 THEN 'Oak Press, Inc.' ELSE 'Oak Press' END END AS credit_publisher, array_to_string(CASE WHEN p_size > 25 THEN [p_name, 'second'] ELSE [p_name] END, '|') AS titles FROM part""",
)
def bylines(t: Tables) -> DataFrame:
    line = F.when(F.col("p_size") > 10, F.concat("p_name", F.lit(" (Author), Someone (Narrator), House of "), "p_brand", F.lit(" (Publisher)"))).otherwise(F.col("p_name"))
    company = F.when(F.col("p_size") > 25, F.lit("Oak Press, Inc.")).otherwise(F.lit("Oak Press"))
    page = F.when(F.col("p_type") == "LARGE", F.concat(F.lit("A Title (Audible Audio Edition): "), "p_name", F.lit(", "), company, F.lit(" : Books"))).otherwise(F.lit("A Title"))
    featured = F.concat("p_name", F.lit(" (Sports #3) | "), F.when(F.col("p_size") > 25, F.lit("second")).otherwise(F.col("p_name")), F.lit(" | nan"))
    return t.part.select("p_partkey", TX.byline(line).alias("b"), TX.product_credits(page).alias("c"), TX.featured_titles(featured).alias("f")).select(
        "p_partkey", "b.author", "b.publisher", F.col("c.author").alias("credit_author"), F.col("c.publisher").alias("credit_publisher"), F.array_join("f", "|").alias("titles")
    )


@query(
    "agents",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN 'Ann ' || c_name WHEN 'HOUSEHOLD' THEN 'Ann Agent' WHEN 'AUTOMOBILE' THEN 'Bold Name Agency' END AS clean_name,
 CASE c_mktsegment WHEN 'FURNITURE' THEN 'Ann ' || c_name WHEN 'HOUSEHOLD' THEN 'Ann Agent' END AS from_text FROM customer""",
)
def agents(t: Tables) -> DataFrame:
    def case(values: dict[str, object]):
        out = None
        for segment, value in values.items():
            hit = F.col("c_mktsegment") == segment
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out.otherwise(F.lit("no"))

    raw = case(
        {
            "FURNITURE": F.concat(F.lit("**Ann "), "c_name", F.lit("** https://agency.example.net/x ")),
            "HOUSEHOLD": F.lit("[Ann Agent](https://x.example.net) ann@x.example.net, WEBSITE: more"),
            "AUTOMOBILE": F.lit("Bold Name Agency."),
            "BUILDING": F.lit("I was unable to find an agent"),
        }
    )
    prose = case(
        {
            "FURNITURE": F.concat(F.lit("She is represented by Ann "), "c_name", F.lit("; write soon")),
            "HOUSEHOLD": F.lit("Literary agent: Ann Agent at Big House. Thanks"),
            "AUTOMOBILE": F.lit("represented by the"),
        }
    )
    return t.customer.select("c_custkey", TX.clean_agent_name(raw).alias("clean_name"), TX.agent_from_text(prose).alias("from_text"))


@query(
    "letters",
    """WITH x AS (SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'Dr ' || s_name ELSE s_name || ' Writer' END AS author, CASE WHEN s_nationkey > 20 THEN 'No MG' WHEN s_nationkey > 10 THEN '$5,000 - $7,500' ELSE 'Up to $1,000' END AS fee, s_name FROM supplier)
SELECT s_suppkey, 'Dear ' || CASE WHEN author LIKE 'Dr %' THEN 'Author' ELSE s_name END || ', ' || CASE fee WHEN 'No MG' THEN 'Revenue Share Only' WHEN '$5,000 - $7,500' THEN '$7,500' ELSE '$1,000' END || ' for Show ' || s_suppkey || CASE WHEN s_suppkey > 50 THEN ' {open_item}' ELSE '' END AS letter, s_suppkey > 50 AS unfilled FROM x""",
)
def letters(t: Tables) -> DataFrame:
    author = F.when(F.col("s_acctbal") > 5000, F.concat(F.lit("Dr "), "s_name")).otherwise(F.concat("s_name", F.lit(" Writer")))
    fee = F.when(F.col("s_nationkey") > 20, F.lit("No MG")).when(F.col("s_nationkey") > 10, F.lit("$5,000 - $7,500")).otherwise(F.lit("Up to $1,000"))
    letter = TX.fill_template(
        "Dear {salutation}, {fee} for {show}{tail}",
        {"salutation": TX.salutation(author), "fee": TX.headline_fee(fee), "show": F.concat(F.lit("Show "), "s_suppkey"), "tail": F.when(F.col("s_suppkey") > 50, F.lit(" {open_item}"))},
    )
    return t.supplier.select("s_suppkey", letter.alias("letter")).withColumn("unfilled", TX.has_placeholder("letter"))


@query(
    "contact_descriptions",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority NOT LIKE '1%' THEN 'No contact info' ELSE concat_ws(' | ', CASE WHEN o_orderstatus <> 'P' THEN 'Email: c' || o_custkey || '@mail.example.net' END, CASE WHEN o_orderpriority LIKE '1%' THEN 'Agent: Ann' END) END AS description,
 concat_ws('; ', CASE WHEN o_orderstatus = 'F' THEN 'author corrected to Writer ' || o_custkey END, CASE WHEN o_orderpriority LIKE '2%' THEN 'series corrected to New Series' END) AS repairs FROM orders""",
)
def contact_descriptions(t: Tables) -> DataFrame:
    email = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("c"), "o_custkey", F.lit("@mail.example.net"))).otherwise(F.lit("nan"))
    agent = F.when(F.col("o_orderpriority").startswith("1"), F.lit(" Ann "))
    author = F.concat(F.lit("Writer "), F.col("o_custkey"))
    repairs = TX.repair_summary(
        [
            ("author", F.when(F.col("o_orderstatus") == "F", author).otherwise(F.lit("Old Name")), F.lit("old name!")),
            ("series", F.when(F.col("o_orderpriority").startswith("2"), F.lit("New Series")), F.lit("Old")),
        ]
    )
    return t.orders.select("o_orderkey", TX.labelled({"Email": email, "Agent": agent}, default="No contact info").alias("description"), repairs.alias("repairs"))


_PREFIX = f"""WITH {TITLED}, w AS (SELECT p_partkey, p_brand, title, string_split(title, ' ') AS w FROM titled), k AS (SELECT p_partkey, p_brand, w, unnest(range(2, len(w) + 1)) AS k FROM w),
p AS (SELECT p_partkey, p_brand, lower(array_to_string(w[1:k], ' ')) AS prefix, array_to_string(w[1:k], ' ') AS spelled, lower(coalesce(w[k + 1], '')) AS nxt FROM k),
n AS (SELECT p_brand, prefix, min(spelled) AS series_name FROM p GROUP BY 1, 2 HAVING count(DISTINCT nxt) > 1 OR (max(nxt) = '' AND count(*) > 1))
SELECT p_brand, series_name, p_partkey FROM p JOIN n USING (p_brand, prefix)"""


@query("prefix_series", _PREFIX)
def prefix_series(t: Tables) -> DataFrame:
    return clusters.common_prefix_series(titled_parts(t), "p_brand", "title", "p_partkey")


_STOP_WORDS = ", ".join(f"'{w}'" for w in TITLE_STOP_WORDS)


@query(
    "related_titles",
    # seeds: the first title of an author, then always the next one that shares no two words with a seed so far
    f"""WITH RECURSIVE w AS (
  SELECT p_partkey AS id, lower(trim(p_brand)) AS a,
    list_sort(list_distinct(list_filter(regexp_extract_all(lower(p_type) || ' ' || lower(p_name), '\\b[a-z]{{4,}}\\b'), lambda x: x NOT IN ({_STOP_WORDS})))) AS words
  FROM part
),
kept AS (SELECT * FROM w WHERE len(words) >= 2 AND a IN (SELECT a FROM w GROUP BY a HAVING count(*) >= 3)),
titles AS (SELECT a, words, min(id) AS idx, count(*) AS n FROM kept GROUP BY ALL),
near AS (
  SELECT x.a, x.idx, x.words, x.n, list(y.idx) FILTER (y.idx IS NOT NULL) AS earlier
  FROM titles x LEFT JOIN titles y ON x.a = y.a AND y.idx < x.idx AND len(list_intersect(x.words, y.words)) >= 2 GROUP BY ALL
),
seeds AS (
  SELECT a, min(idx) AS last, [min(idx)] AS so_far FROM near GROUP BY a
  UNION ALL
  SELECT seeds.a, min(near.idx), list_append(so_far, min(near.idx))
  FROM seeds JOIN near ON near.a = seeds.a AND near.idx > last AND NOT coalesce(list_has_any(so_far, earlier), false)
  GROUP BY seeds.a, last, so_far
),
every AS (SELECT a, last AS seed FROM seeds),
owner AS (
  SELECT near.a, near.idx, near.words, near.n, min(seed) AS seed
  FROM near JOIN every ON every.a = near.a AND (seed = idx OR list_contains(earlier, seed)) GROUP BY ALL
),
sizes AS (SELECT a, seed, sum(n)::BIGINT AS related FROM owner GROUP BY ALL HAVING sum(n) >= 2)
SELECT kept.id AS p_partkey, seed AS group_id, related FROM kept JOIN owner USING (a, words) JOIN sizes USING (a, seed)""",
)
def related_titles(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_brand", F.concat(F.lower("p_type"), F.lit(" "), "p_name").alias("title"))
    return clusters.related_titles(rows, "p_brand", "title", "p_partkey")


@query("verified_states")
def verified_states(t: Tables) -> DataFrame:
    rows = titled_parts(t).withColumn("books", F.when(F.col("p_size") > 25, F.pmod("p_size", F.lit(5))))
    related = clusters.related_titles(rows, "p_brand", "title", "p_partkey").select("p_partkey", "related")
    state = verification_state("title", F.lit(""), "books", F.lit(""), F.col("related"))
    return rows.join(related, "p_partkey", "left").select("p_partkey", state.alias("s")).select("p_partkey", "s.*")


# a name inside a title is one matching block, so the ratio is 2 * name / (title + name)
_CONTAINED_RATIO = "2.0::DOUBLE * length(p_name) / (length(title) + length(p_name))"
_CONTAINED_EDIT = "(1.0::DOUBLE - levenshtein(lower(title), lower(p_name)) / length(title))"


@query(
    "title_similarity",
    f"""WITH {TITLED} SELECT p_partkey, round(({_CONTAINED_RATIO} + {_CONTAINED_EDIT}) / 2, 6) AS mixed, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 1.0::DOUBLE ELSE 0.9::DOUBLE END AS contained,
 round({_CONTAINED_EDIT}, 6) AS edit, p_type IN ('PROMO', 'SMALL', 'LARGE', 'MEDIUM') AS same FROM titled""",
)
def title_similarity(t: Tables) -> DataFrame:
    rows = S.same_title(titled_parts(t), "title", "p_name")
    return rows.select(
        "p_partkey",
        "same",
        F.round(S.similarity("title", "p_name"), 6).alias("mixed"),
        F.round(S.title_similarity("title", "p_name"), 6).alias("contained"),
        F.round(S.edit_ratio("title", "p_name"), 6).alias("edit"),
    )


@query(
    "edit_ratios",
    f"""WITH {TITLED} SELECT p_partkey, round(1.0::DOUBLE - levenshtein(lower(title), lower(p_name)) / greatest(length(title), length(p_name)), 6) AS edit FROM titled""",
)
def edit_ratios(t: Tables) -> DataFrame:
    return titled_parts(t).select("p_partkey", F.round(S.edit_ratio("title", "p_name"), 6).alias("edit"))


_MAIL = "[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}"


@query(
    "extracted_emails",
    f"""WITH e AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '{_MAIL}')) AS l FROM documents) SELECT doc_id, len(l) AS n, (SELECT min(x) FROM (SELECT unnest(l) AS x)) AS least FROM e WHERE len(l) > 0""",
)
def extracted_emails(t: Tables) -> DataFrame:
    found = t.documents.select("doc_id", C.emails_in("text").alias("l")).filter("size(l) > 0")
    return found.select("doc_id", F.size("l").cast("long").alias("n"), F.array_min("l").alias("least"))


def _mail(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    email = (
        F.when(F.col("c_acctbal") < 1000, F.concat(F.lit("jane"), key, F.lit("author@gmail.com")))
        .when(F.col("c_acctbal") < 2000, F.concat(F.lit("press@house"), key, F.lit(".example.net")))
        .when(F.col("c_acctbal") < 3000, F.lit("noreply@site.com"))
        .when(F.col("c_acctbal") < 4000, F.concat(F.lit("logo"), key, F.lit("@2x.png")))
        .when(F.col("c_acctbal") < 5000, F.lit("user@domain.com"))
        .when(F.col("c_acctbal") < 6000, F.lit(""))
        .when(F.col("c_acctbal") < 7000, F.concat(F.lit("ann@agency"), key, F.lit(".example.net")))
        .otherwise(F.concat(F.lit("mailto:zoe"), key, F.lit("@zoe"), key, F.lit(".com?subject=x")))
    )
    return t.customer.select("c_custkey", "c_name", "c_acctbal", email.alias("email"))


@query(
    "email_rules",
    """WITH m AS (SELECT c_custkey, CASE WHEN c_acctbal < 1000 THEN 'A' WHEN c_acctbal < 2000 THEN 'B' WHEN c_acctbal < 3000 THEN 'C' WHEN c_acctbal < 4000 THEN 'D' WHEN c_acctbal < 5000 THEN 'E' WHEN c_acctbal < 6000 THEN 'F' WHEN c_acctbal < 7000 THEN 'G' ELSE 'H' END AS k FROM customer)
SELECT c_custkey, k IN ('A', 'B', 'G', 'H') AS valid, k = 'A' AS fabricated, k = 'B' AS publicity, CASE k WHEN 'A' THEN 'FABRICATION_PATTERN' WHEN 'B' THEN 'PUBLICITY_NOT_DIRECT' WHEN 'E' THEN 'KNOWN_BAD' WHEN 'F' THEN 'MISSING' ELSE 'NEEDS_VERIFICATION' END AS quality,
 CASE k WHEN 'H' THEN 'zoe' || c_custkey || '@zoe' || c_custkey || '.com' END AS own FROM m""",
)
def email_rules(t: Tables) -> DataFrame:
    return _mail(t).select(
        "c_custkey",
        C.valid_email("email").alias("valid"),
        C.looks_fabricated("email").alias("fabricated"),
        C.is_publicity("email").alias("publicity"),
        C.email_quality("email").alias("quality"),
        F.when(F.col("c_acctbal") >= 7000, C.clean_email("email")).alias("own"),
    )


@query(
    "contact_classes",
    """WITH m AS (SELECT c_custkey, CASE WHEN c_acctbal < 1000 THEN 'A' WHEN c_acctbal < 2000 THEN 'B' WHEN c_acctbal < 3000 THEN 'C' WHEN c_acctbal < 4000 THEN 'D' WHEN c_acctbal < 5000 THEN 'E' WHEN c_acctbal < 6000 THEN 'F' WHEN c_acctbal < 7000 THEN 'G' ELSE 'H' END AS k FROM customer)
SELECT c_custkey, CASE k WHEN 'A' THEN 'direct' WHEN 'B' THEN 'other' WHEN 'C' THEN 'other' WHEN 'G' THEN 'agent' WHEN 'H' THEN 'direct' END AS kind,
 CASE k WHEN 'A' THEN 'a' WHEN 'H' THEN 'h' END AS direct, CASE k WHEN 'G' THEN 'g' END AS agent, CASE WHEN k IN ('B', 'C', 'D', 'E') THEN lower(k) END AS other FROM m""",
)
def contact_classes(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    band = (
        F.when(F.col("c_acctbal") < 1000, F.lit("a"))
        .when(F.col("c_acctbal") < 2000, F.lit("b"))
        .when(F.col("c_acctbal") < 3000, F.lit("c"))
        .when(F.col("c_acctbal") < 4000, F.lit("d"))
        .when(F.col("c_acctbal") < 5000, F.lit("e"))
        .when(F.col("c_acctbal") < 6000, F.lit("f"))
        .when(F.col("c_acctbal") < 7000, F.lit("g"))
        .otherwise(F.lit("h"))
    )
    rows = _mail(t).select(
        "c_custkey", band.alias("band"), C.clean_email("email").alias("email"), F.lit("Jane Writer").alias("author"),
        F.when(F.col("c_acctbal") >= 7000, F.concat(F.lit("https://www.zoe"), key, F.lit(".com/contact"))).alias("site"),
        F.when(F.col("c_acctbal").between(6000, 6999.995), F.lit("for film rights write to")).alias("context"),
    )
    none = F.lit(None).cast("string")
    moved = C.demoted_contacts("email", none, none, "author", "site", none)
    out = rows.select("c_custkey", "band", "email", C.classify_contact("email", "author", "site", "context").alias("kind"), moved.alias("m"))
    letter = lambda c: F.when(F.col(c).isNotNull(), F.col("band"))
    return out.select("c_custkey", "kind", letter("m.direct").alias("direct"), letter("m.agent").alias("agent"), letter("m.other").alias("other"))


@query(
    "picked_emails",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'team@house.example.net' WHEN o_orderstatus = 'O' THEN 'zoe.writer@mail.example.net' END AS picked, CASE WHEN o_orderstatus = 'F' THEN 'hello@own.example.net' WHEN o_orderstatus = 'O' THEN 'info@own.example.net' END AS scored FROM orders""",
)
def picked_emails(t: Tables) -> DataFrame:
    def mails(*values: str):
        return F.array(*[F.lit(v) for v in values])

    status = F.col("o_orderstatus")
    several = (
        F.when(status == "F", mails("user@domain.com", "team@house.example.net", "b@c.example.net"))
        .when(status == "O", mails("team@house.example.net", "zoe.writer@mail.example.net"))
        .otherwise(mails("noreply@x.example.net"))
    )
    own = (
        F.when(status == "F", mails("a.person@other.example.net", "hello@own.example.net"))
        .when(status == "O", mails("info@own.example.net", "zz@own.example.net"))
        .otherwise(mails("bad"))
    )
    none = F.array().cast("array<string>")
    return t.orders.select(
        "o_orderkey",
        C.pick_email(several, F.lit("Zoe Writer")).alias("picked"),
        C.best_scored_email(own, F.lit("own.example.net"), none, none).alias("scored"),
    )


@query(
    "social_links",
    """SELECT s_suppkey, 'https://www.instagram.com/s' || s_suppkey AS instagram, 'https://x.com/s' || s_suppkey AS twitter, CASE WHEN s_nationkey > 12 THEN 'https://tiktok.com/@s' || s_suppkey END AS tiktok, 'http://facebook.com/s' || s_suppkey AS blob_facebook, 'twitter.com/s' || s_suppkey AS blob_twitter FROM supplier""",
)
def social_links(t: Tables) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    page = F.concat(
        F.lit("see https://www.instagram.com/s"), key, F.lit(" and https://x.com/s"), key, F.lit("? or https://x.com/other "),
        F.when(F.col("s_nationkey") > 12, F.concat(F.lit("https://tiktok.com/@s"), key)).otherwise(F.lit("")),
    )
    blob = F.concat(F.lit("twitter.com/s"), key, F.lit("; http://facebook.com/s"), key, F.lit(" | http://facebook.com/second"))
    return t.supplier.select("s_suppkey", C.social_links(page).alias("p"), C.split_social_blob(blob).alias("b")).select(
        "s_suppkey", "p.instagram", "p.twitter", "p.tiktok", F.col("b.facebook").alias("blob_facebook"), F.col("b.twitter").alias("blob_twitter")
    )


@query(
    "url_parts",
    """SELECT page_id, nullif(replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), 'www.', ''), '') AS host, regexp_extract(url, '^([^?#]*)', 1) AS bare, TRY_CAST(nullif(regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '/([0-9]+)([^/0-9][^/]*)?/?$', 1), '') AS BIGINT) AS path_id,
 url AS full_url, regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '([^/]*)$', 1) IS NOT NULL AS has_tail FROM pages""",
)
def url_parts(t: Tables) -> DataFrame:
    scheme = F.regexp_replace("url", "^http://", "")
    full = F.when(F.col("url").startswith("http://"), F.regexp_replace(U.ensure_scheme(scheme), "^https", "http")).otherwise(U.ensure_scheme("url"))
    return t.pages.select(
        "page_id", U.host("url").alias("host"), U.strip_query("url").alias("bare"), U.path_id("url").alias("path_id"), full.alias("full_url"),
        U.slug_text("url").isNotNull().alias("has_tail"),
    )


@query(
    "slug_matches",
    "SELECT p_partkey, p_type <> 'PROMO' AS matches, CAST(p_partkey AS VARCHAR) AS catalogue_id, true AS own_site FROM part",
)
def slug_matches(t: Tables) -> DataFrame:
    url = F.concat(F.lit("https://catalogue.example.com/book/show/"), F.col("p_partkey"), F.lit("-"), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))
    guide = F.when(F.col("p_type") == "PROMO", F.concat(F.lit("https://catalogue.example.com/book/show/7-summary-of-"), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))).otherwise(url)
    return titled_parts(t).select("p_partkey", U.slug_matches(guide, "title").alias("matches"), U.catalogue_id(url).alias("catalogue_id"), U.is_own_site(url).alias("own_site"))


@query(
    "evidence_on_pages",
    """WITH c AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'charset' WHEN o_orderstatus = 'O' THEN 'No Such Name' ELSE '' END AS series, CASE WHEN o_orderpriority LIKE '1%' THEN 'track(' ELSE 'nobody at all' END AS author, o_orderkey % n AS p1, o_custkey % n AS p2
  FROM orders, (SELECT max(page_id) * 2 AS n FROM pages)),
l AS (SELECT o_orderkey, series, author, p1 AS p FROM c UNION SELECT o_orderkey, series, author, p2 FROM c),
v AS (SELECT page_id, html FROM pages UNION ALL SELECT page_id, 'an older version by nobody at all' FROM pages WHERE page_id % 3 = 0),
j AS (
  SELECT l.*, max(page_id) IS NOT NULL AS f,
    coalesce(bool_or((series <> '' AND contains(lower(html), lower(series))) OR contains(lower(html), lower(author))), false) AS m
  FROM l LEFT JOIN v ON page_id = p GROUP BY ALL
)
SELECT o_orderkey, count(*) FILTER (m) AS matched, count(*) FILTER (f) AS fetched, CASE WHEN bool_or(m) THEN 'PASS' WHEN bool_or(f) THEN 'PARTIAL' ELSE 'FAIL' END AS status FROM j GROUP BY 1""",
)
def evidence_on_pages(t: Tables) -> DataFrame:
    """Links spread over twice the range of the pages; every third page is stored in two versions."""
    address = F.concat(F.lit("https://p.example.com/"), F.col("page_id")).alias("url")
    older = t.pages.filter("page_id % 3 = 0").select(address, F.lit("an older version by nobody at all").alias("html"))
    stored = t.pages.select(address, "html").union(older)
    n = F.lit(t.pages.agg(F.max("page_id")).first()[0] * 2)
    links = F.array(*[F.concat(F.lit("https://p.example.com/"), F.pmod(key, n)) for key in ("o_orderkey", "o_custkey")])
    series = F.when(F.col("o_orderstatus") == "F", F.lit("charset")).when(F.col("o_orderstatus") == "O", F.lit("No Such Name")).otherwise(F.lit(""))
    author = F.when(F.col("o_orderpriority").startswith("1"), F.lit("Track(")).otherwise(F.lit("nobody at all"))
    claims = t.orders.select("o_orderkey", series.alias("series"), author.alias("author"), F.explode(links).alias("url"))
    return evidence_status(claims, stored, "o_orderkey", ["series", "author"])


@query(
    "author_candidates",
    """WITH u AS (SELECT c_mktsegment AS a, 'm' || (c_custkey % 5) || '@mail.example.net' AS email, CASE WHEN c_nationkey < 3 THEN 'https://site' || c_nationkey || '.example.net' ELSE 'https://twitter.com/x' END AS site, CASE WHEN c_nationkey > 20 THEN 'Ann Agent' ELSE 'the' END AS agent FROM customer
 UNION ALL SELECT 'BUILDING', 'noreply@x.example.net', '', 'Bob Agent' FROM supplier),
s AS (SELECT DISTINCT a, 'email' AS kind, email AS value FROM u WHERE email NOT LIKE 'noreply%' UNION SELECT DISTINCT a, 'site', site FROM u WHERE site LIKE '%example%' UNION SELECT DISTINCT a, 'agent', agent FROM u WHERE agent LIKE '% %')
SELECT lower(a) AS author_key, kind, value FROM s""",
)
def contact_candidates(t: Tables) -> DataFrame:
    first = t.customer.select(
        F.col("c_mktsegment").alias("author"), F.concat(F.lit("m"), F.pmod("c_custkey", F.lit(5)), F.lit("@mail.example.net")).alias("email"),
        F.when(F.col("c_nationkey") < 3, F.concat(F.lit("https://site"), "c_nationkey", F.lit(".example.net"))).otherwise(F.lit("https://twitter.com/x")).alias("site"),
        F.when(F.col("c_nationkey") > 20, F.lit("Ann Agent")).otherwise(F.lit("the")).alias("agent"),
    )
    second = t.supplier.select(F.lit("BUILDING").alias("author"), F.lit("noreply@x.example.net").alias("email"), F.lit("").alias("site"), F.lit("Bob Agent").alias("agent"))
    return author_candidates([first, second])


@query(
    "checked_evidence",
    """WITH c AS (SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'yes_series_level' WHEN '2' THEN 'yes_author_level' WHEN '3' THEN 'no' ELSE 'maybe' END AS s, o_orderstatus = 'F' AS a, o_totalprice > 250000 AS b FROM orders)
SELECT o_orderkey, CASE WHEN s = 'yes_series_level' AND a THEN 'yes_series_level' WHEN s = 'yes_series_level' AND b THEN 'yes_author_level' WHEN s = 'yes_author_level' AND (a OR b) THEN 'yes_author_level' ELSE 'no' END AS status FROM c""",
)
def checked_evidence(t: Tables) -> DataFrame:
    first = F.substring("o_orderpriority", 1, 1)
    claim = F.when(first == "1", F.lit("yes_series_level")).when(first == "2", F.lit("yes_author_level")).when(first == "3", F.lit("no")).otherwise(F.lit("maybe"))
    by_series = F.when(F.col("o_orderstatus") == "F", F.lit("https://www.audio.example.com/a")).otherwise(F.lit("https://elsewhere.example.net/a"))
    by_author = F.when(F.col("o_totalprice") > 250000, F.lit("https://audio.example.com/b")).otherwise(F.lit("none"))
    return t.orders.select("o_orderkey", C.checked_evidence(claim, by_series, by_author, ["audio.example.com"])["status"].alias("status"))


@query(
    "page_fields",
    """SELECT page_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]+>', ' ', 'g'), '&amp;', '&', 'g'), '\\s+', ' ', 'g')), '') AS title,
 len(regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1)) AS links, regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1)[1] AS first_link FROM pages""",
)
def page_fields(t: Tables) -> DataFrame:
    return t.pages.select("page_id", H.tag_text("html", "title").alias("title"), H.links("html").alias("l")).select(
        "page_id", "title", F.size("l").cast("long").alias("links"), F.try_element_at("l", F.lit(1)).alias("first_link")
    )


_SYNOPSIS = "Two rivals share one rink, one winter and one secret that neither of them can keep."


def _book_page(t: Tables) -> DataFrame:
    """Catalogue and product pages written around the stored pages."""
    rating = F.round(3 + F.pmod("page_id", F.lit(20)) / 10, 1).cast("string")
    number = F.col("page_id").cast("string")
    data = F.concat(
        F.lit('<script type="application/ld+json">{"name": "Book ('), number, F.lit(')", "author": [{"name": "Ann Lee"}, {"name": "Bo Ray"}], "numberOfPages": '),
        F.pmod("page_id", F.lit(700)), F.lit(', "aggregateRating": {"ratingValue": '), rating, F.lit(', "ratingCount": '), F.col("page_id") * 10 + 7, F.lit(', "reviewCount": 12}}</script>'),
        F.lit('<h3 aria-label="Book Series"><a href="/series/'), number, F.lit('"><span>Forge</span> #'), number, F.lit("</a></h3>"),
    )
    visible = F.lit(
        '<h1 data-testid="bookTitle">Iron <b>Book</b> (Forge Series, #2)</h1><span class="ContributorLink__name">Ann Lee</span>'
        '<span data-testid="ratingsCount">1,234 ratings</span><span data-testid="reviewsCount">56 reviews</span><div class="RatingStatistics__rating">4.25</div>'
        '<p data-testid="pagesFormat">312 pages, Kindle</p><div data-testid="publicationInfo"><div>First</div> published May 3, 2021 by Oak &amp; Co</div>'
    )
    both = F.concat(
        F.lit(
            '<div class="BookPageMetadataSection__genres"><span class="Button__labelItem">Rom<i>ance</i></span><span class="x Button__labelItem">Sports</span></div>'
            f'<div data-testid="description"><div><span class="Formatted">{_SYNOPSIS}<br></span></div></div>'
            '<div class="CollapsableList"><div class="DescListItem"><dt>Original title</dt><dd><div>Iron <div>One</div></div></dd></div>'
            '<div class="DescListItem"><dt>ASIN</dt><dd>B0'
        ),
        number,
        F.lit(
            '</dd></div><div class="DescListItem"><dt>Awards</dt><dd>Pen</dd></div><div class="DescListItem"><dt>Literary awards</dt><dd>Ink</dd></div></div>'
            '<div class="BookPageMetadataSection__buyButtons"><a href="javascript:x">Kindle</a><a href="/buy/'
        ),
        number,
        F.lit('">Kindle <b>$3</b></a></div>'),
    )
    shop = F.concat(
        F.lit('<span id="productTitle"> Iron  Book </span><div class="author"><a class="a-link-normal" href="/a">Ann Lee</a></div><span id="acrCustomerReviewText">'),
        number,
        F.lit(
            ' ratings</span><div id="detailBullets_feature_div"><ul class="detail-bullet-list"><li><span class="a-list-item"><span class="a-text-bold">Publisher :</span>'
            '<span>Oak Press (May 3, 2021)</span></span><li>Print length : 287 pages<li><span class="a-text-bold">Publication date :</span> May 3, 2021'
            '<li><span class="a-text-bold">Book 2 of 5:</span> <a class="a-link-normal"><span>Forge</span></a>'
            '<li><span class="a-text-bold">Best Sellers Rank:</span> #88 in Store (See Top 100 in Store)<ul class="zg_hrsr"><li><span class="a-list-item">#'
        ),
        number,
        F.lit(' in <a>Sports</a></span></li><li><span class="a-list-item">#7 in Hockey &amp; More</span></li></ul></li></ul></div>'),
    )
    catalogue = F.concat(F.when(F.col("url").contains("/en/"), data).otherwise(visible), both, "html")
    return t.pages.select("page_id", F.col("url").contains("/en/").alias("structured"), catalogue.alias("html"), F.concat(shop, "html").alias("shop"))


@query(
    "book_pages",
    f"""WITH p AS (SELECT page_id, contains(url, '/en/') AS s FROM pages)
SELECT page_id, s AS structured, CASE WHEN s THEN 'Book (' || page_id || ')' ELSE 'Iron Book (Forge Series, #2)' END AS title, CASE WHEN s THEN 'Ann Lee, Bo Ray' ELSE 'Ann Lee' END AS author,
 CASE WHEN s THEN round(3 + (page_id % 20) / 10.0::DOUBLE, 1) ELSE 4.25 END AS rating, CASE WHEN s THEN page_id * 10 + 7 ELSE 1234 END AS rating_count, CASE WHEN s THEN 12 ELSE 56 END::BIGINT AS review_count,
 CASE WHEN s THEN CASE WHEN page_id % 700 > 0 THEN CAST(page_id % 700 AS INTEGER) END ELSE 312 END AS pages, CASE WHEN NOT s THEN 'May 3, 2021' END AS published, CASE WHEN NOT s THEN 'Oak & Co' END AS publisher,
 'B0' || page_id AS asin, 'Pen, Ink' AS awards, 'Iron One' AS original_title, 'Romance|Sports' AS genres, '{_SYNOPSIS}' AS synopsis,
 CASE WHEN s THEN 'Forge #' || page_id ELSE 'Forge Series, #2' END AS series, CASE WHEN s THEN 'https://site.example.com/series/' || page_id END AS series_url,
 CASE WHEN s THEN CAST(page_id AS VARCHAR) ELSE '2' END AS number, 'https://site.example.com/buy/' || page_id AS store_url FROM p""",
)
def book_pages(t: Tables) -> DataFrame:
    rows = _book_page(t).select("page_id", "structured", P.book_fields("html", "https://site.example.com").alias("b"))
    names = "title author rating rating_count review_count pages published publisher asin awards original_title synopsis series series_url number store_url".split()
    return rows.select("page_id", "structured", *[F.col(f"b.{n}").alias(n) for n in names], F.array_join("b.genres", "|").alias("genres"))


@query(
    "shop_pages",
    """SELECT page_id, 'Iron Book' AS title, 'Ann Lee' AS author, page_id AS rating_count, 'Forge' AS series, '2' AS number, '5' AS total_books, 287 AS pages, 'Oak Press' AS publisher, 'May 3, 2021' AS published,
 '#' || page_id || ' in Sports | #7 in Hockey & More' AS best_rank FROM pages""",
)
def shop_pages(t: Tables) -> DataFrame:
    rows = _book_page(t).select("page_id", P.product_fields("shop").alias("p"))
    return rows.select("page_id", *[F.col(f"p.{n}").alias(n) for n in "title author rating_count series number total_books pages publisher published best_rank".split()])


@query(
    "plain_pages",
    """WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', ' ', 'g') AS x FROM pages), b AS (SELECT page_id, regexp_replace(x, '<[^>]+>', ' ', 'g') AS x FROM a),
c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS x FROM b)
SELECT page_id, md5(regexp_replace(regexp_replace(x, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), '[\\s\\p{Z}]+', ' ', 'g')) AS digest FROM c""",
)
def plain_pages(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(H.plain_text("html")).alias("digest"))


_ITEM = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])


@query(
    "lenient_json",
    """WITH e AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) SELECT event_id, CASE WHEN event_type = 'click' THEN 2 WHEN event_type = 'error' THEN 2 ELSE 1 END AS n, k AS first_k, CASE WHEN event_type IN ('click', 'error') THEN k + 1 ELSE k END AS last_k FROM e""",
)
def lenient_json(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    two = F.concat(F.lit('{"k": '), k, F.lit(', "name": "a",}, {"k": '), k + 1, F.lit(', "name": "b"}'))
    text = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("```json\n["), two, F.lit(",]\n```")))
        .when(F.col("event_type") == "error", F.concat(F.lit("Sorry, here: "), two, F.lit(" and {broken")))
        .when(F.col("event_type") == "view", F.concat(F.lit("Answer [{"), F.regexp_replace("props", "^\\{|\\}$", ""), F.lit("}] end")))
        .otherwise(F.col("props"))
    )
    rows = K.lenient_rows(text, _ITEM)
    return t.events.select("event_id", rows.alias("r")).select(
        "event_id", F.size("r").alias("n"), F.try_element_at("r", F.lit(1))["k"].alias("first_k"), F.try_element_at("r", F.lit(-1))["k"].alias("last_k")
    )


@query(
    "answer_envelopes",
    """SELECT event_id, event_type || ' ' || props AS text, CASE WHEN value > 10 THEN 2 ELSE 1 END AS sources, 'https://a.example.com/' || user_id AS first_source FROM events""",
)
def answer_envelopes(t: Tables) -> DataFrame:
    uri = F.concat(F.lit("https://a.example.com/"), F.col("user_id").cast("string"))
    second = F.when(F.col("value") > 10, F.lit("https://b.example.com/")).otherwise(uri)

    def web(u):
        return F.struct(F.struct(u.alias("uri")).alias("web"))

    parts = F.array(F.struct(F.col("event_type").alias("text")), F.struct(F.col("props").alias("text")))
    candidate = F.struct(
        F.struct(parts.alias("parts")).alias("content"), F.struct(F.array(web(uri), web(second), web(uri)).alias("groundingChunks")).alias("groundingMetadata")
    )
    envelope = F.to_json(F.struct(F.array(candidate).alias("candidates")))
    return t.events.select("event_id", envelope.alias("e")).select("event_id", K.answer_text("e").alias("text"), K.answer_sources("e").alias("s")).select(
        "event_id", "text", F.size("s").alias("sources"), F.try_element_at("s", F.lit(1)).alias("first_source")
    )


_PAYLOAD_KEYS = {"represented": "represented_by_agency", "check_status": "imprint_check", "check_url": "imprint_url", "check_note": "imprint_note", "author_check_url": "author_level_url"}


@query(
    "author_payloads",
    """WITH l AS (
  SELECT *, CAST(l_quantity AS BIGINT) AS works FROM lineitem WHERE l_quantity >= 5 AND NOT (l_returnflag = 'N' AND l_linestatus = 'O')
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_returnflag WHEN 'R' THEN 'given' ELSE 'Writer ' || l_suppkey END AS author,
  'Saga ' || l_partkey AS series_name, works AS primary_works, CASE WHEN works = 5 THEN 'eq5_included' ELSE 'gt5_or_more' END AS threshold_flag,
  CAST(round(3 + 20 * l_discount, 2) AS DOUBLE) AS rating, 'sports' AS genre, 'he / she' AS lead_pairing, 'rivals' AS primary_trope,
  CASE WHEN l_partkey % 3 = 0 THEN 'yes_series_level' WHEN l_partkey % 3 = 1 AND l_returnflag <> 'R' THEN 'yes_author_level' ELSE 'no' END AS check_status,
  CASE WHEN l_partkey % 3 = 0 THEN 'https://audio.example.com/' || l_partkey WHEN l_partkey % 3 = 1 AND l_returnflag <> 'R' THEN 'https://audio.example.com/a' END AS check_url,
  'seen ' || l_linenumber AS check_note, CASE WHEN l_returnflag <> 'R' THEN 'https://audio.example.com/a' END AS author_check_url,
  'http://a | http://b' AS support_urls, 'sure' AS confidence_notes
FROM l""",
)
def author_payloads(t: Tables) -> DataFrame:
    """Payloads in three shapes, under a client's own key names."""

    def text(name: str, value) -> Column:
        return F.concat(F.lit(f'"{name}": "'), value, F.lit('"'))

    works = F.col("l_quantity").cast("long").cast("string")
    rating = F.round(3 + 20 * F.col("l_discount"), 2).cast("string")
    third = F.col("l_partkey") % 3
    check = F.when(third == 0, F.lit("Yes_series_level")).when(third == 1, F.lit("yes_series_level")).otherwise(F.lit("perhaps"))
    host = F.when(third == 0, F.lit("https://audio.example.com/")).otherwise(F.lit("https://elsewhere.example.net/"))
    fixed = '"genre_bucket": "sports", "lead_pairing": "he / she", "sub_genre": null, "primary_trope": " rivals ", "support_urls": ["http://a", " http://b", "http://a"], "confidence_notes": "sure"'
    parts = [
        text("series_name", F.concat(F.lit("Saga "), F.col("l_partkey"))), text("primary_works", works), F.concat(F.lit('"first_book_goodreads_rating": '), rating),
        text("imprint_check", check), text("imprint_url", F.concat(host, F.col("l_partkey"))), text("imprint_note", F.concat(F.lit("seen "), F.col("l_linenumber"))), F.lit(fixed),
    ]
    series = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    small = F.lit('{"series_name": "Small", "primary_works": 2}')
    represented = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit("false")).otherwise(F.lit("true"))
    head = F.concat(text("author_name", F.concat(F.lit("Writer "), F.col("l_suppkey"))), F.lit(', "represented_by_agency": '), represented)
    payload = F.concat(F.lit("{"), head, F.lit(', "author_level_url": "https://audio.example.com/a", "qualifying_series": ['), small, F.lit(", "), series, F.lit("]}"))
    answer = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("```json\n["), payload, F.lit("]\n```")))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("["), series, F.lit(", "), small, F.lit("]")))
        .otherwise(payload)
    )
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    parsed = t.lineitem.select(*ids, K.author_payload(answer, F.lit("given"), _PAYLOAD_KEYS).alias("p"))
    found = F.explode(K.qualifying_series(F.col("p"), domains=["audio.example.com"]))
    rows = parsed.select(*ids, F.col("p.author_name").alias("author"), found.alias("s"))
    delivered = ["genre", "lead_pairing", "primary_trope", "check_status", "check_url", "check_note", "author_check_url", "support_urls", "confidence_notes"]
    return rows.select(*ids, "author", "s.series_name", "s.primary_works", "s.threshold_flag", F.col("s.first_book_rating").alias("rating"), *[f"s.{c}" for c in delivered])


@query(
    "catalogue_records",
    """SELECT p_partkey, p_name AS title, CASE WHEN p_type IN ('PROMO', 'LARGE') THEN p_brand WHEN p_type IN ('SMALL', 'MEDIUM') THEN p_brand || ' first' ELSE p_brand || ' store' END AS author, CASE WHEN p_type IN ('PROMO', 'LARGE', 'SMALL', 'MEDIUM') THEN p_size END AS pages,
 CASE WHEN p_type IN ('PROMO', 'LARGE') THEN '978' || p_partkey WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'i' || p_partkey END AS isbn, CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 2019 WHEN p_type IN ('SMALL', 'MEDIUM') THEN 2020 ELSE 2021 END AS pub_year FROM part""",
)
def catalogue_records(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")

    def ident(kind: str, value):
        return F.struct(F.lit(kind).alias("type"), value.alias("identifier"))

    volume = F.to_json(
        F.struct(
            key.alias("id"),
            F.struct(
                F.col("p_name").alias("title"), F.array("p_brand", F.lit("Second")).alias("authors"), F.col("p_size").alias("pageCount"), F.lit("2019-03-01").alias("publishedDate"),
                F.array(ident("ISBN_10", key), ident("ISBN_13", F.concat(F.lit("978"), key))).alias("industryIdentifiers"),
            ).alias("volumeInfo"),
        )
    )
    doc = F.to_json(
        F.struct(
            key.alias("key"), F.col("p_name").alias("title"), F.array(F.concat("p_brand", F.lit(" first")), F.lit("x")).alias("author_name"), F.lit(2020).alias("first_publish_year"),
            F.col("p_size").alias("number_of_pages_median"), F.array(F.concat(F.lit("i"), key)).alias("isbn"),
        )
    )
    store = F.to_json(
        F.struct(F.col("p_partkey").alias("trackId"), F.col("p_name").alias("trackName"), F.concat("p_brand", F.lit(" store")).alias("artistName"), F.lit("2021-01-05T08:00:00Z").alias("releaseDate"))
    )
    kind = F.when(F.col("p_type").isin("PROMO", "LARGE"), F.lit("volume")).when(F.col("p_type").isin("SMALL", "MEDIUM"), F.lit("doc")).otherwise(F.lit("store"))
    raw = t.part.select("p_partkey", kind.alias("kind"), F.when(kind == "volume", volume).when(kind == "doc", doc).otherwise(store).alias("json"))
    records = F.when(F.col("kind") == "volume", K.catalogue_record("json", "volume")).when(F.col("kind") == "doc", K.catalogue_record("json", "doc")).otherwise(K.catalogue_record("json", "store"))
    return raw.select("p_partkey", records.alias("r")).select("p_partkey", "r.title", "r.author", "r.pages", "r.isbn", "r.pub_year")


@query(
    "tagged_lines",
    """SELECT p_partkey, CASE WHEN p_size > 10 THEN p_name END AS series, CAST(p_size AS VARCHAR) || ' primary works' AS books, p_size AS n, CASE WHEN p_size > 10 THEN CASE WHEN p_size > 30 THEN 'search-grounded' ELSE 'search-ungrounded' END END AS source FROM part""",
)
def tagged_lines(t: Tables) -> DataFrame:
    line = F.concat(
        F.lit("Series: "), F.when(F.col("p_size") > 10, F.col("p_name")).otherwise(F.lit("unknown")), F.lit(" | BOOKS: "), F.col("p_size").cast("string"), F.lit(" primary works | FIRST: N/A")
    )
    sources = F.when(F.col("p_size") > 30, F.array(F.lit("https://catalogue.example.com/s"))).otherwise(F.array(F.lit("https://other.example.net")))
    tags = K.tagged_line(line, ["SERIES", "BOOKS", "FIRST"])
    return t.part.select("p_partkey", tags.alias("x"), sources.alias("s")).select(
        "p_partkey", "x.series", "x.books", F.regexp_extract("x.books", "([0-9]+)", 1).cast("int").alias("n"),
        K.grounded_label(F.col("x.series").isNotNull(), "s", "catalogue.example.com").alias("source"),
    )


@query(
    "title_results",
    """WITH r AS (SELECT lower(trim(p_name)) AS k, arg_min(p_type, p_partkey) AS found FROM part WHERE p_partkey % 5 <> 0 GROUP BY 1)
SELECT p_partkey, found FROM part LEFT JOIN r ON lower(trim(p_name)) = k""",
)
def title_results(t: Tables) -> DataFrame:
    """Answers in another case, several for a title, and none for some."""
    answers = t.part.filter("p_partkey % 5 <> 0").select(F.concat(F.lit(" "), F.upper("p_name")).alias("title"), F.col("p_type").alias("found"), F.col("p_partkey").alias("ord"))
    asked = t.part.select("p_partkey", "p_name")
    return J.answers_by_title(asked, answers, "p_name", "title", ["found"], [F.col("ord")]).select("p_partkey", "found")


@query(
    "merged_links",
    """SELECT page_id, CASE WHEN contains(url, 'page=2') THEN url || '|http://x.example.net' ELSE url END AS links FROM pages""",
)
def merged_links(t: Tables) -> DataFrame:
    extra = F.when(F.col("url").contains("page=2"), F.array(F.lit("http://x.example.net"), F.lit("ftp://no")))
    merged = K.merge_links(F.array("url"), F.array("url", F.lit("none")), extra)
    return t.pages.select("page_id", F.array_join(merged, "|").alias("links"))
