"""One query for each operator over its whole table, and the SQL that gives the same rows where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under a name, with its SQL."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def held_out(id: str, parts: int, part: int):
    """True for rows whose crc32 of the id as text leaves that remainder."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % parts == part


@query("op3_packing")
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from shelfmark.llm.packing import pack_documents

    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


# words without white space; a window is 35 of them in a row
_OP6 = r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 34], ' ') AS body
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM w)
),
twice AS (SELECT body FROM win GROUP BY body HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS i
  FROM win JOIN twice USING (body)
),
lost AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
    CASE WHEN gone IS NULL THEN ws ELSE [ws[i] FOR i IN generate_series(1, len(ws)) IF NOT list_contains(gone, i)] END AS kept
  FROM w LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM kept"""


@query("op6_substring_dedup", _OP6)
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.passages import remove_repeated

    return remove_repeated(table(spark, folder, "documents"), width=35, digest=True)


# (verdict, host, path), fixed by the task
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

_OP7 = r"""WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
rules (verdict, r_host, r_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
fits AS (
  SELECT page_id, verdict, r_host || r_path AS rule,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r_host) DESC, length(r_path) DESC) AS rn
  FROM p JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM fits WHERE rn = 1) USING (page_id)"""


@query("op7_url_filter", _OP7)
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.urls import judge_urls

    return judge_urls(table(spark, folder, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op8_bpe")
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from shelfmark.llm.bpe import read_ranks, token_digests

    return token_digests(table(spark, folder, "documents"), read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))


_OP9 = r"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 2, 1))) AS i FROM w WHERE len(ws) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 90 * (x.n + y.n - shared.n)
),
reach (a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN low USING (doc_id)"""


@query("op9_jaccard_join", _OP9)
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.jaccard import Similarity, similar_groups

    return similar_groups(table(spark, folder, "documents"), Similarity(words=3, num=90, den=100)).select("doc_id", "n_shingles", "component_id")


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.toxicity import score_toxicity

    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = score_toxicity(documents, labels.filter(~held_out("doc_id", 5, 0)))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


@query("op2_language")
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.language import identify_languages

    documents = table(spark, folder, "documents")
    found = identify_languages(documents, documents.filter(~held_out("doc_id", 4, 2)))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query("op5_secrets")
def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.secrets import BASE, find_secrets

    found = find_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of(kind) for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


_OP4 = r"""WITH RECURSIVE v AS (
  SELECT vec_id, CASE WHEN len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN list_transform(embedding, lambda x: x::DOUBLE) END AS e
  FROM embeddings
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) >= 0.9 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))
),
reach (a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a AS vec_id, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
  vec_id <= coalesce(b, vec_id) AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN low USING (vec_id)"""


@query("op4_embedding_dedup", _OP4)
def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, folder, "embeddings"), 0.9)


@query("op10_nearest_neighbours")
def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.neighbours import nearest_neighbours

    rows = table(spark, folder, "embeddings")
    return nearest_neighbours(rows, rows.filter(F.col("vec_id") % 20 == 0), 20)


# words of digits, letters and characters from U+0080 on; a window is 10 of them in a row, or a whole shorter item
_OP11 = r"""WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
),
win AS (
  SELECT DISTINCT item, size, array_to_string(ws[i : i + size - 1], ' ') AS body
  FROM (SELECT item, ws, least(len(ws), 10) AS size, unnest(generate_series(1, len(ws) - least(len(ws), 10) + 1)) AS i FROM b WHERE len(ws) > 0)
),
runs AS (
  SELECT doc_id, i, size, array_to_string(ws[i : i + size - 1], ' ') AS body
  FROM (SELECT doc_id, ws, size, unnest(generate_series(1, len(ws) - size + 1)) AS i FROM d, (SELECT DISTINCT size FROM win))
),
met AS (SELECT doc_id, i, size, item FROM runs JOIN win USING (size, body)),
hit AS (SELECT doc_id, count(DISTINCT w) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS w FROM met) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(own.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)"""


@query("op11_decontamination", _OP11)
def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.decontamination import find_contamination

    found = find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), width=10)
    ids = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), ids.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_OP12 = r"""WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(ws) < 200)::INT AS a,
    (100 * len(list_distinct(ws)) < 50 * len(ws))::INT AS b,
    (100 * len(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * len(body))::INT AS c,
    regexp_matches(body, '[#$%&*|]')::INT AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)::INT AS e
  FROM w LEFT JOIN l USING (doc_id)
),
masks AS (SELECT part, [a, b, c, d, e] AS f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY ALL),
letter AS (SELECT unnest([1, 2, 3, 4, 5]) AS x),
orders AS (
  SELECT [p.x, q.x, r.x, s.x, t.x] AS o FROM letter p, letter q, letter r, letter s, letter t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
),
steps AS (SELECT o, step, o[step] AS x, o[1 : step - 1] AS before FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
told AS (
  SELECT part, o, step, x,
    sum(n) FILTER (len(list_filter(before, lambda y: f[y] = 1)) = 0 AND f[x] = 0) AS kept,
    sum(n) FILTER (len(list_filter(before, lambda y: f[y] = 1)) = 0 AND f[x] = 1) AS removed,
    sum(n) FILTER (len(list_filter(before, lambda y: f[y] = 1)) > 0 AND f[x] = 1) AS redundant,
    sum(n) FILTER (list_sum(f) = 1 AND f[x] = 1) AS unique_fails,
    sum(good) FILTER (len(list_filter(before, lambda y: f[y] = 1)) = 0 AND f[x] = 1) AS good_lost,
    sum(toxic) FILTER (len(list_filter(before, lambda y: f[y] = 1)) = 0 AND f[x] = 1) AS toxic_lost
  FROM masks, steps GROUP BY ALL
)
SELECT part, array_to_string([substr('ABCDE', y, 1) FOR y IN o], '') AS filter_order, step,
  coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, x), 0)::BIGINT AS shapley
FROM told"""


@query("op12_filter_audit", _OP12)
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.audit import audit_filters

    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


_OP13 = r"""WITH w AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || doc_id::VARCHAR) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2,
    CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM w
),
cut AS (
  SELECT *, array_to_string(u[1 : least(c1, c2)], '') AS prefix, array_to_string(u[least(c1, c2) + 1 : greatest(c1, c2)], '') AS middle,
    array_to_string(u[greatest(c1, c2) + 1 :], '') AS suffix
  FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(body) AS restored_sha256
FROM cut"""


@query("op13_fill_in_middle", _OP13)
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    from shelfmark.llm.middles import fill_in_middle, restored

    out = fill_in_middle(table(spark, folder, "documents").select("doc_id", "text"))
    digests = {"output_sha256": F.col("text"), "restored_sha256": restored(F.col("text"), F.col("form"))}
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *(F.sha2(x.cast("binary"), 256).alias(name) for name, x in digests.items()))
