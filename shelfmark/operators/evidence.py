"""Contact candidates of authors, and claims checked against stored pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.contacts import clean_email, valid_email
from shelfmark.functions.keys import series_word_key
from shelfmark.functions.nulls import is_missing
from shelfmark.functions.text import plausible_agent
from shelfmark.functions.urls import ensure_scheme, is_own_site
from shelfmark.operators.schema import union_by_name


def author_candidates(tables: Sequence[DataFrame]) -> DataFrame:
    """Distinct (author_key, kind, value) of several tables with author, email, site and agent columns.

    Addresses must be valid, sites must not be social or shop pages, agents must read like names. The values
    stay rows, so an author with many of them needs no large cell.
    """
    site = ensure_scheme("site")
    entries = F.array_compact(
        F.array(
            F.when(valid_email("email"), F.struct(F.lit("email").alias("kind"), clean_email("email").alias("value"))),
            F.when(is_own_site(site), F.struct(F.lit("site").alias("kind"), site.alias("value"))),
            F.when(plausible_agent("agent"), F.struct(F.lit("agent").alias("kind"), F.trim("agent").alias("value"))),
        )
    )
    rows = union_by_name(*[t.select("author", "email", "site", "agent") for t in tables]).filter(~is_missing("author"))
    return rows.select(series_word_key("author").alias("author_key"), F.explode(entries).alias("e")).select("author_key", "e.*").distinct()


def evidence_status(claims: DataFrame, pages: DataFrame, claim_id: str, names: Sequence[str], url: str = "url") -> DataFrame:
    """(claim_id, status, matched, fetched) of claims with links to stored pages.

    ``claims``: claim_id, the name columns and one row per link. PASS when a linked page holds one of the
    names, PARTIAL when pages are stored but none does, FAIL without a stored page. Every stored version of a page
    is read; ``matched`` and ``fetched`` count links, not versions.
    """
    links = claims.select(claim_id, url, *names).distinct()
    versions = pages.select(F.col(url).alias("__u"), F.lower(F.coalesce("html", F.lit(""))).alias("__html"))
    joined = links.join(versions, F.col(url) == F.col("__u"), "left")
    hit = F.lit(False)
    for name in names:
        key = F.lower(F.trim(F.coalesce(F.col(name), F.lit(""))))
        hit = hit | ((key != "") & F.col("__html").contains(key))
    by_link = joined.groupBy(claim_id, url, *names).agg(F.max(F.coalesce(hit, F.lit(False))).alias("__hit"), F.max(F.col("__u").isNotNull()).alias("__stored"))
    per = by_link.groupBy(claim_id).agg(F.count_if("__hit").alias("matched"), F.count_if("__stored").alias("fetched"))
    status = F.when(F.col("matched") > 0, F.lit("PASS")).when(F.col("fetched") > 0, F.lit("PARTIAL")).otherwise(F.lit("FAIL"))
    return per.withColumn("status", status)
