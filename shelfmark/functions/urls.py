"""URL parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.config.vocab import SOCIAL_HOSTS, STUDY_GUIDE_SLUGS
from shelfmark.functions.nulls import col, is_missing, trim_space
from shelfmark.functions.similarity import title_similarity
from shelfmark.functions.text import any_term


def host(c: Column | str) -> Column:
    """Host in lower case without ``www.``; NULL without one."""
    name = F.lower(F.regexp_extract(col(c), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.nullif(F.replace(name, F.lit("www."), F.lit("")), F.lit(""))


def strip_query(c: Column | str) -> Column:
    """URL up to its path."""
    return F.regexp_extract(col(c), "^([^?#]*)", 1)


def catalogue_id(c: Column | str) -> Column:
    """Number in a ``/book/show/<n>`` or ``/series/<n>`` path."""
    return F.nullif(F.regexp_extract(col(c), "/(?:book/show|series)/([0-9]+)", 1), F.lit(""))


def path_id(c: Column | str) -> Column:
    """Last number in the path."""
    return F.regexp_extract(strip_query(c), "/([0-9]+)(?:[^/0-9][^/]*)?/?$", 1).try_cast("long")


def ensure_scheme(c: Column | str) -> Column:
    """URL with a scheme; NULL when missing."""
    text = trim_space(c)
    return F.when(is_missing(text), None).when(F.lower(text).rlike("^https?://"), text).otherwise(F.concat(F.lit("https://"), text))


def is_own_site(c: Column | str) -> Column:
    """True for a host that is not a social network, shop or link page."""
    name = host(c)
    social = name.rlike("(" + "|".join(h.replace(".", "\\.") for h in SOCIAL_HOSTS) + ")$")
    return name.isNotNull() & ~social


def slug_text(c: Column | str) -> Column:
    """Last path part as words, without a leading number."""
    tail = F.element_at(F.split(strip_query(c), "/"), -1)
    return F.replace(F.regexp_replace(tail, "^[0-9]+-?", ""), F.lit("-"), F.lit(" "))


def slug_matches(url: Column | str, title: Column | str, threshold: float = 0.55) -> Column:
    """True when the words of the URL resemble the title and do not name a study guide."""
    tail = F.lower(F.element_at(F.split(strip_query(url), "/"), -1))
    guide = any_term(tail, STUDY_GUIDE_SLUGS)
    return ~guide & (title_similarity(slug_text(url), title) >= threshold)
