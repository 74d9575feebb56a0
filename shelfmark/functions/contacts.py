"""E-mail addresses, social links and contact classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.config import vocab
from shelfmark.functions.keys import series_word_key
from shelfmark.functions.nulls import col, is_missing, let, present, present_once
from shelfmark.functions.text import any_pattern, any_term
from shelfmark.functions.urls import host


def clean_email(c: Column | str) -> Column:
    """Address without ``mailto:``, query and trailing punctuation."""
    text = F.regexp_replace(F.trim(col(c)), "^[.;,)]+|[.;,)]+$", "")
    return F.trim(F.substring_index(F.regexp_replace(text, "(?i)^mailto:", ""), "?", 1))


def local_part(c: Column | str) -> Column:
    return F.lower(F.substring_index(col(c), "@", 1))


def domain(c: Column | str) -> Column:
    return F.lower(F.substring_index(col(c), "@", -1))


def valid_email(c: Column | str, bad_domains: list[str] = vocab.BAD_EMAIL_DOMAINS) -> Column:
    """Well-formed address that is no placeholder, image name, system or service address."""
    text = F.lower(clean_email(c))
    at = F.substring_index(text, "@", -1)
    ends = reduce(lambda a, b: a | b, [text.endswith(e) for e in vocab.BAD_EMAIL_EXTENSIONS])
    good = (
        text.rlike("^" + vocab.EMAIL_PATTERN + "$")
        & ~text.isin(*vocab.BAD_EMAILS)
        & ~at.isin(*bad_domains)
        & ~ends
        & F.length(text).between(6, 100)
        & ~any_term(at, vocab.BAD_EMAIL_DOMAIN_PARTS)
        & ~any_term(text, vocab.SYSTEM_EMAIL_WORDS)
    )
    return F.coalesce(good, F.lit(False))


def emails_in(c: Column | str) -> Column:
    """ARRAY of the distinct valid addresses in a text, in order of first appearance."""
    marked = F.when(col(c).contains("@"), col(c)).otherwise(F.lit(""))
    found = F.regexp_extract_all(marked, F.lit(vocab.EMAIL_PATTERN), 0)
    return F.array_distinct(F.filter(found, lambda e: valid_email(e)))


def looks_fabricated(c: Column | str) -> Column:
    """Address of a form that generated answers often invent."""
    return F.coalesce(any_pattern(F.lower(F.trim(col(c))), vocab.FABRICATED_EMAIL_PATTERNS), F.lit(False))


def is_publicity(c: Column | str) -> Column:
    """Address of a press office."""
    return F.coalesce(col(c).contains("@") & local_part(c).isin(*vocab.PUBLICITY_LOCAL_PARTS), F.lit(False))


def _name_parts(author: Column | str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(col(author), F.lit(""))), "\\s+"), lambda p: F.length(p) > 2)


def is_personal(email: Column | str, author: Column | str) -> Column:
    """Local part holds a part of the author's name, or does not start like a general mailbox."""
    local = F.translate(local_part(email), "._-", "")
    named = F.exists(_name_parts(author), lambda p: local.contains(p))
    general = reduce(lambda a, b: a | b, [local.startswith(p) for p in vocab.GENERIC_LOCAL_PARTS])
    return named | ~general


def pick_email(emails: Column | str, author: Column | str) -> Column:
    """First valid address with a part of the author's name in it, else the first valid one."""
    valid = F.filter(col(emails), lambda e: valid_email(e))
    parts = _name_parts(author)
    named = F.filter(valid, lambda e: F.exists(parts, lambda p: F.translate(local_part(e), "._", "").contains(p)))
    return F.coalesce(F.try_element_at(named, F.lit(1)), F.try_element_at(valid, F.lit(1)))


def score_email(email: Column, site: Column, known: Column, linked: Column) -> Column:
    """Points of an address: known 6, linked 5, same host as the site 4, contact word 2, info@ 1."""
    lower = F.lower(clean_email(email))

    def points(condition: Column, value: int) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), value).otherwise(0)

    return (
        points(F.array_contains(known, lower), 6)
        + points(F.array_contains(linked, lower), 5)
        + points(domain(lower).endswith(site) & (F.length(site) > 0), 4)
        + points(any_term(lower, vocab.CONTACT_WORDS), 2)
        + points(lower.startswith("info@"), 1)
    )


def best_scored_email(emails: Column | str, site: Column, known: Column, linked: Column) -> Column:
    """Valid address with the most points, first in the alphabet on a tie."""
    scored = F.transform(
        F.filter(col(emails), lambda e: valid_email(e)),
        lambda e: F.struct((-score_email(e, site, known, linked)).alias("neg"), clean_email(e).alias("email")),
    )
    return F.array_min(scored)["email"]


def email_quality(c: Column | str) -> Column:
    """MISSING / FABRICATION_PATTERN / PUBLICITY_NOT_DIRECT / KNOWN_BAD / NEEDS_VERIFICATION."""
    bad = F.lower(F.trim(col(c))).isin(*vocab.BAD_EMAILS) | domain(c).isin(*vocab.BAD_EMAIL_DOMAINS)
    return (
        F.when(is_missing(c), F.lit("MISSING"))
        .when(looks_fabricated(c), F.lit("FABRICATION_PATTERN"))
        .when(is_publicity(c), F.lit("PUBLICITY_NOT_DIRECT"))
        .when(bad, F.lit("KNOWN_BAD"))
        .otherwise(F.lit("NEEDS_VERIFICATION"))
    )


def _author_in_local(email: Column | str, author: Column | str) -> Column:
    compact = F.regexp_replace(local_part(email), "[^a-z0-9]+", "")
    tokens = F.filter(F.split(series_word_key(author), " "), lambda t: F.length(t) > 2)
    return F.exists(tokens, lambda t: compact.contains(t))


def classify_contact(email, author, website, context) -> Column:
    """direct / agent / other by host, mailbox name and the words around the address; NULL when undecided."""
    text = F.lower(F.coalesce(col(context), F.lit("")))
    site = F.coalesce(host(website), F.lit(""))
    on_site = (F.length(site) > 0) & domain(email).endswith(site)
    strong = any_term(text, vocab.PUBLICITY_CONTEXT)
    general = local_part(email).isin(*vocab.GENERIC_LOCAL_PARTS)
    return (
        F.when(~F.coalesce(col(email).contains("@"), F.lit(False)), None)
        .when(on_site & strong, F.lit("agent"))
        .when(on_site & general, F.lit("other"))
        .when(on_site, F.lit("direct"))
        .when(_author_in_local(email, author) & strong, F.lit("agent"))
        .when(_author_in_local(email, author), F.lit("direct"))
        .when(strong | any_term(text, vocab.AGENT_CONTEXT), F.lit("agent"))
        .when(general | any_term(text, vocab.OTHER_CONTEXT), F.lit("other"))
        .when((F.length(site) > 0) & (F.length(text) > 0), F.lit("other"))
    )


def demoted_contacts(direct, agent_email, other_email, author, website, agent_name) -> Column:
    """STRUCT(direct, agent, other): addresses moved to the column they belong to, all from the old values.

    A direct address needs the author's own host or name; otherwise it moves to the agent column (when it
    looks like representation or an agent is named) or to the other column, if that one is free. An agent
    address on the author's own host or at a press domain moves on to the other column.
    """
    d, a, o = present(direct), present(agent_email), present(other_email)
    site = F.coalesce(host(website), F.lit(""))
    own = (F.length(site) > 0) & domain(d).endswith(site)
    keep = F.coalesce(own | _author_in_local(d, author), F.lit(False))
    to_agent = d.isNotNull() & ~keep & (
        F.coalesce(any_term(domain(d), vocab.REPRESENTATION_DOMAIN_PARTS), F.lit(False)) | present(agent_name).isNotNull()
    )
    to_other = d.isNotNull() & ~keep & ~to_agent
    agent = F.coalesce(a, F.when(to_agent, d))
    other = F.coalesce(o, F.when(to_other, d))
    press = F.coalesce(
        ((F.length(site) > 0) & domain(agent).endswith(site)) | any_term(domain(agent), vocab.PUBLICITY_DOMAIN_PARTS),
        F.lit(False),
    )
    return F.struct(
        F.when(keep, d).alias("direct"),
        F.when(~press, agent).alias("agent"),
        F.when(press, F.coalesce(other, agent)).otherwise(other).alias("other"),
    )


def social_links(c: Column | str) -> Column:
    """STRUCT of the first link per social network in a text."""
    return F.struct(
        *[
            F.nullif(F.regexp_extract(col(c), pattern, 0), F.lit("")).alias(name)
            for name, pattern in vocab.SOCIAL_PATTERNS.items()
        ]
    )


def split_social_blob(c: Column | str) -> Column:
    """STRUCT of the first link per social network in a list joined by commas, semicolons, bars or spaces."""
    links = F.split(col(c), "[,;|\\s]+")
    hosts = {
        "twitter": "(?i)twitter\\.com|x\\.com",
        "instagram": "(?i)instagram\\.com",
        "facebook": "(?i)facebook\\.com",
        "bookbub": "(?i)bookbub\\.com",
        "tiktok": "(?i)tiktok\\.com",
    }


    def first_on(pattern: str) -> Column:
        return F.try_element_at(F.filter(links, lambda x: x.rlike(pattern)), F.lit(1))

    return F.struct(*[first_on(p).alias(n) for n, p in hosts.items()])


def has_contact_signal(*columns: Column | str) -> Column:
    """True when one of the contact columns is filled."""
    return reduce(lambda a, b: a | b, [~is_missing(c) for c in columns])


def contact_confidence(email, email_source, agent_email, agent_source) -> Column:
    """High for a sourced author address, Medium for a sourced agent address, else Not Found."""
    return (
        F.when(~is_missing(email) & ~is_missing(email_source), F.lit("High"))
        .when(~is_missing(agent_email) & ~is_missing(agent_source), F.lit("Medium"))
        .otherwise(F.lit("Not Found"))
    )


def checked_evidence(status, series_url, author_url, domains: list[str]) -> Column:
    """STRUCT(status, url): a claim is only kept while its evidence lies on one of the domains.

    ``yes_series_level`` falls to ``yes_author_level`` and that to ``no``.
    """

    def on_domain(url) -> Column:
        name = F.lower(F.regexp_extract(col(url), "^https?://([^/?#]*)", 1))
        return F.coalesce(reduce(lambda a, b: a | b, [name.endswith(d) for d in domains]), F.lit(False))

    claim = F.lower(F.coalesce(present_once(status), F.lit("no")))
    facts = F.struct(claim.alias("claim"), on_domain(series_url).alias("series"), on_domain(author_url).alias("author"))

    def outcome(e: Column) -> Column:
        claim, by_series, by_author = e["claim"], e["series"], e["author"]
        level = (
            F.when((claim == "yes_series_level") & by_series, F.lit("yes_series_level"))
            .when((claim == "yes_series_level") & by_author, F.lit("yes_author_level"))
            .when((claim == "yes_author_level") & (by_author | by_series), F.lit("yes_author_level"))
            .otherwise(F.lit("no"))
        )
        url = F.when(by_series, col(series_url)).when((level != "no") & by_author, col(author_url))
        return F.struct(level.alias("status"), F.when((level != "no") | (claim == "no"), url).alias("url"))

    return let(facts, outcome)
