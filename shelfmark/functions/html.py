"""Texts and links of stored pages (HTML text columns); the fields of catalogue and shop pages are in ``pages``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.nulls import col, collapse_space


def tag_text(c: Column | str, tag: str) -> Column:
    """Text of the first element with this tag name, inner tags dropped; NULL without one."""
    inner = F.regexp_extract(col(c), f"(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>", 1)
    return F.nullif(plain_text(inner), F.lit(""))


def plain_text(c: Column | str) -> Column:
    """HTML without comments, scripts, styles and tags; the five basic entities decoded."""
    text = F.regexp_replace(col(c), "(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>", " ")
    text = F.regexp_replace(text, "<[^>]+>", " ")
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return collapse_space(text)


def links(c: Column | str) -> Column:
    """ARRAY of all link targets, in order."""
    return F.regexp_extract_all(col(c), F.lit("(?i)<a\\s[^>]*?href=\"([^\"]*)\""), 1)
