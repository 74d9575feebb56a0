"""Scored series and contacts to an outreach sheet: hours, filter, bands, retention, list entry, letter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.contacts import has_contact_signal
from shelfmark.functions.keys import spaced_key
from shelfmark.functions.ladders import hours, hours_discrepancy, outreach_status, rating_category, retention
from shelfmark.functions.text import fill_template, headline_fee, salutation
from shelfmark.operators.filters import reject_unless, split
from shelfmark.operators.joins import best_entry_by_surname, commercial_band, keyed_left_join
from shelfmark.operators.scoring import with_fields


def outreach_master(series: DataFrame, contacts: DataFrame, listed: DataFrame, template: str, least_hours: float = 40.0) -> tuple[DataFrame, DataFrame]:
    """(outreach rows, rows removed with their reason).

    ``series``: row_id, series_name, author, total_pages, stated_hours, first_count, last_count. ``contacts``:
    contact_order, author, email, agent_email. The letter template names {salutation}, {series}, {fee} and
    {share}.
    """
    joined = keyed_left_join(
        series, contacts, [spaced_key("author")], [spaced_key("author")], ["email", "agent_email"], [F.col("contact_order")]
    )
    timed = with_fields(joined.withColumn("calc_hours", hours("total_pages", "outreach")), hours_discrepancy("calc_hours", "stated_hours"))
    kept, removed = split(timed, reject_unless(F.col("hours") >= least_hours, "below length"))
    banded = with_fields(kept, commercial_band("first_count", "hours"))
    kept_readers = with_fields(banded, retention("last_count", "first_count"), "retention_")
    listed_rows = best_entry_by_surname(kept_readers, listed, "author")
    contact = has_contact_signal("email", "agent_email")
    letter = fill_template(
        template,
        {
            "salutation": salutation("author"),
            "series": F.col("series_name"),
            "fee": headline_fee("fee"),
            "share": F.concat(F.col("share_low").cast("string"), F.lit("%")),
        },
    )
    out = listed_rows.withColumns(
        {
            "rating_category": rating_category("first_count"),
            "status": outreach_status("hours", "first_count", contact),
            "letter": F.when(contact, letter),
        }
    )
    return out, removed
