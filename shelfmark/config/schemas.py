"""Table schemas (fixed column lists)."""

from __future__ import annotations

from pyspark.sql import types as T


_SIMPLE = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType()}


def _of(pairs: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _SIMPLE[k]) for n, k in pairs])


# Book table -------------------------------------------------------------------------
BOOK_SCHEMA = _of(
    [
        ("Series Name", "string"), ("Author Name", "string"), ("Book Name", "string"), ("Book Number", "double"),
        ("Total Books in Series", "int"), ("Goodreads Link", "string"), ("Goodreads # of Ratings", "long"),
        ("Goodreads Rating", "double"), ("First Published", "string"), ("Original Published", "string"), ("Pages", "int"),
        ("Description", "string"), ("Primary Trope", "string"), ("Primary Subgenre", "string"), ("Series Status", "string"),
        ("Amazon Link", "string"), ("Amazon # of Ratings", "long"), ("Amazon Rating", "double"), ("Publisher", "string"),
        ("Self Pub flag", "string"), ("Short Synopsis", "string"), ("Publication Date", "string"), ("Top Lists", "string"),
        ("Featured List", "string"),
    ]
)


def _member(label: str) -> list[tuple[str, str]]:
    return [(f"{label} Name", "string"), (f"{label} Rating", "double"), (f"{label} Rating Count", "long")]


# Series table -----------------------------------------------------------------------
SERIES_SCHEMA = _of(
    [
        ("Book Series Name", "string"), ("Author Name", "string"), ("Primary Subgenre", "string"), ("Type", "string"),
        ("Books in Series", "int"), ("Total Pages", "int"), ("Length of Adaption in Hours", "double"),
        *_member("First Book"), *_member("Last Book"), *_member("Highest Rated Book"), *_member("Lowest Rated Book"),
        ("Publisher Name", "string"), ("Self Pub Flag", "string"), ("Commissioning_Score", "double"),
        ("Commissioning_Rank", "string"),
    ]
    + [
        (n, "string")
        for n in (
            "Subjective Analysis", "Differentiator", "Series_Era", "Rationale", "Goodreads Series URL", "Email", "Website",
            "Twitter", "Instagram", "Facebook", "BookBub", "TikTok", "Literary Agent", "Contact Source", "Discovery Status",
            "Primary Trope", "Objective_Validation_Source", "Amazon_Bestseller_Tag",
        )
    ]
    + [("Amazon_Best_Rank", "int"), ("Books_Featured_Rank_Validation", "string"), ("First_Book_Pub_Year", "int")]
    + [
        (n, "string")
        for n in (
            "Adaptation_Length_Flag", "First_Book_Rating_Flag", "Appeal Flag", "Lowest_Book_Rating_Flag", "Rating_Stability_Flag",
        )
    ]
)
# Legacy headers of series files and columns no report uses ---------------------------
LEGACY_HEADERS = {
    "Author Email": "Email",
    "Author Website": "Website",
    "T100_Mapping": "Amazon_Bestseller_Tag",
    "Num_Books_Featured": "Amazon_Best_Rank",
}
DROPPED_HEADERS = [
    "Books_In_Series_List", "Universe Type", "Universe Reasoning", "Verfied Flag", "Outreach Sent Date",
    "Duplicate Rightsholders", "Outreach Channel", "Contact Info", "Response Status", "Response Date", "Licensing Status",
    "Draft Email", "Source Platform", "Series_Verified", "Verification_Method", "Verified_Series_Name",
    "Verified_Books_Count", "Amazon Series URL",
]
