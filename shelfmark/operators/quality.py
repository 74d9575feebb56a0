"""Data checks. Column checks of one table run in a single scan and come as a long report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.config import models
from shelfmark.functions.nulls import col, is_missing, to_number
from shelfmark.operators.dedupe import duplicate_summary
from shelfmark.operators.groups import Keys
from shelfmark.operators.schema import schema_diff

REPORT = "severity string, field string, check string, n long, sample array<string>"


def missing_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(field, present, missing, missing_percent) of every column, in one scan."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    absent = [is_missing(F.col(f"`{c}`")) if types[c] == "string" else F.col(f"`{c}`").isNull() for c in columns]
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(a, F.lit(1))).alias(f"m{i}") for i, a in enumerate(absent)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(columns)]))
    return counts.select("n", rows.alias("r")).select(
        "r.field",
        (F.col("n") - F.col("r.missing")).alias("present"),
        F.col("r.missing").alias("missing"),
        F.round(F.col("r.missing") * 100.0 / F.nullif("n", F.lit(0)), 2).alias("missing_percent"),
    )


class Check:
    """One counted condition on the rows of a table."""

    def __init__(self, severity: str, field: str, name: str, bad: Column, value: Column, least_share: float = 0.0):
        self.severity, self.field, self.name = severity, field, name
        self.bad, self.value, self.least_share = F.coalesce(bad, F.lit(False)), value, least_share


def required(field: str) -> Check:
    return Check("ERROR", field, "required", is_missing(F.col(field).cast("string")), F.lit(None).cast("string"))


def recommended(field: str) -> Check:
    return Check("WARNING", field, "more than half empty", F.col(field).isNull(), F.lit(None).cast("string"), 0.5)


def numeric(field: str) -> Check:
    value = F.col(field).cast("string")
    return Check("ERROR", field, "not a number", value.isNotNull() & to_number(value).isNull(), value)


def not_negative(field: str) -> Check:
    return Check("ERROR", field, "negative", to_number(F.col(field)) < 0, F.col(field).cast("string"))


def in_range(field: str, low: float, high: float) -> Check:
    value = to_number(F.col(field))
    return Check("ERROR", field, f"outside {low:g} to {high:g}", (value < low) | (value > high), value)


def matches(field: str, pattern: str) -> Check:
    """Filled values must start with the pattern."""
    value = F.col(field)
    return Check("WARNING", field, "unexpected form", ~is_missing(value) & ~value.rlike("^(?:" + pattern + ")"), value)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(severity, field, check, n, sample) of all checks that found rows; one scan, one aggregation.

    The sample holds the least and largest offending value.
    """
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(checks):
        offending = F.when(c.bad, c.value)
        aggregates += [
            F.count(F.when(c.bad, F.lit(1))).alias(f"c{i}"), F.min(offending).cast("string").alias(f"l{i}"), F.max(offending).cast("string").alias(f"h{i}")
        ]
    counts = df.agg(*aggregates)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c.severity).alias("severity"), F.lit(c.field).alias("field"), F.lit(c.name).alias("check"),
                    F.col(f"c{i}").alias("n"), F.array_distinct(F.array_compact(F.array(f"l{i}", f"h{i}"))).alias("sample"),
                    (F.col(f"c{i}") > F.col("n") * c.least_share).alias("hit"),
                )
                for i, c in enumerate(checks)
            ]
        )
    )
    return counts.select(rows.alias("r")).select("r.*").filter("hit").drop("hit")


def schema_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Report rows for missing and unknown columns."""
    diff = schema_diff(df, schema)
    rows = [("WARNING", name, "missing column", 1, []) for name in diff["missing"]]
    rows += [("INFO", name, "unknown column", 1, []) for name in diff["extra"]]
    return df.sparkSession.createDataFrame(rows, REPORT)


def duplicate_report(df: DataFrame, keys: Keys, field: str) -> DataFrame:
    """Report row for rows that share a key."""
    found = duplicate_summary(df, keys).filter("duplicate_rows > 0")
    return found.select(
        F.lit("WARNING").alias("severity"), F.lit(field).alias("field"), F.lit("duplicates").alias("check"),
        F.col("duplicate_rows").alias("n"), F.array().cast("array<string>").alias("sample"),
    )


def missing_required(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Report row for each required column that the table lacks."""
    rows = [("CRITICAL", name, "required column missing", 1, []) for name in fields if name not in df.columns]
    return df.sparkSession.createDataFrame(rows, REPORT)


def run_all(
    df: DataFrame, schema: T.StructType, checks: Sequence[Check], keys: Keys, key_field: str, required_fields: Sequence[str] = ()
) -> DataFrame:
    """The whole report: schema, required columns, column checks, duplicates.

    ``required_fields`` are checked for empty cells where the column is there; a missing one is critical. Other checks of
    missing columns are left out, the schema rows name the column.
    """
    every = [*checks, *(required(name) for name in required_fields)]
    known = [c for c in every if c.field in df.columns]
    report = schema_report(df, schema).unionByName(missing_required(df, required_fields))
    return report.unionByName(run_checks(df, known)).unionByName(duplicate_report(df, keys, key_field))


def is_valid(report: DataFrame) -> DataFrame:
    """One row: whether the report is free of errors."""
    return report.agg((F.count(F.when(F.col("severity").isin("ERROR", "CRITICAL"), F.lit(1))) == 0).alias("valid"))


def repaired_rating(rating, count, other_rating) -> Column:
    """A perfect rating with more than 20 votes is replaced by the other source's rating, else by 4.5."""
    suspicious = (col(rating) == 5.0) & (col(count) > 20)
    other = F.when(col(other_rating) > 0, col(other_rating))
    return F.when(suspicious, F.coalesce(other, F.lit(4.5))).otherwise(col(rating))


def count_anomalies(df: DataFrame, first: str, second: str) -> DataFrame:
    """One row per anomaly of rows with both counts: first over 1.5 x second; a round first count."""
    a, b = F.col(first), F.col(second)
    reasons = F.array_compact(
        F.array(
            F.when(a > b * 1.5, F.lit("first >> second")),
            F.when((a > 1000) & (F.pmod(a, F.lit(500)) == 0), F.lit("round number estimate")),
        )
    )
    return df.filter((a > 0) & (b > 0)).withColumn("reason", F.explode(reasons))


def repair_contradictions(df: DataFrame, series: str, verified_series: str, first_book: str, last_book: str, kind: str, books: str, kind_for: Column) -> DataFrame:
    """Column repairs, all from the old values: a last book equal to the first one of several is blanked, a
    standalone of several books gets its class, a series named like its first book takes the verified name."""
    several = F.col(books) > 1
    same = (F.lower(F.trim(first_book)) == F.lower(F.trim(last_book))) & (F.trim(first_book) != "")
    named = F.lower(F.trim(series)) == F.lower(F.trim(first_book))
    better = named & ~is_missing(verified_series) & (F.lower(F.trim(verified_series)) != F.lower(F.trim(series)))
    return df.withColumns(
        {
            last_book: F.when(F.coalesce(same & several, F.lit(False)), None).otherwise(F.col(last_book)),
            kind: F.when(F.coalesce(F.lower(kind).contains("standalone") & several, F.lit(False)), kind_for).otherwise(F.col(kind)),
            series: F.when(F.coalesce(better, F.lit(False)), F.col(verified_series)).otherwise(F.col(series)),
        }
    )


def gap_triggers(df: DataFrame, columns: dict[str, str], triggers: dict = models.GAP_TRIGGERS, convergence: float = models.CONVERGENCE) -> DataFrame:
    """(phase, gap, missing_share, threshold, run, converged): which repair phase the gaps call for.

    ``columns``: column of each gap; several gaps may look at one column.
    """
    audit = missing_audit(df, list(dict.fromkeys(columns.values())))
    rules = [(phase, name, columns[name], limit) for phase, fields in triggers.items() for name, limit in fields.items() if name in columns]
    table = df.sparkSession.createDataFrame(rules, "phase string, gap string, field string, threshold double")
    share = F.round(F.col("missing") / F.nullif(F.col("missing") + F.col("present"), F.lit(0)), 6)
    return table.join(audit, "field").select(
        "phase", "gap", share.alias("missing_share"), "threshold", (share > F.col("threshold")).alias("run"), (share < convergence).alias("converged")
    )
