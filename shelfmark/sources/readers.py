"""Input tables: CSV files in several states of repair, sheets, JSON caches."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.keys import lower_trim, spaced_key
from shelfmark.functions.nulls import is_missing
from shelfmark.operators.groups import top_per_key
from shelfmark.operators.schema import union_by_name


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, multiline: bool = False) -> DataFrame:
    """CSV with a header; bad lines are skipped. Without a schema every column is text.

    Quoted line breaks need ``multiline``, which reads each file in one task; ``repaired_lines`` first is the
    way for large files.
    """
    reader = spark.read.option("header", True).option("mode", "DROPMALFORMED").option("quote", '"').option("escape", '"')
    reader = reader.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table, split as its files and row groups are."""
    return spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """True when the path exists, on any file system Spark can reach."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """First path of a preference list that exists."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {list(paths)} exists")


def read_first_existing(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    """CSV at the first path of a preference list that exists."""
    return read_csv(spark, first_existing(spark, paths), **options)


# Words of a category header row (S3)
CATEGORY_HEADER = ["Series, Long", "Ratings & Appeal", "Publishers", "Objective List", "Final Rank", "Licensing Info"]


def read_multiheader_csv(spark: SparkSession, path: str, name_column: str = "Book Series Name") -> DataFrame:
    """CSV whose first row may be a category header above the column names.

    Only the first two rows are looked at on the driver; the columns are as many as the longer of them has, so a
    category row may be shorter than the header. Rows without any value or without a name are dropped.
    """
    reader = spark.read.option("header", False).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
    lines = [r["value"] for r in spark.read.text(path).limit(2).collect()]
    width = max((len(next(csv.reader([line]))) for line in lines if line), default=1)
    raw = reader.schema(T.StructType([T.StructField(f"_c{k}", T.StringType()) for k in range(width)])).csv(path)
    head = [list(r) for r in raw.take(2)]
    text = " ".join(str(v) for v in head[0])
    skip = 2 if any(word in text for word in CATEGORY_HEADER) else 1
    header = head[skip - 1]
    names = [" ".join(str(n).split()) if n is not None else f"Unnamed {i}" for i, n in enumerate(header)]
    own = F.struct(*[F.col(c) for c in raw.columns])
    above = [F.struct(*[F.lit(v).cast("string").alias(c) for v, c in zip(row, raw.columns)]) for row in head[:skip]]
    body = raw
    for row in above:
        body = body.filter(~own.eqNullSafe(row))
    df = body.toDF(*names).dropna("all")
    return df.filter(~is_missing(F.col(f"`{name_column}`"))) if name_column in names else df


def repaired_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, line): physical lines joined by a space until their double quotes are balanced.

    A line starts a record when the number of quotes before it in its file is even. Quotes are counted inside
    each input split, the split totals are summed up per file, so the splits of a large file are read in
    parallel. An unclosed record at the end of a file is kept.
    """
    lines = spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    inside = Window.partitionBy("file", "block").orderBy("pos")
    counted = lines.withColumn("q", quotes)
    counted = counted.withColumn("before", F.sum("q").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    blocks = counted.groupBy("file", "block").agg(F.sum("q").alias("total"))
    by_block = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("total").over(by_block), F.lit(0)).alias("carried"))
    marked = counted.join(blocks, ["file", "block"]).withColumn(
        "starts", F.pmod(F.coalesce("before", F.lit(0)) + F.col("carried"), F.lit(2)) == 0
    )
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("start", F.max(F.when(F.col("starts"), F.col("pos"))).over(so_far))
    last = marked.groupBy("file", "block").agg(F.max("start").alias("last"))
    last = last.select("file", "block", F.max("last").over(by_block).alias("open_start"))
    owned = marked.join(last, ["file", "block"]).withColumn("start", F.coalesce("start", "open_start"))
    single = owned.groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("l"))
    return single.select("file", "start", F.trim(F.array_join(F.transform("l", lambda x: x["value"]), " ")).alias("line"))


def read_sheets(spark: SparkSession, sheets: dict[str, str], header_names: Sequence[str] | None = None) -> DataFrame:
    """One table per sheet (a CSV each), united by column name, with the sheet name in ``sheet``."""
    frames = []
    for name, path in sheets.items():
        frame = read_csv(spark, path)
        if header_names:
            frame = frame.toDF(*header_names)
        frames.append(frame.withColumn("sheet", F.lit(name)))
    return union_by_name(*frames)


CONTACT = "struct<author: string, email: string, email_source: string, email_type: string, agent_name: string, agent_email: string, agent_source: string, website: string, method: string, priority: string, series: string>"


def contact_rows(caches: DataFrame, json: str, order: str) -> DataFrame:
    """(author_key, contact fields) of JSON caches keyed by author; the cache with the highest order wins."""
    entries = caches.select(F.col(order).alias("__o"), F.explode(F.from_json(json, f"map<string, {CONTACT}>")).alias("k", "v"))
    entries = entries.filter("v IS NOT NULL").withColumn("author_key", lower_trim("k"))
    return top_per_key(entries, ["author_key"], [F.col("__o").desc()]).select("author_key", "v.*")


def load_contact_caches(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Contacts of several JSON cache files, later files override earlier ones."""
    frames = [spark.read.text(p, wholetext=True).withColumn("cache_order", F.lit(i)) for i, p in enumerate(paths)]
    return contact_rows(union_by_name(*frames), "value", "cache_order")


def existing_keys(tables: Sequence[tuple[DataFrame, Column | str, Column | str]]) -> DataFrame:
    """Distinct ``key`` of "series|||author" and of "series" alone over several tables."""
    parts = []
    for frame, series, author in tables:
        s, a = spaced_key(series), spaced_key(author)
        keys = F.explode(F.array(F.concat(s, F.lit("|||"), a), s))
        parts.append(frame.filter(s != "").select(keys.alias("key")))
    return union_by_name(*parts).distinct()
