"""Output tables. Nothing overwrites its own input: every save is a new version directory."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.keys import slug
from shelfmark.operators.joins import not_in_set
from shelfmark.sources.readers import exists


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV files with a header."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_partitioned(df: DataFrame, path: str, key: str, score: str, row_id: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """One directory per slug of the key, its files sorted by score, highest first.

    Rows are range-partitioned by slug and score, so a large group is spread over several sorted files.
    """
    ordered = [F.col("slug"), F.col(score).desc(), F.col(row_id)]
    out = df.withColumn("slug", slug(key)).repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    out.write.mode(mode).option("header", True).partitionBy("slug").format(fmt).save(path)


def write_sheets(frames: dict[str, DataFrame], path: str, mode: str = "errorifexists") -> None:
    """One output directory per named projection."""
    for name, frame in frames.items():
        write_csv(frame, f"{path}/{name}", mode)


def _file(spark: SparkSession, path: str):
    """(file system, path) of the cluster's storage."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def write_pointer(spark: SparkSession, path: str, version: str) -> None:
    """Names a version as saved: an empty file, which is there or not there, on object stores too."""
    system, where = _file(spark, f"{path}/_saved/{version}")
    system.create(where, False).close()


def current_version(spark: SparkSession, path: str) -> str | None:
    """Directory of the saved version that is last in the order of names, None before the first one."""
    system, folder = _file(spark, f"{path}/_saved")
    names = [x.getPath().getName() for x in system.listStatus(folder)] if system.exists(folder) else []
    return f"{path}/v={max(names)}" if names else None


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The version that was saved last."""
    found = current_version(spark, path)
    if found is None:
        raise FileNotFoundError(f"no saved version below {path}")
    return spark.read.parquet(found)


def save_version(df: DataFrame, path: str, stamp: str | None = None) -> str:
    """Parquet in a new ``v=<time>`` directory below the path; older versions stay as backups.

    The pointer that readers resolve (``read_version``) is written last: a save that ends before leaves the old version in
    force, and its directory is never read. Stamps of one's own must sort in the order of the saves.
    """
    stamp = stamp or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    target = f"{path}/v={stamp}"
    df.write.mode("errorifexists").parquet(target)
    write_pointer(df.sparkSession, path, stamp)
    return target


def append_missing(df: DataFrame, path: str, keys: Sequence[Column | str]) -> None:
    """Append the rows whose key the output does not have yet, so that a stopped run can be resumed."""
    spark = df.sparkSession
    todo = df
    if exists(spark, path):
        todo = not_in_set(df, spark.read.parquet(path), list(keys), list(keys))
    todo.write.mode("append").parquet(path)
