"""Table reading, batch slicing and written intermediate tables shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import configure, cut_lineage

# Rows handed to a Python worker at once. Texts are long, so a batch is kept small; operators slice it further by bytes.
BATCH_ROWS = 128
# Bytes of text that a vectorised step works on at once. One longer text is still taken whole.
CHUNK_BYTES = 512 << 10


def prepare(spark: SparkSession) -> SparkSession:
    """The settings that the operators of this subpackage rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder, as it is."""
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and survives lost executors (an action)."""
    return cut_lineage(df)


def removed(rows: DataFrame) -> None:
    """Deletes a table that ``written`` made and that nothing reads any more."""
    spark = rows.sparkSession
    for name in {x.rsplit("/", 1)[0] for x in rows.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def texts_of(column: pa.Array) -> pa.Array:
    """A text column without nulls (null becomes the empty text), as one array of 32-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.string()) if column.type != pa.string() else column
    return pc.fill_null(column, "")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text array without nulls; offsets start at 0."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", most_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(rows, their texts) in pieces of at most ``most_bytes`` of text, or one row."""
    texts = texts_of(batch.column(column))
    _, offsets = raw(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1)
        yield batch.slice(at, end - at), texts.slice(at, end - at)
        at = end


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_keys(rows: DataFrame, id: str, key: str) -> DataFrame:
    """The rows with a new column ``key`` that is an integer, unique and never null.

    It is the id where ids are so already. Otherwise rows are numbered, and written once, so that every later scan finds the
    same numbers.
    """
    ids = rows.select(rows[id].cast("long").alias("id"))
    odd = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR id IS NULL")
    if odd.isEmpty():
        return rows.withColumn(key, rows[id].cast("long"))
    return written(rows.withColumn(key, F.monotonically_increasing_id()))
