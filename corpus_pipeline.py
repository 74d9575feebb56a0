"""The training-data pipeline: stages over ``documents``, each calling one operator.

All but the last return the columns of ``documents``: toxic documents go, one document of each group of near duplicates
stays, passages that occur more than once are cut out, secrets are replaced by their kind; the last stage packs what is left
into token sequences. A changed text gets its new length in ``n_chars``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.jaccard import Similarity, one_of_each_group
from shelfmark.llm.packing import pack_documents
from shelfmark.llm.passages import cut_repeated
from shelfmark.llm.secrets import redact
from shelfmark.llm.tables import prepare, table, written
from shelfmark.llm.toxicity import reject_toxic


def _counted(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The changed documents with their lengths, in the columns of ``docs``."""
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else changed


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled examples don't show to be toxic."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words and a similarity of 0.8 or more."""
    prepare(spark)
    return one_of_each_group(docs, Similarity(words=5, num=8, den=10))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words that a window of 35 words covers which occurs more than once."""
    prepare(spark)
    return _counted(docs, cut_repeated(docs, 35))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets replaced."""
    prepare(spark)
    return _counted(docs, redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in token sequences."""
    prepare(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("passages", passages), ("secrets", secrets), ("packing", packing)]

# Several stages have no SQL form; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
