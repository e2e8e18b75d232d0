"""Corpus pipeline: language ID, exact dedup, n-gram Jaccard join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimill.llm import dedup, jaccard, langid, mixing, packing
from sentimill.session import materialize


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the identifier accepts (operator 2), with all their columns.

    Null and empty texts and those without a letter go; texts are scored whole; repeated rows
    stay or go together; ids may be null or repeat. An empty table stays empty.
    """
    return langid.keep_accepted(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id (operator 9), with all its columns.

    A null text counts as empty; a null id as larger than any other; of repeated rows one
    stays. Texts are compared whole. An empty table stays empty.
    """
    return dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 5), with all its columns.

    Texts without words and rows without an id stay; rows that share an id stay or go
    together; texts are compared whole. An empty table stays empty.
    """
    return jaccard.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards the target weights of their sources, shuffled (operator 7).

    All columns are kept, whatever their names; texts are not looked at. A null source is a
    source of its own; rows with a null or repeated id draw apart. An empty table stays empty.
    """
    names = {f"c{i}": c for i, c in enumerate(docs.columns)}  # no name meets one of the mixer's
    of = {c: n for n, c in names.items()}
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()])
    mixed = mixing.mix(plain, id_col=of["doc_id"], source_col=of["source"])
    return mixed.select(*[F.col(n).alias(c) for n, c in names.items()])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's length bucket, batch and place in the batch (operator 6).

    A null or empty text has no tokens and is packed like any other; long texts count whole;
    repeated rows are packed one by one. An empty table gives an empty one.
    """
    return packing.pack(docs).select("doc_id", "n_tokens", "bucket", "bucket_length", "batch", "slot")


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: a trained language model cannot be written in SQL; tests/llm hold a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, applied to all documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
