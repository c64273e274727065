"""Corpus pipeline: quality classifier, exact dedup, SimHash near-dedup, mixing to target weights, packing.

Each stage reads the whole table that the one before wrote and its decisions take effect in its rows.
``ORACLE_SQL`` is None: SQL can express neither the trees nor the fingerprints; tests compare with a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stayput.llm import exact_dedup, mixing, packing, quality, simhash
from stayput.llm.common import read
from stayput.session import shared_dir

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, scores 0.5 or more.

    Whole texts are scored; a null or empty text by its zero statistics. Equal texts and repeated rows are kept or dropped together.
    Without labels the score is 0.5 and all stay. An empty table stays empty; other columns pass unchanged.
    """
    return quality.accepted(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts equal without white space: the longest, then the smallest id (null ids last), then the first row.

    Null and empty texts are one group. An empty table stays empty; other columns pass unchanged.
    """
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of documents whose fingerprints of 4-word shingles are within 4 bits: that of the smallest id, then the first.

    Texts without words have fingerprint zero and are linked like others; long texts count whole. An empty table stays empty.
    """
    return simhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it; those that it does not take go.

    A null source is a source like any other, last in the order of weights. A text without words has size 0. An empty table stays empty.
    """
    return mixing.repeated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, in sequences of 2048 ids, repeated rows each.

    Null and empty texts are one end id; a long text is cut where sequences end. An empty table has no pieces.
    """
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet in the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    base = f"{shared_dir(spark, 'pipeline')}/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
