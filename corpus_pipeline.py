"""A corpus pipeline over ``documents``: quality rules, near-duplicates, decontamination, secrets, tokens.

Each stage takes all rows that the one before kept, calls one operator of
``sparktrail.llm``, and is written as Parquet and read again as the next one's
input.  All but the last return the columns of documents; the last adds none of
its input's texts but gives each document's token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparktrail.llm.common import stored, table
from sparktrail.llm.decontaminate import without_leaks
from sparktrail.llm.quality import keep_good
from sparktrail.llm.secret_scan import without_secrets
from sparktrail.llm.sentencepiece_codec import sp_encode
from sparktrail.llm.simhash import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced (and n_chars of the new texts)."""
    return without_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, with their number and the check that they decode to the text."""
    return sp_encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: Components of a graph and merge encodings have no SQL form here; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents to token ids."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
