"""The queries of the corpus operators: each applies one, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, table
from .decontaminate import leaks
from .lexical_search import top_documents
from .license_scan import license_scan
from .lm_score import lm_scores
from .merkle import merkle_proofs
from .oracles import MERKLE_SQL, SEARCH_SQL, URLS_SQL
from .pii import pseudonyms
from .quality import quality
from .secret_scan import secret_scan
from .sentencepiece_codec import sp_encode
from .sharding import shard_by_bytes
from .simhash import near_duplicates
from .token_counts import token_counts
from .url_filter import lower_ascii, url_verdicts

#: The pseudonyms' key of the registered query; a real job takes its own from a secret store.
DEMO_KEY = "sparktrail-demo"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_documents(spark, sf_dir))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_documents(spark, sf_dir))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms(_documents(spark, sf_dir), DEMO_KEY)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_documents(spark, sf_dir))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_encode(_documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(_documents(spark, sf_dir))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_documents(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_documents(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's checksum is divisible by 3 are checked with their text's A-Z lower-cased."""
    third = F.crc32(col("doc_id").cast("string").cast("binary")) % 3 == 0
    claim = F.when(third, lower_ascii(col("text"))).otherwise(col("text"))
    return merkle_proofs(_documents(spark, sf_dir), claims={"text": claim})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_counts, op2_license_scan, op3_lm_score, op4_pii, op5_simhash, op6_quality, op7_sentencepiece,
    op8_sharding, op9_decontaminate, op10_secrets, op11_lexical_search, op12_url_filters, op13_merkle)}
ORACLE: dict[str, str] = {"op11_lexical_search": SEARCH_SQL, "op12_url_filters": URLS_SQL, "op13_merkle": MERKLE_SQL}
