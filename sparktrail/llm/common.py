"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Word separators of the contracts, as a Java regular expression class.
SPACE = r"\x20\x09-\x0D"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again.

    Cuts the lineage: a lost executor costs no more than the table's own
    files, which are in the folder that all executors share.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that working columns can't clash."""
    return F.struct(*[col(c) for c in df.columns]).alias(name)


def unpacked(df: DataFrame, like: DataFrame, name: str = "row") -> DataFrame:
    """The columns that ``packed`` put away."""
    return df.select(*[F.col(name)[c].alias(c) for c in like.columns])


def ids_and_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text), a null text as the empty one."""
    return df.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; before each next one and at the end Arrow gives back what it has freed. It keeps that by itself, a
    hundred MB or so, and a Python worker stays beside the executor when its task is done."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
