"""Materialise an intermediate that feeds several branches of one plan.

``checkpoint()`` writes it once to the shared folder named by
``spark.checkpoint.dir`` (read from the session; a scratch folder is only
created when it is unset, as in tests) and cuts the lineage, so a lost
executor does not recompute the whole upstream plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from sparktrail.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
