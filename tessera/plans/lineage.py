"""Lineage cuts that survive executor loss.

``checkpoint()`` writes to the shared folder named by ``spark.checkpoint.dir``
(reliable storage), never ``localCheckpoint``.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the same folder and read again: smaller than a checkpoint
    and read by column, for wide or long tables that several jobs read."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
