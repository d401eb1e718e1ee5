"""Session helpers: reading tables, the shared checkpoint folder, size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a side table that may be sent to every executor; beyond it callers take their shuffle or block path.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in spark.checkpoint.dir; set one only where there is none (local tests)."""
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = os.path.join(tempfile.gettempdir(), "tessitura-checkpoints")
        spark.sparkContext.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared checkpoint folder, so that its lineage survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def within(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most ``rows`` rows; reads no more than one row beyond that."""
    return df.limit(rows + 1).count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; a larger frame goes to a shuffle join."""
    return F.broadcast(df) if within(df, rows) else df


def blank_to_null(col):
    """NULL for text that is empty after trimming white space."""
    return F.when(F.length(F.trim(col)) > 0, col)
