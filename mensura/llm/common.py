"""Shared helpers: table access, written intermediates, Arrow batch settings."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, remember

#: Rows in an Arrow batch handed to Python.  Texts may be long, so a batch is
#: kept small; operators cut it further by bytes (``words.slices``).
ARROW_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on, where the user left the default."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``;
    ``session.release`` deletes what was written there."""
    return remember(spark, f"{checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of the files, not the
    whole computation, and several consumers read the same rows.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sha_hex(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def sampled(df: DataFrame, columns: list[str], rows: int, total: int) -> DataFrame:
    """About ``rows`` of the ``total`` rows: those whose hash of ``columns``
    falls below that share of its range; all of them if they are fewer.

    A filter, so nothing is sorted or gathered, and the same rows are taken
    however they are dealt.
    """
    if total <= rows:
        return df
    return df.where(F.xxhash64(*columns) < F.lit(int(rows / total * 2**64) - 2**63))
