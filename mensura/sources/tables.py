"""Parquet table access for the driver's data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_READS: dict = {}
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; columns are pruned and filters pushed by Catalyst.

    The relation (file listing and footers) is resolved once per session and
    path; DataFrames are immutable, so sharing the relation is safe.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _READS.get(key)
    if df is None:
        df = _READS[key] = spark.read.parquet(path)
    return df
